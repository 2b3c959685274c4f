"""Order-dependent operators that must not funnel data into one task.

``ROW_NUMBER() OVER (ORDER BY k)`` without PARTITION BY is planned by Spark as
an ``Exchange SinglePartition``: every row of the table goes through one task.
``dense_surrogate_key`` works on *range buckets* instead: the table is
range-partitioned on the full sort order (plus a unique tie-breaker, so a hot
leading value is still split), every row records its bucket and its position in
it, and the table is written to the shared checkpoint folder so bucket ids are
stable for the later passes and survive executor loss.  The count per bucket
(one number each) gives the offsets, which are broadcast; key = position +
offset, a narrow projection.

``LEAD(x) OVER (PARTITION BY k ORDER BY x)`` hashes each key to one task, so a
key holding a third of the rows becomes a straggler.  ``lead_within_key`` cuts
every key into slices of the order column and needs no write.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from strata.session import scratch_path

BUCKET = "_bucket"
LOCAL = "_local"
SLICE = "_slice"
_LOW_33_BITS = (1 << 33) - 1


def materialise(df: DataFrame, label: str) -> DataFrame:
    """Write ``df`` as parquet under the shared checkpoint folder and read it back."""
    path = scratch_path(df.sparkSession, label)
    df.write.mode("overwrite").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def range_buckets(df: DataFrame, order_cols: Sequence[str], n_buckets: int | None = None,
                  with_position: bool = False) -> DataFrame:
    """Append ``_bucket``: ascending, contiguous ranges of ``order_cols`` (NULLS FIRST).

    Spark samples the full composite key to place the range bounds, so the
    buckets are balanced whenever the composite key is (nearly) unique.
    With ``with_position`` each bucket is also sorted and ``_local`` holds the
    row's 0-based position in it: the low 33 bits of
    ``monotonically_increasing_id`` are the record index within the partition.
    The result is materialised, so bucket ids do not change between passes.
    """
    order = [F.col(c).asc_nulls_first() for c in order_cols]
    # without an explicit count, AQE sizes the buckets: coalescing merges only
    # adjacent ranges, so coalesced partitions are still ordered buckets
    bucketed = df.repartitionByRange(n_buckets, *order) if n_buckets else df.repartitionByRange(*order)
    if with_position:
        bucketed = bucketed.sortWithinPartitions(*order)
    bucketed = bucketed.withColumn(BUCKET, F.spark_partition_id())
    if with_position:
        bucketed = bucketed.withColumn(LOCAL, F.monotonically_increasing_id().bitwiseAND(F.lit(_LOW_33_BITS)))
    return materialise(bucketed, "range-buckets")


def dense_surrogate_key(df: DataFrame, order_by: Sequence[str], name: str,
                        tie_breaker: Sequence[str] = (), n_buckets: int | None = None) -> DataFrame:
    """``ROW_NUMBER() OVER (ORDER BY order_by, tie_breaker)`` as BIGINT, without a single-task stage.

    Ascending, NULLS FIRST on every column.  Name the tie-breaker columns so
    the order is total; then the numbering is deterministic.  One range
    shuffle and one write; the numbering itself is a narrow projection.
    """
    cols = list(dict.fromkeys([*order_by, *tie_breaker]))
    b = range_buckets(df, cols, n_buckets, with_position=True)
    # one count per bucket: metadata bounded by the bucket count, not by the data
    counts = sorted((r[BUCKET], r["_n"]) for r in b.groupBy(BUCKET).agg(F.count(F.lit(1)).alias("_n")).collect())
    offsets, running = [], 0
    for bucket, n in counts:
        offsets.append((bucket, running))
        running += n
    table = df.sparkSession.createDataFrame(offsets, f"{BUCKET} int, _offset bigint")
    numbered = b.join(F.broadcast(table), BUCKET, "inner") \
        .withColumn(name, F.col(LOCAL) + F.col("_offset") + F.lit(1))
    return numbered.select(name, *df.columns)


def _slice_of(df: DataFrame, order_col: str, unit: str | float) -> Column:
    """Ascending slices of ``order_col``: a calendar unit of dates and times, a width of numbers."""
    kind = {f.name: f.dataType for f in df.schema.fields}[order_col]
    if isinstance(kind, (T.DateType, T.TimestampType, T.TimestampNTZType)):
        return F.date_trunc(unit if isinstance(unit, str) else "month", F.col(order_col))
    if isinstance(kind, T.NumericType) and not isinstance(unit, str):
        return F.floor(F.col(order_col) / F.lit(unit))
    return F.lit(0)


def lead_within_key(df: DataFrame, key: str, order_col: str, out: str,
                    tie_breaker: Sequence[str] = (), unit: str | float = "month") -> DataFrame:
    """``LEAD(order_col) OVER (PARTITION BY key ORDER BY order_col, tie_breaker)`` as ``out``.

    NULL keys form one partition, as in SQL.  A key's rows are cut into slices
    by a calendar ``unit`` of the order column (or a width, for numbers) and
    processed slice by slice, so a hot key is spread over as many tasks as it
    has slices; rows of one key and one order value stay together.  The first
    value of every (key, slice) comes from a partial aggregate; the next
    slice's first value joins the slice as a marker row that sorts last.  Lazy:
    nothing is written or sampled, the rows cross one exchange, and a plan that
    does not read ``out`` contains none of this.
    """
    tb = [c for c in dict.fromkeys(tie_breaker) if c not in (key, order_col)]
    sliced = df.withColumn(SLICE, _slice_of(df, order_col, unit))
    first = sliced.groupBy(key, SLICE).agg(F.min(order_col).alias("_first"))
    following = F.lead(F.struct(F.col("_first").alias("v"))).over(
        Window.partitionBy(key).orderBy(F.col(SLICE).asc_nulls_first()))
    markers = first.select(key, SLICE, following.alias("_after")).where(F.col("_after").isNotNull()).select(
        key, SLICE, F.col("_after.v").alias(order_col), F.lit(True).alias("_marker"))
    both = sliced.withColumn("_marker", F.lit(False)).unionByName(markers, allowMissingColumns=True)
    order = [F.col("_marker").asc(), F.col(order_col).asc_nulls_first(), *[F.col(c).asc_nulls_first() for c in tb]]
    # lead of a struct is NULL only past the slice's end, even when the next value is NULL
    nxt = F.lead(F.struct(F.col(order_col).alias("v"))).over(Window.partitionBy(key, SLICE).orderBy(*order))
    return both.withColumn("_next", nxt).where(~F.col("_marker")).select(*df.columns, F.col("_next.v").alias(out))


def scd2_end_date(df: DataFrame, key: str, start: str, out: str = "end_date",
                  tie_breaker: Sequence[str] = (), unit: str = "month") -> DataFrame:
    """Type-2 history: ``out`` = next version's ``start`` of the same ``key`` minus one day (DATE).

    The open (latest) version gets NULL.  Ties on ``start`` are ordered by
    ``tie_breaker``.
    """
    nxt = lead_within_key(df, key, start, "_next_start", tie_breaker, unit)
    return nxt.withColumn(out, F.date_sub(F.col("_next_start").cast("date"), 1)).drop("_next_start")

"""Type-2 history over successive loads, and an audit of its intervals.

A history table holds the versions of each key with the days they are valid
(``valid_from``, ``valid_to``; NULL: still valid).  ``merge_extract`` brings a new
full extract into it; ``interval_faults`` lists versions that overlap an earlier
one or leave days uncovered.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

FROM, TO = "valid_from", "valid_to"
OVERLAP, GAP = "overlap", "gap"
#: Stands for "still valid" while ends are compared.
FOREVER = "9999-12-31"


def row_hash(columns: Sequence[str]) -> Column:
    """A 64-bit hash of the columns' values; NULLs count."""
    return F.xxhash64(*[x for c in columns for x in (F.col(c).isNull(), F.col(c))])


def start_history(extract: DataFrame, as_of: str) -> DataFrame:
    """The history of a first extract: every row valid from ``as_of`` on."""
    return extract.withColumn(FROM, F.lit(as_of).cast("date")).withColumn(TO, F.lit(None).cast("date"))


def merge_extract(history: DataFrame, extract: DataFrame, keys: Sequence[str], as_of: str) -> DataFrame:
    """``history`` after a full ``extract`` (one row a key) of the day ``as_of``.

    The open versions meet the extract in one full outer join.  A key whose row
    hash did not change keeps its version; one that changed has it closed on
    the day before and a new one opened; a key that is gone is closed, a
    new one opened.  A version opened on ``as_of`` or later is replaced instead
    of closed, so merging the same day again gives the extract's state and
    replaying a merge changes nothing.  NULL keys match each other.  Closed
    versions pass through untouched; each side has one row a key, so no key
    is hot.
    """
    columns = [c for c in history.columns if c not in (FROM, TO)]
    tracked = [c for c in columns if c not in keys]
    day = F.lit(as_of).cast("date")
    old = history.where(F.col(TO).isNull()).select(F.struct(*columns, FROM).alias("old"), row_hash(tracked).alias("old_hash"))
    new = extract.select(F.struct(*columns).alias("new"), row_hash(tracked).alias("new_hash"))
    same_key = reduce(Column.__and__, [F.col(f"old.{k}").eqNullSafe(F.col(f"new.{k}")) for k in keys])
    both = old.join(new, same_key, "full_outer")

    def version(side: str, start: Column, end: Column) -> Column:
        return F.struct(*[F.col(f"{side}.{c}").alias(c) for c in columns], start.alias(FROM), end.cast("date").alias(TO))

    had, has = F.col("old").isNotNull(), F.col("new").isNotNull()
    unchanged = had & has & (F.col("old_hash") == F.col("new_hash"))
    kept = F.when(unchanged, version("old", F.col(f"old.{FROM}"), F.lit(None)))
    closed = F.when(had & ~unchanged & (F.col(f"old.{FROM}") < day), version("old", F.col(f"old.{FROM}"), F.date_sub(day, 1)))
    opened = F.when(has & ~unchanged, version("new", day, F.lit(None)))
    versions = both.select(F.explode(F.filter(F.array(kept, closed, opened), lambda v: v.isNotNull())).alias("v")).select("v.*")
    return history.where(F.col(TO).isNotNull()).unionByName(versions)


def interval_faults(history: DataFrame, key: str, start: str = FROM, end: str = TO, unit: str = "year") -> DataFrame:
    """Versions that overlap an earlier version of their key, or leave days uncovered after all earlier ones.

    ``(key, start, end, covered_to, fault)``: versions are swept by start (then
    end), ``covered_to`` is the latest end before; a NULL end lasts for ever, a
    NULL start is left out.  The sweep is cut into calendar slices of
    ``unit``: the latest end of every slice comes from a partial aggregate, its
    running maximum over a key's slices enters each slice as a row before
    all others, so a hot key is spread over as many tasks as it has slices.
    """
    last = F.coalesce(F.col(end), F.lit(FOREVER).cast("date"))
    rows = history.where(F.col(start).isNotNull()).select(
        F.col(key).alias("key"), F.col(start).cast("date").alias("start"), F.col(end).cast("date").alias("end"), last.alias("last"),
        F.trunc(start, unit).alias("slice"), F.lit(False).alias("carried"))
    before = Window.partitionBy("key").orderBy("slice").rowsBetween(Window.unboundedPreceding, -1)
    carried = rows.groupBy("key", "slice").agg(F.max("last").alias("top")).withColumn("last", F.max("top").over(before)) \
        .where(F.col("last").isNotNull()).select("key", "slice", "last", F.lit(True).alias("carried"))
    sweep = Window.partitionBy("key", "slice").orderBy(F.col("carried").desc(), "start", "last").rowsBetween(Window.unboundedPreceding, -1)
    covered = rows.unionByName(carried, allowMissingColumns=True).withColumn("covered_to", F.max("last").over(sweep))
    fault = F.when(F.col("start") <= F.col("covered_to"), F.lit(OVERLAP)).when(F.datediff("start", "covered_to") > 1, F.lit(GAP))
    return covered.where(~F.col("carried")).withColumn("fault", fault).where(F.col("fault").isNotNull()).select(
        F.col("key").alias(key), F.col("start").alias(start), F.col("end").alias(end), "covered_to", "fault")

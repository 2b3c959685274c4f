"""Keep one row per key.

``dedup_latest`` keeps, for every key, the row that sorts first under an
ORDER BY (the ``ROW_NUMBER() ... = 1`` idiom).  It is written as an aggregate
of ``max(struct(order columns..., payload...))`` (planned as a sort aggregate,
since the buffer holds strings) with partial aggregation, so the map side
keeps one candidate per key per partition before anything is shuffled: a key
holding a third of all rows (the NULL key, say) costs one row per map task in
the exchange, never a hot task.  Ties on the order columns are
broken by the remaining columns, so the result is a deterministic function of
the input multiset.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def dedup_latest(df: DataFrame, keys: Sequence[str], order_by: Sequence[str],
                 descending: bool = True, tie_breaker: Sequence[str] = ()) -> DataFrame:
    """One row per ``keys``: the greatest (``descending``) or least ``order_by``.

    NULL order values sort lowest, so DESC puts them last and ASC puts them
    first (the MySQL defaults).  NULL keys form one group, as in PARTITION BY.
    ``tie_breaker`` columns are compared next, then every other column.
    """
    keys = list(keys)
    lead = list(order_by) + [c for c in tie_breaker if c not in order_by]
    rest = [c for c in df.columns if c not in keys and c not in lead]
    fields = [F.col(c).alias(f"_o{i}") for i, c in enumerate(lead)] + [F.col(c) for c in rest]
    best = F.max if descending else F.min
    picked = df.groupBy(*keys).agg(best(F.struct(*fields)).alias("_best"))
    out = [F.col(k) for k in keys] + [F.col(f"_best._o{i}").alias(c) for i, c in enumerate(lead)] \
        + [F.col(f"_best.{c}").alias(c) for c in rest]
    return picked.select(*out).select(*df.columns)


def dedup_by_window(df: DataFrame, keys: Sequence[str], order: Sequence[Column]) -> DataFrame:
    """Top-1 per key for mixed sort directions (``row_number`` = 1).

    Catalyst plans a partial ``WindowGroupLimit`` before the exchange, so hot
    keys are cut to one row per map partition before the shuffle as well.
    """
    w = Window.partitionBy(*keys).orderBy(*order)
    return df.withColumn("_rn", F.row_number().over(w)).where(F.col("_rn") == 1).drop("_rn")


def keep_last_loaded(df: DataFrame, key: str, load_seq: str) -> DataFrame:
    """Keep the row with the highest load sequence per key, then drop the sequence.

    The set form of "delete every row whose auto id is not the max of its key".
    """
    return dedup_latest(df, [key], [load_seq], descending=True).drop(load_seq)

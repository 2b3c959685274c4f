"""Connected components over an edge table, iterated through written tables."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from strata.llm.common import materialise


def _large_star(edges: DataFrame) -> DataFrame:
    """Every larger neighbour of ``u`` is linked to the smallest node near ``u``."""
    both = edges.select("u", "v").union(edges.select(F.col("v"), F.col("u")))
    least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
    return both.where("v > u").join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))


def _small_star(edges: DataFrame) -> DataFrame:
    """Every smaller neighbour of ``u``, and ``u``, is linked to the smallest of them."""
    down = edges.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).where("u <> v")
    least = down.groupBy("u").agg(F.min("v").alias("m"))
    moved = down.join(least, "u").where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
    return moved.union(least.select("u", F.col("m").alias("v"))).distinct()


def components(edges: DataFrame) -> DataFrame:
    """``(node, root)`` for every node of ``edges(u, v)`` (long columns).

    ``root`` is the smallest node of the component.  Alternates large-star and
    small-star until the edges no longer change; every round is written to the
    shared folder, and only a checksum and a count reach the driver.  Self
    loops and repeated edges are allowed; an empty table gives an empty result.
    """
    nodes = edges.select(F.explode(F.array("u", "v")).alias("node")).distinct()
    state = materialise(edges.where("u <> v").select(F.greatest("u", "v").alias("u"),
                                                     F.least("u", "v").alias("v")).distinct(), "cc")
    mark = None
    while True:
        n, total = state.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if n == 0 or (n, total) == mark:
            break
        mark = (n, total)
        state = materialise(_small_star(_large_star(state)), "cc")
    return nodes.join(state.withColumnRenamed("u", "node"), "node", "left").select(
        "node", F.coalesce("v", "node").alias("root"))

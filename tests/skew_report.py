"""Measure how evenly the skew-safe operators spread a hot key over tasks.

Usage: python tests/skew_report.py [sf_dir]

A third of lineitem's rows get one key ("HOT").  Each operator runs next to
the plain Spark form of the same computation with the event log on; for each
run the report gives the largest share of rows that a single task read from a
shuffle.  Event logs go to a fresh scratch folder.
"""

from __future__ import annotations

import glob
import json
import sys
import tempfile

import zstandard
from pyspark.sql import SparkSession, Window
from pyspark.sql import functions as F


def main(sf_dir: str) -> dict[str, tuple[float, int, int]]:
    sys.path.insert(0, ".")
    from strata.operators.dedup import dedup_latest
    from strata.operators.ordered import dense_surrogate_key, lead_within_key
    from strata.plans.history import interval_faults

    logs = tempfile.mkdtemp(prefix="strata-skew-")
    spark = (SparkSession.builder.master("local[8]").config("spark.ui.enabled", "false")
             .config("spark.sql.shuffle.partitions", "16").config("spark.sql.adaptive.enabled", "true")
             .config("spark.sql.adaptive.coalescePartitions.enabled", "false")
             .config("spark.eventLog.enabled", "true").config("spark.eventLog.dir", logs)
             .config("spark.eventLog.compress", "false").getOrCreate())
    spark.sparkContext.setLogLevel("ERROR")
    li = spark.read.parquet(f"{sf_dir}/lineitem.parquet")
    hot = li.select(
        F.when(F.col("l_orderkey") % 3 == 0, F.lit("HOT")).otherwise(F.col("l_partkey").cast("string")).alias("k"),
        F.col("l_shipdate").cast("date").alias("d"),
        (F.col("l_orderkey") * 8 + F.col("l_linenumber")).alias("id"),
        F.col("l_extendedprice").alias("v"))
    runs = {
        "dedup_latest (aggregate, partial)": lambda: dedup_latest(hot, ["k"], ["d"], tie_breaker=["id"]),
        "  plain: row_number()=1 per key": lambda: hot.withColumn("rn", F.row_number().over(
            Window.partitionBy("k").orderBy(F.desc("d"), F.desc("id")))).where("rn = 1"),
        "lead_within_key (slices)": lambda: lead_within_key(hot, "k", "d", "nxt", tie_breaker=["id"]),
        "  plain: lead() over partition by key": lambda: hot.withColumn("nxt", F.lead("d").over(
            Window.partitionBy("k").orderBy("d", "id"))),
        "interval_faults (slices)": lambda: interval_faults(
            hot.select("k", F.col("d").alias("valid_from"), F.date_add("d", 3).alias("valid_to")), "k", unit="month"),
        "dense_surrogate_key (range buckets)": lambda: dense_surrogate_key(hot, ["k", "d"], "sk",
                                                                           tie_breaker=["id"], n_buckets=16),
        "  plain: row_number() over (order by)": lambda: hot.withColumn("sk", F.row_number().over(
            Window.orderBy("k", "d", "id"))),
    }
    # business-key join as in the fact: sort-merge (no broadcast), with and without AQE skew splitting;
    # thresholds lowered because partitions here are far below a cluster's 256 MB default
    part = spark.read.parquet(f"{sf_dir}/part.parquet")
    dim = part.select(F.col("p_partkey").cast("string").alias("k"), F.col("p_name")).unionByName(
        part.where(F.col("p_partkey") == 0).select(F.lit("HOT").alias("k"), F.col("p_name")))
    # AQE splits a skewed partition along map-task boundaries; a large table has thousands of
    # map tasks, this file only a few, so the probe side is first spread over 64 map tasks
    many = hot.repartition(64)
    runs["left join on hot key (AQE skew split)"] = lambda: many.join(dim, "k", "left")
    runs["  plain: same join, skew split off"] = lambda: many.join(dim, "k", "left")
    for name, build in runs.items():
        join = "join" in name
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1" if join else "10MB")
        spark.conf.set("spark.sql.adaptive.skewJoin.enabled", str(not name.startswith("  plain: same join")).lower())
        spark.conf.set("spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes", "64KB")
        spark.conf.set("spark.sql.adaptive.advisoryPartitionSizeInBytes", "64KB")
        spark.sparkContext.setJobGroup(name, name)
        build().write.format("noop").mode("overwrite").save()
    spark.stop()

    files = [f for f in glob.glob(f"{logs}/**", recursive=True) if "events" in f or f.endswith("local-")
             or "local-" in f]
    lines = []
    for f in files:
        try:
            raw = open(f, "rb").read()
        except IsADirectoryError:
            continue
        if f.endswith(".zstd"):
            raw = zstandard.ZstdDecompressor().stream_reader(raw).read()
        lines += raw.decode(errors="ignore").splitlines()
    job_group, stage_group, per_stage = {}, {}, {}
    for line in lines:
        try:
            e = json.loads(line)
        except ValueError:
            continue
        ev = e.get("Event")
        if ev == "SparkListenerJobStart":
            g = e.get("Properties", {}).get("spark.jobGroup.id")
            for s in e["Stage IDs"]:
                stage_group[s] = g
        elif ev == "SparkListenerTaskEnd" and e.get("Task Metrics"):
            m = e["Task Metrics"].get("Shuffle Read Metrics", {})
            recs = m.get("Total Records Read", 0)
            per_stage.setdefault(e["Stage ID"], []).append(recs)
    report = {}
    for stage, recs in per_stage.items():
        g = stage_group.get(stage)
        total = sum(recs)
        if g is None or total == 0:
            continue
        share = max(recs) / total
        best = report.get(g)
        if best is None or total > best[1]:
            report[g] = (share, total, len(recs))
    return {name.strip(): report[name] for name in runs if name in report}


if __name__ == "__main__":
    args = [a for a in sys.argv[1:] if not a.startswith("--")]
    result = main(args[0] if args else "/root/testdata/sf0.1")
    if "--json" in sys.argv:
        print(json.dumps(result))
    else:
        print(f"{'operator':42s} {'largest task share':>18s} {'rows shuffled':>14s} {'tasks':>6s}")
        for name, (share, total, n) in result.items():
            print(f"{name:42s} {share:18.1%} {total:14d} {n:6d}")

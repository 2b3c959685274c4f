import datetime as dt
import random

from pyspark.sql import Window
from pyspark.sql import functions as F

from strata.operators.dedup import dedup_by_window, dedup_latest, keep_last_loaded
from strata.operators.joins import orphans
from strata.operators.ordered import dense_surrogate_key, lead_within_key


def test_dedup_latest_null_key_is_one_group_and_nulls_sort_last(spark):
    df = spark.createDataFrame([
        (1, "a", dt.date(2020, 1, 1)), (1, "b", dt.date(2021, 1, 1)), (1, "c", None),
        (None, "x", dt.date(2019, 1, 1)), (None, "y", dt.date(2022, 1, 1)),
        (2, "p", None), (2, "q", None),
    ], "k int, v string, d date")
    got = sorted(dedup_latest(df, ["k"], ["d"], tie_breaker=["v"]).collect(), key=lambda r: (r.k is not None, r.k))
    assert [tuple(r) for r in got] == [(None, "y", dt.date(2022, 1, 1)), (1, "b", dt.date(2021, 1, 1)), (2, "q", None)]


def test_dedup_latest_matches_window_on_hot_key(spark):
    rnd = random.Random(7)
    data = [(0 if i % 3 == 0 else rnd.randint(1, 50), i, rnd.randint(0, 30)) for i in range(3000)]
    df = spark.createDataFrame(data, "k int, id int, d int")
    a = {tuple(r) for r in dedup_latest(df, ["k"], ["d"], tie_breaker=["id"]).collect()}
    b = {tuple(r) for r in dedup_by_window(df, ["k"], [F.col("d").desc(), F.col("id").desc()]).collect()}
    assert a == b and len(a) == 51


def test_keep_last_loaded(spark):
    df = spark.createDataFrame([("A", "US", 1), ("A", "DE", 7), ("B", "FR", 3)], "cid string, c string, seq int")
    assert sorted(tuple(r) for r in keep_last_loaded(df, "cid", "seq").collect()) == [("A", "DE"), ("B", "FR")]


def _hot_table(spark, n=4000, seed=3):
    rnd = random.Random(seed)
    rows = []
    for i in range(n):
        # a third of all rows share one key and one leading value; some NULLs
        k = "HOT" if i % 3 == 0 else (None if i % 17 == 0 else f"K{rnd.randint(0, 40):02d}")
        d = dt.date(2000, 1, 1) if i % 3 == 0 and i % 2 == 0 else (
            None if i % 23 == 0 else dt.date(2000, 1, 1) + dt.timedelta(days=rnd.randint(0, 400)))
        rows.append((k, d, i))
    return spark.createDataFrame(rows, "k string, d date, id int")


def test_dense_surrogate_key_equals_global_row_number(spark):
    df = _hot_table(spark)
    got = dense_surrogate_key(df, ["d", "k"], "sk", tie_breaker=["id"], n_buckets=7)
    ref = df.withColumn("sk", F.row_number().over(Window.orderBy(
        F.col("d").asc_nulls_first(), F.col("k").asc_nulls_first(), "id")).cast("bigint"))
    assert sorted(tuple(r) for r in got.collect()) == sorted(tuple(r) for r in ref.select(*got.columns).collect())
    keys = [r.sk for r in got.select("sk").collect()]
    assert sorted(keys) == list(range(1, df.count() + 1))


def test_dense_surrogate_key_balances_hot_leading_value(spark):
    df = _hot_table(spark)
    from strata.operators.ordered import range_buckets

    b = range_buckets(df, ["d", "k", "id"], 6)
    sizes = [r["count"] for r in b.groupBy("_bucket").count().collect()]
    assert max(sizes) < 0.5 * df.count()       # the hot third is split over buckets


def test_lead_within_key_equals_window_lead(spark):
    df = _hot_table(spark, n=3000, seed=11)
    got = lead_within_key(df, "k", "d", "nxt", tie_breaker=["id"])
    ref = df.withColumn("nxt", F.lead("d").over(Window.partitionBy("k").orderBy(F.col("d").asc_nulls_first(), "id")))
    assert sorted(map(str, got.collect())) == sorted(map(str, ref.select(*got.columns).collect()))


def test_orphans(spark):
    fact = spark.createDataFrame([(1, 10), (2, 99), (3, None)], "id int, pk int")
    dim = spark.createDataFrame([(10,), (11,)], "pk int")
    assert sorted(r.id for r in orphans(fact, dim, [("pk", "pk")]).collect()) == [2, 3]

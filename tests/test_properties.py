"""Property tests: the skew-safe operators equal Spark's single-task window forms."""

import datetime as dt

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import Window
from pyspark.sql import functions as F

from strata.operators.dedup import dedup_by_window, dedup_latest
from strata.operators.ordered import dense_surrogate_key, lead_within_key

keys = st.one_of(st.none(), st.sampled_from(["a", "b", "c", "hot"]))
days = st.one_of(st.none(), st.integers(0, 6).map(lambda d: dt.date(2020, 1, 1) + dt.timedelta(days=d)))
tables = st.lists(st.tuples(keys, days), min_size=1, max_size=60)
SETTINGS = settings(max_examples=8, deadline=None, suppress_health_check=list(HealthCheck))


def _df(spark, rows):
    return spark.createDataFrame([(k, d, i) for i, (k, d) in enumerate(rows)], "k string, d date, id int")


@SETTINGS
@given(rows=tables, n=st.integers(1, 5))
def test_dense_key_property(spark, rows, n):
    df = _df(spark, rows)
    got = dense_surrogate_key(df, ["d", "k"], "sk", tie_breaker=["id"], n_buckets=n)
    ref = df.withColumn("sk", F.row_number().over(
        Window.orderBy(F.col("d").asc_nulls_first(), F.col("k").asc_nulls_first(), "id")).cast("bigint"))
    assert sorted(map(tuple, got.collect())) == sorted(map(tuple, ref.select(*got.columns).collect()))


@SETTINGS
@given(rows=tables, unit=st.sampled_from(["month", "year", "day"]))
def test_lead_property(spark, rows, unit):
    df = _df(spark, rows)
    got = lead_within_key(df, "k", "d", "nxt", tie_breaker=["id"], unit=unit)
    ref = df.withColumn("nxt", F.lead("d").over(Window.partitionBy("k").orderBy(F.col("d").asc_nulls_first(), "id")))
    assert sorted(map(str, got.collect())) == sorted(map(str, ref.select(*got.columns).collect()))


@SETTINGS
@given(rows=tables)
def test_dedup_property(spark, rows):
    df = _df(spark, rows)
    got = {tuple(r) for r in dedup_latest(df, ["k"], ["d"], tie_breaker=["id"]).collect()}
    ref = {tuple(r) for r in dedup_by_window(df, ["k"], [F.col("d").desc_nulls_last(), F.col("id").desc()]).collect()}
    assert got == ref

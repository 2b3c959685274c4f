import datetime as dt

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from conftest import SF_SMALL
from strata.plans import history, trends
from strata.plans.layers import Layers
from strata.plans.registry import QUERIES

D = dt.date
SCHEMA = "k string, v string, w int"


def _rows(df):
    return sorted((tuple(r) for r in df.collect()), key=str)


def test_merge_opens_closes_keeps_and_replays(spark):
    first = spark.createDataFrame([("a", "x", 1), ("b", "x", None), ("c", "x", 1), (None, "n", 1)], SCHEMA)
    second = spark.createDataFrame([("a", "x", 1), ("b", None, None), ("d", "new", 2), (None, "n", 1)], SCHEMA)
    h = history.merge_extract(history.start_history(first, "2024-01-01"), second, ["k"], "2024-02-01")
    expected = sorted([("a", "x", 1, D(2024, 1, 1), None), ("b", "x", None, D(2024, 1, 1), D(2024, 1, 31)),
                       ("b", None, None, D(2024, 2, 1), None),                      # a value that became NULL is a change
                       ("c", "x", 1, D(2024, 1, 1), D(2024, 1, 31)), ("d", "new", 2, D(2024, 2, 1), None),
                       (None, "n", 1, D(2024, 1, 1), None)], key=str)
    assert _rows(h) == expected
    assert _rows(history.merge_extract(h, second, ["k"], "2024-02-01")) == expected
    # the same day again with other rows: versions of that day are replaced, none ends before it began
    again = history.merge_extract(h, first, ["k"], "2024-02-01")
    assert again.where("valid_to < valid_from").count() == 0
    assert _rows(again.where("valid_to IS NULL").select("k", "v", "w")) == _rows(first)
    empty = first.limit(0)
    assert history.merge_extract(history.start_history(empty, "2024-01-01"), empty, ["k"], "2024-02-01").count() == 0


_EXTRACT = st.dictionaries(st.sampled_from("abcde"), st.sampled_from(["x", "y", None]), max_size=5)


@settings(max_examples=8, deadline=None, suppress_health_check=list(HealthCheck))
@given(st.lists(_EXTRACT, min_size=2, max_size=4))
def test_history_shows_every_extract_on_its_day(spark, extracts):
    """After any number of loads the versions valid on a load's day are that load's rows, without faults in between."""
    h = None
    for n, rows in enumerate(extracts):
        e = spark.createDataFrame([(k, v, 1) for k, v in rows.items()], SCHEMA)
        day = f"2024-0{n + 1}-01"
        h = history.start_history(e, day) if h is None else history.merge_extract(h, e, ["k"], day)
    got = h.collect()
    for n, rows in enumerate(extracts):
        day = D(2024, n + 1, 1)
        valid = {r.k: r.v for r in got if r.valid_from <= day and (r.valid_to is None or r.valid_to >= day)}
        assert valid == rows
    assert [r for r in history.interval_faults(h, "k").collect() if r.fault == "overlap"] == []


def test_interval_faults_across_slices_and_open_ends(spark):
    rows = [("a", D(2020, 1, 1), D(2023, 6, 30)), ("a", D(2021, 5, 1), D(2021, 6, 1)),     # inside an interval of an earlier year
            ("a", D(2023, 7, 1), D(2023, 7, 31)), ("a", D(2023, 8, 2), None),               # one day uncovered
            ("a", D(2025, 1, 1), D(2025, 2, 1)),                                            # after one that lasts for ever
            ("b", D(2020, 1, 1), D(2020, 1, 31)), ("b", D(2020, 2, 1), None), ("c", None, D(2020, 1, 1)),
            (None, D(2020, 1, 1), D(2020, 1, 5)), (None, D(2020, 1, 5), None)]
    df = spark.createDataFrame(rows, "k string, valid_from date, valid_to date")
    for unit in ("year", "month"):
        assert _rows(history.interval_faults(df, "k", unit=unit)) == sorted([
            ("a", D(2021, 5, 1), D(2021, 6, 1), D(2023, 6, 30), "overlap"), ("a", D(2023, 8, 2), None, D(2023, 7, 31), "gap"),
            ("a", D(2025, 1, 1), D(2025, 2, 1), D(9999, 12, 31), "overlap"),
            (None, D(2020, 1, 5), None, D(2020, 1, 5), "overlap")], key=str)


def test_sweep_shuffles_by_key_and_slice(spark):
    """No exchange deals the versions by their key alone."""
    df = spark.range(1000).select(F.expr("if(id % 3 = 0, 'hot', cast(id as string))").alias("k"),
                                  F.expr("date_add(DATE'2000-01-01', cast(id as int))").alias("valid_from"),
                                  F.expr("CAST(NULL AS DATE)").alias("valid_to"))
    plan = history.interval_faults(df, "k")._jdf.queryExecution().executedPlan().toString()
    dealt = [x for x in plan.splitlines() if "hashpartitioning(key" in x]
    assert len([x for x in dealt if "slice" not in x]) == 1 < len(dealt)  # the maxima of the slices only


def _monthly(spark, rows):
    return spark.createDataFrame([(D(*m, 1) if m else None, c, k, 1, s) for m, c, k, s in rows],
                                 "month date, country string, category string, n_sales long, sales int").withColumn("sales", F.col("sales").cast("decimal(38,2)"))


def test_trend_fills_months_and_compares_years(spark):
    rows = _monthly(spark, [((2020, 1), "A", None, 10), ((2020, 4), "A", None, 40), ((2021, 1), "A", None, 5), (None, "A", None, 99)])
    got = {(r.month.year, r.month.month): r for r in trends.sales_trend(rows).collect()}
    assert len(got) == 13 and got[2020, 2].sales == 0 and got[2020, 2].n_sales == 0
    assert got[2020, 4].moving_sales == 40 and got[2020, 3].moving_sales == 10 and got[2020, 2].moving_average == 5.0
    assert got[2021, 1].sales_year_ago == 10 and got[2020, 12].sales_year_ago is None


def test_rollup_levels_add_up(spark):
    rows = _monthly(spark, [((2020, 1), "A", "x", 1), ((2020, 1), None, "x", 2), ((2020, 2), "A", None, 4)])
    got = {(r.level, r.month, r.country, r.category): r.sales for r in trends.sales_rollup(rows).collect()}
    assert got[7, None, None, None] == 7 and got[0, D(2020, 1, 1), None, "x"] == 2   # a NULL country is not a total
    assert got[3, D(2020, 1, 1), None, None] == 3 and got[5, None, "A", None] == 5 and got[5, None, None, None] == 2


def test_repeated_dimension_rows_do_not_multiply_sales(spark):
    layers = Layers(spark, SF_SMALL)
    total = QUERIES["gold_sales_by_month"](spark, SF_SMALL).agg(F.sum("sales"), F.sum("n_sales")).first()
    sales = layers.silver("crm_sales_details").agg(F.sum("sls_sales"), F.count("*")).first()
    assert tuple(total) == tuple(sales)


def test_collated_join_has_no_python_and_ignores_case(spark):
    df = QUERIES["gold_dim_customers_collated"](spark, SF_SMALL)
    plain = QUERIES["gold_dim_customers"](spark, SF_SMALL)
    assert df.where("birthdate IS NOT NULL").count() > plain.where("birthdate IS NOT NULL").count()
    assert "Python" not in df._jdf.queryExecution().executedPlan().toString()

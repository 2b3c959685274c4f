import datetime as dt

from strata.operators.joins import orphans
from strata.plans import quality


def _rule(name):
    return {n: p for n, _, p in quality.row_rules("2026-01-01")}[name]


def test_row_rules_do_not_flag_clean_rows(spark):
    prd = spark.createDataFrame([
        (1, "CO-RF-P1", "a", 10, "M", dt.datetime(2020, 1, 1), dt.datetime(2020, 6, 1)),   # clean
        (2, "CORFP2", "b", 0, "R", dt.datetime(2020, 1, 1), dt.datetime(2019, 6, 1)),      # zero cost, bad order
    ], "prd_id int, prd_key string, prd_nm string, prd_cost int, prd_line string, "
       "prd_start_dt timestamp_ntz, prd_end_dt timestamp_ntz")
    assert [r.prd_id for r in prd.where(_rule("dq_prd_key_dash")).collect()] == [1]
    assert [r.prd_id for r in prd.where(_rule("dq_prd_date_order")).collect()] == [2]
    assert [r.prd_id for r in prd.where(_rule("dq_prd_cost_missing")).collect()] == [2]
    loc = spark.createDataFrame([("AW-1", "DE"), ("AW2", "US")], "cid string, cntry string")
    assert [r.cid for r in loc.where(_rule("dq_loc_cid_dash")).collect()] == ["AW-1"]


def test_sales_rule_three_valued(spark):
    s = spark.createDataFrame([("a", 10, 2, 5), ("b", 11, 2, 5), ("c", None, 2, 5), ("d", 10, 2, None),
                               ("e", 2000000000, 2, 1000000000)],
                              "sls_ord_num string, sls_sales int, sls_quantity int, sls_price int")
    # the product is computed in BIGINT, so a large quantity * price does not overflow
    assert sorted(r.sls_ord_num for r in s.where(_rule("dq_sales_rule")).collect()) == ["b", "c", "d"]


def test_orphan_audit_counts_literal_orphans(spark):
    fact = spark.createDataFrame([(1, 10), (2, 99), (3, 98)], "customer_key long, product_key long")
    dim = spark.createDataFrame([(10,), (11,)], "product_key long")
    out = quality._orphan_count(quality.MISSING_PRODUCTS, orphans(fact, dim, [("product_key", "product_key")]))
    assert [tuple(r) for r in out.collect()] == [("Productos Faltantes", 2)]


def test_open_versions_that_fan_out_are_listed(spark):
    class Planted:
        """P1 has one open version, P2 two, P3 one whose category is listed twice."""

        def silver(self, name):
            if name == "crm_prd_info":
                return spark.createDataFrame([
                    ("P1", "A", None), ("P1", "A", dt.date(2020, 1, 1)), ("P2", "A", None), ("P2", "B", None), ("P3", "C", None)],
                    "prd_key string, cat_id string, prd_end_dt date")
            return spark.createDataFrame([("A",), ("C",), ("C",)], "id string")

    assert sorted(tuple(r) for r in quality.dq_current_product_fanout(Planted()).collect()) == [("P2", 2), ("P3", 2)]

"""Plan-shape checks: the properties the operators rely on at scale."""


import __spark_entry__ as entry
from conftest import SF_SMALL
from strata.operators.ordered import dense_surrogate_key, lead_within_key
from strata.plans import gold
from strata.plans.layers import Layers


def plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def test_dedup_reduces_before_the_exchange(spark):
    p = plan(entry.queries()["silver_crm_cust_info"](spark, SF_SMALL))
    exchange = p.index("Exchange hashpartitioning(cst_id")
    assert "partial_max" in p[exchange:]          # partial aggregate sits below (after, in text) the exchange


def test_dense_key_has_no_single_partition_over_rows(spark):
    base = Layers(spark, SF_SMALL).silver("crm_prd_info")
    p = plan(dense_surrogate_key(base, ["prd_start_dt", "prd_key"], "k", tie_breaker=["prd_id"]))
    _no_single_partition(p)
    assert "Window [row_number()" not in p         # numbering is a projection, not a window


def test_lead_is_lazy_and_shuffles_the_rows_once(spark):
    b = Layers(spark, SF_SMALL).bronze("crm_prd_info")
    before = len(spark.sparkContext.statusTracker().getJobIdsForGroup(None))
    p = plan(lead_within_key(b, "prd_key", "prd_start_dt", "nxt", tie_breaker=["prd_id"]))
    assert len(spark.sparkContext.statusTracker().getJobIdsForGroup(None)) == before  # no job starts
    assert "Join" not in p
    wide = [x for x in p.splitlines() if "Exchange hashpartitioning(prd_key" in x and "_slice" in x]
    assert len(wide) == 2                          # the rows with their markers, and the partial first values
    assert p.count("Exchange ") == 3               # and those first values by key


def test_product_dimension_and_fact_skip_the_history(spark):
    for name in ("gold_dim_products", "gold_fact_sales"):
        layers = Layers(spark, SF_SMALL)
        base = layers.dim_products_base() if name == "gold_dim_products" else layers.fact_sales_base()
        assert "lead(" not in base._jdf.queryExecution().optimizedPlan().toString()


def test_scans_read_only_needed_columns(spark):
    p = plan(entry.queries()["dq_loc_cid_dash"](spark, SF_SMALL))
    assert "ReadSchema: struct<c_custkey:bigint>" in p
    p = plan(entry.queries()["silver_erp_loc_a101"](spark, SF_SMALL))
    assert "Exchange" not in p                     # narrow projection


def _no_single_partition(p: str) -> None:
    """Rows never go to one partition; only partial global counts may (one row per task)."""
    lines = p.splitlines()
    for i, line in enumerate(lines):
        if "Exchange SinglePartition" in line:
            assert "HashAggregate(keys=[]" in lines[i + 1], lines[i + 1]


def test_summary_merges_only_partial_counts(spark):
    _no_single_partition(plan(entry.queries()["dq_summary"](spark, SF_SMALL)))


def test_fact_has_no_single_partition(spark):
    _no_single_partition(plan(entry.queries()["gold_fact_sales"](spark, SF_SMALL)))


def test_product_versions_multiply_sales_after_the_last_exchange(spark):
    """Customers are looked up first: the rows that product versions multiply are not shuffled again."""
    sales = spark.range(1).selectExpr("'a' AS sls_ord_num", "concat('p', id % 1) AS sls_prd_key", "id AS sls_cust_id", "current_date() AS sls_order_dt",
                                      "current_date() AS sls_ship_dt", "current_date() AS sls_due_dt", "1 AS sls_sales", "1 AS sls_quantity", "1 AS sls_price")
    products = spark.range(2).selectExpr("id + 1 AS product_key", "concat('p', id % 1) AS product_number")
    customers = spark.range(1).selectExpr("id + 1 AS customer_key", "id AS customer_id")
    for build in (gold.fact_sales, gold.fact_sales_unkeyed, gold.fact_sales_outcomes):
        df = build(sales, products, customers)
        assert df.count() == 2
        joins = [x for x in plan(df).splitlines() if "Join" in x]
        assert "sls_prd_key" in joins[0] and "sls_cust_id" not in joins[0], joins


def test_a_filter_on_silver_dates_repeats_their_source_few_times(spark):
    """The date filter goes into the join of lines and orders, where each occurrence of a date's column repeats its expression."""
    rows = Layers(spark, SF_SMALL).silver("crm_sales_details").where("sls_ship_dt < sls_order_dt")
    condition = next(x for x in rows._jdf.queryExecution().optimizedPlan().toString().splitlines() if "Join" in x)
    assert condition.count("CASE WHEN") <= 8, condition.count("CASE WHEN")


def test_lines_cross_their_exchange_without_prices_of_cents(spark):
    p = plan(Layers(spark, SF_SMALL).bronze("crm_sales_details"))
    joined = [x for x in p.splitlines() if x.strip(" :+-*()0123456789").startswith("Project") and "l_linenumber" in x]
    assert any("AS unit#" in x for x in joined) and not any("sls_price" in x and "l_extendedprice" in x for x in joined)

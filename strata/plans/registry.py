"""Named queries: every operator of the warehouse as a DataFrame over the driver's tables.

Each entry takes ``(spark, sf_dir)`` and returns a DataFrame; the matching
DuckDB statement lives in ``strata.oracle``.  Queries run over whole
tables; the only ordering is the one the audit itself asks for.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from strata.functions import cleaning as c
from strata.plans import gold, history, pipeline, quality, silver, trends
from strata.plans.layers import Layers
from strata.session import drop_shuffles, scratch_path, scratch_removed
from strata.sources import csv_ingest, fixtures

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}


def query(fn: Callable[[Layers], DataFrame]) -> Callable[[Layers], DataFrame]:
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        return fn(Layers(spark, sf_dir))

    run.__name__ = fn.__name__
    run.__doc__ = fn.__doc__
    QUERIES[fn.__name__] = run
    return fn


# ---------------------------------------------------------------- silver tables
for _name in silver.SILVER_COLUMNS:
    def _silver(layers: Layers, _n: str = _name) -> DataFrame:
        return layers.silver(_n)

    _silver.__name__ = f"silver_{_name}"
    query(_silver)


# ---------------------------------------------------------------- composite operators
@query
def dedup_latest_customer(layers: Layers) -> DataFrame:
    """Newest bronze row per customer id."""
    return silver.latest_customers(layers.bronze("crm_cust_info"))


@query
def split_product_key(layers: Layers) -> DataFrame:
    cat_id, prd_key = c.split_product_key("prd_key")
    return layers.bronze("crm_prd_info").select("prd_id", F.col("prd_key").alias("source_key"),
                                                cat_id.alias("cat_id"), prd_key.alias("prd_key"))


@query
def scd2_end_date(layers: Layers) -> DataFrame:
    """History end date = next version's start - 1 day, per raw product key."""
    t = silver.with_history_end(layers.bronze("crm_prd_info"))
    return t.select("prd_id", "prd_key", F.col("prd_start_dt").cast("date").alias("prd_start_dt"),
                    F.col("_end_dt").alias("prd_end_dt"))


@query
def repair_sales(layers: Layers) -> DataFrame:
    b = layers.bronze("crm_sales_details")
    return b.select("sls_ord_num", "sls_sales", "sls_quantity", "sls_price",
                    c.repair_sales("sls_sales", "sls_quantity", "sls_price").alias("repaired_sales"))


@query
def repair_price(layers: Layers) -> DataFrame:
    b = layers.bronze("crm_sales_details")
    return b.select("sls_ord_num", "sls_sales", "sls_quantity", "sls_price",
                    c.repair_price("sls_sales", "sls_quantity", "sls_price").alias("repaired_price"))


@query
def harmonise_customer_keys(layers: Layers) -> DataFrame:
    loc = layers.bronze("erp_loc_a101").select(
        F.lit("erp_loc_a101").alias("source"), F.col("cid").alias("raw_cid"), c.strip_chars("cid", "-").alias("cid"))
    az = layers.bronze("erp_cust_az12").select(
        F.lit("erp_cust_az12").alias("source"), F.col("cid").alias("raw_cid"), c.strip_prefix("cid", "NAS").alias("cid"))
    return loc.unionByName(az)


def _gender(layers: Layers, unknown: str) -> DataFrame:
    return gold.dim_customers_unkeyed(layers.silver("crm_cust_info"), layers.silver("erp_cust_az12"),
                                      layers.silver("erp_loc_a101"), unknown).select("customer_number", "gender")


@query
def master_fallback_gender(layers: Layers) -> DataFrame:
    """CRM gender unless 'n/a', else ERP gender (faithful: the fallback never fires)."""
    return _gender(layers, c.NA)


@query
def master_fallback_gender_fixed(layers: Layers) -> DataFrame:
    """The repaired rule: fall back when CRM says 'Not Specified'."""
    return _gender(layers, c.NOT_SPECIFIED)


@query
def surrogate_key_customers(layers: Layers) -> DataFrame:
    return layers.dim_customers().select("customer_key", "customer_id", "customer_number")


@query
def surrogate_key_products(layers: Layers) -> DataFrame:
    return layers.dim_products().select("product_key", "product_id", "product_number", "start_time")


@query
def gold_dim_customers(layers: Layers) -> DataFrame:
    return layers.dim_customers()


@query
def gold_dim_products(layers: Layers) -> DataFrame:
    return layers.dim_products()


@query
def gold_dim_products_current(layers: Layers) -> DataFrame:
    """Open product versions only, numbered among themselves."""
    return layers.dim_products(current_only=True)


@query
def gold_fact_sales(layers: Layers) -> DataFrame:
    return layers.fact_sales()


@query
def dedup_keep_last_loaded(layers: Layers) -> DataFrame:
    return quality.dedup_keep_last_loaded(layers)


@query
def scalar_functions(layers: Layers) -> DataFrame:
    """The scalar functions of the warehouse on one table."""
    b = layers.bronze("crm_prd_info")
    cost, line, key = F.col("prd_cost"), F.col("prd_line"), F.col("prd_key")
    return b.select(
        "prd_id",
        F.trim(line).alias("f_trim"),
        F.upper(line).alias("f_upper"),
        F.replace(key, F.lit("-"), F.lit("_")).alias("f_replace"),
        F.substring(key, 1, 5).alias("f_substring"),
        F.substring(key, 20, 5).alias("f_substring_past_end"),
        F.length(key).alias("f_length"),
        F.concat(key, F.lit("|"), F.col("prd_nm")).alias("f_concat"),
        F.abs(cost - 1000).alias("f_abs"),
        (cost * 2 - 1).alias("f_arith"),
        (cost.cast("decimal(12,0)") / F.lit(4)).cast("decimal(12,2)").alias("f_div"),
        F.nullif(line, F.lit("S")).alias("f_nullif"),
        F.coalesce(cost, F.lit(0)).alias("f_ifnull"),
        F.coalesce(line, F.lit(c.NA)).alias("f_coalesce"),
        F.col("prd_start_dt").cast("date").alias("f_cast_date"),
        F.date_sub(F.col("prd_start_dt").cast("date"), 1).alias("f_date_sub"),
    )


def _row_counts(layers: Layers, layer: str) -> DataFrame:
    get = layers.bronze if layer == "bronze" else layers.silver
    parts = [get(n).agg(F.count(F.lit(1)).alias("rows_loaded")).select(
        F.lit(f"{layer}.{n}").alias("table_name"), "rows_loaded") for n in silver.SILVER_COLUMNS]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


@query
def bronze_row_counts(layers: Layers) -> DataFrame:
    return _row_counts(layers, "bronze")


@query
def silver_row_counts(layers: Layers) -> DataFrame:
    return _row_counts(layers, "silver")


# ---------------------------------------------------------------- data-quality audits
DQ_QUERIES = quality.AUDITS
for _name in DQ_QUERIES:
    query(getattr(quality, _name))


@query
def dq_summary(layers: Layers) -> DataFrame:
    """Violations per row-level rule, all rules of a table counted in one pass."""
    return quality.summary(layers)


# ---------------------------------------------------------------- sources and sinks
def _roundtrip(layers: Layers, name: str) -> DataFrame:
    """An extract written as its source system delivers it and loaded back."""
    folder = scratch_path(layers.spark, "sources")
    csv_ingest.write_source_csv(layers.bronze(name), folder, name)
    return csv_ingest.read_bronze(layers.spark, folder, name)


@query
def csv_ingest_roundtrip(layers: Layers) -> DataFrame:
    """Sales extract written as CSV and loaded back into bronze."""
    return _roundtrip(layers, "crm_sales_details")


@query
def bronze_empty_to_null(layers: Layers) -> DataFrame:
    """Customer extract: empty text stays '', ``\\N`` is NULL, empty dates and numbers become NULL."""
    return _roundtrip(layers, "crm_cust_info")


@query
def bronze_malformed_rows(layers: Layers) -> DataFrame:
    """A customer extract with row ends and quotes inside fields, NULL words, empty values, short and long rows:
    every row as loaded, with its source text where the number of fields is wrong."""
    name = "crm_cust_info"
    path = csv_ingest.write_lines(fixtures.customer_lines(layers.spark, layers.sf_dir), scratch_path(layers.spark, "sources"), name)
    raw = csv_ingest.read_source_csv(layers.spark, path, csv_ingest.SOURCES[name][1])
    return csv_ingest.to_bronze(name, raw, keep=(csv_ingest.MALFORMED,)).withColumnRenamed(csv_ingest.MALFORMED, "malformed_row")


@query
def bronze_parse_dmy_date(layers: Layers) -> DataFrame:
    """ERP customer extract with birth dates delivered as DD/MM/YYYY."""
    return _roundtrip(layers, "erp_cust_az12")


def _load_extracts(layers: Layers, rows: Callable[[str], DataFrame], wh: str, tables: tuple[str, ...]) -> None:
    """Write extracts of ``rows``, load them into the bronze tables of a warehouse and drop them.

    Beside the tables only the extracts of one load are on disk, compressed.
    """
    with scratch_removed(layers.spark):
        folder = scratch_path(layers.spark, "sources")
        for name in tables:
            csv_ingest.write_source_csv(rows(name), folder, name, compressed=True)
        drop_shuffles(layers.spark)
        pipeline.load_bronze(layers.spark, folder, wh, tables=tables)


@query
def full_refresh_idempotent(layers: Layers) -> DataFrame:
    """Larger extracts of all six tables loaded, then the real ones: every table holds the real rows alone."""
    wh = scratch_path(layers.spark, "warehouse")

    def larger(name: str) -> DataFrame:
        rows = layers.bronze(name)
        text = next(f.name for f in rows.schema.fields if f.dataType.simpleString() == "string")
        return rows.withColumn(text, F.explode(F.array(F.col(text), F.concat(text, F.lit("-old")))))

    for rows in (larger, layers.bronze):
        _load_extracts(layers, rows, wh, tuple(csv_ingest.SOURCES))

    def as_text(name: str) -> DataFrame:
        table = pipeline.read_layer(layers.spark, wh, "bronze", name)
        cells = [F.coalesce(F.col(x).cast("string"), F.lit(csv_ingest.NULL_TOKEN)) for x in csv_ingest.SOURCES[name][1]]
        return table.select(F.lit(name).alias("table_name"), F.concat_ws("|", *cells).alias("row_text"))

    return reduce(DataFrame.unionByName, [as_text(n) for n in csv_ingest.SOURCES])


def _load_to_silver(layers: Layers, *names: str) -> str:
    """CSV extracts -> bronze -> silver (by default all six) in a fresh warehouse folder; returns the folder."""
    wh = scratch_path(layers.spark, "warehouse")
    tables = names or tuple(csv_ingest.SOURCES)
    _load_extracts(layers, layers.bronze, wh, tables)
    pipeline.load_silver(layers.spark, wh, layers.as_of, tables=tables)
    return wh


@query
def silver_write_read_back(layers: Layers) -> DataFrame:
    """Product history after CSV -> bronze -> silver, read back from the written table."""
    wh = _load_to_silver(layers, "crm_prd_info")
    return pipeline.read_layer(layers.spark, wh, "silver", "crm_prd_info").drop("dwh_create_date")


@query
def silver_audit_column(layers: Layers) -> DataFrame:
    """Silver customers as written; whether each is stamped, and with a time within the load."""
    def now() -> Column:
        at = layers.spark.range(1).select(F.localtimestamp().cast("string")).first()[0]
        return F.lit(at).cast("timestamp_ntz")

    start = now()
    wh = _load_to_silver(layers, "crm_cust_info")
    stamp = F.col("dwh_create_date")
    return pipeline.read_layer(layers.spark, wh, "silver", "crm_cust_info").select(
        *silver.SILVER_COLUMNS["crm_cust_info"], stamp.isNotNull().alias("stamped"),
        F.coalesce(stamp.between(start, now()), F.lit(False)).alias("stamped_within_load"))


@query
def gold_read_by_name(layers: Layers) -> DataFrame:
    """Sales per country and category from the written star, its tables read by name in SQL."""
    wh = _load_to_silver(layers)
    pipeline.build_gold(layers.spark, wh)
    pipeline.register_views(layers.spark, wh, prefix="strata_")
    return layers.spark.sql("""
        SELECT c.country, p.category_name, count(*) AS n_rows, CAST(sum(f.sales) AS DECIMAL(38,2)) AS sales
        FROM strata_gold.fact_sales AS f
        JOIN strata_gold.dim_customers AS c ON c.customer_key = f.customer_key
        JOIN strata_gold.dim_products AS p ON p.product_key = f.product_key
        GROUP BY c.country, p.category_name""")


@query
def layer_reconciliation(layers: Layers) -> DataFrame:
    """Bronze to silver to gold of a whole load: rows in, dropped or added with the reason, and out, table by table."""
    wh = _load_to_silver(layers)
    pipeline.build_gold(layers.spark, wh)
    return pipeline.reconcile(layers.spark, wh)


@query
def rejected_sales(layers: Layers) -> DataFrame:
    """The sales that the written star rejects, each with its reason."""
    wh = _load_to_silver(layers)
    pipeline.build_gold(layers.spark, wh)
    return pipeline.read_layer(layers.spark, wh, "gold", "rejected_sales")


@query
def fact_sales_point_in_time(layers: Layers) -> DataFrame:
    """Every sale once, with the product version valid on its order date."""
    return gold.fact_sales_point_in_time(layers.silver("crm_sales_details"), layers.silver("crm_prd_info"))


def _monthly(layers: Layers) -> DataFrame:
    """Monthly sales with ERP locations loaded repeatedly and categories listed twice, as delivered."""
    fact = gold.fact_sales_point_in_time(layers.silver("crm_sales_details"), layers.silver("crm_prd_info"))
    people = gold.dim_customers_unkeyed(layers.silver("crm_cust_info"), layers.silver("erp_cust_az12"),
                                        layers.silver("erp_loc_loads").drop("load_seq"))
    return trends.monthly_sales(fact, people, layers.silver("erp_px_cat_g1v2"))


@query
def gold_sales_by_month(layers: Layers) -> DataFrame:
    """Sales per month, country and category with running totals; repeated customers and categories do not multiply them."""
    return trends.running_totals(_monthly(layers))


@query
def gold_sales_rollup(layers: Layers) -> DataFrame:
    """Totals by month, country and category at all eight levels (GROUPING SETS)."""
    return trends.sales_rollup(_monthly(layers))


@query
def gold_sales_trend(layers: Layers) -> DataFrame:
    """Monthly sales without holes, moving average of three months and the year before."""
    return trends.sales_trend(_monthly(layers))


@query
def gold_distinct_customers(layers: Layers) -> DataFrame:
    """Different customers by month, quarter, year and in all, from bitmaps of the dense customer key."""
    return trends.distinct_customers(layers.silver("crm_sales_details"), layers.dim_customers())


@query
def scd2_merge_extracts(layers: Layers) -> DataFrame:
    """Product history after two extracts, the second merged twice (a replay changes nothing)."""
    first, second = (fixtures.product_extract(layers.spark, layers.sf_dir, n) for n in (0, 1))
    merged = history.merge_extract(history.start_history(first, "2024-01-01"), second, ["prd_key"], "2024-06-01")
    return history.merge_extract(merged, second, ["prd_key"], "2024-06-01")


@query
def dq_history_intervals(layers: Layers) -> DataFrame:
    """Product versions that overlap earlier ones or leave days uncovered."""
    return history.interval_faults(fixtures.product_intervals(layers.spark, layers.sf_dir), "prd_key")


@query
def gold_dim_customers_collated(layers: Layers) -> DataFrame:
    """The customer dimension with keys compared as the source model does (case and trailing spaces ignored)."""
    return gold.dim_customers(layers.silver("crm_cust_info"), layers.silver("erp_cust_az12"), layers.silver("erp_loc_a101"),
                              collation=gold.SOURCE_COLLATION)


@query
def dq_distinct_gndr_collated(layers: Layers) -> DataFrame:
    """CRM gender codes that differ under the source model's collation."""
    return quality.distinct_values(layers.bronze("crm_cust_info"), "cst_gndr", gold.SOURCE_COLLATION)


@query
def dq_distinct_country_collated(layers: Layers) -> DataFrame:
    """Country texts that differ under the source model's collation."""
    return quality.distinct_values(layers.bronze("erp_loc_a101"), "cntry", gold.SOURCE_COLLATION)

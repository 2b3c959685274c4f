"""Silver layer: one pure function per table, bronze DataFrame -> silver DataFrame.

Only ``crm_cust_info`` (dedup per customer id) and ``crm_prd_info`` (history end
dates per product key) move data between tasks; the other four are narrow
projections that stay in one whole-stage-codegen stage after the scan.
The audit column ``dwh_create_date`` is added by the writer (``pipeline``), so
these functions stay deterministic.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from strata.functions import cleaning as c
from strata.operators.dedup import dedup_latest
from strata.operators.ordered import scd2_end_date

# Silver column order of every table.
SILVER_COLUMNS = {
    "crm_cust_info": ["cst_id", "cst_key", "cst_firstname", "cst_lastname", "cst_marital_status", "cst_gndr",
                      "cst_create_date"],
    "crm_prd_info": ["prd_id", "cat_id", "prd_key", "prd_nm", "prd_cost", "prd_line", "prd_start_dt", "prd_end_dt"],
    "crm_sales_details": ["sls_ord_num", "sls_prd_key", "sls_cust_id", "sls_order_dt", "sls_ship_dt", "sls_due_dt",
                          "sls_sales", "sls_quantity", "sls_price"],
    "erp_loc_a101": ["cid", "cntry"],
    "erp_cust_az12": ["cid", "bdate", "gen"],
    "erp_px_cat_g1v2": ["id", "cat", "subcat", "maintenance"],
}


def latest_customers(bronze: DataFrame) -> DataFrame:
    """Newest row per ``cst_id`` by ``cst_create_date`` (NULL ids are one group)."""
    return dedup_latest(bronze, ["cst_id"], ["cst_create_date"], descending=True, tie_breaker=["cst_key"])


def crm_cust_info(bronze: DataFrame) -> DataFrame:
    t = latest_customers(bronze)
    return t.select(
        "cst_id", "cst_key",
        F.trim("cst_firstname").alias("cst_firstname"),
        F.trim("cst_lastname").alias("cst_lastname"),
        c.map_codes("cst_marital_status", c.MARITAL_STATUS, c.NOT_SPECIFIED).alias("cst_marital_status"),
        c.map_codes("cst_gndr", c.CRM_GENDER, c.NOT_SPECIFIED).alias("cst_gndr"),
        "cst_create_date",
    )


def with_history_end(bronze: DataFrame, out: str = "_end_dt") -> DataFrame:
    """History end date per raw (composite) product key, computed before the key is split."""
    tb = [x for x in bronze.columns if x not in ("prd_key", "prd_start_dt")]
    return scd2_end_date(bronze, "prd_key", "prd_start_dt", out, tie_breaker=["prd_id", *tb])


def crm_prd_info(bronze: DataFrame) -> DataFrame:
    t = with_history_end(bronze)
    cat_id, prd_key = c.split_product_key("prd_key")
    return t.select(
        "prd_id",
        cat_id.alias("cat_id"),
        prd_key.alias("prd_key"),
        "prd_nm",
        F.coalesce(F.col("prd_cost"), F.lit(0)).cast("decimal(10,2)").alias("prd_cost"),
        c.map_codes("prd_line", c.PRODUCT_LINE, c.NA).alias("prd_line"),
        F.col("prd_start_dt").cast("date").alias("prd_start_dt"),
        F.col("_end_dt").alias("prd_end_dt"),
    )


def crm_sales_details(bronze: DataFrame) -> DataFrame:
    return bronze.select(
        "sls_ord_num", "sls_prd_key", "sls_cust_id",
        c.int_yyyymmdd_to_date("sls_order_dt").alias("sls_order_dt"),
        c.int_yyyymmdd_to_date("sls_ship_dt").alias("sls_ship_dt"),
        c.int_yyyymmdd_to_date("sls_due_dt").alias("sls_due_dt"),
        c.repair_sales("sls_sales", "sls_quantity", "sls_price").alias("sls_sales"),
        "sls_quantity",
        c.repair_price("sls_sales", "sls_quantity", "sls_price").alias("sls_price"),
    )


def location_columns() -> list:
    """Cleaned ``cid`` (dashes removed) and standardised ``cntry``."""
    return [c.strip_chars("cid", "-").alias("cid"), c.standardise_country("cntry").alias("cntry")]


def erp_loc_a101(bronze: DataFrame) -> DataFrame:
    return bronze.select(*location_columns())


def erp_cust_az12(bronze: DataFrame, as_of: str | None = None) -> DataFrame:
    """``as_of`` (ISO date) replaces NOW() in the future-birthdate rule; default today."""
    return bronze.select(
        c.strip_prefix("cid", "NAS").alias("cid"),
        c.null_if_future("bdate", as_of).alias("bdate"),
        c.map_codes("gen", c.ERP_GENDER, c.NA).alias("gen"),
    )


def erp_px_cat_g1v2(bronze: DataFrame) -> DataFrame:
    return bronze.select("id", "cat", "subcat", "maintenance")

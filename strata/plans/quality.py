"""Data-quality rules over the raw (bronze) and modelled (gold) data.

A rule returns the offending rows, with the columns the audit shows; an empty
result means the rule holds.  Row-level rules are also declared as predicates
(``row_rules``) so ``summary`` can count all rules of a table in one pass with
``count_if`` instead of one scan per rule.

Group rules (duplicates, distinct values, distributions) are hash aggregates
with map-side partial aggregation, so a hot value is combined before the
shuffle.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from strata.functions.cleaning import NA, prefer
from strata.operators.dedup import keep_last_loaded
from strata.operators.joins import orphans
from strata.plans.gold import collated, customers_joined
from strata.plans.layers import Layers

# Output column names and labels of the source model's audits.
DUPLICATE_COUNT = "total_duplicados"
EXPECTED_SALES = "calculo_teorico"
SALES_DIFFERENCE = "diferencia"
GENDER_TOTAL = "total"
PROBLEM = "problema"
AFFECTED_ROWS = "total_filas_afectadas"
MISSING_PRODUCTS = "Productos Faltantes"
MISSING_CUSTOMERS = "Clientes Faltantes"

#: Column with the number of rows that one row stands for.
COPIES = "_copies"


def duplicates(df: DataFrame, key: str, count_name: str = "row_count") -> DataFrame:
    """``GROUP BY key HAVING COUNT(*) > 1``."""
    return df.groupBy(key).agg(F.count(F.lit(1)).alias(count_name)).where(F.col(count_name) > 1)


def distribution(df: DataFrame, key: str, count_name: str = "row_count") -> DataFrame:
    return df.groupBy(key).agg(F.count(F.lit(1)).alias(count_name))


def distinct_values(df: DataFrame, column: str, collation: str | None = None, count_name: str = "row_count") -> DataFrame:
    """The values of a column that differ under ``collation``, each by its least spelling, with their rows."""
    group = collated(F.col(column), collation).alias("_group")
    return df.groupBy(group).agg(F.min(column).alias(column), F.count(F.lit(1)).alias(count_name)).drop("_group")


def expected_sales(qty: Column, price: Column) -> Column:
    return qty.cast("bigint") * price


# ------------------------------------------------------------------ predicates
def _untrimmed(c: str) -> Column:
    return F.length(F.col(c)) != F.length(F.trim(F.col(c)))


def _sales_rule() -> Column:
    s, q, p = F.col("sls_sales"), F.col("sls_quantity"), F.col("sls_price")
    return (s != expected_sales(q, p)) | s.isNull() | q.isNull() | p.isNull()


def _nonpositive(*cols: str) -> Column:
    out = None
    for c in cols:
        e = F.col(c) <= 0
        out = e if out is None else out | e
    return out


def _future_bdate(as_of: str | None) -> Column:
    ref = F.current_date() if as_of is None else F.lit(as_of).cast("date")
    return F.col("bdate") > ref


def row_rules(as_of: str | None) -> list[tuple[str, str, Column]]:
    """(rule, layer.table, predicate) for every row-level rule; ``as_of`` replaces NOW()."""
    return [
        ("dq_untrimmed_firstname", "bronze.crm_cust_info", _untrimmed("cst_firstname")),
        ("dq_prd_key_dash", "bronze.crm_prd_info", F.col("prd_key").contains("-")),
        ("dq_prd_cost_missing", "bronze.crm_prd_info", F.col("prd_cost").isNull() | (F.col("prd_cost") == 0)),
        ("dq_prd_date_order", "bronze.crm_prd_info", F.col("prd_end_dt") < F.col("prd_start_dt")),
        ("dq_sales_rule", "bronze.crm_sales_details", _sales_rule()),
        ("dq_sales_nonpositive", "bronze.crm_sales_details", _nonpositive("sls_sales", "sls_quantity", "sls_price")),
        ("dq_sales_order_after_ship", "bronze.crm_sales_details", F.col("sls_order_dt") > F.col("sls_ship_dt")),
        ("dq_order_date_length", "bronze.crm_sales_details", F.length(F.col("sls_order_dt").cast("string")) != 8),
        ("dq_loc_cid_dash", "bronze.erp_loc_a101", F.col("cid").contains("-")),
        ("dq_erp_cust_nas_prefix", "bronze.erp_cust_az12", F.col("cid").startswith("NAS")),
        ("dq_future_bdate", "bronze.erp_cust_az12", _future_bdate(as_of)),
        ("dq_category_nulls", "bronze.erp_px_cat_g1v2", F.col("id").isNull() | F.col("cat").isNull()),
        ("dq_fact_date_order", "gold.fact_sales", F.col("shipping_date") < F.col("order_date")),
        ("dq_fact_nonpositive", "gold.fact_sales", _nonpositive("sales", "sls_quantity", "price")),
    ]


def table_of(layers: Layers, qualified: str) -> DataFrame:
    layer, name = qualified.split(".")
    if layer == "bronze":
        return layers.bronze(name)
    if name == "fact_sales":
        return layers.fact_sales()
    raise KeyError(qualified)


def violations(layers: Layers, rule: str) -> DataFrame:
    """Offending rows of a row-level rule, with the table's columns."""
    for name, table, pred in row_rules(layers.as_of):
        if name == rule:
            return table_of(layers, table).where(pred)
    raise KeyError(rule)


def summarise(tables: Mapping[str, DataFrame], as_of: str | None = None) -> DataFrame:
    """(rule, table_name, violations) for every row-level rule of the given tables.

    ``tables`` maps ``layer.table`` names (as in ``row_rules``) to DataFrames;
    all rules of one table are counted in a single pass with ``count_if``.  A
    row of a table with a column ``COPIES`` stands for that many rows.
    """
    def violated(df: DataFrame, pred: Column) -> Column:
        if COPIES not in df.columns:
            return F.count_if(pred)
        return F.coalesce(F.sum(F.when(pred, F.col(COPIES))), F.lit(0)).cast("bigint")

    per_table: dict[str, list[tuple[str, Column]]] = {}
    for name, table, pred in row_rules(as_of):
        if table in tables:
            per_table.setdefault(table, []).append((name, pred))
    parts = []
    for table, rules in per_table.items():
        counts = tables[table].agg(*[violated(tables[table], pred).alias(name) for name, pred in rules])
        stacked = counts.select(F.explode(F.array(*[
            F.struct(F.lit(name).alias("rule"), F.lit(table).alias("table_name"), F.col(name).alias("violations"))
            for name, _ in rules])).alias("r")).select("r.*")
        parts.append(stacked)
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def summary(layers: Layers) -> DataFrame:
    """``summarise`` over the tables of one build (the fact rules read no surrogate keys and build no fan-out)."""
    names = dict.fromkeys(table for _, table, _ in row_rules(layers.as_of))
    tables = {t: layers.fact_sales_counted(COPIES) if t == "gold.fact_sales" else table_of(layers, t) for t in names}
    return summarise(tables, layers.as_of)


# ------------------------------------------------------------------ bronze audits
def dq_dup_cst_id(layers: Layers) -> DataFrame:
    return duplicates(layers.bronze("crm_cust_info"), "cst_id", DUPLICATE_COUNT)


def dq_untrimmed_firstname(layers: Layers) -> DataFrame:
    return violations(layers, "dq_untrimmed_firstname").select("cst_firstname")


def dq_distinct_gndr(layers: Layers) -> DataFrame:
    return layers.bronze("crm_cust_info").select("cst_gndr").distinct()


def dq_distinct_marital(layers: Layers) -> DataFrame:
    return layers.bronze("crm_cust_info").select("cst_marital_status").distinct()


def dq_dup_prd_id(layers: Layers) -> DataFrame:
    return duplicates(layers.bronze("crm_prd_info"), "prd_id")


def dq_prd_key_dash(layers: Layers) -> DataFrame:
    return violations(layers, "dq_prd_key_dash").select("prd_key")


def dq_prd_cost_missing(layers: Layers) -> DataFrame:
    return violations(layers, "dq_prd_cost_missing")


def dq_prd_date_order(layers: Layers) -> DataFrame:
    return violations(layers, "dq_prd_date_order")


def dq_sales_rule(layers: Layers) -> DataFrame:
    q, p, s = F.col("sls_quantity"), F.col("sls_price"), F.col("sls_sales")
    return violations(layers, "dq_sales_rule").select(
        "sls_ord_num", "sls_sales", "sls_quantity", "sls_price",
        expected_sales(q, p).alias(EXPECTED_SALES),
        (s.cast("bigint") - expected_sales(q, p)).alias(SALES_DIFFERENCE))


def dq_sales_nonpositive(layers: Layers) -> DataFrame:
    return violations(layers, "dq_sales_nonpositive")


def dq_sales_order_after_ship(layers: Layers) -> DataFrame:
    return violations(layers, "dq_sales_order_after_ship")


def dq_order_date_length(layers: Layers) -> DataFrame:
    return violations(layers, "dq_order_date_length")


def dq_loc_cid_dash(layers: Layers) -> DataFrame:
    return violations(layers, "dq_loc_cid_dash").select("cid")


def dq_distinct_country(layers: Layers) -> DataFrame:
    return layers.bronze("erp_loc_a101").select("cntry").distinct().orderBy(F.col("cntry").asc_nulls_first())


def dq_erp_cust_nas_prefix(layers: Layers) -> DataFrame:
    return violations(layers, "dq_erp_cust_nas_prefix").select("cid")


def dq_future_bdate(layers: Layers) -> DataFrame:
    return violations(layers, "dq_future_bdate").select("bdate")


def dq_distinct_gen(layers: Layers) -> DataFrame:
    return layers.bronze("erp_cust_az12").select("gen").distinct()


def dq_category_nulls(layers: Layers) -> DataFrame:
    return violations(layers, "dq_category_nulls")


def dq_distinct_category(layers: Layers) -> DataFrame:
    return layers.bronze("erp_px_cat_g1v2").select("cat", "subcat").distinct()


# ------------------------------------------------------------------ gold audits
def dq_dup_customer_key(layers: Layers) -> DataFrame:
    return duplicates(layers.dim_customers(), "customer_key")


def dq_dup_customer_number(layers: Layers) -> DataFrame:
    return duplicates(layers.dim_customers_base(), "customer_number")


def dq_gender_distribution(layers: Layers) -> DataFrame:
    return distribution(layers.dim_customers_base(), "gender", GENDER_TOTAL)


def dq_dup_product_key(layers: Layers) -> DataFrame:
    return duplicates(layers.dim_products(), "product_key")


def dq_dup_product_number(layers: Layers) -> DataFrame:
    return duplicates(layers.dim_products_base(), "product_number")


def dq_category_distribution(layers: Layers) -> DataFrame:
    return distribution(layers.dim_products_base(), "category_name")


def _orphan_count(label: str, orphan_rows: DataFrame) -> DataFrame:
    return orphan_rows.agg(F.count(F.lit(1)).alias(AFFECTED_ROWS)) \
        .select(F.lit(label).alias(PROBLEM), AFFECTED_ROWS)


def dq_fact_orphan_products(layers: Layers) -> DataFrame:
    f, p = layers.fact_sales(), layers.dim_products()
    return _orphan_count(MISSING_PRODUCTS, orphans(f, p, [("product_key", "product_key")]))


def dq_fact_orphan_customers(layers: Layers) -> DataFrame:
    f, c = layers.fact_sales(), layers.dim_customers()
    return _orphan_count(MISSING_CUSTOMERS, orphans(f, c, [("customer_key", "customer_key")]))


def dq_sales_orphans_silver(layers: Layers) -> DataFrame:
    """Orphans counted before the inner joins drop them (the audits above cannot see any).

    The dimensions keep every silver product and customer, so the silver keys
    decide; one pass over sales counts both kinds.
    """
    s = layers.silver("crm_sales_details").select("sls_prd_key", "sls_cust_id")
    p = layers.silver("crm_prd_info").select(F.col("prd_key").alias("p_key")).where("prd_key is not null").distinct()
    c = layers.silver("crm_cust_info").select(F.col("cst_id").alias("c_id")).where("cst_id is not null").distinct()
    counts = s.join(p, s["sls_prd_key"] == p["p_key"], "left").join(c, s["sls_cust_id"] == c["c_id"], "left").agg(
        F.count_if(F.col("p_key").isNull()).alias("p"), F.count_if(F.col("c_id").isNull()).alias("c"))
    return counts.select(F.explode(F.array(
        F.struct(F.lit(MISSING_PRODUCTS).alias(PROBLEM), F.col("p").alias(AFFECTED_ROWS)),
        F.struct(F.lit(MISSING_CUSTOMERS).alias(PROBLEM), F.col("c").alias(AFFECTED_ROWS)))).alias("r")).select("r.*")


def dq_fact_date_order(layers: Layers) -> DataFrame:
    return violations(layers, "dq_fact_date_order")


def dq_fact_nonpositive(layers: Layers) -> DataFrame:
    return violations(layers, "dq_fact_nonpositive")


def dq_customer_fanout(layers: Layers) -> DataFrame:
    """``cst_id`` repeated after both left joins when ERP locations were loaded twice."""
    j = customers_joined(layers.silver("crm_cust_info"), layers.silver("erp_cust_az12"),
                         layers.silver("erp_loc_loads").drop("load_seq"))
    return duplicates(j.select(F.col("crm.cst_id").alias("cst_id")), "cst_id")


def dq_gender_country_matrix(layers: Layers) -> DataFrame:
    j = customers_joined(layers.silver("crm_cust_info"), layers.silver("erp_cust_az12"), layers.silver("erp_loc_a101"))
    return j.select(F.col("crm.cst_gndr").alias("cst_gndr"), F.col("person.gen").alias("gen"),
                    F.col("place.cntry").alias("cntry")).distinct() \
        .orderBy(F.col("cst_gndr").asc_nulls_first(), F.col("gen").asc_nulls_first())


def gender_matrix(layers: Layers, unknown: str = NA) -> DataFrame:
    j = customers_joined(layers.silver("crm_cust_info"), layers.silver("erp_cust_az12"), layers.silver("erp_loc_a101"))
    return j.select(F.col("crm.cst_gndr").alias("cst_gndr"), F.col("person.gen").alias("gen"),
                    prefer(F.col("crm.cst_gndr"), F.col("person.gen"), unknown).alias("new_gen")).distinct() \
        .orderBy(F.col("cst_gndr").asc_nulls_first(), F.col("gen").asc_nulls_first())


def dq_gender_matrix(layers: Layers) -> DataFrame:
    return gender_matrix(layers, NA)


def dq_current_product_fanout(layers: Layers) -> DataFrame:
    """Open product versions whose key repeats after the category join."""
    pn = layers.silver("crm_prd_info").where(F.col("prd_end_dt").isNull())
    pc = layers.silver("erp_px_cat_g1v2")
    j = pn.join(pc, pn["cat_id"] == pc["id"], "left")
    return duplicates(j.select(pn["prd_key"]), "prd_key")


def dq_fact_integrity_inner(layers: Layers) -> DataFrame:
    """Fact rows joined to both dimensions by surrogate key whose product key is NULL (none can be)."""
    f = layers.fact_sales().alias("f")
    c = layers.dim_customers().select("customer_key", "customer_id").alias("c")
    p = layers.dim_products().select("product_key", "product_id").alias("p")
    j = f.join(c, F.col("c.customer_key") == F.col("f.customer_key"), "inner") \
        .join(p, F.col("p.product_key") == F.col("f.product_key"), "inner")
    return j.where(F.col("p.product_key").isNull()).select("f.*", "c.customer_id", "p.product_id")


def dedup_keep_last_loaded(layers: Layers) -> DataFrame:
    """Keep the last-loaded ERP location per customer id."""
    return keep_last_loaded(layers.silver("erp_loc_loads"), "cid", "load_seq")



# Every audit above, by name (each returns the offending rows).
AUDITS = [
    "dq_dup_cst_id", "dq_untrimmed_firstname", "dq_distinct_gndr", "dq_distinct_marital", "dq_dup_prd_id",
    "dq_prd_key_dash", "dq_prd_cost_missing", "dq_prd_date_order", "dq_sales_rule", "dq_sales_nonpositive",
    "dq_sales_order_after_ship", "dq_loc_cid_dash", "dq_distinct_country", "dq_erp_cust_nas_prefix",
    "dq_future_bdate", "dq_distinct_gen", "dq_category_nulls", "dq_distinct_category", "dq_order_date_length",
    "dq_dup_customer_key", "dq_dup_customer_number", "dq_gender_distribution", "dq_dup_product_key",
    "dq_dup_product_number", "dq_category_distribution", "dq_fact_orphan_products", "dq_fact_orphan_customers",
    "dq_fact_date_order", "dq_fact_nonpositive", "dq_customer_fanout", "dq_gender_country_matrix",
    "dq_gender_matrix", "dq_current_product_fanout", "dq_fact_integrity_inner", "dq_sales_orphans_silver",
]

# Audits whose one value is already a count, and audits that only inform.
COUNT_AUDITS = {"dq_fact_orphan_products", "dq_fact_orphan_customers", "dq_sales_orphans_silver"}
INFO_AUDITS = {"dq_distinct_gndr", "dq_distinct_marital", "dq_distinct_country", "dq_distinct_gen", "dq_distinct_category",
               "dq_gender_distribution", "dq_category_distribution", "dq_gender_country_matrix", "dq_gender_matrix"}

"""Bronze source extracts derived from the driver's TPC-H-style parquet.

The warehouse reads six CRM/ERP extracts.  No such files exist for testing, so
each extract is derived from ``customer``, ``part``, ``orders`` and ``lineitem``
by fixed rules that plant the dirty cases the cleaning steps must repair
(duplicate and NULL ids, padded text, mixed-case codes, bad dates, broken sales
amounts, legacy key prefixes).  Every extract grows with the tables it reads.

All functions are narrow projections over one scan, except
``crm_sales_details`` which joins lineitem to orders on the order key.
Every extract covers its whole source table; the ``%`` rules below only decide
which rows carry a planted defect (a duplicate, a padded name, a bad date, a
missing ERP record), never which rows are processed.
Row multiplication uses ``explode`` over a small literal array (a generator in
the same stage), never a cross join.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def _pad(c: Column) -> Column:
    """At least eight digits; longer keys stay whole."""
    text = c.cast("string")
    return F.lpad(text, F.greatest(F.lit(8), F.length(text)), F.lit("0"))


def _ymd(c: Column) -> Column:
    return (F.year(c) * 10000 + F.month(c) * 100 + F.dayofmonth(c)).cast("int")


def _pick(selector: Column, values: list) -> Column:
    """``values[selector]`` as a CASE; ``None`` entries give NULL."""
    expr = None
    for i, v in enumerate(values):
        lit = F.lit(v).cast("string") if v is not None else F.lit(None).cast("string")
        expr = F.when(selector == i, lit) if expr is None else expr.when(selector == i, lit)
    return expr


def crm_cust_info(spark: SparkSession, sf_dir: str) -> DataFrame:
    c = read_table(spark, sf_dir, "customer").select("c_custkey", "c_name", "c_mktsegment")
    k = F.col("c_custkey")
    # every customer once; a tenth of them a second time with a later date
    again = (k % 10 == 3) & (k % 97 != 0)
    c = c.withColumn("v", F.explode(F.when(again, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0)))))
    return c.select(
        F.when(k % 97 == 0, F.lit(None)).otherwise(F.lit(11000) + k).cast("bigint").alias("cst_id"),
        # one customer in 89 carries its predecessor's key
        F.concat(F.lit("AW"), _pad(F.when(k % 89 == 88, k - 1).otherwise(k))).alias("cst_key"),
        F.when(k % 5 == 0, F.concat(F.lit("  "), F.col("c_mktsegment"), F.lit(" ")))
        .otherwise(F.col("c_mktsegment")).alias("cst_firstname"),
        F.when(k % 7 == 0, F.concat(F.col("c_name"), F.lit("  "))).otherwise(F.col("c_name")).alias("cst_lastname"),
        _pick(k % 4, ["S", " m ", "M", None]).alias("cst_marital_status"),
        _pick(k % 5, ["F", "m ", "M", "", None]).alias("cst_gndr"),
        # one customer in 83 has no first date
        F.when((k % 83 != 1) | (F.col("v") == 1), F.date_add(
            F.lit("2020-01-01").cast("date"), ((k * 7) % 3000 + F.col("v") * 3000).cast("int"))).alias("cst_create_date"),
    )


def crm_prd_info(spark: SparkSession, sf_dir: str) -> DataFrame:
    p = read_table(spark, sf_dir, "part").select("p_partkey", "p_name", "p_retailprice", "p_brand", "p_type")
    k = F.col("p_partkey")
    # one to three history versions per part
    p = p.withColumn("v", F.explode(F.sequence(F.lit(0), (k % 3).cast("int"))))
    v = F.col("v")
    start = F.date_add(F.lit("1993-01-01").cast("date"), (k % 300 + v * 1000).cast("int"))
    key = F.concat(F.replace(_category_id(), F.lit("_"), F.lit("-")), F.lit("-P"), _pad(k))
    return p.select(
        F.when(k % 101 == 100, k * 10).otherwise(k * 10 + v).cast("bigint").alias("prd_id"),
        F.when(k % 29 == 28, F.translate(key, "-", "_")).otherwise(key).alias("prd_key"),
        F.col("p_name").alias("prd_nm"),
        F.when(k % 13 == 0, F.lit(None)).otherwise(F.floor("p_retailprice") + v).cast("int").alias("prd_cost"),
        _pick(k % 6, ["M", "R ", "S", "t", None, "X"]).alias("prd_line"),
        start.cast("timestamp_ntz").alias("prd_start_dt"),
        F.date_add(start, F.when(k % 31 == 30, 60).otherwise(-30)).cast("timestamp_ntz").alias("prd_end_dt"),
    )


def crm_sales_details(spark: SparkSession, sf_dir: str) -> DataFrame:
    # days, the supplier's rule and the unit price are taken before the join, so narrow rows cross its exchange
    # (small whole numbers compress, prices with cents do not)
    li = read_table(spark, sf_dir, "lineitem").select(
        "l_orderkey", "l_partkey", (F.col("l_suppkey") % 11).cast("int").alias("rule"), "l_linenumber", "l_quantity",
        F.floor(F.try_divide("l_extendedprice", "l_quantity")).alias("unit"), _ymd(F.col("l_shipdate")).alias("shipped"))
    o = read_table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", _ymd(F.col("o_orderdate")).alias("ordered"))
    j = li.join(o, li.l_orderkey == o.o_orderkey, "inner")
    ok, rule, ln = F.col("l_orderkey"), F.col("rule"), F.col("l_linenumber")
    qty, unit = F.col("l_quantity"), F.col("unit")
    return j.select(
        F.concat(F.lit("SO"), ok.cast("string"), F.lit("-"), ln.cast("string")).alias("sls_ord_num"),
        F.concat(F.when(F.col("l_partkey") % 50 == 49, F.lit("ZZ")).otherwise(F.lit("P")),
                 _pad(F.col("l_partkey"))).alias("sls_prd_key"),
        (F.lit(11000) + F.col("o_custkey")).cast("bigint").alias("sls_cust_id"),
        F.when(ok % 61 == 0, F.lit(0)).otherwise(F.col("ordered")).cast("int").alias("sls_order_dt"),
        F.col("shipped").alias("sls_ship_dt"),
        F.when(ok % 67 == 0, F.lit(5489)).otherwise(F.col("shipped")).cast("int").alias("sls_due_dt"),
        F.when(rule == 0, F.lit(None))
        .when(rule == 1, -qty * 10)
        .when(rule == 2, 1 + qty * unit)
        .otherwise(qty * unit).cast("int").alias("sls_sales"),
        F.when((rule == 7) & (ln == 1), F.lit(0)).otherwise(qty).cast("int").alias("sls_quantity"),
        F.when(ln == 3, F.lit(None)).when(ln == 4, -unit).otherwise(unit).cast("int").alias("sls_price"),
    )


def _location_id(k: Column) -> Column:
    """Dashed ERP id; one in 37 comes without the dash."""
    return F.concat(F.when(k % 37 == 36, F.lit("AW")).otherwise(F.lit("AW-")), _pad(k))


def erp_loc_a101(spark: SparkSession, sf_dir: str) -> DataFrame:
    c = read_table(spark, sf_dir, "customer").select("c_custkey")
    k = F.col("c_custkey")
    return c.select(
        _location_id(k).alias("cid"),
        _pick(k % 7, ["DE", " US ", "USA", "", None, " Australia", "de"]).alias("cntry"),
    )


def erp_loc_loads(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``erp_loc_a101`` with a load sequence; every 31st customer is loaded twice."""
    c = read_table(spark, sf_dir, "customer").select("c_custkey")
    k = F.col("c_custkey")
    c = c.withColumn("v", F.explode(F.when(k % 31 == 0, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0)))))
    first = F.col("v") == 0
    return c.select(
        _location_id(k).alias("cid"),
        F.when(first, _pick(k % 7, ["DE", " US ", "USA", "", None, " Australia", "de"]))
        .otherwise(F.lit("USA")).alias("cntry"),
        F.when(first, k).otherwise(F.lit(1000000) + k).cast("bigint").alias("load_seq"),
    )


def erp_cust_az12(spark: SparkSession, sf_dir: str) -> DataFrame:
    # every ninth customer is known to the ERP system by an id that no CRM key matches; some ids are in
    # lower case or end in spaces, which only the source model's collation takes as equal
    c = read_table(spark, sf_dir, "customer").select("c_custkey")
    k = F.col("c_custkey")
    days = F.when(k % 40 == 0, F.lit(54000)).otherwise((k * 13) % 18000).cast("int")
    return c.select(
        F.concat(F.when(k % 2 == 0, F.lit("NAS")).otherwise(F.lit("")),
                 F.when(k % 9 == 8, F.lit("XW")).when(k % 41 == 40, F.lit("aw")).otherwise(F.lit("AW")), _pad(k),
                 F.when(k % 43 == 42, F.lit("  ")).otherwise(F.lit(""))).alias("cid"),
        F.when(k % 23 != 5, F.date_add(F.lit("1950-01-01").cast("date"), days)).alias("bdate"),
        _pick(k % 6, ["F", " m", "Male", "M", "", None]).alias("gen"),
    )


def _brand_number() -> Column:
    return F.regexp_extract("p_brand", r"(\d+)$", 1).cast("int")


def _category_id() -> Column:
    """Five characters: two of the part type, two digits of the brand (``EC_07``)."""
    return F.concat(F.upper(F.substring("p_type", 1, 2)), F.lit("_"), F.lpad(_brand_number().cast("string"), 2, "0"))


def erp_px_cat_g1v2(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Category master: one row for each type and brand of the parts.

    Brands 7, 14, 21 are missing on purpose, brand 5 has no id, brand 10 no
    category, and brands 11 and 22 are listed twice.
    """
    p = read_table(spark, sf_dir, "part").select("p_brand", "p_type", "p_size")
    kinds = p.groupBy("p_brand", "p_type").agg(F.max("p_size").alias("size"))
    n = _brand_number()
    again = F.when(n % 11 == 0, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0)))
    return kinds.where(n % 7 != 0).withColumn("v", F.explode(again)).select(
        F.when(n != 5, _category_id()).alias("id"),
        F.when(n != 10, F.initcap("p_type")).alias("cat"),
        F.concat_ws(" ", F.initcap("p_type"), "p_brand").alias("subcat"),
        F.when((F.col("size") >= 40) & (F.col("v") == 0), F.lit("Yes")).otherwise(F.lit("No")).alias("maintenance"))


def product_extract(spark: SparkSession, sf_dir: str, load: int) -> DataFrame:
    """The product master as extracted at a first (0) or second (1) load: parts appear, go, change price or line."""
    p = read_table(spark, sf_dir, "part").select("p_partkey", "p_name", "p_retailprice", "p_brand")
    k, later = F.col("p_partkey"), F.lit(load)
    return p.where(k % 10 != (7 if load else 0)).select(
        F.concat(F.lit("P"), _pad(k)).alias("prd_key"), F.col("p_name").alias("prd_nm"),
        F.when(k % 13 != 5 * later, F.floor("p_retailprice") + F.when(k % 3 == 0, later).otherwise(0)).cast("int").alias("prd_cost"),
        F.when((k % 17 == 1) & (later == 0), F.lit(None)).otherwise(F.col("p_brand")).alias("prd_line"))


def product_intervals(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Three versions of every part with their days: some end late, early or never, some begin on the same day.
    A third of the parts belong to one product key."""
    k, v = F.col("p_partkey"), F.col("v")
    start = F.date_add(F.lit("1990-01-01").cast("date"), (k % 5000 + v * 400).cast("int"))
    days = F.when((k % 10 == 1) & (v == 0), 430).when((k % 10 == 2) & (v == 1), 380).otherwise(399)
    return read_table(spark, sf_dir, "part").select(k, F.explode(F.array(F.lit(0), F.lit(1), F.lit(2))).alias("v")).select(
        F.when(k % 3 == 0, F.lit("P-hot")).otherwise(F.concat(F.lit("P"), _pad(k))).alias("prd_key"),
        F.when((k % 25 == 4) & (v == 1), F.date_sub(start, 400)).otherwise(start).alias("valid_from"),
        F.when((v < 2) & ((k % 20 != 3) | (v == 1)), F.date_add(start, days)).alias("valid_to"))


def customer_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``line``: the customer extract as a source system might deliver it, each way to write a field planted
    (row ends, quotes and commas inside quotes, escapes, NULL words, empty dates and numbers, short and long rows)."""
    c = read_table(spark, sf_dir, "customer").select("c_custkey", "c_name", "c_mktsegment")
    k, name, segment = F.col("c_custkey"), F.col("c_name"), F.col("c_mktsegment")
    row = F.concat_ws(",", k.cast("string"), F.concat(F.lit("AW"), _pad(k)))

    def line(*parts) -> Column:
        return F.concat(row, *[x if isinstance(x, Column) else F.lit(x) for x in parts])

    forms = [
        line(",", name, ",", segment, ",M,F,2020-01-02"),
        line(',"first\r\n', name, '",', segment, ",M,F,2020-01-02"),
        line(',"', name, ' \\"Jr\\"","', segment, '",S,M,2021-02-03'),
        line(',"""', name, '"", x",a\\tb\\\\c,S,M,2021-02-03'),
        line(",", name, ',"NULL",NULL,\\N,2021-02-03'),
        F.concat(F.lit(",AW"), _pad(k), F.lit(","), name, F.lit(","), segment, F.lit(",M,F,")),
        line(",", name),
        line(",", name, ",", segment, ",M,F,2020-01-02,surplus,\"and, more\""),
        F.concat(F.lit("x"), row, F.lit(",5\" "), name, F.lit(",\"a \"b\" c\",M,\"\",2020-13-45")),
    ]
    pick = None
    for i, form in enumerate(forms):
        pick = F.when(k % len(forms) == i, form) if pick is None else pick.when(k % len(forms) == i, form)
    return c.select(pick.alias("line"))


BRONZE = {
    "crm_cust_info": crm_cust_info,
    "crm_prd_info": crm_prd_info,
    "crm_sales_details": crm_sales_details,
    "erp_loc_a101": erp_loc_a101,
    "erp_cust_az12": erp_cust_az12,
    "erp_px_cat_g1v2": erp_px_cat_g1v2,
}

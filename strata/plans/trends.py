"""Totals and trends over the star: several levels at once, calendars without holes, exact distinct customers.

All start from one pass over the sales that aggregates them to the finest level
(map-side partial aggregation first); what follows runs over that small table.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

_MONEY = "decimal(38,2)"


def one_per_key(df: DataFrame, key: str, value: str, new_key: str, new_value: str) -> DataFrame:
    """One row a key (the greatest value), so that a join to it never multiplies rows."""
    return df.where(F.col(key).isNotNull()).groupBy(F.col(key).alias(new_key)).agg(F.max(value).alias(new_value))


def monthly_sales(sales: DataFrame, customers: DataFrame, categories: DataFrame) -> DataFrame:
    """``(month, country, category, n_sales, sales)`` of the point-in-time fact: every sale counts once,
    however often its customer or category is listed."""
    return sales.join(one_per_key(customers, "customer_id", "country", "c_id", "country"), F.col("customer_id") == F.col("c_id"), "left") \
        .join(one_per_key(categories, "id", "cat", "k_id", "category"), F.col("category_id") == F.col("k_id"), "left") \
        .groupBy(F.trunc("order_date", "month").alias("month"), "country", "category") \
        .agg(F.count(F.lit(1)).alias("n_sales"), F.sum("sales").cast(_MONEY).alias("sales"))


def running_totals(monthly: DataFrame) -> DataFrame:
    """``monthly_sales`` with the running total of each country and category."""
    running = Window.partitionBy("country", "category").orderBy(F.col("month").asc_nulls_first())
    return monthly.withColumn("running_sales", F.sum("sales").over(running).cast(_MONEY))


def sales_rollup(monthly: DataFrame) -> DataFrame:
    """Totals by month, country and category, by each two of them, each one, and in all: ``GROUPING SETS`` over
    ``monthly_sales`` in one pass; ``level`` is ``grouping_id`` (a bit for each column summed over)."""
    m, c, k = F.col("month"), F.col("country"), F.col("category")
    sets = [[m, c, k], [m, c], [m, k], [c, k], [m], [c], [k], []]
    return monthly.groupingSets(sets, m, c, k).agg(
        F.grouping_id().cast("int").alias("level"), F.sum("n_sales").alias("n_sales"), F.sum("sales").cast(_MONEY).alias("sales"))


def sales_trend(monthly: DataFrame, window_months: int = 3) -> DataFrame:
    """Every month between the first and last sale of a country and category, those without sales as 0.

    Moving sum and average over ``window_months`` calendar months (fewer at the
    start), and the sales of the same month a year before (NULL before the
    first year is over).  The calendar of a group is a generated sequence, no join
    of all months with all groups.  Sales without a date have no month here.
    """
    dated = monthly.where(F.col("month").isNotNull())
    spine = dated.groupBy("country", "category").agg(F.min("month").alias("lo"), F.max("month").alias("hi")).select(
        F.col("country").alias("s_country"), F.col("category").alias("s_category"),
        F.explode(F.sequence("lo", "hi", F.expr("INTERVAL 1 MONTH"))).alias("s_month"))
    filled = spine.join(dated, (F.col("s_month") == F.col("month")) & F.col("s_country").eqNullSafe(F.col("country"))
                        & F.col("s_category").eqNullSafe(F.col("category")), "left").select(
        F.col("s_month").alias("month"), F.col("s_country").alias("country"), F.col("s_category").alias("category"),
        F.coalesce("n_sales", F.lit(0)).cast("bigint").alias("n_sales"), F.coalesce("sales", F.lit(0)).cast(_MONEY).alias("sales"))
    number = F.year("month") * 12 + F.month("month")
    by_month = Window.partitionBy("country", "category").orderBy(number)
    recent, year_ago = by_month.rangeBetween(1 - window_months, 0), by_month.rangeBetween(-12, -12)
    total = F.sum("sales").over(recent)
    return filled.withColumn("moving_sales", total.cast(_MONEY)).withColumn(
        "moving_average", total.cast("double") / F.count(F.lit(1)).over(recent).cast("double")).withColumn(
        "sales_year_ago", F.sum("sales").over(year_ago).cast(_MONEY))


def distinct_customers(sales: DataFrame, customers: DataFrame) -> DataFrame:
    """Exact number of different customers by month, quarter and year and in all: ``(level, period, n_customers)``.

    The dense customer key is a position in bitmaps of 32,768 bits: one bitmap a
    month and range of keys is built from the sales, quarters, years and the
    whole are unions of these, never another pass over the sales.
    """
    key = customers.select("customer_key", F.col("customer_id").alias("c_id"))
    bought = sales.where(F.col("sls_order_dt").isNotNull()).join(key, F.col("sls_cust_id") == F.col("c_id")).select(
        F.trunc("sls_order_dt", "month").alias("month"), F.bitmap_bucket_number("customer_key").alias("bucket"),
        F.bitmap_bit_position("customer_key").alias("bit"))
    months = bought.groupBy("month", "bucket").agg(F.bitmap_construct_agg("bit").alias("bits"))
    levels = F.array(*[F.struct(F.lit(name).alias("level"), period.alias("period")) for name, period in (
        ("month", F.col("month")), ("quarter", F.trunc("month", "quarter")), ("year", F.trunc("month", "year")),
        ("all", F.lit(None).cast("date")))])
    joined = months.select(F.explode(levels).alias("at"), "bucket", "bits").groupBy("at", "bucket").agg(F.bitmap_or_agg("bits").alias("bits"))
    return joined.groupBy("at").agg(F.sum(F.bitmap_count("bits")).alias("n_customers")).select("at.level", "at.period", "n_customers")

import time

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from conftest import SF_SMALL
from strata.plans import gold, pipeline, quality, versions
from strata.plans.layers import Layers
from strata.plans.registry import QUERIES
from strata.session import drop_shuffles, ensure_checkpoint_dir, scratch_path
from strata.sources import csv_ingest


def _sources(spark):
    layers = Layers(spark, SF_SMALL)
    folder = scratch_path(spark, "sources")
    for name in csv_ingest.SOURCES:
        csv_ingest.write_source_csv(layers.bronze(name), folder, name)
    return layers, folder


def test_end_to_end_pipeline_and_invariants(spark):
    layers, src = _sources(spark)
    wh = scratch_path(spark, "warehouse")
    loaded = pipeline.load_bronze(spark, src, wh).collect()
    assert all(r.failed_values == 0 for r in loaded)          # clean extracts: every value converted
    first = {r.table_name: r.rows_loaded for r in loaded}
    again = {r.table_name: r.rows_loaded for r in pipeline.load_bronze(spark, src, wh).collect()}
    assert first == again                                     # full refresh is idempotent
    assert first["bronze.crm_sales_details"] == layers.bronze("crm_sales_details").count()

    silver_report = {r.table_name: r.rows_loaded for r in pipeline.load_silver(spark, wh, "2026-01-01").collect()}
    assert silver_report["silver.crm_cust_info"] == layers.silver("crm_cust_info").count()
    cust = pipeline.read_layer(spark, wh, "silver", "crm_cust_info")
    assert cust.where(F.col("dwh_create_date").isNull()).count() == 0

    gold_report = {r.table_name: r.rows_loaded for r in pipeline.build_gold(spark, wh).collect()}
    assert gold_report["gold.fact_sales"] == layers.fact_sales().count()

    # the audit over the written warehouse equals the audit over the in-memory build
    written = {(r.rule, r.table_name): r.violations for r in pipeline.audit(spark, wh, "2026-01-01").collect()}
    built = {(r.rule, r.table_name): r.violations for r in quality.summary(layers).collect()}
    assert written == built and len(written) == 14
    dash = {n: p for n, _, p in quality.row_rules(None)}["dq_prd_key_dash"]
    scan = pipeline.read_layer(spark, wh, "bronze", "crm_prd_info").where(dash)
    assert "StringContains(prd_key,-)" in scan._jdf.queryExecution().executedPlan().toString()

    # every audit over the written tables returns what the same audit returns on the in-memory build
    report = {r.audit: r.offending_rows for r in pipeline.audit_report(spark, wh, "2026-01-01").collect()}
    assert "dq_customer_fanout" not in report and len(report) == len(quality.AUDITS) - 1
    for name in ("dq_dup_cst_id", "dq_sales_rule", "dq_dup_product_number", "dq_fact_date_order", "dq_current_product_fanout"):
        assert report[name] == getattr(quality, name)(layers).count(), name
    # audits that count give their count, audits that inform give none
    assert report["dq_fact_orphan_products"] == report["dq_fact_orphan_customers"] == 0
    silver = {r[0]: r[1] for r in quality.dq_sales_orphans_silver(layers).collect()}
    assert report["dq_sales_orphans_silver"] == sum(silver.values()) > 2 and report["dq_gender_matrix"] is None

    for dim, key in (("dim_customers", "customer_key"), ("dim_products", "product_key")):
        d = pipeline.read_layer(spark, wh, "gold", dim)
        n = d.count()
        stats = d.agg(F.min(key).alias("lo"), F.max(key).alias("hi"), F.countDistinct(key).alias("nd")).first()
        assert (stats.lo, stats.hi, stats.nd) == (1, n, n)    # dense and unique

    # history intervals of one product never overlap and are ordered
    prd = pipeline.read_layer(spark, wh, "silver", "crm_prd_info")
    w = Window.partitionBy("cat_id", "prd_key").orderBy("prd_start_dt", "prd_id")
    bad = prd.withColumn("next_start", F.lead("prd_start_dt").over(w)).where(
        (F.col("prd_end_dt") >= F.col("next_start")) | (F.col("prd_end_dt").isNull() & F.col("next_start").isNotNull()))
    assert bad.count() == 0


def _publish(spark, wh, layer, name, df):
    version = versions.new_version()
    df.write.parquet(versions.version_path(wh, layer, name, version))
    versions.publish(spark, wh, layer, {name: version})


def test_tables_are_read_by_name(spark):
    _, src = _sources(spark)
    wh = scratch_path(spark, "warehouse")
    pipeline.load_bronze(spark, src, wh, tables=["erp_loc_a101", "erp_cust_az12"])
    pipeline.load_silver(spark, wh, "2026-01-01", tables=["erp_loc_a101"])
    names = pipeline.register_views(spark, wh, "named_")
    assert names == ["named_bronze.erp_loc_a101", "named_bronze.erp_cust_az12", "named_silver.erp_loc_a101"]
    n = spark.sql("SELECT count(*) FROM named_silver.erp_loc_a101 AS s JOIN named_bronze.erp_loc_a101 AS b "
                  "ON s.cid = replace(b.cid, '-', '')").first()[0]
    assert n == pipeline.read_layer(spark, wh, "bronze", "erp_loc_a101").count() > 0
    # a later load shows through the same name once the views are switched; a query begun before goes on
    before = spark.table("named_bronze.erp_loc_a101")
    _publish(spark, wh, "bronze", "erp_loc_a101", pipeline.read_layer(spark, wh, "bronze", "erp_loc_a101").limit(3))
    pipeline.register_views(spark, wh, "named_", layers=["bronze"])
    assert spark.sql("SELECT * FROM named_bronze.erp_loc_a101").count() == 3 and before.count() == n
    assert pipeline.read_layer(spark, wh, "bronze", "erp_cust_az12").count() > 0  # the other tables stay as they were


def test_failed_load_changes_nothing(spark, monkeypatch):
    """A load that fails after some tables are written: readers keep the old rows, its folders and scratch are gone."""
    _, src = _sources(spark)
    wh = scratch_path(spark, "warehouse")
    pipeline.load_bronze(spark, src, wh)
    old = {n: sorted(map(str, pipeline.read_layer(spark, wh, "bronze", n).collect())) for n in ("erp_loc_a101", "erp_px_cat_g1v2")}
    folders = {n: versions._names(spark, f"{wh}/bronze/{n}") for n in pipeline.LAYER_TABLES}
    other = scratch_path(spark, "sources")
    csv_ingest.write_source_csv(pipeline.read_layer(spark, wh, "bronze", "erp_loc_a101").limit(1), other, "erp_loc_a101")
    with pytest.raises(Exception, match="PX_CAT_G1V2"):  # the second extract is missing
        pipeline.load_bronze(spark, other, wh, parallel=False, tables=["erp_loc_a101", "erp_px_cat_g1v2"])
    assert {n: sorted(map(str, pipeline.read_layer(spark, wh, "bronze", n).collect())) for n in old} == old
    assert {n: versions._names(spark, f"{wh}/bronze/{n}") for n in pipeline.LAYER_TABLES} == folders

    # rows lost on the way to the files are noticed when the table is read back
    real = spark.read.__class__.parquet
    monkeypatch.setattr(spark.read.__class__, "parquet", lambda self, *p: real(self, *p).limit(2))
    with pytest.raises(pipeline.LoadError):
        pipeline.load_bronze(spark, src, wh, tables=["erp_loc_a101"])
    monkeypatch.undo()
    assert {n: sorted(map(str, pipeline.read_layer(spark, wh, "bronze", n).collect())) for n in old} == old


def test_old_versions_and_scratch_are_dropped(spark):
    _, src = _sources(spark)
    wh = scratch_path(spark, "warehouse")
    for _ in range(4):
        pipeline.load_bronze(spark, src, wh, tables=["erp_loc_a101"])
    assert len(versions._names(spark, f"{wh}/bronze/erp_loc_a101")) == 2     # the published one and the one before
    assert len(versions._names(spark, f"{wh}/_published/bronze")) <= 3
    pipeline.load_bronze(spark, src, wh)
    pipeline.load_silver(spark, wh, "2026-01-01")
    scratch = set(versions._names(spark, f"{ensure_checkpoint_dir(spark)}/strata"))
    pipeline.build_gold(spark, wh)
    assert set(versions._names(spark, f"{ensure_checkpoint_dir(spark)}/strata")) == scratch
    assert pipeline.read_layer(spark, wh, "gold", "dim_customers").count() > 0


def test_extracts_are_on_disk_for_their_own_load_only(spark, tmp_folder, monkeypatch):
    """A full refresh drops the extracts of one load before it writes the next; the real rows alone are left."""
    day = "TIMESTAMP '1995-02-03'"
    tables = {
        "customer": "id AS c_custkey, concat('C', id) AS c_name, 'BUILDING' AS c_mktsegment",
        "part": "id AS p_partkey, concat('part ', id) AS p_name, 'Brand#12' AS p_brand, 'ECONOMY TIN' AS p_type, 7 AS p_size, 900.5D AS p_retailprice",
        "orders": f"id AS o_orderkey, id % 7 AS o_custkey, {day} AS o_orderdate",
        "lineitem": f"id % 40 AS l_orderkey, id % 9 AS l_partkey, id AS l_suppkey, CAST(id / 40 AS INT) AS l_linenumber, 3D AS l_quantity, "
                    f"10.5D AS l_extendedprice, {day} AS l_shipdate"}
    for name, columns in tables.items():
        spark.range(120).selectExpr(f"struct({columns}) AS r").select("r.*").write.parquet(f"{tmp_folder}/{name}.parquet")

    def extracts():
        return {n for n in versions._names(spark, f"{ensure_checkpoint_dir(spark)}/strata") if n.startswith("sources-")}

    there, loads, load = extracts(), [], pipeline.load_bronze

    def watched(*args, **kwargs):
        loads.append(extracts() - there)
        return load(*args, **kwargs)

    monkeypatch.setattr(pipeline, "load_bronze", watched)
    rows = QUERIES["full_refresh_idempotent"](spark, tmp_folder).collect()
    assert [len(folders) for folders in loads] == [1, 1] and loads[0] != loads[1] and extracts() == there
    assert sum(r.table_name == "crm_sales_details" for r in rows) == 120 and not any("-old" in r.row_text for r in rows)


def test_shuffle_files_of_finished_jobs_are_dropped(spark):
    def shuffled():
        files = spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().getAllFiles().mkString("\n").split("\n")
        return {f for f in files if "shuffle_" in f and f.endswith(".data")}

    there = shuffled()
    spark.range(1000).repartition(4, "id").write.format("noop").mode("overwrite").save()
    made = shuffled() - there
    spark.range(1).count()  # Spark may still hold what the last job used
    drop_shuffles(spark)
    until = time.time() + 20
    while shuffled() & made and time.time() < until:
        time.sleep(0.2)
    assert made and not shuffled() & made


def test_published_file_counts_when_it_is_whole(spark, tmp_folder):
    versions.publish(spark, tmp_folder, "gold", {"a": "v1"})
    versions.publish(spark, tmp_folder, "gold", {"b": "v2"})
    assert versions.published(spark, tmp_folder, "gold") == {"a": "v1", "b": "v2"}
    with open(tmp_folder.replace("file:", "") + "/_published/gold/00000009", "w") as f:
        f.write("a\tv3\n")
    assert versions.published(spark, tmp_folder, "gold") == {"a": "v1", "b": "v2"}
    assert versions.published(spark, tmp_folder, "silver") == {}


def test_digest_sees_rows_values_and_nulls(spark):
    def digest(rows):
        df = spark.createDataFrame(rows, "a string, b string")
        return tuple(df.agg(*versions.table_digest(df)).first())

    rows = [("x", None), (None, "x"), ("x", "x")]
    assert digest(rows) == digest(rows[::-1])
    assert len({digest(r) for r in (rows, rows[:2], rows + rows[:1], [rows[0], rows[0], rows[2]], [("x", None)] * 3)}) == 5


def test_rejected_sales_and_the_fact_are_all_sales(spark):
    sales = spark.createDataFrame([("s1", "P", 1), ("s2", "P", 9), ("s3", "Q", 1), ("s4", None, None), ("s5", "P", 2)],
                                  "sls_ord_num string, sls_prd_key string, sls_cust_id long").selectExpr(
        "*", "DATE'2020-01-01' AS sls_order_dt", "DATE'2020-01-01' AS sls_ship_dt", "DATE'2020-01-01' AS sls_due_dt",
        "1.5BD AS sls_sales", "1 AS sls_quantity", "1.5BD AS sls_price")
    products = spark.createDataFrame([(1, "P"), (2, "P"), (3, None)], "product_key long, product_number string")
    customers = spark.createDataFrame([(1, 1), (2, 2), (3, 2), (4, None)], "customer_key long, customer_id long")
    got = gold.fact_sales_outcomes(sales, products, customers)
    rejected = got.where("outcome = 'rejected'")
    assert sorted((r.order_number, r.reason) for r in rejected.collect()) == [
        ("s2", "no customer"), ("s3", "no product"), ("s4", "no product, no customer")]
    fact = got.where("outcome = 'accepted'").select(*gold.FACT_COLUMNS)
    assert sorted(map(str, fact.collect())) == sorted(map(str, gold.fact_sales(sales, products, customers).collect()))
    assert got.where("counts_once").count() == sales.count()


def test_amounts_that_do_not_fit_are_counted(spark):
    wh = scratch_path(spark, "warehouse")
    rows = [("a", 10, 2, 5), ("b", None, 100_000, 100_000), ("c", 999_999_999, 1, None)]
    bronze = spark.createDataFrame(rows, "sls_ord_num string, sls_sales int, sls_quantity int, sls_price int").selectExpr(
        "sls_ord_num", "'P1' AS sls_prd_key", "1L AS sls_cust_id", "20200101 AS sls_order_dt", "20200101 AS sls_ship_dt",
        "20200101 AS sls_due_dt", "sls_sales", "sls_quantity", "sls_price")
    _publish(spark, wh, "bronze", "crm_sales_details", bronze)
    report = pipeline.load_silver(spark, wh, tables=["crm_sales_details"]).collect()
    # b: sales 10^10; c: sales and the price derived from it
    assert [(r.rows_loaded, r.lost_amounts) for r in report] == [(3, 3)]


def test_row_counts_report(spark):
    layers, src = _sources(spark)
    wh = scratch_path(spark, "warehouse")
    pipeline.load_bronze(spark, src, wh)
    got = {r.table_name: r.rows_loaded for r in pipeline.row_counts(spark, wh, "bronze").collect()}
    assert set(got) == {f"bronze.{n}" for n in csv_ingest.SOURCES}
    assert got["bronze.erp_px_cat_g1v2"] == layers.bronze("erp_px_cat_g1v2").count() > 50


def test_partitioned_fact_and_ingest_report(spark):
    layers, src = _sources(spark)
    wh = scratch_path(spark, "warehouse")
    pipeline.load_bronze(spark, src, wh)
    pipeline.load_silver(spark, wh, "2026-01-01")
    report = {r.table_name: r.rows_loaded for r in pipeline.build_gold(spark, wh, ["order_date"]).collect()}
    fact = pipeline.read_layer(spark, wh, "gold", "fact_sales")
    assert report["gold.fact_sales"] == fact.count() == layers.fact_sales().count()
    one_day = fact.where(F.col("order_date") == F.lit("1995-03-01").cast("date"))
    scan = next(x for x in one_day._jdf.queryExecution().executedPlan().toString().splitlines() if "PartitionFilters" in x)
    filters = scan[scan.index("PartitionFilters"):scan.index("PushedFilters")]
    assert "order_date" in filters and "outcome" in filters
    fails = pipeline.ingest_failures(spark, src).collect()
    assert fails and all(r.failures == 0 for r in fails)

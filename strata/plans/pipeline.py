"""The load pipeline: sources -> bronze -> silver -> gold, each a full refresh.

A load writes its tables to fresh version folders, reads each back and compares
it with what was observed while it was written (row count and a digest that does
not depend on row order), and only then switches readers to the new versions
(``strata.plans.versions``): a reader never finds a table missing or half
written, and a load that fails changes nothing.  Scratch folders of a load are
removed at its end.

The tables of one layer are independent, so their jobs are submitted together
from a small thread pool.  Silver tables get the audit column
``dwh_create_date`` at write time.  Each step returns a report DataFrame
``(table_name, rows_loaded, seconds, ...)``; the seconds cover building and
writing the table.  ``register_views`` names the published tables for SQL users.

Gold writes the sales once, in one pass, partitioned by outcome: ``fact_sales``
is the accepted part, ``rejected_sales`` the sales without a product or customer,
each with its reason.
"""

from __future__ import annotations

import time
from collections.abc import Callable, Mapping, Sequence
from concurrent.futures import ThreadPoolExecutor
from contextvars import copy_context
from functools import reduce

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from strata.functions.cleaning import NA, lost_amounts
from strata.plans import gold, quality, silver, versions
from strata.plans.layers import Layers
from strata.session import scratch_removed
from strata.sources import csv_ingest

LAYER_TABLES = list(csv_ingest.SOURCES)
#: Tables that readers see in gold; the last two are parts of the written sales.
GOLD_TABLES = ["dim_customers", "dim_products", "fact_sales", "rejected_sales"]
SALES = "sales"
_PARTS = {"fact_sales": (gold.ACCEPTED, gold.FACT_COLUMNS), "rejected_sales": (gold.REJECTED, gold.REJECTED_COLUMNS)}


class LoadError(RuntimeError):
    """A written table differs from what was observed while it was written; nothing was published."""


def table_path(spark: SparkSession, warehouse_dir: str, layer: str, name: str) -> str:
    """The folder of a table's published version."""
    version = versions.published(spark, warehouse_dir, layer).get(name)
    if version is None:
        raise FileNotFoundError(f"{layer}.{name} has not been published in {warehouse_dir}")
    return versions.version_path(warehouse_dir, layer, name, version)


def read_layer(spark: SparkSession, warehouse_dir: str, layer: str, name: str) -> DataFrame:
    """The published version of a table."""
    if layer == "gold" and name in _PARTS:
        outcome, columns = _PARTS[name]
        return spark.read.parquet(table_path(spark, warehouse_dir, layer, SALES)).where(F.col(gold.OUTCOME) == outcome).select(*columns)
    return spark.read.parquet(table_path(spark, warehouse_dir, layer, name))


def write_version(build: Callable[[], DataFrame], path: str, partition_by: Sequence[str] = ()) -> tuple[int, float]:
    """Build and write a table, then compare what is in its folder with what was written: ``(rows, seconds)``.

    The seconds include jobs that building it starts.
    """
    t0 = time.perf_counter()
    df = build()
    written = Observation()
    df.observe(written, *versions.table_digest(df)).write.partitionBy(*partition_by).parquet(path, compression="zstd")
    seconds = time.perf_counter() - t0
    back = df.sparkSession.read.schema(df.schema).parquet(path)
    found = back.agg(*versions.table_digest(back)).first().asDict()
    if found != {k: written.get.get(k) for k in found}:
        raise LoadError(f"{path}: {found} read back, {written.get} written")
    return found["digest_rows"], round(seconds, 3)


class _Load:
    """The fresh versions of one load: written, then published together or removed."""

    def __init__(self, spark: SparkSession, warehouse_dir: str, layer: str, parallel: bool) -> None:
        self.spark, self.warehouse_dir, self.layer, self.parallel = spark, warehouse_dir, layer, parallel
        self.version, self.tables = versions.new_version(), {}
        self._scratch = scratch_removed(spark)

    def __enter__(self) -> _Load:
        self._scratch.__enter__()
        return self

    def __exit__(self, kind, error, trace) -> None:
        try:
            if kind is None:
                versions.publish(self.spark, self.warehouse_dir, self.layer, self.tables)
            else:
                for name in self.tables:
                    versions.remove(self.spark, self.path(name))
        finally:
            self._scratch.__exit__(None, None, None)

    def path(self, name: str) -> str:
        return versions.version_path(self.warehouse_dir, self.layer, name, self.version)

    def write(self, builds: Mapping[str, Callable[[], DataFrame]], partition_by: Sequence[str] = ()) -> dict[str, tuple[int, float]]:
        """Write independent tables, as concurrent Spark jobs when ``parallel``: rows and seconds of each."""
        self.tables |= dict.fromkeys(builds, self.version)

        def one(name: str) -> tuple[int, float]:
            return write_version(builds[name], self.path(name), partition_by)

        if not self.parallel or len(builds) == 1:
            return {n: one(n) for n in builds}
        with ThreadPoolExecutor(max_workers=len(builds)) as pool:
            jobs = {n: pool.submit(copy_context().run, one, n) for n in builds}
        return {n: job.result() for n, job in jobs.items()}


def _report(spark: SparkSession, layer: str, written: Mapping[str, tuple[int, float]], observed: Mapping[str, Observation] | None = None,
            metrics: Sequence[str] = ()) -> DataFrame:
    """The report rows; ``metrics`` are observed counts (0 for tables without an observation)."""
    rows = []
    for name, (n, seconds) in written.items():
        got = observed[name].get if observed and name in observed else {}
        rows.append((f"{layer}.{name}", n, seconds, *[got.get(m) or 0 for m in metrics]))
    extra = "".join(f", {m} bigint" for m in metrics)
    return spark.createDataFrame(rows, f"table_name string, rows_loaded bigint, seconds double{extra}")


def load_bronze(spark: SparkSession, source_dir: str, warehouse_dir: str, parallel: bool = True,
                tables: Sequence[str] = tuple(LAYER_TABLES)) -> DataFrame:
    """Truncate-and-load bronze tables (by default all six) from their CSV extracts.

    The report's ``failed_values`` counts the non-empty values that did not
    convert to their column type, ``malformed_rows`` the rows with too few or too
    many fields; both are observed during the load itself (one pass).
    """
    observed: dict[str, Observation] = {}

    def build(name: str) -> DataFrame:
        df, observed[name] = csv_ingest.read_bronze_observed(spark, source_dir, name)
        return df

    with _Load(spark, warehouse_dir, "bronze", parallel) as load:
        written = load.write({n: (lambda n=n: build(n)) for n in tables})
    return _report(spark, "bronze", written, observed, ("failed_values", "malformed_rows"))


def load_silver(spark: SparkSession, warehouse_dir: str, as_of: str | None = None, parallel: bool = True,
                tables: Sequence[str] = tuple(LAYER_TABLES)) -> DataFrame:
    """Rebuild silver tables (by default all six) from bronze, stamping ``dwh_create_date``.

    No silver table reads another.  The report's ``lost_amounts`` counts, during
    the write, the repaired sales and prices that are NULL because their column
    cannot hold them.
    """
    bronze = {n: read_layer(spark, warehouse_dir, "bronze", n) for n in tables}
    lost = Observation("silver_crm_sales_details")
    builders = {
        "crm_cust_info": lambda: silver.crm_cust_info(bronze["crm_cust_info"]),
        "crm_prd_info": lambda: silver.crm_prd_info(bronze["crm_prd_info"]),
        "crm_sales_details": lambda: silver.crm_sales_details(bronze["crm_sales_details"].observe(
            lost, F.sum(lost_amounts("sls_sales", "sls_quantity", "sls_price").cast("bigint")).alias("lost_amounts"))),
        "erp_loc_a101": lambda: silver.erp_loc_a101(bronze["erp_loc_a101"]),
        "erp_cust_az12": lambda: silver.erp_cust_az12(bronze["erp_cust_az12"], as_of),
        "erp_px_cat_g1v2": lambda: silver.erp_px_cat_g1v2(bronze["erp_px_cat_g1v2"]),
    }
    with _Load(spark, warehouse_dir, "silver", parallel) as load:
        written = load.write({n: (lambda b=builders[n]: b().withColumn("dwh_create_date", F.localtimestamp())) for n in tables})
    return _report(spark, "silver", written, {"crm_sales_details": lost}, ("lost_amounts",))


def ingest_failures(spark: SparkSession, source_dir: str) -> DataFrame:
    """Per typed bronze column: values present in the extract that did not convert (one pass per file)."""
    parts = []
    for name, (rel, cols) in csv_ingest.SOURCES.items():
        if csv_ingest.BRONZE_TYPES[name]:
            raw = csv_ingest.read_source_csv(spark, f"{source_dir.rstrip('/')}/{rel}", cols)
            parts.append(csv_ingest.conversion_failures(name, raw))
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def build_gold(spark: SparkSession, warehouse_dir: str, partition_fact_by: Sequence[str] = (),
               parallel: bool = True) -> DataFrame:
    """Write both dimensions (together when ``parallel``), then the sales by outcome from the written dimensions;
    all are published at once.

    ``partition_fact_by`` (e.g. ``["order_date"]``) writes the sales in
    partition folders for pruning; rows are first rebalanced on those columns
    (AQE splits a hot value over several tasks and merges small ones), so each
    task writes few, evenly sized files.
    """
    s = {n: read_layer(spark, warehouse_dir, "silver", n).drop("dwh_create_date") for n in LAYER_TABLES}
    dims = {
        "dim_customers": lambda: gold.dim_customers(s["crm_cust_info"], s["erp_cust_az12"], s["erp_loc_a101"]),
        "dim_products": lambda: gold.dim_products(s["crm_prd_info"], s["erp_px_cat_g1v2"]),
    }
    with _Load(spark, warehouse_dir, "gold", parallel) as load:
        written = load.write(dims)

        def sales() -> DataFrame:
            rows = gold.fact_sales_outcomes(s["crm_sales_details"], *(spark.read.parquet(load.path(d)) for d in ("dim_products", "dim_customers")))
            return rows.hint("rebalance", *partition_fact_by) if partition_fact_by else rows

        written |= load.write({SALES: sales}, [gold.OUTCOME, *partition_fact_by])
    _, seconds = written.pop(SALES)
    parts = {p: (read_layer(spark, warehouse_dir, "gold", p).count(), seconds) for p in _PARTS}
    return _report(spark, "gold", written | parts)


def register_views(spark: SparkSession, warehouse_dir: str, prefix: str = "",
                   layers: Sequence[str] = ("bronze", "silver", "gold")) -> list[str]:
    """Name the published tables for SQL: views ``{prefix}bronze.…``, ``{prefix}silver.…``, ``{prefix}gold.…``; returns the names.

    A view reads the version that is published now; call this again after a load
    to switch it (one ``CREATE OR REPLACE`` a view: queries see the old rows or the new ones).
    """
    names = []
    for layer in layers:
        spark.sql(f"CREATE DATABASE IF NOT EXISTS `{prefix}{layer}`")
        known = versions.published(spark, warehouse_dir, layer)
        for table in GOLD_TABLES if layer == "gold" else LAYER_TABLES:
            part = _PARTS.get(table) if layer == "gold" else None
            if (SALES if part else table) not in known:
                continue
            path = table_path(spark, warehouse_dir, layer, SALES if part else table).replace("`", "``")
            columns, where = (", ".join(part[1]), f" WHERE {gold.OUTCOME} = '{part[0]}'") if part else ("*", "")
            spark.sql(f"CREATE OR REPLACE VIEW `{prefix}{layer}`.`{table}` AS SELECT {columns} FROM parquet.`{path}`{where}")
            names.append(f"{prefix}{layer}.{table}")
    return names


def reconcile(spark: SparkSession, warehouse_dir: str) -> DataFrame:
    """``(step, table_name, entry, n_rows)``: for every table of silver and gold what came in, what was dropped
    or added on the way and why, and what came out; the entries of a table add up to its rows out.

    The counts are taken from the published tables themselves.
    """
    def count(layer: str, name: str) -> int:
        return read_layer(spark, warehouse_dir, layer, name).count()

    rows: list[tuple[str, str, str, int]] = []
    for name in LAYER_TABLES:
        n_in, n_out = count("bronze", name), count("silver", name)
        rows += [("bronze to silver", name, "rows in", n_in), ("bronze to silver", name, "rows out", n_out)]
        if name == "crm_cust_info":
            ids = read_layer(spark, warehouse_dir, "bronze", name).groupBy("cst_id").count().agg(F.sum(F.col("count") - 1)).first()[0] or 0
            rows.append(("bronze to silver", name, "dropped: older row of the same id", -ids))
    for name, source in (("dim_customers", "crm_cust_info"), ("dim_products", "crm_prd_info")):
        n_in, n_out = count("silver", source), count("gold", name)
        rows += [("silver to gold", name, "rows in", n_in), ("silver to gold", name, "rows out", n_out),
                 ("silver to gold", name, "added: several rows to one key in a joined table", n_out - n_in)]
    sales = spark.read.parquet(table_path(spark, warehouse_dir, "gold", SALES))
    once = sales.groupBy(gold.OUTCOME, gold.REASON).agg(F.count(F.lit(1)).alias("n"), F.count_if(gold.ONCE).alias("once")).collect()
    rows.append(("silver to gold", "fact_sales", "rows in", count("silver", "crm_sales_details")))
    for r in once:
        if r[gold.OUTCOME] == gold.REJECTED:
            rows.append(("silver to gold", "fact_sales", f"dropped: {r[gold.REASON]}", -r["n"]))
        else:
            rows += [("silver to gold", "fact_sales", "added: several versions of the product or rows of the customer", r["n"] - r["once"]),
                     ("silver to gold", "fact_sales", "rows out", r["n"])]
    return spark.createDataFrame(rows, "step string, table_name string, entry string, n_rows bigint")


def row_counts(spark: SparkSession, warehouse_dir: str, layer: str) -> DataFrame:
    """The load report: one row per table of a layer, ``UNION ALL`` of counts."""
    parts = [read_layer(spark, warehouse_dir, layer, n).agg(F.count(F.lit(1)).alias("rows_loaded"))
             .select(F.lit(f"{layer}.{n}").alias("table_name"), "rows_loaded") for n in LAYER_TABLES]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def audit(spark: SparkSession, warehouse_dir: str, as_of: str | None = None) -> DataFrame:
    """Row-level data-quality rules over the written bronze tables and fact (one pass per table).

    The tables are read from parquet, so each rule's columns are all that is
    read and simple predicates reach the scan.
    """
    tables = {f"bronze.{n}": read_layer(spark, warehouse_dir, "bronze", n) for n in LAYER_TABLES}
    tables["gold.fact_sales"] = read_layer(spark, warehouse_dir, "gold", "fact_sales")
    return quality.summarise(tables, as_of)


class WarehouseLayers(Layers):
    """The layers of a written warehouse, read from parquet, for the audits.

    Offers what the audits read: bronze and silver tables, both dimensions and
    the fact as written.  Relations that are not part of a load (the repeated
    ERP location loads, the open-versions-only product dimension) are absent.
    """

    def __init__(self, spark: SparkSession, warehouse_dir: str, as_of: str | None = None):
        super().__init__(spark, "", as_of)
        self.warehouse_dir = warehouse_dir

    def bronze(self, name: str) -> DataFrame:
        return self._get(f"b:{name}", lambda: read_layer(self.spark, self.warehouse_dir, "bronze", name))

    def silver(self, name: str) -> DataFrame:
        if name not in LAYER_TABLES:
            raise KeyError(f"silver.{name} is not part of a load")
        return self._get(f"s:{name}", lambda: read_layer(self.spark, self.warehouse_dir, "silver", name)
                         .drop("dwh_create_date"))

    def dim_customers(self, unknown: str = NA) -> DataFrame:
        if unknown != NA:
            raise KeyError("only the faithful customer dimension is written")
        return self._get("g:dim_customers", lambda: read_layer(self.spark, self.warehouse_dir, "gold", "dim_customers"))

    def dim_products(self, current_only: bool = False) -> DataFrame:
        if current_only:
            raise KeyError("only the full product dimension is written")
        return self._get("g:dim_products", lambda: read_layer(self.spark, self.warehouse_dir, "gold", "dim_products"))

    def dim_customers_base(self) -> DataFrame:
        return self.dim_customers().drop("customer_key")

    def dim_products_base(self) -> DataFrame:
        return self.dim_products().drop("product_key")

    def fact_sales_base(self) -> DataFrame:
        return self.fact_sales().drop("product_key", "customer_key")

    def fact_sales(self) -> DataFrame:
        return self._get("g:fact_sales", lambda: read_layer(self.spark, self.warehouse_dir, "gold", "fact_sales"))


def audit_report(spark: SparkSession, warehouse_dir: str, as_of: str | None = None) -> DataFrame:
    """``(audit, kind, offending_rows)`` for every audit that the written tables support.

    ``kind`` is ``rows`` (the audit lists offending rows or groups, which are
    counted), ``count`` (the audit's own count is taken) or ``info`` (distinct
    values and distributions, where nothing is offending: NULL).  All row rules
    of one table are counted in one pass.
    """
    layers = WarehouseLayers(spark, warehouse_dir, as_of)
    parts = [audit(spark, warehouse_dir, as_of).select(
        F.col("rule").alias("audit"), F.lit("rows").alias("kind"), F.col("violations").alias("offending_rows"))]
    row_rules = {name for name, _, _ in quality.row_rules(as_of)}
    for name in quality.AUDITS:
        if name in row_rules:
            continue
        kind = "count" if name in quality.COUNT_AUDITS else "info" if name in quality.INFO_AUDITS else "rows"
        try:
            found = getattr(quality, name)(layers) if kind != "info" else None
        except KeyError:
            continue
        n = F.count(F.lit(1)) if kind == "rows" else F.sum(quality.AFFECTED_ROWS)
        rows = spark.range(1).select(F.lit(None).cast("bigint").alias("n")) if found is None else found.agg(n.cast("bigint").alias("n"))
        parts.append(rows.select(F.lit(name).alias("audit"), F.lit(kind).alias("kind"), F.col("n").alias("offending_rows")))
    return reduce(DataFrame.unionByName, parts)

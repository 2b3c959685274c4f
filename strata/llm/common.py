"""Helpers shared by the corpus operators."""

from __future__ import annotations

import tempfile
import zipfile
from collections.abc import Iterator
from pathlib import Path

import pyarrow as pa
from pyarrow import fs
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import StructType

import strata
from strata.session import scratch_path


def materialise(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` below ``spark.checkpoint.dir`` and read it back.

    Cuts lineage with files every executor can read, so work done once is not
    repeated when an executor is lost, and the planner sees real sizes.
    """
    spark = df.sparkSession
    path = scratch_path(spark, f"llm-{name}")
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def open_folder(uri: str) -> tuple[fs.FileSystem, str]:
    """File system and path of a folder below ``spark.checkpoint.dir``, for tasks that read its files themselves."""
    return fs.FileSystem.from_uri(uri)


def arrow_schema(schema: str | StructType) -> pa.Schema:
    return to_arrow_schema(StructType.fromDDL(schema) if isinstance(schema, str) else schema)


def record_batches(rows: list[tuple], schema: pa.Schema) -> pa.RecordBatch:
    columns = list(zip(*rows)) if rows else [()] * len(schema)
    return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns, schema)], schema=schema)


_SHIPPED: set[str] = set()


def ship_package(spark: SparkSession) -> None:
    """Send this package to the Python workers (once per application), so that
    task functions import it wherever they run."""
    context = spark.sparkContext
    if context.applicationId in _SHIPPED:
        return
    root = Path(strata.__file__).parent
    target = Path(tempfile.mkdtemp(prefix="strata-ship-")) / "strata.zip"
    with zipfile.ZipFile(target, "w") as z:
        for f in sorted(root.rglob("*.py")):
            z.write(f, f.relative_to(root.parent))
    context.addPyFile(str(target))
    _SHIPPED.add(context.applicationId)


def map_arrow(df: DataFrame, fn, schema: str | StructType) -> DataFrame:
    """``mapInArrow`` with this package at hand in the workers."""
    ship_package(df.sparkSession)
    return df.mapInArrow(fn, StructType.fromDDL(schema) if isinstance(schema, str) else schema)


def map_rows(df: DataFrame, make, schema: str | StructType, batch_rows: int = 20_000) -> DataFrame:
    """``mapInArrow`` over plain tuples: ``make()`` runs once per task and returns
    a function (row tuple -> iterable of output tuples).  Output leaves in
    batches of at most ``batch_rows`` rows, so a task holds one batch."""
    out = arrow_schema(schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fn, rows = make(), []
        for batch in batches:
            for row in zip(*(c.to_pylist() for c in batch.columns)):
                rows.extend(fn(*row))
                if len(rows) >= batch_rows:
                    yield record_batches(rows, out)
                    rows = []
        if rows:
            yield record_batches(rows, out)

    return map_arrow(df, run, schema)


def hash_share(rows: DataFrame, key: list[str], n: int, total: int | None = None) -> Column:
    """Condition for a repeatable sample of about ``n`` rows: those whose hashed key
    lies in the lowest n / total of the hash range (every row if there are no more than n)."""
    total = rows.count() if total is None else total
    if total <= n:
        return F.lit(True)
    return F.xxhash64(*key) < F.lit(int(-2**63 + n / total * 2**64))


def fresh(df: DataFrame, *names: str) -> list[str]:
    """Column names based on ``names`` that ``df`` does not use (case-insensitively)."""
    used, out = {c.lower() for c in df.columns}, []
    for name in names:
        while name.lower() in used:
            name += "_"
        used.add(name.lower())
        out.append(name)
    return out


def col(name: str) -> Column:
    """A column by its literal name, dots and backticks included."""
    return F.col("`" + name.replace("`", "``") + "`")


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def filter_rows(df: DataFrame, columns: list[str], make) -> DataFrame:
    """Keep the rows for which ``make()``'s function of ``columns`` is true; all columns pass through unread."""
    at = [df.columns.index(c) for c in columns]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        keep = make()
        for batch in batches:
            rows = zip(*(batch.column(i).to_pylist() for i in at))
            yield batch.filter(pa.array([bool(keep(*row)) for row in rows], pa.bool_()))

    return map_arrow(df, run, df.schema)

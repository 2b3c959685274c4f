"""Published table versions of a file-based warehouse.

Every load writes its tables to fresh folders ``{warehouse}/{layer}/{table}/{version}``,
which no reader sees; when all of them are written and checked, one small file
(``{warehouse}/_published/{layer}/{number}``) names the version of every table
of the layer, and readers follow the file with the highest number.  It is
created exclusively and counts only when its last line is there, so a switch
happens wholly or not at all, and two loads cannot publish the same number.
A load that fails changes nothing that readers see and removes its folders.
After a switch the version before stays for readers that began with it; older
ones are removed.
"""

from __future__ import annotations

import datetime as dt
import uuid
from collections.abc import Mapping

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

_END = "end"


def table_digest(df: DataFrame) -> list[Column]:
    """Aggregates that do not depend on row order: the row count, and the sums of three parts of 64-bit row hashes.

    NULLs count: each column is hashed with whether it is NULL.  Columns are
    taken by name, so their order does not matter.  A part has at most 22 bits, so
    its sum is a plain BIGINT for up to 2**41 rows.
    """
    parts = [x for c in sorted(df.columns) for x in (F.col(c).isNull(), F.col(c))]
    row = F.xxhash64(*parts)
    low = F.lit((1 << 21) - 1).cast("bigint")
    cut = [row.bitwiseAND(low), F.shiftright(row, 21).bitwiseAND(low), F.shiftright(row, 42)]
    return [F.count(F.lit(1)).alias("digest_rows"), *[F.sum(p).alias(f"digest_sum_{i}") for i, p in enumerate(cut)]]


def new_version() -> str:
    """A folder name that sorts by time."""
    return f"{dt.datetime.now(dt.timezone.utc):%Y%m%dT%H%M%S%f}-{uuid.uuid4().hex[:8]}"


def _path(spark: SparkSession, path: str):
    """A path of the cluster's file system and that file system (Hadoop's, as Spark's own readers use it)."""
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    return p, p.getFileSystem(spark._jsc.hadoopConfiguration())


def _names(spark: SparkSession, folder: str) -> list[str]:
    p, fs = _path(spark, folder)
    return sorted(s.getPath().getName() for s in fs.listStatus(p)) if fs.exists(p) else []


def remove(spark: SparkSession, path: str) -> None:
    """Delete a folder or file and what is in it, if there is one."""
    p, fs = _path(spark, path)
    fs.delete(p, True)


def _manifests(warehouse_dir: str, layer: str) -> str:
    return f"{warehouse_dir.rstrip('/')}/_published/{layer}"


def version_path(warehouse_dir: str, layer: str, table: str, version: str) -> str:
    return f"{warehouse_dir.rstrip('/')}/{layer}/{table}/{version}"


def _read(spark: SparkSession, path: str) -> dict[str, str] | None:
    """Table to version of one published file; None while it is being written."""
    p, fs = _path(spark, path)
    stream = fs.open(p)
    try:
        lines = spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8").splitlines()
    finally:
        stream.close()
    return dict(line.split("\t") for line in lines[:-1]) if lines and lines[-1] == _END else None


def published(spark: SparkSession, warehouse_dir: str, layer: str) -> dict[str, str]:
    """The version of every table of a layer that readers see now."""
    folder = _manifests(warehouse_dir, layer)
    for name in reversed([n for n in _names(spark, folder) if n.isdigit()]):
        tables = _read(spark, f"{folder}/{name}")
        if tables is not None:
            return tables
    return {}


def publish(spark: SparkSession, warehouse_dir: str, layer: str, versions: Mapping[str, str], keep: int = 1) -> None:
    """Switch readers to ``versions`` of some tables (the other tables stay), then drop all but ``keep`` older ones."""
    folder = _manifests(warehouse_dir, layer)
    numbers = [int(n) for n in _names(spark, folder) if n.isdigit()]
    tables = published(spark, warehouse_dir, layer) | dict(versions)
    p, fs = _path(spark, f"{folder}/{max(numbers, default=0) + 1:08d}")
    stream = fs.create(p, False)  # fails if another load published this number
    stream.write(bytearray("".join(f"{t}\t{v}\n" for t, v in sorted(tables.items())).encode() + _END.encode()))
    stream.close()
    for table, version in versions.items():
        older = [v for v in _names(spark, f"{warehouse_dir.rstrip('/')}/{layer}/{table}") if v < version]
        for v in older[:max(0, len(older) - keep)]:
            remove(spark, version_path(warehouse_dir, layer, table, v))
    for n in sorted(numbers)[:-1 - keep]:
        remove(spark, f"{folder}/{n:08d}")

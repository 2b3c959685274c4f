"""Session construction and the shared scratch location.

Library code never creates its own session; it receives one.  ``local_session``
exists for tests and ``bench.py``.  Intermediate tables that must survive
executor loss (stable surrogate keys, range buckets) are written under the
folder the cluster names in ``spark.checkpoint.dir``; a default is set only when
the session has none, which is the local-test case.
"""

from __future__ import annotations

import os
import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager
from contextvars import ContextVar

from pyspark.sql import SparkSession

#: The scratch folders of the job that runs now, if it removes them at its end.
_SCRATCH: ContextVar[list[str] | None] = ContextVar("scratch", default=None)
_CHECKPOINT_KEY = "spark.checkpoint.dir"


def local_session(cores: int | str = "*", shuffle_partitions: int = 8,
                  app: str = "strata") -> SparkSession:
    """A local session configured like the cluster one (AQE, ANSI, no UI)."""
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.ui.enabled", "false")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.ansi.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.driver.memory", "8g")
    )
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the shared checkpoint folder named by the session.

    Only a local-mode session (tests, bench) without one gets a temporary
    folder; on a cluster a machine-local folder would not survive the loss of
    that machine, so an unset ``spark.checkpoint.dir`` is an error there.
    """
    path = spark.conf.get(_CHECKPOINT_KEY, None) or spark.sparkContext.getCheckpointDir()
    if not path:
        if not spark.sparkContext.master.startswith("local"):
            raise RuntimeError(f"set {_CHECKPOINT_KEY} to a folder shared by the cluster (e.g. on HDFS or S3)")
        path = os.path.join(tempfile.gettempdir(), f"strata-checkpoints-{uuid.uuid4().hex[:8]}")
        spark.conf.set(_CHECKPOINT_KEY, path)
    if not spark.sparkContext.getCheckpointDir():
        spark.sparkContext.setCheckpointDir(path)
    return path


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh, unique folder below the shared checkpoint folder."""
    base = ensure_checkpoint_dir(spark).rstrip("/")
    path = f"{base}/strata/{name}-{uuid.uuid4().hex[:12]}"
    if (used := _SCRATCH.get()) is not None:
        used.append(path)
    return path


@contextmanager
def scratch_removed(spark: SparkSession) -> Iterator[None]:
    """Remove the scratch folders made inside (also by threads started with a copied context) at the end.

    For jobs that write their result: a DataFrame handed out may still read its scratch folders.
    """
    used: list[str] = []
    token = _SCRATCH.set(used)
    try:
        yield
    finally:
        _SCRATCH.reset(token)
        for path in used:
            p = spark._jvm.org.apache.hadoop.fs.Path(path)
            p.getFileSystem(spark._jsc.hadoopConfiguration()).delete(p, True)


def drop_shuffles(spark: SparkSession) -> None:
    """Have the shuffle files of finished jobs removed soon (those of the last job may stay until the next one).

    Spark removes them when the driver collects garbage, which a driver with much free memory may not do for
    half an hour (``spark.cleaner.periodicGC.interval``).
    """
    spark._jvm.System.gc()

"""Session helpers and the shared scratch location.

Intermediate tables (staged files, cut lineage) always go below the folder
the cluster names in ``spark.checkpoint.dir``; a local folder is only set up
when that setting is missing, which is the case in tests and local runs.
"""

from __future__ import annotations

import os
import tempfile
import threading
import uuid
import zipfile
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession


def get_spark(master: str = "local[*]", shuffle_partitions: int = 8, app: str = "strata") -> SparkSession:
    """Local session with the settings the library assumes (UTC, AQE, no UI)."""
    spark = (
        SparkSession.builder.master(master)
        .appName(app)
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        .config("spark.driver.memory", os.environ.get("STRATA_DRIVER_MEMORY", "8g"))
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def checkpoint_root(spark: SparkSession) -> str:
    """The shared checkpoint folder; created locally only when the session has none."""
    root = spark.conf.get("spark.checkpoint.dir", None)
    sc = spark.sparkContext
    if root:
        if not sc.getCheckpointDir():
            sc.setCheckpointDir(root)
        return root.rstrip("/")
    current = sc.getCheckpointDir()
    if current:
        return current.rstrip("/")
    if not sc.master.startswith("local[") and sc.master != "local":
        # Executors would each write to their own disk, and later reads would miss those files.
        raise RuntimeError("set spark.checkpoint.dir to a folder that the driver and all executors share")
    # Unset (tests, local runs): a local folder, registered with the context only.
    root = tempfile.mkdtemp(prefix="strata-ckpt-")
    sc.setCheckpointDir(root)
    return root


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh, unique folder below the shared checkpoint folder."""
    return f"{checkpoint_root(spark)}/strata/{name}-{uuid.uuid4().hex[:12]}"


def cut_lineage(df, name: str = "stage"):
    """Cut lineage through a parquet table written below the shared checkpoint folder.

    Survives executor loss like ``checkpoint()``, but stays columnar: later
    readers prune to the columns they use (a per-file count reads three
    columns, not whole rows).
    """
    path = scratch_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.parquet(path)


@contextmanager
def stage_table(df: DataFrame, name: str = "stage") -> Iterator[DataFrame]:
    """``cut_lineage`` for a table that only the block reads: its files go when the block ends."""
    spark = df.sparkSession
    path = scratch_path(spark, name)
    with shuffles_removed(spark):
        df.write.option("compression", "zstd").parquet(path)
    try:
        yield spark.read.parquet(path)
    finally:
        target = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
        target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(target, True)


SHUFFLE_CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
_cleanup_lock = threading.Lock()
_cleanup_blocks: dict[str, list] = {}  # by session: open blocks, the setting before the first one


@contextmanager
def shuffles_removed(spark: SparkSession) -> Iterator[None]:
    """Writes in the block remove their shuffle files when they end.

    Without it they stay on the executors' disks until the driver's heap is
    collected. A write's plan runs once, so nothing reads them again. Blocks may
    overlap in threads; the session's own setting comes back with the last one.
    """
    session = spark._jsparkSession.sessionUUID()
    with _cleanup_lock:
        open_blocks = _cleanup_blocks.setdefault(session, [0, None])
        if not open_blocks[0]:
            open_blocks[1] = spark.conf.get(SHUFFLE_CLEANUP, None)
            spark.conf.set(SHUFFLE_CLEANUP, "true")
        open_blocks[0] += 1
    try:
        yield
    finally:
        with _cleanup_lock:
            open_blocks[0] -= 1
            if not open_blocks[0]:
                del _cleanup_blocks[session]
                if open_blocks[1] is None:
                    spark.conf.unset(SHUFFLE_CLEANUP)
                else:
                    spark.conf.set(SHUFFLE_CLEANUP, open_blocks[1])


def ship_package(spark: SparkSession) -> None:
    """Sends this package to the executors once per application, as ``--py-files`` would."""
    sc = spark.sparkContext
    if getattr(sc, "_strata_shipped", False):
        return
    root = os.path.dirname(os.path.abspath(__file__))
    # A local file of the driver; Spark's file server hands it to the executors.
    target = os.path.join(tempfile.mkdtemp(prefix="strata-"), "strata.zip")
    with zipfile.ZipFile(target, "w", zipfile.ZIP_DEFLATED) as out:
        for folder, _, files in os.walk(root):
            for f in files:
                if f.endswith(".py"):
                    full = os.path.join(folder, f)
                    out.write(full, os.path.join("strata", os.path.relpath(full, root)))
    sc.addPyFile(target)
    sc._strata_shipped = True

"""Sinks.

All writers are partitioned, idempotent overwrites of exactly the partitions a
batch owns (dynamic partition overwrite), plus explicit clearing of a file's
partitions when a re-delivery leaves one side empty. Rows that lie anyhow go
through ``rebalance`` first, so that one hot date is split across tasks by AQE
instead of being written by a single task. Bronze and quarantine rows lie by
file as they come (a raw file is read by its splits, each by one task), and
are written where they are, without another shuffle of all lines.
"""

from __future__ import annotations

from collections.abc import Iterable, Sequence

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from strata.schemas import REJECT_META_COLUMNS, RAW_COLUMNS
from strata.session import shuffles_removed


def _hadoop_fs(spark: SparkSession, root: str):
    jvm = spark.sparkContext._jvm
    path = jvm.org.apache.hadoop.fs.Path(root)
    return path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), jvm


def clear_partitions(spark: SparkSession, root: str, partitions: Iterable[str]) -> int:
    """Delete partition folders (``a=x/b=y``) below ``root``; returns how many existed."""
    fs, jvm = _hadoop_fs(spark, root)
    n = 0
    for rel in partitions:
        if fs.delete(jvm.org.apache.hadoop.fs.Path(f"{root.rstrip('/')}/{rel}"), True):
            n += 1
    return n


def path_exists(spark: SparkSession, path: str) -> bool:
    fs, jvm = _hadoop_fs(spark, path)
    return bool(fs.exists(jvm.org.apache.hadoop.fs.Path(path)))


def _partitioned_csv(df: DataFrame, path: str, parts: Sequence[str]) -> None:
    with shuffles_removed(df.sparkSession):
        (
            df.write.mode("overwrite")
            .option("partitionOverwriteMode", "dynamic")
            .option("header", "true")
            .option("escape", '"')
            .option("ignoreLeadingWhiteSpace", "false")
            .option("ignoreTrailingWhiteSpace", "false")
            .option("timestampFormat", "yyyy-MM-dd HH:mm:ss")
            .partitionBy(*parts)
            .csv(path)
        )


def write_bronze(valid: DataFrame, bronze_path: str) -> None:
    """K3: valid rows (the eight columns) under ``source_date=/source_file=``, replacing
    only the partitions of the files in this batch. Nothing is written for a
    file without valid rows (clear its partition first, see ``clear_partitions``).
    A task writes one part for each file that it has rows of: ``valid`` comes by
    file, or from ``hint("rebalance", ...)`` on the file or its day."""
    _partitioned_csv(valid.select(*RAW_COLUMNS, "source_date", "source_file"), bronze_path, ["source_date", "source_file"])


def write_quarantine_rows(rejected: DataFrame, quarantine_path: str) -> None:
    """K4: rejected rows with the three leading columns, same layout and clustering as bronze."""
    cols = [*REJECT_META_COLUMNS, *RAW_COLUMNS, "source_date", "source_file"]
    _partitioned_csv(rejected.select(*cols), f"{quarantine_path.rstrip('/')}/rows", ["source_date", "source_file"])


# Bytes of a quarantined file in one row.
PART_BYTES = 8 << 20


def _file_parts(batches):
    from strata.sources.files import file_chunks

    for batch in batches:
        for path in batch.column("source_uri").to_pylist():
            for part, chunk in enumerate(file_chunks(path, PART_BYTES)):
                yield pa.RecordBatch.from_arrays(
                    [pa.array([path], pa.string()), pa.array([part], pa.int32()), pa.array([chunk], pa.binary())],
                    names=["source_uri", "part", "content"],
                )


def write_quarantine_files(spark: SparkSession, failed: DataFrame, quarantine_path: str) -> None:
    """K5: whole failed files (original bytes) with uri, checksum and reason, as parquet.

    ``failed``: source_uri, source_file, source_date, source_checksum, file_error.
    A file is read in chunks on an executor and becomes one row per chunk
    (``part`` from 0, ``content``), so every byte is kept whatever the size.
    """
    from strata.sources.files import spread

    content = spread(failed.select("source_uri")).mapInArrow(_file_parts, "source_uri string, part int, content binary")
    out = failed.join(content, on="source_uri", how="left")
    (
        out.write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy("source_date", "source_file")
        .parquet(f"{quarantine_path.rstrip('/')}/files")
    )


def write_silver(
    silver: DataFrame,
    silver_path: str,
    batch_dates: DataFrame | None = None,
    overwrite: str = "partition",
) -> None:
    """K6: parquet partitioned by SourceDate, dynamic partition overwrite.

    ``overwrite="partition"`` replaces every date partition the batch touches
    (parity). With ``batch_dates`` (one ``source_date`` per file of the batch)
    it first checks that every touched date belongs to the batch, so a stray
    row of another day cannot wipe that day (SURVEY §8.9).
    ``overwrite="merge"`` replaces this batch's SourceFiles by
    ``silver_files.merge_by_file``: their old rows go from every date, rows of
    other files stay, and no row stops the run.
    """
    if batch_dates is not None and overwrite == "partition":
        # In-plan guard: a row whose date is not a date of the batch fails the
        # write job, and a failed dynamic-overwrite job commits nothing.
        dates = batch_dates.select(F.col("source_date").alias("_guard_date")).distinct().withColumn("_in_batch", F.lit(True))
        checked = silver.join(dates, silver["SourceDate"] == dates["_guard_date"], "left")
        ok = F.when(
            F.col("_in_batch").isNull(),
            F.raise_error(F.concat(F.lit("silver row of a date outside the batch: "), F.col("SourceDate").cast("string"))),
        ).otherwise(F.lit(True))
        silver = checked.filter(ok).select(*silver.columns)
    if overwrite == "merge":
        from strata.session import cut_lineage
        from strata.sinks.silver_files import merge_by_file

        silver = cut_lineage(silver, "silver")
        files = silver.select("SourceFile", F.lit(None).cast("date").alias("FileDate")).distinct()
        merge_by_file(silver, silver_path, files, keep_other_files=True)
        return
    (
        silver.hint("rebalance", "SourceDate")
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy("SourceDate")
        .parquet(silver_path)
    )


def write_daily_files(prepared: DataFrame, out_dir: str, provider_id: str) -> None:
    """K1: the prepared source as CSV, one folder per date
    (``<provider>/source_date=YYYY-MM-DD/part-*.csv``); a hot date is split into
    several part files by AQE's rebalance."""
    df = prepared.withColumn("source_date", F.date_format("InvoiceDate", "yyyy-MM-dd")).withColumn(
        "InvoiceDate", F.date_format("InvoiceDate", "yyyy-MM-dd HH:mm:ss")
    )
    (
        df.select(*RAW_COLUMNS, "source_date")
        .hint("rebalance", "source_date")
        .write.mode("overwrite")
        .option("header", "true")
        .option("escape", '"')
        .option("ignoreLeadingWhiteSpace", "false")
        .option("ignoreTrailingWhiteSpace", "false")
        .partitionBy("source_date")
        .csv(f"{out_dir.rstrip('/')}/{provider_id}")
    )


def write_manifest(manifest: DataFrame, path: str) -> None:
    """K2: the manifest as one CSV file (one row per data file: small)."""
    manifest.coalesce(1).write.mode("overwrite").option("header", "true").csv(path)


def append_state(rows: DataFrame, state_path: str) -> None:
    """Append state rows to the append-only state log (parquet)."""
    rows.write.mode("append").parquet(state_path)

"""Silver merged by file: a re-delivery rewrites the partitions that its old and new rows touch.

Silver is partitioned by the date of its rows, but files are what is delivered
again. A line can carry another day's date (a stray row), and a file that is
delivered again can move rows to other dates. Replacing the partitions of the
new rows alone would leave the moved rows' old copies, and would wipe what other
files have there.

Beside the table lies an index: per file its own date, the dates that its rows
are in, and a version; the newest version counts. A merge

1. appends an entry with the old and the possible new dates of its files (so that a run
   which fails half-way is known to have touched them),
2. writes the rows of the known dates in one pass, together with the other
   files' rows there (looked up in the index; as a rule there are none, and
   nothing is read back), counting rows of unknown dates on that pass,
3. if there were any, writes those dates in the same way,
4. removes dates that no row is left in, and appends the entries as they are now.

Run again after any failure, it gives the same table.
"""

from __future__ import annotations

import time

from py4j.protocol import Py4JJavaError
from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from strata.session import cut_lineage, shuffles_removed
from strata.sinks.writers import clear_partitions, path_exists

INDEX_DDL = "SourceFile string, FileDate date, dates array<date>, version bigint"


def index_path(silver_path: str) -> str:
    return f"{silver_path.rstrip('/')}_files"


def file_index(spark: SparkSession, silver_path: str) -> DataFrame:
    """(SourceFile, FileDate, dates): the newest entry of each file with rows; built from the table where there is no index yet."""
    path = index_path(silver_path)
    if path_exists(spark, path):
        log = spark.read.schema(INDEX_DDL).parquet(path)
        newest = log.groupBy("SourceFile").agg(F.max(F.struct("version", "FileDate", "dates")).alias("e"))
        return newest.select("SourceFile", "e.FileDate", "e.dates").where(F.size("dates") > 0)
    if path_exists(spark, silver_path):
        pairs = _table(spark, silver_path, "SourceFile string, SourceDate date").groupBy("SourceFile").agg(F.collect_set("SourceDate").alias("dates"))
        return pairs.select("SourceFile", F.lit(None).cast("date").alias("FileDate"), "dates")
    return spark.createDataFrame([], "SourceFile string, FileDate date, dates array<date>")


def _table(spark: SparkSession, silver_path: str, schema) -> DataFrame:
    """The table, also where no row has been written yet."""
    return spark.read.schema(schema).parquet(silver_path)


def compact_index(spark: SparkSession, silver_path: str) -> int:
    """Rewrites the index as its newest entries; returns their number."""
    entries = cut_lineage(file_index(spark, silver_path).withColumn("version", F.lit(time.time_ns())), "silver-index")
    entries.write.mode("overwrite").parquet(index_path(silver_path))
    return entries.count()


def _append(entries: DataFrame, silver_path: str) -> None:
    rows = entries.select("SourceFile", "FileDate", "dates", F.lit(time.time_ns()).alias("version"))
    rows.coalesce(8).write.mode("append").parquet(index_path(silver_path))


def _write(rows: DataFrame, silver_path: str) -> None:
    with shuffles_removed(rows.sparkSession):
        (
            rows.write.mode("overwrite")
            .option("partitionOverwriteMode", "dynamic")
            .option("compression", "zstd")  # masked ids are hex digests, which snappy leaves as they are
            .partitionBy("SourceDate")
            .parquet(silver_path)
        )


def _others(spark: SparkSession, silver_path: str, placed: DataFrame, dates: DataFrame, schema) -> DataFrame | None:
    """Rows in ``dates`` of the files in ``placed`` (SourceFile, SourceDate), staged; None where there are none."""
    wanted = cut_lineage(placed.join(dates, "SourceDate", "left_semi"), "kept-files")
    if wanted.isEmpty():
        return None
    # Only the dates that other files are in are read (partition pruning by the joined dates).
    touched = [r[0] for r in wanted.select("SourceDate").distinct().collect()]
    table = _table(spark, silver_path, schema).where(F.col("SourceDate").isin(touched))
    return cut_lineage(table.join(wanted, ["SourceFile", "SourceDate"], "left_semi").select(*schema.names), "kept-rows")


def merge_by_file(silver: DataFrame, silver_path: str, files: DataFrame, keep_other_files: bool = False, clustered: bool = False) -> dict:
    """Replaces the rows of ``files`` (SourceFile, FileDate) by those of ``silver``.

    ``files`` names every file of the batch, also those without a row left. Other
    files' rows stay, on whatever date. The one exception, unless
    ``keep_other_files``: a file that belongs to a day of the batch (its FileDate, or its rows' date
    where that is unknown) and is not in the batch is gone from the source, and
    its rows in that day go with it (the batch is then the whole day).
    ``clustered``: a file's rows lie in few tasks already, and are written from there.
    Returns {"stray_rows", "dates", "cleared_dates"}.
    """
    spark = silver.sparkSession
    columns = silver.columns
    files = cut_lineage(files.select("SourceFile", F.col("FileDate").cast("date").alias("FileDate")).distinct(), "batch-files")
    index = cut_lineage(file_index(spark, silver_path), "silver-index")
    placed = index.select("SourceFile", "FileDate", F.explode("dates").alias("SourceDate"))
    mine = placed.join(files.select("SourceFile"), "SourceFile", "left_semi")
    others = placed.join(files.select("SourceFile"), "SourceFile", "left_anti")
    days = files.select(F.col("FileDate").alias("day")).where("day is not null").distinct()
    if not keep_other_files:
        home = F.coalesce("FileDate", "SourceDate")
        gone = others.where(home == F.col("SourceDate")).join(days, F.col("SourceDate") == F.col("day"), "left_semi")
        others = others.join(gone.select("SourceFile", "SourceDate"), ["SourceFile", "SourceDate"], "left_anti")
    else:
        gone = others.limit(0)
    others = others.select("SourceFile", "SourceDate")
    known = cut_lineage(
        days.select(F.col("day").alias("SourceDate")).unionByName(mine.select("SourceDate")).distinct(), "silver-dates"
    )

    # 1: what the run may touch, before it touches anything.
    old = mine.groupBy("SourceFile").agg(F.collect_set("SourceDate").alias("old"))
    before = files.join(old, "SourceFile", "left").select(
        "SourceFile", "FileDate", F.array_compact(F.array_union(F.coalesce("old", F.array().cast("array<date>")), F.array("FileDate"))).alias("dates")
    )
    _append(cut_lineage(before, "index-entries"), silver_path)

    known_dates = [r[0] for r in known.collect()]
    old_files = None
    if path_exists(spark, silver_path):
        table = _table(spark, silver_path, silver.schema).where(F.col("SourceDate").isin(known_dates))
        old_files = cut_lineage(table.select(F.col("_metadata.file_path").alias("path")).distinct(), "old-files")

    # 2: the known dates in one pass, with the other files' rows there.
    seen = Observation()
    # The dates of the batch: a small table, broadcast by Spark where it is small.
    marked = silver.join(known.withColumn("_known", F.lit(True)), "SourceDate", "left")
    marked = marked.observe(seen, F.count_if(F.col("_known").isNull()).alias("stray"))
    rows = marked.where(F.col("_known")).select(*columns)
    kept = _others(spark, silver_path, others, known, silver.schema)
    rows = rows if kept is None else rows.unionByName(kept)
    _write(rows if clustered and kept is None else rows.hint("rebalance", "SourceDate"), silver_path)

    # 3: rows of other dates, which the first pass counted.
    try:
        stray_rows = int(seen.get["stray"] or 0)
    except Py4JJavaError:  # a plan that Spark folds to no rows observes nothing
        stray_rows = silver.join(known, "SourceDate", "left_anti").count()
    touched = known
    if stray_rows:
        strays = cut_lineage(silver.join(known, "SourceDate", "left_anti").select(*columns), "stray-rows")
        dates = strays.select("SourceDate").distinct()
        intent = strays.groupBy("SourceFile").agg(F.collect_set("SourceDate").alias("stray"))
        ahead = before.join(intent, "SourceFile", "left").select(
            "SourceFile", "FileDate", F.array_union("dates", F.coalesce("stray", F.array().cast("array<date>"))).alias("dates")
        )
        _append(cut_lineage(ahead, "index-entries"), silver_path)
        kept = _others(spark, silver_path, others, dates, silver.schema)
        strays = strays if kept is None else strays.unionByName(kept)
        _write(strays.hint("rebalance", "SourceDate"), silver_path)
        touched = known.unionByName(dates).where("SourceDate is not null")

    # 4: the entries as they are now (two columns of the written dates). A date whose files are
    # still the old ones got no row: none is left in it.
    now_in = [r[0] for r in touched.collect()]
    written = _table(spark, silver_path, silver.schema).where(F.col("SourceDate").isin(now_in))
    written = written.select("SourceFile", "SourceDate", F.col("_metadata.file_path").alias("path")).distinct()
    if old_files is not None:
        written = written.join(old_files, "path", "left_anti")
    pairs = cut_lineage(written.select("SourceFile", "SourceDate").distinct(), "silver-pairs")
    held = pairs.join(files.select("SourceFile"), "SourceFile", "left_semi")
    left = {r[0] for r in pairs.select("SourceDate").distinct().collect()}
    cleared = [d for d in known_dates if d not in left]
    clear_partitions(spark, silver_path, [f"SourceDate={d}" for d in cleared])
    after = held.groupBy("SourceFile").agg(F.collect_set("SourceDate").alias("dates"))
    after = files.join(after, "SourceFile", "left").select("SourceFile", "FileDate", F.coalesce("dates", F.array().cast("array<date>")).alias("dates"))
    lost = gone.groupBy("SourceFile").agg(F.max("FileDate").alias("FileDate"), F.collect_set("SourceDate").alias("out"))
    lost = index.join(lost.select("SourceFile", "out"), "SourceFile").select("SourceFile", "FileDate", F.array_except("dates", "out").alias("dates"))
    _append(cut_lineage(after.unionByName(lost), "index-entries"), silver_path)
    return {"stray_rows": stray_rows, "dates": len(left), "cleared_dates": len(cleared)}

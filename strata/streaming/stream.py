"""Structured Streaming variants of intake and late-data handling (SURVEY §2.10
W7-W9, §8.11, §8.17).

* ``stream_lines``: raw CSV files as a file stream (all-string schema,
  ``maxFilesPerTrigger``), each micro-batch handled by the same batch
  functions through ``foreachBatch``.
* ``dedup_stream``: event-time watermark + ``dropDuplicatesWithinWatermark``.
  Unlike the batch lookback (which re-reads the whole window), a watermark
  drops rows older than (max event time seen - delay); the number dropped is
  reported by the query progress (``numRowsDroppedByWatermark``).

``stream_lines`` is Spark's file source, which tracks paths: a replaced file is
not seen again. ``ingest_stream`` has a source of its own that also compares length and
modification time, so re-deliveries are taken as in the batch job.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from strata.schemas import RAW_COLUMNS


def stream_lines(spark: SparkSession, raw_path: str, max_files_per_trigger: int = 1) -> DataFrame:
    """Raw CSV files as a stream of all-string lines with their file path."""
    schema = ", ".join(f"{c} string" for c in RAW_COLUMNS)
    return (
        spark.readStream.schema(schema)
        .option("header", "true")
        .option("escape", '"')
        .option("maxFilesPerTrigger", max_files_per_trigger)
        .option("pathGlobFilter", "*.csv")
        .csv(raw_path)
        .withColumn("source_uri", F.col("_metadata.file_path"))
    )


def dedup_stream(
    df: DataFrame,
    keys: Sequence[str],
    ts_col: str,
    delay: str = "1440 minutes",
) -> DataFrame:
    """W7 streaming: dedup within the watermark (event time as TIMESTAMP)."""
    df = df.withColumn(ts_col, F.col(ts_col).cast("timestamp"))
    return df.withWatermark(ts_col, delay).dropDuplicatesWithinWatermark(list(keys))


def run_available_now(
    df: DataFrame,
    checkpoint: str,
    sink_path: str | None = None,
    handler: Callable[[DataFrame, int], None] | None = None,
    fmt: str = "parquet",
) -> StreamingQuery:
    """W9 streaming: process everything available now in micro-batches, then stop.

    Either append to ``sink_path`` (exactly-once through the checkpoint) or call
    ``handler(batch_df, epoch_id)`` per micro-batch (``foreachBatch``), which
    lets the batch operators (rules, sinks, state) run unchanged.
    """
    w = df.writeStream.option("checkpointLocation", checkpoint).trigger(availableNow=True)
    if handler is not None:
        q = w.foreachBatch(handler).start()
    else:
        q = w.format(fmt).outputMode("append").start(sink_path)
    q.awaitTermination()
    return q


def dropped_by_watermark(q: StreamingQuery) -> int:
    """Rows the watermark dropped over the query's recent progress."""
    total = 0
    for p in q.recentProgress:
        for op in p.get("stateOperators", []):
            total += int(op.get("numRowsDroppedByWatermark", 0))
    return total


def ingest_stream(
    spark: SparkSession,
    raw_path: str,
    bronze_path: str,
    quarantine_path: str,
    checkpoint: str,
    max_files_per_trigger: int = 1,
    state_path: str | None = None,
    provider_id: str = "provider_retail",
    level: str = "exact_set",
) -> StreamingQuery:
    """W9 as a stream: the new raw files of a micro-batch go through ``ingest_batch``.

    Only paths, sizes and times are streamed (``sources.file_feed``), so the job of a
    micro-batch lists nothing; a file that is delivered again under its path
    (another length or modification time) is taken again. Headers, column order,
    file identity, verdicts and state are those of the batch job. Files without a
    date in their name or folder are not taken. The checkpoint makes the intake
    restartable, and the state (default: beside bronze) makes a repeated
    micro-batch change nothing.
    """
    from strata.plans.ingest import ingest_batch
    from strata.session import cut_lineage, ship_package
    from strata.sources.file_feed import FORMAT, FileFeed

    ship_package(spark)
    spark.dataSource.register(FileFeed)
    paths = (
        spark.readStream.format(FORMAT)
        .option("path", raw_path)
        .option("log", f"{checkpoint.rstrip('/')}_files")
        .option("maxFiles", max_files_per_trigger)
        .load()
    )
    states = state_path or f"{bronze_path.rstrip('/')}_state"
    taken: list[int] = []

    def handle(batch: DataFrame, epoch_id: int) -> None:
        listing = cut_lineage(batch.distinct(), "stream-files")
        if listing.isEmpty():
            return
        taken.append(epoch_id)
        ingest_batch(
            spark, raw_path, bronze_path, quarantine_path, states, provider_id=provider_id,
            run_id=f"stream-{epoch_id}", level=level, date_from="either", listing=listing,
        )

    # A run takes what was there when it began, one version of the listing; more until nothing is new.
    while True:
        before = len(taken)
        query = run_available_now(paths, checkpoint, handler=handle)
        if len(taken) == before:
            return query

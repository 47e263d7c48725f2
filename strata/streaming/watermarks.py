"""Watermarks per provider in a stream.

Spark's own watermark is one value for a whole query. Here every provider has its
row of the ingestion state, as in the batch job: a micro-batch starts a run for its
providers, cuts each provider's rows by that provider's window (watermark less
lookback, up to the newest row), hands both parts to the job, and completes the
runs. Only then do the providers' watermarks move. A run that fails is FAILED
with the watermark where it was, and the micro-batch comes again.

The state of micro-batch n is one folder ``epoch_n`` with one row per provider of
that micro-batch: RUNNING, then replaced by FAILED or SUCCESS. Windows are cut by
the state *before* the epoch, so a micro-batch that runs again, whether it failed
or was done but not yet committed by Spark, has the same windows and rows.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from strata.operators import state as st
from strata.operators.incremental import event_bounds, processing_window
from strata.schemas import INGESTION_STATE_KEYS, INGESTION_STATE_SCHEMA
from strata.session import cut_lineage
from strata.sinks.writers import path_exists
from strata.streaming.stream import run_available_now


def ingestion_log(spark: SparkSession, state_path: str, before: int | None = None) -> DataFrame:
    """The newest state per (provider_id, layer) of the stream's log, of the epochs below ``before`` if given."""
    schema = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in INGESTION_STATE_SCHEMA.fields) + ", epoch bigint"
    if not path_exists(spark, state_path):
        return spark.createDataFrame([], schema).drop("epoch")
    log = spark.read.schema(schema).option("recursiveFileLookup", "true").parquet(state_path)
    if before is not None:
        log = log.where(F.col("epoch") < before)
    return st.latest(log, INGESTION_STATE_KEYS, order=("epoch",)).drop("epoch")


def _states(spark: SparkSession, state_path: str, epoch: int, initial: DataFrame | None, providers: DataFrame, layer: str, lookback_minutes: int) -> DataFrame:
    """State rows of ``providers`` before ``epoch``: from the log, else from ``initial``, else NEVER_RUN."""
    columns = INGESTION_STATE_SCHEMA.names
    known = ingestion_log(spark, state_path, before=epoch).select(*columns, F.lit(2).alias("rank"))
    if initial is not None:
        known = known.unionByName(initial.select(*columns, F.lit(1).alias("rank")))
    seeded = st.seed_state(providers, layer=layer, lookback_minutes=lookback_minutes)
    known = known.where(F.col("layer") == layer).unionByName(seeded.select(*columns, F.lit(0).alias("rank")))
    best = st.latest(known, INGESTION_STATE_KEYS, order=("rank",)).drop("rank")
    return best.join(providers, "provider_id", "left_semi")


def _write(rows: DataFrame, state_path: str, epoch: int) -> None:
    out = rows.select(*INGESTION_STATE_SCHEMA.names, F.lit(epoch).cast("bigint").alias("epoch"))
    cut_lineage(out, "ingestion-state").coalesce(1).write.mode("overwrite").parquet(f"{state_path.rstrip('/')}/epoch_{epoch:09d}")


def window_stream(
    stream: DataFrame,
    state_path: str,
    checkpoint: str,
    handler: Callable[[DataFrame, DataFrame, int], None],
    provider_col: str = "provider_id",
    ts_col: str = "InvoiceDate",
    layer: str = "SILVER",
    name: str = "stream",
    initial: DataFrame | None = None,
    lookback_minutes: int = st.DEFAULT_LOOKBACK_MINUTES,
) -> StreamingQuery:
    """Runs ``handler(inside, behind, epoch)`` per micro-batch under a run of each of its providers.

    ``inside``: the rows in their provider's window [watermark - lookback, newest row]
    (all of them for a provider that has never run). ``behind``: rows below it,
    and rows without an event time. Rows without a provider are a provider of
    their own, the empty name. The handler's writes must replace what an earlier
    try of the same epoch wrote. ``initial`` are ingestion states to go on
    from (as the batch job leaves them); a provider that is RUNNING there is held by
    another run and stops the query before anything is written.
    """
    spark = stream.sparkSession
    columns = stream.columns

    def handle(batch: DataFrame, epoch: int) -> None:
        run_id = f"{name}-{epoch}"
        typed = batch.withColumn(ts_col, F.col(ts_col).cast("timestamp"))
        rows = cut_lineage(typed.withColumn("_provider", F.coalesce(F.col(provider_col).cast("string"), F.lit(""))), "stream-rows")
        bounds = cut_lineage(event_bounds(rows, ts_col, by=["_provider"]).withColumnRenamed("_provider", "provider_id"), "stream-bounds")
        providers = bounds.select("provider_id")
        state = cut_lineage(_states(spark, state_path, epoch, initial, providers, layer, lookback_minutes), "stream-state")
        requests = state.select(*INGESTION_STATE_KEYS, F.lit(run_id).alias("run_id"))
        started = cut_lineage(st.start_runs(state, requests), "stream-started")
        held = started.where(~F.col("lock_acquired")).select("provider_id", "last_run_id").limit(5).collect()
        if held:
            raise RuntimeError(f"providers with a run of their own: {[tuple(r) for r in held]}")
        started = started.drop("lock_acquired")
        _write(started, state_path, epoch)

        window = processing_window(state, bounds, by=["provider_id"]).select(F.col("provider_id").alias("_provider"), "lower_bound", "upper_bound")
        placed = rows.join(window, "_provider", "left")
        is_in = F.coalesce(F.col(ts_col).between(F.col("lower_bound"), F.col("upper_bound")), F.lit(False))
        outcome = requests.join(bounds.select("provider_id", F.col("max_available_event_time").alias("max_event_time")), "provider_id")
        try:
            handler(placed.where(is_in).select(*columns), placed.where(~is_in).select(*columns), epoch)
        except Exception:
            _write(st.complete_runs(started, outcome.withColumn("succeeded", F.lit(False))), state_path, epoch)
            raise
        _write(st.complete_runs(started, outcome.withColumn("succeeded", F.lit(True))), state_path, epoch)

    return run_available_now(stream, checkpoint, handler=handle)

"""Keyed state as DataFrames.

There is no MERGE-capable table format here, so state is an append-only log of
full rows; the current state is the newest row per key (``latest``), and the
DML statements of the reference become pure functions
``(current state, changes, now) -> rows``. Writing the result is the caller's
job (``sinks.writers.append_state``).
"""

from __future__ import annotations

import datetime as _dt
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from strata.functions.expr import truncate_text, ts_literal
from strata.schemas import FILE_STATE_KEYS, FILE_STATE_SCHEMA, INGESTION_STATE_KEYS, INGESTION_STATE_SCHEMA

# ---- fixed values: file statuses and ingestion-run statuses ----
PROCESSING = "PROCESSING"
SUCCESS = "SUCCESS"
FILE_VALIDATION_FAILED = "FILE_VALIDATION_FAILED"
FAILED = "FAILED"
RUNNING = "RUNNING"
NEVER_RUN = "NEVER_RUN"
DEFAULT_LOOKBACK_MINUTES = 1440
EPOCH = _dt.datetime(1970, 1, 1, 0, 0, 0)

# ---- fixed values: file status machine (from status, event, to status) ----
# ``None`` as from-status means "any". A file-validation failure is never
# overwritten by a generic failure of the same run.
TRANSITIONS = [
    (None, "start", PROCESSING),
    (PROCESSING, "validated", SUCCESS),
    (PROCESSING, "file_invalid", FILE_VALIDATION_FAILED),
    (PROCESSING, "error", FAILED),
    (FILE_VALIDATION_FAILED, "error", FILE_VALIDATION_FAILED),
]


def _ts(now) -> Column:
    if now is None:
        return F.current_timestamp()
    if isinstance(now, Column):
        return now
    return ts_literal(now)


def latest(
    log: DataFrame,
    keys: Sequence[str] = FILE_STATE_KEYS,
    order: Sequence[str] = ("updated_at", "run_id"),
) -> DataFrame:
    """W1 for all keys at once: the newest row per key (``order`` descending, NULLs last).

    Planned as ``max(struct(order..., rest...))`` per key: a partial aggregate
    runs before the shuffle, so a key holding a third of the log is reduced
    map-side instead of being sorted in one task.
    """
    rest = [c for c in log.columns if c not in keys and c not in order]
    packed = F.max(F.struct(*[F.col(c) for c in order], *[F.col(c) for c in rest])).alias("_m")
    agg = log.groupBy(*keys).agg(packed)
    return agg.select(*[F.col(c) if c in keys else F.col(f"_m.{c}").alias(c) for c in log.columns])


def empty_file_state(spark) -> DataFrame:
    return spark.createDataFrame([], FILE_STATE_SCHEMA)


def _key_join(target: DataFrame, source: DataFrame, keys: Sequence[str], how: str) -> DataFrame:
    t = target.select(*[F.col(c).alias(f"t_{c}") for c in target.columns])
    s = source.select(*[F.col(c).alias(f"s_{c}") for c in source.columns])
    cond = [F.col(f"t_{k}").eqNullSafe(F.col(f"s_{k}")) for k in keys]
    return t.join(s, on=cond, how=how)


def merge_state(
    target: DataFrame,
    source: DataFrame,
    now: _dt.datetime | Column | None = None,
    keys: Sequence[str] = FILE_STATE_KEYS,
    changes_only: bool = False,
) -> DataFrame:
    """M1/J3 (upsert to PROCESSING or the given status).

    ``source``: provider_id, source_uri, source_file, source_date, source_checksum,
    status, run_id -- one row per key. Matched keys get status, run_id,
    last_processed_at and updated_at (counts and error stay); new keys are
    inserted with NULL counts/error and all four times = now. Keys only in the
    target pass through unchanged unless ``changes_only``.
    """
    ts = _ts(now)
    j = _key_join(target, source, keys, "right" if changes_only else "full_outer")
    matched = F.col(f"t_{keys[0]}").isNotNull()
    has_src = F.col(f"s_{keys[0]}").isNotNull()

    def pick(col: str) -> Column:
        t, s = F.col(f"t_{col}"), F.col(f"s_{col}") if col in source.columns else None
        if col in keys:
            return F.coalesce(t, s)
        if col in ("status", "run_id"):
            return F.when(has_src, s).otherwise(t)
        if col in ("last_processed_at", "updated_at"):
            return F.when(has_src, ts).otherwise(t)
        if col in ("first_processed_at", "created_at"):
            return F.when(matched, t).otherwise(ts)
        if col in ("source_file", "source_date"):
            return F.when(matched, t).otherwise(s)
        # counts and error: kept on match, NULL on insert
        return F.when(matched, t).otherwise(F.lit(None).cast(FILE_STATE_SCHEMA[col].dataType))

    return j.select(*[pick(c).cast(FILE_STATE_SCHEMA[c].dataType).alias(c) for c in FILE_STATE_SCHEMA.names])


UPDATE_FIELDS = ["status", "run_id", "record_count", "valid_record_count", "rejected_record_count", "error_message"]


def normalize_updates(changes: DataFrame, keys: Sequence[str] = FILE_STATE_KEYS) -> DataFrame:
    """Absent update arguments become NULL columns (as the reference's UPDATE does);
    the error text is cut to 1000 characters (P14)."""
    cols = [F.col(k) for k in keys]
    for f in UPDATE_FIELDS:
        dtype = FILE_STATE_SCHEMA[f].dataType
        c = F.col(f).cast(dtype) if f in changes.columns else F.lit(None).cast(dtype)
        if f == "error_message":
            c = truncate_text(c, 1000)
        cols.append(c.alias(f))
    return changes.select(*cols)


def update_state(
    target: DataFrame,
    changes: DataFrame,
    now: _dt.datetime | Column | None = None,
    keys: Sequence[str] = FILE_STATE_KEYS,
    changes_only: bool = False,
) -> DataFrame:
    """M2: overwrite status, run_id, the three counts and the error of matched keys
    (absent arguments become NULL), last_processed_at/updated_at = now.
    Changes without a matching key change nothing (see ``affected_rows``)."""
    ts = _ts(now)
    ch = normalize_updates(changes, keys)
    j = _key_join(target, ch, keys, "inner" if changes_only else "left")
    hit = F.col(f"s_{keys[0]}").isNotNull()

    def pick(col: str) -> Column:
        if col in UPDATE_FIELDS:
            return F.when(hit, F.col(f"s_{col}")).otherwise(F.col(f"t_{col}"))
        if col in ("last_processed_at", "updated_at"):
            return F.when(hit, ts).otherwise(F.col(f"t_{col}"))
        return F.col(f"t_{col}")

    return j.select(*[pick(c).cast(FILE_STATE_SCHEMA[c].dataType).alias(c) for c in FILE_STATE_SCHEMA.names])


def affected_rows(target: DataFrame, changes: DataFrame, keys: Sequence[str] = FILE_STATE_KEYS) -> DataFrame:
    """Per change: how many target rows it matches (must be exactly one)."""
    counts = target.groupBy(*keys).agg(F.count(F.lit(1)).alias("affected_rows"))
    return changes.select(*keys).join(counts, on=list(keys), how="left").select(
        *keys, F.coalesce(F.col("affected_rows"), F.lit(0)).alias("affected_rows")
    )


def assert_single_match(target: DataFrame, changes: DataFrame, keys: Sequence[str] = FILE_STATE_KEYS) -> None:
    """Raise unless every change matches exactly one row (an action; small result)."""
    bad = affected_rows(target, changes, keys).filter(F.col("affected_rows") != 1).limit(5).collect()
    if bad:
        raise RuntimeError(f"Expected exactly one state row per change; got {[tuple(r) for r in bad]}")


def transitions(spark) -> DataFrame:
    """M3: the status machine as a DataFrame (from_status NULL = any)."""
    return spark.createDataFrame(TRANSITIONS, "from_status string, event string, to_status string")


def apply_events(current: DataFrame, events: DataFrame, keys: Sequence[str] = FILE_STATE_KEYS) -> DataFrame:
    """M3: next status per key from (keys, event) rows; unknown transitions keep the status."""
    tr = transitions(current.sparkSession)
    cur = current.select(*keys, F.col("status").alias("from_status"))
    j = events.join(cur, on=list(keys), how="left")
    exact = tr.filter(F.col("from_status").isNotNull()).withColumnRenamed("to_status", "_exact")
    anyf = tr.filter(F.col("from_status").isNull()).drop("from_status").withColumnRenamed("to_status", "_any")
    j = j.join(F.broadcast(exact), on=["from_status", "event"], how="left").join(F.broadcast(anyf), on="event", how="left")
    return j.select(*keys, "event", "from_status", F.coalesce("_exact", "_any", "from_status").alias("status"))


def pending(
    files: DataFrame,
    state_log: DataFrame,
    keys: Sequence[str] = FILE_STATE_KEYS,
) -> DataFrame:
    """Each discovered file with the decision SKIP (newest state SUCCESS) or
    PROCESS (any other status, or no state) and the reason."""
    cur = latest(state_log, keys).select(*keys, F.col("status").alias("state_status"))
    j = files.join(cur, on=list(keys), how="left")
    return j.withColumn(
        "action", F.when(F.col("state_status") == SUCCESS, F.lit("SKIP")).otherwise(F.lit("PROCESS"))
    ).withColumn("reason", F.coalesce(F.col("state_status"), F.lit("NEW")))


# ------------------------------------------------------------ ingestion state


def seed_state(
    providers: DataFrame,
    layer: str = "SILVER",
    now: _dt.datetime | Column | None = None,
    lookback_minutes: int = DEFAULT_LOOKBACK_MINUTES,
) -> DataFrame:
    """M7: one NEVER_RUN row per provider (epoch watermark, 1440-minute lookback)."""
    ts = _ts(now)
    return providers.select(
        F.col("provider_id").cast("string"),
        F.lit(layer).alias("layer"),
        ts_literal(EPOCH).alias("last_processed_event_time"),
        ts_literal(EPOCH).alias("max_event_time_seen"),
        F.lit(lookback_minutes).cast("bigint").alias("lookback_minutes"),
        F.lit(NEVER_RUN).alias("last_run_status"),
        F.lit(None).cast("string").alias("last_run_id"),
        F.lit(None).cast("timestamp").alias("last_run_time"),
        ts.alias("updated_at"),
    )


def _ing_join(state: DataFrame, runs: DataFrame) -> DataFrame:
    r = runs.select(*INGESTION_STATE_KEYS, *[F.col(c).alias(f"r_{c}") for c in runs.columns if c not in INGESTION_STATE_KEYS])
    return state.join(r, on=INGESTION_STATE_KEYS, how="left")


def start_runs(state: DataFrame, runs: DataFrame, now=None) -> DataFrame:
    """M4: for each (provider_id, layer, run_id) request set RUNNING unless the row is
    already RUNNING. ``lock_acquired`` tells which requests took effect (the
    reference raises when the affected count is not one)."""
    ts = _ts(now)
    j = _ing_join(state, runs.select(*INGESTION_STATE_KEYS, "run_id"))
    take = F.col("r_run_id").isNotNull() & (F.col("last_run_status") != RUNNING)
    out = j.select(
        *INGESTION_STATE_KEYS,
        "last_processed_event_time",
        "max_event_time_seen",
        "lookback_minutes",
        F.when(take, F.lit(RUNNING)).otherwise(F.col("last_run_status")).alias("last_run_status"),
        F.when(take, F.col("r_run_id")).otherwise(F.col("last_run_id")).alias("last_run_id"),
        F.when(take, ts).otherwise(F.col("last_run_time")).alias("last_run_time"),
        F.when(take, ts).otherwise(F.col("updated_at")).alias("updated_at"),
        F.when(F.col("r_run_id").isNotNull(), take).alias("lock_acquired"),
    )
    return out


def complete_runs(state: DataFrame, runs: DataFrame, now=None, monotonic: bool = True) -> DataFrame:
    """``runs`` has provider_id, layer, run_id, succeeded (bool),
    max_event_time (timestamp, for successes). Only rows whose last_run_id is
    the run change. Success moves both event-time columns to ``max_event_time``
    (``greatest`` with the old value when ``monotonic``; the reference allows
    moving back) and sets SUCCESS; failure sets FAILED and keeps the watermark."""
    ts = _ts(now)
    j = _ing_join(state, runs.select(*INGESTION_STATE_KEYS, "run_id", "succeeded", "max_event_time"))
    mine = F.col("r_run_id").isNotNull() & (F.col("last_run_id") == F.col("r_run_id"))
    ok = mine & F.col("r_succeeded")
    fail = mine & ~F.col("r_succeeded")
    new_wm = F.greatest("last_processed_event_time", "r_max_event_time") if monotonic else F.col("r_max_event_time")
    new_seen = F.greatest("max_event_time_seen", "r_max_event_time") if monotonic else F.col("r_max_event_time")
    return j.select(
        *INGESTION_STATE_KEYS,
        F.when(ok, new_wm).otherwise(F.col("last_processed_event_time")).alias("last_processed_event_time"),
        F.when(ok, new_seen).otherwise(F.col("max_event_time_seen")).alias("max_event_time_seen"),
        "lookback_minutes",
        F.when(ok, F.lit(SUCCESS)).when(fail, F.lit(FAILED)).otherwise(F.col("last_run_status")).alias("last_run_status"),
        "last_run_id",
        F.when(mine, ts).otherwise(F.col("last_run_time")).alias("last_run_time"),
        F.when(mine, ts).otherwise(F.col("updated_at")).alias("updated_at"),
    )


def stale_runs(state: DataFrame, older_than: _dt.datetime | Column) -> DataFrame:
    """RUNNING rows whose run started before ``older_than`` (a RUNNING row never expires otherwise)."""
    return state.filter((F.col("last_run_status") == RUNNING) & (F.col("last_run_time") < _ts(older_than)))


def ingestion_state_columns() -> list[str]:
    return INGESTION_STATE_SCHEMA.names

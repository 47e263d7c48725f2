"""Counts, outcomes and audit rows.

All are aggregates over the flagged lines or per-file results; the single
audit rows are one-row aggregates joined by broadcast, never driver-side sums.
"""

from __future__ import annotations

import datetime as _dt

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from strata.functions.expr import ts_literal
from strata.plans.attach import attach_row

from strata.operators.rules import REASON_COL
from strata.schemas import REJECTION_AUDIT_COLUMNS

# ---- fixed values: file result statuses, reconciliation statuses ----
RECONCILED = "RECONCILED"
NOT_RECONCILED = "NOT_RECONCILED"


def _lit_ts(v) -> Column:
    if v is None:
        return F.current_timestamp()
    return ts_literal(v)


def validation_counts(flagged: DataFrame, by: str = "source_file") -> DataFrame:
    """A3: total, valid and rejected records per file (one partial aggregate)."""
    return flagged.groupBy(by).agg(
        F.count(F.lit(1)).alias("total_records"),
        F.count_if(F.col(REASON_COL) == "").alias("valid_records"),
        F.count_if(F.col(REASON_COL) != "").alias("rejected_records"),
    )


def file_results(verdicts: DataFrame, counts: DataFrame, by: str = "source_file") -> DataFrame:
    """V5 + A3: one row per file; a failed file verdict gives zero counts and its error.

    ``verdicts``: (by, file_valid, file_error); ``counts`` from ``validation_counts``.
    """
    j = verdicts.join(counts, on=by, how="left")
    ok = F.col("file_valid")
    zero = F.lit(0).cast("bigint")
    return j.select(
        F.col(by).alias("input_file"),
        F.when(ok, F.coalesce(F.col("total_records"), zero)).otherwise(zero).alias("total_records"),
        F.when(ok, F.coalesce(F.col("valid_records"), zero)).otherwise(zero).alias("valid_records"),
        F.when(ok, F.coalesce(F.col("rejected_records"), zero)).otherwise(zero).alias("rejected_records"),
        ok.alias("file_valid"),
        F.when(~ok, F.col("file_error")).alias("file_error"),
        F.when(ok, F.lit("SUCCESS")).otherwise(F.lit("FILE_VALIDATION_FAILED")).alias("status"),
    )


def batch_outcome(results: DataFrame) -> DataFrame:
    """Selected, successful and failed files of a batch."""
    return results.agg(
        F.count(F.lit(1)).alias("selected_files"),
        F.count_if(F.col("status") == "SUCCESS").alias("successful_files"),
        F.count_if(F.col("status") != "SUCCESS").alias("failed_files"),
    )


def rejection_audit(
    rejected: DataFrame,
    run_id: str,
    provider_id: str,
    environment: str,
    rejected_at: _dt.datetime | None = None,
    file_col: str = "source_file",
) -> DataFrame:
    """One row per (rejected record, failed rule); ``rejection_reason`` keeps the
    record's full reason string, ``record_number`` is carried when present."""
    extra = ["record_number"] if "record_number" in rejected.columns else []
    exploded = rejected.select(
        *extra,
        F.col(file_col).alias("source_file"),
        F.coalesce(F.col("InvoiceNo"), F.lit("UNKNOWN")).alias("record_identifier"),
        F.col(REASON_COL).alias("rejection_reason"),
        F.explode(F.split(F.col(REASON_COL), ";")).alias("rule_name"),
    )
    return exploded.select(
        F.lit(run_id).alias("run_id"),
        F.lit(provider_id).alias("provider_id"),
        "source_file",
        "record_identifier",
        "rule_name",
        "rejection_reason",
        _lit_ts(rejected_at).alias("rejected_at"),
        F.lit(environment).alias("environment"),
        *extra,
    ).select(*REJECTION_AUDIT_COLUMNS, *extra)


def run_counts(results: DataFrame, valid_lines: DataFrame, silver: DataFrame, ts_col: str = "InvoiceDate") -> DataFrame:
    """One row: file and record counts of a run plus the event-time span of its valid lines."""
    files = results.agg(
        F.count(F.lit(1)).alias("source_file_count"),
        F.sum("total_records").cast("bigint").alias("source_record_count"),
        F.sum("valid_records").cast("bigint").alias("valid_record_count"),
        F.sum("rejected_records").cast("bigint").alias("rejected_record_count"),
        F.count_if(F.col("status") != "SUCCESS").alias("failed_file_count"),
    )
    span = valid_lines.agg(F.min(ts_col).alias("watermark_start"), F.max(ts_col).alias("watermark_end"))
    target = silver.agg(F.count(F.lit(1)).alias("silver_record_count"))
    return attach_row(attach_row(files, span), target)


def run_audit(
    counts: DataFrame,
    run_id: str,
    pipeline_name: str,
    environment: str,
    provider_id: str,
    start_time: _dt.datetime,
    end_time: _dt.datetime | None = None,
    created_at: _dt.datetime | None = None,
) -> DataFrame:
    """A10: the pipeline_run_audit row from ``run_counts`` (SUCCESS when no file
    failed, else PARTIAL_SUCCESS; failed files are named in the error)."""
    status = F.when(F.col("failed_file_count") == 0, F.lit("SUCCESS")).otherwise(F.lit("PARTIAL_SUCCESS"))
    err = F.when(
        F.col("failed_file_count") > 0,
        F.concat(F.col("failed_file_count").cast("string"), F.lit(" file(s) failed file-level validation")),
    )
    return counts.select(
        F.lit(run_id).alias("run_id"),
        F.lit(pipeline_name).alias("pipeline_name"),
        F.lit(environment).alias("environment"),
        F.lit(provider_id).alias("provider_id"),
        _lit_ts(start_time).alias("start_time"),
        _lit_ts(end_time).alias("end_time"),
        status.alias("status"),
        "source_file_count",
        "source_record_count",
        "valid_record_count",
        "rejected_record_count",
        "silver_record_count",
        "watermark_start",
        "watermark_end",
        err.alias("error_message"),
        _lit_ts(created_at).alias("created_at"),
    )


def reconcile(
    counts: DataFrame,
    run_id: str,
    provider_id: str,
    at: _dt.datetime | None = None,
) -> DataFrame:
    """Source, read, valid, rejected, target (+ duplicate) counts and a status.

    ``counts`` columns: source_count, read_count, valid_count, rejected_count,
    duplicate_count, target_count. Reconciled when source = read =
    valid + rejected and target = valid - duplicates.
    """
    ok = (
        (F.col("source_count") == F.col("read_count"))
        & (F.col("read_count") == F.col("valid_count") + F.col("rejected_count"))
        & (F.col("target_count") == F.col("valid_count") - F.col("duplicate_count"))
    )
    return counts.select(
        F.lit(run_id).alias("run_id"),
        F.lit(provider_id).alias("provider_id"),
        *[F.col(c).cast("bigint").alias(c) for c in ("source_count", "read_count", "valid_count", "rejected_count", "target_count", "duplicate_count")],
        F.when(ok, F.lit(RECONCILED)).otherwise(F.lit(NOT_RECONCILED)).alias("reconciliation_status"),
        _lit_ts(at).alias("reconciliation_timestamp"),
    )

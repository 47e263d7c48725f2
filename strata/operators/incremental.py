"""Event-time window, late-data lookback and batch cut.

Bounds are computed as one-row DataFrames and applied with a join against that
single row (a broadcast of one row), so nothing goes through the driver.
``apply_window_literal`` is the variant for known bounds: it also adds the
``SourceDate`` range so partitioned silver tables are pruned (Catalyst does
not derive a date filter from a timestamp filter by itself).
"""

from __future__ import annotations

import datetime as _dt
from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from strata.functions.expr import ts_literal
from strata.plans.attach import attach_row

from strata.operators.state import NEVER_RUN
from strata.plans.numbering import number_rows


def event_bounds(lines: DataFrame, ts_col: str = "InvoiceDate", by: Sequence[str] = ()) -> DataFrame:
    """(min, max) event time, overall or per ``by`` group (partial aggregate, no sort)."""
    return lines.groupBy(*by).agg(
        F.min(ts_col).alias("min_available_event_time"), F.max(ts_col).alias("max_available_event_time")
    )


def processing_window(state: DataFrame, bounds: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """W2 per state row: lower = min available when NEVER_RUN or no watermark, else
    watermark - lookback minutes; upper = max available. ``lower > upper`` is an
    empty window. ``bounds`` is one row (or one per ``by`` key)."""
    # One row per key grows with the keys: AQE decides on broadcast by runtime size.
    j = state.join(bounds, on=list(by), how="left") if by else attach_row(state, bounds)
    wm = F.col("last_processed_event_time")
    lower = (
        F.when((F.col("last_run_status") == NEVER_RUN) | wm.isNull(), F.col("min_available_event_time"))
        .otherwise(wm - F.make_dt_interval(F.lit(0), F.lit(0), F.col("lookback_minutes").cast("int"), F.lit(0)))
    )
    return j.withColumn("lower_bound", lower).withColumn("upper_bound", F.col("max_available_event_time"))


def apply_window(lines: DataFrame, window: DataFrame, ts_col: str = "InvoiceDate", by: Sequence[str] = ()) -> DataFrame:
    """Rows inside [lower_bound, upper_bound] (closed at both ends); ``window`` is
    one row (broadcast) or one per ``by`` key (joined; AQE broadcasts it when small)."""
    w = window.select(*by, "lower_bound", "upper_bound")
    j = lines.join(w, on=list(by), how="inner") if by else attach_row(lines, w)
    return j.filter((F.col(ts_col) >= F.col("lower_bound")) & (F.col(ts_col) <= F.col("upper_bound"))).drop(
        "lower_bound", "upper_bound"
    )


def apply_window_literal(
    lines: DataFrame,
    lower: _dt.datetime,
    upper: _dt.datetime,
    ts_col: str = "InvoiceDate",
    date_col: str | None = "SourceDate",
) -> DataFrame:
    """W7 with known bounds: adds the partition-date range so the scan is pruned."""
    cond = (F.col(ts_col) >= ts_literal(lower)) & (F.col(ts_col) <= ts_literal(upper))
    if date_col and date_col in lines.columns:
        cond = cond & (F.col(date_col) >= F.lit(lower.date())) & (F.col(date_col) <= F.lit(upper.date()))
    return lines.filter(cond)


FILE_ORDER = ("source_date", "source_file", "source_uri")


def sort_files(files: DataFrame, order: Sequence[str] = FILE_ORDER) -> DataFrame:
    """Files sorted by (date, name, uri)."""
    return files.orderBy(*order)


def sequence_files(files: DataFrame, order: Sequence[str] = FILE_ORDER, out: str = "sequence") -> DataFrame:
    """1..n over the sorted file list, without a single-partition window."""
    return number_rows(files, [], list(order), out=out)


def take_batch(files: DataFrame, limit: int = 3, order: Sequence[str] = FILE_ORDER) -> DataFrame:
    """The first ``limit`` files in order (top-k; ``limit`` is the feature)."""
    return files.orderBy(*order).limit(limit)


def first_last(files: DataFrame, order: Sequence[str] = FILE_ORDER) -> DataFrame:
    """First and last file of the sorted list plus the count (one aggregate)."""
    key = F.struct(*[F.col(c) for c in order])
    return files.agg(
        F.count(F.lit(1)).alias("file_count"),
        F.min_by("source_file", key).alias("first_file"),
        F.max_by("source_file", key).alias("last_file"),
    )

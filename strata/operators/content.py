"""Reconciliation by content: multisets of rows compared through additive hashes.

Counts alone cannot tell a lost row and a doubled one from an untouched table.
The content of a set of rows is the sum of their 64-bit hashes modulo 2^64
beside their number: it does not depend on order or on how the rows lie in files
and tasks, partial sums add up (so it is one map-side combined aggregate, or an
``Observation`` on a pass that runs anyway), and contents of disjoint sets add.
A run is reconciled when what was read has the content of what was written,
the written side taken from the tables after the write.
"""

from __future__ import annotations

import datetime as _dt
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F
from pyspark.sql import types as T

from strata.functions.expr import ROW_HASH_TS_FORMAT, ts_literal
from strata.operators.audit import NOT_RECONCILED, RECONCILED

MODULUS = 1 << 64
_WIDE = "decimal(20,0)"


def row_content(df: DataFrame, columns: Sequence[str]) -> Column:
    """A row's 64-bit hash over the text of ``columns``; null differs from blank, and values do not run together.

    Timestamps count to the second and numbers by their string, so a row keeps
    its hash through a CSV file that is read back with the same types.
    """
    texts = []
    for c in columns:
        kind = df.schema[c].dataType
        v = F.date_format(F.col(c), ROW_HASH_TS_FORMAT) if isinstance(kind, (T.TimestampType, T.TimestampNTZType)) else F.col(c).cast("string")
        texts.append(F.coalesce(F.concat(F.length(v).cast("string"), F.lit(":"), v), F.lit("-")))
    return F.xxhash64(F.concat(*texts))


def content_sum(hashes: Column) -> Column:
    """Sum of row hashes, wide enough for any number of rows; ``modulo`` brings it to 64 bits."""
    return F.coalesce(F.sum(hashes.cast(_WIDE)), F.lit(0).cast("decimal(38,0)"))


def modulo(total: Column) -> Column:
    return F.pmod(total.cast("decimal(38,0)"), F.lit(str(MODULUS)).cast("decimal(38,0)")).cast(_WIDE)


def contents(df: DataFrame, columns: Sequence[str], by: Sequence[str] = ()) -> DataFrame:
    """Rows and content per group of ``by`` (one row for all without groups)."""
    return df.groupBy(*by).agg(F.count(F.lit(1)).alias("rows"), modulo(content_sum(row_content(df, columns))).alias("content"))


class ObservedContent:
    """Rows and content of a DataFrame, taken on the pass that consumes it."""

    def __init__(self) -> None:
        self._observation = Observation()

    def on(self, df: DataFrame, columns: Sequence[str]) -> DataFrame:
        return df.observe(self._observation, F.count(F.lit(1)).alias("rows"), content_sum(row_content(df, columns)).alias("content"))

    def result(self) -> tuple[int, int]:
        """(rows, content); waits for the pass to end. A stage that runs again may be counted twice."""
        got = self._observation.get
        return int(got["rows"]), int(got["content"]) % MODULUS


def compare_contents(expected: DataFrame, actual: DataFrame, by: Sequence[str]) -> DataFrame:
    """Per group: rows and content on both sides, a status and what differs.

    ``expected`` and ``actual`` are of ``contents``; groups of either side come
    out, nulls in ``by`` match. ``difference`` is null, ``rows lost``,
    ``rows added`` (a doubled row, or rows of a group that was not read) or
    ``rows altered`` (as many rows, other content).
    """
    e = expected.select(*[F.col(c).alias(f"_e{i}") for i, c in enumerate(by)], F.col("rows").alias("_er"), F.col("content").alias("_ec"))
    a = actual.select(*[F.col(c).alias(f"_a{i}") for i, c in enumerate(by)], F.col("rows").alias("_ar"), F.col("content").alias("_ac"))
    on = F.lit(True)
    for i in range(len(by)):
        on = on & F.col(f"_e{i}").eqNullSafe(F.col(f"_a{i}"))
    zero, none = F.lit(0).cast("bigint"), F.lit(0).cast(_WIDE)
    expected_rows, actual_rows = F.coalesce("_er", zero), F.coalesce("_ar", zero)
    expected_content, actual_content = F.coalesce("_ec", none), F.coalesce("_ac", none)
    difference = (
        F.when(actual_rows < expected_rows, F.lit("rows lost"))
        .when(actual_rows > expected_rows, F.lit("rows added"))
        .when(actual_content != expected_content, F.lit("rows altered"))
    )
    out = e.join(a, on, "full_outer").select(
        *[F.when(F.col("_er").isNotNull(), F.col(f"_e{i}")).otherwise(F.col(f"_a{i}")).alias(c) for i, c in enumerate(by)],
        expected_rows.alias("expected_rows"),
        actual_rows.alias("actual_rows"),
        difference.alias("difference"),
    )
    status = F.when(F.col("difference").isNull(), F.lit(RECONCILED)).otherwise(F.lit(NOT_RECONCILED))
    return out.withColumn("reconciliation_status", status)


def reconcile_run(
    compared: DataFrame,
    counts: DataFrame,
    run_id: str,
    provider_id: str,
    at: _dt.datetime | None = None,
) -> DataFrame:
    """The reconciliation_audit row of a run.

    ``counts``: one row of source_count (records counted in the files' bytes),
    read_count, valid_count, rejected_count and target_count (read back from the
    written tables). Reconciled when source = read = valid + rejected, the
    target holds the valid rows, and every group of ``compared`` agrees by content.
    """
    bad = compared.agg(F.count_if(F.col("reconciliation_status") != RECONCILED).alias("_bad"))
    from strata.plans.attach import attach_row

    ok = (
        (F.col("source_count") == F.col("read_count"))
        & (F.col("read_count") == F.col("valid_count") + F.col("rejected_count"))
        & (F.col("target_count") == F.col("valid_count"))
        & (F.col("_bad") == 0)
    )
    return attach_row(counts, bad).select(
        F.lit(run_id).alias("run_id"),
        F.lit(provider_id).alias("provider_id"),
        *[F.col(c).cast("bigint").alias(c) for c in ("source_count", "read_count", "valid_count", "rejected_count", "target_count")],
        F.when(ok, F.lit(RECONCILED)).otherwise(F.lit(NOT_RECONCILED)).alias("reconciliation_status"),
        (F.current_timestamp() if at is None else ts_literal(at)).alias("reconciliation_timestamp"),
    )

"""Bronze -> silver: casts, row hash, exact dedup, derived and masked columns,
lineage, projection and single-pass run counts (SURVEY §2.5, §2.6, §3.2).
"""

from __future__ import annotations

import datetime as _dt
from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F
from pyspark.sql import types as T

from strata.functions.expr import ts_literal
from strata.functions.expr import (
    ROW_HASH_SEPARATOR,
    ROW_HASH_TS_FORMAT,
    DEFAULT_TIMESTAMP_FORMATS,
    file_name,
    hmac_sha256,
    is_cancellation,
    line_amount,
    mask_sha256,
    try_double,
    try_long,
    try_timestamp,
)
from strata.schemas import RAW_COLUMNS, SILVER_COLUMNS

HASH_COL = "_row_hash"
PART_COL = "_file_part"


def _typed(df: DataFrame, name: str, target: T.DataType, formats) -> Column:
    src = df.schema[name].dataType
    c = F.col(name)
    if isinstance(target, T.StringType):
        return c.cast("string")
    if isinstance(target, T.LongType):
        return try_long(c) if isinstance(src, T.StringType) else c.try_cast("bigint")
    if isinstance(target, T.DoubleType):
        return try_double(c) if isinstance(src, T.StringType) else c.try_cast("double")
    if isinstance(target, T.TimestampType):
        return try_timestamp(c, formats) if isinstance(src, T.StringType) else c.cast("timestamp")
    raise ValueError(target)


SILVER_TYPES = {
    "InvoiceNo": T.StringType(),
    "StockCode": T.StringType(),
    "Description": T.StringType(),
    "Quantity": T.LongType(),
    "InvoiceDate": T.TimestampType(),
    "UnitPrice": T.DoubleType(),
    "CustomerID": T.StringType(),
    "Country": T.StringType(),
}


def cast_columns(df: DataFrame, formats: Sequence[str] = DEFAULT_TIMESTAMP_FORMATS) -> DataFrame:
    """One select of casts. Text goes through ``try_cast``; Quantity via bigint,
    else double then bigint (``6.0`` -> 6, ``2.5`` -> 2). Other columns pass through."""
    return df.select(
        *[
            _typed(df, c, SILVER_TYPES[c], formats).alias(c) if c in SILVER_TYPES else F.col(c)
            for c in df.columns
        ]
    )


def _row_text() -> Column:
    parts = []
    for c in RAW_COLUMNS:
        v = F.date_format(F.col(c), ROW_HASH_TS_FORMAT) if c == "InvoiceDate" else F.col(c).cast("string")
        parts.append(F.coalesce(v, F.lit("")))
    return F.concat_ws(ROW_HASH_SEPARATOR, *parts)


def silver_row_hash() -> Column:
    """P5: SHA-256 of the eight typed values joined by ``||``; NULL as '',
    InvoiceDate as ``yyyy-MM-dd HH:mm:ss``, numbers by Spark's string cast."""
    return F.sha2(_row_text(), 256)


def with_row_hash(df: DataFrame, out: str = HASH_COL) -> DataFrame:
    return df.withColumn(out, silver_row_hash())


def _begins_run(batches: Iterator[tuple[pa.Array, ...]]) -> Iterator[pa.Array]:
    """Whether a row differs from the row before it in one of the columns (nulls are equal), through all of a task's rows."""
    last = None
    for columns in batches:
        n = len(columns[0])
        new = np.zeros(n, dtype=bool)
        if n:
            for c in columns:
                a, b = c.slice(1), c.slice(0, n - 1)
                equal = pc.or_(pc.fill_null(pc.equal(a, b), False), pc.and_(pc.is_null(a), pc.is_null(b)))
                new[1:] |= ~equal.to_numpy(zero_copy_only=False)
            new[0] = last is None or last != [c[0].as_py() for c in columns]
            last = [c[n - 1].as_py() for c in columns]
        yield pa.array(new, pa.bool_())


def _first_of_keys(df: DataFrame, key: Sequence[str], order: Sequence[str]) -> DataFrame:
    """The least row by ``order`` of each ``key``, where rows of a key lie in one task: sorted there, without a shuffle."""
    from strata.session import ship_package

    ship_package(df.sparkSession)
    # Rows are told apart by one number, as a rule.
    lying = df.withColumn("_near", F.xxhash64(*key)).sortWithinPartitions("_near", *key, *order)
    # Nondeterministic: it depends on the order of rows, so no filter on it may move below the sort.
    begins = F.arrow_udf(_begins_run, "boolean").asNondeterministic()
    return lying.withColumn("_begins", begins(*key)).where("_begins").select(*df.columns)


def dedup_exact(
    df: DataFrame,
    mode: str = "hash",
    scope: str = "file",
    file_col: str = "SourceFile",
    survivor_order: Sequence[str] = (),
    carry_keys: Sequence[str] = (),
    parts_col: str | None = None,
    in_place: bool = False,
) -> DataFrame:
    """A1: remove exact duplicate lines.

    ``mode="typed"``  key = the eight typed columns;
    ``mode="hash"``   key = the row hash (merges NULL with '' and values that only
                      differ below a second, as the reference does).
    ``scope="file"``  duplicates only within one source file (the key includes
                      ``file_col`` and ``carry_keys``, columns constant per file);
                      ``"batch"`` across all files.

    Rows that are identical in every column are dropped first by a key-only
    aggregate (map-side partial aggregation, so a hot group of copies shrinks
    before the shuffle). When key-equal rows still differ in other columns
    the survivor is the least by ``survivor_order`` (then all columns), so the
    choice is deterministic.

    ``parts_col`` (hash mode, file scope; constant per file, dropped) is the number of
    parts that a file's rows are dealt to, by their values: the rows are
    shuffled once, without their hash, and lie by file in the result, so that
    it can be written by file as it is. Copies meet in their part, not before the shuffle.

    ``in_place``: a file's rows lie in one task already (``splits.whole_file_records``). They are
    sorted there, and nothing is shuffled. Hash mode and file scope only.
    """
    if mode not in ("hash", "typed"):
        raise ValueError(f"mode must be 'hash' or 'typed', not {mode!r}")
    dealt = parts_col is not None
    if in_place and (dealt or mode != "hash" or scope != "file"):
        raise ValueError("in_place needs mode 'hash', scope 'file' and no parts_col")
    if dealt:
        if mode != "hash" or scope != "file":
            raise ValueError("parts_col needs mode 'hash' and scope 'file'")
        part = F.pmod(F.xxhash64(_row_text()), F.greatest(F.coalesce(F.col(parts_col), F.lit(1)), F.lit(1)).cast("bigint")).cast("int")
        df = df.withColumn(PART_COL, part).drop(parts_col).repartition(file_col, PART_COL)
    if mode == "hash" and HASH_COL not in df.columns:
        df = with_row_hash(df)
    key = [HASH_COL] if mode == "hash" else list(RAW_COLUMNS)
    if scope == "file":
        # Columns constant within a file (lineage such as the checksum) join the
        # key, so the typed mode stays a key-only hash aggregate.
        key = key + [file_col] + [c for c in carry_keys if c in df.columns] + ([PART_COL] if dealt else [])
    elif scope != "batch":
        raise ValueError(f"scope must be 'file' or 'batch', not {scope!r}")
    rest = [c for c in df.columns if c not in key]
    distinct = df.distinct()
    if not rest and not in_place:
        return distinct
    order = list(survivor_order) + [c for c in rest if c not in survivor_order]
    if in_place:
        return _first_of_keys(df, key, order)
    best = F.min(F.struct(*[F.col(c) for c in order])).alias("_s")
    out = distinct.groupBy(*key).agg(best)
    return out.select(*[F.col(c) if c in key else F.col(f"_s.{c}").alias(c) for c in df.columns if c != PART_COL])


def derive(df: DataFrame, mask: str = "sha256", key: str | bytes | None = None) -> DataFrame:
    """LineAmount, IsCancellation and the masked CustomerID."""
    if mask == "sha256":
        masked = mask_sha256("CustomerID")
    elif mask == "hmac":
        if key is None:
            raise ValueError("mask='hmac' needs a key")
        masked = hmac_sha256("CustomerID", key)
    elif mask == "none":
        masked = F.col("CustomerID")
    else:
        raise ValueError(mask)
    return (
        df.withColumn("LineAmount", line_amount())
        .withColumn("IsCancellation", is_cancellation())
        .withColumn("CustomerID", masked)
    )


def lineage(
    df: DataFrame,
    pipeline_run_id: str,
    source_checksum: str | Column | None = None,
    processed_at: _dt.datetime | None = None,
    source_col: str = "source_file",
) -> DataFrame:
    """SourceFile (last path segment), SourceDate = date of InvoiceDate,
    SourceChecksum, PipelineRunID and ProcessedAt (now unless given)."""
    if source_checksum is None:
        checksum = F.col("source_checksum") if "source_checksum" in df.columns else F.lit(None).cast("string")
    elif isinstance(source_checksum, str):
        checksum = F.lit(source_checksum)
    else:
        checksum = source_checksum
    ts = F.current_timestamp() if processed_at is None else ts_literal(processed_at)
    return (
        df.withColumn("SourceFile", file_name(F.col(source_col)))
        .withColumn("SourceDate", F.to_date(F.col("InvoiceDate")))
        .withColumn("SourceChecksum", checksum)
        .withColumn("PipelineRunID", F.lit(pipeline_run_id))
        .withColumn("ProcessedAt", ts)
    )


def project(df: DataFrame) -> DataFrame:
    """The 15 silver columns, in order."""
    return df.select(*SILVER_COLUMNS)


class RunCounts:
    """A2 in one pass: two ``Observation``s on the silver plan (before and after the
    dedup). Counts are best effort (a retried task may be counted once more in
    rare cases); reconciliation recounts the written output."""

    def __init__(self) -> None:
        self.source = Observation()
        self.deduplicated = Observation()

    def result(self) -> dict:
        src = self.source.get["source_count"]
        ded = self.deduplicated.get["deduplicated_count"]
        return {
            "source_count": src,
            "deduplicated_count": ded,
            "duplicate_count": src - ded,
            "silver_count": ded,
        }


def to_silver(
    valid_lines: DataFrame,
    pipeline_run_id: str,
    source_checksum: str | Column | None = None,
    processed_at: _dt.datetime | None = None,
    source_col: str = "source_file",
    dedup_mode: str = "hash",
    dedup_scope: str = "file",
    mask: str = "sha256",
    mask_key: str | bytes | None = None,
    counts: RunCounts | None = None,
    parts_col: str | None = None,
    in_place: bool = False,
) -> DataFrame:
    """The silver plan, one lazy DataFrame: casts -> hash -> dedup -> derived and
    masked -> lineage -> projection.

    Lineage that is constant per file (SourceFile, SourceChecksum) is attached
    before the dedup so that ``scope="file"`` keys on it; run-level literals
    come after. Pass ``RunCounts`` to get the source/deduplicated counts from
    the same pass that writes (A2) instead of extra actions. ``parts_col``, ``in_place``: see ``dedup_exact``.
    """
    df = cast_columns(valid_lines)
    if source_checksum is None:
        checksum = F.col("source_checksum") if "source_checksum" in df.columns else F.lit(None).cast("string")
    elif isinstance(source_checksum, str):
        checksum = F.lit(source_checksum)
    else:
        checksum = source_checksum
    df = df.select(
        *RAW_COLUMNS,
        file_name(F.col(source_col)).alias("SourceFile"),
        checksum.alias("SourceChecksum"),
        *([parts_col] if parts_col else []),
    )
    if counts is not None:
        df = df.observe(counts.source, F.count(F.lit(1)).alias("source_count"))
    df = dedup_exact(df, mode=dedup_mode, scope=dedup_scope, file_col="SourceFile", carry_keys=["SourceChecksum"], parts_col=parts_col, in_place=in_place)
    if dedup_mode == "hash":
        df = df.drop(HASH_COL)
    if counts is not None:
        df = df.observe(counts.deduplicated, F.count(F.lit(1)).alias("deduplicated_count"))
    df = derive(df, mask=mask, key=mask_key)
    ts = F.current_timestamp() if processed_at is None else ts_literal(processed_at)
    df = (
        df.withColumn("SourceDate", F.to_date(F.col("InvoiceDate")))
        .withColumn("PipelineRunID", F.lit(pipeline_run_id))
        .withColumn("ProcessedAt", ts)
    )
    return project(df)

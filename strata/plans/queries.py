"""Registered queries: each runs one operator group over the whole driver tables.

``QUERIES[name](spark, sf_dir) -> DataFrame`` and ``ORACLES[name]`` (DuckDB SQL
over the same tables, when the operator is SQL-expressible). Column names are
aliased identically on both sides.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable

from pyspark.errors import StreamingQueryException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from strata.functions.expr import ts_literal
from strata.functions.expr import (
    hmac_sha256,
    is_cancellation,
    line_amount,
    mask_sha256,
    source_date_from_name,
    truncate_text,
    try_double,
    try_long,
    try_timestamp,
)
from strata.operators import audit, formats, rules, silver
from strata.operators import incremental as inc
from strata.operators import manifest as mf
from strata.operators import state as st
from strata.operators.content import compare_contents, contents
from strata.plans.attach import attach_row
from strata.plans.numbering import number_rows
from strata.plans.retail import (
    BAD_DATE_MOD,
    FLAGGED_SQL,
    RETAIL_LINES_SQL,
    flagged_sql,
    retail_lines,
    source_lines,
    table,
    with_ctes,
)
from strata.schemas import FILE_STATE_KEYS, FILE_STATE_SCHEMA, RAW_COLUMNS, SILVER_CONTRACT
from strata.plans.ingest import bronze_to_silver, ingest_batch, prepare_source, verify_source
from strata.session import cut_lineage, scratch_path, shuffles_removed
from strata.sinks.writers import write_bronze, write_manifest
from strata.sources import contract
from strata.sources.config import rule_config
from strata.sources.files import discover, fingerprint, read_manifest
from strata.streaming.late import keep_late
from strata.streaming.stream import dedup_stream, ingest_stream, run_available_now
from strata.streaming.watermarks import ingestion_log, window_stream

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}

# ---- run-level literals of the registered queries (deterministic output) ----
RUN_ID = "run-20260101-000001"
PROCESSED_AT = dt.datetime(2026, 1, 1, 0, 0, 0)
PROCESSED_AT_SQL = "TIMESTAMP '2026-01-01 00:00:00'"
SOURCE_CHECKSUM = "table-source"
PROVIDER_ID = "provider_retail"
ENVIRONMENT = "dev"


def register(name: str, sql: str | None = None):
    def deco(fn):
        QUERIES[name] = fn
        if sql is not None:
            ORACLES[name] = sql
        return fn

    return deco


# ---------------------------------------------------------------- shared plans


def flagged_lines(spark: SparkSession, sf_dir: str, by_day: bool = False) -> DataFrame:
    """Raw lines -> lenient casts -> ordered reason string."""
    return rules.flag(rules.coerce(retail_lines(spark, sf_dir, by_day)))


def valid_and_rejected(spark: SparkSession, sf_dir: str, by_day: bool = False) -> tuple[DataFrame, DataFrame]:
    return rules.split(flagged_lines(spark, sf_dir, by_day))


def silver_plan(spark: SparkSession, sf_dir: str, dedup_mode: str = "hash", counts=None) -> DataFrame:
    valid, _ = valid_and_rejected(spark, sf_dir)
    return silver.to_silver(
        valid,
        pipeline_run_id=RUN_ID,
        source_checksum=SOURCE_CHECKSUM,
        processed_at=PROCESSED_AT,
        dedup_mode=dedup_mode,
        counts=counts,
    )


SILVER_SQL = with_ctes(
    RETAIL_LINES_SQL,
    FLAGGED_SQL,
    """
silver_typed AS (
  SELECT DISTINCT InvoiceNo, StockCode, Description, CAST(trunc(Quantity) AS BIGINT) AS Quantity,
         InvoiceDate, UnitPrice, CustomerID, Country, source_file AS SourceFile
  FROM valid_lines
)""",
) + f"""
SELECT InvoiceNo, StockCode, Description, Quantity, InvoiceDate, UnitPrice,
       sha256(CustomerID) AS CustomerID, Country,
       round(Quantity * UnitPrice, 2) AS LineAmount,
       upper(substr(InvoiceNo, 1, 1)) = 'C' AS IsCancellation,
       SourceFile, CAST(InvoiceDate AS DATE) AS SourceDate,
       '{SOURCE_CHECKSUM}' AS SourceChecksum, '{RUN_ID}' AS PipelineRunID, {PROCESSED_AT_SQL} AS ProcessedAt
FROM silver_typed"""


@register("silver_lines", SILVER_SQL)
def q_silver_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Flagship: rules -> valid -> casts -> row hash -> dedup -> derived/masked -> lineage -> 15 columns."""
    return silver_plan(spark, sf_dir)


# ------------------------------------------------------------ rule results

NUMBERED_SQL = """
numbered_lines AS (
  SELECT *, row_number() OVER (PARTITION BY source_file ORDER BY
      InvoiceNo NULLS FIRST, StockCode NULLS FIRST, Description NULLS FIRST, Quantity NULLS FIRST,
      InvoiceDate NULLS FIRST, UnitPrice NULLS FIRST, CustomerID NULLS FIRST, Country NULLS FIRST) + 1 AS record_number
  FROM retail_lines
)"""


def numbered_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Raw lines with record_number = position in the file + 2 (header is line 1).

    The derived files have no physical order, so the position is defined by
    the eight raw values (rows equal in all of them are interchangeable).
    Numbered with a range shuffle and an offsets table, not a per-file window.
    """
    raw = retail_lines(spark, sf_dir)
    return number_rows(raw, ["source_file"], list(RAW_COLUMNS), out="record_number", start=2)


@register("valid_lines", with_ctes(RETAIL_LINES_SQL, FLAGGED_SQL) + "\nSELECT * FROM valid_lines")
def q_valid_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The valid side, lenient-typed (bronze content)."""
    valid, _ = valid_and_rejected(spark, sf_dir)
    return valid


REJECTED_SQL = with_ctes(RETAIL_LINES_SQL, NUMBERED_SQL, flagged_sql("numbered_lines")) + """
SELECT record_number, coalesce(InvoiceNo, 'UNKNOWN') AS record_identifier, rejection_reason,
       InvoiceNo, StockCode, Description, Quantity, InvoiceDate, UnitPrice, CustomerID, Country, source_file
FROM rejected_lines"""


def rejected_plan(spark: SparkSession, sf_dir: str) -> DataFrame:
    flagged = rules.flag(rules.coerce(numbered_lines(spark, sf_dir)))
    _, rejected = rules.split(flagged)
    return rejected


@register("rejected_lines", REJECTED_SQL)
def q_rejected_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rejected rows with record_number, record_identifier and all reasons."""
    return rules.rejected_projection(rejected_plan(spark, sf_dir), extra=["source_file"])


@register(
    "rejection_histogram",
    with_ctes(RETAIL_LINES_SQL, FLAGGED_SQL)
    + """
SELECT reason AS rejection_reason, count(*) AS rejected_count
FROM (SELECT unnest(string_split(rejection_reason, ';')) AS reason FROM rejected_lines)
GROUP BY reason""",
)
def q_rejection_histogram(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A4: reasons split, exploded and counted, largest first."""
    _, rejected = valid_and_rejected(spark, sf_dir)
    return rules.reason_histogram(rejected)


@register(
    "rejection_audit",
    with_ctes(RETAIL_LINES_SQL, NUMBERED_SQL, flagged_sql("numbered_lines"))
    + f"""
SELECT '{RUN_ID}' AS run_id, '{PROVIDER_ID}' AS provider_id, source_file,
       coalesce(InvoiceNo, 'UNKNOWN') AS record_identifier, rule_name, rejection_reason,
       {PROCESSED_AT_SQL} AS rejected_at, '{ENVIRONMENT}' AS environment, record_number
FROM (SELECT *, unnest(string_split(rejection_reason, ';')) AS rule_name FROM rejected_lines)""",
)
def q_rejection_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One row per (rejected record, failed rule)."""
    return audit.rejection_audit(rejected_plan(spark, sf_dir), RUN_ID, PROVIDER_ID, ENVIRONMENT, PROCESSED_AT)


@register(
    "validation_counts",
    with_ctes(RETAIL_LINES_SQL, FLAGGED_SQL)
    + """
SELECT source_file, count(*) AS total_records,
       CAST(count_if(rejection_reason = '') AS BIGINT) AS valid_records,
       CAST(count_if(rejection_reason <> '') AS BIGINT) AS rejected_records
FROM flagged_lines GROUP BY source_file""",
)
def q_validation_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A3: total / valid / rejected per daily file."""
    return audit.validation_counts(flagged_lines(spark, sf_dir))


DECLARED_SQL = with_ctes(RETAIL_LINES_SQL, FLAGGED_SQL) + """
SELECT * FROM (
  SELECT source_file, InvoiceNo, StockCode, Description, Quantity, InvoiceDate, UnitPrice, CustomerID, Country,
    concat_ws(';',
      CASE WHEN NOT coalesce(InvoiceNo IS NOT NULL, false) THEN 'required_invoice_no' END,
      CASE WHEN NOT coalesce(StockCode IS NOT NULL, false) THEN 'required_stock_code' END,
      CASE WHEN NOT coalesce(Quantity > 0, false) THEN 'positive_quantity' END,
      CASE WHEN NOT coalesce(UnitPrice >= 0, false) THEN 'positive_unit_price' END,
      CASE WHEN NOT coalesce(InvoiceDate IS NOT NULL, false) THEN 'valid_invoice_date' END) AS failed_rules
  FROM typed_lines)
WHERE failed_rules <> ''"""


@register("declared_rules", DECLARED_SQL)
def q_declared_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The declared rule table (SQL conditions) applied; NULL fails a rule."""
    typed = rules.coerce(retail_lines(spark, sf_dir))
    pack = rules.RulePack(rules.rules_from_table(rule_config(spark), PROVIDER_ID))
    return rules.failed_rules(typed, pack)


# ------------------------------------------------------------ silver pieces

SILVER_TYPED_SQL = """
silver_cast AS (
  SELECT source_file, InvoiceNo, StockCode, Description, CAST(trunc(Quantity) AS BIGINT) AS Quantity,
         InvoiceDate, UnitPrice, CustomerID, Country
  FROM valid_lines
)"""


def silver_cast(spark: SparkSession, sf_dir: str) -> DataFrame:
    valid, _ = valid_and_rejected(spark, sf_dir)
    return silver.cast_columns(valid)


@register(
    "row_hash",
    with_ctes(RETAIL_LINES_SQL, FLAGGED_SQL, SILVER_TYPED_SQL)
    + """
SELECT source_file, InvoiceNo, StockCode,
  sha256(concat_ws('||', coalesce(InvoiceNo, ''), coalesce(StockCode, ''), coalesce(Description, ''),
    coalesce(CAST(Quantity AS VARCHAR), ''), coalesce(strftime(InvoiceDate, '%Y-%m-%d %H:%M:%S'), ''),
    coalesce(CAST(UnitPrice AS VARCHAR), ''), coalesce(CustomerID, ''), coalesce(Country, ''))) AS row_hash
FROM silver_cast""",
)
def q_row_hash(spark: SparkSession, sf_dir: str) -> DataFrame:
    """P5: SHA-256 row hash of the eight typed values."""
    return silver_cast(spark, sf_dir).select("source_file", "InvoiceNo", "StockCode", silver.silver_row_hash().alias("row_hash"))


DEDUP_SQL = with_ctes(RETAIL_LINES_SQL, FLAGGED_SQL, SILVER_TYPED_SQL) + """
SELECT DISTINCT InvoiceNo, StockCode, Description, Quantity, InvoiceDate, UnitPrice, CustomerID, Country,
       source_file AS SourceFile
FROM silver_cast"""


def _dedup(spark: SparkSession, sf_dir: str, mode: str) -> DataFrame:
    df = silver_cast(spark, sf_dir).select(*RAW_COLUMNS, F.col("source_file").alias("SourceFile"))
    out = silver.dedup_exact(df, mode=mode, scope="file")
    return out.drop(silver.HASH_COL)


@register("dedup_lines", DEDUP_SQL)
def q_dedup_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A1, mode typed: key-only aggregate over the eight typed columns per file."""
    return _dedup(spark, sf_dir, "typed")


@register("dedup_hash_lines", DEDUP_SQL)
def q_dedup_hash_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A1, mode hash (reference parity): key = row hash per file, fixed survivor."""
    return _dedup(spark, sf_dir, "hash")


@register(
    "dedup_counts",
    with_ctes(RETAIL_LINES_SQL, FLAGGED_SQL, SILVER_TYPED_SQL)
    + """
SELECT (SELECT count(*) FROM silver_cast) AS source_count,
       (SELECT count(*) FROM (SELECT DISTINCT * FROM silver_cast)) AS deduplicated_count,
       (SELECT count(*) FROM silver_cast) - (SELECT count(*) FROM (SELECT DISTINCT * FROM silver_cast)) AS duplicate_count,
       (SELECT count(*) FROM (SELECT DISTINCT * FROM silver_cast)) AS silver_count""",
)
def q_dedup_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A2: source, deduplicated, duplicate and silver counts of a run (one row)."""
    src = silver_cast(spark, sf_dir)
    before = src.agg(F.count(F.lit(1)).alias("source_count"))
    after = silver.dedup_exact(
        src.select(*RAW_COLUMNS, F.col("source_file").alias("SourceFile")), mode="typed"
    ).agg(F.count(F.lit(1)).alias("deduplicated_count"))
    j = attach_row(before, after)
    return j.select(
        "source_count",
        "deduplicated_count",
        (F.col("source_count") - F.col("deduplicated_count")).alias("duplicate_count"),
        F.col("deduplicated_count").alias("silver_count"),
    )


@register(
    "line_amount",
    with_ctes(RETAIL_LINES_SQL, FLAGGED_SQL, SILVER_TYPED_SQL)
    + """
SELECT source_file, InvoiceNo, Quantity, UnitPrice, round(Quantity * UnitPrice, 2) AS LineAmount FROM silver_cast""",
)
def q_line_amount(spark: SparkSession, sf_dir: str) -> DataFrame:
    """LineAmount = round(Quantity * UnitPrice, 2)."""
    return silver_cast(spark, sf_dir).select(
        "source_file", "InvoiceNo", "Quantity", "UnitPrice", line_amount().alias("LineAmount")
    )


@register(
    "cancellation_flag",
    with_ctes(RETAIL_LINES_SQL, FLAGGED_SQL, SILVER_TYPED_SQL)
    + """
SELECT source_file, InvoiceNo, Quantity, upper(substr(InvoiceNo, 1, 1)) = 'C' AS IsCancellation FROM silver_cast""",
)
def q_cancellation_flag(spark: SparkSession, sf_dir: str) -> DataFrame:
    """IsCancellation (upper-cased first letter is C)."""
    return silver_cast(spark, sf_dir).select("source_file", "InvoiceNo", "Quantity", is_cancellation().alias("IsCancellation"))


@register(
    "masked_customer",
    with_ctes(RETAIL_LINES_SQL, FLAGGED_SQL)
    + """
SELECT sha256(CustomerID) AS CustomerID, count(*) AS line_count FROM valid_lines GROUP BY sha256(CustomerID)""",
)
def q_masked_customer(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Unsalted SHA-256 mask (NULL stays NULL), lines per masked customer."""
    valid, _ = valid_and_rejected(spark, sf_dir)
    return valid.groupBy(mask_sha256("CustomerID").alias("CustomerID")).agg(F.count(F.lit(1)).alias("line_count"))


# ---- fixed values: demo HMAC key of the registered keyed-mask query ----
DEMO_MASK_KEY = "strata-demo-key"


def _pad(byte: int) -> str:
    """The mask key's block, each byte xored with ``byte``, as hex."""
    return bytes(b ^ byte for b in DEMO_MASK_KEY.encode("utf-8").ljust(64, b"\x00")).hex()


@register(
    "keyed_mask",
    with_ctes(RETAIL_LINES_SQL, FLAGGED_SQL)
    + f"""
SELECT sha256(unhex('{_pad(0x5C)}') || unhex(sha256(unhex('{_pad(0x36)}') || encode(CustomerID)))) AS CustomerID, count(*) AS line_count
FROM valid_lines GROUP BY 1""",
)
def q_keyed_mask(spark: SparkSession, sf_dir: str) -> DataFrame:
    """HMAC-SHA256 mask with a key (the twin builds it from two SHA-256; checked against ``hmac`` in tests)."""
    valid, _ = valid_and_rejected(spark, sf_dir)
    return valid.groupBy(hmac_sha256("CustomerID", DEMO_MASK_KEY).alias("CustomerID")).agg(
        F.count(F.lit(1)).alias("line_count")
    )


@register(
    "lineage_columns",
    SILVER_SQL.replace(
        "SELECT InvoiceNo, StockCode, Description, Quantity, InvoiceDate, UnitPrice,\n       sha256(CustomerID)",
        "SELECT SourceFile, SourceDate, SourceChecksum, PipelineRunID, ProcessedAt, count(*) AS line_count FROM (\nSELECT InvoiceNo, StockCode, Description, Quantity, InvoiceDate, UnitPrice,\n       sha256(CustomerID)",
    )
    + ") GROUP BY SourceFile, SourceDate, SourceChecksum, PipelineRunID, ProcessedAt",
)
def q_lineage_columns(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Lineage of the silver rows per file and date."""
    return (
        silver_plan(spark, sf_dir)
        .groupBy("SourceFile", "SourceDate", "SourceChecksum", "PipelineRunID", "ProcessedAt")
        .agg(F.count(F.lit(1)).alias("line_count"))
    )


def _contract_sql() -> str:
    parts = []
    types = {"STRING": "STRING", "INT64": "INT64", "FLOAT64": "FLOAT64", "TIMESTAMP": "TIMESTAMP", "DATE": "DATE", "BOOLEAN": "BOOLEAN"}
    for i, (name, dtype, nullable) in enumerate(SILVER_CONTRACT):
        parts.append(
            f"SELECT {i + 1} AS column_order, '{name}' AS column_name, '{dtype}' AS expected_type, "
            f"'{types[dtype]}' AS actual_type, {str(nullable).lower()} AS nullable, "
            f"CAST(count_if({name} IS NULL) AS BIGINT) AS null_count FROM silver_out"
        )
    body = "\nUNION ALL\n".join(parts)
    silver_cte = SILVER_SQL.replace("\nSELECT InvoiceNo, StockCode, Description, Quantity, InvoiceDate, UnitPrice,\n       sha256", ",\nsilver_out AS (\nSELECT InvoiceNo, StockCode, Description, Quantity, InvoiceDate, UnitPrice,\n       sha256")
    return (
        silver_cte
        + ")\nSELECT *, expected_type = actual_type AS type_ok, nullable OR null_count = 0 AS null_ok FROM (\n"
        + body
        + ")"
    )


@register("silver_contract", _contract_sql())
def q_silver_contract(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Silver types and NULL counts against the declared contract."""
    return contract.contract_check(silver_plan(spark, sf_dir))


# ------------------------------------------------------------ state (events as a state log)
#
# Each event is read as one FileProcessingState row of the file
# ``user_<id>.csv`` with checksum = event type (key = provider, uri, checksum).
# The "first half" (event_id <= max/2) is the existing state, the second half
# the incoming changes.

EVENT_STATE_SQL = f"""
ev AS (
  SELECT event_id,
    '{PROVIDER_ID}' AS provider_id,
    'raw/{PROVIDER_ID}/user_' || CAST(user_id AS VARCHAR) || '.csv' AS source_uri,
    'user_' || CAST(user_id AS VARCHAR) || '.csv' AS source_file,
    CAST(ts AS DATE) AS source_date,
    event_type AS source_checksum,
    CASE event_type WHEN 'purchase' THEN 'SUCCESS' WHEN 'error' THEN 'FAILED'
                    WHEN 'click' THEN 'FILE_VALIDATION_FAILED' ELSE 'PROCESSING' END AS status,
    'run-' || CAST(event_id AS VARCHAR) AS run_id,
    ts AS first_processed_at, ts AS last_processed_at,
    CAST(floor(value) AS BIGINT) AS record_count,
    CAST(floor(value) AS BIGINT) - CAST(floor(value / 10) AS BIGINT) AS valid_record_count,
    CAST(floor(value / 10) AS BIGINT) AS rejected_record_count,
    CASE WHEN event_type = 'error' THEN props END AS error_message,
    ts AS created_at, ts AS updated_at
  FROM events
),
mid AS (SELECT max(event_id) / 2 AS m FROM events),
tgt AS (
  SELECT * EXCLUDE (rn, event_id) FROM (
    SELECT *, row_number() OVER (PARTITION BY provider_id, source_uri, source_checksum
                                 ORDER BY updated_at DESC, run_id DESC) AS rn
    FROM ev WHERE event_id <= (SELECT m FROM mid)) WHERE rn = 1
),
src AS (
  SELECT * EXCLUDE (rn, event_id) FROM (
    SELECT *, row_number() OVER (PARTITION BY provider_id, source_uri, source_checksum
                                 ORDER BY updated_at DESC, run_id DESC) AS rn
    FROM ev WHERE event_id > (SELECT m FROM mid)) WHERE rn = 1
)"""

STATE_JOIN = "t.provider_id = s.provider_id AND t.source_uri = s.source_uri AND t.source_checksum = s.source_checksum"


def events_ts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events with ``ts`` as TIMESTAMP (the file stores TIMESTAMP_NTZ)."""
    return table(spark, sf_dir, "events").withColumn("ts", F.col("ts").cast("timestamp"))


def event_state_rows(events: DataFrame) -> DataFrame:
    v = F.col("value")
    uid = F.col("user_id").cast("string")
    return events.select(
        "event_id",
        F.lit(PROVIDER_ID).alias("provider_id"),
        F.concat(F.lit(f"raw/{PROVIDER_ID}/user_"), uid, F.lit(".csv")).alias("source_uri"),
        F.concat(F.lit("user_"), uid, F.lit(".csv")).alias("source_file"),
        F.to_date("ts").alias("source_date"),
        F.col("event_type").alias("source_checksum"),
        F.when(F.col("event_type") == "purchase", F.lit(st.SUCCESS))
        .when(F.col("event_type") == "error", F.lit(st.FAILED))
        .when(F.col("event_type") == "click", F.lit(st.FILE_VALIDATION_FAILED))
        .otherwise(F.lit(st.PROCESSING))
        .alias("status"),
        F.concat(F.lit("run-"), F.col("event_id").cast("string")).alias("run_id"),
        F.col("ts").alias("first_processed_at"),
        F.col("ts").alias("last_processed_at"),
        F.floor(v).cast("bigint").alias("record_count"),
        (F.floor(v).cast("bigint") - F.floor(v / 10).cast("bigint")).alias("valid_record_count"),
        F.floor(v / 10).cast("bigint").alias("rejected_record_count"),
        F.when(F.col("event_type") == "error", F.col("props")).alias("error_message"),
        F.col("ts").alias("created_at"),
        F.col("ts").alias("updated_at"),
    )


def split_halves(df: DataFrame, key: str = "event_id") -> tuple[DataFrame, DataFrame]:
    """(first half, second half) by ``key`` <= max/2; the bound is a one-row aggregate."""
    mid = df.agg((F.max(key) / 2).alias("_mid"))
    j = attach_row(df, mid)
    first = j.filter(F.col(key) <= F.col("_mid")).drop("_mid")
    second = j.filter(F.col(key) > F.col("_mid")).drop("_mid")
    return first, second


def state_halves(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    rows = event_state_rows(events_ts(spark, sf_dir))
    first, second = split_halves(rows)
    cols = FILE_STATE_SCHEMA.names
    target = st.latest(first.select(*cols))
    source = st.latest(second.select(*cols))
    return target, source


@register(
    "latest_state",
    """SELECT * EXCLUDE (rn) FROM (
  SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) AS rn FROM events)
WHERE rn = 1""",
)
def q_latest_state(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Newest row per key for all keys at once (partial max-struct aggregate)."""
    events = table(spark, sf_dir, "events")
    return st.latest(events, keys=["user_id"], order=["ts", "event_id"])


@register(
    "state_merge",
    with_ctes(EVENT_STATE_SQL)
    + f"""
SELECT coalesce(t.provider_id, s.provider_id) AS provider_id,
       coalesce(t.source_uri, s.source_uri) AS source_uri,
       CASE WHEN t.provider_id IS NOT NULL THEN t.source_file ELSE s.source_file END AS source_file,
       CASE WHEN t.provider_id IS NOT NULL THEN t.source_date ELSE s.source_date END AS source_date,
       coalesce(t.source_checksum, s.source_checksum) AS source_checksum,
       CASE WHEN s.provider_id IS NOT NULL THEN s.status ELSE t.status END AS status,
       CASE WHEN s.provider_id IS NOT NULL THEN s.run_id ELSE t.run_id END AS run_id,
       CASE WHEN t.provider_id IS NOT NULL THEN t.first_processed_at ELSE {PROCESSED_AT_SQL} END AS first_processed_at,
       CASE WHEN s.provider_id IS NOT NULL THEN {PROCESSED_AT_SQL} ELSE t.last_processed_at END AS last_processed_at,
       CASE WHEN t.provider_id IS NOT NULL THEN t.record_count END AS record_count,
       CASE WHEN t.provider_id IS NOT NULL THEN t.valid_record_count END AS valid_record_count,
       CASE WHEN t.provider_id IS NOT NULL THEN t.rejected_record_count END AS rejected_record_count,
       CASE WHEN t.provider_id IS NOT NULL THEN t.error_message END AS error_message,
       CASE WHEN t.provider_id IS NOT NULL THEN t.created_at ELSE {PROCESSED_AT_SQL} END AS created_at,
       CASE WHEN s.provider_id IS NOT NULL THEN {PROCESSED_AT_SQL} ELSE t.updated_at END AS updated_at
FROM tgt t FULL OUTER JOIN src s ON {STATE_JOIN}""",
)
def q_state_merge(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Upsert of the incoming changes into the current state."""
    target, source = state_halves(spark, sf_dir)
    changes = source.select(*FILE_STATE_KEYS, "source_file", "source_date", "status", "run_id")
    return st.merge_state(target, changes, now=PROCESSED_AT)


@register(
    "state_update",
    with_ctes(EVENT_STATE_SQL)
    + f"""
SELECT t.provider_id, t.source_uri, t.source_file, t.source_date, t.source_checksum,
       CASE WHEN s.provider_id IS NOT NULL THEN s.status ELSE t.status END AS status,
       CASE WHEN s.provider_id IS NOT NULL THEN s.run_id ELSE t.run_id END AS run_id,
       t.first_processed_at,
       CASE WHEN s.provider_id IS NOT NULL THEN {PROCESSED_AT_SQL} ELSE t.last_processed_at END AS last_processed_at,
       CASE WHEN s.provider_id IS NOT NULL THEN s.record_count ELSE t.record_count END AS record_count,
       CASE WHEN s.provider_id IS NOT NULL THEN s.valid_record_count ELSE t.valid_record_count END AS valid_record_count,
       CASE WHEN s.provider_id IS NOT NULL THEN s.rejected_record_count ELSE t.rejected_record_count END AS rejected_record_count,
       CASE WHEN s.provider_id IS NOT NULL THEN NULL ELSE t.error_message END AS error_message,
       t.created_at,
       CASE WHEN s.provider_id IS NOT NULL THEN {PROCESSED_AT_SQL} ELSE t.updated_at END AS updated_at
FROM tgt t LEFT JOIN src s ON {STATE_JOIN}""",
)
def q_state_update(spark: SparkSession, sf_dir: str) -> DataFrame:
    """M2: update of matched keys; the absent error argument becomes NULL."""
    target, source = state_halves(spark, sf_dir)
    changes = source.select(
        *FILE_STATE_KEYS, "status", "run_id", "record_count", "valid_record_count", "rejected_record_count"
    )
    return st.update_state(target, changes, now=PROCESSED_AT)


PENDING_SQL = with_ctes(EVENT_STATE_SQL) + """
SELECT f.provider_id, f.source_uri, f.source_checksum, f.source_file, f.source_date,
       l.status AS state_status,
       CASE WHEN l.status = 'SUCCESS' THEN 'SKIP' ELSE 'PROCESS' END AS action,
       coalesce(l.status, 'NEW') AS reason
FROM (SELECT provider_id, source_uri, source_checksum, min(source_file) AS source_file, min(source_date) AS source_date
      FROM ev GROUP BY provider_id, source_uri, source_checksum) f
LEFT JOIN tgt l ON l.provider_id = f.provider_id AND l.source_uri = f.source_uri AND l.source_checksum = f.source_checksum"""


def pending_plan(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = event_state_rows(events_ts(spark, sf_dir))
    first, _ = split_halves(rows)
    files = rows.groupBy(*FILE_STATE_KEYS).agg(F.min("source_file").alias("source_file"), F.min("source_date").alias("source_date"))
    out = st.pending(files, first.select(*FILE_STATE_SCHEMA.names))
    return out.select(*FILE_STATE_KEYS, "source_file", "source_date", "state_status", "action", "reason")


@register("pending_files", PENDING_SQL)
def q_pending_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """SKIP when the newest state of (provider, uri, checksum) is SUCCESS, else PROCESS."""
    return pending_plan(spark, sf_dir)


FILE_ORDER = ["source_date", "source_file", "source_uri", "source_checksum"]


@register(
    "file_sequence",
    "SELECT *, row_number() OVER (ORDER BY source_date, source_file, source_uri, source_checksum) AS sequence FROM ("
    + PENDING_SQL
    + ") WHERE action = 'PROCESS'",
)
def q_file_sequence(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Files to process, sorted, numbered 1..n (no single-partition window)."""
    todo = pending_plan(spark, sf_dir).filter(F.col("action") == "PROCESS")
    return inc.sequence_files(todo, order=FILE_ORDER)


@register(
    "batch_files",
    "SELECT * FROM (" + PENDING_SQL + ") WHERE action = 'PROCESS' ORDER BY source_date, source_file, source_uri, source_checksum LIMIT 3",
)
def q_batch_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The first three pending files (top-k; the limit is the feature)."""
    todo = pending_plan(spark, sf_dir).filter(F.col("action") == "PROCESS")
    return inc.take_batch(todo, 3, order=FILE_ORDER)


# ------------------------------------------------------------ event-time window

PROVIDER_STATE_SQL = """
prov_state AS (
  SELECT event_type AS provider_id,
         CASE WHEN event_type = 'view' THEN TIMESTAMP '1970-01-01 00:00:00'
              WHEN event_type = 'signup' THEN NULL ELSE max(ts) END AS last_processed_event_time,
         CASE event_type WHEN 'view' THEN 'NEVER_RUN' WHEN 'error' THEN 'FAILED' ELSE 'SUCCESS' END AS last_run_status,
         CAST(CASE WHEN event_type = 'click' THEN 0 ELSE 1440 END AS BIGINT) AS lookback_minutes
  FROM events WHERE event_id <= (SELECT max(event_id) / 2 FROM events)
  GROUP BY event_type
),
bounds AS (
  SELECT event_type AS provider_id, min(ts) AS min_available_event_time, max(ts) AS max_available_event_time
  FROM events GROUP BY event_type
),
win AS (
  SELECT s.provider_id, s.last_run_status, s.last_processed_event_time, s.lookback_minutes,
         b.min_available_event_time, b.max_available_event_time,
         CASE WHEN s.last_run_status = 'NEVER_RUN' OR s.last_processed_event_time IS NULL THEN b.min_available_event_time
              ELSE s.last_processed_event_time - to_minutes(s.lookback_minutes) END AS lower_bound,
         b.max_available_event_time AS upper_bound
  FROM prov_state s LEFT JOIN bounds b ON s.provider_id = b.provider_id
)"""


def provider_window(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    events = events_ts(spark, sf_dir).withColumn("provider_id", F.col("event_type"))
    first, _ = split_halves(events)
    et = F.col("provider_id")
    state = first.groupBy("provider_id").agg(F.max("ts").alias("_max")).select(
        "provider_id",
        F.when(et == "view", ts_literal(st.EPOCH))
        .when(et == "signup", F.lit(None).cast("timestamp"))
        .otherwise(F.col("_max"))
        .alias("last_processed_event_time"),
        F.when(et == "view", F.lit(st.NEVER_RUN)).when(et == "error", F.lit(st.FAILED)).otherwise(F.lit(st.SUCCESS)).alias("last_run_status"),
        F.when(et == "click", F.lit(0)).otherwise(F.lit(st.DEFAULT_LOOKBACK_MINUTES)).cast("bigint").alias("lookback_minutes"),
    )
    bounds = inc.event_bounds(events, ts_col="ts", by=["provider_id"])
    return inc.processing_window(state, bounds, by=["provider_id"]), events


@register(
    "processing_window",
    with_ctes(PROVIDER_STATE_SQL) + "\nSELECT * FROM win",
)
def q_processing_window(spark: SparkSession, sf_dir: str) -> DataFrame:
    """W2 + A9: per provider, lower = min available (never run / no watermark) or
    watermark - lookback; upper = max available."""
    win, _ = provider_window(spark, sf_dir)
    return win.select(
        "provider_id", "last_run_status", "last_processed_event_time", "lookback_minutes",
        "min_available_event_time", "max_available_event_time", "lower_bound", "upper_bound",
    )


@register(
    "lookback_rows",
    with_ctes(PROVIDER_STATE_SQL)
    + """
SELECT e.event_id, e.user_id, e.event_type, e.ts FROM events e JOIN win w ON w.provider_id = e.event_type
WHERE e.ts >= w.lower_bound AND e.ts <= w.upper_bound""",
)
def q_lookback_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows inside each provider's window, closed at both ends."""
    win, events = provider_window(spark, sf_dir)
    rows = inc.apply_window(events, win, ts_col="ts", by=["provider_id"])
    return rows.select("event_id", "user_id", "event_type", "ts")


# ------------------------------------------------------------ ingestion runs (one state row per user)

_FIRST_HALF = " WHERE event_id <= (SELECT max(event_id) / 2 FROM events)"

USER_STATE_SQL = f"""
ulatest AS (
  SELECT * EXCLUDE (rn) FROM (
    SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) AS rn
    FROM events{_FIRST_HALF}) WHERE rn = 1
),
ustate AS (
  SELECT 'user_' || CAST(user_id AS VARCHAR) AS provider_id, 'SILVER' AS layer,
         ts AS last_processed_event_time, ts AS max_event_time_seen, CAST(1440 AS BIGINT) AS lookback_minutes,
         CASE event_type WHEN 'purchase' THEN 'SUCCESS' WHEN 'error' THEN 'FAILED' WHEN 'view' THEN 'RUNNING'
                         WHEN 'signup' THEN 'NEVER_RUN' ELSE 'SUCCESS' END AS last_run_status,
         'run-' || CAST(event_id AS VARCHAR) AS last_run_id, ts AS last_run_time, ts AS updated_at
  FROM ulatest
),
started AS (
  SELECT provider_id, layer, last_processed_event_time, max_event_time_seen, lookback_minutes,
         CASE WHEN last_run_status <> 'RUNNING' THEN 'RUNNING' ELSE last_run_status END AS last_run_status,
         CASE WHEN last_run_status <> 'RUNNING' THEN 'run-next-' || substr(provider_id, 6) ELSE last_run_id END AS last_run_id,
         CASE WHEN last_run_status <> 'RUNNING' THEN NOW_TS ELSE last_run_time END AS last_run_time,
         CASE WHEN last_run_status <> 'RUNNING' THEN NOW_TS ELSE updated_at END AS updated_at,
         last_run_status <> 'RUNNING' AS lock_acquired
  FROM ustate
)""".replace("NOW_TS", PROCESSED_AT_SQL)


def user_state(spark: SparkSession, sf_dir: str, halves: bool = True) -> tuple[DataFrame, DataFrame]:
    """(state rows from the first half of the events, the second half); without ``halves`` the state is of all events."""
    events = events_ts(spark, sf_dir)
    first, second = split_halves(events) if halves else (events, events)
    last = st.latest(first.select("event_id", "ts", "user_id", "event_type"), keys=["user_id"], order=["ts", "event_id"])
    et = F.col("event_type")
    state = last.select(
        F.concat(F.lit("user_"), F.col("user_id").cast("string")).alias("provider_id"),
        F.lit("SILVER").alias("layer"),
        F.col("ts").alias("last_processed_event_time"),
        F.col("ts").alias("max_event_time_seen"),
        F.lit(st.DEFAULT_LOOKBACK_MINUTES).cast("bigint").alias("lookback_minutes"),
        F.when(et == "purchase", F.lit(st.SUCCESS)).when(et == "error", F.lit(st.FAILED))
        .when(et == "view", F.lit(st.RUNNING)).when(et == "signup", F.lit(st.NEVER_RUN))
        .otherwise(F.lit(st.SUCCESS)).alias("last_run_status"),
        F.concat(F.lit("run-"), F.col("event_id").cast("string")).alias("last_run_id"),
        F.col("ts").alias("last_run_time"),
        F.col("ts").alias("updated_at"),
    )
    return state, second


def started_runs(spark: SparkSession, sf_dir: str, halves: bool = True) -> tuple[DataFrame, DataFrame]:
    state, second = user_state(spark, sf_dir, halves)
    requests = state.select("provider_id", "layer", F.concat(F.lit("run-next-"), F.substring("provider_id", 6, 64)).alias("run_id"))
    return st.start_runs(state, requests, now=PROCESSED_AT), second


@register("run_lock_transition", with_ctes(USER_STATE_SQL.replace(_FIRST_HALF, "")) + "\nSELECT * FROM started")
def q_run_lock_transition(spark: SparkSession, sf_dir: str) -> DataFrame:
    """M4: start a run per provider, with states from all events; rows already RUNNING keep their run (no lock)."""
    started, _ = started_runs(spark, sf_dir, halves=False)
    return started


@register(
    "run_complete",
    with_ctes(
        USER_STATE_SQL,
        """
outcome AS (
  SELECT 'user_' || CAST(user_id AS VARCHAR) AS provider_id, max(ts) AS max_event_time,
         count_if(event_type = 'error') = 0 AS succeeded
  FROM events WHERE event_id > (SELECT max(event_id) / 2 FROM events) GROUP BY user_id
)""",
    )
    + f"""
SELECT s.provider_id, s.layer,
  CASE WHEN s.lock_acquired AND coalesce(o.succeeded, true) THEN greatest(s.last_processed_event_time, o.max_event_time) ELSE s.last_processed_event_time END AS last_processed_event_time,
  CASE WHEN s.lock_acquired AND coalesce(o.succeeded, true) THEN greatest(s.max_event_time_seen, o.max_event_time) ELSE s.max_event_time_seen END AS max_event_time_seen,
  s.lookback_minutes,
  CASE WHEN s.lock_acquired AND coalesce(o.succeeded, true) THEN 'SUCCESS' WHEN s.lock_acquired THEN 'FAILED' ELSE s.last_run_status END AS last_run_status,
  s.last_run_id,
  CASE WHEN s.lock_acquired THEN {PROCESSED_AT_SQL} ELSE s.last_run_time END AS last_run_time,
  CASE WHEN s.lock_acquired THEN {PROCESSED_AT_SQL} ELSE s.updated_at END AS updated_at
FROM started s LEFT JOIN outcome o ON o.provider_id = s.provider_id""",
)
def q_run_complete(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Complete the started runs; success moves the watermark forward
    (never back), failure leaves it."""
    started, second = started_runs(spark, sf_dir)
    outcome = second.groupBy(F.concat(F.lit("user_"), F.col("user_id").cast("string")).alias("provider_id")).agg(
        F.max("ts").alias("max_event_time"), (F.count_if(F.col("event_type") == "error") == 0).alias("succeeded")
    )
    runs = (
        started.filter(F.col("lock_acquired"))
        .select("provider_id", "layer", F.col("last_run_id").alias("run_id"))
        .join(outcome, on="provider_id", how="left")
        .select("provider_id", "layer", "run_id", F.coalesce("succeeded", F.lit(True)).alias("succeeded"), "max_event_time")
    )
    return st.complete_runs(started.drop("lock_acquired"), runs, now=PROCESSED_AT)


@register(
    "seed_state",
    f"""SELECT DISTINCT event_type AS provider_id, 'SILVER' AS layer,
       TIMESTAMP '1970-01-01 00:00:00' AS last_processed_event_time, TIMESTAMP '1970-01-01 00:00:00' AS max_event_time_seen,
       CAST(1440 AS BIGINT) AS lookback_minutes, 'NEVER_RUN' AS last_run_status, CAST(NULL AS VARCHAR) AS last_run_id,
       CAST(NULL AS TIMESTAMP) AS last_run_time, {PROCESSED_AT_SQL} AS updated_at
FROM events""",
)
def q_seed_state(spark: SparkSession, sf_dir: str) -> DataFrame:
    """M7: one NEVER_RUN row per provider found in the data."""
    providers = table(spark, sf_dir, "events").select(F.col("event_type").alias("provider_id")).distinct()
    return st.seed_state(providers, now=PROCESSED_AT)


# ------------------------------------------------------------ scalar odds and ends


@register(
    "file_bounds",
    with_ctes(RETAIL_LINES_SQL)
    + """
SELECT count(*) AS file_count, min(source_file) AS first_file, max(source_file) AS last_file
FROM (SELECT DISTINCT source_file FROM retail_lines)""",
)
def q_file_bounds(spark: SparkSession, sf_dir: str) -> DataFrame:
    """First and last daily file of the sorted list, and how many."""
    files = retail_lines(spark, sf_dir).select("source_file").distinct()
    files = files.select(
        F.concat(F.lit(f"raw/{PROVIDER_ID}/"), F.col("source_file")).alias("source_uri"),
        "source_file",
        source_date_from_name("source_file").alias("source_date"),
    )
    return inc.first_last(files)


@register(
    "error_truncation",
    """SELECT p_partkey, substr('Row rejected: ' || repeat(p_name || '; ', 60), 1, 1000) AS error_message,
       CAST(length(substr('Row rejected: ' || repeat(p_name || '; ', 60), 1, 1000)) AS INTEGER) AS message_length
FROM part""",
)
def q_error_truncation(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Error text cut to 1000 characters."""
    msg = truncate_text(F.concat(F.lit("Row rejected: "), F.repeat(F.concat(F.col("p_name"), F.lit("; ")), 60)), 1000)
    return table(spark, sf_dir, "part").select("p_partkey", msg.alias("error_message"), F.length(msg).alias("message_length"))


LENIENT_SQL = """
SELECT l_orderkey, l_linenumber,
       TRY_CAST(qt AS DOUBLE) AS quantity,
       CAST(trunc(TRY_CAST(qt AS DOUBLE)) AS BIGINT) AS quantity_long,
       try_strptime(tt, '%Y-%m-%d %H:%M:%S') AS ship_ts,
       TRY_CAST(pt AS DOUBLE) AS price
FROM (
  SELECT l_orderkey, l_linenumber,
    CASE WHEN (l_orderkey + l_linenumber) % 17 = 0 THEN CAST(l_quantity AS VARCHAR) || 'x' ELSE CAST(l_quantity AS VARCHAR) END AS qt,
    CASE WHEN (l_orderkey + l_linenumber) % 17 = 1 THEN strftime(l_shipdate, '%d.%m.%Y') ELSE strftime(l_shipdate, '%Y-%m-%d %H:%M:%S') END AS tt,
    CASE WHEN (l_orderkey + l_linenumber) % 17 = 2 THEN 'USD ' || CAST(l_extendedprice AS VARCHAR) ELSE CAST(l_extendedprice AS VARCHAR) END AS pt
  FROM lineitem)"""


@register("lenient_casts", LENIENT_SQL)
def q_lenient_casts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Text with every 17th value broken; bad numbers and dates become NULL."""
    li = table(spark, sf_dir, "lineitem")
    k = (F.col("l_orderkey") + F.col("l_linenumber")) % 17
    qt = F.when(k == 0, F.concat(F.col("l_quantity").cast("string"), F.lit("x"))).otherwise(F.col("l_quantity").cast("string"))
    tt = F.when(k == 1, F.date_format("l_shipdate", "dd.MM.yyyy")).otherwise(F.date_format("l_shipdate", "yyyy-MM-dd HH:mm:ss"))
    pt = F.when(k == 2, F.concat(F.lit("USD "), F.col("l_extendedprice").cast("string"))).otherwise(F.col("l_extendedprice").cast("string"))
    return li.select(
        "l_orderkey",
        "l_linenumber",
        try_double(qt).alias("quantity"),
        try_long(qt).alias("quantity_long"),
        try_timestamp(tt).alias("ship_ts"),
        try_double(pt).alias("price"),
    )


# ---- fixed values: forms in which the countries of the derived feed write their dates ----
COUNTRY_FORMS = [("yyyy-MM-dd HH:mm:ss", "%Y-%m-%d %H:%M:%S"), ("dd/MM/yyyy HH:mm", "%d/%m/%Y %H:%M"), ("MM/dd/yyyy HH:mm", "%m/%d/%Y %H:%M")]

_FORM_OF = "length(coalesce(Country, '')) % 3"

ELECTION_SQL = with_ctes(
    RETAIL_LINES_SQL,
    f"""
written AS (
  SELECT Country, CASE WHEN ts IS NULL THEN InvoiceDate WHEN {_FORM_OF} = 0 THEN strftime(ts, '{COUNTRY_FORMS[0][1]}')
         WHEN {_FORM_OF} = 1 THEN strftime(ts, '{COUNTRY_FORMS[1][1]}') ELSE strftime(ts, '{COUNTRY_FORMS[2][1]}') END AS t
  FROM (SELECT *, try_strptime(InvoiceDate, '{COUNTRY_FORMS[0][1]}') AS ts FROM retail_lines)
),
parsed AS (
  SELECT Country, t, """
    + ", ".join(f"try_strptime(t, '{f}') AS p{i}" for i, (_, f) in enumerate(COUNTRY_FORMS))
    + """ FROM written
),
elected AS (
  SELECT Country, CASE WHEN count(p0) >= count(p1) AND count(p0) >= count(p2) THEN 0 WHEN count(p1) >= count(p2) THEN 1 ELSE 2 END AS f
  FROM parsed GROUP BY Country
)""",
) + f"""
SELECT p.Country, CASE e.f {' '.join(f"WHEN {i} THEN '{j}'" for i, (j, _) in enumerate(COUNTRY_FORMS))} END AS format,
       count(p.t) AS total, count(CASE e.f WHEN 0 THEN p0 WHEN 1 THEN p1 ELSE p2 END) AS parsed,
       min(CASE e.f WHEN 0 THEN p0 WHEN 1 THEN p1 ELSE p2 END) AS first_date,
       max(CASE e.f WHEN 0 THEN p0 WHEN 1 THEN p1 ELSE p2 END) AS last_date
FROM parsed p JOIN elected e ON p.Country IS NOT DISTINCT FROM e.Country GROUP BY p.Country, e.f"""


@register("timestamp_election", ELECTION_SQL)
def q_timestamp_election(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each country writes its dates in its own form (ISO, day first, month first, some
    broken); the form is elected per country and reads its lines."""
    ts = F.try_to_timestamp("InvoiceDate", F.lit(COUNTRY_FORMS[0][0]))
    form = F.length(F.coalesce("Country", F.lit(""))) % 3
    text = F.when(ts.isNull(), F.col("InvoiceDate"))
    for i, (f, _) in enumerate(COUNTRY_FORMS):
        text = text.when(form == i, F.date_format(ts, f))
    lines = retail_lines(spark, sf_dir).select("Country", text.alias("InvoiceDate"))
    candidates = [f for f, _ in COUNTRY_FORMS]
    lines = cut_lineage(lines, "country-lines")
    elected = formats.elect_formats(lines, ["Country"], formats=candidates)
    read = formats.read_elected(lines, elected, ["Country"], formats=candidates)
    spans = read.groupBy("Country").agg(F.min("InvoiceDate").alias("first_date"), F.max("InvoiceDate").alias("last_date"))
    spans = spans.withColumnRenamed("Country", "_c")
    joined = elected.join(spans, F.col("Country").eqNullSafe(F.col("_c")))
    return joined.select("Country", "format", "total", "parsed", "first_date", "last_date")


# ------------------------------------------------------------ headers, manifests, dates

_EXPECTED_SQL = "[" + ", ".join(f"'{c}'" for c in RAW_COLUMNS) + "]"
_SWAPPED = [RAW_COLUMNS[1], RAW_COLUMNS[0], *RAW_COLUMNS[2:]]
_SWAPPED_SQL = "[" + ", ".join(f"'{c}'" for c in _SWAPPED) + "]"

# ---- fixed values: header variants of the derived files (by day or key number) ----
DROP_COUNTRY_MOD = 7
EXTRA_FOO_MOD = 11
SWAP_MOD = 13
DUP_COUNTRY_MOD = 19


def derived_header(k) -> F.Column:
    """Header of a derived file, varied by the number ``k``: columns swapped,
    Country missing, an extra ``Foo``, Country twice."""
    base = F.when(k % SWAP_MOD == 0, F.array(*[F.lit(c) for c in _SWAPPED])).otherwise(
        F.array(*[F.lit(c) for c in RAW_COLUMNS])
    )
    h = F.when(k % DROP_COUNTRY_MOD == 0, F.filter(base, lambda x: x != "Country")).otherwise(base)
    h = F.when(k % EXTRA_FOO_MOD == 0, F.array_append(h, F.lit("Foo"))).otherwise(h)
    return F.when(k % DUP_COUNTRY_MOD == 0, F.array_append(h, F.lit("Country"))).otherwise(h)


def _header_sql(k: str) -> str:
    h = f"CASE WHEN {k} % {SWAP_MOD} = 0 THEN {_SWAPPED_SQL} ELSE {_EXPECTED_SQL} END"
    h = f"CASE WHEN {k} % {DROP_COUNTRY_MOD} = 0 THEN list_filter({h}, lambda x: x <> 'Country') ELSE {h} END"
    h = f"CASE WHEN {k} % {EXTRA_FOO_MOD} = 0 THEN list_append({h}, 'Foo') ELSE {h} END"
    return f"CASE WHEN {k} % {DUP_COUNTRY_MOD} = 0 THEN list_append({h}, 'Country') ELSE {h} END"


def _verdict_sql(h: str, level: str) -> str:
    miss = f"list_filter({_EXPECTED_SQL}, lambda x: NOT list_contains({h}, x))"
    unexp = f"list_filter({h}, lambda x: NOT list_contains({_EXPECTED_SQL}, x))"
    dup = f"list_sort(list_distinct(list_filter({h}, lambda x: len(list_filter({h}, lambda y: y = x)) > 1)))"
    if level == "exact_ordered":
        ok = f"({h} = {_EXPECTED_SQL})"
    elif level == "exact_set":
        ok = f"(len({miss}) = 0 AND len({unexp}) = 0 AND len({dup}) = 0)"
    else:
        ok = f"(len({miss}) = 0)"
    err = (
        f"CASE WHEN len({miss}) > 0 THEN 'Missing expected columns: ' || array_to_string({miss}, ', ') "
        f"WHEN {ok} THEN NULL "
        f"WHEN len({unexp}) > 0 THEN 'Unexpected columns found: ' || array_to_string({unexp}, ', ') "
        f"WHEN len({dup}) > 0 THEN 'Duplicated columns found: ' || array_to_string({dup}, ', ') "
        "ELSE 'Column order differs from the contract' END"
    )
    return ok, err, miss, unexp, dup


def _header_check_sql() -> str:
    ok_o, _, miss, unexp, dup = _verdict_sql("h", "exact_ordered")
    ok_s, err_s, *_ = _verdict_sql("h", "exact_set")
    ok_p, *_ = _verdict_sql("h", "superset")
    return f"""
SELECT file_id, array_to_string(h, ',') AS header,
       array_to_string({miss}, ',') AS missing_columns,
       array_to_string({unexp}, ',') AS unexpected_columns,
       array_to_string({dup}, ',') AS duplicated_columns,
       {ok_o} AS exact_ordered_ok, {ok_s} AS exact_set_ok, {ok_p} AS superset_ok,
       {err_s} AS file_error
FROM (SELECT o_orderkey AS file_id, {_header_sql('o_orderkey')} AS h FROM orders)"""


@register("header_check", _header_check_sql())
def q_header_check(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One header per order-file, checked at all three levels."""
    headers = table(spark, sf_dir, "orders").select(
        F.col("o_orderkey").alias("file_id"), derived_header(F.col("o_orderkey")).alias("header")
    )
    h = F.col("header")
    exact = (
        contract.header_verdict(headers, level="exact_set")
        .withColumn("exact_ordered_ok", contract.level_ok(h, "exact_ordered"))
        .withColumn("superset_ok", contract.level_ok(h, "superset"))
    )
    return exact.select(
        "file_id",
        F.array_join("header", ",").alias("header_text"),
        F.array_join("missing_columns", ",").alias("missing_columns"),
        F.array_join("unexpected_columns", ",").alias("unexpected_columns"),
        F.array_join(F.array_sort("duplicated_columns"), ",").alias("duplicated_columns"),
        "exact_ordered_ok",
        F.col("file_valid").alias("exact_set_ok"),
        "superset_ok",
        "file_error",
    ).withColumnRenamed("header_text", "header")


DAILY_SQL = f"""
daily AS (
  SELECT '{PROVIDER_ID}' AS provider_id, strftime(l_shipdate, '%Y-%m-%d') AS source_date,
         'retail_sales_' || strftime(l_shipdate, '%Y%m%d') || '.csv' AS file_name,
         '{PROVIDER_ID}/' || strftime(l_shipdate, '%Y-%m-%d') || '/retail_sales_' || strftime(l_shipdate, '%Y%m%d') || '.csv' AS relative_path,
         count(*) AS record_count
  FROM lineitem GROUP BY 1, 2, 3, 4
)"""


def daily_plan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mf.daily_counts(mf.prepare(source_lines(spark, sf_dir)), PROVIDER_ID)


@register("daily_manifest", with_ctes(DAILY_SQL) + "\nSELECT * FROM daily")
def q_daily_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Strict-typed source split by day; one manifest row per daily file."""
    return daily_plan(spark, sf_dir)


# ---- fixed values: manifest defects of the check query ----
MANIFEST_COUNT_OFF_MOD = 13
MANIFEST_DROP_MOD = 17
FILE_MISSING_MOD = 19


@register(
    "manifest_check",
    with_ctes(
        DAILY_SQL,
        f"""
man AS (
  SELECT relative_path, source_date,
         record_count + CASE WHEN date_diff('day', DATE '1970-01-01', CAST(source_date AS DATE)) % {MANIFEST_COUNT_OFF_MOD} = 0 THEN 1 ELSE 0 END AS record_count
  FROM daily WHERE date_diff('day', DATE '1970-01-01', CAST(source_date AS DATE)) % {MANIFEST_DROP_MOD} <> 0
),
act AS (
  SELECT relative_path, record_count FROM daily
  WHERE date_diff('day', DATE '1970-01-01', CAST(source_date AS DATE)) % {FILE_MISSING_MOD} <> 0
)""",
    )
    + """
SELECT coalesce(m.relative_path, a.relative_path) AS relative_path, m.source_date AS expected_date,
       m.record_count AS expected_count, a.record_count AS actual_count,
       m.relative_path IS NOT NULL AS listed, a.relative_path IS NOT NULL AS present,
       coalesce(m.record_count = a.record_count, false) AS count_ok,
       CASE WHEN a.relative_path IS NULL THEN 'MISSING_FILE' WHEN m.relative_path IS NULL THEN 'UNLISTED_FILE'
            WHEN m.record_count <> a.record_count THEN 'COUNT_MISMATCH' ELSE 'OK' END AS status
FROM man m FULL OUTER JOIN act a ON m.relative_path = a.relative_path""",
)
def q_manifest_check(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Manifest (some counts off, some rows gone) against the files
    there (some missing), full outer join on the relative path."""
    daily = daily_plan(spark, sf_dir)
    day = F.unix_date(F.to_date("source_date"))
    manifest = daily.filter(day % MANIFEST_DROP_MOD != 0).withColumn(
        "record_count", F.col("record_count") + F.when(day % MANIFEST_COUNT_OFF_MOD == 0, 1).otherwise(0)
    )
    actual = daily.filter(day % FILE_MISSING_MOD != 0).select("relative_path", "record_count")
    return mf.verify_manifest(manifest, actual)


# Lines of a part, about.
PURITY_ROWS = 250_000


@register(
    "date_purity",
    f"""
SELECT l_orderkey, count(*) AS record_count, CAST(count_if(d IS NULL) AS BIGINT) AS unparsed_dates,
       count(DISTINCT CAST(d AS DATE)) AS distinct_dates, min(CAST(d AS DATE)) AS min_date,
       min(CAST(o_orderdate AS DATE)) AS declared_date,
       count_if(d IS NULL) = 0 AS all_dates_parse,
       count(DISTINCT CAST(d AS DATE)) = 1 AS single_date,
       (count(DISTINCT CAST(d AS DATE)) = 1) AND (min(CAST(d AS DATE)) = min(CAST(o_orderdate AS DATE))) AS date_matches,
       CASE WHEN count_if(d IS NULL) > 0 THEN 'invalid_invoice_date'
            WHEN count(DISTINCT CAST(d AS DATE)) <> 1 THEN 'multiple_dates'
            WHEN NOT ((count(DISTINCT CAST(d AS DATE)) = 1) AND (min(CAST(d AS DATE)) = min(CAST(o_orderdate AS DATE)))) THEN 'date_mismatch' END AS first_failure
FROM (
  SELECT l.l_orderkey, o.o_orderdate,
         try_strptime(CASE WHEN l.l_suppkey % {BAD_DATE_MOD} = 0 THEN strftime(l.l_shipdate, '%d/%m/%Y')
                           ELSE strftime(l.l_shipdate, '%Y-%m-%d %H:%M:%S') END, '%Y-%m-%d %H:%M:%S') AS d
  FROM lineitem l LEFT JOIN orders o ON o.o_orderkey = l.l_orderkey)
GROUP BY l_orderkey""",
)
def q_date_purity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Per order-file, all dates parse, one calendar date, equal to the declared (order) date.

    The join and the counts by order work on parts of about ``PURITY_ROWS`` lines:
    their number follows the input, so a task's memory does not.
    """
    li = table(spark, sf_dir, "lineitem").select("l_orderkey", "l_suppkey", "l_shipdate")
    orders = table(spark, sf_dir, "orders").select("o_orderkey", "o_orderdate")
    text = F.when(F.col("l_suppkey") % BAD_DATE_MOD == 0, F.date_format("l_shipdate", "dd/MM/yyyy")).otherwise(
        F.date_format("l_shipdate", "yyyy-MM-dd HH:mm:ss")
    )
    # A count of a parquet table reads its footers only.
    slots = int(spark.conf.get("spark.sql.shuffle.partitions"))
    parts = max(slots, -(-li.count() // PURITY_ROWS))
    li, orders = li.repartition(parts, "l_orderkey"), orders.repartition(parts, "o_orderkey")
    lines = li.join(orders, li.l_orderkey == orders.o_orderkey, "left").select(
        "l_orderkey", text.alias("InvoiceDate"), "o_orderdate"
    )
    return mf.date_purity(lines, "l_orderkey", "InvoiceDate", declared_col="o_orderdate").select(
        "l_orderkey", "record_count", "unparsed_dates", "distinct_dates", "min_date", "declared_date",
        "all_dates_parse", "single_date", "date_matches", "first_failure",
    )


# ------------------------------------------------------------ batch of daily files with header verdicts

def _batch_sql() -> str:
    ok, err, *_ = _verdict_sql("h", "exact_set")
    return f"""
files AS (
  SELECT source_file, date_diff('day', DATE '1970-01-01', CAST(strptime(regexp_extract(source_file, '(\\d{{8}})', 1), '%Y%m%d') AS DATE)) AS d
  FROM (SELECT DISTINCT source_file FROM retail_lines)
),
verdict AS (
  SELECT source_file, {ok} AS file_valid, {err} AS file_error
  FROM (SELECT source_file, {_header_sql('d')} AS h FROM files)
),
"""


BATCH_SQL = _batch_sql() + """counts AS (
  SELECT source_file, count(*) AS total_records, count_if(rejection_reason = '') AS valid_records,
         count_if(rejection_reason <> '') AS rejected_records
  FROM flagged_lines GROUP BY source_file
),
results AS (
  SELECT v.source_file AS input_file,
         CAST(CASE WHEN file_valid THEN coalesce(total_records, 0) ELSE 0 END AS BIGINT) AS total_records,
         CAST(CASE WHEN file_valid THEN coalesce(valid_records, 0) ELSE 0 END AS BIGINT) AS valid_records,
         CAST(CASE WHEN file_valid THEN coalesce(rejected_records, 0) ELSE 0 END AS BIGINT) AS rejected_records,
         file_valid, CASE WHEN NOT file_valid THEN file_error END AS file_error,
         CASE WHEN file_valid THEN 'SUCCESS' ELSE 'FILE_VALIDATION_FAILED' END AS status
  FROM verdict v LEFT JOIN counts c ON c.source_file = v.source_file
),
batch_valid AS (
  SELECT * FROM valid_lines WHERE source_file IN (SELECT source_file FROM verdict WHERE file_valid)
),
batch_silver AS (
  SELECT DISTINCT InvoiceNo, StockCode, Description, CAST(trunc(Quantity) AS BIGINT) AS Quantity,
         InvoiceDate, UnitPrice, CustomerID, Country, source_file
  FROM batch_valid
)"""


def batch_plan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Per-file summary of the batch in one scan of the lines.

    Level 1 groups the flagged lines by (file, reason, silver-typed values) with
    the number of copies (partial aggregation before the shuffle, so copies and
    hot files shrink map-side). Level 2 rolls those groups up per file: total,
    valid and rejected lines, the distinct valid rows (= silver rows after the
    typed per-file dedup) and the event-time span of the valid lines. The file
    verdict (derived header, exact_set) is computed on the per-file rows.
    """
    flagged = silver.cast_columns(flagged_lines(spark, sf_dir))
    ok = F.col(rules.REASON_COL) == ""
    groups = flagged.groupBy("source_file", rules.REASON_COL, *RAW_COLUMNS).agg(F.count(F.lit(1)).alias("_n"))
    per_file = groups.groupBy("source_file").agg(
        F.sum("_n").cast("bigint").alias("total_records"),
        F.coalesce(F.sum(F.when(ok, F.col("_n"))), F.lit(0)).cast("bigint").alias("valid_records"),
        F.coalesce(F.sum(F.when(~ok, F.col("_n"))), F.lit(0)).cast("bigint").alias("rejected_records"),
        F.count_if(ok).alias("silver_records"),
        F.min(F.when(ok, F.col("InvoiceDate"))).alias("watermark_start"),
        F.max(F.when(ok, F.col("InvoiceDate"))).alias("watermark_end"),
    )
    day = F.unix_date(source_date_from_name("source_file"))
    headers = per_file.withColumn("header", derived_header(day))
    return contract.header_verdict(headers, level="exact_set")


def batch_results(summary: DataFrame) -> DataFrame:
    return audit.file_results(
        summary.select("source_file", "file_valid", "file_error"),
        summary.select("source_file", "total_records", "valid_records", "rejected_records"),
    )


def batch_totals(summary: DataFrame) -> DataFrame:
    """One row: the run's counts over the files that passed, plus failures."""
    v = F.col("file_valid")
    return summary.agg(
        F.count(F.lit(1)).alias("source_file_count"),
        F.coalesce(F.sum(F.when(v, F.col("total_records"))), F.lit(0)).cast("bigint").alias("source_record_count"),
        F.coalesce(F.sum(F.when(v, F.col("valid_records"))), F.lit(0)).cast("bigint").alias("valid_record_count"),
        F.coalesce(F.sum(F.when(v, F.col("rejected_records"))), F.lit(0)).cast("bigint").alias("rejected_record_count"),
        F.coalesce(F.sum(F.when(v, F.col("silver_records"))), F.lit(0)).cast("bigint").alias("silver_record_count"),
        F.min(F.when(v, F.col("watermark_start"))).alias("watermark_start"),
        F.max(F.when(v, F.col("watermark_end"))).alias("watermark_end"),
        F.count_if(~v).alias("failed_file_count"),
    )


@register("file_results", with_ctes(RETAIL_LINES_SQL, FLAGGED_SQL, BATCH_SQL) + "\nSELECT * FROM results")
def q_file_results(spark: SparkSession, sf_dir: str) -> DataFrame:
    """V5 + A3: one verdict row per file; failed files count zero."""
    return batch_results(batch_plan(spark, sf_dir))


@register(
    "batch_outcome",
    with_ctes(RETAIL_LINES_SQL, FLAGGED_SQL, BATCH_SQL)
    + """
SELECT count(*) AS selected_files, CAST(count_if(status = 'SUCCESS') AS BIGINT) AS successful_files,
       CAST(count_if(status <> 'SUCCESS') AS BIGINT) AS failed_files FROM results""",
)
def q_batch_outcome(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Selected, successful and failed files of the batch."""
    return audit.batch_outcome(batch_results(batch_plan(spark, sf_dir)))


PIPELINE_NAME = "retail_raw_to_silver"


@register(
    "run_audit",
    with_ctes(RETAIL_LINES_SQL, FLAGGED_SQL, BATCH_SQL)
    + f"""
SELECT '{RUN_ID}' AS run_id, '{PIPELINE_NAME}' AS pipeline_name, '{ENVIRONMENT}' AS environment,
       '{PROVIDER_ID}' AS provider_id, {PROCESSED_AT_SQL} AS start_time, {PROCESSED_AT_SQL} AS end_time,
       CASE WHEN r.failed = 0 THEN 'SUCCESS' ELSE 'PARTIAL_SUCCESS' END AS status,
       r.files AS source_file_count, r.src AS source_record_count, r.val AS valid_record_count,
       r.rej AS rejected_record_count, (SELECT count(*) FROM batch_silver) AS silver_record_count,
       (SELECT min(InvoiceDate) FROM batch_valid) AS watermark_start,
       (SELECT max(InvoiceDate) FROM batch_valid) AS watermark_end,
       CASE WHEN r.failed > 0 THEN CAST(r.failed AS VARCHAR) || ' file(s) failed file-level validation' END AS error_message,
       {PROCESSED_AT_SQL} AS created_at
FROM (SELECT count(*) AS files, CAST(sum(total_records) AS BIGINT) AS src, CAST(sum(valid_records) AS BIGINT) AS val,
             CAST(sum(rejected_records) AS BIGINT) AS rej, count_if(status <> 'SUCCESS') AS failed FROM results) r""",
)
def q_run_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A10: the run audit row (counts, watermark span, status)."""
    counts = batch_totals(batch_plan(spark, sf_dir))
    return audit.run_audit(counts, RUN_ID, PIPELINE_NAME, ENVIRONMENT, PROVIDER_ID, PROCESSED_AT, PROCESSED_AT, PROCESSED_AT)


@register(
    "reconciliation",
    with_ctes(RETAIL_LINES_SQL, FLAGGED_SQL, BATCH_SQL)
    + f"""
SELECT '{RUN_ID}' AS run_id, '{PROVIDER_ID}' AS provider_id,
       src AS source_count, src AS read_count, val AS valid_count, rej AS rejected_count,
       tgt AS target_count, val - tgt AS duplicate_count,
       CASE WHEN src = val + rej AND tgt = val - (val - tgt) THEN 'RECONCILED' ELSE 'NOT_RECONCILED' END AS reconciliation_status,
       {PROCESSED_AT_SQL} AS reconciliation_timestamp
FROM (SELECT CAST(sum(total_records) AS BIGINT) AS src, CAST(sum(valid_records) AS BIGINT) AS val,
             CAST(sum(rejected_records) AS BIGINT) AS rej, (SELECT count(*) FROM batch_silver) AS tgt FROM results)""",
)
def q_reconciliation(spark: SparkSession, sf_dir: str) -> DataFrame:
    """source = read = valid + rejected, target = valid - duplicates."""
    t = batch_totals(batch_plan(spark, sf_dir))
    counts = t.select(
        F.col("source_record_count").alias("source_count"),
        F.col("source_record_count").alias("read_count"),
        F.col("valid_record_count").alias("valid_count"),
        F.col("rejected_record_count").alias("rejected_count"),
        F.col("silver_record_count").alias("target_count"),
        (F.col("valid_record_count") - F.col("silver_record_count")).alias("duplicate_count"),
    )
    return audit.reconcile(counts, RUN_ID, PROVIDER_ID, PROCESSED_AT)


# ---- fixed values: faults of the delivered copy in the content reconciliation, by the invoice's number ----
LOST_MOD, DOUBLED_MOD, ALTERED_MOD = 1009, 1013, 1019

_INVOICE_NUMBER_SQL = "TRY_CAST(regexp_extract(InvoiceNo, '([0-9]+)', 1) AS BIGINT)"


def delivered_lines(valid: DataFrame) -> DataFrame:
    """The valid lines as a faulty writer delivers them: some lost, some twice, some altered."""
    number = F.regexp_extract("InvoiceNo", "([0-9]+)", 1).try_cast("bigint")
    is_fault = lambda mod: F.coalesce(number % mod == 0, F.lit(False))
    lost, doubled, altered = is_fault(LOST_MOD), is_fault(DOUBLED_MOD), is_fault(ALTERED_MOD)
    copies = F.when(lost, 0).when(doubled, 2).otherwise(1)
    out = valid.withColumn("Description", F.when(altered, F.concat(F.lit("altered "), F.coalesce("Description", F.lit("")))).otherwise(F.col("Description")))
    return out.withColumn("_copy", F.explode(F.array_repeat(F.lit(1), copies))).drop("_copy")


@register(
    "content_reconciliation",
    with_ctes(
        RETAIL_LINES_SQL,
        FLAGGED_SQL,
        f"""
faults AS (
  SELECT source_file, coalesce({_INVOICE_NUMBER_SQL} % {LOST_MOD} = 0, false) AS lost,
         coalesce({_INVOICE_NUMBER_SQL} % {DOUBLED_MOD} = 0, false) AS doubled,
         coalesce({_INVOICE_NUMBER_SQL} % {ALTERED_MOD} = 0, false) AS altered
  FROM valid_lines
),
per_file AS (
  SELECT source_file, count(*) AS expected_rows,
         CAST(sum(CASE WHEN lost THEN 0 WHEN doubled THEN 2 ELSE 1 END) AS BIGINT) AS actual_rows,
         count_if(lost OR doubled OR altered) AS faults
  FROM faults GROUP BY source_file
)""",
    )
    + """
SELECT source_file, expected_rows, actual_rows,
       CASE WHEN actual_rows < expected_rows THEN 'rows lost' WHEN actual_rows > expected_rows THEN 'rows added'
            WHEN faults > 0 THEN 'rows altered' END AS difference,
       CASE WHEN faults = 0 THEN 'RECONCILED' ELSE 'NOT_RECONCILED' END AS reconciliation_status
FROM per_file""",
)
def q_content_reconciliation(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A12 by content: the valid lines of every file against a written copy with lost,
    doubled and altered rows, read back from its table; one verdict a file."""
    valid, _ = valid_and_rejected(spark, sf_dir)
    written = cut_lineage(delivered_lines(valid), "delivered")
    by = ["source_file"]
    return compare_contents(contents(valid, RAW_COLUMNS, by), contents(written, RAW_COLUMNS, by), by)


_DAY_SQL = "date_diff('day', DATE '1970-01-01', CAST(source_date AS DATE))"


@register(
    "manifest_file",
    with_ctes(
        DAILY_SQL,
        f"""
listed AS (
  SELECT 'as counted' AS manifest, relative_path, record_count FROM daily
  UNION ALL
  SELECT 'off', relative_path, record_count + CASE WHEN {_DAY_SQL} % {MANIFEST_COUNT_OFF_MOD} = 0 THEN 1 ELSE 0 END
  FROM daily WHERE {_DAY_SQL} % {MANIFEST_DROP_MOD} <> 0
),
there AS (SELECT m.manifest, d.relative_path, d.record_count FROM daily d CROSS JOIN (SELECT DISTINCT manifest FROM listed) m),
checked AS (
  SELECT coalesce(l.manifest, t.manifest) AS manifest, l.record_count AS expected, t.record_count AS actual
  FROM listed l FULL OUTER JOIN there t ON l.manifest = t.manifest AND l.relative_path = t.relative_path
)""",
    )
    + """
SELECT manifest, CAST(count(expected) AS BIGINT) AS listed_files, CAST(count(actual) AS BIGINT) AS present_files,
       CAST(coalesce(sum(expected), 0) AS BIGINT) AS manifest_records, CAST(coalesce(sum(actual), 0) AS BIGINT) AS counted_records,
       CAST(count_if(expected IS NULL OR actual IS NULL OR expected <> actual) AS BIGINT) AS failed_files,
       coalesce(sum(expected), 0) = coalesce(sum(actual), 0) AND count_if(expected IS NULL OR actual IS NULL OR expected <> actual) = 0 AS reconciled
FROM checked GROUP BY manifest""",
)
def q_manifest_file(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two manifests written as files and read back, one as counted and one
    with counts off and files left out; each totalled against the records counted."""
    daily = cut_lineage(daily_plan(spark, sf_dir), "daily")
    day = F.unix_date(F.to_date("source_date"))
    off = daily.where(day % MANIFEST_DROP_MOD != 0).withColumn(
        "record_count", F.col("record_count") + F.when(day % MANIFEST_COUNT_OFF_MOD == 0, 1).otherwise(0)
    )
    out = None
    for name, manifest in (("as counted", daily), ("off", off)):
        path = scratch_path(spark, "manifest")
        write_manifest(manifest.withColumn("sha256", F.lit(None).cast("string")), path)
        checked = mf.verify_manifest(read_manifest(spark, path), daily.select("relative_path", "record_count"))
        total = mf.manifest_reconciliation(checked).select(F.lit(name).alias("manifest"), "*")
        out = total if out is None else out.unionByName(total)
    return out


# ------------------------------------------------------------ file round trips (rows-only checks)
#
# These stage files derived from the tables below the shared checkpoint folder
# and run the file path end to end: discovery, hashing, header checks, CSV
# reads, sinks, state and manifests.


def stage_raw_files(spark: SparkSession, sf_dir: str) -> str:
    """The raw layer written as daily CSV files (``source_date=YYYY-MM-DD/part-*.csv``)."""
    root = scratch_path(spark, "raw")
    raw = retail_lines(spark, sf_dir, by_day=True).withColumn(
        "source_date", F.date_format(source_date_from_name("source_file"), "yyyy-MM-dd")
    )
    with shuffles_removed(spark):
        (
            raw.select(*RAW_COLUMNS, "source_date")
            .write.option("header", "true")
            .option("escape", '"')
            .option("ignoreLeadingWhiteSpace", "false")
            .option("ignoreTrailingWhiteSpace", "false")
            .partitionBy("source_date")
            .csv(f"{root}/{PROVIDER_ID}")
        )
    return root


@register("discover_files")
def q_discover_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Discovered daily files (date from the partition folder), numbered."""
    raw = stage_raw_files(spark, sf_dir)
    files = discover(spark, raw, date_from="partition").select("source_uri", "source_file", "source_date")
    return inc.sequence_files(files, order=["source_date", "source_file", "source_uri"])


FINGERPRINT_DAILY_SQL = with_ctes(RETAIL_LINES_SQL) + """
SELECT strftime(CAST(strptime(regexp_extract(source_file, '(\\d{8})', 1), '%Y%m%d') AS DATE), '%Y-%m-%d') AS source_date,
       count(*) AS physical_records,
       'InvoiceNo,StockCode,Description,Quantity,InvoiceDate,UnitPrice,CustomerID,Country' AS header,
       CAST(0 AS BIGINT) AS too_large_files
FROM retail_lines GROUP BY 1"""


@register("file_fingerprints", FINGERPRINT_DAILY_SQL)
def q_file_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    """SHA-256, length, physical record count and header of every staged file
    (read in chunks on the executors), summed per day: part-file bytes depend on Spark's row
    order, day totals and headers do not (hashes are checked against hashlib in tests)."""
    raw = stage_raw_files(spark, sf_dir)
    fp = fingerprint(spark, raw).filter(F.col("length") > 0)
    day = F.regexp_extract(F.col("source_uri"), r"source_date=(\d{4}-\d{2}-\d{2})", 1)
    return fp.groupBy(day.alias("source_date")).agg(
        F.sum("physical_records").cast("bigint").alias("physical_records"),
        F.max(F.array_join("header", ",")).alias("header"),
        F.count_if(F.col("source_checksum").isNull()).alias("too_large_files"),
    )


def _ingest(spark: SparkSession, sf_dir: str):
    raw = stage_raw_files(spark, sf_dir)
    out = scratch_path(spark, "layers")
    paths = {k: f"{out}/{k}" for k in ("bronze", "quarantine", "state", "silver")}
    results = ingest_batch(
        spark, raw, paths["bronze"], paths["quarantine"], paths["state"], PROVIDER_ID, RUN_ID, now=PROCESSED_AT, date_from="partition"
    )
    return results, paths


INGEST_DAILY_SQL = with_ctes(RETAIL_LINES_SQL, FLAGGED_SQL) + """
SELECT strftime(CAST(strptime(regexp_extract(source_file, '(\\d{8})', 1), '%Y%m%d') AS DATE), '%Y-%m-%d') AS source_date,
       count(*) AS total_records,
       CAST(count_if(rejection_reason = '') AS BIGINT) AS valid_records,
       CAST(count_if(rejection_reason <> '') AS BIGINT) AS rejected_records,
       CAST(0 AS BIGINT) AS failed_files
FROM flagged_lines GROUP BY 1"""


@register("ingest_roundtrip", INGEST_DAILY_SQL)
def q_ingest_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """W9 + K3/K4/K5 + M1-M3 + R10: one batch job over all staged files; the per-file
    results summed per day (part-file names vary, day totals do not)."""
    results, _ = _ingest(spark, sf_dir)
    return results.groupBy(F.date_format("source_date", "yyyy-MM-dd").alias("source_date")).agg(
        F.sum("total_records").cast("bigint").alias("total_records"),
        F.sum("valid_records").cast("bigint").alias("valid_records"),
        F.sum("rejected_records").cast("bigint").alias("rejected_records"),
        F.count_if(F.col("status") != st.SUCCESS).alias("failed_files"),
    )


@register(
    "silver_overwrite",
    "SELECT SourceDate, count(*) AS line_count FROM (" + SILVER_SQL + ") GROUP BY SourceDate",
)
def q_silver_overwrite(spark: SparkSession, sf_dir: str) -> DataFrame:
    """K6 + A2: bronze (valid lines of the daily files) -> silver twice into the same
    table; dynamic overwrite keeps it whole, not doubled. Rows per SourceDate."""
    out = scratch_path(spark, "layers")
    valid, _ = valid_and_rejected(spark, sf_dir, by_day=True)
    bronze = valid.withColumn("source_date", F.date_format(source_date_from_name("source_file"), "yyyy-MM-dd"))
    write_bronze(bronze, f"{out}/bronze")
    for _ in range(2):
        bronze_to_silver(spark, f"{out}/bronze", f"{out}/silver", RUN_ID, processed_at=PROCESSED_AT)
    return spark.read.parquet(f"{out}/silver").groupBy("SourceDate").agg(F.count(F.lit(1)).alias("line_count"))


@register(
    "prepare_roundtrip",
    """SELECT strftime(l_shipdate, '%Y-%m-%d') AS source_date, count(*) AS manifest_records,
       count(*) AS counted_records, true AS all_ok
FROM lineitem GROUP BY 1""",
)
def q_prepare_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """S12/P3/K1/K2 then V2, V6-V12: write daily files and their manifest, verify every
    file (header, count, dates, checksum); per day: records listed, records
    counted, and whether all of the day's files passed."""
    out = scratch_path(spark, "prepared")
    manifest = cut_lineage(prepare_source(spark, source_lines(spark, sf_dir), out, PROVIDER_ID))
    checked = verify_source(spark, manifest, out, PROVIDER_ID)
    return checked.groupBy(F.col("expected_date").alias("source_date")).agg(
        F.sum("expected_count").cast("bigint").alias("manifest_records"),
        F.sum("actual_count").cast("bigint").alias("counted_records"),
        F.bool_and(F.col("status") == "OK").alias("all_ok"),
    )


@register("stream_dedup", "SELECT DISTINCT user_id, event_type FROM events")
def q_stream_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """W7/W9 streaming: events as a file stream (four files, one per trigger),
    watermark longer than the data span (measured first), dedup within the
    watermark -- equal to the batch distinct."""
    staged = scratch_path(spark, "events-stream")
    events = table(spark, sf_dir, "events")
    ts = F.col("ts").cast("timestamp")
    span = events.agg(F.unix_seconds(F.max(ts)) - F.unix_seconds(F.min(ts))).first()[0] or 0
    events.repartition(4).write.parquet(f"{staged}/in")
    stream = (
        spark.readStream.schema(events.schema).option("maxFilesPerTrigger", 1).parquet(f"{staged}/in")
    )
    deduped = dedup_stream(stream, ["user_id", "event_type"], "ts", delay=f"{span + 86400} seconds")
    run_available_now(deduped.select("user_id", "event_type", "ts"), f"{staged}/_checkpoint", f"{staged}/out")
    return spark.read.parquet(f"{staged}/out").select("user_id", "event_type")


# ---- fixed values: events that come last, and events that come twice ----
LATE_MOD, TWICE_MOD = 20, 50
LATE_DELAY = "2 hours"
# Rows of a slice for each task slot.
SLICE_ROWS = 50_000


def time_slices(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame, int]:
    """(events, events with ``slice``, number of slices): slices of time by the input's size; a twentieth comes last.

    A micro-batch has a fixed cost, so a slice gives every task slot ``SLICE_ROWS`` rows, not one slot alone.
    """
    events = table(spark, sf_dir, "events").withColumn("ts", F.col("ts").cast("timestamp")).select("event_id", "ts", "user_id", "event_type")
    bounds = events.agg(F.count(F.lit(1)).alias("n"), F.min(F.unix_micros("ts")).alias("a"), F.max(F.unix_micros("ts")).alias("b")).first()
    slices = max(2, -(-bounds["n"] // (SLICE_ROWS * max(1, spark.sparkContext.defaultParallelism))))
    width = max(1, ((bounds["b"] or 0) - (bounds["a"] or 0)) // slices + 1)
    part = F.floor((F.unix_micros("ts") - F.lit(bounds["a"] or 0)) / width).cast("int")
    return events, events.withColumn("slice", F.when(F.col("event_id") % LATE_MOD == 0, F.lit(slices)).otherwise(part)), slices


def stage_slices(dealt: DataFrame, name: str) -> DataFrame:
    """``dealt`` staged by slice: reading one (``slice == k``) reads that folder alone, not all slices again."""
    path = scratch_path(dealt.sparkSession, name)
    dealt.hint("rebalance", "slice").write.partitionBy("slice").parquet(path)
    return dealt.sparkSession.read.schema(dealt.schema).parquet(path)


@register(
    "stream_late_rows",
    f"""
WITH seen AS (SELECT max(ts) AS m FROM events WHERE event_id % {LATE_MOD} <> 0)
SELECT e.event_id, e.ts, coalesce(e.event_id % {LATE_MOD} = 0 AND e.ts < seen.m - INTERVAL {LATE_DELAY}, false) AS late
FROM events e CROSS JOIN seen""",
)
def q_stream_late_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """W7 streaming: events arrive in slices of time (their number follows the input's size), some
    twice; a twentieth comes after all others, mostly behind the watermark. Every event
    reaches the target once, those behind the watermark marked."""
    staged = scratch_path(spark, "late-stream")
    events, dealt, slices = time_slices(spark, sf_dir)
    again = dealt.where(F.col("event_id") % TWICE_MOD == 1).withColumn("slice", F.lit(slices))
    dealt = stage_slices(dealt.unionByName(again), "late-slices")
    for k in range(slices + 1):
        dealt.where(F.col("slice") == k).drop("slice").write.parquet(f"{staged}/in/slice_{k:06d}")
        stream = spark.readStream.schema(events.schema).option("recursiveFileLookup", "true").parquet(f"{staged}/in")
        keep_late(stream, f"{staged}/out", f"{staged}/_checkpoint", ["event_id"], "ts", LATE_DELAY)
    return spark.read.parquet(f"{staged}/out").select("event_id", "ts", "late")


# ---- fixed value: lookback of the stream's windows, in minutes ----
STREAM_LOOKBACK = 120


@register(
    "stream_watermarks",
    f"""
WITH seen AS (SELECT event_type, max(ts) AS m FROM events WHERE event_id % {LATE_MOD} <> 0 GROUP BY event_type),
placed AS (
  SELECT e.event_type, e.ts, seen.m,
         coalesce(e.event_id % {LATE_MOD} = 0 AND e.ts < seen.m - INTERVAL {STREAM_LOOKBACK} MINUTE, false) AS behind
  FROM events e LEFT JOIN seen USING (event_type)
)
SELECT event_type AS provider_id, max(ts) AS last_processed_event_time, 'SUCCESS' AS last_run_status,
       max(m) AS watermark_after_failure, count_if(NOT behind)::BIGINT AS rows_inside, count_if(behind)::BIGINT AS rows_behind
FROM placed GROUP BY event_type""",
)
def q_stream_watermarks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """W2/W8/M4-M7 streaming: events arrive in slices of time, each event type a provider with its own
    watermark and lookback; a twentieth comes last. The last micro-batch fails once after its rows
    are written: the watermarks stay, the restart writes the same rows and moves them."""
    staged = scratch_path(spark, "watermark-stream")
    events, dealt, slices = time_slices(spark, sf_dir)
    dealt = stage_slices(dealt, "watermark-slices")

    def run(fail: bool) -> None:
        def handler(inside: DataFrame, behind: DataFrame, epoch: int) -> None:
            for part, rows in (("inside", inside), ("behind", behind)):
                rows.write.mode("overwrite").parquet(f"{staged}/out/{part}/epoch_{epoch}")
            if fail:
                raise RuntimeError("the run is to fail")

        stream = spark.readStream.schema(events.schema).option("recursiveFileLookup", "true").parquet(f"{staged}/in")
        window_stream(
            stream, f"{staged}/state", f"{staged}/_checkpoint", handler, provider_col="event_type", ts_col="ts", lookback_minutes=STREAM_LOOKBACK
        )

    for k in range(slices):
        dealt.where(F.col("slice") == k).drop("slice").write.parquet(f"{staged}/in/slice_{k:06d}")
        run(fail=False)
    dealt.where(F.col("slice") == slices).drop("slice").write.parquet(f"{staged}/in/slice_{slices:06d}")
    try:
        run(fail=True)
    except StreamingQueryException as error:
        if "the run is to fail" not in str(error):
            raise
    failed = cut_lineage(ingestion_log(spark, f"{staged}/state").where("last_processed_event_time > TIMESTAMP '1970-01-01'"), "failed-states")
    run(fail=False)
    out = None
    for part in ("inside", "behind"):
        rows = spark.read.schema(events.schema).option("recursiveFileLookup", "true").parquet(f"{staged}/out/{part}")
        rows = rows.select(F.col("event_type").alias("provider_id"), F.lit(part).alias("part"))
        out = rows if out is None else out.unionByName(rows)
    counts = out.groupBy("provider_id").agg(F.count_if(F.col("part") == "inside").alias("rows_inside"), F.count_if(F.col("part") == "behind").alias("rows_behind"))
    after = failed.select("provider_id", F.col("last_processed_event_time").alias("watermark_after_failure"))
    state = ingestion_log(spark, f"{staged}/state").select("provider_id", "last_processed_event_time", "last_run_status")
    return state.join(after, "provider_id", "left").join(counts, "provider_id")


STREAM_INGEST_SQL = with_ctes(RETAIL_LINES_SQL, FLAGGED_SQL) + """
SELECT strftime(CAST(strptime(regexp_extract(source_file, '(\\d{8})', 1), '%Y%m%d') AS DATE), '%Y-%m-%d') AS source_date,
       count(*) AS total_records,
       CAST(count_if(rejection_reason = '') AS BIGINT) AS valid_records,
       CAST(count_if(rejection_reason <> '') AS BIGINT) AS rejected_records
FROM flagged_lines GROUP BY 1"""


@register("stream_ingest", STREAM_INGEST_SQL)
def q_stream_ingest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """W9 streaming: staged daily files read as a file stream (2000 files per
    trigger), validated per micro-batch with the batch operators and routed to
    bronze / quarantine via foreachBatch; per-day totals of what was written."""
    raw = stage_raw_files(spark, sf_dir)
    out = scratch_path(spark, "stream-layers")
    ingest_stream(spark, raw, f"{out}/bronze", f"{out}/quarantine", f"{out}/_checkpoint", max_files_per_trigger=2000)
    opts = {"header": "true", "escape": '"', "multiLine": "true"}
    bronze = spark.read.options(**opts).csv(f"{out}/bronze").select(
        F.col("source_date").cast("string").alias("source_date"), F.lit(1).alias("v"), F.lit(0).alias("r")
    )
    quarantine = spark.read.options(**opts).csv(f"{out}/quarantine/rows").select(
        F.col("source_date").cast("string").alias("source_date"), F.lit(0).alias("v"), F.lit(1).alias("r")
    )
    return (
        bronze.unionByName(quarantine)
        .groupBy("source_date")
        .agg(
            F.count(F.lit(1)).alias("total_records"),
            F.sum("v").cast("bigint").alias("valid_records"),
            F.sum("r").cast("bigint").alias("rejected_records"),
        )
    )


@register(
    "manifest_totals",
    with_ctes(DAILY_SQL) + "\nSELECT count(*) AS file_count, CAST(sum(record_count) AS BIGINT) AS record_count FROM daily",
)
def q_manifest_totals(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Files and records the daily manifest represents."""
    return mf.manifest_totals(daily_plan(spark, sf_dir))


# ---- fixed values: event of an incoming state row, by its event type ----
EVENT_OF_TYPE = [("purchase", "validated"), ("click", "file_invalid"), ("error", "error")]


@register(
    "status_transitions",
    with_ctes(EVENT_STATE_SQL)
    + """
SELECT s.provider_id, s.source_uri, s.source_checksum, s.event, t.status AS from_status,
       coalesce(
         CASE WHEN t.status = 'PROCESSING' AND s.event = 'validated' THEN 'SUCCESS'
              WHEN t.status = 'PROCESSING' AND s.event = 'file_invalid' THEN 'FILE_VALIDATION_FAILED'
              WHEN t.status = 'PROCESSING' AND s.event = 'error' THEN 'FAILED'
              WHEN t.status = 'FILE_VALIDATION_FAILED' AND s.event = 'error' THEN 'FILE_VALIDATION_FAILED' END,
         CASE WHEN s.event = 'start' THEN 'PROCESSING' END,
         t.status) AS status
FROM (SELECT provider_id, source_uri, source_checksum,
             CASE source_checksum WHEN 'purchase' THEN 'validated' WHEN 'click' THEN 'file_invalid'
                                  WHEN 'error' THEN 'error' ELSE 'start' END AS event
      FROM src) s
LEFT JOIN tgt t ON t.provider_id = s.provider_id AND t.source_uri = s.source_uri AND t.source_checksum = s.source_checksum""",
)
def q_status_transitions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """M3: incoming events applied to the current status through the transition table."""
    target, source = state_halves(spark, sf_dir)
    event = F.lit("start")
    for etype, ev in reversed(EVENT_OF_TYPE):
        event = F.when(F.col("source_checksum") == etype, F.lit(ev)).otherwise(event)
    events = source.select(*FILE_STATE_KEYS, event.alias("event"))
    return st.apply_events(target, events)

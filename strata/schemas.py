"""Fixed schemas of the data model.

The column names, their order and the type names below are fixed values that
must equal the reference's contract for results to line up.
"""

from __future__ import annotations

from pyspark.sql import types as T

# ---- fixed values: business columns of one raw line, in file order ----
RAW_COLUMNS = [
    "InvoiceNo",
    "StockCode",
    "Description",
    "Quantity",
    "InvoiceDate",
    "UnitPrice",
    "CustomerID",
    "Country",
]

# ---- fixed values: silver projection, in output order ----
SILVER_COLUMNS = [
    "InvoiceNo",
    "StockCode",
    "Description",
    "Quantity",
    "InvoiceDate",
    "UnitPrice",
    "CustomerID",
    "Country",
    "LineAmount",
    "IsCancellation",
    "SourceFile",
    "SourceDate",
    "SourceChecksum",
    "PipelineRunID",
    "ProcessedAt",
]

# ---- fixed values: the leading columns of a rejected line ----
REJECT_META_COLUMNS = ["record_number", "record_identifier", "rejection_reason"]

# ---- fixed values: contract of the raw line (column, order, type, nullable) ----
RAW_CONTRACT = [
    ("InvoiceNo", 1, "STRING", False),
    ("StockCode", 2, "STRING", False),
    ("Description", 3, "STRING", True),
    ("Quantity", 4, "INT64", False),
    ("InvoiceDate", 5, "TIMESTAMP", False),
    ("UnitPrice", 6, "FLOAT64", False),
    ("CustomerID", 7, "STRING", True),
    ("Country", 8, "STRING", False),
]

# ---- fixed values: contract of the silver line (column, type, nullable) ----
SILVER_CONTRACT = [
    ("InvoiceNo", "STRING", False),
    ("StockCode", "STRING", False),
    ("Description", "STRING", True),
    ("Quantity", "INT64", False),
    ("InvoiceDate", "TIMESTAMP", False),
    ("UnitPrice", "FLOAT64", False),
    ("CustomerID", "STRING", True),
    ("Country", "STRING", False),
    ("LineAmount", "FLOAT64", False),
    ("IsCancellation", "BOOLEAN", False),
    ("SourceFile", "STRING", False),
    ("SourceDate", "DATE", False),
    ("SourceChecksum", "STRING", False),
    ("PipelineRunID", "STRING", False),
    ("ProcessedAt", "TIMESTAMP", False),
]

# Logical type name -> Spark type.
LOGICAL_TYPES = {
    "STRING": T.StringType(),
    "INT64": T.LongType(),
    "FLOAT64": T.DoubleType(),
    "TIMESTAMP": T.TimestampType(),
    "DATE": T.DateType(),
    "BOOLEAN": T.BooleanType(),
}

RAW_STRING_SCHEMA = T.StructType([T.StructField(c, T.StringType(), True) for c in RAW_COLUMNS])


def _struct(fields):
    return T.StructType([T.StructField(n, t, nullable) for n, t, nullable in fields])


S, L, TS, D, B, DBL = T.StringType(), T.LongType(), T.TimestampType(), T.DateType(), T.BooleanType(), T.DoubleType()

FILE_STATE_SCHEMA = _struct(
    [
        ("provider_id", S, False),
        ("source_uri", S, False),
        ("source_file", S, False),
        ("source_date", D, True),
        ("source_checksum", S, False),
        ("status", S, False),
        ("run_id", S, True),
        ("first_processed_at", TS, True),
        ("last_processed_at", TS, True),
        ("record_count", L, True),
        ("valid_record_count", L, True),
        ("rejected_record_count", L, True),
        ("error_message", S, True),
        ("created_at", TS, False),
        ("updated_at", TS, False),
    ]
)
FILE_STATE_KEYS = ["provider_id", "source_uri", "source_checksum"]

INGESTION_STATE_SCHEMA = _struct(
    [
        ("provider_id", S, False),
        ("layer", S, False),
        ("last_processed_event_time", TS, True),
        ("max_event_time_seen", TS, True),
        ("lookback_minutes", L, False),
        ("last_run_status", S, False),
        ("last_run_id", S, True),
        ("last_run_time", TS, True),
        ("updated_at", TS, False),
    ]
)
INGESTION_STATE_KEYS = ["provider_id", "layer"]

DATA_CONFIG_SCHEMA = _struct(
    [
        ("provider_id", S, False),
        ("raw_path", S, False),
        ("bronze_path", S, False),
        ("silver_path", S, False),
        ("quarantine_path", S, False),
        ("file_format", S, False),
        ("delimiter", S, True),
        ("write_mode", S, False),
        ("header", B, True),
        ("ingestion_frequency", S, False),
        ("active", B, False),
        ("created_at", TS, False),
        ("updated_at", TS, False),
    ]
)

SCHEMA_CONFIG_SCHEMA = _struct(
    [
        ("provider_id", S, False),
        ("table_name", S, False),
        ("column_name", S, False),
        ("column_order", L, False),
        ("data_type", S, False),
        ("nullable", B, False),
        ("description", S, True),
        ("active", B, False),
        ("created_at", TS, False),
        ("updated_at", TS, False),
    ]
)

EXTRA_CONFIG_SCHEMA = _struct(
    [
        ("provider_id", S, False),
        ("rule_name", S, False),
        ("rule_type", S, False),
        ("rule_condition", S, False),
        ("severity", S, False),
        ("active", B, False),
        ("created_at", TS, False),
        ("updated_at", TS, False),
    ]
)

RUN_AUDIT_COLUMNS = [
    "run_id",
    "pipeline_name",
    "environment",
    "provider_id",
    "start_time",
    "end_time",
    "status",
    "source_file_count",
    "source_record_count",
    "valid_record_count",
    "rejected_record_count",
    "silver_record_count",
    "watermark_start",
    "watermark_end",
    "error_message",
    "created_at",
]

REJECTION_AUDIT_COLUMNS = [
    "run_id",
    "provider_id",
    "source_file",
    "record_identifier",
    "rule_name",
    "rejection_reason",
    "rejected_at",
    "environment",
]

RECONCILIATION_COLUMNS = [
    "run_id",
    "provider_id",
    "source_count",
    "read_count",
    "valid_count",
    "rejected_count",
    "target_count",
    "reconciliation_status",
    "reconciliation_timestamp",
]

MANIFEST_SCHEMA = _struct(
    [
        ("provider_id", S, True),
        ("source_date", S, True),
        ("file_name", S, True),
        ("relative_path", S, True),
        ("record_count", L, True),
        ("sha256", S, True),
    ]
)

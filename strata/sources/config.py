"""Configuration tables as DataFrames.

Feed configuration, schema contracts and rule tables are small tables (one row
per feed, per column, per rule). They are DataFrames like any other; only the
rows a job needs to build its reader or its rule expressions are collected.
"""

from __future__ import annotations

import datetime as _dt
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from strata.operators.rules import DECLARED_RULES
from strata.schemas import DATA_CONFIG_SCHEMA, EXTRA_CONFIG_SCHEMA, INGESTION_STATE_KEYS, RAW_CONTRACT, SCHEMA_CONFIG_SCHEMA


def feed_config(
    spark: SparkSession,
    feeds: Sequence[dict],
    now: _dt.datetime | None = None,
) -> DataFrame:
    """DataConfig rows from dicts (paths are parameters, never built in)."""
    ts = now or _dt.datetime.now(_dt.timezone.utc).replace(tzinfo=None)
    rows = []
    for f in feeds:
        rows.append(
            (
                f["provider_id"],
                f["raw_path"],
                f["bronze_path"],
                f["silver_path"],
                f["quarantine_path"],
                f.get("file_format", "CSV"),
                f.get("delimiter", ","),
                f.get("write_mode", "APPEND"),
                f.get("header", True),
                f.get("ingestion_frequency", "DAILY"),
                f.get("active", True),
                ts,
                ts,
            )
        )
    return spark.createDataFrame(rows, DATA_CONFIG_SCHEMA)


def active_feeds(config: DataFrame) -> DataFrame:
    """The active feeds."""
    return config.filter(F.col("active"))


def reader_options(feed_row) -> dict:
    """CSV reader options of one feed row (format, separator, header)."""
    return {
        "format": (feed_row["file_format"] or "CSV").lower(),
        "sep": feed_row["delimiter"] or ",",
        "header": str(bool(feed_row["header"]) if feed_row["header"] is not None else True).lower(),
    }


def schema_config(spark: SparkSession, provider_id: str = "provider_retail", table_name: str = "retail_sales", now=None) -> DataFrame:
    """S11 seed: the declared contract of the raw line as SchemaConfig rows."""
    ts = now or _dt.datetime(1970, 1, 1)
    rows = [(provider_id, table_name, n, o, t, nl, None, True, ts, ts) for n, o, t, nl in RAW_CONTRACT]
    return spark.createDataFrame(rows, SCHEMA_CONFIG_SCHEMA)


def rule_config(spark: SparkSession, provider_id: str = "provider_retail", now=None) -> DataFrame:
    """R7 seed: the declared rules as ExtraConfig rows."""
    ts = now or _dt.datetime(1970, 1, 1)
    rows = [(provider_id, n, t, c, s, a, ts, ts) for n, t, c, s, a in DECLARED_RULES]
    return spark.createDataFrame(rows, EXTRA_CONFIG_SCHEMA)


def ingestion_state(state: DataFrame, provider_id: str, layer: str) -> DataFrame:
    """The state row of (provider, layer). The reference reads "any one row";
    here a second row for the key is an error (``assert_unique_keys``)."""
    return state.filter((F.col("provider_id") == provider_id) & (F.col("layer") == layer))


def assert_unique_keys(state: DataFrame, keys: Sequence[str] = INGESTION_STATE_KEYS) -> None:
    """Fail when a key has more than one row (a small aggregate result)."""
    dup = state.groupBy(*keys).count().filter(F.col("count") > 1).limit(5).collect()
    if dup:
        raise RuntimeError(f"state keys with more than one row: {[tuple(r)[:-1] for r in dup]}")

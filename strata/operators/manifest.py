"""Source preparation and manifest checks (SURVEY §2.2 F3, §2.3 V6-V12, §2.5 P3/P12,
§2.6 A5-A7, §2.7 J1).

The reference loops over manifest rows and stops at the first bad file; here
every check is a column of one per-file DataFrame (a full outer join of the
manifest with what is actually there), with ``status`` naming the first
failing check in the reference's order (missing, schema, count, dates,
partition date, checksum).
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from strata.functions.expr import DEFAULT_TIMESTAMP_FORMATS, try_timestamp

DEFAULT_PROVIDER = "provider_retail"


def _strict(c: Column, target: str, name: str) -> Column:
    """Cast that fails the job on a bad value (independent of the ANSI setting)."""
    t = c.try_cast(target)
    return F.when(c.isNotNull() & t.isNull(), F.raise_error(F.lit(f"strict cast of {name} to {target} failed"))).otherwise(t)


def prepare(df: DataFrame) -> DataFrame:
    """Strict typing of the source; ids stay text, CustomerID via an integer
    (``17850``, not ``17850.0``). A value that does not convert raises."""
    cust = F.col("CustomerID")
    cust_long = _strict(cust.cast("string").try_cast("double"), "bigint", "CustomerID") if dict(df.dtypes)["CustomerID"] in ("string",) else _strict(cust, "bigint", "CustomerID")
    ts = F.col("InvoiceDate")
    if dict(df.dtypes)["InvoiceDate"] == "string":
        parsed = try_timestamp(ts, DEFAULT_TIMESTAMP_FORMATS)
        ts_out = F.when(ts.isNotNull() & parsed.isNull(), F.raise_error(F.lit("strict parse of InvoiceDate failed"))).otherwise(parsed)
    else:
        ts_out = ts.cast("timestamp")
    return df.select(
        F.col("InvoiceNo").cast("string").alias("InvoiceNo"),
        F.col("StockCode").cast("string").alias("StockCode"),
        F.col("Description").cast("string").alias("Description"),
        _strict(F.col("Quantity"), "bigint", "Quantity").alias("Quantity"),
        ts_out.alias("InvoiceDate"),
        _strict(F.col("UnitPrice"), "double", "UnitPrice").alias("UnitPrice"),
        cust_long.cast("string").alias("CustomerID"),
        F.col("Country").cast("string").alias("Country"),
    )


def with_daily_file(df: DataFrame, provider_id: str = DEFAULT_PROVIDER) -> DataFrame:
    """P12 + A5: ``source_date`` text (yyyy-MM-dd) of InvoiceDate, the daily file
    name ``retail_sales_YYYYMMDD.csv`` and its path relative to the output root."""
    d = F.date_format(F.col("InvoiceDate"), "yyyy-MM-dd")
    name = F.concat(F.lit("retail_sales_"), F.date_format(F.col("InvoiceDate"), "yyyyMMdd"), F.lit(".csv"))
    return (
        df.withColumn("source_date", d)
        .withColumn("file_name", name)
        .withColumn("relative_path", F.concat_ws("/", F.lit(provider_id), F.col("source_date"), F.col("file_name")))
    )


def daily_counts(prepared: DataFrame, provider_id: str = DEFAULT_PROVIDER) -> DataFrame:
    """Manifest rows without checksums -- records per daily file."""
    return (
        with_daily_file(prepared, provider_id)
        .groupBy("source_date", "file_name", "relative_path")
        .agg(F.count(F.lit(1)).alias("record_count"))
        .select(F.lit(provider_id).alias("provider_id"), "source_date", "file_name", "relative_path", "record_count")
    )


def manifest_totals(manifest: DataFrame) -> DataFrame:
    """Number of files and records the manifest represents."""
    return manifest.agg(
        F.count(F.lit(1)).alias("file_count"), F.sum("record_count").cast("bigint").alias("record_count")
    )


def date_purity(
    lines: DataFrame,
    file_col: str,
    date_text_col: str = "InvoiceDate",
    declared_col: str | None = None,
    formats: Sequence[str] = DEFAULT_TIMESTAMP_FORMATS,
) -> DataFrame:
    """V7-V9 + A7 per file: all InvoiceDate values parse, exactly one calendar date,
    and it equals the declared date. ``date_text_col`` may be text or timestamp."""
    ts = F.col(date_text_col)
    parsed = try_timestamp(ts, formats) if dict(lines.dtypes)[date_text_col] == "string" else ts.cast("timestamp")
    d = F.to_date(parsed)
    aggs = [
        F.count(F.lit(1)).alias("record_count"),
        F.count_if(parsed.isNull()).alias("unparsed_dates"),
        F.count_distinct(d).alias("distinct_dates"),
        F.min(d).alias("min_date"),
    ]
    if declared_col:
        aggs.append(F.min(F.to_date(F.col(declared_col))).alias("declared_date"))
    out = lines.groupBy(file_col).agg(*aggs)
    all_parse = F.col("unparsed_dates") == 0
    one_date = F.col("distinct_dates") == 1
    out = out.withColumn("all_dates_parse", all_parse).withColumn("single_date", one_date)
    if declared_col:
        out = out.withColumn("date_matches", one_date & (F.col("min_date") == F.col("declared_date")))
        first = (
            F.when(~all_parse, F.lit("invalid_invoice_date"))
            .when(~one_date, F.lit("multiple_dates"))
            .when(~F.col("date_matches"), F.lit("date_mismatch"))
        )
    else:
        first = F.when(~all_parse, F.lit("invalid_invoice_date")).when(~one_date, F.lit("multiple_dates"))
    return out.withColumn("first_failure", first)


def verify_manifest(
    manifest: DataFrame,
    actual: DataFrame,
    key: str = "relative_path",
) -> DataFrame:
    """J1 + V6, V8-V11 per file, full outer join on the relative path.

    ``manifest``: relative_path, source_date, record_count, sha256 (may be NULL).
    ``actual``: relative_path plus whatever was measured of the file:
    record_count, sha256, header_ok, all_dates_parse, single_date, min_date.
    Files on disk but not in the manifest come out as ``unlisted`` (the
    reference never notices them).
    """
    m = manifest.select(
        F.col(key),
        F.col("source_date").alias("expected_date"),
        F.col("record_count").cast("bigint").alias("expected_count"),
        (F.col("sha256") if "sha256" in manifest.columns else F.lit(None).cast("string")).alias("expected_sha256"),
        F.lit(True).alias("listed"),
    )
    cols = {c for c in actual.columns}
    a = actual.select(
        F.col(key),
        F.col("record_count").cast("bigint").alias("actual_count"),
        (F.col("sha256") if "sha256" in cols else F.lit(None).cast("string")).alias("actual_sha256"),
        (F.col("header_ok") if "header_ok" in cols else F.lit(True)).alias("header_ok"),
        (F.col("all_dates_parse") if "all_dates_parse" in cols else F.lit(True)).alias("all_dates_parse"),
        (F.col("single_date") if "single_date" in cols else F.lit(True)).alias("single_date"),
        (F.date_format("min_date", "yyyy-MM-dd") if "min_date" in cols else F.lit(None).cast("string")).alias("actual_date"),
        F.lit(True).alias("present"),
    )
    j = m.join(a, on=key, how="full_outer")
    listed = F.coalesce(F.col("listed"), F.lit(False))
    present = F.coalesce(F.col("present"), F.lit(False))
    count_ok = F.col("expected_count") == F.col("actual_count")
    date_ok = F.col("actual_date").isNull() | (F.col("actual_date") == F.col("expected_date"))
    sum_ok = F.col("expected_sha256").isNull() | (F.col("expected_sha256") == F.col("actual_sha256"))
    status = (
        F.when(~present, F.lit("MISSING_FILE"))
        .when(~listed, F.lit("UNLISTED_FILE"))
        .when(~F.col("header_ok"), F.lit("SCHEMA_MISMATCH"))
        .when(~count_ok, F.lit("COUNT_MISMATCH"))
        .when(~F.col("all_dates_parse"), F.lit("INVALID_INVOICE_DATE"))
        .when(~F.col("single_date"), F.lit("MULTIPLE_DATES"))
        .when(~date_ok, F.lit("DATE_MISMATCH"))
        .when(~sum_ok, F.lit("CHECKSUM_MISMATCH"))
        .otherwise(F.lit("OK"))
    )
    return j.select(
        F.col(key),
        F.col("expected_date"),
        F.col("expected_count"),
        F.col("actual_count"),
        listed.alias("listed"),
        present.alias("present"),
        F.coalesce(count_ok, F.lit(False)).alias("count_ok"),
        status.alias("status"),
    )


def manifest_reconciliation(verified: DataFrame) -> DataFrame:
    """V12 done for real: manifest total vs the records actually counted."""
    return verified.agg(
        F.count_if(F.col("listed")).alias("listed_files"),
        F.count_if(F.col("present")).alias("present_files"),
        F.coalesce(F.sum("expected_count"), F.lit(0)).cast("bigint").alias("manifest_records"),
        F.coalesce(F.sum("actual_count"), F.lit(0)).cast("bigint").alias("counted_records"),
        F.count_if(F.col("status") != "OK").alias("failed_files"),
    ).withColumn("reconciled", (F.col("manifest_records") == F.col("counted_records")) & (F.col("failed_files") == 0))


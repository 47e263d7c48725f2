"""Scalar column expressions.

All of them are plain ``pyspark.sql.functions`` compositions, so they stay
inside whole-stage codegen; none of them runs Python per row.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterable, Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

# ---- fixed values: null tokens of the reference's CSV reader (pandas defaults) ----
PANDAS_NULL_TOKENS = [
    "",
    "#N/A",
    "#N/A N/A",
    "#NA",
    "-1.#IND",
    "-1.#QNAN",
    "-NaN",
    "-nan",
    "1.#IND",
    "1.#QNAN",
    "<NA>",
    "N/A",
    "NA",
    "NULL",
    "NaN",
    "None",
    "n/a",
    "nan",
    "null",
]

# ---- fixed values: the production file-name pattern and its date format ----
FILE_NAME_PATTERN = r"^retail_sales_(\d{8})\.csv$"
FILE_NAME_DATE_FORMAT = "yyyyMMdd"

# ---- fixed values: timestamp text formats accepted by the lenient parse ----
DEFAULT_TIMESTAMP_FORMATS = [
    "yyyy-MM-dd HH:mm:ss",
    "yyyy-MM-dd'T'HH:mm:ss",
    "yyyy-MM-dd HH:mm",
    "yyyy-MM-dd",
    "yyyy-MM-dd H:mm:ss",
    "yyyy-MM-dd HH:mm:ss.[SSSSSS][SSSSS][SSSS][SSS][SS][S]",
    "yyyy-MM-dd'T'HH:mm:ss.[SSSSSS][SSSSS][SSSS][SSS][SS][S]",
    "yyyy-MM-dd'T'HH:mm:ssXXX",
    "M/d/yyyy H:mm",
    "M/d/yyyy H:mm:ss",
]
# ---- fixed values: words that are numbers, and letters of Java number literals (6d, 12f, 0x1p3) ----
NUMBER_WORDS = ["inf", "infinity", "nan"]
LITERAL_LETTERS = "dfxp"

# ---- fixed values: row-hash separator and its timestamp text format ----
ROW_HASH_SEPARATOR = "||"
ROW_HASH_TS_FORMAT = "yyyy-MM-dd HH:mm:ss"


def ts_literal(v) -> Column:
    """Timestamp literal read as wall-clock time in the session time zone.

    ``F.lit(datetime)`` goes through the Python process's local zone; casting
    the text keeps the same wall-clock value whatever the session zone is.
    """
    if isinstance(v, Column):
        return v
    return F.lit(v.strftime("%Y-%m-%d %H:%M:%S.%f")).cast("timestamp")


def col(c: str | Column) -> Column:
    return F.col(c) if isinstance(c, str) else c


def is_blank(c: str | Column) -> Column:
    """Null, or only whitespace (Python ``str.strip() == ''``, Unicode-aware)."""
    c = col(c)
    return c.isNull() | c.rlike(r"(?U)^\s*$")


def null_tokens(c: str | Column, tokens: Sequence[str] = PANDAS_NULL_TOKENS) -> Column:
    """Map the reader's null tokens to NULL (one projection, no UDF)."""
    c = col(c)
    return F.when(c.isin(list(tokens)), F.lit(None).cast("string")).otherwise(c)


def try_double(c: str | Column) -> Column:
    """Text to double; anything that is no decimal number becomes NULL."""
    c = col(c)
    text = F.lower(c.cast("string"))
    word = F.ltrim(F.trim(text), F.lit("+-")).isin(NUMBER_WORDS)
    return F.when(word | (F.translate(text, LITERAL_LETTERS, "") == text), c.try_cast("double"))


def try_long(c: str | Column) -> Column:
    """Text to bigint: integral text directly, otherwise via double (``6.0`` -> 6, ``2.5`` -> 2).

    Trying bigint first keeps integers above 2^53 exact.
    """
    c = col(c)
    return F.coalesce(c.try_cast("bigint"), try_double(c).try_cast("bigint"))


def try_timestamp(c: str | Column, formats: Sequence[str] = DEFAULT_TIMESTAMP_FORMATS) -> Column:
    """Text to timestamp by an explicit list of formats; first that parses wins, else NULL."""
    c = col(c)
    return F.coalesce(*[F.try_to_timestamp(c, F.lit(fmt)) for fmt in formats])


def line_amount(quantity: str | Column = "Quantity", unit_price: str | Column = "UnitPrice") -> Column:
    """round(Quantity * UnitPrice, 2), half-up."""
    return F.round(col(quantity) * col(unit_price), 2)


def is_cancellation(invoice_no: str | Column = "InvoiceNo") -> Column:
    """First letter, upper-cased, is ``C``; NULL when InvoiceNo is NULL."""
    return F.upper(F.substring(col(invoice_no), 1, 1)) == F.lit("C")


def mask_sha256(c: str | Column) -> Column:
    """Unsalted SHA-256 hex; NULL stays NULL."""
    return F.sha2(col(c), 256)


def hmac_sha256(c: str | Column, key: str | bytes) -> Column:
    """HMAC-SHA256 hex built from ``sha2``/``unhex``/``concat``; NULL stays NULL.

    The key becomes a literal of the plan: keep plans with keys out of logs.
    """
    block = 64
    k = key.encode("utf-8") if isinstance(key, str) else bytes(key)
    if len(k) > block:
        k = hashlib.sha256(k).digest()
    k = k.ljust(block, b"\x00")
    ipad = bytearray(b ^ 0x36 for b in k)
    opad = bytearray(b ^ 0x5C for b in k)
    c = col(c)
    inner = F.unhex(F.sha2(F.concat(F.lit(ipad), c.cast("binary")), 256))
    outer = F.sha2(F.concat(F.lit(opad), inner), 256)
    return F.when(c.isNotNull(), outer)


def file_name(path: str | Column) -> Column:
    """Last path segment."""
    return F.element_at(F.split(col(path), "/"), -1)


def file_stem(name: str | Column) -> Column:
    """Name without its last suffix (``Path.stem``)."""
    return F.regexp_replace(col(name), r"(.)\.[^.]*$", "$1")


def source_date_from_name(name: str | Column) -> Column:
    """Date in ``retail_sales_YYYYMMDD.csv`` (case-sensitive); NULL when the name
    misses the pattern or the date is impossible."""
    digits = F.regexp_extract(col(name), FILE_NAME_PATTERN, 1)
    return F.when(digits != "", F.try_to_date(digits, FILE_NAME_DATE_FORMAT))


def name_parts(name: str | Column) -> Column:
    """(year, month, day) text of a production file name, no calendar check."""
    n = col(name)
    return F.struct(
        F.regexp_extract(n, r"^retail_sales_(\d{4})(\d{2})(\d{2})\.csv$", 1).alias("year"),
        F.regexp_extract(n, r"^retail_sales_(\d{4})(\d{2})(\d{2})\.csv$", 2).alias("month"),
        F.regexp_extract(n, r"^retail_sales_(\d{4})(\d{2})(\d{2})\.csv$", 3).alias("day"),
    )


def truncate_text(c: str | Column, length: int = 1000) -> Column:
    """Cut a message to ``length`` characters (error texts in state rows)."""
    return F.substring(col(c), 1, length)


def minus_minutes(ts: str | Column, minutes: str | Column | int) -> Column:
    """Timestamp minus a number of minutes (interval arithmetic, no Python)."""
    m = F.lit(minutes) if isinstance(minutes, int) else col(minutes)
    return col(ts) - F.make_dt_interval(F.lit(0), F.lit(0), m.cast("int"), F.lit(0))


def reasons(flags: Iterable[tuple[str, Column]]) -> Column:
    """Ordered reason string: the names of the true flags joined by ``;`` ('' when none)."""
    return F.concat_ws(";", *[F.when(cond, F.lit(name)) for name, cond in flags])

"""Column contracts: header checks in three strictness levels, contract-ordered
projection, contract from the schema-config table, silver contract check
(SURVEY §1.4, §2.3 V1-V4, §2.12 E1-E2, §2.5 P15, §2.1 S11).

Header checks work on an ``array<string>`` column (one header per file), so a
whole batch of files is checked in one projection.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from strata.schemas import LOGICAL_TYPES, RAW_COLUMNS, SILVER_CONTRACT

LEVELS = ("exact_ordered", "exact_set", "superset")

# ---- fixed values: texts of the header errors ----
MISSING_TEXT = "Missing expected columns: "
UNEXPECTED_TEXT = "Unexpected columns found: "


def _arr(values: Sequence[str]) -> Column:
    return F.array(*[F.lit(v) for v in values])


def missing_columns(actual: Column, expected: Sequence[str] = RAW_COLUMNS) -> Column:
    """Expected names absent from the header, in expected order."""
    return F.filter(_arr(expected), lambda x: ~F.array_contains(actual, x))


def unexpected_columns(actual: Column, expected: Sequence[str] = RAW_COLUMNS) -> Column:
    """Header names not expected, in header order, duplicates kept."""
    exp = _arr(expected)
    return F.filter(actual, lambda x: ~F.array_contains(exp, x))


def duplicated_columns(actual: Column) -> Column:
    """Names present more than once (pandas would rename them ``X.1``: unexpected)."""
    return F.array_distinct(
        F.filter(actual, lambda x: F.size(F.filter(actual, lambda y: y == x)) > 1)
    )


def level_ok(header: Column, level: str, expected: Sequence[str] = RAW_COLUMNS) -> Column:
    """The verdict of one strictness level as a column (see ``header_verdict``)."""
    if level == "exact_ordered":
        return header == _arr(expected)
    miss = F.size(missing_columns(header, expected)) == 0
    if level == "superset":
        return miss
    if level == "exact_set":
        return miss & (F.size(unexpected_columns(header, expected)) == 0) & (F.size(duplicated_columns(header)) == 0)
    raise ValueError(f"level must be one of {LEVELS}")


def header_verdict(
    headers: DataFrame,
    header_col: str = "header",
    expected: Sequence[str] = RAW_COLUMNS,
    level: str = "exact_set",
) -> DataFrame:
    """V1-V3 per row: missing, unexpected and duplicated names and the verdict.

    exact_ordered: header equals the expected list;
    exact_set:     nothing missing, nothing unexpected, no duplicates (any order);
    superset:      nothing missing (unexpected names are dropped with a warning).
    ``file_error`` follows the reference's wording, missing reported first.
    """
    if level not in LEVELS:
        raise ValueError(f"level must be one of {LEVELS}")
    h = F.col(header_col)
    miss, unexp, dup = missing_columns(h, expected), unexpected_columns(h, expected), duplicated_columns(h)
    df = headers.withColumn("missing_columns", miss).withColumn("unexpected_columns", unexp).withColumn(
        "duplicated_columns", dup
    )
    m, u, d = F.col("missing_columns"), F.col("unexpected_columns"), F.col("duplicated_columns")
    if level == "exact_ordered":
        ok = h == _arr(expected)
    elif level == "exact_set":
        ok = (F.size(m) == 0) & (F.size(u) == 0) & (F.size(d) == 0)
    else:
        ok = F.size(m) == 0
    err = (
        F.when(F.size(m) > 0, F.concat(F.lit(MISSING_TEXT), F.array_join(m, ", ")))
        .when(ok, F.lit(None).cast("string"))
        .when(F.size(u) > 0, F.concat(F.lit(UNEXPECTED_TEXT), F.array_join(u, ", ")))
        .when(F.size(d) > 0, F.concat(F.lit("Duplicated columns found: "), F.array_join(d, ", ")))
        .otherwise(F.lit("Column order differs from the contract"))
    )
    return df.withColumn("file_valid", ok).withColumn("file_error", err)


def select_contract(df: DataFrame, expected: Sequence[str] = RAW_COLUMNS, keep: Sequence[str] = ()) -> DataFrame:
    """V4: force contract order (unexpected columns dropped, ``keep`` carried at the end)."""
    return df.select(*expected, *keep)


def contract_from_table(schema_config: DataFrame, provider_id: str, table_name: str) -> T.StructType:
    """StructType from SchemaConfig rows ordered by ``column_order``.

    The table lists one table's columns (tens of rows), so it is collected as
    configuration, not data.
    """
    rows = (
        schema_config.filter(
            (F.col("provider_id") == provider_id) & (F.col("table_name") == table_name) & F.col("active")
        )
        .orderBy("column_order")
        .select("column_name", "data_type", "nullable")
        .collect()
    )
    return T.StructType([T.StructField(r[0], LOGICAL_TYPES[r[1]], bool(r[2])) for r in rows])


def _type_name(dt: T.DataType) -> str:
    for name, t in LOGICAL_TYPES.items():
        if type(t) is type(dt):
            return name
    return dt.simpleString().upper()


def contract_check(df: DataFrame, contract: Sequence[tuple[str, str, bool]] = SILVER_CONTRACT) -> DataFrame:
    """One row per contract column -- expected vs actual type, NULL count (one
    aggregate over the data) and whether the column meets the contract."""
    present = {f.name: f.dataType for f in df.schema.fields}
    aggs = [
        F.count_if(F.col(name).isNull()).alias(name) if name in present else F.lit(None).cast("bigint").alias(name)
        for name, _t, _n in contract
    ]
    counts = df.agg(*aggs)
    stack = ", ".join(f"'{name}', `{name}`" for name, _t, _n in contract)
    nulls = counts.selectExpr(f"stack({len(contract)}, {stack}) AS (column_name, null_count)")
    spec = df.sparkSession.createDataFrame(
        [
            (name, dtype, nullable, _type_name(present[name]) if name in present else None, i + 1)
            for i, (name, dtype, nullable) in enumerate(contract)
        ],
        "column_name string, expected_type string, nullable boolean, actual_type string, column_order int",
    )
    j = spec.join(F.broadcast(nulls), on="column_name", how="left")
    return j.select(
        "column_order",
        "column_name",
        "expected_type",
        "actual_type",
        "nullable",
        F.col("null_count").cast("bigint").alias("null_count"),
        (F.col("expected_type") == F.col("actual_type")).alias("type_ok"),
        (F.col("nullable") | (F.col("null_count") == 0)).alias("null_ok"),
    )


__all__ = [
    "contract_check",
    "contract_from_table",
    "header_verdict",
    "missing_columns",
    "select_contract",
    "unexpected_columns",
]

"""Retail invoice lines derived from the driver's TPC-H-style tables.

``retail_lines`` is the raw layer the registered queries start from: one row
per lineitem (plus exact copies of some), the eight business columns as
text the way a CSV reader hands them over, and ``source_file`` naming the
daily file (``retail_sales_YYYYMMDD.csv`` of the ship date) the line
belongs to. Defects are put in by fixed arithmetic on the keys, so the same
view can be written in DuckDB SQL (``RETAIL_LINES_SQL``) for the oracle.

Plan shape: the orders get their customer first, then lineitem joins the orders and
part, so the lines, the largest table, are shuffled twice and not once more for the
customers. What a line needs of its own columns is worked out before its shuffles
(quantity, defects as bits, day and time), and the nation (25 rows by definition,
broadcast) comes after them, so that few and small columns are shuffled.
Customer and part grow with the data: AQE picks broadcast only when the
runtime size is under the threshold. Copies come from a ``Generate`` on the same scan, not from a
second scan and a union.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

# ---- fixed values: defect arithmetic of the derived raw layer ----
BLANK_INVOICE_MOD = 97  # InvoiceNo ''
NULL_INVOICE_MOD = 101  # InvoiceNo NULL
BLANK_STOCK_MOD = 89  # StockCode ' '
BAD_DATE_MOD = 83  # InvoiceDate in an unparsable day-first form
NEGATIVE_PRICE_MOD = 79  # UnitPrice negated
NULL_CUSTOMER_MOD = 11  # CustomerID NULL
BLANK_COUNTRY_NATION = 7  # Country ''
COPY_MOD = 50  # line appears twice
RETURN_SIGN_MOD = 4  # returned lines with partkey % 4 <> 0 get a negative quantity


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def daily_file_name(ts_col) -> F.Column:
    return F.concat(F.lit("retail_sales_"), F.date_format(ts_col, "yyyyMMdd"), F.lit(".csv"))


def buyers(orders: DataFrame, customer: DataFrame) -> DataFrame:
    """(o_orderkey, o_custkey, c_nationkey) of every order; no customer: null."""
    return orders.join(customer, F.col("o_custkey") == F.col("c_custkey"), "left").select("o_orderkey", "o_custkey", "c_nationkey")


def with_nation(lines: DataFrame, nation: DataFrame) -> DataFrame:
    """``lines`` with n_nationkey and n_name of their buyer; no nation: null."""
    return lines.join(F.broadcast(nation), F.col("c_nationkey") == F.col("n_nationkey"), "left")


# Bits of ``_marks``.
RETURNED, LOWER_CASE, BAD_DATE = 1, 2, 4


def _narrow(li: DataFrame) -> DataFrame:
    """What the lines need of lineitem, in few columns: ``_marks`` (bits), ``_qty``, ``_day`` and ``_clock`` stand for the columns they come from."""
    ret = F.col("l_returnflag") == "R"
    qty = F.col("l_quantity").cast("bigint")
    quantity = (
        F.when((F.col("l_linenumber") == 5) & (F.col("l_returnflag") == "N"), F.lit(0).cast("bigint"))
        .when(ret & (F.col("l_partkey") % RETURN_SIGN_MOD != 0), -qty)
        .otherwise(qty)
    )
    bits = {RETURNED: ret, LOWER_CASE: ret & (F.col("l_linenumber") == 7), BAD_DATE: F.col("l_suppkey") % BAD_DATE_MOD == 0}
    marks = sum((F.when(is_set, bit).otherwise(0) for bit, is_set in bits.items()), F.lit(0)).cast("tinyint")
    return li.select(
        "l_orderkey",
        "l_partkey",
        "l_extendedprice",
        quantity.alias("_qty"),
        marks.alias("_marks"),
        F.to_date("l_shipdate").alias("_day"),
        F.date_format("l_shipdate", "HH:mm:ss").alias("_clock"),
    )


def retail_lines(spark: SparkSession, sf_dir: str, by_day: bool = False) -> DataFrame:
    """Raw text lines: ``source_file`` + the eight business columns (strings).

    ``by_day``: the lines of a daily file lie in few tasks, to be written by file as they
    are (AQE splits a hot day). The typed columns are shuffled for it, not their texts.
    """
    li = table(spark, sf_dir, "lineitem").select(
        "l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_quantity", "l_extendedprice", "l_returnflag", "l_shipdate"
    )
    orders = table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey")
    customer = table(spark, sf_dir, "customer").select("c_custkey", "c_nationkey")
    nation = table(spark, sf_dir, "nation").select("n_nationkey", "n_name")
    part = table(spark, sf_dir, "part").select("p_partkey", "p_name")

    j = (
        _narrow(li)
        .join(buyers(orders, customer), F.col("l_orderkey") == F.col("o_orderkey"), "left")
        .join(part, F.col("l_partkey") == F.col("p_partkey"), "left")
        .drop("o_orderkey", "p_partkey")
    )
    if by_day:
        j = j.hint("rebalance", "_day")
    j = with_nation(j, nation)
    ok, pk = F.col("l_orderkey"), F.col("l_partkey")
    marked = lambda bit: F.col("_marks").bitwiseAND(F.lit(bit).cast("tinyint")) != 0
    invoice = (
        F.when(ok % BLANK_INVOICE_MOD == 0, F.lit(""))
        .when(ok % NULL_INVOICE_MOD == 0, F.lit(None).cast("string"))
        .when(marked(LOWER_CASE), F.concat(F.lit("c"), ok.cast("string")))
        .when(marked(RETURNED), F.concat(F.lit("C"), ok.cast("string")))
        .otherwise(ok.cast("string"))
    )
    invoice_date = F.when(marked(BAD_DATE), F.date_format("_day", "dd/MM/yyyy")).otherwise(
        F.concat(F.date_format("_day", "yyyy-MM-dd"), F.lit(" "), F.col("_clock"))
    )
    price = F.when(ok % NEGATIVE_PRICE_MOD == 0, -F.col("l_extendedprice")).otherwise(F.col("l_extendedprice"))
    lines = j.select(
        daily_file_name(F.col("_day")).alias("source_file"),
        invoice.alias("InvoiceNo"),
        F.when(pk % BLANK_STOCK_MOD == 0, F.lit(" ")).otherwise(pk.cast("string")).alias("StockCode"),
        F.col("p_name").alias("Description"),
        F.col("_qty").cast("string").alias("Quantity"),
        invoice_date.alias("InvoiceDate"),
        price.cast("string").alias("UnitPrice"),
        F.when(F.col("o_custkey") % NULL_CUSTOMER_MOD == 0, F.lit(None).cast("string"))
        .otherwise(F.col("o_custkey").cast("string"))
        .alias("CustomerID"),
        F.when(F.col("n_nationkey") == BLANK_COUNTRY_NATION, F.lit("")).otherwise(F.col("n_name")).alias("Country"),
        F.explode(F.when(ok % COPY_MOD == 0, F.array(F.lit(1), F.lit(2))).otherwise(F.array(F.lit(1)))).alias("_copy"),
    )
    return lines.drop("_copy")


def source_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Clean, typed lines (the prepared source before it is split into daily files):
    no defects, no copies. Quantity bigint, InvoiceDate timestamp, UnitPrice double."""
    li = table(spark, sf_dir, "lineitem").select(
        "l_orderkey", "l_partkey", "l_quantity", "l_extendedprice", "l_returnflag", "l_shipdate"
    )
    orders = table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey")
    customer = table(spark, sf_dir, "customer").select("c_custkey", "c_nationkey")
    nation = table(spark, sf_dir, "nation").select("n_nationkey", "n_name")
    part = table(spark, sf_dir, "part").select("p_partkey", "p_name")
    j = (
        li.join(buyers(orders, customer), F.col("l_orderkey") == F.col("o_orderkey"), "left")
        .join(part, F.col("l_partkey") == F.col("p_partkey"), "left")
    )
    ok = F.col("l_orderkey")
    return with_nation(j, nation).select(
        F.when(F.col("l_returnflag") == "R", F.concat(F.lit("C"), ok.cast("string"))).otherwise(ok.cast("string")).alias("InvoiceNo"),
        F.col("l_partkey").cast("string").alias("StockCode"),
        F.col("p_name").alias("Description"),
        F.col("l_quantity").cast("bigint").alias("Quantity"),
        F.col("l_shipdate").cast("timestamp").alias("InvoiceDate"),
        F.col("l_extendedprice").alias("UnitPrice"),
        F.col("o_custkey").cast("string").alias("CustomerID"),
        F.col("n_name").alias("Country"),
    )


# DuckDB twin of ``retail_lines`` (a CTE body), used by the oracle SQL.
RETAIL_LINES_SQL = f"""
retail_base AS (
  SELECT
    l.l_orderkey AS _ok,
    'retail_sales_' || strftime(l.l_shipdate, '%Y%m%d') || '.csv' AS source_file,
    CASE WHEN l.l_orderkey % {BLANK_INVOICE_MOD} = 0 THEN ''
         WHEN l.l_orderkey % {NULL_INVOICE_MOD} = 0 THEN NULL
         WHEN l.l_returnflag = 'R' AND l.l_linenumber = 7 THEN 'c' || CAST(l.l_orderkey AS VARCHAR)
         WHEN l.l_returnflag = 'R' THEN 'C' || CAST(l.l_orderkey AS VARCHAR)
         ELSE CAST(l.l_orderkey AS VARCHAR) END AS InvoiceNo,
    CASE WHEN l.l_partkey % {BLANK_STOCK_MOD} = 0 THEN ' ' ELSE CAST(l.l_partkey AS VARCHAR) END AS StockCode,
    p.p_name AS Description,
    CASE WHEN l.l_linenumber = 5 AND l.l_returnflag = 'N' THEN '0'
         WHEN l.l_returnflag = 'R' AND l.l_partkey % {RETURN_SIGN_MOD} <> 0 THEN CAST(-CAST(l.l_quantity AS BIGINT) AS VARCHAR)
         ELSE CAST(CAST(l.l_quantity AS BIGINT) AS VARCHAR) END AS Quantity,
    CASE WHEN l.l_suppkey % {BAD_DATE_MOD} = 0 THEN strftime(l.l_shipdate, '%d/%m/%Y')
         ELSE strftime(l.l_shipdate, '%Y-%m-%d %H:%M:%S') END AS InvoiceDate,
    CAST(CASE WHEN l.l_orderkey % {NEGATIVE_PRICE_MOD} = 0 THEN -l.l_extendedprice ELSE l.l_extendedprice END AS VARCHAR) AS UnitPrice,
    CASE WHEN o.o_custkey % {NULL_CUSTOMER_MOD} = 0 THEN NULL ELSE CAST(o.o_custkey AS VARCHAR) END AS CustomerID,
    CASE WHEN n.n_nationkey = {BLANK_COUNTRY_NATION} THEN '' ELSE n.n_name END AS Country
  FROM lineitem l
  LEFT JOIN orders o ON o.o_orderkey = l.l_orderkey
  LEFT JOIN customer c ON c.c_custkey = o.o_custkey
  LEFT JOIN nation n ON n.n_nationkey = c.c_nationkey
  LEFT JOIN part p ON p.p_partkey = l.l_partkey
),
retail_lines AS (
  SELECT source_file, InvoiceNo, StockCode, Description, Quantity, InvoiceDate, UnitPrice, CustomerID, Country
  FROM retail_base
  UNION ALL
  SELECT source_file, InvoiceNo, StockCode, Description, Quantity, InvoiceDate, UnitPrice, CustomerID, Country
  FROM retail_base WHERE _ok % {COPY_MOD} = 0
)"""

def flagged_sql(src: str = "retail_lines") -> str:
    """Typed + flagged lines in DuckDB (lenient casts, six rules in order); any
    extra columns of ``src`` are carried."""
    return rf"""
typed_lines AS (
  SELECT * REPLACE (
         TRY_CAST(Quantity AS DOUBLE) AS Quantity,
         try_strptime(InvoiceDate, '%Y-%m-%d %H:%M:%S') AS InvoiceDate,
         TRY_CAST(UnitPrice AS DOUBLE) AS UnitPrice)
  FROM {src}
),
flagged_lines AS (
  SELECT *, concat_ws(';',
      CASE WHEN InvoiceNo IS NULL OR regexp_matches(InvoiceNo, '^\s*$') THEN 'required_invoice_no' END,
      CASE WHEN StockCode IS NULL OR regexp_matches(StockCode, '^\s*$') THEN 'required_stock_code' END,
      CASE WHEN Quantity IS NULL OR isnan(Quantity) OR isinf(Quantity)
                OR (Quantity <= 0 AND NOT starts_with(coalesce(InvoiceNo, ''), 'C')) THEN 'valid_quantity' END,
      CASE WHEN UnitPrice IS NULL OR isnan(UnitPrice) OR UnitPrice < 0 THEN 'positive_unit_price' END,
      CASE WHEN InvoiceDate IS NULL THEN 'valid_invoice_date' END,
      CASE WHEN Country IS NULL OR regexp_matches(Country, '^\s*$') THEN 'required_country' END
  ) AS rejection_reason
  FROM typed_lines
),
valid_lines AS (
  SELECT * EXCLUDE (rejection_reason) FROM flagged_lines WHERE rejection_reason = ''
),
rejected_lines AS (
  SELECT * FROM flagged_lines WHERE rejection_reason <> ''
)"""


FLAGGED_SQL = flagged_sql()


def with_ctes(*bodies: str) -> str:
    return "WITH " + ",\n".join(b.strip() for b in bodies)

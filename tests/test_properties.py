"""Random rows: the Spark rule pack against a brute-force Python version of the
six rules, plus invariants (total = valid + rejected, dedup is idempotent)."""

import datetime as dt
import math

from hypothesis import HealthCheck, given, settings
from pyspark.sql import functions as F
from hypothesis import strategies as st

from strata.operators import rules, silver
from strata.schemas import RAW_COLUMNS

TEXT = st.one_of(st.none(), st.sampled_from(["", " ", "  \t", "x", "536365", "C536365", "c12", "UK", "A B"]))
NUM = st.one_of(
    st.none(),
    st.sampled_from(["", "abc", "-", "1.2.3", " 6 ", "6.", ".5", "0", "-0", "-3", "2.5", "1e3", "-1e-2", "Infinity", "NaN"]),
    st.integers(-5, 5).map(str),
)
DATE = st.one_of(
    st.none(),
    st.sampled_from(["2010-12-01 08:26:00", "2010-12-01", "2010-12-01T08:26:00", "2010-12-01 08:26", "01/12/2010", "not a date", ""]),
)
ROW = st.tuples(TEXT, TEXT, TEXT, NUM, DATE, NUM, TEXT, TEXT)

FORMATS = ["%Y-%m-%d %H:%M:%S", "%Y-%m-%dT%H:%M:%S", "%Y-%m-%d %H:%M", "%Y-%m-%d"]


def blank(v):
    return v is None or v.strip() == ""


def num(v):
    if v is None:
        return None
    try:
        return float(v)
    except ValueError:
        return None


def ts(v):
    if v is None:
        return None
    for f in FORMATS:
        try:
            return dt.datetime.strptime(v, f)
        except ValueError:
            pass
    return None


def python_reasons(r):
    inv, stock, _desc, q, d, p, _cust, country = r
    qv, pv = num(q), num(p)
    out = []
    if blank(inv):
        out.append("required_invoice_no")
    if blank(stock):
        out.append("required_stock_code")
    if qv is None or math.isnan(qv) or math.isinf(qv) or (qv <= 0 and not (inv or "").startswith("C")):
        out.append("valid_quantity")
    if pv is None or math.isnan(pv) or pv < 0:
        out.append("positive_unit_price")
    if ts(d) is None:
        out.append("valid_invoice_date")
    if blank(country):
        out.append("required_country")
    return ";".join(out)


@settings(max_examples=8, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(ROW, min_size=1, max_size=60))
def test_rules_match_brute_force(spark, rows):
    keyed = [(i, *r) for i, r in enumerate(rows)]
    df = spark.createDataFrame(keyed, "i int, " + ", ".join(f"{c} string" for c in RAW_COLUMNS))
    flagged = rules.flag(rules.coerce(df))
    got = {r.i: r.rejection_reason for r in flagged.select("i", "rejection_reason").collect()}
    want = {i: python_reasons(r) for i, r in enumerate(rows)}
    assert got == want
    valid, rejected = rules.split(flagged)
    assert valid.count() + rejected.count() == len(rows)
    typed = silver.cast_columns(valid.drop("i")).withColumn("SourceFile", F.lit("f.csv"))
    once = silver.dedup_exact(typed, mode="typed")
    assert silver.dedup_exact(once, mode="typed").count() == once.count()

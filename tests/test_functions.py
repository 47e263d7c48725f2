"""Scalar functions against Python equivalents."""

import hashlib
import hmac

from strata.functions.expr import hmac_sha256, is_blank, mask_sha256, source_date_from_name, try_long


def test_hmac_matches_python(spark):
    for key in ["k", "x" * 100]:
        df = spark.createDataFrame([("17850",), ("",), (None,)], "c string")
        got = [r[0] for r in df.select(hmac_sha256("c", key)).collect()]
        want = [hmac.new(key.encode(), v.encode(), hashlib.sha256).hexdigest() if v is not None else None for v in ["17850", "", None]]
        assert got == want


def test_sha_mask_and_blank(spark):
    df = spark.createDataFrame([("17850",), (None,), (" \t",), (" ",), ("x",)], "c string")
    rows = df.select(mask_sha256("c").alias("m"), is_blank("c").alias("b")).collect()
    assert rows[0].m == hashlib.sha256(b"17850").hexdigest() and rows[1].m is None
    assert [r.b for r in rows] == [False, True, True, True, False]


def test_names_and_casts(spark):
    df = spark.createDataFrame(
        [("retail_sales_20101201.csv", "6"), ("retail_sales_20101399.csv", "6.0"), ("retail_sales_20101201.CSV", "2.5"), ("x.csv", "abc")],
        "n string, q string",
    )
    rows = df.select(source_date_from_name("n").alias("d"), try_long("q").alias("q")).collect()
    assert [str(r.d) if r.d else None for r in rows] == ["2010-12-01", None, None, None]
    assert [r.q for r in rows] == [6, 6, 2, None]


def test_name_parts_stem_minutes(spark):
    import datetime as dt

    from strata.functions.expr import file_stem, minus_minutes, name_parts

    df = spark.createDataFrame([("retail_sales_20101399.csv", dt.datetime(2010, 12, 5))], "n string, t timestamp")
    r = df.select(
        name_parts("n").alias("p"), file_stem("n").alias("s"), minus_minutes("t", 1440).alias("m")
    ).collect()[0]
    assert (r.p.year, r.p.month, r.p.day) == ("2010", "13", "99")  # no calendar check (S3)
    assert r.s == "retail_sales_20101399"
    assert r.m == dt.datetime(2010, 12, 4)


def test_config_tables(spark):
    import datetime as dt

    from strata.operators import rules
    from strata.sources.config import (
        active_feeds,
        assert_unique_keys,
        feed_config,
        ingestion_state,
        reader_options,
        rule_config,
        schema_config,
    )
    from strata.sources.contract import contract_from_table
    from strata.operators.state import seed_state

    cfg = feed_config(
        spark,
        [
            {"provider_id": "p", "raw_path": "r", "bronze_path": "b", "silver_path": "s", "quarantine_path": "q"},
            {"provider_id": "old", "raw_path": "r", "bronze_path": "b", "silver_path": "s", "quarantine_path": "q", "active": False, "delimiter": ";"},
        ],
        now=dt.datetime(2026, 1, 1),
    )
    feeds = active_feeds(cfg).collect()
    assert [f.provider_id for f in feeds] == ["p"]
    assert reader_options(feeds[0]) == {"format": "csv", "sep": ",", "header": "true"}
    schema = contract_from_table(schema_config(spark), "provider_retail", "retail_sales")
    assert schema.names == ["InvoiceNo", "StockCode", "Description", "Quantity", "InvoiceDate", "UnitPrice", "CustomerID", "Country"]
    assert [f.nullable for f in schema.fields] == [False, False, True, False, False, False, True, False]
    names = [n for n, _ in rules.rules_from_table(rule_config(spark), "provider_retail")]
    assert names == ["required_invoice_no", "required_stock_code", "positive_quantity", "positive_unit_price", "valid_invoice_date"]
    st = seed_state(spark.createDataFrame([("p",), ("q",)], "provider_id string"))
    assert ingestion_state(st, "p", "SILVER").count() == 1
    assert_unique_keys(st)
    try:
        assert_unique_keys(st.unionByName(st))
        raise AssertionError("expected duplicate keys to fail")
    except RuntimeError:
        pass

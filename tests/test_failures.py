"""Errors, retries, re-deliveries and texts that earlier versions got wrong."""

import datetime as dt
import hashlib
import os

import pytest
from pyspark.sql import functions as F

from strata.functions.expr import try_double, try_long, try_timestamp
from strata.operators import state as st
from strata.plans import ingest
from strata.sinks import writers
from strata.sources import files

HEADER = "InvoiceNo,StockCode,Description,Quantity,InvoiceDate,UnitPrice,CustomerID,Country\n"
ROW = "536365,85123A,thing,6,{day} 08:26:00,2.55,17850,United Kingdom\n"
T0 = dt.datetime(2024, 1, 1)


def layers(root):
    return {k: f"{root}/{k}" for k in ("bronze", "quarantine", "state", "silver")}


def deliver(root, name, text):
    os.makedirs(f"{root}/raw", exist_ok=True)
    with open(f"{root}/raw/{name}", "w", newline="") as f:
        f.write(text)


def newest(spark, paths):
    return {r.source_checksum: r for r in st.latest(ingest.load_state(spark, paths["state"])).collect()}


def test_java_literals_are_no_numbers(spark):
    rows = [("6d", None, None), ("12f", None, None), ("0x1p3", None, None), ("6", 6.0, 6), (" 2.5 ", 2.5, 2), ("1e3", 1000.0, 1000), ("-.5", -0.5, 0), (None, None, None)]
    df = spark.createDataFrame(rows, "t string, d double, l long")
    got = df.select("t", "d", "l", try_double("t").alias("gd"), try_long("t").alias("gl")).collect()
    assert [(r.t, r.gd, r.gl) for r in got] == [(r.t, r.d, r.l) for r in got]


def test_timestamp_forms(spark):
    texts = ["12/1/2010 8:26", "2010-12-01 8:26:00", "2010-12-01 08:26:00.5", "2010-12-01T08:26:00Z", "2010-12-01T08:26:00", "01.12.2010 08:26"]
    df = spark.createDataFrame([(t,) for t in texts], "t string").select("t", F.date_format(try_timestamp("t"), "yyyy-MM-dd HH:mm").alias("ts"))
    got = {r.t: r.ts for r in df.collect()}
    assert got.pop("01.12.2010 08:26") is None and set(got.values()) == {"2010-12-01 08:26"}


@pytest.mark.parametrize("size", [1, 7, 1 << 20])
def test_chunks_of_any_size_describe_a_file(workdir, size):
    for text in ["", "\n", "a", "﻿a,\"b, c\",d\r\n1,2,3\n", HEADER * 50, "x" * 100_000 + "\n1"]:
        path = f"{workdir}/f.csv"
        with open(path, "w", newline="", encoding="utf-8") as f:
            f.write(text)
        digest, records, header = files.describe_file("file:" + path, size)
        assert digest == hashlib.sha256(text.encode()).hexdigest()
        lines = text.count("\n") + (1 if text and not text.endswith("\n") else 0)
        assert records == max(lines - 1, 0)
        if "b, c" in text:
            assert header == ["a", "b, c", "d"]


def test_error_leaves_failed_and_a_retry_succeeds(spark, workdir, monkeypatch):
    paths = layers(workdir)
    deliver(workdir, "retail_sales_20101201.csv", HEADER + ROW.format(day="2010-12-01"))
    args = (spark, f"{workdir}/raw", paths["bronze"], paths["quarantine"], paths["state"])

    def broken(*_):
        raise OSError("disk " + "x" * 2000)

    with monkeypatch.context() as m:
        m.setattr(writers, "write_bronze", broken)
        with pytest.raises(OSError):
            ingest.ingest_batch(*args, run_id="r1", now=T0)
    (row,) = newest(spark, paths).values()
    assert row.status == st.FAILED and row.error_message.startswith("OSError: disk") and len(row.error_message) <= 1000
    ingest.ingest_batch(*args, run_id="r2", now=T0 + dt.timedelta(minutes=1))
    (row,) = newest(spark, paths).values()
    assert row.status == st.SUCCESS and row.record_count == 1


def test_silver_takes_the_newest_checksum_and_only_the_given_dates(spark, workdir):
    paths = layers(workdir)
    args = (spark, f"{workdir}/raw", paths["bronze"], paths["quarantine"], paths["state"])
    deliver(workdir, "retail_sales_20101202.csv", HEADER + ROW.format(day="2010-12-02"))
    for k in range(4):
        text = HEADER + ROW.format(day="2010-12-01").replace("thing", f"thing {k}")
        deliver(workdir, "retail_sales_20101201.csv", text)
        ingest.ingest_batch(*args, run_id=f"r{k}", now=T0 + dt.timedelta(minutes=k))
        ingest.bronze_to_silver(spark, paths["bronze"], paths["silver"], run_id=f"r{k}", state_path=paths["state"], dates=["2010-12-01"])
        rows = spark.read.parquet(paths["silver"]).collect()
        assert [(r.Description, r.SourceChecksum, str(r.SourceDate)) for r in rows] == [(f"thing {k}", hashlib.sha256(text.encode()).hexdigest(), "2010-12-01")]


def test_failed_file_keeps_all_its_bytes(spark, workdir, monkeypatch):
    monkeypatch.setattr(writers, "PART_BYTES", 64)
    paths = layers(workdir)
    text = HEADER.replace("Country", "Land") + ROW.format(day="2010-12-01") * 20
    deliver(workdir, "retail_sales_20101201.csv", text)
    ingest.ingest_batch(spark, f"{workdir}/raw", paths["bronze"], paths["quarantine"], paths["state"], now=T0)
    parts = spark.read.parquet(f"{paths['quarantine']}/files").orderBy("part").collect()
    assert b"".join(bytes(r.content) for r in parts).decode() == text


def test_state_of_a_null_checksum_is_updated(spark):
    log = st.empty_file_state(spark)
    key = "provider_id string, source_uri string, source_checksum string, source_file string, source_date date, status string, run_id string"
    first = spark.createDataFrame([("p", "u", None, "f", None, st.PROCESSING, "r")], key)
    log = st.merge_state(log, first, now=T0)
    done = spark.createDataFrame([("p", "u", None, st.SUCCESS)], "provider_id string, source_uri string, source_checksum string, status string")
    assert [r.status for r in st.update_state(log, done, now=T0).collect()] == [st.SUCCESS]


def test_stream_reads_each_file_by_its_header(spark, workdir):
    from strata.streaming.stream import ingest_stream

    paths = layers(workdir)
    names = HEADER.strip().split(",")
    values = ROW.format(day="2010-12-01").strip().split(",")
    order = [1, 0, *range(2, 8)]
    swapped = ",".join(names[i] for i in order) + "\n" + ",".join(values[i] for i in order) + "\n"
    deliver(workdir, "retail_sales_20101201.csv", swapped)
    deliver(workdir, "retail_sales_20101202.csv", HEADER.replace(",Country", "") + "1,2,3,4,5,6,7\n")
    deliver(workdir, "notes.csv", "a,b\n1,2\n")
    ingest_stream(spark, f"{workdir}/raw", paths["bronze"], paths["quarantine"], f"{workdir}/ck", state_path=paths["state"])
    bronze = spark.read.option("header", "true").csv(paths["bronze"]).collect()
    assert [(r.InvoiceNo, r.StockCode, r.source_file) for r in bronze] == [("536365", "85123A", "retail_sales_20101201.csv")]
    states = {r.source_file: r.status for r in newest(spark, paths).values()}
    assert states == {"retail_sales_20101201.csv": st.SUCCESS, "retail_sales_20101202.csv": st.FILE_VALIDATION_FAILED}

"""Timestamp forms elected per file: day first and month first side by side."""

import datetime as dt

from fixtures import HEADER, line, write_file
from pyspark.sql import functions as F
from strata.operators import formats
from strata.plans import ingest


def days(form, dates):
    return [d.strftime(form) for d in dates]


def test_forms_are_elected_per_group_with_the_wider_group_for_ties(spark):
    span = [dt.datetime(2010, m, d, 8, 5) for m in range(1, 13) for d in (3, 11, 25)]
    early = [dt.datetime(2010, 4, 3, 9, 0)]
    rows = [("p", "day", t) for t in days("%d/%m/%Y %H:%M", span)] + [("q", "month", t) for t in days("%m/%d/%Y %H:%M", span)]
    rows += [("p", "tie", t) for t in days("%d/%m/%Y %H:%M", early)] + [("q", "tie2", t) for t in days("%m/%d/%Y %H:%M", early)]
    rows += [("p", "none", "soon"), ("q", "none2", None), ("r", "lost", "never"), (None, None, "2010-04-03"), ("p", "day", "bad"), ("p", "day", None)]
    df = spark.createDataFrame(rows, "provider string, file string, InvoiceDate string")
    by = ["provider", "file"]
    elected = formats.elect_formats(df, by, wider=["provider"])
    got = {r.file: (r.format, r.parsed, r.total) for r in elected.collect()}
    day, month = "d/M/yyyy H:mm[:ss]", "M/d/yyyy H:mm[:ss]"
    assert got == {
        "day": (day, 36, 37), "month": (month, 36, 36), "tie": (day, 1, 1), "tie2": (month, 1, 1), "none": (day, 0, 1), "none2": (month, 0, 0),
        "lost": (None, 0, 1), None: ("yyyy-MM-dd", 1, 1),
    }
    read = formats.read_elected(df, elected, by)
    spans = {r.file: (r.n, r.a, r.b) for r in read.groupBy("file").agg(F.count("InvoiceDate").alias("n"), F.min("InvoiceDate").alias("a"), F.max("InvoiceDate").alias("b")).collect()}
    assert spans["day"] == spans["month"] == (36, min(span), max(span))
    assert spans["tie"] == spans["tie2"] == (1, early[0], early[0]) and spans["lost"] == (0, None, None)
    assert formats.elect_formats(df.limit(0), by).count() == 0


def test_intake_reads_each_file_in_its_form(spark, workdir):
    a = "\n".join([HEADER, line(inv="1", date="25/12/2010 08:26"), line(inv="2", date="03/04/2010 08:26"), line(inv="3", date="2010-13-45")])
    b = "\n".join([HEADER, line(inv="4", date="12/25/2010 08:26"), line(inv="5", date="03/04/2010 08:26")])
    write_file(f"{workdir}/raw", "retail_sales_20101201.csv", a + "\n")
    write_file(f"{workdir}/raw", "retail_sales_20101202.csv", b + "\n")
    paths = [f"{workdir}/{k}" for k in ("raw", "bronze", "quarantine", "state")]
    res = ingest.ingest_batch(spark, *paths, run_id="r", elect=True).collect()
    assert sorted((r.valid_records, r.rejected_records) for r in res) == [(2, 0), (2, 1)]
    got = {r.InvoiceNo: r.InvoiceDate for r in spark.read.option("header", "true").csv(paths[1]).collect()}
    assert got == {"1": "2010-12-25 08:26:00", "2": "2010-04-03 08:26:00", "4": "2010-12-25 08:26:00", "5": "2010-03-04 08:26:00"}
    only = [f"{workdir}/{k}" for k in ("raw", "bronze2", "quarantine2", "state2")]
    res = ingest.ingest_batch(spark, *only, run_id="r", timestamp_formats=["M/d/yyyy H:mm"]).collect()
    assert sorted((r.valid_records, r.rejected_records) for r in res) == [(1, 2), (2, 0)]

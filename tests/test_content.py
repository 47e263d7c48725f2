"""Reconciliation by content: lost, doubled and altered rows, and the audits of a run."""

import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from fixtures import HEADER, fixture_text, line, write_file
from strata.operators import content
from strata.plans import ingest
from strata.sinks import writers

SCHEMA = "f string, a string, b string, n double, t timestamp"
T = dt.datetime(2010, 12, 1, 8, 26)


def data():
    rng = random.Random(4)
    return [(f"f{i % 4}" if i % 5 else None, rng.choice(["x", "", None, "x-"]), rng.choice([None, "", "1:x", "-"]), i / 4, T) for i in range(400)] + [("f1", "c", "c", 1.0, T)] * 60


def compared(spark, changed):
    both = [content.contents(spark.createDataFrame(rows, SCHEMA).repartition(k), ["a", "b", "n", "t"], ["f"]) for rows, k in ((data(), 3), (changed, 7))]
    return {r.f: (r.difference, r.reconciliation_status) for r in content.compare_contents(*both, ["f"]).collect()}


def test_lost_doubled_and_altered_rows_show(spark):
    same = data()
    random.Random(1).shuffle(same)
    assert set(compared(spark, same).values()) == {(None, "RECONCILED")}
    rows = data()
    lost = rows.pop(1)
    doubled = rows[1]
    rows.append(doubled)
    rows[2] = (*rows[2][:3], -1.0, T)
    rows[7] = (rows[7][0], None if rows[7][1] == "" else "", *rows[7][2:])  # null for blank
    got = compared(spark, rows)
    assert got[lost[0]] == ("rows lost", "NOT_RECONCILED")
    assert {v[0] for v in got.values()} == {"rows lost", "rows added", "rows altered", None} - ({None} if len({lost[0], doubled[0]}) > 3 else set())
    swapped = data()
    swapped[3], swapped[8] = (*swapped[3][:1], *swapped[8][1:]), (*swapped[8][:1], *swapped[3][1:])
    assert sum(v[1] != "RECONCILED" for v in compared(spark, swapped).values()) == (0 if swapped[3][0] == swapped[8][0] else 2)
    # A group that only one side has.
    extra = [*data(), ("new", "x", "x", 1.0, T)]
    assert compared(spark, extra)["new"] == ("rows added", "NOT_RECONCILED")
    assert compared(spark, [r for r in data() if r[0]])[None] == ("rows lost", "NOT_RECONCILED")


def test_observed_content_equals_the_aggregate(spark, workdir):
    df = spark.createDataFrame(data(), SCHEMA)
    seen = content.ObservedContent()
    seen.on(df, ["a", "b"]).write.parquet(f"{workdir}/t")
    r = content.contents(spark.read.parquet(f"{workdir}/t"), ["a", "b"]).first()
    assert seen.result() == (r["rows"], int(r["content"]))


FAULTS = {
    "none": lambda df: df,
    "lost": lambda df: df.where("InvoiceNo <> '536374'"),
    "doubled": lambda df: df.unionByName(df.where("InvoiceNo = '536374'")),
    "altered": lambda df: df.withColumn("Country", F.when(F.col("InvoiceNo") == "536374", "FR").otherwise(F.col("Country"))),
}


@pytest.mark.parametrize("fault", list(FAULTS))
def test_audits_of_a_run(spark, workdir, monkeypatch, fault):
    write_file(f"{workdir}/raw", "retail_sales_20101201.csv", fixture_text())
    write_file(f"{workdir}/raw", "retail_sales_20101202.csv", HEADER + '\n536365,S1,"two\n\nlines, ""q""",6,2010-12-02 08:00:00,1e7,,UK\n' + line(desc='""'))
    write_file(f"{workdir}/raw", "retail_sales_20101203.csv", "a,b\n1,2\n")
    real = writers.write_bronze
    monkeypatch.setattr(writers, "write_bronze", lambda df, path: real(FAULTS[fault](df), path))
    paths = [f"{workdir}/{k}" for k in ("raw", "bronze", "quarantine", "state")]
    ingest.ingest_batch(spark, *paths, run_id="r", audit_path=f"{workdir}/audit", now=T)
    row = spark.read.parquet(f"{workdir}/audit/reconciliation").first()
    target = {"none": 9, "lost": 8, "doubled": 10, "altered": 9}[fault]
    assert (row.source_count, row.read_count, row.valid_count, row.rejected_count, row.target_count) == (20, 20, 9, 11, target)
    assert row.reconciliation_status == ("RECONCILED" if fault == "none" else "NOT_RECONCILED")
    parts = {(r.source_file, r.side): r.difference for r in spark.read.parquet(f"{workdir}/audit/content").collect()}
    what = {"none": None, "lost": "rows lost", "doubled": "rows added", "altered": "rows altered"}[fault]
    first = "retail_sales_20101201.csv"
    assert parts == {(first, "valid"): what, (first, "rejected"): None, ("retail_sales_20101202.csv", "valid"): None}
    run = spark.read.parquet(f"{workdir}/audit/runs").first()
    assert (run.status, run.source_file_count, run.source_record_count, run.valid_record_count, run.silver_record_count) == ("PARTIAL_SUCCESS", 3, 20, 9, None)
    assert spark.read.parquet(f"{workdir}/audit/rejections").count() == 16

"""Silver merged by file: moved rows, stray rows, files without rows, repeats, failures."""

import datetime as dt
import os

import pytest
from pyspark.sql import functions as F

from fixtures import HEADER, line, write_file
from strata.plans.ingest import bronze_to_silver, ingest_batch
from strata.sinks import silver_files

D = [dt.date(2010, 12, d) for d in range(1, 8)]
SCHEMA = "InvoiceNo string, SourceFile string, SourceDate date"


def rows(spark, data):
    return spark.createDataFrame([(n, f, D[d]) for n, f, d in data], SCHEMA)


def batch(spark, files):
    return spark.createDataFrame([(f, None if d is None else D[d]) for f, d in files], "SourceFile string, FileDate date")


def content(spark, path):
    return sorted((r.InvoiceNo, r.SourceFile, D.index(r.SourceDate)) for r in spark.read.schema(SCHEMA).parquet(path).collect())


def test_a_file_that_moves_to_another_date_leaves_no_old_row(spark, workdir):
    path = f"{workdir}/silver"
    silver_files.merge_by_file(rows(spark, [("a", "f1", 0), ("b", "f1", 1), ("c", "f2", 1)]), path, batch(spark, [("f1", 0), ("f2", 1)]))
    assert content(spark, path) == [("a", "f1", 0), ("b", "f1", 1), ("c", "f2", 1)]
    got = silver_files.merge_by_file(rows(spark, [("a", "f1", 2), ("b", "f1", 2)]), path, batch(spark, [("f1", 0)]))
    assert content(spark, path) == [("a", "f1", 2), ("b", "f1", 2), ("c", "f2", 1)]
    assert got == {"stray_rows": 2, "dates": 2, "cleared_dates": 1}
    assert not os.path.exists(f"{path}/SourceDate={D[0]}")
    # Back again, and the stray date is cleared.
    silver_files.merge_by_file(rows(spark, [("a", "f1", 0)]), path, batch(spark, [("f1", 0)]))
    assert content(spark, path) == [("a", "f1", 0), ("c", "f2", 1)]
    assert {(r.SourceFile, tuple(r.dates)) for r in silver_files.file_index(spark, path).collect()} == {("f1", (D[0],)), ("f2", (D[1],))}
    assert silver_files.compact_index(spark, path) == 2


def test_stray_rows_of_others_survive_a_whole_day(spark, workdir):
    path = f"{workdir}/silver"
    silver_files.merge_by_file(rows(spark, [("a", "f1", 0), ("s", "f1", 1)]), path, batch(spark, [("f1", 0)]))
    silver_files.merge_by_file(rows(spark, [("b", "f2", 1), ("g", "f3", 1)]), path, batch(spark, [("f2", 1), ("f3", 1)]))
    assert content(spark, path) == [("a", "f1", 0), ("b", "f2", 1), ("g", "f3", 1), ("s", "f1", 1)]
    # The day comes again without f3: the batch is the whole day, f1's stray row is none of its.
    silver_files.merge_by_file(rows(spark, [("b2", "f2", 1)]), path, batch(spark, [("f2", 1)]))
    assert content(spark, path) == [("a", "f1", 0), ("b2", "f2", 1), ("s", "f1", 1)]
    # A file delivered again without a row leaves nothing behind, other files stay.
    silver_files.merge_by_file(rows(spark, []), path, batch(spark, [("f2", 1)]), keep_other_files=True)
    assert content(spark, path) == [("a", "f1", 0), ("s", "f1", 1)]
    silver_files.merge_by_file(rows(spark, []), path, batch(spark, [("f1", 0)]), keep_other_files=True)
    assert content(spark, path) == []


def test_first_merge_learns_an_old_table(spark, workdir):
    path = f"{workdir}/silver"
    rows(spark, [("a", "f1", 0), ("b", "f1", 3), ("c", "f2", 3)]).write.partitionBy("SourceDate").parquet(path)
    silver_files.merge_by_file(rows(spark, [("a2", "f1", 0)]), path, batch(spark, [("f1", 0)]))
    assert content(spark, path) == [("a2", "f1", 0), ("c", "f2", 3)]


@pytest.mark.parametrize("at", [1, 2])
def test_a_failed_merge_is_healed_by_the_next(spark, workdir, monkeypatch, at):
    path = f"{workdir}/silver"
    silver_files.merge_by_file(rows(spark, [("a", "f1", 0), ("b", "f1", 1), ("c", "f2", 1)]), path, batch(spark, [("f1", 0), ("f2", 1)]))
    calls, real = [], silver_files._write

    def broken(rows, path):
        calls.append(1)
        if len(calls) == at:
            raise OSError("lost")
        real(rows, path)

    again = rows(spark, [("a", "f1", 0), ("b", "f1", 4)]), path, batch(spark, [("f1", 0)])
    with monkeypatch.context() as m:
        m.setattr(silver_files, "_write", broken)
        with pytest.raises(OSError):
            silver_files.merge_by_file(*again)
    silver_files.merge_by_file(*again)
    assert content(spark, path) == [("a", "f1", 0), ("b", "f1", 4), ("c", "f2", 1)]


def test_job_with_a_stray_row_and_a_redelivery(spark, workdir):
    paths = {k: f"{workdir}/{k}" for k in ("raw", "bronze", "quarantine", "state", "silver")}
    day = lambda d, **k: line(date=f"2010-12-0{d} 08:00:00", **k)

    def run(n):
        now = dt.datetime(2024, 1, n)
        ingest_batch(spark, paths["raw"], paths["bronze"], paths["quarantine"], paths["state"], run_id=f"r{n}", now=now)
        return bronze_to_silver(spark, paths["bronze"], paths["silver"], run_id=f"r{n}", state_path=paths["state"])

    write_file(paths["raw"], "retail_sales_20101201.csv", "\n".join([HEADER, day(1, inv="1"), day(3, inv="2")]) + "\n")
    write_file(paths["raw"], "retail_sales_20101203.csv", "\n".join([HEADER, day(3, inv="3")]) + "\n")
    counts = run(1)
    assert counts["silver_count"] == 3 and "stray_count" not in counts  # day 3 is a day of the batch
    write_file(paths["raw"], "retail_sales_20101201.csv", "\n".join([HEADER, day(1, inv="1"), day(5, inv="2")]) + "\n")
    assert run(2)["stray_count"] == 1
    got = spark.read.parquet(paths["silver"]).select("InvoiceNo", F.dayofmonth("SourceDate").alias("d")).collect()
    assert sorted(map(tuple, got)) == [("1", 1), ("2", 5), ("3", 3)]
    # All lines of the file are rejected now: its rows go.
    write_file(paths["raw"], "retail_sales_20101201.csv", HEADER + "\n" + day(1, inv="") + "\n")
    run(3)
    assert [r.InvoiceNo for r in spark.read.parquet(paths["silver"]).collect()] == ["3"]

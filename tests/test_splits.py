"""Splits of CSV files: record borders, numbers and contents against a sequential reader."""

import csv
import os
import random

import pytest
from pyspark.sql import functions as F

from fixtures import HEADER, line, write_file
from strata.session import cut_lineage
from strata.sources import files
from strata.sources.splits import SplitScan, record_texts

ODD_RECORDS = [
    'a,b', '"a\nb",c', '"x ""y"" z",1', '"""",2', '"",""', ',,', 'st"ray,q"uote', '"a,\r\nb",3', '"é\n中",4', ' "blank first",5', '"last"', "'single',6",
    '"ends""",7', '"""starts",8', "x" * 50, '"' + "line\n" * 20 + '",9',
]


def body(rng, n, ends=("\n", "\r\n")):
    out, records = [], []
    for _ in range(n):
        if rng.random() < 0.1:
            out.append(rng.choice(ends))  # a blank line is no record
            continue
        r = rng.choice(ODD_RECORDS)
        records.append(r)
        out.append(r + rng.choice(ends))
    return "".join(out), records


@pytest.mark.parametrize("chunk", [1, 2, 3, 7, 64, 1 << 20])
def test_splits_cut_whole_records(chunk):
    rng = random.Random(chunk)
    for trial in range(20):
        text, records = body(rng, rng.randint(0, 60))
        if trial % 3 == 0 and records:
            text = text.rstrip("\r\n")  # no line break at the end
        data = ("h1,h2\r\n" + text).encode()
        for size in (1, 40, 200, 1 << 20):
            scan = SplitScan(",", size)
            for a in range(0, len(data), chunk):
                scan.feed(data[a : a + chunk])
            scan.feed(b"", last=True)
            splits = scan.splits()
            assert [b for _, b, _ in splits[:-1]] == [a for a, _, _ in splits[1:]]
            got = []
            for a, b, first in splits:
                assert first == len(got)
                got += record_texts(data[a:b]).to_pylist()
            assert got == records
            if size == 1 and records:
                assert len(splits) >= len(records)


def test_header_only_and_empty():
    for data in (b"", b"a,b", b"a,b\n", b"a,b\r\n\r\n"):
        scan = SplitScan()
        scan.feed(data)
        scan.feed(b"", last=True)
        assert [t for a, b, _ in scan.splits() for t in record_texts(data[a:b]).to_pylist()] == []


def test_one_file_over_many_tasks_equals_a_sequential_read(spark, workdir):
    """Quoted line breaks and doubled quotes, more than 8 tasks, numbers as of a sequential reader; one read of the file."""
    rng = random.Random(5)
    path = os.path.join(workdir, "raw", "retail_sales_20101201.csv")
    os.makedirs(os.path.dirname(path))
    with open(path, "w", newline="", encoding="utf-8") as f:
        writer = csv.writer(f, lineterminator="\n")
        writer.writerow(HEADER.split(","))
        for i in range(40_000):
            text = rng.choice(["WIDGET", "two\nlines", 'say "hi"\n\n', "a,b", "é\n" * 3, ""])
            writer.writerow([f"5{i}", "S1", text, rng.randint(1, 9), "2010-12-01 08:26:00", "2.5", "17850", "UK"])
    fp = cut_lineage(files.fingerprint(spark, os.path.dirname(path), split_bytes=100_000), "fingerprints")
    assert fp.select(F.size("splits")).first()[0] > 15
    old = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", "16")
    try:
        df = files.read_lines(spark, fp, tokens=None)
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", old)
    assert df.rdd.getNumPartitions() > 8
    assert len({r.p for r in df.select(F.spark_partition_id().alias("p")).distinct().collect()}) > 8
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "Scan csv" not in plan and "Join" not in plan
    got = {r.record_number: (r.InvoiceNo, r.Description, r.Quantity) for r in df.collect()}
    with open(path, newline="", encoding="utf-8") as f:
        want = {i + 1: (r[0], r[2] or None, r[3]) for i, r in enumerate(csv.reader(f)) if i}
    assert got == want


def test_split_read_equals_the_csv_source(spark, workdir):
    """Nulls, short and long rows, quotes inside fields: the same rows as Spark's CSV source gives."""
    text = HEADER + "\n" + "\n".join(
        [line(), '"",S2,,"",x,1,,UK', line(desc='"two\nlines, ""q"""'), "536365,S1", line() + ",extra", line() + ",", "", '5,st"ray,q"x,1,d,2,c,UK', line(desc=" padded ")]
    )
    raw = os.path.join(workdir, "raw")
    path = write_file(raw, "retail_sales_20101201.csv", text)
    fp = files.fingerprint(spark, raw, split_bytes=64)
    got = sorted(tuple(r)[1:] for r in files.read_lines(spark, fp).collect())
    want = sorted(tuple(r)[1:] for r in files.read_group(spark, [path], HEADER.split(",")).collect())
    assert got == want and len(got) == 8


def test_semicolon_feed(spark, workdir):
    from strata.plans.ingest import ingest_feeds
    from strata.sources.config import feed_config

    feeds = []
    for provider, sep in (("comma", ","), ("semi", ";")):
        root = os.path.join(workdir, provider)
        rows = [HEADER, line(desc='"a;b, c"'), line(inv=""), line(inv="7", price="2,5" if sep == ";" else "2.5")]
        cells = [list(csv.reader([r]))[0] if i != 3 else HEADER.split(",") for i, r in enumerate(rows)]
        cells[3] = ["7", "S1", "x", "6", "2010-12-01 08:26:00", "2.5", "1", "UK"]
        with_sep = "\n".join(sep.join(f'"{c}"' if sep in c or "," in c else c for c in r) for r in cells) + "\n"
        write_file(os.path.join(root, "raw"), "retail_sales_20101201.csv", with_sep)
        paths = {f"{k}_path": os.path.join(root, k) for k in ("raw", "bronze", "silver", "quarantine")}
        feeds.append({"provider_id": provider, "delimiter": sep, **paths})
    res = ingest_feeds(spark, feed_config(spark, feeds), os.path.join(workdir, "state")).collect()
    assert sorted((r.provider_id, r.valid_records, r.rejected_records, r.status) for r in res) == [("comma", 2, 1, "SUCCESS"), ("semi", 2, 1, "SUCCESS")]
    for f in feeds:
        got = spark.read.option("header", "true").csv(f["bronze_path"]).select("Description").collect()
        assert sorted(r.Description for r in got) == ["a;b, c", "x"]

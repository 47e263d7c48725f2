"""File fixtures (FIXTURES.md §4): discovery names, headers, byte-order mark,
empty and header-only files, extra/short fields, quoted newlines."""

import hashlib
import os

from pyspark.sql import functions as F

from fixtures import HEADER, fixture_text, line, write_file
from strata.plans.ingest import ingest_batch
from strata.sources.files import discover, fingerprint


def test_discovery_filters_and_order(spark, workdir):
    raw = os.path.join(workdir, "raw")
    write_file(raw, "retail_sales_20101202.csv", fixture_text())
    write_file(os.path.join(raw, "sub"), "retail_sales_20101201.csv", fixture_text())
    write_file(raw, "retail_sales_20101399.csv", fixture_text())  # impossible date
    write_file(raw, "retail_sales_20101203.CSV", fixture_text())  # pattern is case-sensitive
    write_file(os.path.join(raw, "test"), "retail_sales_20101204.csv", fixture_text())
    write_file(raw, "notes.txt", "x")
    got = [(r.source_file, str(r.source_date)) for r in discover(spark, raw).collect()]
    assert got == [("retail_sales_20101201.csv", "2010-12-01"), ("retail_sales_20101202.csv", "2010-12-02")]


def test_fingerprint_matches_hashlib(spark, workdir):
    raw = os.path.join(workdir, "raw")
    text = "﻿" + fixture_text().replace("\n", "\r\n")
    p = write_file(raw, "retail_sales_20101201.csv", None, binary=text.encode("utf-8"))
    r = fingerprint(spark, raw).collect()[0]
    assert r.source_checksum == hashlib.sha256(open(p, "rb").read()).hexdigest()
    assert r.physical_records == 18
    assert list(r.header) == HEADER.split(",")


def _ingest(spark, workdir, files, level="exact_set"):
    raw = os.path.join(workdir, "raw")
    for name, text in files.items():
        if isinstance(text, bytes):
            write_file(raw, name, None, binary=text)
        else:
            write_file(raw, name, text)
    out = {k: os.path.join(workdir, k) for k in ("bronze", "quarantine", "state")}
    res = ingest_batch(spark, raw, out["bronze"], out["quarantine"], out["state"], run_id="t", level=level).collect()
    return {r.source_file: r for r in res}, out


def test_file_level_verdicts(spark, workdir):
    cols = HEADER.split(",")
    reordered = ",".join([cols[1], cols[0]] + cols[2:])
    swapped_row = lambda l: ",".join([l.split(",")[1], l.split(",")[0]] + l.split(",")[2:])
    body = [line(), line(inv="536400")]
    files = {
        "retail_sales_20101201.csv": HEADER + "\n" + "\n".join(body) + "\n",
        "retail_sales_20101202.csv": reordered + "\n" + "\n".join(swapped_row(x) for x in body) + "\n",
        "retail_sales_20101203.csv": ",".join(cols[:-1]) + "\n" + "\n".join(x.rsplit(",", 1)[0] for x in body) + "\n",
        "retail_sales_20101204.csv": HEADER + ",Foo\n" + "\n".join(x + ",1" for x in body) + "\n",
        "retail_sales_20101205.csv": HEADER + ",Country\n" + "\n".join(x + ",UK" for x in body) + "\n",
        "retail_sales_20101206.csv": b"\xef\xbb\xbf" + (HEADER + "\n" + body[0] + "\n").encode(),
        "retail_sales_20101207.csv": HEADER + "\n",
        "retail_sales_20101208.csv": b"",
        "retail_sales_20101209.csv": HEADER + "\n" + body[0] + "\n" + body[1] + ",extra\n",
        "retail_sales_20101210.csv": HEADER + "\n" + body[0] + "\n" + body[1].rsplit(",", 1)[0] + "\n",
        "retail_sales_20101211.csv": HEADER + '\n536365,S1,"two\nlines, ""quoted""",6,2010-12-11 08:00:00,2.5,17850,UK\n',
    }
    res, out = _ingest(spark, workdir, files)
    st = {k: (v.status, v.total_records, v.valid_records, v.rejected_records) for k, v in res.items()}
    assert st["retail_sales_20101201.csv"] == ("SUCCESS", 2, 2, 0)
    assert st["retail_sales_20101202.csv"] == ("SUCCESS", 2, 2, 0)  # exact_set: any order
    assert st["retail_sales_20101203.csv"][0] == "FILE_VALIDATION_FAILED"  # Country missing
    assert "Missing expected columns: Country" in res["retail_sales_20101203.csv"].file_error
    assert st["retail_sales_20101204.csv"][0] == "FILE_VALIDATION_FAILED"  # unexpected Foo
    assert st["retail_sales_20101205.csv"][0] == "FILE_VALIDATION_FAILED"  # Country twice
    assert st["retail_sales_20101206.csv"] == ("SUCCESS", 1, 1, 0)  # byte-order mark
    assert st["retail_sales_20101207.csv"] == ("SUCCESS", 0, 0, 0)  # header only
    assert st["retail_sales_20101208.csv"][0] == "FILE_VALIDATION_FAILED"  # zero bytes
    assert st["retail_sales_20101209.csv"][0] == "FILE_VALIDATION_FAILED"  # extra field
    assert st["retail_sales_20101210.csv"] == ("SUCCESS", 2, 1, 1)  # short row -> required_country
    assert st["retail_sales_20101211.csv"] == ("SUCCESS", 1, 1, 0)  # quoted newline, one row
    b = spark.read.option("header", "true").option("multiLine", "true").option("escape", '"').csv(out["bronze"])
    desc = [r.Description for r in b.filter("source_file = 'retail_sales_20101211.csv'").collect()]
    assert desc == ['two\nlines, "quoted"']
    # whole failed files kept with their bytes
    failed = spark.read.parquet(os.path.join(out["quarantine"], "files"))
    assert failed.count() == 5
    # reordered file lands in contract order
    r = b.filter("source_file = 'retail_sales_20101202.csv'").collect()
    assert sorted(x.InvoiceNo for x in r) == ["536365", "536400"]


def test_redelivery_replaces_both_sides(spark, workdir):
    raw = os.path.join(workdir, "raw")
    out = {k: os.path.join(workdir, k) for k in ("bronze", "quarantine", "state")}
    write_file(raw, "retail_sales_20101201.csv", HEADER + "\n" + line() + "\n" + line(inv="") + "\n")
    ingest_batch(spark, raw, out["bronze"], out["quarantine"], out["state"], run_id="a").collect()
    q = os.path.join(out["quarantine"], "rows", "source_date=2010-12-01", "source_file=retail_sales_20101201.csv")
    assert os.path.isdir(q)
    write_file(raw, "retail_sales_20101201.csv", HEADER + "\n" + line() + "\n")  # new bytes, no rejects
    res = ingest_batch(spark, raw, out["bronze"], out["quarantine"], out["state"], run_id="b").collect()
    assert len(res) == 1 and res[0].rejected_records == 0
    assert not os.path.isdir(q)


def test_record_numbers_across_splits(spark, workdir):
    """Physical record numbers stay exact when files are split over many tasks
    (multiLine off, tiny split size): no per-file task, no sort."""
    from strata.sources.files import read_group

    raw = os.path.join(workdir, "raw")
    paths = []
    for f in range(2):
        body = "\n".join(line(inv=f"{f}{i:06d}") for i in range(20000))
        paths.append(write_file(raw, f"retail_sales_2010120{f + 1}.csv", HEADER + "\n" + body + "\n"))
    old = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", str(256 * 1024))
    try:
        df = read_group(spark, paths, HEADER.split(","), multiline=False)
        assert df.rdd.getNumPartitions() >= 8
        rows = df.select("source_uri", "record_number", "InvoiceNo").collect()
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", old)
    assert len(rows) == 40000
    for r in rows:
        assert int(r.InvoiceNo[1:]) + 2 == r.record_number


def test_ingest_feeds_from_config(spark, workdir):
    from fixtures import fixture_text
    from strata.plans.ingest import ingest_feeds
    from strata.sources.config import feed_config

    feeds = []
    for p in ("prov_a", "prov_b"):
        root = os.path.join(workdir, p)
        write_file(os.path.join(root, "raw"), "retail_sales_20101201.csv", fixture_text())
        feeds.append(
            {"provider_id": p, **{f"{k}_path": os.path.join(root, k) for k in ("raw", "bronze", "silver", "quarantine")}}
        )
    feeds.append({**feeds[0], "provider_id": "off", "active": False})
    res = ingest_feeds(spark, feed_config(spark, feeds), os.path.join(workdir, "state")).collect()
    assert sorted((r.provider_id, r.valid_records, r.rejected_records) for r in res) == [("prov_a", 7, 11), ("prov_b", 7, 11)]


def test_fingerprint_cache_reads_only_changed_files(spark, workdir):
    import time

    from strata.sources.files import fingerprint

    raw = os.path.join(workdir, "raw")
    a = write_file(raw, "retail_sales_20101201.csv", HEADER + "\n" + line() + "\n")
    write_file(raw, "retail_sales_20101202.csv", HEADER + "\n" + line(inv="9") + "\n")
    first = fingerprint(spark, raw)
    cache = spark.createDataFrame(first.collect(), first.schema)
    # tamper with the cached checksum of file 2: an unchanged file must reuse it
    cache = cache.withColumn(
        "source_checksum",
        F.when(F.col("source_uri").endswith("20101202.csv"), F.lit("cached")).otherwise(F.col("source_checksum")),
    )
    time.sleep(0.01)
    with open(a, "a") as fh:
        fh.write(line(inv="7") + "\n")  # file 1 changes: new length and time
    got = {r.source_uri.rsplit("/", 1)[-1]: r for r in fingerprint(spark, raw, cache=cache).collect()}
    assert got["retail_sales_20101202.csv"].source_checksum == "cached"
    assert got["retail_sales_20101201.csv"].source_checksum == hashlib.sha256(open(a, "rb").read()).hexdigest()
    assert got["retail_sales_20101201.csv"].physical_records == 2


def test_discover_by_partition_folder(spark, workdir):
    raw = os.path.join(workdir, "raw")
    write_file(os.path.join(raw, "source_date=2010-12-02"), "part-00000-a.c000.csv", fixture_text())
    write_file(os.path.join(raw, "source_date=2010-12-01"), "part-00001-b.c000.csv", fixture_text())
    write_file(os.path.join(raw, "source_date=2010-13-01"), "part-00002-c.c000.csv", fixture_text())  # no such date
    write_file(os.path.join(raw, "test", "source_date=2010-12-03"), "part-00003-d.c000.csv", fixture_text())
    got = [(r.source_file, str(r.source_date)) for r in discover(spark, raw, date_from="partition").collect()]
    assert got == [("part-00001-b.c000.csv", "2010-12-01"), ("part-00000-a.c000.csv", "2010-12-02")]


def test_listing_has_each_file_once(spark, workdir):
    """Empty files are listed; names that a URI escapes keep their form and are read."""
    raw = os.path.join(workdir, "raw")
    odd = os.path.join(raw, "a b+c%20d")
    write_file(odd, "retail_sales_20101201.csv", fixture_text())
    write_file(raw, "retail_sales_20101202.csv", None, binary=b"")
    got = {r.source_file: (r.source_uri, r.length) for r in discover(spark, raw).collect()}
    assert {k: v[1] > 0 for k, v in got.items()} == {"retail_sales_20101201.csv": True, "retail_sales_20101202.csv": False}
    assert discover(spark, raw).count() == 2
    assert "/a b+c%20d/" in got["retail_sales_20101201.csv"][0]
    sums = {r.source_uri: r.source_checksum for r in fingerprint(spark, raw).collect()}
    assert sums[got["retail_sales_20101202.csv"][0]] == hashlib.sha256(b"").hexdigest()
    assert sums[got["retail_sales_20101201.csv"][0]] == hashlib.sha256(fixture_text().encode()).hexdigest()
    assert discover(spark, os.path.join(workdir, "none")).count() == 0

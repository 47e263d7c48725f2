"""Plans: numbering under skew, dedup modes, manifest round trip, streaming,
and the driver entry point."""

import datetime as dt
import os

from pyspark.sql import functions as F

from conftest import SF001
from strata.operators import silver
from strata.plans.numbering import number_rows
from strata.schemas import RAW_COLUMNS, SILVER_COLUMNS


def test_number_rows_skewed_group(spark):
    # one group holds ~90% of the rows; numbers must be 1..n in order within each group
    rows = [("hot" if i % 10 else f"g{i % 7}", (i * 7919) % 10007) for i in range(5000)]
    df = spark.createDataFrame(rows, "g string, v long")
    got = number_rows(df, ["g"], ["v"], out="n", num_partitions=8).collect()
    by = {}
    for r in got:
        by.setdefault(r.g, []).append((r.v, r.n))
    for g, items in by.items():
        items.sort()
        assert [n for _, n in items] == list(range(1, len(items) + 1)), g


def test_dedup_modes(spark):
    base = ("536365", "S1", None, 6, dt.datetime(2010, 12, 1, 8, 26), 2.5, "17850", "UK", "f.csv")
    other = ("536365", "S1", "", 6, dt.datetime(2010, 12, 1, 8, 26), 2.5, "17850", "UK", "f.csv")
    schema = "InvoiceNo string, StockCode string, Description string, Quantity long, InvoiceDate timestamp, UnitPrice double, CustomerID string, Country string, SourceFile string"
    df = spark.createDataFrame([base, base, other], schema)
    typed = silver.dedup_exact(df, mode="typed").collect()
    hashed = silver.dedup_exact(df, mode="hash").drop(silver.HASH_COL).collect()
    assert len(typed) == 2  # NULL and '' differ as typed values
    assert len(hashed) == 1  # the row hash maps NULL to '' (reference behaviour)
    assert hashed[0].Description is None  # deterministic survivor: least value (NULL first)
    other_file = other[:-1] + ("g.csv",)
    df2 = spark.createDataFrame([base, other_file], schema)
    assert silver.dedup_exact(df2, mode="hash", scope="file").count() == 2
    assert silver.dedup_exact(df2, mode="hash", scope="batch").count() == 1


def test_prepare_and_verify_manifest(spark, workdir):
    from strata.plans.ingest import prepare_source, verify_source
    from strata.plans.retail import source_lines
    from strata.sinks.writers import clear_partitions

    out = os.path.join(workdir, "prepared")
    src = source_lines(spark, SF001).filter(F.col("InvoiceDate") < F.lit("1995-06-01"))
    manifest = prepare_source(spark, src, out).cache()
    assert manifest.agg(F.sum("record_count")).collect()[0][0] == src.count()
    checked = verify_source(spark, manifest, out)
    assert {r.status for r in checked.collect()} == {"OK"}
    # remove one day's folder: that file is reported missing, the rest stays OK
    first = manifest.orderBy("relative_path").first()
    clear_partitions(spark, os.path.join(out, "provider_retail"), [f"source_date={first.source_date}"])
    st = {r.relative_path: r.status for r in verify_source(spark, manifest, out).collect()}
    assert st[first.relative_path] == "MISSING_FILE"
    assert sum(1 for v in st.values() if v == "OK") == len(st) - 1


def test_stream_dedup_matches_batch(spark, workdir):
    from strata.streaming.stream import dedup_stream, run_available_now

    ev = spark.read.parquet(f"{SF001}/events.parquet")
    ev.repartition(3).write.parquet(os.path.join(workdir, "in"))
    stream = spark.readStream.schema(ev.schema).option("maxFilesPerTrigger", 1).parquet(os.path.join(workdir, "in"))
    q = run_available_now(
        dedup_stream(stream, ["user_id", "event_type"], "ts", "40 days").select("user_id", "event_type"),
        os.path.join(workdir, "ck"),
        os.path.join(workdir, "out"),
    )
    got = spark.read.parquet(os.path.join(workdir, "out"))
    assert got.count() == ev.select("user_id", "event_type").distinct().count()
    assert got.subtract(ev.select("user_id", "event_type")).count() == 0
    assert q.lastProgress is not None


def test_stream_dedup_over_a_long_span(spark, workdir):
    """Events over two years in any order: none is late, and no pair comes twice."""
    from strata.plans.queries import q_stream_dedup

    schema = spark.read.parquet(f"{SF001}/events.parquet").schema
    base = dt.datetime(2022, 1, 1)
    rows = [
        {"event_id": i, "ts": base + dt.timedelta(days=(i * 37) % 730), "user_id": i % 90, "event_type": "abc"[i % 3]} for i in range(900)
    ]
    table = spark.createDataFrame([tuple(r.get(f.name) for f in schema) for r in rows], schema)
    table.write.parquet(os.path.join(workdir, "events.parquet"))
    got = [tuple(r) for r in q_stream_dedup(spark, workdir).collect()]
    assert sorted(got) == sorted({(r["user_id"], r["event_type"]) for r in rows})


def test_entry_smoke(spark):
    import __spark_entry__ as e

    df = e.entry(spark)
    assert df.columns == SILVER_COLUMNS
    assert df.count() > 0
    assert set(e.oracle_sql()) <= set(e.queries())
    assert len(RAW_COLUMNS) == 8


def test_ingest_stream_fixture(spark, workdir):
    from fixtures import fixture_text, write_file
    from strata.streaming.stream import ingest_stream

    raw = os.path.join(workdir, "raw")
    write_file(raw, "retail_sales_20101201.csv", fixture_text())
    write_file(raw, "retail_sales_20101202.csv", fixture_text())
    b, q = os.path.join(workdir, "bronze"), os.path.join(workdir, "quarantine")
    ingest_stream(spark, raw, b, q, os.path.join(workdir, "ck"))
    bronze = spark.read.option("header", "true").csv(b)
    rows = spark.read.option("header", "true").csv(os.path.join(q, "rows"))
    assert bronze.count() == 14 and rows.count() == 22
    assert {int(r.record_number) for r in rows.collect()} == {3, 4, 5, 6, 7, 10, 12, 14, 15, 16, 17}


def test_stream_watermark_drops_late_rows(spark, workdir):
    """A delay shorter than the disorder between files drops late rows, and the
    query reports how many (the batch lookback would have re-read them)."""
    from strata.streaming.stream import dedup_stream, dropped_by_watermark, run_available_now

    base = dt.datetime(2024, 1, 10)
    mk = lambda d, k: (k, base + dt.timedelta(days=d))
    batches = [[mk(5, i) for i in range(10)], [mk(9, 100 + i) for i in range(10)], [mk(0, 200 + i) for i in range(10)]]
    for i, rows in enumerate(batches):
        spark.createDataFrame(rows, "k long, ts timestamp").coalesce(1).write.parquet(os.path.join(workdir, "in", f"b{i}"))
    schema = "k long, ts timestamp"
    stream = spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).option("recursiveFileLookup", "true").parquet(
        os.path.join(workdir, "in")
    )
    q = run_available_now(dedup_stream(stream, ["k"], "ts", "1 day"), os.path.join(workdir, "ck"), os.path.join(workdir, "out"))
    got = spark.read.parquet(os.path.join(workdir, "out")).count()
    assert got < 30
    assert dropped_by_watermark(q) == 30 - got


def test_number_rows_independent_of_input_order(spark):
    # a third of the rows are copies of one line; the rest distinct
    rows = [("f1", "same", 1)] * 600 + [("f1" if i % 2 else "f2", f"v{i:05d}", i % 9) for i in range(1200)]
    df = spark.createDataFrame(rows, "g string, a string, b int")
    a = number_rows(df.repartition(7), ["g"], ["a", "b"], out="n", num_partitions=6)
    b = number_rows(df.orderBy(F.rand(3)).repartition(3), ["g"], ["a", "b"], out="n", num_partitions=5)
    ra = sorted(tuple(r) for r in a.collect())
    rb = sorted(tuple(r) for r in b.collect())
    assert ra == rb
    by = {}
    for g, av, bv, n in ra:
        by.setdefault(g, []).append(n)
    for g, ns in by.items():
        assert sorted(ns) == list(range(1, len(ns) + 1)), g
    # copies of the hot line take one contiguous block of numbers
    hot = sorted(n for g, av, bv, n in ra if av == "same")
    assert hot == list(range(hot[0], hot[0] + 600))


def test_hash_dedup_survivor_is_deterministic(spark):
    ts = dt.datetime(2010, 12, 1, 8, 26)
    schema = "InvoiceNo string, StockCode string, Description string, Quantity long, InvoiceDate timestamp, UnitPrice double, CustomerID string, Country string, SourceFile string"
    rows = [
        ("536365", "S1", "W", 6, ts, 2.5, None, "UK", "b.csv"),
        ("536365", "S1", "W", 6, ts, 2.5, "", "UK", "a.csv"),
    ]
    for order in (rows, rows[::-1]):
        df = spark.createDataFrame(order, schema).repartition(2)
        got = silver.dedup_exact(df, mode="hash", scope="batch", survivor_order=["SourceFile"]).collect()
        assert len(got) == 1
        assert (got[0].SourceFile, got[0].CustomerID) == ("a.csv", "")  # least source file survives


def test_ingest_stream_restart_is_idempotent(spark, workdir):
    from fixtures import fixture_text, write_file
    from strata.streaming.stream import ingest_stream

    raw = os.path.join(workdir, "raw")
    write_file(raw, "retail_sales_20101201.csv", fixture_text())
    b, q, ck = (os.path.join(workdir, k) for k in ("bronze", "quarantine", "ck"))
    ingest_stream(spark, raw, b, q, ck)
    ingest_stream(spark, raw, b, q, ck)  # restart on the same checkpoint: nothing new
    assert spark.read.option("header", "true").csv(b).count() == 7
    write_file(raw, "retail_sales_20101202.csv", fixture_text())
    ingest_stream(spark, raw, b, q, ck)  # only the new file is read
    bronze = spark.read.option("header", "true").csv(b)
    assert bronze.count() == 14
    assert bronze.select("source_file").distinct().count() == 2

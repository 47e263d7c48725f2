"""What the file round trips leave on the disks: shuffles of lines, their width, and what stays after a write (own rows)."""

import datetime as dt
import time
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from fixtures import HEADER, line, write_file
from strata import session
from strata.operators import silver
from strata.plans import ingest
from strata.plans.retail import retail_lines
from strata.schemas import RAW_COLUMNS
from strata.sinks.writers import write_bronze
from strata.sources import splits
from strata.sources.files import list_files

DAY = dt.datetime(2024, 5, 1)
LINEITEM = "l_orderkey long, l_partkey long, l_suppkey long, l_linenumber int, l_quantity double, l_extendedprice double, l_returnflag string, l_shipdate timestamp"
TEXTS = ["x", "a,b", 'q"uo"te', "line\nbreak", "cr\r\nlf", "cr\ronly", " lead", "trail ", "", None, "end\r", "\\back", "back\\", '"', '""', 'a"\n,b', "\n", "\r"]


def exchanges(df) -> list[str]:
    return [ln for ln in df._jdf.queryExecution().executedPlan().toString().splitlines() if "Exchange " in ln]


def shuffle_files(spark) -> set[str]:
    found = spark.sparkContext._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().getAllFiles()
    names = {found.apply(i).getName() for i in range(found.size())}
    return {n for n in names if n.startswith("shuffle_") and n.endswith(".data")}


def shuffles_gone(spark, before: set[str], seconds: float = 5) -> bool:
    """Whether all shuffle files newer than ``before`` go (they are removed in the background)."""
    deadline = time.time() + seconds
    while (left := shuffle_files(spark) - before) and time.time() < deadline:
        time.sleep(0.2)
    return not left


def bronze_rows(spark, names):
    rows = []
    for name in names:
        for i, v in enumerate(TEXTS):
            for k in range(8):
                rows.append((*[v if j == k else f"{i}" for j in range(8)], "2024-05-01", name))
    return spark.createDataFrame(rows, ", ".join(f"{c} string" for c in RAW_COLUMNS) + ", source_date string, source_file string")


def test_bronze_files_read_whole_equal_sparks_reader(spark, workdir):
    rows = bronze_rows(spark, ["a:b.csv", "c d.csv", "e+f.csv", "g%h.csv", "plain.csv"]).repartition(3)
    write_bronze(rows, workdir)
    want = ingest._read_bronze(spark, [workdir], None)
    files = list_files(spark, workdir).select("path", "length", ingest._name_of_rows("path").alias("source_file"))
    got = ingest._read_bronze_files(files)
    columns = [*RAW_COLUMNS, "source_file"]
    assert want.count() == 5 * 8 * len(TEXTS)
    assert got.select(columns).exceptAll(want.select(columns)).isEmpty() and want.select(columns).exceptAll(got.select(columns)).isEmpty()
    # The three parts of a file lie in one task.
    tasks = got.select("source_file", F.spark_partition_id().alias("p")).distinct().groupBy("source_file").count()
    assert len(list(Path(workdir).glob("*/source_file=plain.csv/part-*.csv"))) == 3
    assert [r["count"] for r in tasks.collect()] == [1] * 5


@pytest.mark.parametrize("size", [1, 2, 3, 7, 1000])
def test_records_of_chunks_are_those_of_the_file(size):
    data = (HEADER + "\n" + line(inv='"a\n""b"') + "\r\n\n" + line(desc='"c\r\nd"') + "\n" + line(inv="last")).encode()
    chunks = (data[i : i + size] for i in range(0, len(data), size))
    got = [t for part in splits.file_records(chunks) for t in part.to_pylist()]
    assert got == splits.record_texts(data).to_pylist()[1:] and len(got) == 3
    assert [len(p) for p in splits.file_records(iter([]))] == []


def typed_rows(spark):
    rows = []
    for f in ("a", "b", "c"):
        for sum_ in (None, "x"):
            tail = (f, sum_)
            rows += [(f"i{k % 20}", "s", "d", 1, DAY, 2.0, "c", "UK", *tail) for k in range(60)]
            rows += [("i1", "s", d, 1, DAY, 2.0, "c", "UK", *tail) for d in (None, "")]
            rows += [("i1", "s", "d", 1, DAY, p, "c", "UK", *tail) for p in (0.0, -0.0, float("nan"), float("nan"))]
            rows += [("i1", "s", "d", 1, DAY.replace(microsecond=7), 2.0, "c", "UK", *tail), (None,) * 8 + tail]
            rows += [("a||b", "s", "d", 1, DAY, 1.0, "c", "UK", *tail), ("a", "b||s", "d", 1, DAY, 1.0, "c", "UK", *tail)]
    kinds = ", ".join(f"{c} {silver.SILVER_TYPES[c].simpleString()}" for c in RAW_COLUMNS)
    return spark.createDataFrame(rows, f"{kinds}, SourceFile string, SourceChecksum string")


def test_dedup_in_place_shuffles_nothing(spark, workdir):
    df = typed_rows(spark)
    plain = silver.dedup_exact(df, carry_keys=["SourceChecksum"])
    lying = df.repartition(3, "SourceFile")
    got = silver.dedup_exact(lying, carry_keys=["SourceChecksum"], in_place=True)
    assert len(exchanges(got)) == 1  # the one that dealt the rows
    key = lambda r: tuple((v is not None, str(v)) for v in r)
    assert got.columns == plain.columns
    assert sorted(map(key, got.collect())) == sorted(map(key, plain.collect()))
    # Runs go on over batches.
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "3")
    try:
        assert sorted(map(key, got.select("*").collect())) == sorted(map(key, plain.collect()))
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")
    with pytest.raises(ValueError):
        silver.dedup_exact(df, mode="typed", in_place=True)


@pytest.mark.parametrize("part_bytes", [64 << 20, 1500, 1, None])
def test_silver_of_small_and_large_files(spark, workdir, monkeypatch, part_bytes):
    """None: files that only Spark's readers open."""
    seen, own_reads = [], part_bytes is not None
    if not own_reads:
        part_bytes = 1500
        monkeypatch.setattr(ingest, "opens", lambda path: False)

    def to_silver(*args, **how):
        seen.append(how)
        return real(*args, **how)

    real = silver.to_silver
    monkeypatch.setattr(ingest.silver, "to_silver", to_silver)
    monkeypatch.setattr(ingest, "PART_BYTES", part_bytes)
    day = lambda d, n: "\n".join([HEADER, *[line(inv=str(k % n), date=f"2010-12-0{d} 08:00:00") for k in range(3 * n)]]) + "\n"
    write_file(f"{workdir}/raw", "retail_sales_20101201.csv", day(1, 5))
    write_file(f"{workdir}/raw", "retail_sales_20101202.csv", day(2, 40))
    ingest.ingest_batch(spark, f"{workdir}/raw", f"{workdir}/bronze", f"{workdir}/q", f"{workdir}/state", run_id="r")
    counts = ingest.bronze_to_silver(spark, f"{workdir}/bronze", f"{workdir}/silver", "r", state_path=f"{workdir}/state")
    assert counts == {"source_count": 135, "deduplicated_count": 45, "duplicate_count": 90, "silver_count": 45}
    rows = spark.read.parquet(f"{workdir}/silver")
    got = {(r.SourceFile, r.n, r.sums) for r in rows.groupBy("SourceFile").agg(F.count("InvoiceNo").alias("n"), F.count_distinct("SourceChecksum").alias("sums")).collect()}
    assert got == {("retail_sales_20101201.csv", 5, 1), ("retail_sales_20101202.csv", 40, 1)}
    want = [(True, False)] * own_reads + [(False, True)] * (not own_reads or part_bytes <= 1500)
    assert [("in_place" in h, "parts_col" in h) for h in seen] == want
    # One day alone.
    counts = ingest.bronze_to_silver(spark, f"{workdir}/bronze", f"{workdir}/silver", "r2", state_path=f"{workdir}/state", dates=["2010-12-01"])
    assert counts["silver_count"] == 5 and spark.read.parquet(f"{workdir}/silver").count() == 45
    with pytest.raises(Exception, match="PATH_NOT_FOUND"):
        ingest.bronze_to_silver(spark, f"{workdir}/bronze", f"{workdir}/silver", "r3", dates=["2010-12-09"])


def test_lines_are_shuffled_narrow(spark, workdir):
    none = {
        "lineitem": LINEITEM,
        "orders": "o_orderkey long, o_custkey long", "customer": "c_custkey long, c_nationkey int",
        "nation": "n_nationkey int, n_name string", "part": "p_partkey long, p_name string",
    }
    for name, ddl in none.items():
        spark.createDataFrame([], ddl).write.parquet(f"{workdir}/{name}.parquet")
    lines = retail_lines(spark, workdir, by_day=True)
    plan = lines._jdf.queryExecution().executedPlan().toString().splitlines()
    (at,) = [i for i, ln in enumerate(plan) if "REBALANCE_PARTITIONS_BY_COL" in ln]
    assert "hashpartitioning(_day" in plan[at]
    shuffled = plan[at + 1]
    for wide in ("l_suppkey", "l_linenumber", "l_quantity", "l_returnflag", "l_shipdate", "n_name", "o_orderkey", "p_partkey"):
        assert wide not in shuffled
    assert "p_name" in shuffled and "_marks" in shuffled


def test_a_write_removes_its_shuffle_files(spark, workdir):
    assert spark.conf.get(session.SHUFFLE_CLEANUP, None) is None
    with session.stage_table(spark.range(1000).repartition(4, "id"), "kept") as rows:
        path = rows.inputFiles()[0].removeprefix("file:").replace("//", "/")
        assert rows.count() == 1000 and Path(path).exists()
        with session.shuffles_removed(spark), session.shuffles_removed(spark):
            assert spark.conf.get(session.SHUFFLE_CLEANUP) == "true"
    assert spark.conf.get(session.SHUFFLE_CLEANUP, None) is None
    assert not Path(path).parent.exists()
    before = shuffle_files(spark)
    write_bronze(bronze_rows(spark, ["a.csv"]).repartition(4, "InvoiceNo"), f"{workdir}/bronze")
    assert shuffles_gone(spark, before)


@pytest.mark.parametrize("how", ["plain", "elected", "failing"])
def test_a_batch_leaves_no_staged_rows(spark, workdir, monkeypatch, how):
    staged, real = [], session.scratch_path

    def scratch_path(spark, name):
        staged.append((name, real(spark, name)))
        return staged[-1][1]

    monkeypatch.setattr(session, "scratch_path", scratch_path)
    if how == "failing":
        monkeypatch.setattr(ingest.writers, "write_bronze", lambda *a: (_ for _ in ()).throw(OSError("lost")))
    write_file(f"{workdir}/raw", "retail_sales_20101201.csv", "\n".join([HEADER, line(inv="1"), line(inv=""), line(inv="3")]) + "\n")
    run = lambda: ingest.ingest_batch(
        spark, f"{workdir}/raw", f"{workdir}/bronze", f"{workdir}/q", f"{workdir}/state", run_id="r", elect=how == "elected", audit_path=f"{workdir}/audit"
    )
    if how == "failing":
        with pytest.raises(OSError):
            run()
    else:
        results = run()
        assert [(r.total_records, r.valid_records, r.rejected_records) for r in results.collect()] == [(3, 2, 1)]
    rows = [Path(p) for name, p in staged if name in ("flagged", "raw-lines")]
    assert len(rows) == (2 if how == "elected" else 1) and not any(p.exists() for p in rows)
    assert spark.conf.get(session.SHUFFLE_CLEANUP, None) is None


def test_staged_raw_files_leave_no_shuffle_files(spark, workdir):
    from strata.plans import queries as Q

    tables = {
        "lineitem": ([(k, k % 5, k % 3, k % 7, 2.0, 9.5, "RNA"[k % 3], DAY + dt.timedelta(days=k % 4)) for k in range(200)], LINEITEM),
        "orders": ([(k, k % 9) for k in range(150)], "o_orderkey long, o_custkey long"),
        "customer": ([(k, k) for k in range(8)], "c_custkey long, c_nationkey int"),
        "nation": ([(k, f"n{k}") for k in range(7)], "n_nationkey int, n_name string"),
        "part": ([(k, f"p{k}") for k in range(4)], "p_partkey long, p_name string"),
    }
    for name, (rows, ddl) in tables.items():
        spark.createDataFrame(rows, ddl).write.parquet(f"{workdir}/{name}.parquet")
    before = shuffle_files(spark)
    raw = Q.stage_raw_files(spark, workdir)
    assert list(Path(raw).rglob("part-*.csv"))
    assert shuffles_gone(spark, before)

"""What keeps the work of the lines' queries in bounds as the tables grow (own rows)."""

import datetime as dt
import re
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from strata.operators import silver
from strata.plans import queries as Q
from strata.schemas import RAW_COLUMNS
from strata.sinks.writers import write_bronze

DAY = dt.datetime(2024, 5, 1)


def test_a_slice_gives_every_task_slot_its_rows(spark, workdir):
    if spark.sparkContext.defaultParallelism < 3:
        pytest.skip("needs three task slots")
    rows = spark.range(120_001).select(
        F.col("id").alias("event_id"), F.timestamp_seconds(F.lit(1_700_000_000) + F.col("id")).alias("ts"),
        (F.col("id") % 7).alias("user_id"), F.lit("view").alias("event_type"),
    )
    rows.write.parquet(f"{workdir}/events.parquet")
    _, dealt, slices = Q.time_slices(spark, workdir)
    assert slices == 2
    staged = Q.stage_slices(dealt, "test-slices")
    sizes = {k: staged.where(F.col("slice") == k).count() for k in range(slices + 1)}
    assert sum(sizes.values()) == 120_001 and sizes[2] == 6001
    # Reading one slice reads its folder.
    plan = staged.where(F.col("slice") == 1)._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(slice" in plan


def test_date_purity_has_parts_by_the_number_of_lines(spark, workdir, monkeypatch):
    monkeypatch.setattr(Q, "PURITY_ROWS", 5, raising=False)
    lines = [(k % 10, 1, DAY + dt.timedelta(days=k // 50)) for k in range(100)]
    spark.createDataFrame(lines, "l_orderkey long, l_suppkey long, l_shipdate timestamp").write.parquet(f"{workdir}/lineitem.parquet")
    spark.createDataFrame([(k, DAY) for k in range(9)], "o_orderkey long, o_orderdate timestamp").write.parquet(f"{workdir}/orders.parquet")
    got = Q.QUERIES["date_purity"](spark, workdir)
    plan = got._jdf.queryExecution().executedPlan().toString()
    assert re.search(r"hashpartitioning\(l_orderkey#\d+L?, 20\)", plan)
    # The counts by order need no shuffle of their own.
    assert plan.count("hashpartitioning(l_orderkey") == 1
    rows = {r.l_orderkey: (r.record_count, r.distinct_dates, r.declared_date) for r in got.collect()}
    assert rows == {k: (10, 2, DAY.date() if k < 9 else None) for k in range(10)}


def test_bronze_rows_are_written_where_they_lie(spark, workdir):
    text = [F.lit("x").alias(c) for c in RAW_COLUMNS]
    rows = spark.range(1000).repartition(3).select(*text, F.lit("2024-05-01").alias("source_date"), F.lit("f.csv").alias("source_file"))
    write_bronze(rows, f"{workdir}/bronze")
    parts = list(Path(f"{workdir}/bronze/source_date=2024-05-01/source_file=f.csv").glob("part-*.csv"))
    assert len(parts) == 3
    assert spark.read.option("header", "true").csv(f"{workdir}/bronze").count() == 1000


@pytest.mark.parametrize("by_day", [False, True])
def test_lines_are_the_same_by_day(spark, by_day):
    from conftest import SF001
    from strata.plans.retail import retail_lines

    want = retail_lines(spark, SF001)
    got = retail_lines(spark, SF001, by_day=by_day)
    assert got.columns == want.columns and got.exceptAll(want).isEmpty() and want.exceptAll(got).isEmpty()


def test_dealt_dedup_shuffles_the_lines_once(spark):
    rows = []
    for f, parts in (("a", None), ("b", 1), ("c", 3)):
        for k in range(40):
            base = (f"i{k % 20}", "s", "d", 1, DAY, 2.0, "c", "UK", f, None, parts)
            rows.append(base)
        rows += [
            ("i1", "s", None, 1, DAY, 2.0, "c", "UK", f, None, parts),
            ("i1", "s", "", 1, DAY, 2.0, "c", "UK", f, None, parts),
            ("i1", "s", "d", 1, DAY.replace(microsecond=7), 2.0, "c", "UK", f, None, parts),
            (None, None, None, None, None, None, None, None, f, None, parts),
        ]
    kinds = ", ".join(f"{c} {silver.SILVER_TYPES[c].simpleString()}" for c in RAW_COLUMNS)
    df = spark.createDataFrame(rows, f"{kinds}, SourceFile string, SourceChecksum string, parts long")
    dealt = silver.dedup_exact(df, carry_keys=["SourceChecksum"], parts_col="parts")
    assert dealt._jdf.queryExecution().executedPlan().toString().count("Exchange ") == 1
    plain = silver.dedup_exact(df.drop("parts"), carry_keys=["SourceChecksum"])
    assert dealt.columns == plain.columns
    key = lambda r: tuple((v is not None, str(v)) for v in r)
    assert sorted(map(tuple, dealt.collect()), key=key) == sorted(map(tuple, plain.collect()), key=key)

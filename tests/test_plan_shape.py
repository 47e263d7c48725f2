"""Physical-plan properties the design relies on (checked on sf0.001)."""

import datetime as dt
import os

from conftest import SF001
from strata.operators import incremental as inc
from strata.plans import queries as Q


def plan_of(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def test_silver_reads_lineitem_once_with_pruned_columns(spark):
    plan = plan_of(Q.QUERIES["silver_lines"](spark, SF001))
    assert plan.count("lineitem.parquet") == 1
    scan = [ln for ln in plan.splitlines() if "lineitem.parquet" in ln][0]
    for unused in ("l_discount", "l_tax", "l_linestatus"):
        assert unused not in scan
    assert "PythonUDF" not in plan and "BatchEvalPython" not in plan


def test_rules_evaluated_once_before_split(spark):
    plan = plan_of(Q.QUERIES["valid_lines"](spark, SF001))
    assert plan.count("RLIKE") == 3  # three blank tests, computed once (not again in a pushed filter)
    assert "Generate inline" in plan


def test_batch_audit_is_one_scan(spark):
    plan = plan_of(Q.QUERIES["run_audit"](spark, SF001))
    assert plan.count("lineitem.parquet") == 1


def test_latest_is_an_aggregate_not_a_window(spark):
    plan = plan_of(Q.QUERIES["latest_state"](spark, SF001))
    assert "Window" not in plan
    assert "Aggregate" in plan


def test_typed_dedup_is_hash_aggregate(spark):
    plan = plan_of(Q.QUERIES["dedup_lines"](spark, SF001))
    assert "HashAggregate" in plan and "SortAggregate" not in plan


def test_lookback_prunes_silver_partitions(spark, workdir):
    silver = Q.QUERIES["silver_lines"](spark, SF001)
    path = os.path.join(workdir, "silver")
    silver.write.partitionBy("SourceDate").parquet(path)
    table = spark.read.parquet(path)
    lo, hi = dt.datetime(1996, 1, 1), dt.datetime(1996, 1, 31, 23, 59, 59)
    rows = inc.apply_window_literal(table, lo, hi)
    plan = plan_of(rows)
    assert "PartitionFilters: [isnotnull(SourceDate" in plan
    want = table.filter((table.InvoiceDate >= lo) & (table.InvoiceDate <= hi)).count()
    assert rows.count() == want


def test_typed_silver_is_hash_aggregate(spark):
    plan = plan_of(Q.silver_plan(spark, SF001, dedup_mode="typed"))
    assert "HashAggregate" in plan and "SortAggregate" not in plan


def test_numbering_takes_two_exchanges(spark):
    """Of the rows; rows with many copies pass a third one as a few pieces."""
    from strata.plans.numbering import number_rows, sorted_rows

    df = spark.range(1000).selectExpr("id % 7 AS g", "CAST(id AS string) AS v")
    plan = plan_of(sorted_rows(df, ["g", "v"], ["g"], 8))
    assert plan.count("Exchange ") == 2 and "Window" not in plan
    numbered = number_rows(df, ["g"], ["v"], out="n", num_partitions=8)
    assert numbered.count() == 1000
    plan = plan_of(numbered)
    assert "BroadcastHashJoin" in plan and "SortMergeJoin" not in plan and "ShuffledHashJoin" not in plan


def test_copies_of_one_row_are_expanded_by_many_tasks(spark):
    from pyspark.sql import functions as F
    from strata.plans.numbering import number_rows

    hot = spark.range(1_000_000).selectExpr("'f' AS g", "'same line' AS v")
    rest = spark.range(2000).selectExpr("IF(id % 2 = 0, 'e', 'h') AS g", "CAST(id AS string) AS v")
    numbered = number_rows(hot.unionByName(rest), ["g"], ["v"], out="n", start=2, num_partitions=16)
    spread = numbered.where("v = 'same line'").groupBy(F.spark_partition_id().alias("p")).count().collect()
    got = numbered.groupBy("g").agg(F.count("n").alias("c"), F.count_distinct("n").alias("d"), F.min("n").alias("a"), F.max("n").alias("b"))
    assert {tuple(r) for r in got.collect()} == {("f", 1_000_000, 1_000_000, 2, 1_000_001), ("e", 1000, 1000, 2, 1001), ("h", 1000, 1000, 2, 1001)}
    assert len(spread) > 4 and max(r["count"] for r in spread) < 500_000

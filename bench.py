"""Benchmark of the headline queries.

Runs each query on ``$BENCH_SF_DIR`` (default /root/testdata/sf0.1) with
``local[$BENCH_CPUS]`` and prints ONE JSON line::

    {"metric": "total_sec", "value": N, "unit": "sec", "queries": {...}, "sf": ...}

Each query is fully evaluated by a ``noop`` write (no collect to the driver);
the time is the median of ``$BENCH_REPEAT`` warm runs after one warm-up.
``silver_lines_five_actions`` renders the flagship the way the reference's job
does it (four counts and a write, each re-running the plan) for contrast with
``silver_lines`` (one pass, counts from observations).
"""

from __future__ import annotations

import json
import os
import re
import statistics
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from pyspark.sql import functions as F  # noqa: E402

from strata.operators import silver  # noqa: E402
from strata.plans import queries as Q  # noqa: E402
from strata.session import get_spark, scratch_path  # noqa: E402
from strata.sinks import writers  # noqa: E402

HEADLINE = [
    "silver_lines",
    "dedup_lines",
    "dedup_hash_lines",
    "rejection_histogram",
    "rejected_lines",
    "validation_counts",
    "latest_state",
    "state_merge",
    "pending_files",
    "header_check",
    "run_audit",
    "daily_manifest",
]


def noop(df) -> None:
    df.write.format("noop").mode("overwrite").save()


def silver_one_pass(spark, sf):
    counts = silver.RunCounts()
    noop(Q.silver_plan(spark, sf, counts=counts))
    return counts.result()


def silver_five_actions(spark, sf):
    raw = Q.retail_lines(spark, sf)
    valid, _ = Q.valid_and_rejected(spark, sf)
    cast = silver.cast_columns(valid)
    raw.count()
    cast.count()
    silver.dedup_exact(cast.select(*silver.RAW_COLUMNS, F.col("source_file").alias("SourceFile")), "hash").count()
    out = Q.silver_plan(spark, sf)
    out.count()
    noop(out)


def timed(fn, repeat):
    fn()  # warm-up
    runs = []
    for _ in range(repeat):
        t = time.perf_counter()
        fn()
        runs.append(time.perf_counter() - t)
    return round(statistics.median(runs), 3)


def main() -> None:
    sf = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1").rstrip("/")
    cpus = int(os.environ.get("BENCH_CPUS", "8"))
    repeat = int(os.environ.get("BENCH_REPEAT", "3"))
    spark = get_spark(master=f"local[{cpus}]", shuffle_partitions=max(8, cpus * 2), app="strata-bench")
    out = {}
    for name in HEADLINE:
        out[name] = timed(lambda n=name: noop(Q.QUERIES[n](spark, sf)), repeat)
    out["silver_lines_typed_dedup"] = timed(lambda: noop(Q.silver_plan(spark, sf, dedup_mode="typed")), repeat)
    out["silver_lines_one_pass_observed"] = timed(lambda: silver_one_pass(spark, sf), repeat)
    out["silver_lines_five_actions"] = timed(lambda: silver_five_actions(spark, sf), repeat)
    target = scratch_path(spark, "bench-silver")
    out["silver_write_parquet"] = timed(
        lambda: writers.write_silver(Q.silver_plan(spark, sf), target), 1
    )
    m = re.search(r"sf([0-9.]+)", sf)
    total = round(sum(v for k, v in out.items() if k in HEADLINE), 3)
    print(
        json.dumps(
            {
                "metric": "total_sec",
                "value": total,
                "unit": "sec",
                "queries": out,
                "sf": float(m.group(1)) if m else sf,
                "cpus": cpus,
            }
        )
    )


if __name__ == "__main__":
    main()

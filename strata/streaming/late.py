"""Late rows kept: a stream whose rows behind the watermark reach the target, once.

``dropDuplicatesWithinWatermark`` drops what comes later than the watermark. The
batch lookback re-reads a window and would still miss a row that is older. Here
each micro-batch is compared with the target itself, in the dates of its own
rows only: a row that the target has is a duplicate, a row behind the watermark is
written with ``late`` set, every other row is written as it is. No state grows
with the keys; what a micro-batch reads of the target is bounded by the dates
it has rows of (partition pruning).

A micro-batch owns the partitions ``epoch=n`` of the target: if it runs again it
replaces them and is compared with the other epochs only, so it writes the same
rows. The watermark of an epoch comes from the log of the epochs before it.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from strata.plans.attach import attach_row
from strata.session import cut_lineage
from strata.sinks.writers import path_exists
from strata.streaming.stream import run_available_now

LOG_DDL = "epoch bigint, max_event_time timestamp, watermark timestamp, kept bigint, late bigint, duplicates bigint"


def late_log(spark: SparkSession, target: str) -> DataFrame:
    """One row per micro-batch: its watermark, and how many rows it kept, kept late, and left out as duplicates."""
    path = f"{target.rstrip('/')}_log"
    if not path_exists(spark, path):
        return spark.createDataFrame([], LOG_DDL)
    return spark.read.schema(LOG_DDL).option("recursiveFileLookup", "true").parquet(path)


def keep_late(
    stream: DataFrame,
    target: str,
    checkpoint: str,
    keys: Sequence[str],
    ts_col: str,
    delay: str = "1440 minutes",
) -> StreamingQuery:
    """Writes the stream's rows to ``target`` (parquet by event_date and epoch), each key once.

    ``keys`` identify a row together with its event time. Of rows with equal keys
    the first micro-batch's stays, of one micro-batch the least by all columns. Null keys
    match each other; a row without an event time is never late and is kept
    under the null date. ``late``: the event time lies more than ``delay`` behind
    the greatest one of earlier micro-batches.
    """
    spark = stream.sparkSession
    identity = [*keys, ts_col]

    def handle(batch: DataFrame, epoch: int) -> None:
        typed = batch.withColumn(ts_col, F.col(ts_col).cast("timestamp"))
        rows = cut_lineage(typed.withColumn("event_date", F.to_date(ts_col)), "late-rows")
        log = late_log(spark, target).where(F.col("epoch") < epoch)
        seen = log.agg(F.max("max_event_time").alias("m")).select((F.col("m") - F.expr(f"INTERVAL {delay}")).alias("w")).first()["w"]
        rest = [c for c in rows.columns if c not in identity]
        one = rows.groupBy(*identity).agg(F.min(F.struct(*rest)).alias("_row")).select(*identity, *[F.col(f"_row.{c}").alias(c) for c in rest])
        if path_exists(spark, target):
            dates = [r[0] for r in rows.select("event_date").distinct().collect()]
            whole = T.StructType([*rows.schema.fields, T.StructField("late", T.BooleanType()), T.StructField("epoch", T.LongType())])
            held = spark.read.schema(whole).parquet(target)
            in_dates = F.col("event_date").isin([d for d in dates if d is not None])
            held = held.where((in_dates | F.col("event_date").isNull() if None in dates else in_dates) & (F.col("epoch") != epoch))
            there = held.select(*[F.col(c).alias(f"_h{i}") for i, c in enumerate(identity)])
            same = F.lit(True)
            for i, c in enumerate(identity):
                same = same & F.col(c).eqNullSafe(F.col(f"_h{i}"))
            one = one.join(there, same, "left_anti")
        is_late = F.coalesce(F.col(ts_col) < F.lit(seen).cast("timestamp"), F.lit(False))
        out = cut_lineage(one.select(*rows.columns, is_late.alias("late"), F.lit(epoch).cast("bigint").alias("epoch")), "late-kept")
        write = out.hint("rebalance", "event_date").write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
        write.partitionBy("event_date", "epoch").parquet(target)
        counts = out.agg(F.count(F.lit(1)).alias("kept"), F.count_if("late").alias("late"))
        entry = attach_row(rows.agg(F.max(ts_col).alias("max_event_time"), F.count(F.lit(1)).alias("n")), counts)
        entry = entry.select(
            F.lit(epoch).cast("bigint").alias("epoch"), "max_event_time", F.lit(seen).cast("timestamp").alias("watermark"),
            "kept", "late", (F.col("n") - F.col("kept")).alias("duplicates"),
        )
        entry.coalesce(1).write.mode("overwrite").parquet(f"{target.rstrip('/')}_log/epoch_{epoch:09d}")

    return run_available_now(stream, checkpoint, handler=handle)

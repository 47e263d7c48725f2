"""Watermarks per provider in a stream: windows, failures, repeated micro-batches, foreign runs."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from strata.operators import state as st
from strata.streaming.watermarks import ingestion_log, window_stream

SCHEMA = "provider_id string, ts timestamp, v long"
BASE = dt.datetime(2024, 3, 1)


def at(hours):
    return BASE + dt.timedelta(hours=hours)


@pytest.fixture
def feed(spark, workdir):
    class Feed:
        fail_on: set = set()
        n = 0

        def put(self, rows):
            spark.createDataFrame(rows, SCHEMA).coalesce(1).write.parquet(f"{workdir}/in/b{self.n}")
            self.n += 1

        def run(self, checkpoint="ck", **more):
            def handler(inside, behind, epoch):
                for part, df in (("inside", inside), ("behind", behind)):
                    df.write.mode("overwrite").parquet(f"{workdir}/out/{part}/epoch_{epoch}")
                if epoch in self.fail_on:
                    raise ValueError("the sink is gone")

            stream = spark.readStream.schema(SCHEMA).option("recursiveFileLookup", "true").parquet(f"{workdir}/in")
            window_stream(stream, f"{workdir}/state", f"{workdir}/{checkpoint}", handler, ts_col="ts", lookback_minutes=60, **more)

        def rows(self, part):
            got = spark.read.schema(SCHEMA).option("recursiveFileLookup", "true").parquet(f"{workdir}/out/{part}")
            return sorted(r.v for r in got.collect())

        def state(self):
            return {r.provider_id: (r.last_processed_event_time, r.last_run_status, r.last_run_id) for r in ingestion_log(spark, f"{workdir}/state").collect()}

    return Feed()


def test_each_provider_has_its_own_watermark(feed):
    feed.put([("a", at(10), 1), ("a", at(1), 2), ("b", at(2), 3), (None, at(0), 4), ("a", None, 5)])
    feed.run()
    assert feed.rows("inside") == [1, 2, 3, 4] and feed.rows("behind") == [5]
    assert {k: v[0] for k, v in feed.state().items()} == {"a": at(10), "b": at(2), "": at(0)}
    # An hour behind its provider's watermark is in, more is behind; "b" is not held to "a"'s.
    feed.put([("a", at(9), 6), ("a", at(8.9), 7), ("b", at(1), 8), ("b", at(5), 9), ("c", at(-100), 10)])
    feed.run()
    assert feed.rows("inside") == [1, 2, 3, 4, 6, 8, 9, 10] and feed.rows("behind") == [5, 7]
    # Older rows alone don't move a watermark back; providers without rows keep theirs.
    assert feed.state() == {
        "a": (at(10), "SUCCESS", "stream-1"), "b": (at(5), "SUCCESS", "stream-1"), "c": (at(-100), "SUCCESS", "stream-1"), "": (at(0), "SUCCESS", "stream-0"),
    }


def test_a_failed_micro_batch_leaves_the_watermark(feed):
    feed.put([("a", at(10), 1), ("b", at(3), 2)])
    feed.run()
    feed.put([("a", at(20), 3), ("a", at(9.5), 4), ("d", at(1), 5)])
    feed.fail_on = {1}
    for _ in range(2):  # the restart fails as well
        with pytest.raises(Exception, match="the sink is gone"):
            feed.run()
        state = feed.state()
        assert state["a"] == (at(10), "FAILED", "stream-1") and state["d"] == (st.EPOCH, "FAILED", "stream-1")
        assert state["b"] == (at(3), "SUCCESS", "stream-0")
    feed.fail_on = set()
    feed.run()
    assert feed.state()["a"] == (at(20), "SUCCESS", "stream-1") and feed.rows("inside") == [1, 2, 3, 4, 5]


def test_a_repeated_micro_batch_has_the_same_windows(feed):
    """Done, but not committed by Spark: another checkpoint runs epoch 0 again, after its watermarks moved."""
    feed.put([("a", at(10), 1), ("a", at(0), 2)])
    feed.run()
    before = feed.state()
    feed.run(checkpoint="other")
    assert feed.rows("inside") == [1, 2] and feed.rows("behind") == [] and feed.state() == before


def test_states_of_the_batch_job_are_continued(feed, spark):
    seeded = st.seed_state(spark.createDataFrame([("a",), ("b",)], "provider_id string"))
    held = seeded.withColumn("last_run_status", F.lit("RUNNING")).withColumn("last_run_id", F.lit("batch-7"))
    done = seeded.withColumn("last_run_status", F.lit("SUCCESS")).withColumn("last_processed_event_time", F.lit(at(50)))
    feed.put([("a", at(49.5), 1), ("a", at(20), 2)])
    with pytest.raises(Exception, match="batch-7"):
        feed.run(initial=held)
    assert feed.state() == {}
    feed.run(initial=done.withColumn("lookback_minutes", F.lit(60).cast("bigint")))
    assert feed.rows("inside") == [1] and feed.rows("behind") == [2] and feed.state()["a"][0] == at(50)

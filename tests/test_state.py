"""State life cycle, idempotency, failure/retry (the reference's three scripts,
with assertions), ingestion-run transitions and processing windows."""

import datetime as dt

from pyspark.sql import functions as F

from strata.operators import incremental as inc
from strata.operators import state as st
from strata.schemas import FILE_STATE_SCHEMA, INGESTION_STATE_SCHEMA

T0 = dt.datetime(2026, 1, 1, 10, 0, 0)
T1 = dt.datetime(2026, 1, 1, 10, 5, 0)
T2 = dt.datetime(2026, 1, 1, 10, 9, 0)
KEY = ("provider_retail", "raw/provider_retail/state_test.csv", "test_checksum_12345")


def _change(spark, status, run_id, **kw):
    row = dict(zip(st.FILE_STATE_KEYS, KEY))
    row.update(status=status, run_id=run_id, **kw)
    cols = list(row)
    return spark.createDataFrame([tuple(row[c] for c in cols)], cols)


def test_life_cycle(spark):
    log = st.empty_file_state(spark)
    start = spark.createDataFrame(
        [(*KEY[:2], "state_test.csv", dt.date(2010, 12, 3), KEY[2], "PROCESSING", "run-1")],
        "provider_id string, source_uri string, source_file string, source_date date, source_checksum string, status string, run_id string",
    )
    s1 = st.merge_state(st.latest(log), start, now=T0)
    log = log.unionByName(s1)
    cur = st.latest(log).collect()[0]
    assert (cur.status, cur.first_processed_at, cur.record_count) == ("PROCESSING", T0, None)
    upd = _change(spark, "SUCCESS", "run-1", record_count=100, valid_record_count=98, rejected_record_count=2)
    st.assert_single_match(st.latest(log), upd)
    log = log.unionByName(st.update_state(st.latest(log), upd, now=T1, changes_only=True))
    cur = st.latest(log).collect()[0]
    assert (cur.status, cur.record_count, cur.valid_record_count, cur.rejected_record_count) == ("SUCCESS", 100, 98, 2)
    assert cur.first_processed_at == T0 and cur.updated_at == T1
    # idempotency: same key with SUCCESS -> SKIP
    files = spark.createDataFrame([KEY], "provider_id string, source_uri string, source_checksum string")
    assert st.pending(files, log).collect()[0].action == "SKIP"
    # new bytes under the same uri are a new key -> PROCESS
    files2 = spark.createDataFrame([(KEY[0], KEY[1], "other")], "provider_id string, source_uri string, source_checksum string")
    assert [(r.action, r.reason) for r in st.pending(files2, log).collect()] == [("PROCESS", "NEW")]


def test_failure_then_retry(spark):
    log = spark.createDataFrame(
        [(*KEY[:2], "f.csv", dt.date(2010, 12, 2), KEY[2], "PROCESSING", "r", T0, T0, None, None, None, None, T0, T0)],
        FILE_STATE_SCHEMA,
    )
    fail = _change(spark, "FAILED", "r", error_message="x" * 5000)
    log = log.unionByName(st.update_state(st.latest(log), fail, now=T1, changes_only=True))
    cur = st.latest(log).collect()[0]
    assert cur.status == "FAILED" and len(cur.error_message) == 1000 and cur.record_count is None
    files = spark.createDataFrame([KEY], "provider_id string, source_uri string, source_checksum string")
    assert st.pending(files, log).collect()[0].action == "PROCESS"
    # merge on a matched key keeps counts/error and first_processed_at
    again = spark.createDataFrame(
        [(*KEY[:2], "f.csv", dt.date(2010, 12, 2), KEY[2], "PROCESSING", "r2")],
        "provider_id string, source_uri string, source_file string, source_date date, source_checksum string, status string, run_id string",
    )
    m = st.merge_state(st.latest(log), again, now=T2).collect()[0]
    assert (m.status, m.run_id, m.first_processed_at, m.last_processed_at) == ("PROCESSING", "r2", T0, T2)
    assert len(m.error_message) == 1000


def test_unmatched_update_is_reported(spark):
    target = st.empty_file_state(spark)
    upd = _change(spark, "SUCCESS", "r")
    assert st.affected_rows(target, upd).collect()[0].affected_rows == 0
    try:
        st.assert_single_match(target, upd)
        raise AssertionError("expected an error")
    except RuntimeError:
        pass


def test_status_machine(spark):
    cur = spark.createDataFrame([("a", "PROCESSING"), ("b", "FILE_VALIDATION_FAILED"), ("c", None)], "k string, status string")
    ev = spark.createDataFrame([("a", "validated"), ("b", "error"), ("c", "start")], "k string, event string")
    got = {r.k: r.status for r in st.apply_events(cur, ev, keys=["k"]).collect()}
    assert got == {"a": "SUCCESS", "b": "FILE_VALIDATION_FAILED", "c": "PROCESSING"}


def test_run_lock_and_watermark(spark):
    state = st.seed_state(spark.createDataFrame([("p",)], "provider_id string"), now=T0)
    assert state.collect()[0].last_run_status == "NEVER_RUN"
    req = spark.createDataFrame([("p", "SILVER", "run-1")], "provider_id string, layer string, run_id string")
    s1 = st.start_runs(state, req, now=T1)
    r = s1.collect()[0]
    assert (r.last_run_status, r.last_run_id, r.lock_acquired) == ("RUNNING", "run-1", True)
    req2 = spark.createDataFrame([("p", "SILVER", "run-2")], "provider_id string, layer string, run_id string")
    assert st.start_runs(s1.drop("lock_acquired"), req2, now=T1).collect()[0].lock_acquired is False
    done = spark.createDataFrame(
        [("p", "SILVER", "run-1", True, dt.datetime(2010, 12, 9))],
        "provider_id string, layer string, run_id string, succeeded boolean, max_event_time timestamp",
    )
    s2 = st.complete_runs(s1.drop("lock_acquired"), done, now=T2).collect()[0]
    assert (s2.last_run_status, s2.last_processed_event_time) == ("SUCCESS", dt.datetime(2010, 12, 9))
    # a success with an older max never moves the watermark back
    back = spark.createDataFrame(
        [("p", "SILVER", "run-1", True, dt.datetime(2010, 12, 1))],
        "provider_id string, layer string, run_id string, succeeded boolean, max_event_time timestamp",
    )
    s3 = st.complete_runs(spark.createDataFrame([tuple(s2)], INGESTION_STATE_SCHEMA), back, now=T2).collect()[0]
    assert s3.last_processed_event_time == dt.datetime(2010, 12, 9)


def test_processing_windows(spark):
    """FIXTURES.md §5."""
    d = lambda n, h=0: dt.datetime(2010, 12, n, h)
    rows = [
        ("a", "NEVER_RUN", dt.datetime(1970, 1, 1), 1440, d(1), d(9), d(1), d(9)),
        ("b", "SUCCESS", None, 1440, d(1), d(9), d(1), d(9)),
        ("c", "SUCCESS", d(5), 1440, d(1), d(9), d(4), d(9)),
        ("d", "FAILED", d(5), 1440, d(1), d(9), d(4), d(9)),
        ("e", "SUCCESS", d(9), 0, d(1), d(8), d(9), d(8)),
    ]
    state = spark.createDataFrame(
        [(r[0], r[1], r[2], r[3]) for r in rows],
        "provider_id string, last_run_status string, last_processed_event_time timestamp, lookback_minutes bigint",
    )
    bounds = spark.createDataFrame(
        [(r[0], r[4], r[5]) for r in rows],
        "provider_id string, min_available_event_time timestamp, max_available_event_time timestamp",
    )
    got = {r.provider_id: (r.lower_bound, r.upper_bound) for r in inc.processing_window(state, bounds, by=["provider_id"]).collect()}
    assert got == {r[0]: (r[6], r[7]) for r in rows}
    # empty window selects nothing
    lines = spark.createDataFrame([("e", d(8, 12))], "provider_id string, InvoiceDate timestamp")
    win = inc.processing_window(state, bounds, by=["provider_id"])
    assert inc.apply_window(lines, win, by=["provider_id"]).count() == 0


def test_batch_limit_and_sequence(spark):
    files = spark.createDataFrame(
        [(f"u{i}", f"retail_sales_201012{i:02d}.csv", dt.date(2010, 12, i)) for i in range(9, 0, -1)],
        "source_uri string, source_file string, source_date date",
    )
    top = [r.source_file for r in inc.take_batch(files, 3).collect()]
    assert top == ["retail_sales_20101201.csv", "retail_sales_20101202.csv", "retail_sales_20101203.csv"]
    seq = {r.source_file: r.sequence for r in inc.sequence_files(files).collect()}
    assert seq["retail_sales_20101201.csv"] == 1 and seq["retail_sales_20101209.csv"] == 9
    fl = inc.first_last(files).collect()[0]
    assert (fl.file_count, fl.first_file, fl.last_file) == (9, "retail_sales_20101201.csv", "retail_sales_20101209.csv")
    assert F is not None


def test_compact_state(spark, workdir):
    import os

    from strata.plans.ingest import compact_state

    path = os.path.join(workdir, "state")
    rows = [
        (*KEY[:2], "f.csv", dt.date(2010, 12, 2), KEY[2], s, "r", T0, t, None, None, None, None, T0, t)
        for s, t in [("PROCESSING", T0), ("SUCCESS", T1)]
    ]
    spark.createDataFrame(rows, FILE_STATE_SCHEMA).write.parquet(path)
    assert compact_state(spark, path) == 1
    assert spark.read.parquet(path).collect()[0].status == "SUCCESS"


def test_stale_runs(spark):
    state = spark.createDataFrame(
        [("p", "SILVER", None, None, 1440, "RUNNING", "r1", T0, T0), ("q", "SILVER", None, None, 1440, "RUNNING", "r2", T2, T2),
         ("s", "SILVER", None, None, 1440, "SUCCESS", "r3", T0, T0)],
        INGESTION_STATE_SCHEMA,
    )
    assert [r.provider_id for r in st.stale_runs(state, T1).collect()] == ["p"]


def test_idempotency_literal_case(spark):
    """SUCCESS with 3108 / 3107 / 1 for (provider, uri, checksum) -> SKIP; a merge of
    incoming changes leaves exactly one row per key."""
    key = ("provider_retail", "raw/provider_retail/2010/12/01/retail_sales_20101201.csv", "a" * 64)
    log = spark.createDataFrame(
        [(key[0], key[1], "retail_sales_20101201.csv", dt.date(2010, 12, 1), key[2], "SUCCESS", "r", T0, T0, 3108, 3107, 1, None, T0, T0)],
        FILE_STATE_SCHEMA,
    )
    files = spark.createDataFrame([key], "provider_id string, source_uri string, source_checksum string")
    r = st.pending(files, log).collect()[0]
    assert (r.action, r.reason) == ("SKIP", "SUCCESS")
    changes = spark.createDataFrame(
        [(key[0], key[1], "retail_sales_20101201.csv", dt.date(2010, 12, 1), key[2], "PROCESSING", "r2"),
         (key[0], key[1] + "x", "x.csv", dt.date(2010, 12, 1), key[2], "PROCESSING", "r2")],
        "provider_id string, source_uri string, source_file string, source_date date, source_checksum string, status string, run_id string",
    )
    merged = st.merge_state(st.latest(log), changes, now=T1)
    assert merged.count() == merged.select(*st.FILE_STATE_KEYS).distinct().count() == 2
    kept = [m for m in merged.collect() if m.source_uri == key[1]][0]
    assert (kept.record_count, kept.valid_record_count, kept.rejected_record_count) == (3108, 3107, 1)

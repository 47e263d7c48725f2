"""Late rows reach the target once; counts equal a batch twin."""

import datetime as dt

from strata.streaming.late import keep_late, late_log

SCHEMA = "k long, ts timestamp, v string"
BASE = dt.datetime(2024, 1, 10)


def at(day, hour=0):
    return BASE + dt.timedelta(days=day, hours=hour)


def test_late_rows_are_kept_once(spark, workdir):
    batches = [
        [(1, at(5), "a"), (2, at(5, 1), "b"), (2, at(5, 1), "a"), (None, at(5), "n"), (9, None, "no time")],
        [(3, at(9), "c"), (1, at(5), "again"), (None, at(5), "n2")],
        [(4, at(0), "late"), (5, at(8, 1), "just in time"), (6, at(7, 23), "late"), (4, at(0), "late2"), (9, None, "no time")],
        [(4, at(0), "late again"), (7, at(1), "late")],
    ]

    def run():
        stream = spark.readStream.schema(SCHEMA).option("recursiveFileLookup", "true").parquet(f"{workdir}/in")
        return keep_late(stream, f"{workdir}/out", f"{workdir}/ck", ["k"], "ts", "1 day")

    for i, rows in enumerate(batches):
        spark.createDataFrame(rows, SCHEMA).coalesce(1).write.parquet(f"{workdir}/in/b{i}")
        run()
    got = {(r.k, r.ts, r.v, r.late) for r in spark.read.parquet(f"{workdir}/out").collect()}
    # The twin: first batch wins, the watermark is a day behind the greatest time of the batches before.
    want, known, seen, log = set(), set(), None, []
    for rows in batches:
        mark = seen and seen - dt.timedelta(days=1)
        fresh = {}
        for k, t, v in sorted(rows, key=lambda r: r[2]):
            if (k, t) not in known:
                fresh.setdefault((k, t), (v, bool(mark and t and t < mark)))
        want |= {(k, t, v, late) for (k, t), (v, late) in fresh.items()}
        known |= set(fresh)
        log.append((mark, len(fresh), sum(late for _, late in fresh.values()), len(rows) - len(fresh)))
        seen = max([t for _, t, _ in rows if t] + ([seen] if seen else []))
    assert got == want and sum(r[3] for r in got) == 3
    entries = late_log(spark, f"{workdir}/out").orderBy("epoch").collect()
    assert [(r.watermark, r.kept, r.late, r.duplicates) for r in entries] == log


def test_a_repeated_micro_batch_changes_nothing(spark, workdir):
    """A lost checkpoint delivers everything again as other epochs: the target keeps each row once."""
    spark.createDataFrame([(1, at(5), "a"), (2, at(5), "b")], SCHEMA).write.parquet(f"{workdir}/in/b0")
    stream = lambda: spark.readStream.schema(SCHEMA).option("recursiveFileLookup", "true").parquet(f"{workdir}/in")
    keep_late(stream(), f"{workdir}/out", f"{workdir}/ck1", ["k"], "ts")
    before = sorted(map(tuple, spark.read.parquet(f"{workdir}/out").select("k", "ts", "v", "late").collect()))
    keep_late(stream(), f"{workdir}/out", f"{workdir}/ck2", ["k"], "ts")  # epoch 0 again
    assert sorted(map(tuple, spark.read.parquet(f"{workdir}/out").select("k", "ts", "v", "late").collect())) == before

"""The stream takes a re-delivered path again; its content equals the batch job's."""

import datetime as dt
import os

from fixtures import HEADER, fixture_text, line, write_file
from strata.plans.ingest import ingest_batch
from strata.sources.file_feed import FileFeedReader, VersionLog, list_folder
from strata.streaming.stream import ingest_stream


def touch(path, seconds):
    os.utime(path, (seconds, seconds))


def test_versions_list_new_and_changed_files(workdir):
    raw, log = f"{workdir}/raw", f"{workdir}/log"
    for i in range(4):
        touch(write_file(raw, f"retail_sales_2010120{i + 1}.csv", "x"), 1000 + i)
    write_file(raw, "_hidden.csv", "x")
    write_file(raw, "notes.txt", "x")
    options = {"path": raw, "log": log, "maxfiles": "3"}
    reader = FileFeedReader(options)
    assert reader.latestOffset() == {"version": 1} and reader.latestOffset() == {"version": 2} and reader.latestOffset() == {"version": 2}
    got = [t[0].rsplit("/", 1)[-1] for p in reader.partitions({"version": 0}, {"version": 2}) for t in reader.read(p)]
    assert got == [f"retail_sales_2010120{i + 1}.csv" for i in range(4)]
    assert all(u.startswith("file:/") for u in list_folder(raw))
    # A restart knows them; another length or time is a change, the same bytes and time are none.
    again = FileFeedReader(options)
    assert again.latestOffset() == {"version": 2}
    touch(f"{raw}/retail_sales_20101202.csv", 5000)
    write_file(raw, "retail_sales_20101203.csv", "xy")
    touch(f"{raw}/retail_sales_20101203.csv", 1002)
    assert again.latestOffset() == {"version": 3}
    assert [(t[0].rsplit("/", 1)[-1], t[1], t[2].timestamp()) for t in again.read(again.partitions({"version": 2}, {"version": 3})[0])] == [
        ("retail_sales_20101202.csv", 1, 5000.0), ("retail_sales_20101203.csv", 2, 1002.0)
    ]
    # Beyond a snapshot nothing is forgotten.
    for k in range(12):
        touch(f"{raw}/retail_sales_20101201.csv", 6000 + k)
        assert again.latestOffset() == {"version": 4 + k}
    assert FileFeedReader(options).latestOffset() == {"version": 15} and len(VersionLog(log).state()[1]) == 4


def bronze(spark, path):
    df = spark.read.option("header", "true").option("escape", '"').option("multiLine", "true").csv(path)
    return sorted(tuple(str(x) for x in r) for r in df.collect())


def test_stream_takes_a_redelivered_file_and_equals_the_batch(spark, workdir):
    raw = f"{workdir}/raw"
    s = {k: f"{workdir}/s/{k}" for k in ("bronze", "quarantine", "ck", "state")}
    b = {k: f"{workdir}/b/{k}" for k in ("bronze", "quarantine", "state")}

    def both(n):
        ingest_stream(spark, raw, s["bronze"], s["quarantine"], s["ck"], max_files_per_trigger=2, state_path=s["state"])
        ingest_batch(spark, raw, b["bronze"], b["quarantine"], b["state"], run_id=f"b{n}", now=dt.datetime(2024, 1, 1 + n))
        assert bronze(spark, s["bronze"]) == bronze(spark, b["bronze"])
        assert bronze(spark, s["quarantine"] + "/rows") == bronze(spark, b["quarantine"] + "/rows")

    for d in (1, 2, 3):
        write_file(raw, f"retail_sales_2010120{d}.csv", fixture_text())
    both(0)
    assert len(bronze(spark, s["bronze"])) == 21
    write_file(raw, "retail_sales_20101202.csv", HEADER + "\n" + line(inv="7", desc='"new\nline"') + "\n" + line(inv="") + "\n")
    write_file(raw, "retail_sales_20101204.csv", "")
    both(1)
    assert len(bronze(spark, s["bronze"])) == 15
    both(2)  # nothing new: nothing changes
    s["ck"] = f"{workdir}/s/ck2"  # a lost checkpoint: the files come again, the state keeps them from being processed twice
    both(3)

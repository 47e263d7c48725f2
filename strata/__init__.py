"""strata: layered (raw -> bronze -> silver) ingestion operators on Spark DataFrames.

Every public operator takes DataFrames (plus plain parameters) and returns a
lazy DataFrame built from Spark's own expressions; only the sinks and the
jobs in ``strata.plans.ingest`` / ``strata.streaming.stream`` trigger actions.
"""

from strata.session import get_spark, scratch_path


def __getattr__(name):
    # The jobs import pyspark machinery; load them on first use.
    jobs = {
        "ingest_batch": "strata.plans.ingest",
        "ingest_feeds": "strata.plans.ingest",
        "bronze_to_silver": "strata.plans.ingest",
        "prepare_source": "strata.plans.ingest",
        "verify_source": "strata.plans.ingest",
        "compact_state": "strata.plans.ingest",
        "ingest_stream": "strata.streaming.stream",
    }
    if name in jobs:
        import importlib

        return getattr(importlib.import_module(jobs[name]), name)
    raise AttributeError(name)


__all__ = [
    "bronze_to_silver",
    "compact_state",
    "get_spark",
    "ingest_batch",
    "ingest_feeds",
    "ingest_stream",
    "prepare_source",
    "scratch_path",
    "verify_source",
]

"""Keyed writes as table transformations."""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from hopdex.operators.joins import drop_known, newest


def upsert(base: DataFrame, delta: DataFrame, key: list[str], by: list[str]) -> DataFrame:
    """`base` with the keys of `delta` replaced; the last write by `by` wins.

    A small delta leaves the base unshuffled: only its keys are broadcast.
    """
    last = newest(delta, key, by)
    kept = drop_known(base, last, key)
    return kept.unionByName(last.select(*base.columns))


def mark_interrupted(jobs: DataFrame) -> DataFrame:
    """Jobs that were still open when the process ended."""
    open_job = F.col("status").isin("created", "running")
    return jobs.withColumn("status", F.when(open_job, "interrupted").otherwise(F.col("status")))

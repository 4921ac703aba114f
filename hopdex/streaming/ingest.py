"""Incremental indexing with Structured Streaming."""

import json

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from hopdex.functions.urls import normalize_url
from hopdex.operators.crawl import accepted, check_seeds, crawl
from hopdex.operators.extract import parse_responses
from hopdex.operators.index import build_postings, build_word_entries, changed_entries
from hopdex.operators.joins import drop_known, match_join, newest, only_keys
from hopdex.operators.status import page_counters, pressure_sessions
from hopdex.operators.upsert import mark_interrupted
from hopdex.schemas import RESPONSES
from hopdex.session import stage
from hopdex.sources.store import IndexStore
from hopdex.sources.tables import with_origin


def read_response_stream(
    spark: SparkSession, path: str, max_files: int = 1000, max_bytes: str | None = None
) -> DataFrame:
    """Response files as they arrive; a batch takes in `max_files`, or `max_bytes` if given."""
    limit = ("maxBytesPerTrigger", max_bytes) if max_bytes else ("maxFilesPerTrigger", max_files)
    return spark.readStream.schema(RESPONSES).option(*limit).parquet(path)


def one_per_url(offered: DataFrame) -> DataFrame:
    """One response per canonical URL. Only the rows of repeated URLs are shuffled.

    A good answer is taken before a failure; the rest of the choice is by the whole
    content, headers included, so a replay picks the same. URLs that have no
    canonical form are dropped.
    """
    columns = offered.columns
    # Written with these URLs: they are asked for three times, and a batch is read but once.
    offered = stage(offered.withColumn("url", normalize_url(F.col("url"))), "offered").filter("url IS NOT NULL")
    repeated = offered.groupBy("url").agg(F.count("*").alias("_n")).filter("_n > 1").select("url")
    repeated = stage(repeated, "repeated")
    single = drop_known(offered, repeated, ["url"])
    numbered = offered.withColumn("_row", F.monotonically_increasing_id())
    copies = match_join(numbered, repeated, ["url"], ["_row"]).select(*columns)
    good = F.col("error").isNull() & F.coalesce(F.col("status").between(200, 299), F.lit(False))
    headers = F.to_json(F.sort_array(F.map_entries("headers")))
    chosen = newest(copies, ["url"], [good, F.col("status"), F.col("error"), F.col("body"), headers])
    return single.unionByName(chosen)


def index_responses(store: IndexStore, offered: DataFrame, batch: str | None = None) -> None:
    """Add responses: pages, postings and word entries.

    A URL that has a page already is dropped before it is parsed. A batch of a stream
    has a name: run again, it replaces what it has left, or is left out if it came to
    its end, which is when its pages are there. Nothing else may write in between.
    """
    if batch and store.holds("pages", batch):
        return
    offered = stage(one_per_url(offered), "offered")
    fresh = stage(parse_responses(drop_known(offered, store.read("pages"), ["url"])), "fresh")
    # Only what the batch touches is read from the other tables. Its URLs are
    # new, so the store cannot hold entries of theirs.
    known = only_keys(store.read("discoveries"), fresh, ["url"])
    entries = build_word_entries(fresh, with_origin(known, store.read("jobs")))
    store.insert("postings", build_postings(fresh), batch)
    store.insert("word_entries", entries, batch)
    store.insert("pages", fresh, batch)


def record_discoveries(store: IndexStore, jobs: DataFrame, found: DataFrame) -> None:
    """Add jobs and their discoveries; pages fetched before count for them at once.

    Word entries come first, so that after a failure the same call completes the rest.
    """
    jobs, found = stage(jobs, "jobs"), stage(found, "found")
    fresh = stage(with_origin(found, jobs), "fresh")
    entries = build_word_entries(only_keys(store.read("pages"), fresh, ["url"]), fresh)
    stored = only_keys(store.read("word_entries"), fresh, ["url"])
    # A page is fetched once, so an entry is there as it is or not at all.
    store.insert("word_entries", changed_entries(entries, stored))
    store.upsert("discoveries", found)
    store.upsert("jobs", jobs)


def stream_name(spark: SparkSession, checkpoint: str) -> str:
    """The id that Spark keeps with a checkpoint; a new checkpoint is a new stream."""
    text = spark.read.text(f"{checkpoint}/metadata", wholetext=True).first().value
    return json.loads(text)["id"]


def index_stream(responses: DataFrame, store: IndexStore, checkpoint: str) -> StreamingQuery:
    """Index everything that is available now and stop.

    A batch that is run again after a failure, or after a restart from the same
    checkpoint, is known by its stream and number and changes nothing.
    """
    def run(batch: DataFrame, batch_number: int) -> None:
        index_responses(store, batch, f"{stream_name(store.spark, checkpoint)}-{batch_number}")

    return (
        responses.writeStream.foreachBatch(run)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )


def counter_stream(events: DataFrame, sink, checkpoint: str) -> StreamingQuery:
    """Per-job event counts, kept as running state; `sink(batch, id)` gets changed jobs."""
    counts = events.groupBy("job_id", "message").agg(F.count("*").alias("events"))
    return (
        counts.writeStream.outputMode("update")
        .foreachBatch(sink)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )


def session_stream(
    events: DataFrame, message: str, path: str, checkpoint: str, late: str = "10 seconds"
) -> StreamingQuery:
    """Back-pressure times as Parquet below `path`, each written once, when it has ended.

    Events may come up to `late` after others that are newer. State holds the open
    times only, whatever the length of the stream. Two seconds without an event end a
    time even if the job never logs again: other jobs' events move the clock.
    """
    merged = pressure_sessions(events.withWatermark("logged_at", late), message)
    return (
        merged.writeStream.outputMode("append").format("parquet")
        .option("path", path).option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )


def recover(store: IndexStore) -> None:
    """After a stop: the tables are as written; jobs left open become interrupted."""
    jobs = store.read("jobs").filter(F.col("status").isin("created", "running"))
    store.upsert("jobs", mark_interrupted(jobs))


def run_jobs(store: IndexStore, seeds: DataFrame) -> DataFrame:
    """Run crawl jobs over the pages in the store, to their end.

    The checked seeds become running jobs; their discoveries and word entries go
    into the store; then the jobs are completed and keep their counters. Returns the
    refused seeds with their reasons.
    """
    checked = stage(check_seeds(seeds), "seeds")
    accepted_seeds = stage(accepted(checked), "accepted")
    now = F.current_timestamp()
    zero = F.lit(0).cast("bigint")
    jobs = accepted_seeds.select(
        "job_id", "origin_url", "max_depth", "rate_limit", "queue_capacity", "worker_count",
        F.lit("running").alias("status"), now.alias("created_at"), now.alias("updated_at"),
        *[zero.alias(c) for c in ("pages_discovered", "pages_indexed", "queue_backpressure_count",
                                  "rate_backpressure_count")],
    )
    jobs = stage(jobs, "jobs")
    pages = store.read("pages")
    found = stage(crawl(accepted_seeds, pages), "found")
    record_discoveries(store, jobs, found.select("job_id", "url", "depth"))
    counters = page_counters(found, pages).select("job_id", "pages_discovered", "pages_indexed")
    ended = jobs.drop("pages_discovered", "pages_indexed").join(counters, "job_id", "left").withColumns({
        "status": F.lit("completed"), "updated_at": F.current_timestamp(),
        "pages_discovered": F.coalesce("pages_discovered", zero),
        "pages_indexed": F.coalesce("pages_indexed", zero),
    })
    store.upsert("jobs", ended)
    return checked.filter("reject_reason IS NOT NULL")

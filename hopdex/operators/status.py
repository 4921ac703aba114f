"""Job and corpus status: roll-ups, recent events, lifecycle."""

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from hopdex.operators.extract import is_success
from hopdex.operators.joins import match_join
from hopdex.operators.ranking import rank_within
from hopdex.session import stage

# Length of a job's log view, age at which a back-pressure event
# stops counting as active, and the states that are final.
LOG_VIEW_ROWS = 100
RECENT_SECONDS = 2
# Largest rank limit that Spark applies before a shuffle.
WINDOW_ROWS = 1000
FINAL_STATES = ["completed", "failed", "interrupted"]


def page_totals(pages: DataFrame) -> DataFrame:
    """One row: pages_indexed, pages_failed, visited_urls."""
    good = F.coalesce(is_success(), F.lit(False))  # a page without a status is not a good one
    return pages.agg(
        F.count_if(good).alias("pages_indexed"),
        F.count_if(~good).alias("pages_failed"),
        F.count("*").alias("visited_urls"),
    )


def job_totals(live: DataFrame) -> DataFrame:
    """One row over live jobs: indexing_active, backpressure_active, queue_depth."""
    running = F.col("status") == "running"
    pressed = F.col("queue_backpressure_active") | F.col("rate_backpressure_active")
    return live.agg(
        F.coalesce(F.bool_or(running), F.lit(False)).alias("indexing_active"),
        F.coalesce(F.bool_or(running & pressed), F.lit(False)).alias("backpressure_active"),
        F.coalesce(F.sum(F.when(running, F.col("queue_depth"))), F.lit(0))
        .cast("bigint").alias("queue_depth"),
    )


def global_status(live: DataFrame, pages: DataFrame) -> DataFrame:
    """The one-row corpus status. Both inputs of the join have exactly one row."""
    left = job_totals(live).withColumn("_one", F.lit(1))
    right = page_totals(pages).withColumn("_one", F.lit(1))
    return left.join(F.broadcast(right), "_one").drop("_one")


def with_history_defaults(history: DataFrame) -> DataFrame:
    """Columns that only a live job fills (fixed values): 0 or false for stored ones."""
    zero, no = F.lit(0), F.lit(False)
    return history.withColumns(
        {
            "queue_depth": zero,
            "active_workers": zero,
            "pending_shared_pages": zero,
            "queue_backpressure_active": no,
            "rate_backpressure_active": no,
        }
    )


def live_and_history(live: DataFrame, history: DataFrame) -> DataFrame:
    """Live jobs plus the stored ones that are not live."""
    stored = history.join(live.select("job_id"), "job_id", "left_anti")
    return live.unionByName(with_history_defaults(stored).select(*live.columns))


def job_lookup(jobs: DataFrame, job_id: str) -> DataFrame:
    """The row of one job in `live_and_history`, or none."""
    return jobs.filter(F.col("job_id") == job_id)


def newest_first(jobs: DataFrame) -> DataFrame:
    return jobs.orderBy(F.desc("created_at"), "job_id")


def with_newest_position(jobs: DataFrame) -> DataFrame:
    """Adds each job's place in the newest-first list."""
    return rank_within(jobs, [], [F.desc("created_at"), F.col("job_id")], "position")


def page_counters(discoveries: DataFrame, pages: DataFrame) -> DataFrame:
    """Per job: discovered URLs, ready pages (failures included), URLs still waiting.

    Asked URLs are reduced to one row each before they meet the page table.
    """
    states = pages.select("url", F.lit(True).alias("_ready"))
    known = stage(discoveries.select("url").distinct().join(states, "url"), "ready")
    joined = match_join(discoveries, known, ["url"], ["job_id"], how="left")
    return joined.groupBy("job_id").agg(
        F.count("*").alias("pages_discovered"),
        F.count("_ready").alias("pages_indexed"),
        F.count_if(F.col("_ready").isNull()).alias("pages_waiting"),
    )


def event_counters(events: DataFrame, kinds: dict[str, str]) -> DataFrame:
    """Per job, one count per kind: `kinds` maps output column to message class."""
    return events.groupBy("job_id").agg(
        *[F.count_if(F.col("message") == kind).alias(name) for name, kind in kinds.items()]
    )


def backpressure_recent(events: DataFrame, message: str, asof: Column | None = None) -> DataFrame:
    """Per job with such events: the last one and whether it is under two seconds old.

    Without `asof`, a job's own last event of any class is its present.
    """
    last = F.max(F.when(F.col("message") == message, F.col("logged_at")))
    now = F.max("logged_at") if asof is None else F.max(asof)
    per_job = events.groupBy("job_id").agg(last.alias("last_at"), now.alias("_now"))
    fresh = F.col("last_at") > F.col("_now") - F.expr(f"INTERVAL {RECENT_SECONDS} SECONDS")
    return per_job.filter("last_at IS NOT NULL").select("job_id", "last_at", fresh.alias("active"))


def pressure_sessions(events: DataFrame, message: str) -> DataFrame:
    """The times in which jobs are under back-pressure, from tables and streams alike.

    One row (job_id, active_from, active_until, n_events) for events of the class with
    under two seconds between them: a job is active from the first one until two
    seconds after the last. Events are merged in each task before they are shuffled. A
    stream has to have a watermark on `logged_at`; it gives a row when that has come to
    the row's end, moved on by events of any class and job.
    """
    gap = F.session_window("logged_at", f"{RECENT_SECONDS} seconds")
    # A condition on the time itself stays behind the watermark, which then sees all events.
    pressed = F.when(F.col("message") == message, F.col("logged_at")).isNotNull()
    merged = events.filter(pressed).groupBy("job_id", gap.alias("session")).agg(
        F.count("*").alias("n_events"))
    return merged.select(
        "job_id", F.col("session.start").alias("active_from"), F.col("session.end").alias("active_until"), "n_events")


def recent_logs(logs: DataFrame, rows: int = LOG_VIEW_ROWS) -> DataFrame:
    """The last `rows` entries of every job with their place, oldest first.

    Up to WINDOW_ROWS the rank limit is also applied before the shuffle, so a task
    sends at most `rows` entries per job on, however long the log of a job is. Longer
    views are ranked by ranges, which puts no whole log into one task either.
    """
    if rows > WINDOW_ROWS:
        ranked = rank_within(logs, ["job_id"], [F.desc("id")], "_back").filter(F.col("_back") <= rows)
        return rank_within(ranked.drop("_back"), ["job_id"], [F.col("id")], "line").withColumn(
            "line", F.col("line").cast("int"))
    last_first = Window.partitionBy("job_id").orderBy(F.desc("id"))
    kept = logs.withColumn("_back", F.row_number().over(last_first)).filter(F.col("_back") <= rows)
    oldest_first = Window.partitionBy("job_id").orderBy("id")
    return kept.withColumn("line", F.row_number().over(oldest_first)).drop("_back")


def job_logs(logs: DataFrame, job_id: str, rows: int = LOG_VIEW_ROWS) -> DataFrame:
    """The log view of one job, oldest first."""
    last = logs.filter(F.col("job_id") == job_id).orderBy(F.desc("id")).limit(rows)
    return last.orderBy("id").select("logged_at", "message")


def latest_status(events: DataFrame) -> DataFrame:
    """Per job its current status from (job_id, status, at, id) events.

    The first final state sticks; without one the latest event counts.
    """
    final = F.col("status").isin(*FINAL_STATES)
    moment = F.struct("at", "id")
    return events.groupBy("job_id").agg(
        F.coalesce(
            F.min_by(F.when(final, F.col("status")), F.when(final, moment)),
            F.max_by("status", moment),
        ).alias("status")
    )

"""Status functions beyond the registered queries, and the registered ones' form."""

from datetime import datetime

import pytest
from pyspark.sql import functions as F

import __spark_entry__ as entry_points
from hopdex.operators import status
from hopdex.plans.library import QUERIES
from hopdex.sources.store import IndexStore


def logs(spark, n=250):
    return spark.range(n).select(
        "id", F.when(F.col("id") % 5 == 0, "b").otherwise("a").alias("job_id"),
        F.timestamp_seconds(F.col("id")).alias("logged_at"),
        F.concat(F.lit("m"), F.col("id").cast("string")).alias("message"),
    )


def test_log_view_keeps_the_last_hundred_oldest_first(spark):
    a = [i for i in range(250) if i % 5]
    view = status.recent_logs(logs(spark)).filter("job_id = 'a'").orderBy("line").collect()
    assert [r.id for r in view] == a[-100:] and [r.line for r in view] == list(range(1, 101))
    assert [r.message for r in status.job_logs(logs(spark), "b").collect()] == [
        f"m{i}" for i in range(0, 250, 5)
    ]


def test_log_limit_runs_before_the_shuffle(spark):
    plan = status.recent_logs(logs(spark))._jdf.queryExecution().executedPlan().toString()
    assert plan.count("WindowGroupLimit") == 2


def test_logs_are_appended(spark, tmp_path):
    store = IndexStore(spark, str(tmp_path))
    for _ in range(2):
        store.insert("logs", logs(spark, 3))
    assert store.read("logs").count() == 6


def test_live_jobs_hide_their_history(spark):
    live = spark.createDataFrame(
        [("a", "running", 3, 1, 0, True, False), ("b", "completed", 9, 0, 0, True, True)],
        "job_id string, status string, queue_depth int, active_workers int, "
        "pending_shared_pages int, queue_backpressure_active boolean, rate_backpressure_active boolean",
    )
    history = spark.createDataFrame([("a", "stored"), ("c", "stored")], "job_id string, status string")
    both = status.live_and_history(live, history)
    assert sorted((r.job_id, r.status, r.queue_depth, r.queue_backpressure_active) for r in both.collect()) == [
        ("a", "running", 3, True), ("b", "completed", 9, True), ("c", "stored", 0, False)
    ]
    assert status.job_lookup(both, "c").count() == 1 and status.job_lookup(both, "z").count() == 0
    pages = spark.createDataFrame([(None, 200), ("x", 0)], "error string, status_code int")
    row = status.global_status(live, pages).collect()[0]
    assert (row.indexing_active, row.backpressure_active, row.queue_depth) == (True, True, 3)
    assert (row.pages_indexed, row.pages_failed, row.visited_urls) == (1, 1, 2)
    idle = status.global_status(live.filter("job_id = 'b'"), pages).collect()[0]
    assert (idle.indexing_active, idle.backpressure_active, idle.queue_depth) == (False, False, 0)


def test_first_final_state_sticks(spark):
    events = spark.createDataFrame(
        [("a", "created", 1, 1), ("a", "running", 2, 2), ("b", "running", 1, 3), ("b", "interrupted", 2, 4),
         ("b", "completed", 3, 5), ("b", "running", 4, 6)], "job_id string, status string, at int, id int")
    assert {r.job_id: r.status for r in status.latest_status(events).collect()} == {
        "a": "running", "b": "interrupted"
    }


def test_recent_back_pressure_against_a_given_time(spark):
    rows = [("a", "p", datetime(2024, 1, 1, 0, 0, 1)), ("b", "p", datetime(2024, 1, 1, 0, 0, 2)),
            ("b", "x", datetime(2024, 1, 1, 0, 0, 9)), ("c", "x", datetime(2024, 1, 1))]
    events = spark.createDataFrame(rows, "job_id string, message string, logged_at timestamp_ntz")
    asof = F.lit("2024-01-01 00:00:03").cast("timestamp_ntz")
    out = status.backpressure_recent(events, "p", asof).collect()
    assert {r.job_id: r.active for r in out} == {"a": False, "b": True}
    own = status.backpressure_recent(events, "p").collect()
    assert {r.job_id: r.active for r in own} == {"a": True, "b": False}


def test_newest_first(spark):
    jobs = spark.createDataFrame([("b", 1), ("a", 1), ("c", 2)], "job_id string, created_at int")
    assert [r.job_id for r in status.newest_first(jobs).collect()] == ["c", "a", "b"]


def test_every_query_has_its_sql():
    """Queries of other subpackages may have none."""
    oracles = set(entry_points.oracle_sql())
    assert set(QUERIES) <= oracles <= set(entry_points.queries())


@pytest.mark.parametrize("name", ["search_ranked", "frontier_actions", "stream_postings", "word_entry_upsert"])
def test_queries_match_their_sql_on_the_smallest_tables(spark, name):
    """All queries are compared by tools/check_oracles.py; these stay in the suite."""
    from collections import Counter
    from pathlib import Path

    import duckdb

    folder = "/root/testdata/sf0.001"
    if not Path(folder).is_dir():
        pytest.skip("no test tables here")
    db = duckdb.connect()
    for path in Path(folder).glob("*.parquet"):
        db.execute(f"CREATE VIEW {path.stem} AS SELECT * FROM '{path}'")
    df = QUERIES[name](spark, folder)
    cursor = db.execute(entry_points.oracle_sql()[name])
    names = [d[0] for d in cursor.description]
    want = Counter(tuple(str(v) for _, v in sorted(zip(names, r))) for r in cursor.fetchall())
    got = Counter(tuple(str(r[c]) for c in sorted(df.columns)) for r in df.collect())
    assert sorted(names) == sorted(df.columns) and got == want

"""Store, text lines, keyed writes, streaming."""

import gzip
from collections import Counter

import pytest
from pyspark.sql import functions as F

from hopdex.operators.extract import parse_responses
from hopdex.operators.index import build_postings, build_word_entries
from hopdex.operators import status
from hopdex.operators.search import search_relevance
from hopdex.operators.status import pressure_sessions
from hopdex.operators.upsert import upsert
from hopdex.schemas import DISCOVERIES, JOBS, RESPONSES, WORD_ENTRIES
from hopdex.session import stage
from hopdex.sources.store import IndexStore
from hopdex.sources.tables import with_origin
from hopdex.sources.word_lines import parse_lines, read_lines, to_lines, write_lines
from hopdex.streaming.ingest import (
    counter_stream, index_responses, index_stream, one_per_url, read_response_stream, record_discoveries, recover, run_jobs,
    session_stream, stream_name,
)


def rows(df):
    return Counter(tuple(r) for r in df.select(*sorted(df.columns)).collect())


def responses(spark, pages):
    headers = {"Content-Type": "text/html"}
    return spark.createDataFrame([(u, 200, headers, h.encode(), None) for u, h in pages], RESPONSES)


def page(i, words):
    return f"http://s.test/{i}", f"<title>Page {i}</title>{words}"


def jobs(spark, *ids, status="running"):
    at = F.timestamp_seconds(F.lit(0))
    df = spark.createDataFrame([(j,) for j in ids], "job_id string")
    for field in JOBS.fields:
        if field.name not in df.columns:
            df = df.withColumn(field.name, F.lit(0).cast("int").cast(field.dataType)
                               if field.name not in ("created_at", "updated_at") else at)
    return df.withColumn("origin_url", F.concat(F.lit("http://o.test/"), "job_id")).withColumn(
        "status", F.lit(status))


def test_lines(spark, tmp_path):
    entries = spark.createDataFrame(
        [("python", "https://p.test/w/", "https://p.test/", 1, 490), ("9x", "http://a/", "http://b/", 0, 2),
         ("", "u", "o", 0, 1)], WORD_ENTRIES)
    text = sorted((r.letter, r.line) for r in to_lines(entries).collect())
    assert text == [("9", "9x http://a/ http://b/ 0 2"), ("_", " u o 0 1"),
                    ("p", "python https://p.test/w/ https://p.test/ 1 490")]
    path = str(tmp_path / "lines")
    write_lines(entries.filter("word <> ''"), path)
    assert (tmp_path / "lines" / "letter=9").is_dir()
    assert rows(read_lines(spark, path)) == rows(entries.filter("word <> ''"))
    hits = search_relevance(
        spark.createDataFrame([(1, "Python")], "query_id bigint, text string"),
        read_lines(spark, path),
        spark.createDataFrame([], "url string, title string"),
    ).collect()
    assert [(h.score, h.title) for h in hits] == [(5895, "https://p.test/w/")]


def test_unusable_lines_are_skipped(spark):
    lines = ["", "  ", "# note", "a b c 1", "a b c 1 2 3", "p u o x 1", "p u o 1 y",
             "  w u o 1 2  ", "w u o 1.5 2", "w\tu2 \t o -1 +2", "w u o 99999999999 1"]
    df = spark.createDataFrame([(x,) for x in lines], "line string")
    assert sorted(tuple(r) for r in parse_lines(df).collect()) == [
        ("w", "u", "o", 1, 2), ("w", "u2", "o", -1, 2)
    ]


def test_upsert_twice_is_upsert_once(spark):
    base = spark.createDataFrame([("a", 1, 0), ("b", 2, 0)], "k string, v int, at int")
    delta = spark.createDataFrame([("b", 3, 1), ("b", 4, 2), ("c", 5, 1)], "k string, v int, at int")
    once = upsert(base, delta, ["k"], ["at"])
    assert rows(once.select("k", "v")) == Counter([("a", 1), ("b", 4), ("c", 5)])
    assert rows(upsert(once, delta, ["k"], ["at"])) == rows(once)


def entry(spark, *rows):
    return spark.createDataFrame([(w, "u", "o", 0, f) for w, f in rows], WORD_ENTRIES)


def test_store_holds_one_row_of_a_key(spark, tmp_path):
    store = IndexStore(spark, str(tmp_path))

    def held():
        return sorted((r.word, r.frequency) for r in store.read("word_entries").collect())

    assert held() == []
    store.compact("word_entries")
    store.insert("word_entries", entry(spark, ("w", 1), ("x1", 1)))
    store.upsert("word_entries", entry(spark, ("w", 2), ("x2", 1)))
    assert held() == [("w", 2), ("x1", 1), ("x2", 1)]
    store.upsert("word_entries", entry(spark))
    store.insert("word_entries", entry(spark))
    before = held()
    store.compact("word_entries")
    assert held() == before and all(len(f) == 1 for _, f in store.folders("word_entries").values())
    store.replace("word_entries", entry(spark, ("w", 7), ("y", 1)))
    assert held() == [("w", 7), ("y", 1)]  # no row of the letter x is left
    store.insert("word_entries", entry(spark, ("x", 3)))
    assert held() == [("w", 7), ("x", 3), ("y", 1)]
    store.replace("word_entries", entry(spark))
    assert held() == []


def test_letters_without_a_changed_key_keep_their_files(spark, tmp_path):
    store = IndexStore(spark, str(tmp_path))
    store.insert("word_entries", entry(spark, ("a", 1), ("ab", 1), ("b", 1), ("c", 1)))
    before = store.folders("word_entries")
    reader = store.read("word_entries")
    store.upsert("word_entries", entry(spark, ("a", 2), ("bc", 5), ("d", 1)))
    after = store.folders("word_entries")
    assert after["c"] == before["c"]
    assert after["a"][0] > before["a"][0] and len(after["a"][1]) == 1
    assert after["b"][0] == before["b"][0] and set(before["b"][1]) < set(after["b"][1])
    # A reader that came before sees what it has listed.
    assert sorted((r.word, r.frequency) for r in reader.collect()) == [("a", 1), ("ab", 1), ("b", 1), ("c", 1)]
    assert sorted((r.word, r.frequency) for r in store.read("word_entries").collect()) == [
        ("a", 2), ("ab", 1), ("b", 1), ("bc", 5), ("c", 1), ("d", 1)]
    assert [r.word for r in store.read("word_entries", ["c", "x"]).collect()] == ["c"]


def test_a_batch_run_again_replaces_its_first_run(spark, tmp_path, site):
    store = IndexStore(spark, str(tmp_path))
    index_responses(store, responses(spark, site[:1]), "s-0")
    whole = IndexStore(spark, str(tmp_path) + "/whole")
    index_responses(whole, responses(spark, site[:1]), "s-0")
    index_responses(whole, responses(spark, site[1:]), "s-1")
    # The second batch ends before its pages are written.
    store.insert("postings", build_postings(parse_responses(responses(spark, site[1:3]))), "s-1")
    assert not store.holds("pages", "s-1")
    index_responses(store, responses(spark, site[1:]), "s-1")
    assert store.holds("pages", "s-1")
    index_responses(store, responses(spark, [page(9, "other")]), "s-1")  # known by its name
    for table in ("pages", "postings", "word_entries"):
        assert rows(store.read(table).drop("fetched_at", "links")) == rows(whole.read(table).drop("fetched_at", "links"))


def test_fresh_writes_are_read_without_a_shuffle(spark, tmp_path):
    store = IndexStore(spark, str(tmp_path))
    for nth in range(5):
        index_responses(store, responses(spark, [page(nth, f"word{nth} common")]))
    plan = store.read("postings")._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan and store.read("postings").count() == 5 * 4


@pytest.fixture(scope="module")
def site():
    return [page(1, "alpha beta"), page(2, "beta beta 9x"), page(3, "gamma"), page(4, "delta beta")]


def batch_result(spark, site, found, job_rows):
    pages = stage(parse_responses(responses(spark, site)), "pages")
    provenance = with_origin(found, job_rows)
    return build_postings(pages), build_word_entries(pages, provenance)


def test_stream_equals_batch_with_replay_and_restart(spark, tmp_path, site):
    inbox, offsets = str(tmp_path / "in"), str(tmp_path / "offsets")
    store = IndexStore(spark, str(tmp_path / "store"))
    found = spark.createDataFrame(
        [(j, u, d) for j in ("j1", "j2") for d, (u, _) in enumerate(site)], DISCOVERIES)
    some = found.filter("job_id = 'j1'")
    record_discoveries(store, jobs(spark, "j1"), some)

    def deliver(*pages):
        responses(spark, pages).coalesce(1).write.mode("append").parquet(inbox)

    deliver(site[0], site[0], site[1])
    deliver(site[1], site[2])  # site[1] again: offered before
    source = read_response_stream(spark, inbox, max_files=1)
    query = index_stream(source, store, offsets)
    query.awaitTermination()
    progress = [p for p in query.recentProgress if p["numInputRows"] > 0]
    assert len(progress) == 2
    assert store.read("pages").count() == 3

    # A replayed batch is known by its name, and its pages by their URLs.
    before = rows(store.read("postings")), rows(store.read("word_entries"))
    index_responses(store, responses(spark, [site[3]]), f"{stream_name(spark, offsets)}-1")
    index_responses(store, responses(spark, [site[1], ("HTTP://S.test:80/3", "x")]))
    assert (rows(store.read("postings")), rows(store.read("word_entries"))) == before
    assert store.read("pages").count() == 3
    store.compact("pages")
    store.compact("postings")

    # A job that asks for pages fetched before gets its entries at once.
    record_discoveries(store, jobs(spark, "j2"), found.filter("job_id = 'j2'"))

    # Restart: same offsets, a new store object, one more page.
    deliver(site[3])
    again = IndexStore(spark, store.root)
    recover(again)
    assert {r.status for r in again.read("jobs").collect()} == {"interrupted"}
    later = read_response_stream(spark, inbox, max_files=1)
    index_stream(later, again, offsets).awaitTermination()
    assert {r.status for r in again.read("jobs").collect()} == {"interrupted"}

    postings, entries = batch_result(spark, site, found, jobs(spark, "j1", "j2"))
    assert rows(again.read("postings").drop("letter")) == rows(postings)
    assert rows(again.read("word_entries").drop("letter")) == rows(entries)
    nine = again.read("word_entries").filter("letter = '9'").collect()
    assert {r.word for r in nine} == {"9x"}


def test_counter_stream_updates(spark, tmp_path):
    inbox = str(tmp_path / "in")
    schema = "job_id string, message string"
    for batch in ([("a", "x"), ("a", "y")], [("a", "x"), ("b", "x")]):
        spark.createDataFrame(batch, schema).coalesce(1).write.mode("append").parquet(inbox)
    latest = {}

    def sink(batch, number):
        latest.update({(r.job_id, r.message): r.events for r in batch.collect()})

    source = spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).parquet(inbox)
    counter_stream(source, sink, str(tmp_path / "offsets")).awaitTermination()
    assert latest == {("a", "x"): 2, ("a", "y"): 1, ("b", "x"): 1}


def test_pressure_streams_close_as_the_status_says(spark, tmp_path):
    inbox, out = str(tmp_path / "in"), str(tmp_path / "out")
    schema = "id bigint, job_id string, logged_at timestamp, message string"
    seconds = {"a": [0, 1, 3, 4.999, 9], "b": [2.5, 4.4, 6.5], "c": [4]}
    events = sorted((at, job) for job, times in seconds.items() for at in times)

    def logged(some):
        rows = [(0, job, "p", float(at)) for at, job in some] + [(0, job, "x", at + 0.1) for at, job in some]
        return spark.createDataFrame(rows, "id bigint, job_id string, message string, at double").select(
            "id", "job_id", F.timestamp_millis(F.round(F.col("at") * 1000).cast("bigint")).alias("logged_at"), "message")

    logs = logged(events)
    for part in (events[:3], events[3:7], events[7:], [(60, "z")]):
        logged(part).coalesce(1).write.mode("append").parquet(inbox)
        source = spark.readStream.schema(schema).parquet(inbox)
        session_stream(source, "p", out, str(tmp_path / "offsets"), late="1 second").awaitTermination()
    closed = spark.read.parquet(out)
    assert rows(closed) == rows(pressure_sessions(logs, "p"))  # that of z is still open
    # Two seconds to the next event leave no moment without pressure.
    assert sorted((r.job_id, r.n_events) for r in closed.collect()) == [
        ("a", 1), ("a", 4), ("b", 1), ("b", 2), ("c", 1)]
    for at in (0, 1.5, 3, 4.6, 6.999, 7, 8.5, 11):
        asof = F.timestamp_millis(F.lit(int(at * 1000)))
        seen = status.backpressure_recent(logs.filter(F.col("logged_at") <= asof), "p", asof)
        now = closed.filter((F.col("active_from") <= asof) & (F.col("active_until") > asof))
        assert sorted(r.job_id for r in now.collect()) == sorted(r.job_id for r in seen.filter("active").collect())


def test_one_response_per_url(spark):
    a, b, c = (f"http://s.test/{name}" for name in "abc")
    offered = responses(spark, [(a, "1"), (a, "1"), (a, "2"), (b, "3"), (c, "4"), (c, "4")])
    first = sorted((r.url, bytes(r.body)) for r in one_per_url(offered.repartition(3)).collect())
    again = sorted((r.url, bytes(r.body)) for r in one_per_url(offered.repartition(2)).collect())
    assert [u for u, _ in first] == [a, b, c] and first == again


def test_a_good_answer_is_taken_before_a_failure(spark):
    html = {"Content-Type": "text/html"}
    offered = spark.createDataFrame([
        ("http://a.test", 200, html, b"good", None), ("HTTP://A.test/", 503, html, b"zzz", None),
        ("http://a.test/", None, None, None, "timed out"), ("http://b.test/", 200, {"x": "1"}, b"same", None),
        ("http://b.test/", 200, {"x": "2"}, b"same", None), ("mailto:x@y", 200, html, b"", None),
    ], RESPONSES)
    for parts in (1, 4):
        chosen = {r.url: r for r in one_per_url(offered.repartition(parts)).collect()}
        assert set(chosen) == {"http://a.test/", "http://b.test/"}
        assert bytes(chosen["http://a.test/"].body) == b"good"
        assert chosen["http://b.test/"].headers == {"x": "2"}


def test_jobs_run_to_their_end(spark, tmp_path):
    store = IndexStore(spark, str(tmp_path))
    index_responses(store, responses(spark, [
        ("http://s.test/", '<a href="/1">one</a> <a href="/gone">x</a>'), page(1, "alpha")]))
    seeds = spark.createDataFrame(
        [("http://s.test", "1", "5"), ("http://s.test", "1", "5"), ("http://s.test/1", "0", None), ("x:y", "1", None),
         ("http://s.test", "deep", None)], "origin string, max_depth string, queue_capacity string")
    refused = run_jobs(store, seeds)
    assert sorted(r.reject_reason for r in refused.collect()) == [
        "max_depth must be a number", "origin must be a valid http or https URL"]
    found = sorted((r.origin_url, r.status, r.pages_discovered, r.pages_indexed, r.queue_capacity)
                   for r in store.read("jobs").collect())
    assert found == [("http://s.test/", "completed", 3, 2, 5)] * 2 + [("http://s.test/1", "completed", 1, 1, 100)]
    assert store.read("word_entries").filter("word = 'alpha'").count() == 2

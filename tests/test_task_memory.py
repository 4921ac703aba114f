"""What a task holds does not follow the rows it reads."""

import tracemalloc

import numpy as np
import pyarrow as pa
from pyspark.sql import functions as F

from hopdex.llm import common, decontaminate
from hopdex.operators import search
from hopdex.operators.index import dedup_entries
from hopdex.operators.search import _matches, query_terms
from hopdex.schemas import WORD_ENTRIES
from hopdex.session import stage


def plan_lines(df):
    return df._jdf.queryExecution().executedPlan().toString().split("\n")


def test_copies_of_entries_are_not_counted_before_the_shuffle(spark):
    rows = [("w", f"u{n}", "o", 0, n) for n in range(20)] + [(None, "u", "o", 0, 1)]
    entries = spark.createDataFrame(rows, WORD_ENTRIES).withColumn("_position", F.lit(1))
    older = entries.withColumns({"frequency": F.lit(-1), "_position": F.lit(0)})
    kept = dedup_entries(entries.unionByName(older).unionByName(entries))
    lines = plan_lines(kept)
    shuffle = next(n for n, line in enumerate(lines) if "Exchange hashpartitioning" in line)
    assert not [line for line in lines[shuffle:] if "Aggregate" in line]
    assert sorted(map(tuple, kept.select(*WORD_ENTRIES.names).collect()), key=str) == sorted(rows, key=str)


def test_postings_meet_by_page_before_the_queries_multiply_them(spark):
    postings = spark.createDataFrame(
        [(f"t{n % 5}", f"u{n % 7}", 1 + n % 3, n % 2) for n in range(35)],
        "term string, url string, frequency int, title_hits int")
    asked = spark.createDataFrame([("q1", "t1 t2 t2"), ("q2", "t1 t9")], "query_id string, text string")
    totals = [F.sum(F.col("times") * F.col("frequency")).alias("n")]
    sums = [_matches(postings, query_terms(asked), by_page).groupBy("query_id", "url").agg(*totals)
            for by_page in (False, True)]
    lines = plan_lines(sums[1])  # before it runs, as the plan names its first form too after that
    by_query, by_page = ([line for line in lines if f"hashpartitioning({key}" in line] for key in ("query_id", "url"))
    assert not by_query and len(by_page) == 1
    assert sorted(sums[0].collect()) == sorted(sums[1].collect())


def test_entries_meet_by_page_and_origin_before_the_queries_multiply_them(spark, monkeypatch):
    plans = {}

    def staged(df, purpose):
        plans[purpose] = plan_lines(df)
        return stage(df, purpose)

    monkeypatch.setattr(search, "stage", staged)
    rows = [(f"t{n % 5}", f"u{n % 7}", f"o{n % 2}", n % 3, 1 + n % 4) for n in range(210)]
    entries = spark.createDataFrame(sorted(set(rows)), WORD_ENTRIES)
    asked = spark.createDataFrame([("q1", "t1 t2 t2"), ("q2", "t1 t9"), (None, None)], "query_id string, text string")
    pages = spark.createDataFrame([("u1", "One"), ("u2", "")], "url string, title string")
    found = {tuple(r)[:5] for r in search.search_relevance(asked, entries, pages).drop("title", "frequency").collect()}
    wanted = {}
    for term, url, origin, depth, frequency in set(rows):
        for query in {"t1": ("q1", "q2"), "t2": ("q1",)}.get(term, ()):
            key = query, url, origin, depth
            wanted[key] = wanted.get(key, -5 * depth) + 10 * frequency + 1000
    assert found == {(*key, score) for key, score in wanted.items()}
    shuffles = [line for line in plans["scored"] if "hashpartitioning(" in line]
    assert not [line for line in shuffles if "hashpartitioning(query_id" in line]
    assert len([line for line in shuffles if "hashpartitioning(url#" in line and "origin_url#" in line]) == 1


def peak_of(step):
    """(result, bytes held at most, bytes held after) of a call."""
    tracemalloc.start()
    out = step()
    after, peak = tracemalloc.get_traced_memory()
    tracemalloc.stop()
    return out, peak, after


def test_hashing_words_neither_holds_nor_keeps_arrays_as_long_as_the_text(monkeypatch):
    monkeypatch.setattr(common, "_POWERS", {})
    data = np.frombuffer(b"some words of a text " * 200_000, np.uint8)
    starts, ends = common.word_spans(data, np.array([0, len(data)]), ~np.isin(np.arange(256), [32]))
    hashes, peak, after = peak_of(lambda: common.word_hashes(data, starts, ends))
    assert peak < 12 * len(data) and after - hashes.nbytes < 3 * len(data)
    assert len(np.unique(hashes)) == 5
    # A long text hashed at once is not kept either, and has the hash that it has by itself.
    few, _, kept = peak_of(lambda: common.span_hashes(data[:2_000_000].astype(np.uint64), starts[:9], ends[:9]))
    assert (few == hashes[:9]).all() and kept < 1_000_000


def test_looking_for_items_holds_arrays_for_a_part_of_a_batch():
    class Sent:
        value = decontaminate.Matcher([(7, "an item that is long enough to be found")], 0.08)

    texts = ["nothing here " * 400] * 400 + ["There is an item that is long enough to be found"]
    numbers = pa.array(range(len(texts)), pa.int64())
    batch = pa.record_batch({"doc_id": numbers, "k_id": numbers, "k_text": numbers, "text": pa.array(texts)})
    found, peak, _ = peak_of(lambda: [b.to_pylist() for b in decontaminate._search(Sent)([batch])])
    assert [(r["doc_id"], r["item_id"]) for b in found for r in b] == [(400, 7)]
    assert peak < 16 * batch.nbytes


def test_looking_for_items_starts_no_workers_but_those_that_search(spark):
    docs = spark.range(3).select(F.col("id").alias("doc_id"), F.lit("an item that is long enough").alias("text"))
    items = docs.limit(1).select(F.col("doc_id").alias("item_id"), "text")
    found = decontaminate.find_contamination(docs, items)
    assert not [line for line in plan_lines(found) if "ExistingRDD" in line]
    assert sorted(r.doc_id for r in found.collect()) == [0, 1, 2]
    none = decontaminate.find_contamination(docs, items.filter("item_id < 0"))
    assert none.schema == found.schema and none.collect() == []

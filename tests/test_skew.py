"""The paths that only large or skewed data takes, forced on small data."""

import random
from collections import Counter

import pytest
from pyspark.sql import functions as F

from hopdex.operators import joins
from hopdex.operators.joins import drop_known, match_join, newest, newest_wide
from hopdex.operators.ranking import rank_within


@pytest.fixture
def sides(spark):
    dice = random.Random(5)
    left = [("hot" if i % 3 == 0 else f"k{dice.randint(0, 20)}", i) for i in range(600)]
    right = [("hot", 1000 + i) for i in range(40)] + [(f"k{i}", i) for i in range(0, 20, 2)]
    dice.shuffle(left)
    return (
        spark.createDataFrame(left, "k string, a int").repartition(5), left,
        spark.createDataFrame(right, "k string, b int").repartition(3), right,
    )


def rows(df):
    return Counter(tuple(r) for r in df.collect())


@pytest.mark.parametrize("broadcast", ["right", "left", None])
@pytest.mark.parametrize("hot_rows", [7, 1000])
def test_match_join_equals_nested_loops(sides, broadcast, hot_rows):
    left, ls, right, rs = sides
    out = match_join(left, right, ["k"], ["a"], ["b"], broadcast=broadcast,
                     hot_rows=hot_rows, small_rows=3)
    want = Counter((k, a, b) for k, a in ls for j, b in rs if j == k)
    assert rows(out.select("k", "a", "b")) == want


def test_hot_keys_are_cut_on_both_sides(sides):
    left, _, right, _ = sides
    out = match_join(left, right, ["k"], ["a"], ["b"], broadcast=None, hot_rows=7)
    plan = out._jdf.queryExecution().toString()
    assert "_left_piece" in plan and "_right_piece" in plan


def test_left_match_join_keeps_unmatched_rows_once(sides):
    left, ls, right, rs = sides
    few = right.groupBy("k").agg(F.min("b").alias("b"))
    best = {}
    for k, b in rs:
        best[k] = min(b, best.get(k, b))
    for small_rows in (3, 1000):
        out = match_join(left, few, ["k"], ["a"], how="left", hot_rows=7, small_rows=small_rows)
        assert rows(out.select("k", "a", "b")) == Counter((k, a, best.get(k)) for k, a in ls)


def test_small_side_is_broadcast_only_below_the_bound(sides):
    left, _, right, _ = sides
    def plan(n):
        return match_join(left, right, ["k"], ["a"], small_rows=n)._jdf.queryExecution().toString()
    assert "strategy=broadcast" in plan(50)
    assert "strategy=broadcast" not in plan(49).split("== Analyzed")[0]


def test_newest_forms_agree(spark):
    dice = random.Random(9)
    data = [(f"u{dice.randint(0, 9) if i % 3 else 0}", i, f"v{i}") for i in range(300)]
    df = spark.createDataFrame(data, "url string, at int, v string").repartition(6)
    want = Counter({u: (u, a, v) for u, a, v in data}.values())
    assert rows(newest(df, ["url"], ["at"])) == want
    assert rows(newest_wide(df, "url", "at").select("url", "at", "v")) == want


def test_newest_wide_beyond_the_broadcast_bound(spark, monkeypatch):
    data = [("a" if i % 2 else f"u{i % 50}", i, "x") for i in range(400)]
    df = spark.createDataFrame(data, "url string, at int, v string").repartition(6)
    want = Counter({u: (u, a, v) for u, a, v in data}.values())
    monkeypatch.setattr(joins, "is_small", lambda df, rows=0: False)
    assert rows(newest_wide(df, "url", "at").select("url", "at", "v")) == want


def test_rank_limit_runs_before_the_shuffle(spark):
    df = spark.range(100).selectExpr("id % 3 AS k", "id")
    plan = newest(df, ["k"], ["id"])._jdf.queryExecution().executedPlan().toString()
    assert plan.count("WindowGroupLimit") == 2


def test_rank_within_counts_across_partitions(spark):
    dice = random.Random(2)
    data = [(1 if i % 3 else dice.randint(2, 30), dice.randint(0, 5), i) for i in range(2000)]
    df = spark.createDataFrame(data, "g int, s int, id int").repartition(7)
    df = df.sparkSession.createDataFrame(df.collect(), df.schema).repartition(7)
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        out = rank_within(df, ["g"], [F.desc("s"), F.col("id")], "n").collect()
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")
    want, place = {}, Counter()
    for g, s, i in sorted(data, key=lambda r: (r[0], -r[1], r[2])):
        place[g] += 1
        want[i] = place[g]
    assert {r.id: r.n for r in out} == want and len(out) == len(data)


def test_rank_without_groups(spark):
    df = spark.range(500).select((F.col("id") * 7 % 500).alias("x")).repartition(6)
    assert all(r.n == r.x + 1 for r in rank_within(df, [], [F.col("x")], "n").collect())


@pytest.mark.parametrize("bound", [0, 4, 100])
def test_key_filters_on_every_path(spark, monkeypatch, bound):
    df = spark.createDataFrame([("a", 1), ("b", 2), ("a", 3)], "k string, v int")
    known = spark.createDataFrame([("a",), ("a",), ("c",), ("d",), ("e",)], "k string")
    real = joins.is_small
    monkeypatch.setattr(joins, "is_small", lambda d, rows=0: real(d, bound))
    assert rows(drop_known(df, known, ["k"])) == Counter([("b", 2)])
    assert rows(joins.only_keys(df, known, ["k"])) == Counter([("a", 1), ("a", 3)])


def test_word_entries_of_many_discoveries(spark, monkeypatch):
    """The shuffled join, with one URL that nearly every job discovers."""
    from hopdex.operators import index

    pages = spark.createDataFrame(
        [("hot", "a b a", None, 200), ("cold", "c", None, 200), ("bad", "x", "err", 0)],
        "url string, text string, error string, status_code int",
    )
    found = [("hot", f"o{i % 40}", i % 3) for i in range(300)] + [("cold", "o1", 1), ("bad", "o1", 1)]
    discoveries = spark.createDataFrame(found, "url string, origin_url string, depth int")
    real = index.match_join
    monkeypatch.setattr(index, "is_small", lambda d, rows=0: False)
    monkeypatch.setattr(index, "match_join", lambda *a, **k: real(*a, **k, hot_rows=20))
    got = rows(index.build_word_entries(pages, discoveries))
    counts = {"hot": {"a": 2, "b": 1}, "cold": {"c": 1}, "bad": {}}
    assert got == Counter((w, u, o, d, n) for u, o, d in set(found) for w, n in counts[u].items())


def test_search_with_large_results(spark, monkeypatch):
    """Nothing small: shuffled joins with hot terms, hot pages and hot queries."""
    from hopdex.operators import joins as j
    from hopdex.operators import search

    postings = spark.createDataFrame(
        [("the", f"u{i}", 1 + i % 3, i % 2) for i in range(60)] + [("rare", "u1", 2, 0)],
        "term string, url string, frequency int, title_hits int",
    )
    pages = spark.createDataFrame(
        [(f"u{i}", f"t{i}" if i % 4 else "", None, 200) for i in range(60)],
        "url string, title string, error string, status_code int",
    )
    found = spark.createDataFrame(
        [(f"j{i}", "o", "u1", 0) for i in range(50)] + [("j0", "o", f"u{i}", 1) for i in range(2, 60)],
        "job_id string, origin_url string, url string, depth int",
    )
    queries = spark.createDataFrame(
        [(i, "the the rare" if i % 2 else "the") for i in range(30)], "query_id bigint, text string"
    )
    want = rows(search.search_default(queries, postings, pages, found))
    assert sum(want.values()) == 30 * 108
    real = j.match_join

    def large(*args, **options):
        return real(*args, **{**options, "hot_rows": 9, "broadcast": None})

    monkeypatch.setattr(search, "is_small", lambda d, rows=0: False)
    monkeypatch.setattr(search, "match_join", large)
    assert rows(search.search_default(queries, postings, pages, found)) == want

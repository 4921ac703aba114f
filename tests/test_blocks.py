"""Posting blocks and signed changes against the plain index."""

import random
import re
from collections import Counter

import pytest
from pyspark.sql import functions as F

from hopdex.operators.blocks import index_blocks, score_pages, search_blocks
from hopdex.operators.index import build_postings, build_word_entries
from hopdex.operators.refetch import change_entries, change_postings, entry_changes, posting_changes
from hopdex.operators.search import search_default
from hopdex.session import stage

PAGE = "url string, title string, text string, status_code int, error string"
QUERY = "query_id bigint, text string"
FOUND = "job_id string, url string, origin_url string, depth int"


def site(seed, n=60):
    """Pages with one word that all hold, null and empty fields, and failures."""
    dice = random.Random(seed)
    words = lambda k: " ".join(dice.choice(["all", "Ab", "it's", "x9", "née", "dog", "cat"]) for _ in range(k))
    pages = [(f"u{i}", words(2), "all " + words(dice.randint(0, 9)), 200, None) for i in range(n)]
    return pages + [("null", None, None, 200, None), ("empty", "", "", 302, None), ("gone", "all", "all", 404, None),
                    ("broken", "all", "all", 200, "cut"), ("silent", "all", "all", None, None)]


def places(pages):
    rows = [(f"j{j}", p[0], f"o{j % 2}", j) for p in pages for j in range(3)]
    return rows + [("j0", "never fetched", "o0", 1)]


def rows(df):
    return Counter(tuple(r) for r in df.collect())


@pytest.mark.parametrize("span", [1, 8, 4096])
def test_block_search_equals_the_plain_one(spark, span):
    pages = stage(spark.createDataFrame(site(1), PAGE).repartition(4), "pages")
    found = spark.createDataFrame(places(site(1)), FOUND)
    asked = spark.createDataFrame(
        [(1, "all dog DOG it's"), (2, "unknown"), (3, ""), (4, None), (None, "cat"), (5, "all"), (5, "all x9")], QUERY)
    blocks = index_blocks(pages, found, span)
    assert blocks.blocks.agg(F.max(F.size("entries"))).first()[0] <= span
    got = rows(search_blocks(asked, blocks))
    assert got == rows(search_default(asked, build_postings(pages), pages, found)) and got


def test_blocks_stand_in_page_order_and_lose_nothing(spark):
    pages = stage(spark.createDataFrame(site(2), PAGE).repartition(3), "pages")
    blocks = index_blocks(pages, spark.createDataFrame(places(site(2)), FOUND), 8).blocks
    for row in blocks.collect():
        numbers = [e.page for e in row.entries]
        assert numbers == sorted(set(numbers)) and {n >> 3 for n in numbers} == {row.block}
    good = [p for p in site(2) if p[4] is None and p[3] in (200, 302)]
    tokens = lambda text: re.findall("[a-z0-9]+(?:'[a-z0-9]+)?", (text or "").lower())
    want = Counter(t for p in good for t in set(tokens(p[2])) | set(tokens(p[1])))
    got = blocks.groupBy("term").agg(F.sum(F.size("entries"))).collect()
    assert {r[0]: r[1] for r in got} == dict(want)


def test_only_blocks_are_shuffled(spark):
    pages = stage(spark.createDataFrame(site(3), PAGE), "pages")
    blocks = index_blocks(pages, spark.createDataFrame(places(site(3)), FOUND)).blocks
    plan = score_pages(spark.createDataFrame([(1, "all dog")], QUERY), blocks)._jdf.queryExecution().executedPlan().toString()
    shuffles = re.findall(r"Exchange hashpartitioning\(([^)]*)", plan)
    assert len(shuffles) == 1 and "query_id" in shuffles[0] and "page" not in shuffles[0]


def test_empty_index(spark):
    none = index_blocks(spark.createDataFrame([], PAGE), spark.createDataFrame([], FOUND))
    assert search_blocks(spark.createDataFrame([(1, "all")], QUERY), none).collect() == []
    with pytest.raises(ValueError):
        index_blocks(spark.createDataFrame([], PAGE), spark.createDataFrame([], FOUND), 100)


def test_changes_lead_to_the_rebuilt_index(spark):
    before = site(4)
    # Half come again: with other text, the same text, as failures, back from one, and new ones.
    anew = [(u, t, x + " dog" if x else "now all", 200, None) for u, t, x, _, _ in before[::4]]
    anew += [before[1], (before[2][0], "all", "all", 500, None), (before[3][0], None, None, 200, None)]
    anew += [("gone", "all", "all dog", 200, None), ("new", "Dog", "dog dog", 200, None)]
    anew = list({p[0]: p for p in anew}.values())
    after = list({p[0]: p for p in before + anew}.values())
    found = spark.createDataFrame(places(before) + [("j9", "new", "o9", 2)], FOUND)
    old, new, all_ = (stage(spark.createDataFrame(r, PAGE).repartition(3), "pages") for r in (before, anew, after))
    changes = stage(posting_changes(old, new), "changes")
    assert rows(change_postings(build_postings(old), changes)) == rows(build_postings(all_))
    entries = stage(build_word_entries(old, found), "entries")
    got = change_entries(entries, entry_changes(changes, found))
    assert rows(got) == rows(build_word_entries(all_, found))
    assert got.schema == entries.schema


def test_equal_texts_change_nothing(spark):
    pages = stage(spark.createDataFrame(site(5), PAGE), "pages")
    assert posting_changes(pages, pages).isEmpty()
    none = spark.createDataFrame([], PAGE)
    assert posting_changes(pages, none).isEmpty()
    assert rows(change_postings(build_postings(pages), posting_changes(pages, none))) == rows(build_postings(pages))

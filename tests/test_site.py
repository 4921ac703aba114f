"""The three-page site end to end: fetch, crawl, index, search, store, restart."""

import gzip

import pytest
from pyspark.sql import functions as F

from hopdex.operators.crawl import accepted, check_seeds, crawl, fetch_list
from hopdex.operators.extract import parse_responses
from hopdex.operators.index import build_postings, build_word_entries
from hopdex.operators.search import ranked, result_json, search, search_default, search_relevance
from hopdex.schemas import RESPONSES
from hopdex.session import stage

SITE = "http://site.test"
# Words, titles and links of the three pages that the expected scores rest on.
HTML = {
    "/": "<html><head><title>Alpha Root</title></head><body>alpha alpha beta <a href='/docs'>docs</a></body></html>",
    "/docs": "<title>Beta Docs</title><p>beta beta beta gamma <a href=\"/deep#x\">deep</a> <a href='/deep'></a>",
    "/deep": "<title>Gamma Deep</title><body>gamma alpha</body>",
}


def responses(spark, paths=HTML):
    headers = {"Content-Type": "text/html; charset=utf-8", "Content-Encoding": "gzip"}
    rows = [(SITE + p, 200, headers, gzip.compress(HTML[p].encode()), None) for p in paths]
    return spark.createDataFrame(rows, RESPONSES)


@pytest.fixture(scope="module")
def pages(spark):
    return stage(parse_responses(responses(spark)), "pages")


def discover(spark, pages, depth, jobs=("j1",)):
    rows = [(j, SITE + "/", depth) for j in jobs]
    seeds = accepted(check_seeds(spark.createDataFrame(rows, "job_id string, origin string, max_depth int")))
    return crawl(seeds, pages)


def asked(spark, *texts, sort_by=None):
    return spark.createDataFrame(
        [(i, t, sort_by) for i, t in enumerate(texts)], "query_id bigint, text string, sort_by string"
    )


def shown(df, *columns):
    rows = df.collect()
    return sorted([tuple(r[c] for c in columns) for r in rows])


def test_pages(pages):
    got = {r.url: r for r in pages.collect()}
    assert got[SITE + "/"].text == "alpha alpha beta docs"
    assert got[SITE + "/docs"].title == "Beta Docs"
    assert got[SITE + "/docs"].text == "beta beta beta gamma deep"
    assert got[SITE + "/docs"].links == [SITE + "/deep"]
    assert got[SITE + "/deep"].links == []
    assert all(r.status_code == 200 and r.error is None for r in got.values())


def test_depth_and_default_search(spark, pages):
    found = stage(discover(spark, pages, 1), "found")
    assert shown(found, "url", "depth") == [(SITE + "/", 0), (SITE + "/docs", 1)]
    postings = build_postings(pages)
    hits = search_default(asked(spark, "beta", "beta beta", "", "..."), postings, pages, found)
    assert shown(hits, "query_id", "relevant_url", "score", "frequency", "depth") == [
        (0, SITE + "/", 1, 1, 0), (0, SITE + "/docs", 8, 3, 1),
        (1, SITE + "/", 2, 2, 0), (1, SITE + "/docs", 16, 6, 1),
    ]
    places = shown(ranked(hits), "query_id", "position", "relevant_url")
    assert places == [(0, 1, SITE + "/docs"), (0, 2, SITE + "/"),
                      (1, 1, SITE + "/docs"), (1, 2, SITE + "/")]


def test_gamma_at_depth_two(spark, pages):
    found = discover(spark, pages, 2)
    hits = search_default(asked(spark, "gamma"), build_postings(pages), pages, found)
    assert shown(hits, "relevant_url", "score", "depth", "title") == [
        (SITE + "/deep", 6, 2, "Gamma Deep"), (SITE + "/docs", 1, 1, "Beta Docs")
    ]


def test_entries_and_relevance(spark, pages):
    found = stage(discover(spark, pages, 1, ("j1", "j2")), "found")
    entries = build_word_entries(pages, found)
    beta = entries.filter("word = 'beta'")
    assert shown(beta, "url", "origin_url", "depth", "frequency") == [
        (SITE + "/", SITE + "/", 0, 1), (SITE + "/docs", SITE + "/", 1, 3)
    ]
    for text in ("beta", "beta beta"):
        hits = search_relevance(asked(spark, text), entries, pages)
        assert shown(hits, "relevant_url", "score") == [(SITE + "/", 1010), (SITE + "/docs", 1025)]
    # Two jobs with one origin and depth: two rows by default, one by relevance.
    both = asked(spark, "beta").union(asked(spark, "gamma", sort_by="relevance"))
    both = both.withColumn("query_id", F.when(F.col("sort_by").isNull(), 0).otherwise(1))
    out = search(both, build_postings(pages), entries, pages, found)
    assert shown(out, "query_id", "relevant_url", "score") == [
        (0, SITE + "/", 1), (0, SITE + "/", 1), (0, SITE + "/docs", 8), (0, SITE + "/docs", 8),
        (1, SITE + "/docs", 1005),
    ]
    documents = [r.result for r in result_json(out).collect()]
    assert any('"relevance_score":null' in d and '"url":"http://site.test/docs"' in d for d in documents)
    assert any('"relevance_score":1005' in d for d in documents)


def test_missing_page_keeps_url_as_title(spark, pages):
    entries = build_word_entries(pages, discover(spark, pages, 1))
    hits = search_relevance(asked(spark, "beta"), entries, pages.filter("url like '%docs'"))
    assert shown(hits, "relevant_url", "title") == [
        (SITE + "/", SITE + "/"), (SITE + "/docs", "Beta Docs")
    ]


def test_unfetched_pages_are_listed_once(spark, pages):
    some = pages.filter("url <> 'http://site.test/deep'")
    found = discover(spark, some, 5, ("a", "b"))
    assert shown(fetch_list(found, some), "url") == [(SITE + "/deep",)]


def test_seed_rules(spark):
    rows = [("http://A.test", 1, 1, 1.0, 1), ("nope", 1, 1, 1.0, 1), ("http://a.test", -1, 1, 1.0, 1),
            ("http://a.test", 0, 0, 1.0, 1), ("http://a.test", 0, 1, 0.0, 1),
            ("http://a.test", 0, 1, 1.0, 0), ("http://a.test", None, None, None, None)]
    seeds = spark.createDataFrame(
        rows, "origin string, max_depth int, queue_capacity int, rate_limit double, worker_count int"
    )
    checked = check_seeds(seeds)
    assert [r.reject_reason for r in checked.collect()] == [
        None, "origin must be a valid http or https URL", "max_depth must be >= 0",
        "queue_capacity must be >= 1", "rate_limit must be > 0", "worker_count must be >= 1", None,
    ]
    assert shown(accepted(checked), "origin_url", "max_depth") == [
        ("http://a.test/", 0), ("http://a.test/", 1)
    ]
    assert all(len(r.job_id) == 64 for r in accepted(checked).collect())


def test_stored_index_is_pruned_by_the_query(spark, pages, tmp_path):
    from hopdex.operators.search import _matches, query_terms
    from hopdex.sources.store import IndexStore

    store = IndexStore(spark, str(tmp_path))
    store.replace("postings", build_postings(pages))
    matches = _matches(store.read("postings"), query_terms(asked(spark, "beta gamma")))
    assert shown(matches, "term", "url", "frequency") == [
        ("beta", SITE + "/", 1), ("beta", SITE + "/docs", 3),
        ("gamma", SITE + "/deep", 1), ("gamma", SITE + "/docs", 1),
    ]
    plan = matches._jdf.queryExecution().executedPlan().toString()
    assert "letter#" in plan.split("PartitionFilters: ")[1].split("]")[0]
    assert "In(term" in plan or "EqualTo(term" in plan or "term IN" in plan

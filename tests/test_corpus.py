"""Inputs derived from the given tables."""

from hopdex.plans import corpus


def test_raw_pages_are_written_with_canonical_urls(spark, tmp_path):
    """A plan that parses them has one Python worker a task, not three."""
    rows = [(0, "HTTP://A.test:80", "old"), (1, "http://a.test/", "new"), (2, "http://b.test/x#f", "b"),
            (3, "mailto:x@y", "no"), (4, None, "no"), (None, "http://c.test/", None)]
    spark.createDataFrame(rows, "page_id long, url string, html string").write.parquet(str(tmp_path / "pages.parquet"))
    raw = corpus.raw_pages(spark, str(tmp_path))
    assert "EvalPython" not in raw._jdf.queryExecution().optimizedPlan().toString()
    assert {(r.page_id, r.url, r.html) for r in raw.collect()} == {
        (1, "http://a.test/", "new"), (2, "http://b.test/x", "b"), (None, "http://c.test/", None)}
    assert set(corpus.raw_pages(spark, str(tmp_path), ("page_id", "url")).columns) == {"page_id", "url"}

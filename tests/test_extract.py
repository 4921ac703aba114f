"""Markup snippets, body decoding, error classes."""

import gzip

import pytest
from pyspark.sql import functions as F

from hopdex.functions.markup import parse_page
from hopdex.operators.extract import CUT_NOTE, edges, fetch_state, is_success, parse_responses
from hopdex.schemas import PAGES, RESPONSES
from hopdex.sources.tables import pages_from_json_links, pages_with_json_links, read_body_files

BASE = "http://a.test/d/e"
LONG = 3_000_000
SNIPPETS = [
    ("a<br>b<b>c</b>d", "", "a b c d", []),
    ("<noscript><a href=\"/n\">q</a></noscript>", "", "", ["http://a.test/n"]),
    ("<script>1<b>2</b></script>t", "", "t", []),
    ("x <a href='q", "", "x", []),
    ("<title>A</title><svg><title>B</title></svg>", "A B", "", []),
    ("<title> A \n B</title>c", "A B", "c", []),
    ("<title>never closed <p>all", "never closed all", "", []),
    ("<noscript>x<script>y</noscript>z</script>w", "", "", []),
    ("a&nbsp;b&amp;c&eacute;", "", "a b&cé", []),
    ("tail &am", "", "", []),
    ("<!-- <title>no</title> --><!DOCTYPE html>yes", "", "yes", []),
    ("<a href=/x href=/y>1</a><a>2</a><a href='mailto:q'>3</a><A HREF=' z#f '>4</A>", "", "1 2 3 4",
     ["http://a.test/y", "http://a.test/d/z"]),
    ("<base href='http://b/'><a href='r'>1</a><a href='r#2'>2</a>", "", "1 2", ["http://a.test/d/r"]),
    ("<a href='http://[bad/'>x</a><a href='/ok'>y</a>", "", "x y", ["http://a.test/ok"]),
    ("<style>p{}</style></style>k", "", "k", []),
    ("", "", "", []),
    ("1 < 2 and 3 > 2", "", "1 < 2 and 3 > 2", []),
]


@pytest.mark.parametrize("html,title,text,links", SNIPPETS)
def test_snippets(html, title, text, links):
    assert parse_page(html, BASE) == (title, text, links, None)


def run(spark, *rows):
    df = spark.createDataFrame(list(rows), RESPONSES)
    return {r.url.rsplit("/", 1)[1]: r for r in parse_responses(df).collect()}


def test_bodies_and_errors(spark):
    def ok(name, body, ctype="text/plain", encoding=None):
        headers = {"Content-Type": ctype} if ctype else {}
        if encoding:
            headers["content-ENCODING"] = encoding
        return (f"http://a.test/p/{name}", 200, headers, body, None)

    page = b"<title>T</title>caf\xc3\xa9 <a href='/l'>x</a>"
    got = run(
        spark,
        ok("utf8", "naïve".encode()),
        ok("bad", b"a\xffb\xe2\x82c"),
        ok("latin", "é".encode("latin-1"), "text/plain; charset=ISO-8859-1"),
        ok("quoted", "é".encode("latin-1"), 'text/plain; Charset="latin-1"; x=y'),
        ok("nocs", b"x", "text/plain; charset=no-such"),
        ok("zip", gzip.compress(page), "text/html", "GZIP"),
        ok("notzip", b"plain", "text/plain", "gzip"),
        ok("cutzip", gzip.compress(b"hello" * 100)[:-12], "text/plain", "gzip"),
        ok("html", page, "Application/XHTML+xml ; q=1"),
        ok("none", b"<b>raw</b>", None),
        ok("odd", b"<b>raw</b>", "html"),
        ok("empty", None),
        ok("long", b"w" * LONG),
        ok("longzip", gzip.compress(b"v" * LONG), encoding="gzip"),
        ("http://a.test/p/gone", 404, {}, b"x", None),
        ("http://a.test/p/moved", 304, {}, b"", None),
        ("http://a.test/p/dns", 0, None, None, "no such host"),
        ("http://a.test/p/late", 0, None, None, "unexpected error: timed out"),
    )
    assert got["utf8"].text == "naïve" and got["utf8"].title == "/p/utf8"
    assert got["bad"].text == b"a\xffb\xe2\x82c".decode("utf-8", "replace")
    assert got["latin"].text == got["quoted"].text == "é"
    assert got["nocs"].error == "unexpected error: unknown encoding: no-such"
    assert (got["nocs"].status_code, got["nocs"].title, got["nocs"].text) == (0, "", "")
    assert (got["zip"].title, got["zip"].text) == ("T", "café x")
    assert got["zip"].links == got["html"].links == ["http://a.test/l"]
    assert got["notzip"].text == "plain"
    assert got["cutzip"].error.startswith("unexpected error: ") and got["cutzip"].status_code == 0
    assert got["none"].text == got["odd"].text == "<b>raw</b>" and got["none"].links == []
    assert got["empty"].text == "" and got["empty"].error is None
    # Whole bodies count, packed ones too; a cut is asked for.
    assert got["long"].text == "w" * LONG and got["longzip"].text == "v" * LONG
    df = spark.createDataFrame([ok("long", b"w" * LONG)], RESPONSES)
    assert parse_responses(df, max_body_bytes=100).first().text == "w" * 100 + CUT_NOTE.format(100)
    assert (got["gone"].status_code, got["gone"].error) == (404, "HTTP 404")
    assert (got["moved"].status_code, got["moved"].error) == (304, "HTTP 304")
    assert (got["dns"].status_code, got["dns"].error) == (0, "URL error: no such host")
    assert (got["late"].status_code, got["late"].error) == (0, "unexpected error: timed out")
    assert all(r.links == [] for r in got.values() if r.error)


def test_success_and_state(spark):
    rows = [(None, 200), (None, 399), (None, 400), (None, 199), ("x", 200), ("", 200)]
    df = spark.createDataFrame(rows, "error string, status_code int")
    out = df.select(is_success().alias("ok"), fetch_state(F.col("error")).alias("s")).collect()
    assert [r.ok for r in out] == [True, True, False, False, False, False]
    assert [r.s for r in out] == ["fetched"] * 4 + ["failed", "fetched"]


def test_json_links_and_edges(spark):
    rows = [("u", "t", "x", ["a", "é\"b"], None, 200, None), ("v", "", "", [], None, 200, None),
            ("w", "", "", ["a"], None, 0, "bad")]
    pages = spark.createDataFrame(rows, PAGES)
    again = pages_from_json_links(pages_with_json_links(pages))
    assert sorted(again.collect()) == sorted(pages.collect())
    assert [tuple(r) for r in edges(pages).orderBy("position").collect()] == [
        ("u", 0, "a"), ("u", 1, "é\"b")
    ]


def test_saved_bodies_are_a_source(spark, tmp_path):
    (tmp_path / "one.html").write_bytes(b"<title>One</title>x")
    pages = parse_responses(read_body_files(spark, str(tmp_path), "http://f.test", "text/html"))
    assert [(r.url, r.title, r.text) for r in pages.collect()] == [
        ("http://f.test/one.html", "One", "x")
    ]


def test_plain_bodies_go_past_python(spark):
    """Rows that a UDF does not need would wait for it with their bodies, any number of them."""
    rows = [("http://a.test/p/plain", 200, {"Content-Type": "text/plain"}, b"x", None),
            ("http://a.test/p/html", 200, {"Content-Type": "text/html"}, b"<p>y", None),
            ("http://a.test/p/bad", 200, {"Content-Type": "text/plain"}, b"a\xff", None),
            ("http://a.test/p/none", None, None, None, None),
            ("http://a.test/p/gone", 404, {}, b"x", None)]
    pages = parse_responses(spark.createDataFrame(rows, RESPONSES))
    plan = pages._jdf.queryExecution().optimizedPlan()
    assert plan.nodeName() == "Union"
    with_python = ["EvalPython" in plan.children().apply(n).toString() for n in range(2)]
    assert with_python == [False, True]
    got = {r.url.rsplit("/", 1)[1]: (r.text, r.error) for r in pages.collect()}
    assert got == {"plain": ("x", None), "html": ("y", None), "bad": ("a�", None), "none": ("", None),
                   "gone": ("", "HTTP 404")}

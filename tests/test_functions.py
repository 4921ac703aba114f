import random
import re
from collections import Counter
from datetime import UTC, datetime, timedelta

import pytest
from pyspark.sql import functions as F

from hopdex.functions.text import collapse_ws, field_counts, letter_of, term_counts, tokenize, utc_iso
from hopdex.functions.urls import canonical_url, normalize_url, page_links

ABSOLUTE = [
    ("", None),
    ("   ", None),
    (None, None),
    ("HTTP://Ex.COM", "http://ex.com/"),
    ("https://a.b:443/x?q=2&a=1#f", "https://a.b/x?q=2&a=1"),
    ("http://a.b:443/", "http://a.b:443/"),
    ("http://u:p@H:81/a", "http://h:81/a"),
    ("http://h:0/", "http://h/"),
    ("http://h:0081/", "http://h:81/"),
    ("http://h:99999/", None),
    ("http://h:x/", None),
    ("mailto:x@y", None),
    ("javascript:f()", None),
    ("tel:1", None),
    ("data:,x", None),
    ("ftp://a/", None),
    ("a/b", None),
    ("http://", None),
    ("http://:80/", "http:///"),
    ("http://[::1]:8080/x", "http://::1:8080/x"),
    ("http://[bad/", None),
    ("  http://a/b c ", "http://a/b c"),
    ("http://a?", "http://a/"),
    ("http://a?x#y", "http://a/?x"),
    ("http://a#y", "http://a/"),
    ("http://a/P%41th/", "http://a/P%41th/"),
    ("http://a/x;p", "http://a/x;p"),
    ("http://ünï.example/für", "http://ünï.example/für"),
]
RELATIVE = [
    ("../d/./e", "http://a/b/c?x", "http://a/d/e"),
    ("?z", "http://a/b/c?x", "http://a/b/c?z"),
    ("#f", "http://a/b/c", "http://a/b/c"),
    ("//cdn.x/a", "https://a/", "https://cdn.x/a"),
    ("http://a/x/../y", "http://a/b", "http://a/x/../y"),
    ("http://[bad/", "http://a/", None),
    ("/für", "https://A.b:443/x", "https://a.b/für"),
    ("/a/../b", "http://a/x", "http://a/b"),
    ("/./b", "http://a/x", "http://a/b"),
    ("/.b", "http://a/x", "http://a/.b"),
    ("/a//b", "http://a/x", "http://a/a//b"),
    ("/x;", "http://a/x", "http://a/x"),
    ("/a:b?q=/../z", "http://a/x", "http://a/a:b?q=/../z"),
    ("x", "http://a", "http://a/x"),
    ("mailto:q", "http://a/", None),
    ("", "http://a/", None),
    (" /t ", "http://a/", "http://a/t"),
]


def test_absolute_urls(spark):
    rows = spark.createDataFrame([(i, r) for i, (r, _) in enumerate(ABSOLUTE)], "i int, raw string")
    got = {r.i: r.u for r in rows.select("i", normalize_url(F.col("raw")).alias("u")).collect()}
    assert [got[i] for i in range(len(ABSOLUTE))] == [want for _, want in ABSOLUTE]


def test_relative_urls(spark):
    rows = spark.createDataFrame(
        [(i, r, b) for i, (r, b, _) in enumerate(RELATIVE)], "i int, raw string, base string"
    )
    out = rows.select("i", normalize_url(F.col("raw"), F.col("base")).alias("u")).collect()
    got = {r.i: r.u for r in out}
    assert [got[i] for i in range(len(RELATIVE))] == [want for _, _, want in RELATIVE]


PIECES = [
    "http", "HTTPS", "://", ":", "/", "//", "?", "#", "..", ".", ";", "a", "B", "é", "80", "443",
    "081", "70000", "@", "[", "]", " ", "\t", "\n", "&", "=", "%20", "x.y", "-", "　",
]
STARTS = ["http://", "https://", "HTTP://", "//", "/", "", "http://a", "https://b.c/"]


@pytest.mark.parametrize("seed", [1, 2])
def test_native_urls_agree_with_the_standard_library(spark, seed):
    """Whatever the expression answers must be what the UDF would answer."""
    dice = random.Random(seed)

    def shape():
        return dice.choice(STARTS) + "".join(dice.choices(PIECES, k=dice.randint(0, 7)))

    cases = [(shape(), shape()) for _ in range(5000)]
    rows = spark.createDataFrame(
        [(r, "http://h.x/d/e?f" if i % 2 else b) for i, (r, b) in enumerate(cases)],
        "raw string, base string",
    )
    out = rows.select(
        "raw", "base",
        normalize_url(F.col("raw")).alias("alone"),
        normalize_url(F.col("raw"), F.col("base")).alias("joined"),
    ).collect()
    for r in out:
        assert r.alone == canonical_url(r.raw), r
        assert r.joined == canonical_url(r.raw, r.base), r
        links = page_links([r.raw, r.base, r.raw], r.base)
        want = dict.fromkeys([canonical_url(r.raw, r.base), canonical_url(r.base, r.base)])
        assert links == [u for u in want if u], r


def test_tokens_and_counts(spark):
    rows = spark.createDataFrame(
        [("a'b'c '90s don't it''s", "A b"), ("naïve café", "x X naïve"), ("", ""), ("b b a", "")],
        "text string, title string",
    )
    t, h = tokenize(F.col("text")), tokenize(F.col("title"))
    out = rows.select(t.alias("t"), term_counts(t).alias("c"), field_counts(t, h).alias("f")).collect()
    assert out[0].t == ["a'b", "c", "90s", "don't", "it", "s"]
    assert out[1].t == ["na", "ve", "caf"]
    assert out[2].t == [] and out[2].c == [] and out[2].f == []
    assert [tuple(x) for x in out[3].c] == [("a", 1), ("b", 2)]
    assert {tuple(x) for x in out[1].f} == {
        ("na", 1, 1), ("ve", 1, 1), ("caf", 1, 0), ("x", 0, 2)
    }


def test_field_counts_by_brute_force(spark):
    dice = random.Random(3)

    def words():
        return "".join(dice.choices("ab' c1É", k=dice.randint(0, 14)))

    cases = [(words(), words()) for _ in range(3000)]
    shape = re.compile(r"[a-z0-9]+(?:'[a-z0-9]+)?")
    rows = spark.createDataFrame(cases, "text string, title string")
    f = field_counts(tokenize(F.col("text")), tokenize(F.col("title")))
    for r in rows.select("text", "title", f.alias("f")).collect():
        a, b = (Counter(shape.findall(x.lower())) for x in (r.text, r.title))
        assert {tuple(x) for x in r.f} == {(k, a[k], b[k]) for k in a | b}
        assert len(r.f) == len(a | b)


def test_whitespace_and_letters(spark):
    rows = spark.createDataFrame([(" a \n b　c\x1c ", "Zed"), ("", ""), ("x", "9x")], "s string, w string")
    out = rows.select(collapse_ws(F.col("s")).alias("s"), letter_of(F.col("w")).alias("l")).collect()
    assert [(r.s, r.l) for r in out] == [("a b c", "z"), ("", "_"), ("x", "9")]


@pytest.mark.parametrize("zone", ["UTC", "America/New_York", "Asia/Kolkata"])
def test_times_as_utc_text(spark, zone):
    moments = [0, 7, -1, 1_000_000, 1_704_067_200_123_000, 1_699_163_999_999_999, -86_400_000_000, None]
    before = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", zone)
    try:
        df = spark.createDataFrame([(m,) for m in moments], "m long")
        got = [r[0] for r in df.select(utc_iso(F.timestamp_micros("m"))).collect()]
    finally:
        spark.conf.set("spark.sql.session.timeZone", before)
    start = datetime(1970, 1, 1, tzinfo=UTC)
    assert got == [None if m is None else (start + timedelta(microseconds=m)).isoformat() for m in moments]

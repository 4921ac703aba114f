import re
from collections import Counter
from itertools import permutations

import pytest
from helpers import documents

from hopdex.llm.filter_audit import audit_filters, first_copies, measure
from hopdex.session import stage

COLUMNS = ["part", "filter_order", "step", "kept", "removed", "redundant", "unique_fails", "good_lost", "toxic_lost", "shapley"]


def brute(rows, labels):
    place = lambda doc: float("inf") if doc is None else doc
    first = {}
    for doc, text, _ in rows:
        first[text or ""] = min(first.get(text or "", float("inf")), place(doc))
    parts = {}
    for doc, text, lang in rows:
        text = text or ""
        words = re.findall(r"[^\x20\x09-\x0D]+", text)
        fails = "".join(f for f, bad in zip("ABCDE", (
            len(words) < 100, 100 * len(set(words)) < 80 * len(words), 100 * len(re.findall("[A-Z]", text)) > 10 * len(text),
            re.search(r"[#$%&*|]", text), place(doc) > first[text]), strict=True) if bad)
        own = [(q, t) for d, q, t in labels if d is not None and d == doc]
        parts.setdefault(lang or "", []).append((fails, any(q == 1 for q, _ in own), any(t == 1 for _, t in own)))
    out, shapley = [], Counter()
    for part, docs in parts.items():
        for order in map("".join, permutations("ABCDE")):
            for step, own in enumerate(order, 1):
                before = set(order[: step - 1])
                here = [d for d in docs if own in d[0] and not before & set(d[0])]
                shapley[part, own] += len(here)
                out.append([part, order, step, sum(own not in d[0] and not before & set(d[0]) for d in docs), len(here),
                            sum(own in d[0] and bool(before & set(d[0])) for d in docs),
                            sum(d[0] == own for d in docs), sum(d[1] for d in here), sum(d[2] for d in here)])
    return sorted((*r, shapley[r[0], r[1][r[2] - 1]]) for r in out)


def corpus():
    words = lambda i, n: " ".join(f"w{i}x{k}" for k in range(n))
    rows = [(i, words(i % 7, 120), "en" if i % 3 else "de") for i in range(21)]
    rows += [(30 + i, words(i, 40) + " # " + "same " * (30 * i), None) for i in range(5)]
    rows += [(40, words(1, 110).upper(), "en"), (41, words(1, 110).upper(), "fr"), (42, None, "en"), (43, "", ""), (44, " \t\n", "en")]
    rows += [(None, words(0, 120), "en"), (None, "alone é", "en"), (50, words(9, 130), "x"), (50, words(9, 130), "x"), (50, "é$", "x")]
    return rows + [(60, " ".join(f"n{k}" for k in range(40_000)), "en")]


LABELS = [(1, 1, 0), (1, 0, 1), (8, 1, 1), (40, None, 1), (30, 1, None), (None, 1, 1), (99, 1, 1)]


@pytest.mark.parametrize("bits", [64, 2])
def test_matches_brute_force(spark, bits):
    """With two bits of a hash, different texts have one hash: those are told apart in full."""
    rows = corpus()
    docs = documents(spark, rows)
    labels = spark.createDataFrame([(*r, "x") for r in LABELS], "doc_id long, quality int, toxic int, text string")
    found = audit_filters(docs, labels, hash_bits=bits)
    assert found.columns == COLUMNS
    assert sorted(tuple(r) for r in found.collect()) == brute(rows, LABELS)


def test_the_sketch_clears_unique_texts_only(spark):
    docs = spark.range(4000).selectExpr("id as doc_id", "concat('t', id % 3990) as text", "'en' as lang")
    measured = measure(docs)
    hashes = stage(measured.select("h"), "hashes")
    repeats, clashes = first_copies(measured, hashes)
    assert sorted(r.first for r in repeats.collect()) == list(range(10)) and clashes.isEmpty()


def test_empty_tables(spark):
    labels = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    assert audit_filters(documents(spark, []), labels).collect() == []
    assert audit_filters(documents(spark, [(1, "a", "en")]), labels).count() == 600

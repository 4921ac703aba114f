import random
import re

import numpy as np
import pytest
from helpers import classes_of, documents, rows_of

from hopdex.llm.components import components
from hopdex.llm.ngram_join import runs_for, shared_counts, similar_documents


def shingles(text, size=5):
    words = re.findall(r"[0-9a-z\x80-\U0010ffff]+", (text or "").lower())
    if not words:
        return frozenset()
    return frozenset(tuple(words[i: i + size]) for i in range(max(1, len(words) - size + 1)))


def brute(rows, threshold=0.8):
    sets = {i: shingles(t) for i, (_, t) in enumerate(rows)}

    def linked(i, j):
        a, b = sets[i], sets[j]
        return bool(a) and bool(b) and len(a & b) >= threshold * len(a | b) - 1e-12

    root = classes_of(range(len(rows)), linked)
    big = 2**63
    ids = lambda i: big if rows[i][0] is None else rows[i][0]
    out = []
    for i, (doc, text) in enumerate(rows):
        members = [j for j in range(len(rows)) if root[j] == root[i]]
        smallest = min(map(ids, members))
        links = {sets[j] for j in range(len(rows)) if j != i and sets[j] != sets[i] and linked(min(i, j), max(i, j))}
        copies = {(rows[j][0], rows[j][1]) for j in range(len(rows)) if sets[i] and sets[j] == sets[i]} or {0}
        out.append((doc, None if smallest == big else smallest, len(links), len(copies)))
    return sorted(out, key=repr)


def corpus(families=12, size=6):
    rng = random.Random(12)
    word = lambda: "".join(rng.choice("abcdefgé") for _ in range(rng.randint(2, 6)))
    common = " ".join(word() for _ in range(30))
    rows, doc = [], 0
    for _ in range(families):
        base = [word() for _ in range(rng.randint(40, 120))]
        for _ in range(size):
            text = list(base)
            for _ in range(rng.randint(0, 4)):
                text[rng.randrange(len(text))] = word()
            rows.append((doc, " ".join(text)))
            doc += 1
    rows += [(doc + i, common + " " + " ".join(word() for _ in range(rng.randint(1, 30)))) for i in range(20)]
    rows += [(900, None), (901, ""), (902, "!!"), (903, "one two"), (904, "One, TWO!"), (None, "one two"), (905, "one"),
             (906, rows[0][1]), (906, rows[0][1]), (907, "x " * 3000), (None, None)]
    return rows


@pytest.mark.parametrize("bucket", [256, 4])
def test_matches_brute_force(spark, bucket):
    rows = corpus()
    found = rows_of(similar_documents(documents(spark, rows), recall=0.9999, bucket=bucket),
                    "doc_id", "class_id", "n_links", "n_copies")
    assert found == brute(rows)


def test_one_of_each_class_stays(spark):
    rows = corpus(3)
    found = similar_documents(documents(spark, rows), recall=0.9999).filter("stays").collect()
    classes = [r.class_id for r in found if r.class_id is not None and r.doc_id != 906]
    assert len(classes) == len(set(classes))
    assert {c for _, c, _, _ in brute(rows)} <= {r.class_id for r in found}


def test_empty_table(spark):
    assert similar_documents(documents(spark, [])).collect() == []


def test_runs_reach_the_recall():
    assert runs_for(0.99, 0.8, 0) == 3 and runs_for(0.99, 0.8, 2) == 7
    for depth in range(4):
        runs = runs_for(0.95, 0.8, depth)
        assert 1 - (1 - 0.8 ** (depth + 1)) ** runs >= 0.95


def test_shared_counts():
    rng = np.random.default_rng(2)
    sets = [np.unique(rng.integers(0, 9000, 4000).astype(np.uint64)) for _ in range(5)]
    found = shared_counts(sets)
    for i in range(5):
        for j in range(5):
            if i != j:
                assert found[i, j] == len(np.intersect1d(sets[i], sets[j]))


def test_components(spark):
    rng = random.Random(1)
    links = [(rng.randrange(300), rng.randrange(300)) for _ in range(200)] + [(i, i + 1) for i in range(400, 470)]
    links += [(500, i) for i in range(501, 560)] + [(None, 3), (7, 7)]
    found = dict(components(spark.createDataFrame(links, "a long, b long")).distinct().collect())
    nodes = sorted({x for pair in links for x in pair if None not in pair and pair[0] != pair[1]})
    pairs = {(min(p), max(p)) for p in links if None not in p}
    assert found == classes_of(nodes, lambda i, j: (i, j) in pairs)
    assert components(spark.createDataFrame([], "a long, b long")).collect() == []

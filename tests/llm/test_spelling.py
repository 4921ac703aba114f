import random
import re
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
from helpers import documents, edit_distance, rows_of

from hopdex.llm.spelling import group_variants, letters, near_pairs


def brute(rows):
    counts = Counter()
    for doc, text in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            low = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in run)
            h = zlib.crc32(f"{'null' if doc is None else doc}:{low}".encode())
            if h % 97 == 0:
                at = h % len(low)
                low = low[:at] + low[at + 1:]
            counts[low] += 1
    n = {w: c for w, c in counts.items() if len(w) >= 5 and c >= 3}
    near = {w: [v for v in n if abs(len(v) - len(w)) <= 1 and edit_distance(v, w) == 1] for w in n}
    form = {}
    for w, found in near.items():
        best = min(found, key=lambda v: (-n[v], v), default=None)
        if best is not None and n[best] >= 2 * n[w]:
            form[w] = best
    out = []
    for w in n:
        root = w
        while root in form:
            root = form[root]
        out.append((w, form.get(w), root, n[w], len(near[w]), n.get(form.get(w))))
    return sorted(out, key=repr)


def corpus():
    rng = random.Random(11)
    stems = ["".join(rng.choice("abàÿ×") for _ in range(rng.randint(5, 9))) for _ in range(25)]
    rows = []
    for i in range(120):
        words = []
        for _ in range(60):
            word = rng.choice(stems[: 1 + int(25 * rng.random() ** 3)])
            for _ in range(rng.randint(0, 2)):
                at = rng.randrange(len(word))
                word = word[:at] + rng.choice(["", "a", "b", "à"]) + word[at + rng.randint(0, 1):]
            words.append(word if rng.random() < 0.8 else word.upper())
        rows.append((i, rng.choice([" ", ", ", "1"]).join(words)))
    chain = [("chains", 96), ("chainsa", 40), ("chainsab", 20), ("chainsabc", 9), ("chainsabcd", 4)]
    rows += [(200 + k, " ".join([w] * n)) for k, (w, n) in enumerate(chain)]
    rows += [(300, None), (301, ""), (None, "Àbcde Àbcde Àbcde àbcde"), (302, "ties1" * 9), (303, "aaaaa " * 5 + "aaaaaa " * 5 + "aaaa " * 9)]
    long = "xy" * 5000
    rows += [(304, " ".join([long, long, long] + [long + "z"] * 7 + ["q" + long] * 3))]
    return rows + [(0, rows[0][1]), (0, rows[0][1])]


@pytest.mark.parametrize("longest", [1024, 2])
def test_matches_brute_force(spark, longest):
    """Short lists get windows down to one letter."""
    rows = corpus()
    small = [(d, t) for d, t in rows if d != 304]
    found = rows_of(group_variants(documents(spark, small), longest), "word", "form", "root", "n", "n_near", "form_n")
    assert found == brute(small)
    assert {r[0]: r[2] for r in found}["chainsabcd"] == "chains"


def test_very_long_words(spark):
    found = rows_of(group_variants(documents(spark, corpus()[-3:-2])), "word", "n", "n_near", "form_n")
    long = "xy" * 5000
    assert sorted((len(w), n, k, f) for w, n, k, f in found if w in (long, long + "z", "q" + long)) == [
        (10000, 3, 2, 7), (10001, 3, 1, None), (10001, 7, 1, None)]


def test_lists_against_all_pairs():
    rng = random.Random(2)
    words = sorted({"".join(rng.choice("abc") for _ in range(rng.choice([5, 6]))) for _ in range(300)})
    codes, offsets = letters(pa.array(words))
    count = len(words)
    whole = lambda value: np.full(count, value)
    new = np.arange(count) == 0
    pairs = sorted((words[a], words[b]) for one, two in near_pairs(codes, offsets, new, whole(5), whole(0), whole(5))
                   for a, b in zip(one, two, strict=True))
    want = sorted((a, b) for a in words for b in words if min(len(a), len(b)) == 5 and edit_distance(a, b) == 1)
    assert pairs == want


def test_empty_table(spark):
    assert group_variants(documents(spark, [])).collect() == []
    assert group_variants(documents(spark, [(1, "abcde abcde"), (2, None)])).collect() == []

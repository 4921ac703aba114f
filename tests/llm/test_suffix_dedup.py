import hashlib
import random

import numpy as np
import pytest

from hopdex.llm.suffix_dedup import common_prefixes, remove_repeats, sort_suffixes

SCHEMA = "doc_id long, text string, kept string, runs int"


def brute(rows, length=100):
    """doc_id, n_bytes, n_removed, n_spans, hash by looking at every string."""
    order = lambda i: (i is None, i or 0)
    first = {}
    for doc, text in rows:
        raw = (text or "").encode()
        for at in range(len(raw) - length + 1):
            gram = raw[at: at + length]
            place = (order(doc), at)
            if gram not in first or place < first[gram]:
                first[gram] = place
    out = []
    for doc, text in rows:
        raw = (text or "").encode()
        gone = np.zeros(len(raw), bool)
        for at in range(len(raw) - length + 1):
            if first[raw[at: at + length]] < (order(doc), at):
                gone[at: at + length] = True
        spans = int(gone[:1].sum() + (gone[1:] & ~gone[:-1]).sum())
        left = bytes(np.frombuffer(raw, np.uint8)[~gone])
        out.append((doc, len(raw), int(gone.sum()), spans, hashlib.sha256(left).hexdigest()))
    return sorted(out, key=str)


def result(spark, rows, **options):
    docs = spark.createDataFrame([(d, t, "x", 1) for d, t in rows], SCHEMA).repartition(3)
    found = remove_repeats(docs, **options).select(
        "doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256")
    return sorted((tuple(r) for r in found.collect()), key=str)


def corpus():
    rng = random.Random(5)
    word = lambda: "".join(rng.choice("abé ") for _ in range(rng.randint(1, 9)))
    text = lambda n: " ".join(word() for _ in range(n))
    shared, long_shared = text(40), text(300)
    rows = [(i, text(rng.randint(1, 60))) for i in range(20)]
    rows += [(100 + i, text(20) + shared + text(rng.randint(0, 20))) for i in range(8)]
    rows += [(200 + i, long_shared[i * 7:] + shared) for i in range(4)]
    rows += [(300, "a" * 1000), (301, "ab" * 300), (302, ("x" * 57 + "y") * 12), (303, "a" * 99), (304, "a" * 100)]
    rows += [(400, None), (401, ""), (None, shared), (None, None), (50, long_shared), (50, long_shared)]
    rows += [(60, text(30) + long_shared), (60, long_shared)]
    return rows


def test_matches_brute_force(spark):
    rows = corpus()
    assert result(spark, rows) == brute(rows)


def test_crowded_names_give_the_same(spark):
    rows = corpus()
    assert result(spark, rows, hot=3) == brute(rows)


def test_a_long_region_counts_by_its_text(spark):
    # One region of one letter: few regions, much text.
    rows = [(1, "a" * 5000), (2, "a" * 4000 + "b"), (3, "c" * 150)]
    assert result(spark, rows, hot=10) == brute(rows)


def test_other_length(spark):
    rows = corpus()
    assert result(spark, rows, length=37) == brute(rows, 37)


def test_empty_table(spark):
    assert result(spark, []) == []


def test_text_longer_than_a_chunk(spark, monkeypatch):
    import hopdex.llm.suffix_dedup as module

    rng = random.Random(3)
    piece = "".join(rng.choice("abcdef") for _ in range(900))
    rows = [(1, piece * 3 + "a" * 700), (2, piece[100:700] + "zz" + piece)]
    monkeypatch.setattr(module, "CHUNK", 256)
    monkeypatch.setattr(module, "REGION", 64)
    from hopdex.llm.common import text_bytes  # noqa: F401
    data = np.frombuffer("".join(t for _, t in rows).encode(), np.uint8)
    ends = np.cumsum([len(t.encode()) for _, t in rows])
    names, starts, counts, _ = module._regions(data, ends, 100)
    covered = np.zeros(len(data), int)
    for start, count in zip(starts, counts, strict=True):
        covered[start: start + count] += 1
    expected = np.zeros(len(data), int)
    for end, size in zip(ends, np.diff(np.append(0, ends)), strict=True):
        expected[end - size: end - 99] = 1
    assert (covered == expected).all()
    assert len(names) == len(starts)


@pytest.mark.parametrize("letters", ["ab", "abcdefgh", "a"])
def test_two_stage_order(letters):
    rng = random.Random(len(letters))
    data = np.frombuffer("".join(rng.choice(letters) for _ in range(3000)).encode(), np.uint8)
    wanted = np.array(sorted(rng.sample(range(2900), 1500)))
    order = sort_suffixes(data, wanted, 100)
    raw = data.tobytes()
    strings = [raw[i: i + 100] for i in order]
    assert sorted(order) == list(wanted)
    groups = [s for s, before in zip(strings, [None, *strings], strict=False) if s != before]
    assert len(groups) == len(set(strings))  # equal strings stand together
    prefix = common_prefixes(data, order, 100)
    for one, two, common in zip(strings, strings[1:], prefix[1:], strict=False):
        real = next((i for i in range(100) if one[i: i + 1] != two[i: i + 1]), 100)
        assert common == real

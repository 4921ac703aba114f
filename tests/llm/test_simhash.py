import random
import re
from collections import Counter

import numpy as np
import pytest
import xxhash
from helpers import classes_of, documents

from hopdex.llm.simhash import bands_for, fingerprints, similar_fingerprints, tile_links


def brute_print(text):
    low = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    words = re.findall(r"[^\x20\x09-\x0D]+", low)
    grams = [" ".join(words[i: i + 4]) for i in range(max(1, len(words) - 3))] if words else []
    hashes = [xxhash.xxh64_intdigest(g.encode(), 42) for g in grams]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def brute(rows):
    prints = [brute_print(t) for _, t in rows]
    distinct = sorted(set(prints))
    root = classes_of(distinct, lambda a, b: bin(a ^ b).count("1") <= 4)
    smallest = {}
    for (doc, _), bits in zip(rows, prints, strict=True):
        if doc is not None:
            smallest[root[bits]] = min(doc, smallest.get(root[bits], doc))
    return Counter((doc, f"{bits:016x}", smallest.get(root[bits])) for (doc, _), bits in zip(rows, prints, strict=True))


def corpus(n=40):
    rng = random.Random(5)
    word = lambda: "".join(rng.choice("abcdeéABC.") for _ in range(rng.randint(1, 6)))
    rows = []
    for i in range(n):
        words = [word() for _ in range(rng.randint(200, 400))]
        rows.append((i, rng.choice([" ", "\n", " \t "]).join(words)))
        for k in range(i % 4):
            words[rng.randrange(len(words))] = word()
            rows.append((1000 + 10 * i + k, " ".join(words)))
    rows += [(500, None), (501, ""), (502, " \n\t"), (503, "one"), (504, "ONE"), (505, "one two three"), (506, "a b c d")]
    rows += [(507, "a b c d a b c d a b c d"), (None, "one"), (None, "nobody else"), (3, rows[0][1]), (3, rows[0][1])]
    return rows + [(508, " ".join(f"w{k % 70_000}" for k in range(140_000)))]


@pytest.mark.parametrize("tile, cell", [(1024, 2048), (2, 2048), (4, 1)])
def test_matches_brute_force(spark, tile, cell):
    """Small tiles make cells large, and small cells make more bands."""
    rows = corpus()
    found = similar_fingerprints(documents(spark, rows), tile=tile, cell=cell)
    assert found.columns == ["doc_id", "fingerprint", "component_id"]
    assert Counter(tuple(r) for r in found.collect()) == brute(rows)


def test_tiles_find_every_pair():
    rng = np.random.default_rng(3)
    bits = rng.integers(0, 2**63, 300, dtype=np.uint64)
    near = bits.copy()
    for _ in range(4):
        near ^= np.uint64(1) << rng.integers(0, 64, len(near)).astype(np.uint64)
    both = np.unique(np.concatenate([bits, near, bits[:50] ^ np.uint64(31)]))
    want = {(int(a), int(b)) for i, a in enumerate(both) for b in both[i + 1:] if int(a ^ b).bit_count() <= 4}
    for tile in (1, 7, 1000):
        pairs = [(int(both[a]), int(both[b])) for one, two in tile_links(both, np.full(len(both), 2), tile=tile)
                 for a, b in zip(one, two, strict=True)]
        assert len(pairs) == len(want) and {tuple(sorted(p)) for p in pairs} == want


def test_more_fingerprints_get_wider_keys():
    assert bands_for(100)[1] == 1 and bands_for(10**8)[1] == 2 and bands_for(10**10)[1] > 2
    assert bands_for(100)[0] == [0, 12, 25, 38, 51, 64]


def test_one_family_in_one_cell(spark):
    """Thousands of fingerprints that agree on every band but one: tiles of equal counts."""
    base = 0x0F0F_1234_5678_9ABC
    prints = sorted({base ^ (1 << a) ^ (1 << b) for a in range(13) for b in range(13) if a != b} | {base})
    from hopdex.llm.simhash import cells

    table = spark.createDataFrame([(p,) for p in prints], "bits long")
    rows = cells(table, len(prints), tile=8).collect()
    tasks = {}
    for r in rows:
        tasks.setdefault(r.task, []).append((r.bits, r.side))
    met = {(a, b) for group in tasks.values() for a, s in group for b, t in group if a < b and (s == 2 or s != t)}
    want = {(a, b) for a in prints for b in prints if a < b and (a ^ b).bit_count() <= 4}
    assert want <= met


def test_fingerprints_of_no_texts():
    assert len(fingerprints(np.zeros(0, np.uint8), np.zeros(1, np.int64))) == 0


def test_empty_table(spark):
    assert similar_fingerprints(documents(spark, [])).collect() == []

import math
import random

import numpy as np
import public_tokenizers
from helpers import documents, rows_of

from hopdex.llm.language_id import Lattice, fit, identify_languages, read_pieces, words_of

PATH = public_tokenizers.path("byte_bpe_50k.json")


def texts(language, count, seed):
    rng = random.Random(seed)
    stems = {"xx": ["tion", "ing", "the", "and"], "yy": ["heit", "ung", "der", "und"], "zz": ["ción", "los", "que", "ñas"]}
    return [" ".join("".join(rng.choice(stems[language]) for _ in range(rng.randint(1, 3))) for _ in range(rng.randint(3, 60)))
            for _ in range(count)]


def test_forward_sums_all_segmentations():
    pieces = [b"a", b"b", b"ab", b"ba", b"aba"]
    chance = np.array([[0.2, 0.1], [0.1, 0.3], [0.3, 0.2], [0.1, 0.1], [0.3, 0.3]])

    def brute(word, column):
        if not word:
            return 1.0
        return sum(chance[i, column] * brute(word[len(p):], column) for i, p in enumerate(pieces) if word.startswith(p))

    lattice = Lattice(pieces)
    for word in (b"a", b"ab", b"aba", b"ababa", b"bbaab"):
        parts = np.frombuffer(word, np.uint8)[None, :].astype(np.uint64)
        total = lattice.forward(parts, chance)[-1][0]
        assert np.allclose(total, [brute(word, 0), brute(word, 1)])
        # Expected uses: each letter is covered once.
        uses = lattice.expected(parts, np.ones(1), chance[:, 0])
        assert math.isclose(sum(u * len(p) for u, p in zip(uses, pieces, strict=True)), len(word))


def test_pieces_come_from_the_vocabulary():
    pieces = read_pieces(PATH)
    assert b" the" in pieces and b"tion" in pieces and all(len(p) <= 8 for p in pieces)
    assert {bytes([b]) for b in range(256)} <= set(pieces)


def test_held_out_accuracy(spark):
    rows = [(i * 3 + n, t, lang) for n, lang in enumerate(("xx", "yy", "zz")) for i, t in enumerate(texts(lang, 60, n))]
    truth = {r[0]: r[2] for r in rows}
    found = identify_languages(documents(spark, rows), PATH).collect()
    held = [r for r in found if r.held_out]
    assert 30 < len(held) < 90
    assert all(r.lang_pred == truth[r.doc_id] and 0.5 < r.score <= 1 for r in held)


def test_odd_rows(spark):
    rows = [(1, "the and tion", "xx"), (2, "der und heit", "yy"), (3, None, "xx"), (4, "", None), (5, "123 !?", "yy"),
            (None, "und der", None), (6, "the " * 20_000, "xx"), (6, "the " * 20_000, "xx"), (7, "ing" * 500, None)]
    train = documents(spark, rows[:2])
    found = rows_of(identify_languages(documents(spark, rows), PATH, train=train), "doc_id", "lang_pred")
    assert found == sorted([(1, "xx"), (2, "yy"), (3, "und"), (4, "und"), (5, "und"), (None, "yy"), (6, "xx"), (6, "xx"),
                            (7, "xx")], key=repr)
    nothing = identify_languages(documents(spark, rows), PATH, train=documents(spark, []))
    assert {(r.lang_pred, r.score) for r in nothing.collect()} == {("und", 0.0)}
    assert identify_languages(documents(spark, []), PATH).collect() == []


def test_model_needs_no_labels_of_a_text():
    model = fit([("xx", t) for t in texts("xx", 20, 8)] + [("zz", t) for t in texts("zz", 20, 9)], read_pieces(PATH))
    scores = model.score_texts(["los que ñas", "the and", ""])
    assert scores[0].argmax() == 1 and scores[1].argmax() == 0 and (scores[2] == 0).all()
    assert words_of("Ab1c d_E é!") == ["ab", "c", "d", "e", "é"]


def test_training_texts_are_whole_and_ranked_by_hash(spark):
    from hopdex.llm.language_id import training_sample
    rows = [(i, f"{i} " + "long " * 4_000, "xx") for i in range(30)] + [(100 + i, "same text", "yy") for i in range(500)]
    sample = training_sample(documents(spark, rows + [(None, "no language", None), (7, None, "xx")]), 10, 100_000)
    assert sum(lang == "xx" for lang, _ in sample) == 4 and sample.count(("yy", "same text")) == 1
    assert all(t.count("long") == 4_000 for lang, t in sample if lang == "xx")


def test_ties_go_to_the_first_language(spark):
    train = documents(spark, [(1, "same words here", "yy"), (2, "same words here", "xx")])
    found = identify_languages(documents(spark, [(3, "same words here", None)]), PATH, train=train).collect()
    assert [(r.lang_pred, r.score) for r in found] == [("xx", 0.5)]

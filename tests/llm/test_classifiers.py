import random

import numpy as np
import pyarrow as pa
import pytest
from helpers import documents

from hopdex.llm import common, quality_mil, toxicity
from hopdex.llm.common import text_bytes
from hopdex.llm.quality_mil import score_quality
from hopdex.llm.toxicity import score_toxicity

LABELS = "doc_id long, quality int, toxic int, text string"


def words(rng, count):
    return [rng.choice("stone river green cloud paper light window garden yellow music".split()) for _ in range(count)]


def make(count, bad, seed):
    rng, rows = random.Random(seed), []
    for i in range(count):
        label = rng.random() < 0.4
        rows.append((i, bad(rng, label), int(label)))
    return rows


def junk(rng, label):
    text = " ".join(words(rng, rng.randint(30, 300)))
    return text if label else text[: len(text) // 2] + " ".join(w.upper() + "###!!" for w in words(rng, 150))


def insult(rng, label):
    text = words(rng, rng.randint(40, 400))
    if label:
        at = rng.randrange(len(text))
        text[at:at] = ["you", rng.choice(["morxon", "morxish", "morxity", "blarg"])]
    return " ".join(text)


@pytest.mark.parametrize("score,column,bad", [(score_quality, "quality", junk), (score_toxicity, "toxic", insult)])
def test_held_out_accuracy(spark, score, column, bad):
    rows = make(400, bad, 3)
    truth = {r[0]: r[2] for r in rows}
    labels = spark.createDataFrame(
        [(i, x if column == "quality" else None, x if column == "toxic" else None, "") for i, _, x in rows]
        + [(None, 1, 1, ""), (9999, 1, 1, ""), (3, None, None, "")], LABELS)
    found = score(documents(spark, [(i, t) for i, t, _ in rows]), labels).collect()
    held = [r for r in found if r.held_out]
    assert len(found) == 400 and len(held) > 50
    right = sum(r.predicted == truth[r.doc_id] for r in held)
    assert right / len(held) > 0.93
    assert all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.5) for r in found)


@pytest.mark.parametrize("score", [score_quality, score_toxicity])
def test_odd_rows(spark, score):
    rows = [(1, None), (2, ""), (3, "a"), (3, "a"), (None, "b c"), (4, "\n \n"), (5, "x" * 300_000), (6, "word " * 50_000)]
    few = spark.createDataFrame([(1, 1, 1, ""), (2, 0, 0, ""), (3, 1, 0, ""), (4, 0, 1, "")], LABELS)
    found = score(documents(spark, rows), few).collect()
    assert len(found) == len(rows) and all(0 <= r.score <= 1 for r in found)
    assert len({r.score for r in found if r.doc_id == 3}) == 1
    none = spark.createDataFrame([], LABELS)
    assert {r.score for r in score(documents(spark, rows), none).collect()} == {0.5}
    assert score(documents(spark, []), few).collect() == []


def test_attention_gradients():
    rng = np.random.default_rng(0)
    model = quality_mil.Model()
    inputs = rng.normal(size=(7, quality_mil.FEATURES)).astype(np.float32) * 0.3
    counts, goal, even = np.array([3, 1, 3]), np.array([1.0, 0.0, 1.0], np.float32), np.ones(3, np.float32)

    def loss():
        logit = model.forward(inputs, counts)["logit"].astype(np.float64)
        return np.mean(np.log1p(np.exp(-logit)) * goal + np.log1p(np.exp(logit)) * (1 - goal))

    found = model.gradients(model.forward(inputs, counts), counts, goal, even)
    for name in ("attend", "tanh", "gate", "score", "encode0"):
        at = tuple(0 for _ in model.weights[name].shape)
        step = 1e-2
        model.weights[name][at] += step
        high = loss()
        model.weights[name][at] -= 2 * step
        low = loss()
        model.weights[name][at] += step
        assert abs((high - low) / (2 * step) - found[name][at]) < 2e-3


def test_recurrent_gradients():
    rng = np.random.default_rng(1)
    model = toxicity.Model()
    vectors = rng.normal(size=(5, toxicity.WIDTH)).astype(np.float32)
    places = np.array([[0, 1, 2, 3], [4, 4, -1, -1], [-1, -1, -1, -1]])
    weight = np.array([0.7, -0.4, 0.2])
    loss = lambda: float((model.forward(vectors, places)["logit"] * weight).sum())
    found, d_vectors = model.gradients(model.forward(vectors, places, keep=True), weight)
    step = 1e-2

    def slope(array, at):
        array[at] += step
        high = loss()
        array[at] -= 2 * step
        low = loss()
        array[at] += step
        return (high - low) / (2 * step)

    for name in model.weights:
        at = tuple(s // 2 for s in model.weights[name].shape)
        assert abs(slope(model.weights[name], at) - found[name][at]) < 2e-3, name
    for at in ((0, 0), (4, 3)):
        assert abs(slope(vectors, at) - d_vectors[at]) < 2e-3


def test_windows_cover_the_text_and_overlap():
    counts = np.array([0, 1, 32, 33, 100])
    places, number = toxicity.windows(counts)
    assert number.tolist() == [1, 1, 1, 2, 6]
    first = np.cumsum(counts) - counts
    row = np.repeat(np.arange(5), number)
    for text in range(5):
        seen = places[row == text]
        assert set(seen[seen >= 0]) == set(range(first[text], first[text] + counts[text]))


@pytest.mark.parametrize("model", [toxicity.Model(), quality_mil.Model()])
def test_slices_do_not_change_scores(model):
    def score(texts):
        some = text_bytes(pa.array(texts))
        return model.score(*some) if isinstance(model, toxicity.Model) else model.score(*quality_mil.passages(*some))

    texts = ["one two three", "", "four " * 190, "é x", "...", ""]
    single = np.concatenate([score([t]) for t in texts])
    assert np.allclose(score(texts), single, atol=1e-5)


def test_word_hashes_in_parts_equal_hashes_at_once(monkeypatch):
    data = np.frombuffer(b"  one two  three four" * 20 + b" " * 50 + b"end", np.uint8)
    starts, ends = common.word_spans(data, np.array([0, len(data)]), ~np.isin(np.arange(256), [32]))
    whole = common.span_hashes(data.astype(np.uint64), starts, ends)
    monkeypatch.setattr(common, "SLICE_BYTES", 16)
    assert (common.word_hashes(data, starts, ends) == whole).all()


def test_samples_hold_whole_texts(spark):
    """The only sign of a class stands behind 20,000 characters; the bound drops rows, not parts of texts."""
    from pyspark.sql import functions as F

    from hopdex.llm.common import labelled_sample
    rows = [(i, "word " * 5_000 + ("poison" if i % 2 else "honey")) for i in range(40)]
    labels = spark.createDataFrame([(i, i % 2) for i in range(40)] + [(0, None), (None, 1)], "doc_id long, toxic int")
    docs = documents(spark, rows + [(41, None)])
    sample = labelled_sample(docs, labels, "toxic", F.col("doc_id") % 5 == 0, 10, 150_000)
    assert [sum(label == own for _, label in sample) for own in (0, 1)] == [5, 5]
    assert all(text.endswith("poison" if label else "honey") for text, label in sample)
    assert len(labelled_sample(docs, labels, "toxic", F.lit(False), 7, 10**9)) == 14
    assert labelled_sample(docs, labels, "toxic", F.lit(True), 7, 10**9) == []

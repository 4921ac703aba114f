"""Quality by attention-based multiple-instance learning.

A document is a bag of passages and only the bag has a label. Every passage is
encoded; gated attention, learned from the document labels, weighs the passages; the
weighted sum of their codes is scored.
"""

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from hopdex.llm.common import Adam, labelled_sample, sigmoid, slices, text_bytes, third, word_hashes, word_spans

PASSAGE = 512  # bytes
SAMPLE_PER_CLASS, SAMPLE_BYTES = 1_500, 8_000_000
CODE, ATTENTION, EPOCHS, BATCH, RATE = 24, 12, 30, 64, 0.01
_PAIRS = 128  # buckets of the byte-pair histogram


def _byte_classes() -> np.ndarray:
    out = np.full(256, 11)
    for number, members in enumerate(
        ["abcdefghijklmnopqrstuvwxyz", "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "0123456789", " ", "\n", ".,;:", "!?",
         "#*$%&<>", "|", "'\"()[]-", "\t\r\x0b\x0c"]
    ):
        out[[ord(c) for c in members]] = number
    out[128:] = 12
    return out


_CLASS, _CLASSES = _byte_classes(), 13
_WORD_BYTE = ~np.isin(np.arange(256), [32, 9, 10, 11, 12, 13])
_SHARES = _CLASSES + 4
FEATURES = _SHARES + _PAIRS


def passages(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(features of every passage, passages of every text); an empty text has one."""
    sizes = np.diff(offsets)
    count = np.maximum(1, -(-sizes // PASSAGE))
    first = np.concatenate([[0], np.cumsum(count)])
    place = np.arange(len(data)) - np.repeat(offsets[:-1], sizes)
    of_byte = np.repeat(first[:-1], sizes) + place // PASSAGE
    total = int(first[-1])
    length = np.bincount(of_byte, minlength=total).astype(np.float32)
    some = np.maximum(length, 1)
    out = np.zeros((total, FEATURES), np.float32)
    classes = np.bincount(of_byte * _CLASSES + _CLASS[data], minlength=total * _CLASSES)
    out[:, :_CLASSES] = classes.reshape(total, _CLASSES) / some[:, None]
    starts, ends = word_spans(data, offsets, _WORD_BYTE)
    if len(starts):
        hashes, of_word = word_hashes(data, starts, ends), of_byte[starts]
        words = np.bincount(of_word, minlength=total).astype(np.float32)
        text = np.searchsorted(offsets[1:], starts, side="right")
        same = np.zeros(len(starts), bool)
        same[1:] = (hashes[1:] == hashes[:-1]) & (text[1:] == text[:-1])
        # Distinct words of a passage: a stable order by hash, then by passage.
        by = np.lexsort((hashes, of_word))
        new = np.ones(len(by), bool)
        new[1:] = (hashes[by][1:] != hashes[by][:-1]) | (of_word[by][1:] != of_word[by][:-1])
        any_word = np.maximum(words, 1)
        out[:, _CLASSES] = np.bincount(of_word, same, total) / any_word
        out[:, _CLASSES + 1] = np.bincount(of_word[by], new, total) / any_word
        out[:, _CLASSES + 2] = np.bincount(of_word, ends - starts, total) / any_word / 10
    out[:, _CLASSES + 3] = np.log1p(length) / 6
    if len(data) > 1:
        low = data | 32  # the case is a feature of its own
        inside = np.ones(len(data) - 1, bool)  # both bytes are of one text
        ends = offsets[1:-1]
        inside[ends[(ends > 0) & (ends < len(data))] - 1] = False
        pair = (low[:-1].astype(np.int64) * 31 + low[1:] * 7) % _PAIRS
        pairs = np.bincount((of_byte[:-1] * _PAIRS + pair)[inside], minlength=total * _PAIRS)
        out[:, _SHARES:] = np.sqrt(pairs.reshape(total, _PAIRS) / some[:, None])
    return out, count


class Model:
    """tanh encoder, gated attention and a logistic score."""

    def __init__(self, seed: int = 1):
        rng = np.random.default_rng(seed)
        draw = lambda *shape: (rng.normal(size=shape) / np.sqrt(shape[0])).astype(np.float32)
        self.mean, self.scale = np.zeros(FEATURES, np.float32), np.ones(FEATURES, np.float32)
        self.weights = {
            "encode": draw(FEATURES, CODE), "encode0": np.zeros(CODE, np.float32),
            "tanh": draw(CODE, ATTENTION), "gate": draw(CODE, ATTENTION), "attend": draw(ATTENTION),
            "score": draw(CODE), "score0": np.zeros(1, np.float32),
        }

    def forward(self, inputs: np.ndarray, counts: np.ndarray) -> dict:
        """Bags stand one after another; `counts` has their sizes, one at least."""
        w = self.weights
        x = (inputs - self.mean) / self.scale
        code = np.tanh(x @ w["encode"] + w["encode0"])
        left, gate = np.tanh(code @ w["tanh"]), sigmoid(code @ w["gate"])
        raw = (left * gate) @ w["attend"]
        first = np.cumsum(counts) - counts
        top = np.maximum.reduceat(raw, first)
        weight = np.exp(raw - np.repeat(top, counts))
        weight /= np.repeat(np.add.reduceat(weight, first), counts)
        bag = np.add.reduceat(code * weight[:, None], first)
        return {"x": x, "code": code, "left": left, "gate": gate, "weight": weight, "bag": bag,
                "first": first, "logit": bag @ w["score"] + w["score0"][0]}

    def gradients(self, f: dict, counts: np.ndarray, labels: np.ndarray, importance: np.ndarray) -> dict:
        w = self.weights
        error = (sigmoid(f["logit"]) - labels) * importance / len(labels)
        of_bag = error[:, None] * w["score"]
        spread = np.repeat(of_bag, counts, axis=0)
        along = (f["code"] * spread).sum(axis=1)
        mean = np.repeat(np.add.reduceat(f["weight"] * along, f["first"]), counts)
        raw = (f["weight"] * (along - mean))[:, None]
        inner = raw * w["attend"]
        left = inner * f["gate"] * (1 - f["left"] ** 2)
        gate = inner * f["left"] * f["gate"] * (1 - f["gate"])
        code = spread * f["weight"][:, None] + left @ w["tanh"].T + gate @ w["gate"].T
        code *= 1 - f["code"] ** 2
        out = {
            "encode": f["x"].T @ code, "encode0": code.sum(0), "tanh": f["code"].T @ left,
            "gate": f["code"].T @ gate, "attend": ((f["left"] * f["gate"]) * raw).sum(0),
            "score": f["bag"].T @ error, "score0": np.array([error.sum()]),
        }
        out["encode"] = out["encode"] + 1e-4 * w["encode"]
        return out

    def score(self, inputs: np.ndarray, counts: np.ndarray) -> np.ndarray:
        return sigmoid(self.forward(inputs, counts)["logit"].astype(np.float64))


def fit(sample: list[tuple[str, int]], epochs: int = EPOCHS, seed: int = 1) -> Model:
    """Train on (text, label) pairs; both classes weigh the same."""
    model = Model(seed)
    labels = np.array([label for _, label in sample], np.float32)
    if len(set(labels.tolist())) < 2:  # nothing to tell apart: the only label seen, or one half
        model.weights["score"][:] = 0
        model.weights["score0"][:] = 0 if not len(labels) else 4 * (2 * labels[0] - 1)
        return model
    texts = pa.record_batch({"text": pa.array([text for text, _ in sample], pa.string())})
    parts = [passages(*text_bytes(part.column("text"))) for part in slices([texts])]
    inputs, counts = (np.concatenate(arrays) for arrays in zip(*parts, strict=True))
    model.mean, model.scale = inputs.mean(0), inputs.std(0) + 0.02
    first = np.cumsum(counts) - counts
    share = labels.mean()
    importance = np.where(labels == 1, 0.5 / share, 0.5 / (1 - share)).astype(np.float32)
    rng, adam = np.random.default_rng(seed), Adam(model.weights, RATE)
    for epoch in range(epochs):
        adam.rate = RATE * (1 - 0.9 * epoch / epochs)
        order = rng.permutation(len(labels))
        for at in range(0, len(order), BATCH):
            some = order[at: at + BATCH]
            rows = np.concatenate([np.arange(first[i], first[i] + counts[i]) for i in some])
            f = model.forward(inputs[rows], counts[some])
            adam.step(model.gradients(f, counts[some], labels[some], importance[some]))
    return model


def _score(model):
    def run(batches):
        for batch in slices(batches):
            inputs, counts = passages(*text_bytes(batch.column("text")))
            score = model.value.score(inputs, counts)
            yield pa.record_batch({
                "doc_id": batch.column("doc_id"), "held_out": batch.column("held_out"),
                "score": score, "predicted": (score >= 0.5).astype(np.int32),
            })
    return run


def score_quality(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """The probability that a document has label 1, from its whole text.

    Learns from the labels of rows whose crc32 of doc_id modulo 3 is not 1, a sample of
    at most SAMPLE_PER_CLASS whole documents and SAMPLE_BYTES bytes a class. Returns doc_id, held_out (that
    remainder is 1), score and predicted (1 if score >= 0.5). Null and empty texts
    are a bag of one empty passage; null labels and label ids are not learned from;
    without any label all scores are 0.5. A repeated row gets the same score; other
    columns are ignored; an empty table gives none. Needs no shuffle of texts.
    """
    held_out = third(F.col("doc_id"), 3) == 1
    sample = labelled_sample(docs, labels, "quality", held_out, SAMPLE_PER_CLASS, SAMPLE_BYTES)
    model = docs.sparkSession.sparkContext.broadcast(fit(sample))
    return docs.select("doc_id", "text", held_out.alias("held_out")).mapInArrow(
        _score(model), "doc_id long, held_out boolean, score double, predicted int"
    )

"""Toxicity by a bidirectional gated recurrent network with attention pooling.

A text is a row of words; a word enters as the sum of a word vector and the mean of
the vectors of its character trigrams. Windows of WINDOW words that overlap by half
cover the whole text. The network reads each window in both directions, attention
pools its states, and the highest window decides about the text. Forward and backward
passes are written in numpy.
"""

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from hopdex.llm.common import (
    Adam, labelled_sample, mix, sigmoid, slices, spans, text_bytes, third, word_hashes, word_spans)

WINDOW, STRIDE = 32, 16
WORDS, GRAMS = 1 << 15, 1 << 15  # buckets of the two tables of vectors
WIDTH, STATE = 12, 10
SAMPLE_PER_CLASS, SAMPLE_BYTES = 2_000, 8_000_000
EPOCHS, BATCH, RATE = 8, 128, 0.01
_PAD = 0

_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
_WORD_BYTE = np.zeros(256, bool)
_WORD_BYTE[[*range(48, 58), *range(65, 91), *range(97, 123), *range(128, 256)]] = True


class Words:
    """The words of a slice of texts: distinct ones with their table rows, and their sequence."""

    def __init__(self, data: np.ndarray, offsets: np.ndarray):
        low = _LOWER[data]
        starts, ends = word_spans(low, offsets, _WORD_BYTE)
        hashes = word_hashes(low, starts, ends)
        distinct, first, self.sequence = np.unique(hashes, return_index=True, return_inverse=True)
        text = np.searchsorted(offsets[1:], starts, side="right")
        self.counts = np.bincount(text, minlength=len(offsets) - 1)
        self.rows = (distinct % np.uint64(WORDS)).astype(np.int64)
        # Trigrams of ^word$: bytes padded on both sides.
        sizes = (ends - starts)[first]
        at = np.cumsum(sizes + 2) - (sizes + 2)
        padded = np.full(int((sizes + 2).sum()), 1, np.uint64)
        if len(first):
            inner = np.arange(sizes.sum()) - np.repeat(np.cumsum(sizes) - sizes, sizes)
            padded[np.repeat(at + 1, sizes) + inner] = low[np.repeat(starts[first], sizes) + inner]
        grams = np.zeros(0, np.int64)
        if len(padded) > 2:
            triple = (padded[:-2] << np.uint64(16)) | (padded[1:-1] << np.uint64(8)) | padded[2:]
            grams = (mix(triple) % np.uint64(GRAMS)).astype(np.int64)
        # The grams of word i are grams[at[i]: at[i] + sizes[i]].
        keep = np.repeat(at, sizes) + (np.arange(sizes.sum()) - np.repeat(np.cumsum(sizes) - sizes, sizes))
        self.grams, self.gram_counts = grams[keep], sizes


def windows(counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(word places of every window, windows of every text); -1 is padding.

    Windows begin every STRIDE words and cover each text to its end; a text without
    words has one empty window.
    """
    number = 1 + np.maximum(0, -(-(counts - WINDOW) // STRIDE))
    first = np.cumsum(counts) - counts
    row = np.repeat(np.arange(len(counts)), number)
    nth = np.arange(len(row)) - np.repeat(np.cumsum(number) - number, number)
    inside = nth[:, None] * STRIDE + np.arange(WINDOW)
    return np.where(inside < counts[row][:, None], first[row][:, None] + inside, -1), number


class Model:
    """Vectors, a GRU for each direction, attention and the output."""

    def __init__(self, seed: int = 1):
        rng = np.random.default_rng(seed)
        draw = lambda *shape: (rng.normal(size=shape) / np.sqrt(shape[0])).astype(np.float32)
        self.words = (rng.normal(size=(WORDS, WIDTH)) * 0.05).astype(np.float32)
        self.grams = (rng.normal(size=(GRAMS, WIDTH)) * 0.05).astype(np.float32)
        self.weights = {"attend": draw(2 * STATE), "out": draw(2 * STATE), "out0": np.zeros(1, np.float32)}
        for way in "fb":
            self.weights |= {
                f"in_{way}": draw(WIDTH, 3 * STATE), f"bias_{way}": np.zeros(3 * STATE, np.float32),
                f"state_{way}": draw(STATE, 3 * STATE),
            }
        self.slope, self.shift = 1.0, 0.0

    def vectors(self, words: Words) -> np.ndarray:
        """One vector for each distinct word."""
        if not len(words.rows):
            return np.zeros((0, WIDTH), np.float32)
        first = np.cumsum(words.gram_counts) - words.gram_counts
        out = np.add.reduceat(self.grams[words.grams], first) / words.gram_counts[:, None]
        return (out + self.words[words.rows]).astype(np.float32)

    def _read(self, way: str, inputs, places, alive, keep: bool):
        """States of one direction; `inputs` holds in-projections of distinct words."""
        recurrent = self.weights[f"state_{way}"]
        count, length = places.shape
        states = np.zeros((length + 1, count, STATE), np.float32)
        kept = []
        steps = range(length) if way == "f" else range(length - 1, -1, -1)
        before = states[length]
        for step in steps:
            given = inputs[places[:, step]]
            inner = before @ recurrent
            gates = sigmoid(given[:, : 2 * STATE] + inner[:, : 2 * STATE])
            update, reset = gates[:, :STATE], gates[:, STATE:]
            new = np.tanh(given[:, 2 * STATE:] + reset * inner[:, 2 * STATE:])
            change = np.where(alive[:, step, None], update, 0)
            states[step] = before + change * (new - before)
            if keep:
                kept.append((step, before, inner, update, reset, new))
            before = states[step]
        return states[:length], kept

    def forward(self, vectors: np.ndarray, places: np.ndarray, keep: bool = False) -> dict:
        """Logits of windows; `places` are rows of `vectors`, -1 where a window has ended."""
        alive = places >= 0
        f = {"alive": alive, "places": np.where(alive, places, len(vectors)), "vectors": vectors}
        padded = np.concatenate([vectors, np.zeros((1, WIDTH), np.float32)])
        states = []
        for way in "fb":
            inputs = padded @ self.weights[f"in_{way}"] + self.weights[f"bias_{way}"]
            seen, f[f"kept_{way}"] = self._read(way, inputs, f["places"], alive, keep)
            states.append(seen)
        f["states"] = both = np.concatenate(states, axis=2)
        raw = np.where(alive.T, both @ self.weights["attend"], -1e9)
        raw = np.exp(raw - raw.max(axis=0))
        f["weight"] = weight = raw / raw.sum(axis=0)
        f["pooled"] = np.einsum("ln,lnd->nd", weight, both) * alive.any(axis=1)[:, None]
        f["logit"] = f["pooled"] @ self.weights["out"] + self.weights["out0"][0]
        return f

    def gradients(self, f: dict, error: np.ndarray) -> tuple[dict, np.ndarray]:
        """Gradients of the weights and of the vectors, given those of the logits."""
        w, out = self.weights, {}
        error = error.astype(np.float32)
        out["out"], out["out0"] = f["pooled"].T @ error, np.array([error.sum()])
        pooled = error[:, None] * w["out"] * f["alive"].any(axis=1)[:, None]
        along = np.einsum("lnd,nd->ln", f["states"], pooled)
        raw = f["weight"] * (along - (f["weight"] * along).sum(axis=0))
        out["attend"] = np.einsum("ln,lnd->d", raw, f["states"])
        states = f["weight"][:, :, None] * pooled + raw[:, :, None] * w["attend"]
        padded = np.concatenate([f["vectors"], np.zeros((1, WIDTH), np.float32)])
        d_vectors = np.zeros_like(padded)
        for nth, way in enumerate("fb"):
            part = states[:, :, nth * STATE: (nth + 1) * STATE]
            recurrent = w[f"state_{way}"]
            d_inputs = np.zeros((len(padded), 3 * STATE), np.float32)
            d_recurrent = np.zeros_like(recurrent)
            carry = np.zeros_like(part[0])
            for step, before, inner, update, reset, new in reversed(f[f"kept_{way}"]):
                d_state = carry + part[step]
                change = np.where(f["alive"][:, step, None], update, 0)
                d_new = d_state * change * (1 - new**2)
                d_update = np.where(f["alive"][:, step, None], d_state * (new - before), 0)
                d_update = d_update * update * (1 - update)
                d_reset = d_new * inner[:, 2 * STATE:] * reset * (1 - reset)
                d_inner = np.concatenate([d_update, d_reset, d_new * reset], axis=1)
                d_given = np.concatenate([d_update, d_reset, d_new], axis=1)
                carry = d_state * (1 - change) + d_inner @ recurrent.T
                d_recurrent += before.T @ d_inner
                np.add.at(d_inputs, f["places"][:, step], d_given)
            out[f"state_{way}"] = d_recurrent
            out[f"in_{way}"] = padded.T @ d_inputs
            out[f"bias_{way}"] = d_inputs.sum(axis=0)
            d_vectors += d_inputs @ w[f"in_{way}"].T
        return out, d_vectors[:-1]

    def window_logits(self, words: Words) -> tuple[np.ndarray, np.ndarray]:
        """(logits of all windows, windows of every text)."""
        places, number = windows(words.counts)
        vectors = self.vectors(words)
        logits = [np.zeros(0, np.float32)]
        for at in range(0, len(places), 16_384):
            some = places[at: at + 16_384]
            known = np.where(some >= 0, words.sequence[some] if len(words.sequence) else -1, -1)
            logits.append(self.forward(vectors, known)["logit"])
        return np.concatenate(logits), number

    def score(self, data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
        """Probability of every text: its highest window, calibrated."""
        words = Words(data, offsets)
        if not len(words.counts):
            return np.zeros(0)
        logits, number = self.window_logits(words)
        top = np.maximum.reduceat(logits, np.cumsum(number) - number).astype(np.float64)
        return sigmoid(self.slope * top + self.shift)


def _start(model: Model, words: Words, labels: np.ndarray) -> None:
    """Let one coordinate of the vectors begin as the log odds of words and trigrams."""
    share = (labels.sum() + 1) / (len(labels) + 2)
    seen = {"words": np.zeros((2, WORDS)), "grams": np.zeros((2, GRAMS))}  # texts of each label
    first, ends = np.cumsum(words.gram_counts) - words.gram_counts, np.cumsum(words.counts)
    for text, label in enumerate(labels.tolist()):
        some = np.unique(words.sequence[ends[text] - words.counts[text]: ends[text]])
        grams = words.grams[spans(first[some], words.gram_counts[some])]
        seen["words"][int(label), np.unique(words.rows[some])] += 1
        seen["grams"][int(label), np.unique(grams)] += 1
    for table, (good, bad) in (("words", seen["words"]), ("grams", seen["grams"])):
        odds = np.log((bad + 2 * share) / (good + 2 * (1 - share))) - np.log(share / (1 - share))
        getattr(model, table)[:, 0] = odds


def fit(sample: list[tuple[str, int]], epochs: int = EPOCHS, seed: int = 1) -> Model:
    """Train on (text, label) pairs.

    Only texts have labels. In each round the highest windows of a text under the
    present network stand for it, together with one other window of a clean text.
    """
    model = Model(seed)
    labels = np.array([label for _, label in sample], np.float32)
    if len(set(labels.tolist())) < 2:  # nothing to tell apart
        model.slope, model.shift = 0.0, 0.0 if not len(labels) else 4.0 * (2 * labels[0] - 1)
        return model
    rng = np.random.default_rng(seed)
    check = np.zeros(len(labels), bool)  # a fifth of the sample only calibrates
    if len(labels) >= 50:
        check[rng.permutation(len(labels))[: len(labels) // 5]] = True
    text_of = lambda some: text_bytes(pa.array([sample[i][0] for i in some], pa.string()))
    train = np.flatnonzero(~check)
    words = Words(*text_of(train))
    marks = labels[train]
    _start(model, words, marks)
    places, number = windows(words.counts)
    known = np.where(places >= 0, words.sequence[places], -1).astype(np.int32)
    del places
    owner = np.repeat(np.arange(len(marks)), number)
    odds = np.concatenate([model.vectors(words)[:, 0], [-9.0]])
    level = np.concatenate([
        np.sort(odds[known[at: at + 16_384]], axis=1)[:, -2:].sum(axis=1) for at in range(0, len(known), 16_384)])
    adam = Adam(model.weights, RATE)
    for epoch in range(epochs):
        adam.rate = RATE * (1 - 0.8 * epoch / epochs)
        by = np.lexsort((-level, owner))
        nth = np.arange(len(by)) - np.repeat(np.cumsum(number) - number, number)
        toxic = marks[owner[by]] == 1
        chosen = by[np.where(toxic, nth < 1, nth < 2)]
        other = rng.integers(0, len(owner), len(marks) // 2)
        chosen = np.concatenate([chosen, other[marks[owner[other]] == 0]])
        goal = marks[owner[chosen]]
        share = goal.mean()
        importance = np.where(goal == 1, 0.5 / share, 0.5 / (1 - share)).astype(np.float32)
        order = rng.permutation(len(chosen))
        vectors = model.vectors(words)
        for at in range(0, len(order), BATCH):
            some = order[at: at + BATCH]
            used, inverse = np.unique(known[chosen[some]], return_inverse=True)
            local = np.where(used < 0, -1, np.arange(len(used)) - (used[0] < 0))
            used = used[used >= 0]
            f = model.forward(vectors[used], local[inverse.reshape(len(some), WINDOW)], keep=True)
            error = (sigmoid(f["logit"]) - goal[some]) * importance[some] / len(some)
            found, d_vectors = model.gradients(f, error)
            adam.step(found)
            _learn_vectors(model, words, used, d_vectors, adam.rate * 4)
            vectors[used] = model.vectors(_only(words, used))
        level, _ = model.window_logits(words)
    _calibrate(model, text_of, labels, check if check.any() else ~check)
    return model


def _only(words: Words, some: np.ndarray) -> Words:
    """The chosen distinct words alone."""
    out = object.__new__(Words)
    first = np.cumsum(words.gram_counts) - words.gram_counts
    sizes = words.gram_counts[some]
    at = np.repeat(first[some], sizes) + (np.arange(sizes.sum()) - np.repeat(np.cumsum(sizes) - sizes, sizes))
    out.rows, out.grams, out.gram_counts = words.rows[some], words.grams[at], sizes
    return out


def _learn_vectors(model: Model, words: Words, used: np.ndarray, change: np.ndarray, rate: float) -> None:
    """Normalised gradient steps on the table rows of the words in a batch."""
    part = _only(words, used)
    size = np.sqrt((change**2).mean()) + 1e-8
    step = np.clip(change / size, -3, 3) * rate
    np.add.at(model.words, part.rows, -step)
    share = np.repeat(step / part.gram_counts[:, None], part.gram_counts, axis=0)
    np.add.at(model.grams, part.grams, -share)


def _calibrate(model: Model, text_of, labels: np.ndarray, check: np.ndarray) -> None:
    """Fit slope and shift of the highest windows' logits by balanced logistic regression."""
    some = np.flatnonzero(check)
    words = Words(*text_of(some))
    logits, number = model.window_logits(words)
    top = np.maximum.reduceat(logits, np.cumsum(number) - number).astype(np.float64)
    goal = labels[some].astype(np.float64)
    if not 0 < goal.mean() < 1:
        return
    weight = np.where(goal == 1, 0.5 / goal.mean(), 0.5 / (1 - goal.mean()))
    scale, middle = top.std() + 1e-6, top.mean()
    x, slope, shift = (top - middle) / scale, 1.0, 0.0
    for _ in range(500):
        error = (sigmoid(slope * x + shift) - goal) * weight / len(goal)
        slope -= 2.0 * ((error * x).sum() + 1e-3 * slope)
        shift -= 2.0 * error.sum()
    model.slope, model.shift = slope / scale, shift - slope * middle / scale


def _score(model):
    def run(batches):
        for batch in slices(batches):
            score = model.value.score(*text_bytes(batch.column("text")))
            yield pa.record_batch({
                "doc_id": batch.column("doc_id"), "held_out": batch.column("held_out"),
                "score": score, "predicted": (score >= 0.5).astype(np.int32),
            })
    return run


def score_toxicity(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """The probability that a document is toxic, from all windows of its whole text.

    Learns from the labels of rows whose crc32 of doc_id modulo 5 is not 0, a sample of
    at most SAMPLE_PER_CLASS whole documents and SAMPLE_BYTES bytes a class. Returns doc_id, held_out (that
    remainder is 0), score and predicted (1 if score >= 0.5). Null and empty texts are
    one empty window; null labels and label ids are not learned from; without any
    label all scores are 0.5. A repeated row gets the same score; other columns are
    ignored; an empty table gives none. Needs no shuffle of texts.
    """
    held_out = third(F.col("doc_id"), 5) == 0
    sample = labelled_sample(docs, labels, "toxic", held_out, SAMPLE_PER_CLASS, SAMPLE_BYTES)
    model = docs.sparkSession.sparkContext.broadcast(fit(sample))
    return docs.select("doc_id", "text", held_out.alias("held_out")).mapInArrow(
        _score(model), "doc_id long, held_out boolean, score double, predicted int"
    )

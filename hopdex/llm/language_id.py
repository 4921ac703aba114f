"""Language identification by unigram pieces, summed over all segmentations.

Each language has a probability for every piece of a fixed public vocabulary. The
probability of a word is the sum over all ways to cut it into pieces, which the
forward algorithm computes; a text is the product of its words. The piece
probabilities are fitted by expectation maximisation, also over all segmentations.
"""

import json
import re

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from hopdex.llm.bpe import _byte_letters
from hopdex.llm.common import slices, smallest_hashes, texts_within, third
from hopdex.session import stage

# Pieces have at most this many bytes, so that one fits a 64-bit number.
LONGEST = 8
# A word is scored in parts of this many bytes, the blank before it included.
PART = 32
# Training takes at most this many texts of a language, and of each so many characters.
SAMPLE_TEXTS, SAMPLE_BYTES = 300, 2_000_000
ROUNDS = 4
_WORD = re.compile(r"[^\W\d_]+")
UNKNOWN = "und"


def read_pieces(path: str) -> list[bytes]:
    """The pieces of a public byte-level vocabulary that words of letters can hold."""
    with open(path, encoding="utf-8") as file:
        tokens = json.load(file)["model"]["vocab"]
    letters, found = _byte_letters(), set()
    for token in tokens:
        raw = bytes(letters[c] for c in token)
        body = raw.removeprefix(b" ")
        fits = 1 < len(raw) <= LONGEST and body == body.lower()
        if fits and not re.search(rb"[\x00-`{-\x7f]", body):
            found.add(raw)
    return sorted(found | {bytes([b]) for b in range(256)})


def words_of(text: str) -> list[str]:
    return _WORD.findall(text.lower())


def _keys(parts: np.ndarray, end: int, size: int) -> np.ndarray:
    """Number of the bytes [end - size, end) of all rows."""
    key = np.zeros(len(parts), np.uint64)
    for at in range(end - size, end):
        key = (key << np.uint64(8)) | parts[:, at]
    return key


class Lattice:
    """Looks up which pieces end where in many words of one length."""

    def __init__(self, pieces: list[bytes]):
        sizes = np.array([len(p) for p in pieces])
        values = np.array([int.from_bytes(p, "big") for p in pieces], np.uint64)
        self.numbers, self.values, self.count = {}, {}, len(pieces)
        for size in range(1, LONGEST + 1):
            of = np.flatnonzero(sizes == size)
            by = np.argsort(values[of])
            self.values[size], self.numbers[size] = values[of][by], of[by]

    def ending(self, parts: np.ndarray, end: int, size: int) -> tuple[np.ndarray, np.ndarray]:
        """(rows, piece numbers) of the pieces of this size that end at `end`."""
        values = self.values[size]
        if not len(values):
            return np.zeros(0, np.int64), np.zeros(0, np.int64)
        key = _keys(parts, end, size)
        at = np.minimum(np.searchsorted(values, key), len(values) - 1)
        rows = np.flatnonzero(values[at] == key)
        return rows, self.numbers[size][at[rows]]

    def forward(self, parts: np.ndarray, chance: np.ndarray) -> np.ndarray:
        """alpha[end, row, language]: probability of the first `end` bytes, over all cuts."""
        count, length = parts.shape
        alpha = np.zeros((length + 1, count, chance.shape[1]))
        alpha[0] = 1.0
        for end in range(1, length + 1):
            for size in range(1, min(end, LONGEST) + 1):
                rows, number = self.ending(parts, end, size)
                if len(rows) == count:
                    alpha[end] += alpha[end - size] * chance[number]
                elif len(rows):
                    alpha[end, rows] += alpha[end - size, rows] * chance[number]
        return alpha

    def expected(self, parts: np.ndarray, weights: np.ndarray, chance: np.ndarray) -> np.ndarray:
        """Expected uses of every piece in the weighted words, for one language."""
        count, length = parts.shape
        alpha = self.forward(parts, chance[:, None])[:, :, 0]
        beta = np.zeros_like(alpha)
        beta[length] = 1.0
        uses = np.zeros(self.count)
        scale = weights / alpha[length]
        for end in range(length, 0, -1):
            for size in range(1, min(end, LONGEST) + 1):
                rows, number = self.ending(parts, end, size)
                flow = beta[end, rows] * chance[number]
                beta[end - size, rows] += flow
                uses += np.bincount(number, alpha[end - size, rows] * flow * scale[rows], self.count)
        return uses


def _by_length(words: list[bytes]):
    """(places, bytes as a matrix) for each length; words are cut into parts first."""
    cut = [(i, w[at: at + PART]) for i, w in enumerate(words) for at in range(0, len(w), PART)]
    sizes = np.array([len(w) for _, w in cut], np.int64)
    place = np.array([i for i, _ in cut], np.int64)
    for size in np.unique(sizes):
        of = np.flatnonzero(sizes == size)
        joined = b"".join([cut[i][1] for i in of])
        yield place[of], np.frombuffer(joined, np.uint8).reshape(len(of), size).astype(np.uint64)


class Model:
    """Languages, pieces and their probabilities."""

    def __init__(self, languages: list[str], pieces: list[bytes], chance: np.ndarray):
        self.languages, self.lattice, self.chance = languages, Lattice(pieces), chance

    def word_scores(self, words: list[str]) -> np.ndarray:
        """Log probability of every word in every language, summed over all segmentations."""
        out = np.zeros((len(words), len(self.languages)))
        for place, parts in _by_length([b" " + w.encode() for w in words]):
            for at in range(0, len(place), 50_000):
                some = parts[at: at + 50_000]
                total = np.log(self.lattice.forward(some, self.chance)[-1])
                np.add.at(out, place[at: at + 50_000], total)
        return out

    def score_texts(self, texts: list[str]) -> np.ndarray:
        """Log probability of every text; each distinct word is looked at once."""
        split = [words_of(t) for t in texts]
        counts = [len(s) for s in split]
        coded = pa.array([w for s in split for w in s], pa.string()).dictionary_encode()
        words = self.word_scores(coded.dictionary.to_pylist())
        out = np.zeros((len(texts), len(self.languages)))
        if len(coded):
            row = np.repeat(np.arange(len(texts)), counts)
            code = coded.indices.to_numpy()
            for language in range(len(self.languages)):
                out[:, language] = np.bincount(row, words[code, language], len(texts))
        return out


def fit(texts: list[tuple[str, str]], pieces: list[bytes], rounds: int = ROUNDS) -> Model:
    """Fit piece probabilities to (language, text) pairs."""
    languages = sorted({lang for lang, _ in texts})
    lattice = Lattice(pieces)
    columns = []
    for language in languages:
        seen: dict[str, int] = {}
        for lang, text in texts:
            if lang == language:
                for word in words_of(text):
                    seen[word] = seen.get(word, 0) + 1
        weights = np.array(list(seen.values()), float)
        groups = list(_by_length([b" " + w.encode() for w in seen]))
        chance = np.full(len(pieces), 1.0 / len(pieces))
        for _ in range(rounds):
            uses = sum((lattice.expected(p, weights[i], chance) for i, p in groups), np.zeros(len(pieces)))
            chance = (uses + 0.01) / (uses.sum() + 0.01 * len(pieces))
        columns.append(chance)
    chance = np.stack(columns, axis=1) if columns else np.zeros((len(pieces), 0))
    # A piece that no language uses tells nothing; single bytes stay, so all words can be cut.
    used = np.array([len(p) == 1 for p in pieces])
    if columns:
        used |= chance.max(axis=1) > 2 * chance.min(axis=1)
    return Model(languages, [p for p, u in zip(pieces, used, strict=True) if u], chance[used])


def training_sample(docs: DataFrame, most: int = SAMPLE_TEXTS, most_bytes: int = SAMPLE_BYTES) -> list[tuple[str, str]]:
    """Whole (lang, text) pairs: at most `most` of a language, and `most_bytes` bytes of text.

    Those with the smallest hashes of their texts, equal texts once. Only hashes are
    ranked; the texts of the chosen ones are fetched afterwards.
    """
    known = docs.filter("lang is not null and text is not null").select("lang", "text", F.xxhash64("text").alias("h"))
    hashes = known.groupBy("lang", "h").agg(F.max(F.octet_length("text")).alias("size"))
    chosen = texts_within(smallest_hashes(stage(hashes, "hashes"), "lang", most).collect(), "lang", most_bytes)
    # As Arrow: a list of rows would start further Python workers, beside those of the next steps.
    picked = docs.sparkSession.createDataFrame(pa.table({
        "lang": pa.array([r.lang for r in chosen], pa.string()), "h": pa.array([r.h for r in chosen], pa.int64())}))
    texts = known.join(F.broadcast(picked), ["lang", "h"]).groupBy("lang", "h").agg(F.min("text").alias("text"))
    return [(r.lang, r.text) for r in texts.orderBy("lang", "text").collect()]


def _predict(model, rest):
    def run(batches):
        for batch in slices(batches):
            texts = [t or "" for t in batch.column("text").to_pylist()]
            scores = model.value.score_texts(texts)
            best, sure = [UNKNOWN] * len(texts), np.zeros(len(texts))
            known = batch.column("has_letter").to_pylist()
            if scores.shape[1]:
                top = scores.argmax(axis=1)
                chances = np.exp(scores - scores.max(axis=1, keepdims=True))
                sure = np.where(known, 1 / chances.sum(axis=1), 0.0)
                best = [model.value.languages[t] if k else UNKNOWN for t, k in zip(top, known, strict=True)]
            yield pa.record_batch({
                "doc_id": batch.column("doc_id"), "held_out": batch.column("held_out"),
                "lang_pred": pa.array(best, pa.string()), "score": pa.array(sure, pa.float64()),
                **{name: batch.column(name) for name in rest},
            })
    return run


def identify_languages(docs: DataFrame, vocabulary: str, train: DataFrame | None = None,
                       rest: str | None = None) -> DataFrame:
    """The language of every document, from its text alone.

    Learns from `train` (default: the rows of `docs` whose crc32 of doc_id modulo 3 is
    not 1), a sample of SAMPLE_TEXTS whole texts and SAMPLE_BYTES bytes of each language at most. Returns doc_id,
    held_out (that remainder is 1), lang_pred and score, the probability of that
    language among those learned. `und` with score 0 if the text is null, empty or
    without a letter, or if nothing could be learned. A null lang is not learned
    from; a null id counts as the text 'null'; repeated rows get the same results; an
    empty table gives none. The column of `docs` that `rest` names is returned with the
    text; other columns are ignored. Needs no shuffle of texts.
    """
    held_out = third(F.col("doc_id"), 3) == 1
    pairs = training_sample(docs.filter(~held_out) if train is None else train)
    model = docs.sparkSession.sparkContext.broadcast(fit(pairs, read_pieces(vocabulary)))
    schema = T.StructType().add("doc_id", "long").add("held_out", "boolean").add("lang_pred", "string").add("score", "double")
    if rest:
        schema.add("text", "string").add("rest", docs.schema[rest].dataType)
    return docs.select(
        "doc_id", "text", held_out.alias("held_out"),
        F.coalesce(F.col("text").rlike(r"\p{L}"), F.lit(False)).alias("has_letter"),
        *([F.col(rest).alias("rest")] if rest else []),
    ).mapInArrow(_predict(model, ["text", "rest"] if rest else []), schema)

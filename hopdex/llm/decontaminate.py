"""Benchmark decontamination by pigeonhole edit matching.

An item that occurs in a text with at most k errors, and is split into k + 1 pieces,
leaves one piece without an error. So exact hits of pieces name all places to look
at, and Myers' bit-parallel algorithm computes the edit distance there.
"""

from collections import defaultdict

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from hopdex.llm.common import keyed, slices, spans, text_bytes

# Errors allowed, as a part of the characters of an item.
ERROR_RATE = 0.08
# Items and characters that one pass over the documents looks for; more take more passes.
PASS_ITEMS, PASS_CHARS = 50_000, 16_000_000
_KEY = 8
_FILTER_BITS = 22
# Items that a task keeps ready for Myers' algorithm.
_PATTERNS = 2_000
# Bytes of text that a task looks at together: several arrays of eight bytes for each of them.
_SLICE = 1 << 19
_MULTIPLY = np.uint64(0x9E3779B97F4A7C15)
_SPACES = np.isin(np.arange(256), [9, 10, 11, 12, 13, 32])


def normal(text: str) -> str:
    """Lower case, runs of ASCII white space as one blank."""
    return " ".join(p for p in _split_spaces(text.lower()) if p)


def _split_spaces(text: str) -> list[str]:
    for space in "\t\n\x0b\x0c\r":
        text = text.replace(space, " ")
    return text.split(" ")


def pieces_of(text: str, errors: int) -> list[tuple[int, str]]:
    """(offset, piece): `errors` + 1 pieces of about the same length."""
    cuts = [len(text) * n // (errors + 1) for n in range(errors + 2)]
    return [(a, text[a:b]) for a, b in zip(cuts, cuts[1:], strict=False)]


class Pattern:
    """An item, ready for Myers' algorithm."""

    def __init__(self, text: str, errors: int):
        self.text, self.errors = text, errors
        self.masks: dict[str, int] = {}
        for at, char in enumerate(text):
            self.masks[char] = self.masks.get(char, 0) | 1 << at

    def best(self, text: str) -> tuple[int, int]:
        """(edit distance, end) of the best occurrence inside `text`; of equals the first."""
        size, masks = len(self.text), self.masks
        full, top = (1 << size) - 1, 1 << (size - 1)
        plus, minus, score = full, 0, size
        best, end = size, 0
        for at, char in enumerate(text):
            equal = masks.get(char, 0)
            vertical = equal | minus
            across = (((equal & plus) + plus) ^ plus) | equal
            up = minus | (full & ~(across | plus))
            down = plus & across
            if up & top:
                score += 1
            elif down & top:
                score -= 1
                if score < best:
                    best, end = score, at + 1
            up = (up << 1) & full
            down = (down << 1) & full
            plus = down | (full & ~(vertical | up))
            minus = up & vertical
        return best, end

    def distance(self, text: str, most: int | None = None) -> int:
        """Edit distance of the whole item and the whole `text`; if it is above `most`, some number above that."""
        size, masks = len(self.text), self.masks
        full, top = (1 << size) - 1, 1 << (size - 1)
        plus, minus, score = full, 0, size
        # The distance after a character, less one for each that is to come, is no more than the last one.
        least = len(text) + (size + len(text) if most is None else most)
        for char in text:
            equal = masks.get(char, 0)
            vertical = equal | minus
            across = (((equal & plus) + plus) ^ plus) | equal
            up = minus | (full & ~(across | plus))
            down = plus & across
            if up & top:
                score += 1
            elif down & top:
                score -= 1
            least -= 1
            if score > least:
                return most + 1
            up = (up << 1 | 1) & full  # skipping a character of `text` costs one as well
            down = (down << 1) & full
            plus = down | (full & ~(vertical | up))
            minus = up & vertical
        return score


def _words(data: np.ndarray) -> np.ndarray:
    """The eight bytes from every place as one number, zeros behind the end."""
    padded = np.concatenate([data, np.zeros(_KEY, np.uint8)])
    return np.ndarray(shape=(len(data),), dtype=">u8", buffer=padded.data, strides=(1,)).astype(np.uint64)


class Matcher:
    """Finds all items of one pass in texts.

    Items are one run of bytes and pieces are rows of arrays sorted by key, so that a
    task holds about thirty bytes for a piece.
    """

    def __init__(self, items: list[tuple[int, str]], error_rate: float):
        known = [(item_id, text) for item_id, text in ((i, normal(t)) for i, t in items) if text]
        raw = [text.encode() for _, text in known]
        self.ids = np.array([item_id for item_id, _ in known], object)
        self.errors = np.array([int(len(text) * error_rate) for _, text in known], np.int32)
        self.bounds = np.concatenate([[0], np.cumsum([len(r) for r in raw])]).astype(np.int64)
        self.blob = b"".join(raw)
        number, offset, start, length = [], [], [], []
        for at, ((_, text), data) in enumerate(zip(known, raw, strict=True)):
            cuts = np.array([o for o, _ in pieces_of(text, int(self.errors[at]))] + [len(text)])
            if len(data) == len(text):
                places = cuts
            else:  # from characters to bytes
                begins = np.flatnonzero((np.frombuffer(data, np.uint8) & 0xC0) != 0x80)
                places = np.append(begins, len(data))[cuts]
            number.append(np.full(len(cuts) - 1, at, np.int32))
            offset.append(cuts[:-1].astype(np.int32))
            start.append(places[:-1] + self.bounds[at])
            length.append(np.diff(places).astype(np.int32))
        empty = [np.zeros(0, np.int64)]
        number, offset, start, length = (np.concatenate(x or empty) for x in (number, offset, start, length))
        self.pieces = {}
        words = _words(np.frombuffer(self.blob, np.uint8))
        for size in np.unique(np.minimum(length, _KEY)).tolist():
            some = np.flatnonzero(np.minimum(length, _KEY) == size)
            keys = words[start[some]] >> np.uint64(8 * (_KEY - size))
            by = np.argsort(keys, kind="stable")
            some, keys = some[by], keys[by]
            bits = np.zeros(1 << _FILTER_BITS, bool)
            bits[self._slot(keys)] = True
            self.pieces[size] = bits, keys, number[some], offset[some], start[some], length[some]
        self._patterns: dict[int, Pattern] = {}

    @staticmethod
    def _slot(keys: np.ndarray) -> np.ndarray:
        return ((keys * _MULTIPLY) >> np.uint64(64 - _FILTER_BITS)).astype(np.int64)

    def pattern(self, number: int) -> Pattern:
        if number not in self._patterns:
            if len(self._patterns) >= _PATTERNS:
                self._patterns.clear()
            text = self.blob[self.bounds[number]: self.bounds[number + 1]].decode()
            self._patterns[number] = Pattern(text, int(self.errors[number]))
        return self._patterns[number]

    def piece_hits(self, data: np.ndarray):
        """(byte place, item, character offset in the item) of every exact piece hit."""
        if not len(data):
            return
        words, raw = _words(data), data.tobytes()
        for size, (bits, sorted_keys, number, offset, start, length) in self.pieces.items():
            keys = words >> np.uint64(8 * (_KEY - size))
            places = np.flatnonzero(bits[self._slot(keys)])
            low = np.searchsorted(sorted_keys, keys[places])
            count = np.searchsorted(sorted_keys, keys[places], side="right") - low
            rows = spans(low, count)
            columns = (np.repeat(places, count), number[rows], offset[rows], start[rows], length[rows])
            for place, item, at, begin, long in zip(*(c.tolist() for c in columns), strict=True):
                if raw[place: place + long] == self.blob[begin: begin + long]:
                    yield place, item, at

    def matches(self, data: np.ndarray, offsets: np.ndarray):
        """(text, item, distance, end) of every item that occurs; the best place of each."""
        raw, bounds = data.tobytes(), offsets.tolist()
        texts: dict[int, tuple[str, np.ndarray]] = {}
        seen = defaultdict(set)
        for place, number, offset in self.piece_hits(data):
            row = int(np.searchsorted(offsets, place, side="right")) - 1
            if row not in texts:
                part = data[bounds[row]: bounds[row + 1]]
                # Characters before each byte, to go from bytes to characters.
                before = np.cumsum((part & 0xC0) != 0x80)
                texts[row] = raw[bounds[row]: bounds[row + 1]].decode("utf-8", "replace"), before
            start = int(texts[row][1][place - bounds[row]]) - 1 - offset
            seen[row, number].add(start)
        for (row, number), starts in seen.items():
            item_id, pattern = self.ids[number], self.pattern(number)
            errors, best = pattern.errors, None
            for low, high in _merged(sorted(starts), errors, len(pattern.text)):
                low = max(low, 0)
                distance, end = pattern.best(texts[row][0][low:high])
                if distance <= errors and (best is None or (distance, low + end) < best):
                    best = distance, low + end
            if best:
                yield row, item_id, *best


def _merged(starts: list[int], errors: int, size: int):
    """Stretches of text around aligned starts; those that overlap are one."""
    low, high = None, None
    for start in starts:
        if low is not None and start - errors <= high:
            high = start + size + errors
            continue
        if low is not None:
            yield low, high
        low, high = start - errors, start + size + errors
    yield low, high


def squeeze(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Runs of white space as one blank, none at the ends of a text; a blank parts two texts."""
    space = _SPACES[data]
    keep = ~space
    keep[1:] |= ~space[:-1]
    edges = offsets[:-1][offsets[:-1] < len(data)]
    keep[edges] = ~space[edges]
    total = np.concatenate([[0], np.cumsum(keep)])
    out = np.where(space, np.uint8(32), data)[keep]
    return out, total[offsets]


_FOUND = pa.schema([
    ("doc_id", pa.int64()), ("k_id", pa.int64()), ("k_text", pa.int64()),
    ("item_id", pa.int64()), ("distance", pa.int32()), ("end", pa.int64()),
])


def _search(matcher):
    def run(batches):
        for batch in slices(batches, most=_SLICE):
            data, offsets = squeeze(*text_bytes(batch.column("text")))
            found = [m for m in matcher.value.matches(data, offsets) if m]
            rows = pa.array([m[0] for m in found], pa.int64())
            yield pa.record_batch({
                **{name: batch.column(name).take(rows) for name in ("doc_id", "k_id", "k_text")},
                "item_id": pa.array([m[1] for m in found], pa.int64()),
                "distance": pa.array([m[2] for m in found], pa.int32()),
                "end": pa.array([m[3] for m in found], pa.int64()),
            })
    return run


def _passes(items: DataFrame):
    """The items in blocks of a bounded size; never more than one block is fetched at a time."""
    rows = items.select("item_id", "text").filter("text is not null").distinct()
    block, chars = [], 0
    for row in rows.toLocalIterator():
        if block and (len(block) >= PASS_ITEMS or chars + len(row.text) > PASS_CHARS):
            yield block
            block, chars = [], 0
        block.append((row.item_id, row.text))
        chars += len(row.text)
    if block:
        yield block


def find_contamination(docs: DataFrame, items: DataFrame, error_rate: float = ERROR_RATE) -> DataFrame:
    """The benchmark items that each document holds, with a few errors at most.

    Texts and items are compared in lower case and with runs of white space as one
    blank. An item of m characters occurs if a stretch of the text has an edit
    distance of at most error_rate * m from it; pieces cut the item evenly, so every
    such stretch is found. Returns doc_id, item_id, distance and end (the character
    after the best stretch in the compared text), a row for each document and item, with
    k_id and k_text that name the document.

    Null and empty texts and items never match, a null id is kept as it is, repeated
    rows give repeated results, repeated items one; other columns are ignored; empty
    tables give none. Items are searched in passes of a bounded number. No shuffle.
    """
    spark = docs.sparkSession
    texts = keyed(docs).select("doc_id", "k_id", "k_text", F.lower("text").alias("text"))
    schema = "doc_id long, k_id long, k_text long, item_id long, distance int, end long"
    # As Arrow: a list of rows would start further Python workers beside those that search.
    found = spark.createDataFrame(_FOUND.empty_table())
    for block in _passes(items):
        matcher = spark.sparkContext.broadcast(Matcher(block, error_rate))
        found = found.unionByName(texts.mapInArrow(_search(matcher), schema))
    return found

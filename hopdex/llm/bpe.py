"""Byte-level BPE: encoding by last-token states over a trie of words, and decoding.

For every string there is one last token of its encoding. The last token of a prefix
is the token t that ends there for which (last token of the rest, t) stays apart under
the merges. So the encoding of a word needs only the states of its prefixes, and words
that begin alike share those: the distinct words of a slice form a trie, which is
walked depth first, each node once.
"""

import hashlib
import json
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from hopdex.llm.common import slices

# The split of this vocabulary family; a fixed value, as the vocabulary's users have it.
PATTERN = (
    r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
)
# Words that a process remembers; beyond that it starts anew.
REMEMBERED = 400_000
# Pairs of neighbours that a process remembers.
PAIRS = 400_000
# Bytes of text that are split into words together.
_SLICE = 1 << 20
# Longer words are not remembered.
LONG = 64


def _byte_letters() -> dict[str, int]:
    """The printable letter that stands for each byte in vocabulary files."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    out = {chr(b): b for b in plain}
    rest = [b for b in range(256) if b not in set(plain)]
    return out | {chr(256 + n): b for n, b in enumerate(rest)}


class Vocabulary:
    """Tokens and merges of a vocabulary file in the JSON form of the tokenizers library."""

    def __init__(self, text: str):
        data = json.loads(text)
        model, letters = data["model"], _byte_letters()
        raw = lambda token: bytes(letters[c] for c in token)
        self.ids = {raw(token): number for token, number in model["vocab"].items()}
        pairs = [m if isinstance(m, list) else m.split(" ") for m in model["merges"]]
        self.merges = {(raw(a), raw(b)): rank for rank, (a, b) in enumerate(pairs)}
        self.special = {t["content"]: t["id"] for t in data["added_tokens"]}
        self.bytes_of = {number: token for token, number in self.ids.items()}
        self.bytes_of |= {number: content.encode() for content, number in self.special.items()}
        self.sizes = {number: len(token) for number, token in self.bytes_of.items()}
        # What a prefix of a word ends with, as far as tokens can go on from there: a state for each beginning
        # of a token, filled as words need it: the beginning, the state after each next byte, and for the tokens
        # that end there, the longest first, the id, the length and whether it stays after the last token before.
        self._begins = {token[:size] for token in self.ids for size in range(1, len(token) + 1)}
        self._states: dict[bytes, tuple[bytes, dict, tuple]] = {b"": (b"", {}, ())}
        self._stay: dict[int, dict[int, bool]] = {}
        self._pairs = 0
        self._halves: dict[bytes, tuple[int, bytes, bytes] | None] = {}

    def merged(self, text: bytes, least: int = 1) -> list[bytes]:
        """The encoding by definition, the earliest merge first, down to `least` parts. Quadratic, for short strings."""
        parts = [text[i: i + 1] for i in range(len(text))]
        while len(parts) > least:
            rank, at = min(
                (self.merges.get(pair, len(self.merges)), i)
                for i, pair in enumerate(zip(parts, parts[1:], strict=False))
            )
            if rank == len(self.merges):
                break
            parts[at: at + 2] = [parts[at] + parts[at + 1]]
        return parts

    def halves(self, token: bytes) -> tuple[int, bytes, bytes] | None:
        """(rank, left, right) of the last merge that makes a token, rank -1 for one byte; none if they do not make it."""
        if token not in self._halves:
            known = (-1, token, token)
            if len(token) > 1:
                parts = self.merged(token, 2)
                rank = self.merges.get(tuple(parts)) if len(parts) == 2 else None
                known = None if rank is None else (rank, *parts)
            self._halves[token] = known
        return self._halves[token]

    def apart(self, left: bytes, right: bytes) -> bool:
        """Whether the merges leave these two tokens, which they make, as they are.

        Goes back through the merges of the two, the last one first. If what then stands
        at the border has a merge of its own that comes before the one taken back, that
        would have been made instead; of equal ones the left is made first.
        """
        halves = self._halves
        before = len(self.merges)
        while True:
            rank = self.merges.get((left, right))
            if rank is not None and rank < before:
                return False
            first, second = halves.get(left) or self.halves(left), halves.get(right) or self.halves(right)
            if first[0] < 0 and second[0] < 0:
                return True
            if first[0] > second[0]:
                before, left = first[0], first[2]
            else:
                before, right = second[0] + 1, second[1]

    def _stays(self, left: int, token: int) -> bool:
        """Whether the merges make this token of its bytes and leave it and the one before it, if any, as they are."""
        if self._pairs >= PAIRS:
            for known in self._stay.values():
                known.clear()
            self._pairs = 0
        self._pairs += 1
        own = self.bytes_of[token]
        stays = self.halves(own) is not None and (left < 0 or self.apart(self.bytes_of[left], own))
        self._stay[token][left] = stays
        return stays

    def _step(self, state: tuple, byte: int) -> tuple:
        """The state after one more byte: the longest end of the prefix that begins a token."""
        end = state[0] + bytes((byte,))
        while end and end not in self._begins:
            end = end[1:]
        if end not in self._states:
            tokens = [end[at:] for at in range(len(end)) if end[at:] in self.ids]
            self._states[end] = (
                end, {}, tuple((self.ids[t], len(t), self._stay.setdefault(self.ids[t], {})) for t in tokens))
        after = state[1][byte] = self._states[end]
        return after

    def encode_words(self, words: list[bytes]) -> Iterator[tuple[bytes, list[int]]]:
        """(word, ids) of distinct words, in the order of a depth-first walk of their trie.

        Sorted words are the leaves of the trie from left to right, so the path to
        the current node is a stack: what two neighbours share stays on it.
        """
        sizes = self.sizes
        path = b""
        # For the first d bytes of the path: the last token (-1 before any), and the state.
        last, states = [-1], [self._states[b""]]
        for word in sorted(words):
            shared = 0
            limit = min(len(path), len(word))
            while shared < limit and path[shared] == word[shared]:
                shared += 1
            del last[shared + 1:], states[shared + 1:]
            path, state = word, states[shared]
            for depth, byte in enumerate(word[shared:], shared + 1):
                state = state[1].get(byte) or self._step(state, byte)
                for token, size, known in state[2]:
                    before = last[depth - size]
                    stays = known.get(before)
                    if stays or (stays is None and self._stays(before, token)):
                        break
                else:
                    raise ValueError(f"the vocabulary has no token for {word[depth - 1:depth]!r}")
                last.append(token)
                states.append(state)
            tokens, depth = [], len(word)
            while depth:
                tokens.append(last[depth])
                depth -= sizes[last[depth]]
            tokens.reverse()
            yield word, tokens

    def decode(self, ids: list[int]) -> bytes:
        return b"".join(map(self.bytes_of.__getitem__, ids))
_SPLIT = regex.compile(PATTERN)


class _Encoder:
    """Word encodings of one process, kept between batches and tasks."""

    def __init__(self, vocabulary: Vocabulary):
        self.vocabulary = vocabulary
        # Ids joined by commas; and what they decode to, of words that do not come back as they were.
        self.ids: dict[str, str] = {}
        self.back: dict[str, str] = {}
        contents = sorted(vocabulary.special, key=len, reverse=True)
        self.special = regex.compile("|".join(map(regex.escape, contents))) if contents else None

    def split(self, text: str) -> list[str]:
        """Words of a text; special tokens stand as words of their own."""
        if self.special is None or not self.special.search(text):
            return _SPLIT.findall(text)
        words, at = [], 0
        for match in self.special.finditer(text):
            words += _SPLIT.findall(text[at: match.start()])
            words.append(match.group())
            at = match.end()
        return words + _SPLIT.findall(text[at:])

    def encode(self, texts: list[str]) -> Iterator[tuple[str, str]]:
        """(ids joined by commas, decoded text) of every text. Words and tokens have whole characters."""
        if len(self.ids) > REMEMBERED:
            self.ids.clear()
            self.back.clear()
        split = [self.split(text) for text in texts]
        ids, back, vocabulary = self.ids, self.back, self.vocabulary
        fresh = set().union(*split) - ids.keys()
        marks = fresh & vocabulary.special.keys()
        for mark in marks:
            ids[mark] = str(vocabulary.special[mark])
        names = {word.encode(): word for word in fresh - marks}
        passing = []
        for raw, numbers in vocabulary.encode_words(list(names)):
            word = names[raw]
            ids[word] = ",".join(map(str, numbers))
            decoded = vocabulary.decode(numbers)
            if decoded != raw:
                back[word] = decoded.decode("utf-8", "replace")
            if len(raw) > LONG:
                passing.append(word)
        for words in split:
            yield ",".join(map(ids.__getitem__, words)), "".join([back.get(w, w) for w in words] if back else words)
        for word in passing:
            del ids[word]
            back.pop(word, None)


# The encoder of a process, with the hash of its vocabulary: the tasks of a worker share what it remembers.
_LOADED: dict[str, _Encoder] = {}


def _encode(vocabulary_text, with_ids):
    def run(batches):
        key = hashlib.sha256(vocabulary_text.value.encode()).hexdigest()
        if key not in _LOADED:
            _LOADED.clear()
            _LOADED[key] = _Encoder(Vocabulary(vocabulary_text.value))
        encoder = _LOADED[key]
        for batch in slices(batches, most=_SLICE):
            raw = batch.column("text").cast(pa.binary()).to_pylist()
            texts = [(value or b"").decode("utf-8", "replace") for value in raw]
            counts, id_hashes, decoded, numbers = [], [], [], []
            for ids, back in encoder.encode(texts):
                counts.append(ids.count(",") + 1 if ids else 0)
                id_hashes.append(hashlib.sha256(ids.encode()).hexdigest())
                decoded.append(back)
                if with_ids:
                    numbers.append(np.array(ids.split(","), np.int32) if ids else np.zeros(0, np.int32))
            columns = {
                "doc_id": batch.column("doc_id"), "n_tokens": pa.array(counts, pa.int64()),
                "ids_sha256": pa.array(id_hashes, pa.string()), "decoded": pa.array(decoded, pa.large_string()),
            }
            schema = _OUT
            if with_ids:
                columns["ids"] = pa.array(numbers, pa.list_(pa.int32()))
                schema = schema.append(pa.field("ids", pa.list_(pa.int32())))
            yield pa.record_batch(columns).cast(schema)
    return run


_OUT = pa.schema([
    ("doc_id", pa.int64()), ("n_tokens", pa.int64()), ("ids_sha256", pa.string()), ("decoded", pa.string()),
])


def encode_documents(docs: DataFrame, vocabulary: str, with_ids: bool = False) -> DataFrame:
    """Token counts, a digest of the token ids and the decoded text of every document.

    `vocabulary` is the path of a byte-level BPE file, read on the driver and sent to
    the tasks; its size is that of the file. Special tokens' strings in a text become
    their ids. Returns doc_id, n_tokens, ids_sha256 (of the decimal ids joined by
    commas) and decoded, and with `with_ids` the token ids as an array. A null or empty text has no tokens; nulls in other columns,
    repeated rows and ids change nothing; other columns are ignored; an empty table
    gives none. Needs no shuffle.
    """
    with open(vocabulary, encoding="utf-8") as file:
        text = docs.sparkSession.sparkContext.broadcast(file.read())
    return docs.select("doc_id", F.col("text").cast("binary").alias("text")).mapInArrow(
        _encode(text, with_ids),
        "doc_id long, n_tokens long, ids_sha256 string, decoded string" + (", ids array<int>" if with_ids else ""),
    )


def token_ids(texts: list[str], vocabulary: str) -> list[list[int]]:
    """The ids of a few texts, without Spark."""
    with open(vocabulary, encoding="utf-8") as file:
        encoder = _Encoder(Vocabulary(file.read()))
    return [[int(i) for i in ids.split(",") if i] for ids, _ in encoder.encode(texts)]

import hashlib
import random
import tracemalloc
from types import SimpleNamespace

import public_tokenizers
import pyarrow as pa
from helpers import documents, rows_of
from tokenizers import Tokenizer

from hopdex.llm import bpe
from hopdex.llm.bpe import Vocabulary, encode_documents, token_ids

PATH = public_tokenizers.path("byte_bpe_50k.json")
sha = lambda text: hashlib.sha256(text.encode()).hexdigest()


def odd_texts():
    rng = random.Random(4)
    alphabet = "abcdefg ABC 0123 .,!?'\n\t\r\x0b\x1c\x1d\x85\u00a0\u2028 éüñß 中文字 😀👍🏽 \u0301 <|endoftext|> 's 'll don't"
    texts = ["", " ", "   ", "a", "  a  b ", "\n\n\n x", "<|endoftext|>", "a<|endoftext|><|endoftext|> b", "x" * 3000,
             "=" * 500, " " * 700 + "y", "ab" * 900, "1234567890" * 30, "naïve café\u0301", "\x00\x01\x7f", "it's we'll I'D"]
    for _ in range(300):
        texts.append("".join(rng.choice(alphabet) for _ in range(rng.randint(1, 80))))
    return texts


def test_same_ids_as_the_library():
    library, texts = Tokenizer.from_file(PATH), odd_texts()
    expected = [e.ids for e in library.encode_batch(texts, add_special_tokens=False)]
    assert token_ids(texts, PATH) == expected


def test_documents(spark):
    library = Tokenizer.from_file(PATH)
    rows = [(i, t) for i, t in enumerate(odd_texts())] + [(None, "null id"), (7, None), (8, "again"), (8, "again")]
    found = rows_of(encode_documents(documents(spark, rows), PATH), "doc_id", "n_tokens", "ids_sha256", "decoded")
    expected = []
    for doc, text in rows:
        ids = library.encode(text or "", add_special_tokens=False).ids
        back = library.decode(ids, skip_special_tokens=False)
        expected.append((doc, len(ids), sha(",".join(map(str, ids))), back))
    assert found == sorted(expected, key=repr)


def test_ids_of_a_table(spark):
    library = Tokenizer.from_file(PATH)
    rows = [(i, t) for i, t in enumerate(odd_texts())] + [(None, "null id"), (7, None), (8, "again"), (8, "again")]
    found = rows_of(encode_documents(documents(spark, rows), PATH, with_ids=True), "doc_id", "ids")
    expected = [(doc, library.encode(text or "", add_special_tokens=False).ids) for doc, text in rows]
    assert found == sorted(expected, key=repr)


def test_empty_table(spark):
    for with_ids in (False, True):
        assert encode_documents(documents(spark, []), PATH, with_ids).collect() == []


def test_trie_walk_equals_the_definition():
    vocabulary = Vocabulary(open(PATH, encoding="utf-8").read())
    rng = random.Random(9)
    words = {bytes(rng.choice(b"etaoin shr") for _ in range(rng.randint(1, 14))) for _ in range(3000)}
    for word, ids in vocabulary.encode_words(sorted(words)):
        assert [vocabulary.bytes_of[i] for i in ids] == vocabulary.merged(word)
        assert vocabulary.decode(ids) == word


def test_neighbours_are_judged_without_merging_again(monkeypatch):
    """As the merges have it, by halves of tokens that are known: whole merges run once a token, not once a pair."""
    vocabulary = Vocabulary(open(PATH, encoding="utf-8").read())
    rng = random.Random(5)
    tokens = sorted(vocabulary.ids)
    pairs = [(rng.choice(tokens), rng.choice(tokens)) for _ in range(3000)]
    pairs += [(t[:n], t[n:]) for t in rng.sample(tokens, 3000) for n in range(1, len(t))]
    pairs = [p for p in pairs if p[0] in vocabulary.ids and p[1] in vocabulary.ids]
    expected = [vocabulary.merged(a + b) == [a, b] for a, b in pairs]
    assert True in expected and False in expected
    calls, merged = [], Vocabulary.merged
    monkeypatch.setattr(Vocabulary, "merged", lambda self, *args: calls.append(args[0]) or merged(self, *args))
    assert [vocabulary.apart(a, b) for a, b in pairs] == expected
    assert len(calls) == len(set(calls)) <= len(tokens)


def _words(count):
    rng = random.Random(6)
    return [" " + "".join(rng.choice("abcdefghijklmnoprstuvw") for _ in range(rng.randint(6, 12))) for _ in range(count)]


def test_a_process_remembers_little_for_a_word():
    words = _words(40_000)
    encoder = bpe._Encoder(Vocabulary(open(PATH, encoding="utf-8").read()))
    tracemalloc.start()
    try:
        for at in range(0, len(words), 2_000):
            list(encoder.encode(["".join(words[at: at + 2_000])]))
        held = tracemalloc.get_traced_memory()[0]
    finally:
        tracemalloc.stop()
    assert held < 600 * len(words)


def test_tasks_of_a_worker_share_what_it_remembers(monkeypatch):
    """And what it remembers is bounded, with the same ids."""
    library, words = Tokenizer.from_file(PATH), _words(2_000)
    vocabulary = SimpleNamespace(value=open(PATH, encoding="utf-8").read())
    encoded = []
    encode_words = Vocabulary.encode_words
    monkeypatch.setattr(Vocabulary, "encode_words", lambda self, w: encoded.append(len(w)) or encode_words(self, w))
    monkeypatch.setattr(bpe, "PAIRS", 50)
    monkeypatch.setattr(bpe, "_LOADED", {})
    batch = pa.record_batch({"doc_id": pa.array([1]), "text": pa.array(["".join(words).encode()], pa.binary())})
    for _ in range(2):
        found = pa.Table.from_batches(bpe._encode(vocabulary, True)(iter([batch]))).to_pylist()
        assert found[0]["ids"] == library.encode("".join(words), add_special_tokens=False).ids
        assert found[0]["decoded"] == "".join(words)
    assert encoded[0] > 1_900 and encoded[1] == 0
    (encoder,) = bpe._LOADED.values()
    assert sum(map(len, encoder.vocabulary._stay.values())) <= 50


def test_a_task_gives_its_memory_back(monkeypatch):
    """When its last slice is done, before the worker goes on to a task of another step."""
    from hopdex.llm import common
    done = []
    monkeypatch.setattr(common, "give_back", lambda: done.append(True))
    batch = pa.record_batch({"text": pa.array(["a" * 10] * 5)})
    cut = common.slices(iter([batch]), most=20)
    assert [next(cut).num_rows for _ in range(3)] == [2, 2, 1] and not done
    assert list(cut) == [] and done == [True]

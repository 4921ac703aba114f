"""Removal of repeated byte strings by a distributed, two-stage suffix sort.

A byte goes if a string of `length` bytes that covers it also starts earlier in the
corpus. Suffixes of different documents meet only where they can match:

1. Every string of `length` bytes is named after the smallest hash of the `GRAM`-byte
   strings inside it, a value that depends on its content alone. Starts that follow
   one another and share the name form a region.
2. Names with two occurrences in the corpus are the only ones that can repeat.
   Regions with such a name travel, with their text, to the task of that name.
3. There the suffixes that begin in the regions are sorted in two stages: those
   smaller than their successor directly, all others by a scan over the buckets of
   first bytes. Adjacent common prefixes then give the groups of equal strings, and
   all but the earliest of a group are repeats.
4. Repeats return to their documents as runs of starts.
"""

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from hopdex.llm.common import binary_column, keyed, mix, slices, spans, text_bytes
from hopdex.session import stage

LENGTH = 100
GRAM = 16
# Starts after which a region is cut, so that periodic text has bounded regions.
REGION = 1 << 16
# Bytes of text that one sort looks at, and what is left of its last name.
BLOCK = 2 << 20
# Names with a larger load go another way, which does not gather them in a task. The load
# of a region is one for every two lengths of text, so it bounds regions and bytes.
HOT = 50_000
CHUNK = 1 << 20

_RNG = np.random.Generator(np.random.PCG64(20240229))
_BYTE_HASH = _RNG.integers(1, 2**63, 256, dtype=np.uint64) | np.uint64(1)
_STEPS = [np.uint64(x) for x in (_RNG.integers(1, 2**63, 8, dtype=np.uint64) | np.uint64(1))]


def _gram_hashes(data: np.ndarray) -> np.ndarray:
    """Hash of the GRAM bytes from every position (GRAM is a power of two)."""
    hashes, width = _BYTE_HASH[data], 1
    for step in _STEPS:
        if width == GRAM:
            break
        hashes = hashes[:-width] * step + hashes[width:]
        width *= 2
    return mix(hashes)


def _window_min(values: np.ndarray, width: int) -> np.ndarray:
    """Smallest of `width` values from every position."""
    have, out = 1, values
    while have * 2 <= width:
        out = np.minimum(out[:-have], out[have:])
        have *= 2
    rest = width - have
    return np.minimum(out[:-rest], out[rest:]) if rest else out


def _regions(data: np.ndarray, ends: np.ndarray, length: int):
    """(name, start, count, has two occurrences) of the regions of texts that follow one another."""
    width = length - GRAM + 1
    found = []
    total = len(data)
    for at in range(0, max(total - length + 1, 0), CHUNK):
        part = data[at: min(at + CHUNK + length - 1, total)]
        hashes = _gram_hashes(part)
        names = _window_min(hashes, width)
        place = np.arange(at, at + len(names))
        text = np.searchsorted(ends, place, side="right")  # the text that a start lies in
        valid = place + length <= ends[text]
        cut = np.ones(len(names), bool)
        cut[1:] = (names[1:] != names[:-1]) | (text[1:] != text[:-1]) | (place[1:] % REGION == 0)
        first = np.flatnonzero(cut)
        counts = np.add.reduceat(valid, first) if len(first) else np.zeros(0, np.int64)
        first, counts = first[counts > 0], counts[counts > 0]
        inside = np.arange(width)
        twice = np.zeros(len(first), bool)
        for lo in range(0, len(first), 1 << 14):
            rows, last = first[lo: lo + (1 << 14)], (first + counts - 1)[lo: lo + (1 << 14)]
            name = names[rows][:, None]
            left = rows + np.argmax(hashes[rows[:, None] + inside] == name, axis=1)
            right = last + width - 1 - np.argmax(
                hashes[last[:, None] + inside[::-1]] == name, axis=1)
            twice[lo: lo + (1 << 14)] = left != right
        found.append((names[first].view(np.int64), first + at, counts, twice))
    if not found:
        empty = np.zeros(0, np.int64)
        return empty, empty, empty, np.zeros(0, bool)
    return tuple(np.concatenate(x) for x in zip(*found, strict=True))


def _find_regions(length):
    def run(batches):
        for batch in slices(batches):
            data, offsets = text_bytes(batch.column("text"))
            names, starts, counts, twice = _regions(data, offsets[1:], length)
            row = np.searchsorted(offsets[1:], starts, side="right")
            ids = batch.column("k_id").to_numpy()[row]
            texts = batch.column("k_text").to_numpy()[row]
            # A region with one occurrence of its name is shorter than two lengths: load one.
            load = np.maximum(1 + twice, -(-(counts + length - 1) // (2 * length)))
            yield pa.record_batch({
                "name": names, "k_id": ids, "k_text": texts, "start": starts - offsets[row],
                "count": counts.astype(np.int32), "load": load.astype(np.int32),
            })
    return run


def _list_column(column: pa.Array, field: str) -> np.ndarray:
    return column.flatten().field(field).to_numpy(zero_copy_only=False)


def _contexts(length):
    """The text of every listed region, a row each."""
    def run(batches):
        for batch in slices(batches, most=1 << 20):
            data, offsets = text_bytes(batch.column("text"))
            lists = batch.column("regions")
            row = np.repeat(np.arange(batch.num_rows), lists.value_lengths().fill_null(0).to_numpy())
            start, count = _list_column(lists, "start"), _list_column(lists, "count").astype(np.int64)
            name = _list_column(lists, "name")
            sizes = count + length - 1
            # Bound what is written at once.
            cuts = np.searchsorted(np.cumsum(sizes), np.arange(BLOCK, sizes.sum(), BLOCK))
            for some in np.split(np.arange(len(row)), cuts):
                if len(some):
                    text = data[spans(offsets[row[some]] + start[some], sizes[some])]
                    yield pa.record_batch({
                        "name": name[some], "k_id": batch.column("k_id").to_numpy()[row[some]],
                        "k_text": batch.column("k_text").to_numpy()[row[some]],
                        "start": start[some], "text": binary_column(text, sizes[some]),
                    })
    return run


def _words(data: np.ndarray) -> np.ndarray:
    """The eight bytes from every position as a number that sorts as they do."""
    padded = np.concatenate([data, np.zeros(8, np.uint8)])
    view = np.ndarray(shape=(len(data) + 1,), dtype=">u8", buffer=padded.data, strides=(1,))
    return view.astype(np.uint64)


def _strings_at(data: np.ndarray, places: np.ndarray, length: int):
    """(first, rows) for slices of the places: the bytes from each as rows of words.

    One copy of neighbouring bytes for a place; the last word is filled up with zeros.
    """
    width = -(-length // 8) * 8
    padded = np.concatenate([data, np.zeros(width, np.uint8)])
    windows = np.lib.stride_tricks.sliding_window_view(padded, width)
    for at in range(0, len(places), 1 << 14):
        rows = windows[places[at: at + (1 << 14)]]
        rows[:, length:] = 0
        yield at, rows.view(np.uint64)


def _direct_sort(data: np.ndarray, places: np.ndarray, words: np.ndarray, length: int) -> np.ndarray:
    """Places ordered by the `length` bytes from there, eight more at a time.

    Groups in which nothing differs any more are left as they are.
    """
    order = places[np.argsort(words[places], kind="stable")]
    # Hash of all bytes, to see where a group is already settled.
    whole = np.zeros(len(order), np.uint64)
    for at, rows in _strings_at(data, order, length):
        part = whole[at: at + len(rows)]
        for column in rows.T:
            part[:] = mix(part + column)
    key, group = words[order], np.zeros(len(order), np.int64)
    slots, last = np.arange(len(order)), len(words) - 1
    for at in range(8, length + 8, 8):
        fresh = np.ones(len(slots), bool)
        fresh[1:] = (key[1:] != key[:-1]) | (group[1:] != group[:-1])
        group = np.cumsum(fresh) - 1
        # Only groups with different strings go on.
        mixed = np.zeros(len(group), bool)
        mixed[group[1:][~fresh[1:] & (whole[1:] != whole[:-1])]] = True
        going = mixed[group]
        slots, group, whole = slots[going], group[going], whole[going]
        if at >= length or not len(slots):
            break
        some = order[slots]
        key = words[np.minimum(some + at, last)]
        by = np.lexsort((key, group))
        order[slots], whole, key = some[by], whole[by], key[by]
    return order


def sort_suffixes(data: np.ndarray, wanted: np.ndarray, length: int) -> np.ndarray:
    """The wanted positions in the order of the `length` bytes from there, in two stages.

    A suffix is of the small kind if it is smaller than its successor, that is, if
    the next different byte is larger. Those are sorted directly. A large one is put
    in place when the scan over the buckets meets its successor, as all successors
    of a bucket's large suffixes are smaller and so come earlier.
    """
    total = len(data)
    if not len(wanted):
        return wanted
    # Runs of one byte are of the small kind if the byte after them is larger; the end
    # of the data counts as smallest.
    first = np.flatnonzero(np.concatenate([[True], data[1:] != data[:-1]]))
    rises = np.append(data[first[1:]] > data[first[:-1]], False)
    small = np.repeat(rises, np.diff(np.append(first, total)))
    # A large suffix needs its successors up to the first small one.
    needed = np.zeros(total, bool)
    needed[wanted] = True
    more = wanted[~small[wanted]] + 1
    while len(more):
        more = more[more < total]
        more = more[~needed[more]]
        needed[more] = True
        more = more[~small[more]] + 1
    words = _words(data)
    direct = _direct_sort(data, np.flatnonzero(needed & small), words, length)
    direct_first = np.searchsorted(data[direct], np.arange(257))
    queues: list[list[np.ndarray]] = [[] for _ in range(256)]
    if needed[total - 1]:  # its successor is the empty suffix, the smallest of all
        queues[data[total - 1]].append(np.array([total - 1]))
    needed_large = needed & ~small
    out = []
    for byte in range(256):
        part = queues[byte]
        round_ = np.concatenate(part) if part else np.zeros(0, np.int64)
        large = []
        while len(round_):
            large.append(round_)
            before = round_[round_ > 0] - 1
            round_ = before[needed_large[before] & (data[before] == byte)]
        bucket = np.concatenate([*large, direct[direct_first[byte]: direct_first[byte + 1]]])
        if not len(bucket):
            continue
        out.append(bucket)
        before = bucket[bucket > 0] - 1
        before = before[needed_large[before] & (data[before] > byte)]
        first = data[before]
        by = np.argsort(first, kind="stable")
        before, first = before[by], first[by]
        for piece in np.split(before, np.flatnonzero(first[1:] != first[:-1]) + 1):
            if len(piece):
                queues[data[piece[0]]].append(piece)
    order = np.concatenate(out)
    keep = np.zeros(total, bool)
    keep[wanted] = True
    return order[keep[order]]


def common_prefixes(data: np.ndarray, order: np.ndarray, length: int) -> np.ndarray:
    """Common prefix of each suffix with the one before it in `order`, `length` at most."""
    out = np.zeros(len(order), np.int64)
    before = None
    for at, rows in _strings_at(data, order, length):
        if before is not None:
            rows, at = np.concatenate([before, rows]), at - 1
        before = rows[-1:]
        differ = rows[1:] != rows[:-1]
        word = differ.argmax(axis=1)
        pairs = np.arange(len(word))
        unequal = differ[pairs, word]
        pairs, word = pairs[unequal], word[unequal]
        one, two = rows[pairs + 1, word], rows[pairs, word]
        byte = (one[:, None].view(np.uint8) != two[:, None].view(np.uint8)).argmax(axis=1)
        found = np.full(len(unequal), length, np.int64)
        found[pairs] = word * 8 + byte
        out[at + 1: at + len(rows)] = found
    return out


def repeated_starts(data, sizes, ids, starts, length) -> tuple[np.ndarray, np.ndarray]:
    """(region, offset) of the starts whose string also starts earlier."""
    first = np.concatenate([[0], np.cumsum(sizes)[:-1]])
    counts = sizes - (length - 1)
    wanted = spans(first, counts)
    region = np.repeat(np.arange(len(sizes)), counts)
    # Place in the corpus: documents by id, then position.
    _, rank = np.unique(ids, return_inverse=True)
    place = (rank[region].astype(np.int64) << 40) | (starts[region] + wanted - first[region])
    of = np.zeros(len(data), np.int64)
    of[wanted] = np.arange(len(wanted))
    order = sort_suffixes(data, wanted, length)
    prefix = common_prefixes(data, order, length)
    bounds = np.flatnonzero(np.concatenate([[True], prefix[1:] < length]))
    mine = of[order]
    earliest = np.minimum.reduceat(place[mine], bounds)
    repeat = place[mine] > np.repeat(earliest, np.diff(np.append(bounds, len(order))))
    hit = np.sort(mine[repeat])
    return region[hit], (wanted - first[region])[hit]


def _runs(batch: pa.RecordBatch, length: int):
    data, offsets = text_bytes(batch.column("text"))
    ids, starts = batch.column("k_id").to_numpy(), batch.column("start").to_numpy()
    region, offset = repeated_starts(data, np.diff(offsets), ids, starts, length)
    cut = np.ones(len(region), bool)
    cut[1:] = (region[1:] != region[:-1]) | (offset[1:] != offset[:-1] + 1)
    begin = np.flatnonzero(cut)
    row = region[begin]
    return pa.record_batch({
        "k_id": ids[row], "k_text": batch.column("k_text").to_numpy()[row],
        "start": starts[row] + offset[begin],
        "count": np.diff(np.append(begin, len(region))).astype(np.int64),
    })


def _sort_blocks(length):
    """Sort blocks of whole names; rows arrive ordered by name."""
    def run(batches):
        waiting, size = [], 0
        for batch in slices(batches, most=BLOCK // 4):
            names = batch.column("name").to_numpy()
            cut = 0
            if size >= BLOCK:
                new = np.flatnonzero(names != waiting[-1].column("name")[-1].as_py())
                if len(new):  # a name ends here
                    cut = int(new[0])
                    yield _runs(_joined([*waiting, batch.slice(0, cut)]), length)
                    waiting, size = [], 0
            waiting.append(batch.slice(cut))
            size += batch.column("text").nbytes
        if waiting:
            yield _runs(_joined(waiting), length)
    return run


def _joined(batches):
    return pa.Table.from_batches(batches).combine_chunks().to_batches()[0]


def _strings(length):
    """A row for each string of the regions of a hot name: two hashes and the start."""
    def run(batches):
        for batch in slices(batches, most=1 << 18):
            data, offsets = text_bytes(batch.column("text"))
            counts = np.diff(offsets) - (length - 1)
            places = spans(offsets[:-1], counts)
            row = np.repeat(np.arange(batch.num_rows), counts)
            words = _words(data)
            one, two = np.full(len(places), 7, np.uint64), np.full(len(places), 11, np.uint64)
            for at in range(0, length, 8):
                word = words[places + min(at, length - 8)]
                one, two = mix(one + word), mix(two ^ (word * _STEPS[0]))
            yield pa.record_batch({
                "one": one.view(np.int64), "two": two.view(np.int64),
                "k_id": batch.column("k_id").to_numpy()[row],
                "k_text": batch.column("k_text").to_numpy()[row],
                "start": batch.column("start").to_numpy()[row] + places - offsets[row],
            })
    return run


def _cut_texts(length):
    def run(batches):
        for batch in slices(batches):
            data, offsets = text_bytes(batch.column("text"))
            lists = batch.column("runs")
            sizes = lists.value_lengths().fill_null(0).to_numpy()
            row = np.repeat(np.arange(batch.num_rows), sizes)
            start = _list_column(lists, "start") + offsets[row]
            end = start + _list_column(lists, "count") + length - 1
            depth = np.zeros(len(data) + 1, np.int32)
            np.add.at(depth, start, 1)
            np.add.at(depth, end, -1)
            gone = np.cumsum(depth[:-1]) > 0
            begins = gone.copy()
            begins[1:] &= ~gone[:-1]
            edge = offsets[:-1][offsets[:-1] < len(data)]
            begins[edge] = gone[edge]  # a run never goes on in the next document
            total = np.concatenate([[0], np.cumsum(gone)])
            seen = np.concatenate([[0], np.cumsum(begins)])
            kept = np.flatnonzero(~gone)
            left = data[kept]
            bounds = offsets - total[offsets]
            hashes, raw = [], left.tobytes()
            for a, b in zip(bounds[:-1], bounds[1:], strict=True):
                hashes.append(hashlib.sha256(raw[a:b]).hexdigest())
            yield pa.record_batch({
                "doc_id": batch.column("doc_id"),
                "n_bytes": np.diff(offsets),
                "n_removed": np.diff(total[offsets]), "n_spans": np.diff(seen[offsets]),
                "kept_sha256": pa.array(hashes, pa.string()),
                "kept": binary_column(left, np.diff(bounds)),
            })
    return run


def remove_repeats(docs: DataFrame, length: int = LENGTH, hot: int = HOT) -> DataFrame:
    """Every document with its repeated strings taken out.

    A byte is removed if it is covered by a string of `length` bytes of the same
    text that also starts at an earlier place: in a document with a smaller id, or
    earlier in the same one. Strings are judged on the input.

    Returns doc_id, n_bytes, n_removed, n_spans (maximal removed runs), kept_sha256
    and kept (the bytes left). Null texts are empty; texts shorter than `length`
    stay as they are; a null id comes after all ids. Rows that repeat an id and a
    text are one document and get one result each; texts that share an id are
    ordered by place alone. Other columns are ignored. An empty table gives none.

    `length` has to be at least GRAM. Names with more than `hot` regions, or with so much
    text that it is more than `hot` times two lengths, are not gathered: their strings
    are compared by 128-bit hashes in an aggregate.
    """
    if length < GRAM:
        raise ValueError(f"length must be at least {GRAM}")
    docs = keyed(docs)
    key = ["k_id", "k_text"]
    regions = docs.select("k_id", "k_text", "text").mapInArrow(
        _find_regions(length),
        "name long, k_id long, k_text long, start long, count int, load int",
    )
    shared = regions.groupBy("name").agg(F.sum("load").alias("load"))
    shared = stage(shared.filter("load > 1"), "names")
    where = F.struct("name", "start", "count")

    def runs_of(names: DataFrame, path) -> DataFrame:
        lists = (
            regions.drop("load").join(names.select("name"), "name")
            .groupBy(*key).agg(F.collect_set(where).alias("regions"))
        )
        return path(docs.join(lists, key).mapInArrow(
            _contexts(length), "name long, k_id long, k_text long, start long, text binary"
        ))

    def sorted_runs(contexts: DataFrame) -> DataFrame:
        apart = contexts.repartition("name").sortWithinPartitions("name")
        return apart.mapInArrow(_sort_blocks(length), "k_id long, k_text long, start long, count long")

    def hashed_runs(contexts: DataFrame) -> DataFrame:
        strings = contexts.mapInArrow(
            _strings(length), "one long, two long, k_id long, k_text long, start long"
        )
        first = strings.groupBy("one", "two").agg(F.min(F.struct("k_id", "start")).alias("first"))
        later = strings.join(first, ["one", "two"]).filter(F.struct("k_id", "start") > F.col("first"))
        return later.select(*key, "start", F.lit(1).cast("long").alias("count"))

    runs = runs_of(shared.filter(F.col("load") <= hot), sorted_runs)
    crowded = shared.filter(F.col("load") > hot)
    if not crowded.isEmpty():
        runs = runs.unionByName(runs_of(crowded, hashed_runs))
    runs = runs.groupBy(*key).agg(F.collect_list(F.struct("start", "count")).alias("runs"))
    return docs.join(runs, key, "left").mapInArrow(
        _cut_texts(length),
        "doc_id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string, kept binary",
    )

"""Near duplicates by SimHash, with every pair that could be near compared bit by bit.

Distinct fingerprints meet in cells: fingerprints that agree on some of the bands they are
cut in. Inside a cell they are sorted by population count and cut in tiles, and pairs of
tiles are compared by exclusive-or and bit counts, unless their population counts are
further apart than the radius. No link within the radius is lost.
"""

from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from hopdex.llm.common import slices, text_bytes
from hopdex.llm.components import components
from hopdex.llm.decontaminate import squeeze
from hopdex.operators.joins import match_join
from hopdex.session import stage

WORDS, RADIUS, SEED = 4, 4, 42
# Fingerprints of a tile, and what a cell of bands should hold on average at most.
TILE, CELL = 1_024, 2_048
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32


def _shingles(raw: bytes, begins: np.ndarray, ends: np.ndarray, first: int, last: int, words: int) -> list[int]:
    """XXH64 of the shingles of the words `first` to `last` - 1, or of all of them if they are fewer."""
    stop = max(last - words + 1, first + 1)
    high = ends[np.minimum(np.arange(first, stop) + words, last) - 1]
    return [xxhash.xxh64_intdigest(raw[a:b], SEED) for a, b in zip(begins[first:stop].tolist(), high.tolist(), strict=True)]


def fingerprints(data: np.ndarray, offsets: np.ndarray, words: int = WORDS) -> np.ndarray:
    """SimHash of every text; a bit is set if over half of the shingles set it."""
    data, offsets = squeeze(_LOWER[data], offsets)
    out = np.zeros(len(offsets) - 1, np.uint64)
    raw = data.tobytes()
    for row, (a, b) in enumerate(zip(offsets[:-1].tolist(), offsets[1:].tolist(), strict=True)):
        if a < b and data[b - 1] == 32:
            b -= 1
        if a >= b:
            continue
        blanks = np.flatnonzero(data[a:b] == 32) + a
        begins, ends = np.append(a, blanks + 1), np.append(blanks, b)
        votes, total = np.zeros(64, np.int64), 0
        for at in range(0, len(begins), 1 << 16):  # a long text in parts that overlap by the shingle
            last = min(at + (1 << 16) + words - 1, len(begins))
            if at and last - at < words:
                break
            hashes = np.array(_shingles(raw, begins, ends, at, last, words), ">u8")
            votes += np.unpackbits(hashes.view(np.uint8).reshape(-1, 8), axis=1).sum(axis=0, dtype=np.int64)
            total += len(hashes)
        out[row] = np.packbits(2 * votes > total).view(">u8")[0]
    return out


def _fingerprinted(batches):
    for batch in slices(batches):
        bits = fingerprints(*text_bytes(batch.column("text")))
        yield pa.record_batch({"doc_id": batch.column("doc_id"), "bits": pa.array(bits.view(np.int64), pa.int64())})


def bands_for(count: int, radius: int = RADIUS, cell: int = CELL) -> tuple[list[int], int]:
    """(the first bit of each band and 64 at the end, bands to agree on).

    Two fingerprints within the radius agree on all but `radius` bands at least. More
    bands make a wider key and more of them, so their number follows the fingerprints.
    """
    for bands in range(radius + 1, radius + 6):
        agree = bands - radius
        if count / 2 ** (64 * agree // bands) <= cell:
            break
    return [64 * n // bands for n in range(bands + 1)], agree


def _keys(cuts: list[int], agree: int):
    """A column with a key for every choice of bands to agree on: the choice above the bits of them."""
    keys = []
    for nth, chosen in enumerate(combinations(range(len(cuts) - 1), agree)):
        mask = sum(((1 << (cuts[b + 1] - cuts[b])) - 1) << cuts[b] for b in chosen)
        mask -= (1 << 64) if mask >> 63 else 0
        keys.append(F.xxhash64(F.lit(nth), F.col("bits").bitwiseAND(F.lit(mask))))
    return F.array(*keys)


def cells(bits: DataFrame, count: int, radius: int = RADIUS, tile: int = TILE, cell: int = CELL) -> DataFrame:
    """(task, side, bits): fingerprints to compare, every pair within the radius in one task at least.

    A cell up to four tiles long is a task. A larger one is cut in tiles of equal
    population counts, more than one where a count has many, and a task is a pair of
    tiles whose counts differ by the radius at most: `side` 0 meets `side` 1, and a
    tile meets itself with side 2.
    """
    cuts, agree = bands_for(count, radius, cell)
    rows = bits.select("bits", F.explode(_keys(cuts, agree)).alias("key"))
    rows = rows.withColumn("ones", F.bit_count("bits"))
    large = rows.groupBy("key").agg(F.count("*").alias("n")).filter(F.col("n") > 4 * tile).select("key")
    large = stage(large, "large")
    if large.isEmpty():
        return rows.select(F.col("key").alias("task"), F.lit(2).alias("side"), "bits")
    small = match_join(rows, large.withColumn("is_large", F.lit(True)), ["key"], ["bits"], how="left")
    rest = small.filter("is_large").select("key", "ones", "bits")
    tiles = rest.groupBy("key", "ones").agg(F.ceil(F.count("*") / tile).cast("int").alias("tiles"))
    own = match_join(rest, stage(tiles, "tiles"), ["key", "ones"], ["bits"])
    own = own.withColumn("at", F.pmod(F.xxhash64("bits"), "tiles").cast("int"))
    # A tile goes to itself, to later tiles of its count, and as the other side to those of near counts.
    near = stage(tiles, "tiles").groupBy("key").agg(F.collect_list(F.struct("ones", "tiles")).alias("there"))
    near = own.join(near, "key")  # at most 65 counts of a cell
    partner = F.explode(F.flatten(F.transform(
        F.filter("there", lambda t: F.abs(t["ones"] - F.col("ones")) <= radius),
        lambda t: F.transform(F.sequence(F.lit(0), t["tiles"] - 1), lambda i: F.struct(t["ones"].alias("o"), i.alias("i"))))))
    near = near.select("key", "bits", F.struct(F.col("ones").alias("o"), F.col("at").alias("i")).alias("mine"), partner.alias("other"))
    one, two = F.least("mine", "other"), F.greatest("mine", "other")
    side = F.when(F.col("mine") == F.col("other"), 2).when(F.col("mine") < F.col("other"), 0).otherwise(1)
    near = near.select(F.xxhash64("key", one["o"], one["i"], two["o"], two["i"]).alias("task"), side.alias("side"), "bits")
    return small.filter("is_large is null").select(F.col("key").alias("task"), F.lit(2).alias("side"), "bits").unionByName(near)


def _near(one: np.ndarray, two: np.ndarray, radius: int) -> tuple[np.ndarray, np.ndarray]:
    return np.nonzero(np.bitwise_count(one[:, None] ^ two[None, :]) <= radius)


def tile_links(bits: np.ndarray, side: np.ndarray, radius: int = RADIUS, tile: int = TILE):
    """(a, b) index pairs of fingerprints of a task within the radius, all that are different.

    Sorted by population count and cut in tiles; two tiles are compared only if their
    counts come within the radius.
    """
    ones = np.bitwise_count(bits)
    by = np.argsort(ones, kind="stable")
    for low in range(0, len(by), tile):
        mine = by[low: low + tile]
        # From this tile on, up to the last row within reach of its largest count.
        stop = int(np.searchsorted(ones[by], int(ones[mine[-1]]) + radius, side="right"))
        for at in range(low, stop, tile):
            other = by[at: min(at + tile, stop)]
            a, b = _near(bits[mine], bits[other], radius)
            a, b = mine[a], other[b]
            good = (bits[a] != bits[b]) & ((side[a] == 2) | (side[a] != side[b]))
            if at == low:
                good &= a < b
            if good.any():
                yield a[good], b[good]


def _spanning(count: int, pairs) -> tuple[np.ndarray, np.ndarray]:
    """For rows that have a link, the smallest row each is connected with in this task."""
    root = np.arange(count)
    pairs = list(pairs)
    if not pairs:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    a, b = np.concatenate([p[0] for p in pairs]), np.concatenate([p[1] for p in pairs])
    while True:
        low = np.minimum(root[a], root[b])
        after = root.copy()
        np.minimum.at(after, root[a], low)
        np.minimum.at(after, root[b], low)
        after = after[after]
        if (after == root).all():
            break
        root = after
    some = np.flatnonzero(root != np.arange(count))
    return some, root[some]


def _linked(radius: int, tile: int):
    """Links that connect what is within the radius in each task; rows come sorted by task."""
    def links(task, bits, side):
        # Tasks of one batch are told apart by number; most hold a few rows, so they are taken singly
        # only where a pair is possible at all.
        cuts = np.flatnonzero(np.append(True, task[1:] != task[:-1]))
        ends = np.append(cuts[1:], len(task))
        out_a, out_b = [], []
        sizes = ends - cuts
        for size in np.unique(sizes[(sizes > 1) & (sizes <= 64)]):
            rows = cuts[sizes == size][:, None] + np.arange(size)
            step = max(1, (1 << 21) // int(size) ** 2)
            for at in range(0, len(rows), step):  # tiles of equal size, side by side
                some = rows[at: at + step]
                mine = bits[some]
                near = np.bitwise_count(mine[:, :, None] ^ mine[:, None, :]) <= radius
                near &= np.triu(np.ones((size, size), bool), 1)
                which, a, b = np.nonzero(near)
                a, b = some[which, a], some[which, b]
                good = (bits[a] != bits[b]) & ((side[a] == 2) | (side[a] != side[b]))
                out_a.append(bits[a[good]])
                out_b.append(bits[b[good]])
        for low, high in zip(cuts[sizes > 64].tolist(), ends[sizes > 64].tolist(), strict=True):
            here = bits[low:high]
            a, b = _spanning(high - low, tile_links(here, side[low:high], radius, tile))
            out_a.append(here[a])
            out_b.append(here[b])
        none = [np.zeros(0, np.uint64)]
        return pa.record_batch({
            "a": pa.array(np.concatenate(out_a or none).view(np.int64), pa.int64()),
            "b": pa.array(np.concatenate(out_b or none).view(np.int64), pa.int64())})

    def run(batches):
        held, count = [], 0
        for batch in batches:
            held.append([batch.column(c).to_numpy(zero_copy_only=False) for c in ("task", "bits", "side")])
            count += batch.num_rows
            if count < 32 * TILE:
                continue
            task, bits, side = (np.concatenate(c) for c in zip(*held, strict=True))
            last = int(np.searchsorted(task, task[-1]))  # sorted: the last task may go on
            if last:
                yield links(task[:last], bits[:last].view(np.uint64), side[:last])
            held, count = [[task[last:], bits[last:], side[last:]]], len(task) - last
        if count:
            task, bits, side = (np.concatenate(c) for c in zip(*held, strict=True))
            yield links(task, bits.view(np.uint64), side)
    return run


def similar_fingerprints(docs: DataFrame, radius: int = RADIUS, tile: int = TILE, cell: int = CELL) -> DataFrame:
    """The SimHash of every document and the smallest id it is connected with.

    Texts in lower case (A to Z) are cut in words at ASCII white space; shingles are four
    words with a blank between, repeats counted, or all words if there are fewer. A bit is
    set if it is set in over half of the shingles' XXH64 (seed 42). Documents are linked
    if their fingerprints differ in `radius` bits at most.

    Returns doc_id, fingerprint (16 hexadecimal digits) and component_id, the smallest id
    reachable by links. A null, empty or blank text has fingerprint zero and is linked like any other. A null id
    gets a result but names no component unless all ids there are null. Rows that repeat an id
    are rows as any other; other columns are ignored; an empty table gives none.
    """
    texts = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text"))
    known = stage(texts.mapInArrow(_fingerprinted, "doc_id long, bits long"), "fingerprints")
    # One row stands for all documents with a fingerprint; the rest of the work knows no copies.
    distinct = stage(known.groupBy("bits").agg(
        F.min("doc_id").alias("first"), F.count("*").alias("n")), "distinct")
    tasks = cells(distinct.select("bits"), distinct.count(), radius, tile, cell)
    tasks = tasks.repartition("task").sortWithinPartitions("task")
    links = tasks.mapInArrow(_linked(radius, tile), "a long, b long").distinct()
    roots = stage(components(links).distinct(), "roots")
    named = distinct.join(roots.withColumnRenamed("node", "bits"), "bits", "left")
    named = named.filter("n > 1 or root is not null").withColumn("root", F.coalesce("root", "bits"))
    named = stage(named.select("bits", "first", "root"), "named")
    smallest = named.groupBy("root").agg(F.min("first").alias("component_id"))
    named = stage(match_join(named, smallest, ["root"], ["bits"]).select("bits", "component_id"), "classes")
    placed = match_join(known, named, ["bits"], ["doc_id"], how="left")
    return placed.select(
        "doc_id", F.lower(F.lpad(F.hex("bits"), 16, "0")).alias("fingerprint"),
        F.coalesce("component_id", "doc_id").alias("component_id"))

"""Jaccard self-join of word n-gram sets by chosen paths.

Every run splits the documents by one sampled token of their sets: the token whose
hash under the run's permutation is smallest, which two sets of Jaccard similarity j
share with probability j. Buckets that are still large are split again by the next
sampled token of the run; small ones are compared pair by pair. The runs are as many
as the recall asks for. A bucket that sampling does not make small, such as a large
family of near copies, is compared in blocks of bounded size.

A pair that several runs find is counted in the first of them only, which each task
sees from the buckets of the two documents. So tasks return a count and one link per
document, never all pairs.
"""

import math
from fractions import Fraction

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from hopdex.llm.common import LAST_ID, binary_column, keyed, mix, slices, spans, text_bytes, word_hashes, word_spans
from hopdex.llm.components import components
from hopdex.operators.joins import only_keys
from hopdex.session import stage

WORDS, THRESHOLD, RECALL = 5, 0.8, 0.99
# Splits of a bucket after the first, and documents of a bucket that one task compares.
DEPTH, BUCKET = 2, 256
_WORD_BYTE = np.zeros(256, bool)
_WORD_BYTE[[*range(48, 58), *range(65, 91), *range(97, 123), *range(128, 256)]] = True
_ODD = np.random.Generator(np.random.PCG64(7)).integers(1, 2**63, 512, dtype=np.uint64) | np.uint64(1)


def runs_for(recall: float, threshold: float, depth: int) -> int:
    """Runs after which a pair at the threshold is missed with a chance of 1 - recall at most.

    In one run it stays together through all depth + 1 splits with a chance of
    threshold ** (depth + 1), in small buckets with a larger one.
    """
    return max(1, math.ceil(math.log(1 - recall) / math.log(1 - threshold ** (depth + 1))))


def shingle_sets(data: np.ndarray, offsets: np.ndarray, words: int = WORDS) -> tuple[np.ndarray, np.ndarray]:
    """(sorted distinct shingle hashes of all texts one after another, set sizes).

    Words are runs of letters, digits and non-ASCII characters. A text with fewer
    than `words` words has one shingle, of all its words; one without words has none.
    """
    starts, ends = word_spans(data, offsets, _WORD_BYTE)
    count = np.bincount(np.searchsorted(offsets[1:], starts, side="right"), minlength=len(offsets) - 1)
    hashes = word_hashes(data, starts, ends)
    first = np.cumsum(count) - count
    shingles = np.where(count > 0, np.maximum(count - words + 1, 1), 0)
    row = np.repeat(np.arange(len(count)), shingles)
    place = spans(first, shingles)
    total = np.zeros(len(place), np.uint64)
    for nth in range(words):
        at = place + nth
        inside = nth < count[row]
        word = hashes[np.minimum(at, max(len(hashes) - 1, 0))] if len(hashes) else total
        total = np.where(inside, mix(total * _ODD[-1] + word), total)
    by = np.lexsort((total, row))
    total, row = total[by], row[by]
    new = np.ones(len(total), bool)
    new[1:] = (total[1:] != total[:-1]) | (row[1:] != row[:-1])
    return total[new], np.bincount(row[new], minlength=len(count))


def _nodes(sets: np.ndarray, sizes: np.ndarray) -> list[bytes | None]:
    """A 128-bit name of each set; none for an empty one."""
    if not len(sizes):
        return []
    some = sizes > 0
    first = (np.cumsum(sizes) - sizes)[some]
    names = np.zeros((len(sizes), 2), ">u8")
    if len(first):
        names[some, 0] = mix(np.add.reduceat(mix(sets * _ODD[-2]), first))
        names[some, 1] = mix(np.add.reduceat(mix(sets ^ _ODD[-3]), first) + sizes[some].astype(np.uint64))
    raw = names.tobytes()
    return [raw[16 * i: 16 * i + 16] if s else None for i, s in enumerate(some)]


def _signatures(tokens: int, words: int):
    def run(batches):
        for batch in slices(batches):
            sets, sizes = shingle_sets(*text_bytes(batch.column("text")), words)
            names = _nodes(sets, sizes)
            some = sizes > 0
            first = (np.cumsum(sizes) - sizes)[some]
            sampled = np.zeros((len(sizes), tokens), np.int64)
            if len(first):
                for nth in range(tokens):
                    sampled[some, nth] = np.minimum.reduceat(sets * _ODD[nth], first).view(np.int64)
            flat = pa.array(sampled.reshape(-1))
            yield pa.record_batch({
                "k_id": batch.column("k_id"), "k_text": batch.column("k_text"),
                "node": pa.array(names, pa.binary()),
                "tokens": pa.ListArray.from_arrays(
                    np.arange(0, len(flat) + 1, tokens, dtype=np.int32), flat),
            })
    return run


def _leaves(nodes: DataFrame, runs: int, depth: int, bucket: int) -> DataFrame:
    """(node, run, leaf, size) of every bucket with two nodes or more, after all splits."""
    each = nodes.select("node", F.explode(F.sequence(F.lit(0), F.lit(runs - 1))).alias("run"), "tokens")
    token = lambda level: F.get("tokens", F.col("run") * (depth + 1) + level)
    rows = each.select("node", "run", F.xxhash64("run", token(0)).alias("leaf"),
                       F.array(*[token(level) for level in range(1, depth + 1)]).alias("rest"))
    done = None
    for level in range(depth + 1):
        sizes = rows.groupBy("leaf").agg(F.count("*").alias("size")).filter("size > 1")
        rows = stage(rows.join(sizes, "leaf"), "paths")
        last = level == depth
        small = (rows if last else rows.filter(F.col("size") <= bucket)).select("node", "run", "leaf", "size")
        done = small if done is None else done.unionByName(small)
        if last:
            break
        rows = rows.filter(F.col("size") > bucket)
        if rows.isEmpty():
            break
        rows = rows.select("node", "run", F.xxhash64("leaf", F.get("rest", F.lit(level))).alias("leaf"), "rest")
    return done


def _compared(leaves: DataFrame, runs: int, bucket: int) -> DataFrame:
    """(task, one, two, node, block, run, leaf, seen): who is compared with whom.

    A leaf of more than `bucket` nodes is dealt into blocks by the node's hash, and
    each pair of blocks is a task. `seen` holds the leaves of the node by run.
    """
    seen = leaves.groupBy("node").agg(F.map_from_entries(F.collect_list(F.struct("run", "leaf"))).alias("of"))
    seen = seen.select("node", F.transform(
        F.sequence(F.lit(0), F.lit(runs - 1)), lambda r: F.coalesce(F.element_at("of", r), F.lit(0))).alias("seen"))
    blocks = F.ceil(F.col("size") / bucket).cast("int")
    rows = leaves.join(seen, "node").withColumn("blocks", blocks)
    rows = rows.withColumn("block", F.pmod(F.xxhash64("node"), "blocks").cast("int"))
    rows = rows.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
    one, two = F.least("block", "other"), F.greatest("block", "other")
    return rows.select(
        F.xxhash64("leaf", one, two).alias("task"), (one == two).alias("same"),
        "node", "block", "run", "seen",
    )


def _groups(batches, key: str = "task"):
    """Whole groups of rows that arrive ordered by `key`, as tables."""
    waiting = []
    for batch in batches:
        keys = batch.column(key).to_numpy()
        cuts = [0, *(np.flatnonzero(keys[1:] != keys[:-1]) + 1).tolist(), len(keys)]
        for a, b in zip(cuts, cuts[1:], strict=False):
            if a == b:
                continue
            if waiting and waiting[0].column(key)[0].as_py() != keys[a]:
                yield pa.Table.from_batches(waiting).combine_chunks()
                waiting = []
            waiting.append(batch.slice(a, b - a))
    if waiting:
        yield pa.Table.from_batches(waiting).combine_chunks()


def _fresh(group: pa.Table) -> np.ndarray:
    """The pairs of a task that no earlier run brought together, as an upper triangle."""
    count, run = group.num_rows, group.column("run")[0].as_py()
    seen = np.array(group.column("seen").to_pylist(), np.int64).reshape(count, -1)
    fresh = np.triu(np.ones((count, count), bool), 1)
    for earlier in range(run):
        of = seen[:, earlier]
        fresh &= (of[:, None] != of) | (of == 0)
    if not group.column("same")[0].as_py():
        block = group.column("block").to_numpy()
        fresh &= block[:, None] != block
    return fresh


def _needed(batches):
    """The nodes of tasks that have a pair to compare; most tasks of later runs have none."""
    out, held = [], 0
    for group in _groups(batches):
        fresh = _fresh(group)
        rows = np.flatnonzero(fresh.any(axis=0) | fresh.any(axis=1))
        if len(rows):
            out.append(group.take(rows))
            held += len(rows)
        if held > 5_000:
            yield from pa.concat_tables(out).combine_chunks().to_batches()
            out, held = [], 0
    if out:
        yield from pa.concat_tables(out).combine_chunks().to_batches()


def shared_counts(sets: list[np.ndarray]) -> np.ndarray:
    """Sizes of all intersections of the sets, by products of a 0/1 matrix in blocks of tokens."""
    count = len(sets)
    row = np.repeat(np.arange(count), [len(s) for s in sets])
    _, code, times = np.unique(np.concatenate(sets), return_inverse=True, return_counts=True)
    common = times > 1  # others are in one set only
    number = np.cumsum(common) - 1
    row, code = row[common[code]], number[code[common[code]]]
    by = np.argsort(code, kind="stable")
    row, code = row[by], code[by]
    out = np.zeros((count, count), np.float64)
    width, total = 4_096, int(common.sum())
    for at in range(0, total, width):
        low, high = np.searchsorted(code, [at, at + width])
        matrix = np.zeros((count, width), np.float32)
        matrix[row[low:high], code[low:high] - at] = 1
        out += matrix @ matrix.T
    return out


def _compare(threshold: float):
    limit = Fraction(str(threshold))

    def run(batches):
        for group in _groups(batches):
            fresh = _fresh(group)
            sets = [np.frombuffer(s, np.uint64) for s in group.column("members").to_pylist()]
            shared = shared_counts(sets)
            size = np.array([len(s) for s in sets])
            union = size[:, None] + size - shared
            linked = fresh & (shared * limit.denominator >= union * limit.numerator)
            linked |= linked.T
            degree = linked.sum(axis=1)
            some = np.flatnonzero(degree)
            if not len(some):
                continue
            root = np.arange(len(sets))  # smallest row that is reachable
            while True:
                near = np.where(linked, root, len(sets)).min(axis=1)
                after = np.minimum(root, near)
                after = after[after]
                if (after == root).all():
                    break
                root = after
            nodes = group.column("node").to_pylist()
            yield pa.record_batch({
                "a": pa.array([nodes[i] for i in some], pa.binary()),
                "b": pa.array([nodes[i] for i in root[some]], pa.binary()),
                "links": degree[some].astype(np.int64),
            })
    return run


def _members(words):
    def run(batches):
        for batch in slices(batches):
            sets, sizes = shingle_sets(*text_bytes(batch.column("text")), words)
            yield pa.record_batch({
                "node": pa.array(_nodes(sets, sizes), pa.binary()),
                "members": binary_column(sets.view(np.uint8), sizes * 8),
            })
    return run


def similar_documents(docs: DataFrame, threshold: float = THRESHOLD, words: int = WORDS,
                      recall: float = RECALL, depth: int = DEPTH, bucket: int = BUCKET) -> DataFrame:
    """The near-duplicate class of every document.

    Two documents are linked if the Jaccard similarity of their sets of `words`-word
    shingles (lower case, punctuation ignored) is at least `threshold`; links are
    verified exactly, and one at the threshold is found with a chance of at least
    `recall`. Returns doc_id, class_id (the smallest id in its connected class, null if
    all are), n_links (other shingle sets that are linked with the document's own),
    n_copies (documents with the same set, itself included), stays (true for the first
    document of the class) and k_id, k_text that name the row.

    A text without words, null or empty, is alone in its class. Shorter texts than a
    shingle are one shingle. A repeated row counts once as a copy and gets its result
    each time; a null id sorts last. Other columns are ignored; an empty table gives
    none.
    """
    docs = keyed(docs)
    key = ["k_id", "k_text"]
    low = docs.select(*key, F.lower("text").alias("text"))
    runs = runs_for(recall, threshold, depth)
    signed = stage(low.mapInArrow(
        _signatures(runs * (depth + 1), words),
        "k_id long, k_text long, node binary, tokens array<long>",
    ), "signatures")
    known = signed.filter("node is not null")
    # One document stands for all with the same set.
    nodes = known.groupBy("node").agg(
        F.min(F.struct("k_id", "k_text", "tokens")).alias("rep"),
        F.count_distinct("k_id", "k_text").alias("n_copies"),
    )
    nodes = stage(nodes.select("node", "rep.*", "n_copies"), "nodes")
    leaves = stage(_leaves(nodes, runs, depth, bucket), "leaves")
    tasks = _compared(leaves, runs, bucket)
    columns = "task long, same boolean, node binary, block int, run int, seen array<long>"
    wanted = tasks.repartition("task").sortWithinPartitions("task").mapInArrow(_needed, columns)
    wanted = stage(wanted, "wanted")
    chosen = nodes.join(wanted.select("node").distinct(), "node", "left_semi").select(*key)
    sets = only_keys(low, stage(chosen, "chosen"), key)
    sets = sets.select("text").mapInArrow(_members(words), "node binary, members binary")
    sets = sets.dropDuplicates(["node"])
    compared = wanted.join(sets, "node").repartition("task").sortWithinPartitions("task")
    found = compared.mapInArrow(_compare(threshold), "a binary, b binary, links long")
    found = stage(found, "found")
    degrees = found.groupBy(F.col("a").alias("node")).agg(F.sum("links").alias("n_links"))
    classes = components(found.select("a", "b")).distinct()
    rooted = nodes.select("node", *key, "n_copies").join(classes, "node", "left").join(degrees, "node", "left")
    rooted = rooted.withColumn("root", F.coalesce("root", "node"))
    smallest = rooted.groupBy("root").agg(F.min(F.struct(*key)).alias("first"))
    named = rooted.join(smallest, "root").select(
        "node", "first", F.coalesce("n_links", F.lit(0)).alias("n_links"), "n_copies")
    placed = signed.select(*key, "node").distinct().join(named, "node", "left").drop("node")
    first = F.coalesce("first", F.struct(*key))  # a text without words stands for itself
    class_id = F.when(first["k_id"] < LAST_ID, first["k_id"])
    return docs.select("doc_id", *key).join(placed, key).select(
        "doc_id", class_id.alias("class_id"), F.coalesce("n_links", F.lit(0)).alias("n_links"),
        F.coalesce("n_copies", F.lit(1)).alias("n_copies"), (first == F.struct(*key)).alias("stays"), *key,
    )

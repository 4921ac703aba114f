"""What each filter of a chain costs, in every order of the chain.

Five filters are measured once per document as bits of a mask. Counts of equal masks
add up, so every order, step and share follows from at most 32 counts of a part.

Only the fifth filter, exact repeats, needs other documents. A counting Bloom sketch of
text hashes goes ahead: a text with a counter that only it has touched is unique, and
only the others are shuffled and compared in full.
"""

from itertools import permutations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from hopdex.llm.common import LAST_ID, mix
from hopdex.llm.line_rules import SPACE
from hopdex.operators.joins import match_join, only_keys
from hopdex.session import stage

FILTERS = "ABCDE"
ORDERS = ["".join(p) for p in permutations(FILTERS)]
_CAPITALS = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
# Counters a document, counters of a segment, and of a sketch at most. One bit of a counter is
# broadcast, so a sketch takes 64 MB at most; a fuller one clears fewer texts and loses none.
COUNTERS, SEGMENT, MOST_COUNTERS = 16, 1 << 20, 1 << 29
TOUCHED = 3
_SALTS = np.random.Generator(np.random.PCG64(17)).integers(1, 2**63, TOUCHED + 1, dtype=np.uint64)
# Hashes that one partial sketch takes up.
_PART = 1 << 20


def measure(docs: DataFrame, hash_bits: int = 64) -> DataFrame:
    """(k_id, doc_id, part, text, h, mask): bits 0 to 3 of the mask are the filters A to D."""
    text = F.coalesce(F.col("text"), F.lit(""))
    rows = docs.select(
        F.coalesce("doc_id", F.lit(LAST_ID)).alias("k_id"), "doc_id",
        F.coalesce("lang", F.lit("")).alias("part"), text.alias("text"))
    h = F.xxhash64("text")
    rows = rows.withColumn("h", h if hash_bits == 64 else h.bitwiseAND((1 << hash_bits) - 1))
    rows = rows.withColumn("words", F.array_remove(F.split("text", SPACE + "+"), ""))
    size = F.char_length("text")
    capitals = size - F.char_length(F.translate("text", _CAPITALS, ""))
    fails = [
        F.size("words") < 100,
        100 * F.size(F.array_distinct("words")) < 80 * F.size("words"),
        100 * capitals.cast("long") > 10 * size.cast("long"),
        F.col("text").rlike(r"[#$%&*|]"),
    ]
    mask = sum((F.when(fail, 1 << n).otherwise(0) for n, fail in enumerate(fails)), F.lit(0))
    return rows.withColumn("mask", mask.cast("int")).drop("words")


def _places(hashes: np.ndarray, segments: int) -> tuple[np.ndarray, np.ndarray]:
    """The segment of each hash, and the counters there that it touches, a column for each."""
    hashes = hashes.view(np.uint64)
    segment = (mix(hashes ^ _SALTS[-1]) % np.uint64(segments)).astype(np.int32)
    slots = [mix(hashes ^ salt) & np.uint64(SEGMENT - 1) for salt in _SALTS[:-1]]
    return segment, np.stack(slots, axis=1).astype(np.uint32)


def _partial(segments: int):
    """Partial sketches: the counters that some hashes touched, and those they touched again."""
    def sketch(hashes):
        segment, slots = _places(hashes, segments)
        cells = np.repeat(segment.astype(np.int64) * SEGMENT, TOUCHED) + slots.reshape(-1)
        cells, times = np.unique(cells, return_counts=True)
        low = np.searchsorted(cells, np.arange(segments + 1, dtype=np.int64) * SEGMENT)
        some = np.flatnonzero(low[1:] > low[:-1])
        local = (cells & (SEGMENT - 1)).astype(np.uint32)
        once = [local[low[s]: low[s + 1]] for s in some]
        again = [local[low[s]: low[s + 1]][times[low[s]: low[s + 1]] > 1] for s in some]
        yield pa.record_batch({
            "segment": pa.array(some, pa.int32()),
            "once": pa.array([x.tobytes() for x in once], pa.binary()),
            "again": pa.array([x.tobytes() for x in again], pa.binary()),
        })

    def run(batches):
        held, count = [], 0
        for batch in batches:
            held.append(batch.column("h").to_numpy(zero_copy_only=False).astype(np.int64))
            count += len(held[-1])
            if count >= _PART:
                yield from sketch(np.concatenate(held))
                held, count = [], 0
        if count:
            yield from sketch(np.concatenate(held))
    return run


def _merged(batches):
    """For each segment, bits of the counters that reached two; rows come sorted by segment."""
    current, seen, twice = None, None, None

    def done():
        return pa.record_batch({
            "segment": pa.array([current], pa.int32()), "bits": pa.array([np.packbits(twice).tobytes()], pa.binary())})

    for batch in batches:
        rows = zip(batch.column("segment").to_pylist(), batch.column("once"), batch.column("again"), strict=True)
        for segment, once, again in rows:
            if segment != current:
                if current is not None:
                    yield done()
                current, seen, twice = segment, np.zeros(SEGMENT, bool), np.zeros(SEGMENT, bool)
            slots = np.frombuffer(once.as_buffer(), np.uint32)
            twice[slots[seen[slots]]] = True
            seen[slots] = True
            twice[np.frombuffer(again.as_buffer(), np.uint32)] = True
    if current is not None:
        yield done()


def repeated_counters(hashes: DataFrame, counters: int = COUNTERS, most: int = MOST_COUNTERS) -> np.ndarray:
    """The merged sketch of a written table with a column `h`: a row of bits for each segment.

    Partial sketches of the tasks meet by segment. The size follows the number of rows up
    to `most` counters, an eighth of that in bytes, which is what reaches the driver.
    """
    segments = max(1, min(-(-hashes.count() * counters // SEGMENT), most // SEGMENT))
    parts = hashes.select("h").mapInArrow(_partial(segments), "segment int, once binary, again binary")
    merged = parts.repartition("segment").sortWithinPartitions("segment").mapInArrow(_merged, "segment int, bits binary")
    out = np.zeros((segments, SEGMENT // 8), np.uint8)
    for row in merged.collect():
        out[row.segment] = np.frombuffer(row.bits, np.uint8)
    return out


def maybe_repeated(sketch) -> Column:
    """Whether the hash `h` may have come twice; false is certain. `sketch` is a broadcast."""
    @F.arrow_udf("boolean")
    def test(h: pa.Array) -> pa.Array:
        bits = sketch.value
        segment, slots = _places(h.to_numpy(zero_copy_only=False), len(bits))
        byte = bits[segment[:, None], slots >> 3]
        hit = (byte >> (7 - (slots & 7)).astype(np.uint8)) & 1
        return pa.array(hit.all(axis=1))

    return test("h")


def first_copies(docs: DataFrame, hashes: DataFrame, counters: int = COUNTERS) -> tuple[DataFrame, DataFrame]:
    """The texts that occur again: (h, first, n), and the hashes that two different texts have.

    `docs` has (k_id, h, text), `hashes` is a written table of their hashes. Full texts
    are grouped, aggregated in each task before the shuffle, so that a text with many
    copies is sent once by a task.
    """
    spark = docs.sparkSession
    sketch = spark.sparkContext.broadcast(repeated_counters(hashes, counters))
    suspects = docs.select("k_id", "h", "text").filter(maybe_repeated(sketch))
    groups = suspects.groupBy("h", "text").agg(F.min("k_id").alias("first"), F.count("*").alias("n"))
    groups = stage(groups.select("h", "first", "n"), "groups")
    clashes = stage(groups.groupBy("h").agg(F.count("*").alias("texts")).filter("texts > 1").select("h"), "clashes")
    return groups.filter("n > 1").select("h", "first"), clashes


def failed_masks(docs: DataFrame, hash_bits: int = 64, counters: int = COUNTERS) -> DataFrame:
    """(doc_id, part, mask) of every document, with bit 4 for a text that a smaller id has too."""
    measured = measure(docs, hash_bits)
    narrow = stage(measured.drop("text"), "measured")
    texts = measured.select("k_id", "h", "text")
    repeats, clashes = first_copies(texts, narrow, counters)
    later = F.coalesce(F.col("k_id") > F.col("first"), F.lit(False))
    mask = (F.col("mask") + F.when(later, 16).otherwise(0)).alias("mask")
    alone = narrow if clashes.isEmpty() else narrow.join(clashes, "h", "left_anti")
    found = match_join(alone, repeats, ["h"], ["k_id"], how="left").select("doc_id", "part", mask)
    if not clashes.isEmpty():
        # Hashes that do not tell texts apart: these few go by the texts themselves.
        full = stage(only_keys(measured, clashes, ["h"]), "clashing")
        first = full.groupBy("text").agg(F.min("k_id").alias("first"))
        found = found.unionByName(
            match_join(full, first, ["text"], ["k_id"], how="left").select("doc_id", "part", mask))
    return found


def audit_filters(docs: DataFrame, labels: DataFrame, hash_bits: int = 64, counters: int = COUNTERS) -> DataFrame:
    """Counts of every filter at every step of every order, for each language.

    Filters (a document fails): A under 100 words, B under 80 % distinct words, C over
    10 % capitals, D one of #$%&*|, E the text of a smaller id. Returns, for each `part`
    (the values of lang, null as the empty one), filter_order (120) and step (1 to 5):
    kept, removed, redundant (fails, but was removed before), unique_fails (fails nothing
    else), good_lost and toxic_lost (removed here, by labels) and shapley (what the
    filter removes, summed over all orders).

    A null or empty text has no words and fails A only, unless an earlier document is
    empty too. A null id is later than all others and has no labels; of several labels of
    an id any 1 counts. Repeated rows count each; rows with one id are no repeats of each
    other. Other columns are ignored; an empty table gives none.
    """
    found = failed_masks(docs, hash_bits, counters)
    known = labels.filter("doc_id is not null").groupBy("doc_id").agg(
        F.max((F.col("quality") == 1).cast("int")).alias("good"),
        F.max((F.col("toxic") == 1).cast("int")).alias("toxic"))
    known = stage(known, "labels")
    found = match_join(found, known, ["doc_id"], ["part", "mask"], how="left")
    counts = found.groupBy("part", "mask").agg(
        F.count("*").alias("n"), F.sum(F.coalesce("good", F.lit(0))).cast("long").alias("good"),
        F.sum(F.coalesce("toxic", F.lit(0))).cast("long").alias("toxic"))
    return _orders(stage(counts, "masks"))


def _orders(counts: DataFrame) -> DataFrame:
    """All orders and steps from the counts of masks; a part has 32 of those at most."""
    rows = counts.withColumn("filter_order", F.explode(F.array(*[F.lit(o) for o in ORDERS])))
    rows = rows.withColumn("step", F.explode(F.array(*[F.lit(n) for n in range(1, 6)])))
    before = F.expr("substring(filter_order, 1, step - 1)")
    own = F.expr("substring(filter_order, step, 1)")
    bits = lambda letters: sum(
        (F.when(F.instr(letters, f) > 0, 1 << n).otherwise(0) for n, f in enumerate(FILTERS)), F.lit(0))
    fails = F.col("mask").bitwiseAND(bits(own)) > 0
    gone = F.col("mask").bitwiseAND(bits(before)) > 0
    here = fails & ~gone
    total = lambda value, condition, name: F.sum(F.when(condition, value).otherwise(0)).cast("long").alias(name)
    share = (F.col("n") * F.lit(len(ORDERS)) / F.greatest(F.bit_count("mask"), F.lit(1))).cast("long")
    return rows.groupBy("part", "filter_order", "step").agg(
        total(F.col("n"), ~fails & ~gone, "kept"), total(F.col("n"), here, "removed"),
        total(F.col("n"), fails & gone, "redundant"),
        total(F.col("n"), F.col("mask") == bits(own), "unique_fails"),
        total(F.col("good"), here, "good_lost"), total(F.col("toxic"), here, "toxic_lost"),
        total(share, fails, "shapley"))


ORACLE = r"""
WITH d AS (SELECT doc_id, coalesce(lang, '') AS part, coalesce(text, '') AS text FROM documents),
f AS (SELECT text, min(doc_id) AS first FROM d GROUP BY text),
w AS (SELECT d.*, regexp_extract_all(d.text, '[^\x20\x09-\x0D]+') AS words, f.first FROM d JOIN f USING (text)),
l AS (SELECT doc_id, max(CAST(quality = 1 AS INT)) AS good, max(CAST(toxic = 1 AS INT)) AS toxic FROM labels GROUP BY doc_id),
m AS (SELECT part, coalesce(l.good, 0) AS good, coalesce(l.toxic, 0) AS toxic,
        [len(words) < 100, 100 * len(list_distinct(words)) < 80 * len(words),
         100 * length(regexp_replace(text, '[^A-Z]', '', 'g')) > 10 * length(text),
         regexp_matches(text, '[#$%&*|]'), w.doc_id > first] AS fails
      FROM w LEFT JOIN l ON l.doc_id = w.doc_id),
c AS (SELECT part, fails, count(*) AS n, sum(good) AS good, sum(toxic) AS toxic FROM m GROUP BY part, fails),
p AS (SELECT a.x || b.x || c.x || d.x || e.x AS filter_order
      FROM (SELECT unnest(['A', 'B', 'C', 'D', 'E']) AS x) a, (SELECT unnest(['A', 'B', 'C', 'D', 'E']) AS x) b,
           (SELECT unnest(['A', 'B', 'C', 'D', 'E']) AS x) c, (SELECT unnest(['A', 'B', 'C', 'D', 'E']) AS x) d,
           (SELECT unnest(['A', 'B', 'C', 'D', 'E']) AS x) e
      WHERE len(list_distinct([a.x, b.x, c.x, d.x, e.x])) = 5),
s AS (SELECT filter_order, step, substr(filter_order, step, 1) AS own, substr(filter_order, 1, step - 1) AS before
      FROM p, range(1, 6) AS r(step)),
x AS (SELECT c.*, s.*, fails[ascii(own) - 64] AS here,
        len(list_filter(range(1, 6), lambda i: fails[i] AND contains(before, chr(CAST(i + 64 AS INT))))) > 0 AS gone,
        len(list_filter(fails, lambda v: v)) AS bad FROM c, s),
r AS (SELECT part, filter_order, step, own,
        sum(CASE WHEN NOT here AND NOT gone THEN n ELSE 0 END) AS kept,
        sum(CASE WHEN here AND NOT gone THEN n ELSE 0 END) AS removed,
        sum(CASE WHEN here AND gone THEN n ELSE 0 END) AS redundant,
        sum(CASE WHEN here AND bad = 1 THEN n ELSE 0 END) AS unique_fails,
        sum(CASE WHEN here AND NOT gone THEN good ELSE 0 END) AS good_lost,
        sum(CASE WHEN here AND NOT gone THEN toxic ELSE 0 END) AS toxic_lost FROM x GROUP BY ALL),
h AS (SELECT part, own, sum(removed) AS shapley FROM r GROUP BY part, own)
SELECT part, filter_order, CAST(step AS INT) AS step, CAST(kept AS BIGINT) AS kept, CAST(removed AS BIGINT) AS removed,
       CAST(redundant AS BIGINT) AS redundant, CAST(unique_fails AS BIGINT) AS unique_fails,
       CAST(good_lost AS BIGINT) AS good_lost, CAST(toxic_lost AS BIGINT) AS toxic_lost,
       CAST(shapley AS BIGINT) AS shapley
FROM r JOIN h USING (part, own)
"""

"""Helpers that several operators share: inputs, row keys and text as numpy arrays."""

import ctypes
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from hopdex.operators.joins import is_small, match_join
from hopdex.session import stage

# Bytes of text that one step of a Python task looks at together.
SLICE_BYTES = 2 << 20
# Bytes that are hashed together, and powers that a process keeps: arrays of eight bytes for each of them.
_HASH_BYTES, _KEPT_POWERS = 1 << 18, 1 << 19
_MIX_A, _MIX_B = np.uint64(0xBF58476D1CE4E5B9), np.uint64(0x94D049BB133111EB)
LAST_ID = 2**63 - 1


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def keyed(docs: DataFrame, rest: str | None = None) -> DataFrame:
    """(doc_id, text, k_id, k_text, and the column `rest` names as `rest`): k_id and k_text name a row, never null.

    Rows with the same id and the same text are one document that is repeated; all
    of them get the same results. A null id sorts after all others, a null text is
    empty. k_text is a hash of the text where an id has several texts, and 0
    elsewhere, which is what nearly all rows have and costs next to nothing in a
    shuffle. Other columns are left behind, so their names cannot clash.
    """
    text = F.coalesce(F.col("text"), F.lit("")).alias("text")
    more = [F.col(rest).alias("rest")] if rest else []
    rest = ["rest"] if rest else []
    base = docs.select("doc_id", text, F.coalesce("doc_id", F.lit(LAST_ID)).alias("k_id"), *more)
    of_text = F.xxhash64("text")
    several = base.groupBy("k_id").agg(F.min(of_text).alias("one"), F.max(of_text).alias("two"))
    several = stage(several.filter("one <> two").select("k_id", F.lit(True).alias("several")), "ids")
    if several.isEmpty():
        # 0 for all ids there are, but not a literal: the optimizer would drop that from
        # one side's join keys only, and equal shuffles would no longer be shared.
        return base.withColumn("k_text", F.shiftright("k_id", 63))
    several = F.broadcast(several) if is_small(several) else several
    name = F.when(F.col("several"), of_text).otherwise(F.lit(0).cast("long"))
    return base.join(several, "k_id", "left").select(
        "doc_id", "text", "k_id", *rest, name.alias("k_text"))


def third(doc_id: Column, parts: int) -> Column:
    """crc32 of the id as text, modulo `parts`; a null id counts as the text 'null'."""
    return F.crc32(F.coalesce(doc_id.cast("string"), F.lit("null")).cast("binary")) % parts


def slices(batches: Iterator[pa.RecordBatch], column: str = "text",
           most: int = SLICE_BYTES) -> Iterator[pa.RecordBatch]:
    """Cut record batches so that each holds about `most` bytes of `column`, one row at least.

    After the last one the process gives back the memory that it no longer uses.
    """
    for batch in batches:
        if not batch.num_rows:
            continue
        _, offsets = text_bytes(batch.column(column))
        at = 0
        while at < batch.num_rows:
            end = int(np.searchsorted(offsets, offsets[at] + most, side="right")) - 1
            end = min(max(end, at + 1), batch.num_rows)
            yield batch.slice(at, end - at)
            at = end
    give_back()


def give_back() -> None:
    """Return freed memory to the system: a worker goes on to the tasks of other steps, beside the JVM."""
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)  # of glibc only
    if trim:
        trim(0)


def text_bytes(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The UTF-8 bytes of a string or binary column in one array, and where rows begin and end."""
    if column.null_count:
        column = column.fill_null(b"" if pa.types.is_binary(column.type) else "")
    wide = pa.types.is_large_string(column.type) or pa.types.is_large_binary(column.type)
    _, ends, data = column.buffers()
    count = len(column)
    if not count:
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    offsets = np.frombuffer(ends, np.int64 if wide else np.int32)
    offsets = offsets[column.offset: column.offset + count + 1].astype(np.int64)
    raw = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    return raw[offsets[0]: offsets[-1]], offsets - offsets[0]


def mix(values: np.ndarray) -> np.ndarray:
    """Spread the bits of 64-bit values."""
    values = values ^ (values >> np.uint64(30))
    values = values * _MIX_A
    values = values ^ (values >> np.uint64(27))
    values = values * _MIX_B
    return values ^ (values >> np.uint64(31))


def spans(starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """start, start + 1, ... of every span, one after another."""
    ends = np.cumsum(lengths)
    total = int(ends[-1]) if len(ends) else 0
    return np.arange(total, dtype=np.int64) + np.repeat(starts - (ends - lengths), lengths)


def binary_column(data: np.ndarray, lengths: np.ndarray) -> pa.Array:
    """A binary column whose values stand one after another in `data`."""
    offsets = np.zeros(len(lengths) + 1, np.int32)
    np.cumsum(lengths, out=offsets[1:])
    return pa.Array.from_buffers(
        pa.binary(), len(lengths), [None, pa.py_buffer(offsets), pa.py_buffer(np.ascontiguousarray(data))]
    )


_POWERS: dict[int, tuple[np.ndarray, np.ndarray]] = {}
_BASE = 0x9E3779B97F4A7C15


def _powers(count: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of an odd base and of its inverse modulo 2**64, up to a bound kept per process."""
    have = _POWERS.get(0)
    if have is None or len(have[0]) < count:
        size = 1 << max(16, int(count - 1).bit_length())
        size = size if size <= _KEPT_POWERS else count
        inverse = pow(_BASE, -1, 1 << 64)
        both = []
        for base in (_BASE, inverse):
            out = np.full(size, base, np.uint64)
            out[0] = 1
            both.append(np.multiply.accumulate(out))
        have = both[0], both[1]
        if size <= _KEPT_POWERS:
            _POWERS[0] = have
    return have[0][:count], have[1][:count]


def span_hashes(values: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """A 64-bit polynomial hash of values[start:end] for every span, in time linear in `values`."""
    forward, back = _powers(len(values) + 1)
    sums = np.zeros(len(values) + 1, np.uint64)
    np.cumsum(values * forward[: len(values)], out=sums[1:])
    return mix((sums[ends] - sums[starts]) * back[starts] + (ends - starts).astype(np.uint64))


def word_hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """span_hashes of bytes, for spans that start in order, a part of `data` at a time."""
    step = min(SLICE_BYTES, _HASH_BYTES)
    cuts = np.searchsorted(starts, np.arange(0, len(data) + step, step))
    out = [np.zeros(0, np.uint64)]
    for low, high in zip(cuts[:-1].tolist(), cuts[1:].tolist(), strict=True):
        if low < high:
            at, stop = int(starts[low]), int(ends[low:high].max())
            out.append(span_hashes(data[at:stop].astype(np.uint64), starts[low:high] - at, ends[low:high] - at))
    return np.concatenate(out)


def smallest_hashes(rows: DataFrame, group: str, most: int) -> DataFrame:
    """At most `most` rows of each group, those with the smallest `h`; `rows` is a written table.

    A hash is as likely small as large, so a bound that follows from the size of the
    group leaves about twice `most` rows to rank. No task ranks a whole group.
    """
    sizes = rows.groupBy(group).agg(F.count("*").alias("_of"))
    near = match_join(rows, stage(sizes, "groups"), [group], ["h"])
    place = F.col("h") / F.lit(2.0**64) + 0.5  # between 0 and 1
    near = near.filter(place * F.col("_of") <= 2 * most + 20).drop("_of")
    rank = F.row_number().over(Window.partitionBy(group).orderBy("h"))
    return near.withColumn("_rank", rank).filter(F.col("_rank") <= most).drop("_rank")


def texts_within(rows: list, group: str, most_bytes: int) -> list:
    """Rows in the order of their hashes whose texts fit in `most_bytes` for a group; texts stay whole."""
    held: dict = {}
    chosen = []
    for row in sorted(rows, key=lambda r: (str(r[group]), r["h"])):
        total = held.get(row[group], 0) + row["size"]
        if total <= most_bytes:
            held[row[group]] = total
            chosen.append(row)
    return chosen


def labelled_sample(docs: DataFrame, labels: DataFrame, label: str, held_out: Column,
                    per_class: int, class_bytes: int) -> list[tuple[str, int]]:
    """A bounded sample of (text, 0 or 1) of documents with a label that are not held out.

    At most `per_class` documents of each class, those with the smallest id hashes, and
    of these as many as have `class_bytes` bytes of text together; texts are whole, and
    one longer than that is left out. Both bounds say what the driver fetches. Of
    several labels of an id the largest counts, of several texts the smallest.
    """
    known = labels.filter(F.col(label).isNotNull() & F.col("doc_id").isNotNull())
    known = known.filter(~held_out).groupBy("doc_id").agg(
        F.max((F.col(label) == 1).cast("int")).alias("_label"))
    known = stage(known.withColumn("h", F.xxhash64("doc_id")), "labelled")
    chosen = stage(smallest_hashes(known, "_label", per_class), "chosen")
    texts = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text"))
    sizes = texts.select("doc_id", F.octet_length("text").alias("size")).join(F.broadcast(chosen), "doc_id")
    sizes = sizes.groupBy("doc_id", "_label", "h").agg(F.max("size").alias("size"))
    picked = texts_within(sizes.collect(), "_label", class_bytes)
    # As Arrow: a list of rows would start further Python workers, beside those of the next steps.
    picked = docs.sparkSession.createDataFrame(pa.table({
        "doc_id": pa.array([r.doc_id for r in picked], pa.int64()),
        "_label": pa.array([r["_label"] for r in picked], pa.int32())}))
    rows = texts.join(F.broadcast(picked), "doc_id").groupBy("doc_id", "_label").agg(F.min("text").alias("text"))
    return [(r.text, r["_label"]) for r in rows.orderBy("doc_id").collect()]


def word_spans(data: np.ndarray, offsets: np.ndarray, is_word: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Starts and ends of the runs of word bytes; no run goes on in the next text."""
    inside = is_word[data]
    edge = np.zeros(len(data), bool)
    edge[offsets[:-1][offsets[:-1] < len(data)]] = True
    begins, stops = inside.copy(), inside.copy()
    begins[1:] &= ~inside[:-1] | edge[1:]
    stops[:-1] &= ~inside[1:] | edge[1:]
    return np.flatnonzero(begins), np.flatnonzero(stops) + 1


def sigmoid(x: np.ndarray) -> np.ndarray:
    return 0.5 * (1 + np.tanh(0.5 * x))


class Adam:
    """Adam over a dict of arrays."""

    def __init__(self, weights: dict[str, np.ndarray], rate: float):
        self.weights, self.rate, self.steps = weights, rate, 0
        self.mean = {k: np.zeros_like(v) for k, v in weights.items()}
        self.square = {k: np.zeros_like(v) for k, v in weights.items()}

    def step(self, gradients: dict[str, np.ndarray]) -> None:
        self.steps += 1
        for name, gradient in gradients.items():
            mean, square = self.mean[name], self.square[name]
            mean += 0.1 * (gradient - mean)
            square += 0.001 * (gradient**2 - square)
            size = np.sqrt(square / (1 - 0.999**self.steps)) + 1e-8
            self.weights[name] -= self.rate * mean / (1 - 0.9**self.steps) / size

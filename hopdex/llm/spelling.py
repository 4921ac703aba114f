"""Spelling variants: words of a corpus that are one edit apart, and the form each goes by.

Two words one edit apart agree before the edit and behind it, so words meet in lists that
share a beginning and an end and leave a window for the edit. A list is sorted, and every
word is looked up in it with the rows of its edit matrix, three cells around the diagonal.
Words of a list that begin alike share these rows: the longest common prefixes of neighbours
say where a row goes on, and a range is left when its prefix is more than one edit away.
"""

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from hopdex.llm.common import text_bytes
from hopdex.operators.joins import match_join
from hopdex.session import stage

RUN = "[A-Za-zÀ-ÿ]+"
_CAPITALS, _SMALL = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
LEAST_LETTERS, LEAST_TIMES, ONE_IN = 5, 3, 97
# Words of a list that is looked through; longer lists get narrower windows.
LIST = 1_024
# Rows that one step of a task holds, and words it looks up together.
_HELD, _TOGETHER = 32_768, 2_048
_FAR = np.uint8(2)


def word_counts(docs: DataFrame) -> DataFrame:
    """(word, n): the words of all texts, some of them with a letter taken out."""
    low = F.translate("run", _CAPITALS, _SMALL)
    id_text = F.coalesce(F.col("doc_id").cast("string"), F.lit("null"))
    runs = docs.select(id_text.alias("id"), F.explode(
        F.regexp_extract_all(F.col("text"), F.lit(RUN), F.lit(0))).alias("run"))
    runs = runs.filter(F.char_length("run") >= LEAST_LETTERS).select("id", low.alias("run"))
    # A hash that ONE_IN divides takes out a letter; most runs have none and stay as they are.
    h = F.crc32(F.concat_ws(":", "id", "run").cast("binary"))
    at = F.when(h % ONE_IN == 0, h % F.char_length("run"))
    runs = runs.select("run", at.cast("int").alias("at"))
    cut = F.expr("concat(substring(run, 1, at), substring(run, at + 2))")
    words = runs.select(F.when(F.col("at").isNull(), F.col("run")).otherwise(cut).alias("word"))
    words = words.filter(F.char_length("word") >= LEAST_LETTERS)
    return words.groupBy("word").agg(F.count("*").alias("n")).filter(F.col("n") >= LEAST_TIMES)


def _with_key(rows: DataFrame) -> DataFrame:
    """Adds the list of a row: the size, the window and what stands around the window."""
    return rows.withColumn("key", F.expr(
        "concat_ws(' ', size, low, high, left(word, low), right(word, size - high))"))


def word_lists(words: DataFrame, longest: int = LIST) -> DataFrame:
    """(key, size, low, high, word, n): lists in which all words one edit apart meet.

    `size` is the length of the shorter of two words, and `low` to `high` the window for
    the edit, from letter to letter of it. A list with more than `longest` words is
    replaced by those of the two halves of its window, until the window is one letter;
    such a list has no more words than the square of the alphabet.
    """
    rows = words.withColumn("size", F.explode(F.array(F.char_length("word") - 1, F.char_length("word"))))
    rows = rows.filter(F.col("size") >= LEAST_LETTERS)
    rows = rows.withColumns({"low": F.lit(0), "high": F.col("size")})
    done = None
    while True:
        middle = F.expr("(low + high) div 2").cast("int")
        halves = F.array(F.struct(F.col("low").alias("l"), middle.alias("h")), F.struct(middle.alias("l"), F.col("high").alias("h")))
        rows = rows.withColumn("half", F.explode(halves)).withColumns({"low": F.col("half.l"), "high": F.col("half.h")})
        rows = stage(_with_key(rows.drop("half", "key")), "lists")
        large = rows.filter("high - low > 1").groupBy("key").agg(F.count("*").alias("rows"))
        large = stage(large.filter(F.col("rows") > longest).select("key", F.lit(True).alias("is_large")), "large")
        if large.isEmpty():
            return rows if done is None else done.unionByName(rows)
        marked = match_join(rows, large, ["key"], ["word"], how="left")
        small = marked.filter("is_large is null").drop("is_large")
        done = small if done is None else done.unionByName(small)
        rows = marked.filter("is_large").drop("is_large")


def letters(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Words as one byte a letter, their code points, and where they begin and end."""
    data, offsets = text_bytes(column)
    lead = data == 0xC3
    after = np.concatenate([[False], lead[:-1]]) if len(data) else lead
    codes = np.where(after, data + np.uint8(0x40), data)[~lead]
    return codes, offsets - np.concatenate([[0], np.cumsum(lead)])[offsets]


def common_prefixes(codes: np.ndarray, begin: np.ndarray, size: np.ndarray, new_list: np.ndarray) -> np.ndarray:
    """Letters that each word shares with the one before; -1 at the start of a list."""
    out = np.where(new_list, -1, 0)
    going = np.flatnonzero(~new_list)
    depth = 0
    while len(going):
        going = going[(size[going] > depth) & (size[going - 1] > depth)]
        going = going[codes[begin[going] + depth] == codes[begin[going - 1] + depth]]
        depth += 1
        out[going] = depth
    return out


def near_pairs(codes: np.ndarray, offsets: np.ndarray, new_list: np.ndarray, size: np.ndarray,
               low: np.ndarray, high: np.ndarray):
    """(word, near word) rows of sorted lists that are one edit apart, each found once.

    `size`, `low` and `high` say for every row what its list holds, see word_lists.
    """
    count = len(offsets) - 1
    begin, length = offsets[:-1], np.diff(offsets)
    shared = common_prefixes(codes, begin, length, new_list)
    first = np.flatnonzero(new_list)
    number = np.cumsum(new_list) - 1
    end = np.append(first[1:], count)
    # Places where a shared prefix of some depth ends: depth and place in one sorted number.
    breaks = np.sort((shared * count + np.arange(count))[shared >= 0])
    codes = np.append(codes, np.uint8(0))

    def letter(row, place, valid):
        return np.where(valid, codes[np.where(valid, begin[row] + place, 0)], 0)

    depths = low
    for at in range(0, count, _TOGETHER):
        waiting = np.arange(at, min(at + _TOGETHER, count))
        waiting = waiting[(end - first)[number[waiting]] > 1]
        waiting = waiting[np.argsort(depths[waiting], kind="stable")]
        started, depth = 0, int(depths[waiting[0]]) if len(waiting) else 0
        word = np.zeros(0, np.int64)
        a = b = word
        same = np.zeros(0, np.int64)
        rows = [np.zeros(0, np.uint8)] * 3
        while started < len(waiting) or len(word):
            # Words whose list shares `depth` letters start here: no edit so far.
            stop = int(np.searchsorted(depths[waiting], depth, side="right"))
            if stop > started:
                new = waiting[started:stop]
                started = stop
                word = np.concatenate([word, new])
                a, b = np.concatenate([a, first[number[new]]]), np.concatenate([b, end[number[new]]])
                same = np.concatenate([same, np.full(len(new), depth)])
                fresh = [np.where(depth >= 1, 1, 2), 0, np.where(length[new] > depth, 1, 2)]
                rows = [np.concatenate([old, np.broadcast_to(value, len(new)).astype(np.uint8)])
                        for old, value in zip(rows, fresh, strict=True)]
            # The words from a to b share `depth` letters; parted by the next one.
            begins = np.searchsorted(breaks, depth * count + a + 1)
            parts = np.searchsorted(breaks, depth * count + b) - begins
            entry = np.repeat(np.arange(len(word)), parts + 1)
            nth = np.arange(len(entry)) - np.repeat(np.cumsum(parts + 1) - (parts + 1), parts + 1)
            left = np.where(nth == 0, a[entry], 0)
            inner = nth > 0
            left[inner] = breaks[(begins[entry] + nth - 1)[inner]] - depth * count
            right = np.append(left[1:], 0)
            last = nth == parts[entry]
            right[last] = b[entry[last]]
            word, same = word[entry], same[entry]
            old = [r[entry] for r in rows]
            ended = length[left] == depth
            if ended.any():
                # The first word of a range may be the shared prefix itself: its last cell decides.
                some = np.flatnonzero(ended)
                cell = length[word[some]] - depth + 1
                inside = (cell >= 0) & (cell <= 2)
                some, cell = some[inside], cell[inside]
                near = np.stack([r[some] for r in old])[cell, np.arange(len(some))] == 1
                one, two = word[some[near]], left[some[near]]
                edit = same[some[near]]
                own = (edit >= low[one]) & ((edit < high[one]) | (high[one] == size[one]))
                own &= np.minimum(length[one], length[two]) == size[one]
                yield one[own], two[own]
            char = letter(left, depth, ~ended)
            own_length = length[word]
            before = letter(word, depth - 1, (depth >= 1) & (own_length >= depth))
            here = letter(word, depth, own_length > depth)
            behind = letter(word, depth + 1, own_length > depth + 1)
            new0 = np.minimum(old[0] + (char != before), old[1] + 1)
            new0 = np.where(own_length >= depth, new0, _FAR)
            new1 = np.minimum(np.minimum(old[1] + (char != here), old[2] + 1), new0 + 1)
            new1 = np.where(own_length > depth, new1, _FAR)
            new2 = np.minimum(old[2] + (char != behind), new1 + 1)
            new2 = np.where(own_length > depth + 1, new2, _FAR)
            same = same + ((same == depth) & (own_length > depth) & (char == here))
            # Left: more than one edit, or none up to the end of the window.
            keep = ~ended & (np.minimum(np.minimum(new0, new1), new2) <= 1)
            keep &= (same <= high[word]) | (high[word] == size[word])
            word, a, b, same = word[keep], left[keep], right[keep], same[keep]
            rows = [np.minimum(new[keep], _FAR).astype(np.uint8) for new in (new0, new1, new2)]
            depth += 1
            if not len(word) and started < len(waiting):
                depth = max(depth, int(depths[waiting[started]]))


def _near(batches):
    """(word, n_near, top, form) rows: how many near words a list has for a word, and the most frequent."""
    def found(table):
        words = table.column("word").combine_chunks()
        codes, offsets = letters(words)
        key = table.column("key").combine_chunks().dictionary_encode().indices.to_numpy()
        new_list = np.append(True, key[1:] != key[:-1])
        size, low, high = (table.column(c).to_numpy().astype(np.int64) for c in ("size", "low", "high"))
        n = table.column("n").to_numpy()
        pairs = list(near_pairs(codes, offsets, new_list, size, low, high))
        one = np.concatenate([p[0] for p in pairs] or [np.zeros(0, np.int64)])
        two = np.concatenate([p[1] for p in pairs] or [np.zeros(0, np.int64)])
        by = np.lexsort((two, -n[two], one))  # rows of a list are in the order of the words
        one, two = one[by], two[by]
        head = np.flatnonzero(np.append(True, one[1:] != one[:-1])) if len(one) else np.zeros(0, np.int64)
        counts = np.diff(np.append(head, len(one)))
        return pa.record_batch({
            "word": words.take(pa.array(one[head])), "n_near": pa.array(counts, pa.int64()),
            "top": pa.array(n[two[head]], pa.int64()), "form": words.take(pa.array(two[head]))})

    held, count = [], 0
    for batch in batches:
        if not batch.num_rows:
            continue
        held.append(batch)
        count += batch.num_rows
        if count < _HELD:
            continue
        table = pa.Table.from_batches(held)
        keys = table.column("key").to_pylist()
        cut = len(keys)
        while cut and keys[cut - 1] == keys[-1]:
            cut -= 1  # the last list may go on
        if cut:
            yield found(table.slice(0, cut))
        held, count = table.slice(cut).to_batches(), len(keys) - cut
    if held:
        yield found(pa.Table.from_batches(held))


def _roots(forms: DataFrame) -> DataFrame:
    """(word, root): the last word that forms lead to. Every step doubles the way that is known."""
    while True:
        there = forms.select(F.col("word").alias("root"), F.col("root").alias("further"))
        after = match_join(forms, there, ["root"], ["word"], how="left")
        after = stage(after.select("word", F.coalesce("further", "root").alias("root"),
                                   F.col("further").isNotNull().alias("moved")), "roots")
        if after.filter("moved").isEmpty():
            return after.select("word", "root")
        forms = after.select("word", "root")


def group_variants(docs: DataFrame, longest: int = LIST) -> DataFrame:
    """The words of a corpus with their near words and the form each goes by.

    Words are runs of letters (A to Z in lower case, and the letters up to U+00FF) of five
    letters or more that occur three times or more; a run loses a letter where the hash of its
    document and itself says so. Two are near if one letter put in, left out or changed makes one the
    other. Returns word, n, n_near, form (the near word with the largest n, of equals the first by
    code points, if it has twice the word's n or more), form_n, and root (the last word that
    forms lead to, the word itself without one).

    Null and empty texts have no words, a null id counts as the text 'null', repeated rows
    count again; other columns are ignored; an empty table gives none.
    """
    texts = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text"))
    words = stage(word_counts(texts), "words")
    lists = word_lists(words, longest).repartition("key").sortWithinPartitions("key", "word")
    near = lists.mapInArrow(_near, "word string, n_near long, top long, form string")
    best = near.groupBy("word").agg(
        F.sum("n_near").alias("n_near"), F.min(F.struct((-F.col("top")).alias("less"), "form")).alias("best"))
    rated = words.join(best, "word", "left")
    has_form = -F.col("best.less") >= 2 * F.col("n")
    rated = stage(rated.select(
        "word", "n", F.coalesce("n_near", F.lit(0)).alias("n_near"), F.when(has_form, F.col("best.form")).alias("form"),
        F.when(has_form, -F.col("best.less")).alias("form_n")), "rated")
    roots = _roots(rated.filter("form is not null").select("word", F.col("form").alias("root")))
    return rated.join(roots, "word", "left").select(
        "word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")

"""Quality rules for texts, with the frequency of their lines across documents.

Everything is a column expression or an aggregate; no text is shuffled, only hashes
of lines and counts.
"""

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from hopdex.llm.common import LAST_ID

SPACE = r"[\x20\x09-\x0D]"
_SPACES = " \t\n\x0b\x0c\r"
_SYMBOLS = "#*$%&|<>"
_WINDOW = 8
# A line is boilerplate if more documents of its host hold it.
MOST_DOCS = 20
# A document is depleted if less than this part of its words remains.
LEAST_LEFT = 0.3


def _repeat_words(words: Column) -> Column:
    """Words inside windows of eight that occur twice or more, the first included.

    Windows are compared by 64-bit hashes and sorted with their places, so the work
    is n log n for any text. Texts without a repeated window stop after one look.
    """
    places = F.sequence(F.lit(1), F.size(words) - (_WINDOW - 1))
    hashes = F.transform(places, lambda i: F.xxhash64(F.slice(words, i, _WINDOW)))

    def covered(hashes: Column) -> Column:
        pairs = F.sort_array(F.transform(hashes, lambda h, i: F.struct(h.alias("h"), i.alias("i"))))
        return F.transform(F.array(pairs), _twice)[0]

    def _twice(pairs: Column) -> Column:
        last = F.size(pairs) - 1
        again = F.filter(pairs, lambda p, i: (
            F.when(i > 0, pairs[F.greatest(i - 1, F.lit(0))]["h"] == p["h"]).otherwise(False)
            | F.when(i < last, pairs[F.least(i + 1, last)]["h"] == p["h"]).otherwise(False)
        ))
        found = F.sort_array(F.transform(again, lambda p: p["i"]))
        return F.transform(F.array(found), _length)[0]

    def _length(found: Column) -> Column:
        steps = F.transform(found, lambda p, i: F.when(
            i > 0, F.least(F.lit(_WINDOW), p - found[F.greatest(i - 1, F.lit(0))])
        ).otherwise(_WINDOW))
        return F.aggregate(steps, F.lit(0), lambda a, b: a + b)

    def of(hashes: Column) -> Column:
        distinct = F.size(F.array_distinct(hashes)) == F.size(hashes)
        return F.when(distinct, 0).otherwise(covered(hashes))

    count = F.transform(F.array(hashes), of)[0]  # the array names the hashes, computed once
    return F.when(F.size(words) < _WINDOW, 0).otherwise(count).cast("long")


def base_measures(docs: DataFrame) -> DataFrame:
    """Adds the word and symbol counts of `text` and base_failed."""
    text = F.coalesce(F.col("text"), F.lit(""))
    size = F.char_length(text)
    lines = F.filter(F.split(text, "\n"), lambda line: line.rlike(r"[^\x20\x09-\x0D]"))
    cut = docs.select(
        *docs.columns,
        F.array_remove(F.split(text, SPACE + "+"), "").alias("_words"),
        lines.alias("_lines"),
        F.char_length(F.translate(text, _SPACES, "")).cast("long").alias("word_chars"),
        (size - F.char_length(F.translate(text, _SYMBOLS, ""))).cast("long").alias("n_symbols"),
    )
    counted = cut.select(
        *docs.columns, "word_chars", "n_symbols",
        F.size("_words").cast("long").alias("n_words"),
        (F.size("_lines") - F.size(F.array_distinct("_lines"))).cast("long").alias("n_dup_lines"),
        _repeat_words(F.col("_words")).alias("n_repeat_words"),
    )
    failed = (F.col("n_words") < 20) | (100 * F.col("n_repeat_words") > 30 * F.col("n_words"))
    return counted.withColumn("base_failed", failed)


def _normal(text: Column) -> Column:
    """Lines in lower case, digits alike, runs of white space as one blank."""
    spaced = F.regexp_replace(F.lower(text), r"[\x20\x09\x0B-\x0D]+", " ")
    return F.translate(spaced, "0123456789", "0000000000")


def line_rows(docs: DataFrame) -> DataFrame:
    """A row for each normalised line of a document: its hash, host and words."""
    lines = docs.select(*_KEY, F.explode(F.split(_normal(F.col("text")), "\n")).alias("_line"))
    lines = lines.select(*_KEY, F.trim("_line").alias("_line")).filter("_line <> ''")
    words = F.char_length("_line") - F.char_length(F.translate("_line", " ", "")) + 1
    return lines.select(*_KEY, F.xxhash64("_line").alias("line"), words.cast("long").alias("words"))


_KEY = ["k_host", "k_id", "k_text"]


def _hosted(docs: DataFrame, host: str) -> DataFrame:
    """doc_id, text and the keys of a document."""
    text = F.coalesce(F.col("text"), F.lit(""))
    return docs.select(
        F.col("doc_id"), text.alias("text"), F.coalesce(F.col(host), F.lit("")).alias("k_host"),
        F.coalesce("doc_id", F.lit(LAST_ID)).alias("k_id"), F.xxhash64(text).alias("k_text"),
    )


def _frequent(lines: DataFrame, most_docs: int) -> DataFrame:
    """(k_host, line) of the lines found in more than `most_docs` documents of a host."""
    # Distinct documents first, so that neither a copy nor a line gathers in one task.
    return (
        lines.select("k_host", "line", "k_id", "k_text").distinct()
        .groupBy("k_host", "line").agg(F.count("*").alias("n"))
        .filter(F.col("n") > most_docs).select("k_host", "line")
    )


def drop_frequent_lines(docs: DataFrame, host: str = "source", most_docs: int = MOST_DOCS) -> DataFrame:
    """Every document without its frequent lines.

    Lines, split at line feeds, that after normalising are found in more than `most_docs`
    documents of the same host are taken out; all others stay as they were written,
    blank ones included. Returns doc_id, text, n_lines and n_removed. A null text is
    empty; a null host is one host; a null id is one document per text; a repeated row
    gets the same result again; an empty table gives none. Other columns are ignored.
    """
    docs = _hosted(docs, host)
    lines = line_rows(docs)
    found = lines.select(*_KEY, "line").distinct().join(_frequent(lines, most_docs), ["k_host", "line"])
    found = found.groupBy(*_KEY).agg(F.collect_set("line").alias("_gone"))
    written = F.split("text", "\n")
    named = F.transform(F.split(_normal(F.col("text")), "\n"), lambda line: F.trim(line))
    marked = F.zip_with(written, named, lambda line, name: F.struct(
        line.alias("line"), ((name != "") & F.array_contains("_gone", F.xxhash64(name))).alias("gone")))
    cut = docs.join(found, _KEY, "left").select(
        "doc_id", F.when(F.col("_gone").isNull(), F.transform(written, lambda line: F.struct(
            line.alias("line"), F.lit(False).alias("gone")))).otherwise(marked).alias("_lines"))
    left = F.transform(F.filter("_lines", lambda x: ~x["gone"]), lambda x: x["line"])
    return cut.select(
        "doc_id", F.array_join(left, "\n").alias("text"),
        F.size("_lines").cast("long").alias("n_lines"),
        (F.size("_lines") - F.size(left)).cast("long").alias("n_removed"),
    )


def rate_documents(docs: DataFrame, host: str = "source", most_docs: int = MOST_DOCS,
                   least_left: float = LEAST_LEFT) -> DataFrame:
    """Counts and a verdict for every document.

    Words are runs of anything but ASCII white space. base_failed: fewer than 20
    words, or over 30 % of them in repeated windows of eight. `kept` is false for
    those and for depleted documents: normalised lines found in more than
    `most_docs` documents of the same host are taken out, and a document with less
    than `least_left` of its words left goes.

    Returns doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words,
    base_failed, removed_words, kept. A null or empty text has no words and fails; a
    null host is one host, a null id one document per text. A repeated row counts
    once and gets the same result again. Other columns are ignored; an empty table
    gives none.
    """
    docs = _hosted(docs, host)
    lines = line_rows(docs)
    frequent = _frequent(lines, most_docs)
    # A repeated row would count its lines twice: its rows agree, so one average is right.
    per_line = lines.join(frequent, ["k_host", "line"])
    removed = per_line.groupBy(*_KEY).agg(F.sum("words").alias("removed_words"))
    measured = base_measures(docs).drop("text")
    copies = measured.groupBy(*_KEY).agg(F.count("*").alias("_rows"))
    removed = removed.join(copies, _KEY).select(
        *_KEY, (F.col("removed_words") / F.col("_rows")).cast("long").alias("removed_words"))
    rated = measured.join(removed, _KEY, "left")
    gone = F.coalesce("removed_words", F.lit(0))
    left = F.col("n_words") - gone
    kept = ~F.col("base_failed") & (left >= least_left * F.col("n_words"))
    return rated.select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
        "base_failed", gone.alias("removed_words"), kept.alias("kept"),
    )


ORACLE = rf"""
WITH d AS (SELECT doc_id, coalesce(source, '') AS host, coalesce(text, '') AS text FROM documents),
w AS (SELECT *, list_filter(string_split_regex(text, '[\x20\x09-\x0D]+'), lambda x: x <> '') AS words,
        list_filter(string_split(text, chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) AS lines FROM d),
m AS (SELECT doc_id, host, text, len(words) AS n_words,
        length(array_to_string(words, '')) AS word_chars,
        length(regexp_replace(text, '[^#*$%&|<>]', '', 'g')) AS n_symbols,
        len(lines) - len(list_distinct(lines)) AS n_dup_lines, words FROM w),
g AS (SELECT doc_id, i, array_to_string(words[i:i + 7], ' ') AS gram
      FROM m, LATERAL unnest(range(1, n_words - 6)) AS t(i)),
r AS (SELECT doc_id, i FROM (SELECT *, count(*) OVER (PARTITION BY doc_id, gram) AS n FROM g) WHERE n > 1),
c AS (SELECT doc_id, count(DISTINCT i + k) AS n_repeat_words FROM r, range(8) AS s(k) GROUP BY doc_id),
l AS (SELECT doc_id, host, trim(translate(unnest(string_split(
        regexp_replace(lower(text), '[\x20\x09\x0B-\x0D]+', ' ', 'g'), chr(10))), '0123456789', '0000000000')) AS line FROM d),
f AS (SELECT host, line FROM l WHERE line <> '' GROUP BY host, line HAVING count(DISTINCT doc_id) > {MOST_DOCS}),
x AS (SELECT doc_id, sum(len(string_split(line, ' '))) AS removed FROM l JOIN f USING (host, line) GROUP BY doc_id),
b AS (SELECT m.*, coalesce(c.n_repeat_words, 0) AS n_repeat_words, coalesce(x.removed, 0) AS removed
      FROM m LEFT JOIN c USING (doc_id) LEFT JOIN x USING (doc_id)),
v AS (SELECT *, n_words < 20 OR 100 * n_repeat_words > 30 * n_words AS base_failed FROM b)
SELECT doc_id, CAST(n_words AS BIGINT) AS n_words, CAST(word_chars AS BIGINT) AS word_chars,
       CAST(n_symbols AS BIGINT) AS n_symbols, CAST(n_dup_lines AS BIGINT) AS n_dup_lines,
       CAST(n_repeat_words AS BIGINT) AS n_repeat_words, base_failed,
       NOT base_failed AND n_words - removed >= {LEAST_LEFT} * n_words AS kept
FROM v
"""

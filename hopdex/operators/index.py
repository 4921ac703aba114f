"""Postings and word entries."""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from hopdex.functions.text import field_counts, letter_of, term_counts, tokenize
from hopdex.operators.extract import is_success
from hopdex.operators.joins import is_small, match_join, only_keys
from hopdex.schemas import WORD_ENTRIES, WORD_ENTRY_KEY


def build_postings(pages: DataFrame) -> DataFrame:
    """(term, url, frequency, title_hits) of the successful pages.

    `pages` has one row per URL, so every term of a URL is counted inside its
    row: no shuffle, whatever the number of pages.
    """
    text, title = F.coalesce("text", F.lit("")), F.coalesce("title", F.lit(""))
    counts = field_counts(tokenize(text), tokenize(title))
    return pages.filter(is_success()).select("url", F.inline(counts)).select(
        "term", "url", "frequency", "title_hits"
    )


def build_word_entries(pages: DataFrame, discoveries: DataFrame) -> DataFrame:
    """(word, url, origin_url, depth, frequency), one row per key.

    `discoveries` carries origin_url. Jobs that share origin and depth share
    their entries. Each page travels to its discoveries as one row of counts;
    the words are unfolded after the join.
    """
    provenance = discoveries.select("url", "origin_url", "depth").distinct()
    pages = pages.filter(is_success()).select("url", "text")
    few = is_small(discoveries)
    if few:  # a short list of discoveries: count only the pages it names
        pages = only_keys(pages, discoveries, ["url"])
    counted = pages.select("url", term_counts(tokenize(F.coalesce("text", F.lit("")))).alias("counts"))
    if few:
        joined = counted.join(F.broadcast(provenance), "url")
    else:
        joined = match_join(
            provenance, counted, ["url"], ["origin_url", "depth"],
            broadcast=None, left_counts=discoveries,
        )
    return joined.select("url", "origin_url", "depth", F.inline("counts")).select(
        F.col("term").alias("word"), "url", "origin_url", "depth", F.col("n").alias("frequency")
    )


def changed_entries(new: DataFrame, stored: DataFrame) -> DataFrame:
    """Rows of `new` that the store lacks or holds with another frequency."""
    return new.join(stored.select(*WORD_ENTRIES.names), WORD_ENTRIES.names, "left_anti")


def dedup_entries(entries: DataFrame) -> DataFrame:
    """One row per key. Key and frequency agree unless a source holds conflicts;
    then the highest load position `_position` wins, where there is one.

    Rows are shuffled as they are: copies of a key come from different loads, so a task
    that counted first would hold nearly all of its rows, which is no bounded number.
    """
    if "_position" in entries.columns:
        last = F.max_by("frequency", "_position")
    else:
        last = F.max("frequency")
    return entries.repartition(*WORD_ENTRY_KEY).groupBy(*WORD_ENTRY_KEY).agg(last.alias("frequency"))


def with_letter(df: DataFrame, word: str) -> DataFrame:
    return df.withColumn("letter", letter_of(F.col(word)))

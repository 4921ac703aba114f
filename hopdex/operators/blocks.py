"""Postings in blocks of numbered pages, and a search that moves blocks instead of rows.

Pages get numbers once, and all pages with the same number divided by SPAN are one
block. A block of a term holds its pages there as one array of at most SPAN entries, so
no array grows with the corpus, and a term of any frequency is cut into many rows. Every
page of a block is numbered in one partition, so a block is put together before its
rows are shuffled.
"""

from typing import NamedTuple

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from hopdex.functions.text import field_counts, tokenize
from hopdex.operators.extract import is_success
from hopdex.operators.joins import is_light, match_join
from hopdex.operators.search import RESULT_COLUMNS, TITLE_WEIGHT, query_terms
from hopdex.session import stage

# Pages of a block: a power of two below the rows that one partition can number (2 ** 33).
SPAN = 4096


class BlockIndex(NamedTuple):
    """blocks: (term, block, entries); shown: (page, url, title, job_id, origin_url, depth).

    An entry is (page, frequency, title_hits), in the order of the pages.
    """

    blocks: DataFrame
    shown: DataFrame


def _block(page: Column, span: int) -> Column:
    return F.shiftright(page, span.bit_length() - 1)


def index_blocks(pages: DataFrame, discoveries: DataFrame, span: int = SPAN) -> BlockIndex:
    """Number the successful pages and write their blocks and what a result shows of them.

    `pages` has one row per URL. Failed pages and pages without a word have no entries;
    a discovery without a successful page is not shown.
    """
    if span & (span - 1):
        raise ValueError("span must be a power of two")
    numbered = pages.filter(is_success()).select(
        F.monotonically_increasing_id().alias("page"), "url", "title", "text")
    # Written, as a task that runs again could number its pages in another order.
    numbered = stage(numbered, "numbered")
    text, title = F.coalesce("text", F.lit("")), F.coalesce("title", F.lit(""))
    counts = numbered.select("page", F.inline(field_counts(tokenize(text), tokenize(title))))
    entry = F.struct("page", "frequency", "title_hits")
    blocks = counts.groupBy("term", _block(F.col("page"), span).alias("block")).agg(
        F.sort_array(F.collect_list(entry)).alias("entries"))
    known = discoveries.select("job_id", "url", "origin_url", "depth")
    shown = match_join(known, numbered.select("page", "url", "title"), ["url"], ["job_id"], broadcast=None)
    return BlockIndex(
        stage(blocks, "blocks"),
        stage(shown.select("page", "url", "title", "job_id", "origin_url", "depth"), "shown"),
    )


def score_pages(queries: DataFrame, blocks: DataFrame) -> DataFrame:
    """(query_id, page, score, frequency) of all pages with a word of a query.

    Only blocks are shuffled, by query and block; a page's words then lie in one
    partition already. A key holds one row for each word of the query at most.
    """
    met = match_join(blocks, query_terms(queries), ["term"], ["block"], ["query_id"])
    met = met.repartition("query_id", "block")
    entries = met.select("query_id", "block", "times", F.inline("entries"))
    gain = F.col("frequency").cast("bigint") + TITLE_WEIGHT * F.col("title_hits").cast("bigint")
    return entries.groupBy("query_id", "block", "page").agg(
        F.sum(F.col("times") * gain).alias("score"),
        F.sum(F.col("times") * F.col("frequency")).alias("frequency"),
    ).drop("block")


def search_blocks(queries: DataFrame, index: BlockIndex) -> DataFrame:
    """The results of the default search, from a block index.

    Pages are joined by number; URLs and titles come with the discoveries. Queries
    without a word, or without a known one, have no result.
    """
    scored = score_pages(queries, index.blocks)
    if is_light(index.shown):
        found = scored.join(F.broadcast(index.shown), "page")
    else:
        found = match_join(
            index.shown, stage(scored, "scored"), ["page"], ["job_id"], ["query_id"], broadcast=None)
    title = F.coalesce(F.nullif(F.col("title"), F.lit("")), F.col("url"))
    return found.withColumn("title", title).withColumnRenamed("url", "relevant_url").select(*RESULT_COLUMNS)

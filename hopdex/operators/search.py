"""Batches of free-text searches over the index.

Both rankers take all queries of a batch at once and run as one plan of joins
and aggregations; neither uses Python workers.
"""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from hopdex.functions.text import term_counts, tokenize
from hopdex.operators.extract import is_success
from hopdex.operators.index import with_letter
from hopdex.operators.joins import is_light, is_small, match_join, only_keys
from hopdex.operators.ranking import rank_within
from hopdex.session import stage

# Fixed values of the two scoring formulas.
TITLE_WEIGHT = 5
TERM_WEIGHT = 10
TERM_BONUS = 1000
DEPTH_COST = 5

# Up to this many distinct terms are handed to the scan of a stored index.
TERM_FILTER = 1000

RESULT_COLUMNS = [
    "query_id", "relevant_url", "origin_url", "depth", "score", "frequency", "title"
]


def query_terms(queries: DataFrame) -> DataFrame:
    """(query_id, term, times) with repeats counted."""
    counts = F.inline(term_counts(tokenize(F.col("text"))))
    return queries.select("query_id", counts).withColumnRenamed("n", "times")


def _matches(index: DataFrame, terms: DataFrame, by_page: bool = False) -> DataFrame:
    """Index rows of the asked terms. A term can own a large share of either side.

    With `by_page` and a short list of terms the rows of a page (and of an origin and depth,
    where there are those) meet in one task before the queries multiply them, so that sums
    over them need no further shuffle. Stored postings are sorted by term: a task would
    else hold a sum for most of its rows.
    """
    on = ["term"]
    if "letter" in index.columns:
        terms, on = with_letter(terms, "term"), ["letter", "term"]
        index = _asked_part(index, terms)
    # A page can be found from very many origins: all columns that tell rows apart spread them.
    spread = [c for c in ("url", "origin_url", "depth") if c in index.columns]
    if by_page and is_small(terms):
        # By number, as what the queries make of a partition is not seen by who merges small ones.
        parts = int(index.sparkSession.conf.get("spark.sql.shuffle.partitions"))
        index = only_keys(index, terms, on).repartition(parts, *spread)
    return match_join(index, terms, on, spread, ["query_id"])


def _asked_part(index: DataFrame, terms: DataFrame) -> DataFrame:
    """The part of a stored index that the terms can touch, for the scan to prune.

    Letters choose the folders; there are no more of them than token characters.
    A short list of terms also becomes a filter that skips files by their statistics.
    """
    letters = [r.letter for r in terms.select("letter").distinct().collect()]
    index = index.filter(F.col("letter").isin(letters))
    asked = terms.select("term").distinct().limit(TERM_FILTER + 1).collect()
    if len(asked) <= TERM_FILTER:
        index = index.filter(F.col("term").isin([r.term for r in asked]))
    return index


def _titled(scored: DataFrame, pages: DataFrame, how: str) -> DataFrame:
    """Add page titles. `scored` is a written table, so its size is known.

    A small result never makes the page table move: the needed titles are picked
    by a broadcast of the result's URLs.
    """
    titles = pages.select("url", "title")
    spread = [c for c in ("query_id", "origin_url", "depth") if c in scored.columns]
    if is_small(scored):
        needed = titles.join(F.broadcast(scored.select("url").distinct()), "url", "left_semi")
        needed = stage(needed, "titles")
        if is_light(needed):  # a title can be as long as its page
            return scored.join(F.broadcast(needed), "url", how)
        titles = needed
    return match_join(scored, titles, ["url"], spread, how=how, broadcast=None)


def search_default(
    queries: DataFrame, postings: DataFrame, pages: DataFrame, discoveries: DataFrame
) -> DataFrame:
    """Text frequency plus weighted title hits; a repeated query word counts again.

    Every discovery of a matching page gives a row, so two jobs give two rows.
    """
    gain = F.col("frequency").cast("bigint") + TITLE_WEIGHT * F.col("title_hits").cast("bigint")
    scored = (
        _matches(postings, query_terms(queries), by_page=True)
        .groupBy("query_id", "url")
        .agg(
            F.sum(F.col("times") * gain).alias("score"),
            F.sum(F.col("times") * F.col("frequency")).alias("frequency"),
        )
    )
    scored = stage(scored, "scored")
    titled = _titled(scored, pages.filter(is_success()), "inner")
    known = discoveries.select("job_id", "url", "origin_url", "depth")
    titled = stage(titled, "titled")
    if is_light(titled):
        found = known.join(F.broadcast(titled), "url")
    else:
        found = match_join(known, titled, ["url"], ["job_id"], ["query_id"], broadcast=None)
    return _result(found)


def search_relevance(queries: DataFrame, entries: DataFrame, pages: DataFrame) -> DataFrame:
    """Weighted frequency plus a bonus per distinct matched word, less a depth cost.

    Ignores titles when scoring and needs no page row: without one the URL stands
    in for the title.
    """
    index = entries.withColumnRenamed("word", "term")
    scored = (
        _matches(index, query_terms(queries).drop("times"), by_page=True)
        .groupBy("query_id", "url", "origin_url", "depth")
        .agg(
            F.sum(TERM_WEIGHT * F.col("frequency").cast("bigint") + TERM_BONUS).alias("_gain"),
            F.sum("frequency").alias("frequency"),
        )
        .withColumn("score", F.col("_gain") - DEPTH_COST * F.col("depth"))
        .drop("_gain")
    )
    return _result(_titled(stage(scored, "scored"), pages, "left"))


def _result(found: DataFrame) -> DataFrame:
    title = F.coalesce(F.nullif(F.col("title"), F.lit("")), F.col("url"))
    return found.withColumn("title", title).withColumnRenamed("url", "relevant_url").select(
        *RESULT_COLUMNS
    )


def search(
    queries: DataFrame,
    postings: DataFrame,
    entries: DataFrame,
    pages: DataFrame,
    discoveries: DataFrame,
) -> DataFrame:
    """Each query by its `sort_by`: exactly `relevance`, or else the default."""
    by_relevance = F.col("sort_by").eqNullSafe("relevance")
    plain = search_default(queries.filter(~by_relevance), postings, pages, discoveries)
    exact = search_relevance(queries.filter(by_relevance), entries, pages)
    return plain.withColumn("sort_by", F.lit("default")).unionByName(
        exact.withColumn("sort_by", F.lit("relevance"))
    )


def in_result_order(results: DataFrame) -> DataFrame:
    """All results in the documented total order, as one distributed sort."""
    return results.orderBy("query_id", F.desc("score"), "depth", "relevant_url", "origin_url")


def ranked(results: DataFrame) -> DataFrame:
    """Adds each row's position in its query's result list."""
    order = [F.desc("score"), F.col("depth"), F.col("relevant_url"), F.col("origin_url")]
    return rank_within(results, ["query_id"], order, "position")


def plain_result_json(results: DataFrame) -> DataFrame:
    """(query_id, result): the shorter document that a search without `sort_by` answers with."""
    # The keys of the document, in this order.
    document = F.struct(
        F.col("relevant_url").alias("url"), "relevant_url", "origin_url", "depth", "frequency", "score", "title",
    )
    return results.select(
        "query_id", F.to_json(document, {"ignoreNullFields": "false"}).alias("result"))


def result_json(results: DataFrame) -> DataFrame:
    """(query_id, sort_by, result): one JSON document per result row."""
    # The keys of the document, in this order.
    relevance = F.when(F.col("sort_by") == "relevance", F.col("score"))
    document = F.struct(
        F.col("relevant_url").alias("url"),
        "relevant_url",
        "origin_url",
        F.col("origin_url").alias("origin"),
        "depth",
        "frequency",
        relevance.alias("relevance_score"),
        "score",
        "title",
    )
    return results.select(
        "query_id", "sort_by", F.to_json(document, {"ignoreNullFields": "false"}).alias("result")
    )

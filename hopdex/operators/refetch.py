"""Pages that are fetched anew: signed changes of counts instead of a rebuild.

The old text of a page is counted with a minus, the new one with a plus. What does not
cancel is what changes in the index; words that both texts hold equally often are never
touched, and neither are the rows of other pages.
"""

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from hopdex.functions.text import field_counts, tokenize
from hopdex.operators.extract import is_success
from hopdex.operators.joins import drop_known, match_join, only_keys
from hopdex.schemas import WORD_ENTRY_KEY
from hopdex.session import stage

_FIELDS = ["frequency", "title_hits"]


def _counts(side: str, sign: int) -> Column:
    """Signed counts of one side of a pair of pages; none if it is absent or failed."""
    good = F.coalesce(is_success(F.col(f"{side}.error"), F.col(f"{side}.status_code")), F.lit(False))
    text = [F.coalesce(F.when(good, F.col(f"{side}.{c}")), F.lit("")) for c in ("text", "title")]
    return F.transform(field_counts(*map(tokenize, text)), lambda e: F.struct(
        e["term"].alias("term"), *[(sign * e[c]).alias(c) for c in _FIELDS]))


def posting_changes(old: DataFrame, fetched: DataFrame) -> DataFrame:
    """(term, url, frequency, title_hits): what the fetched pages add to the postings.

    Both have one row per URL. A URL that was not there counts as empty, and so does
    a page that failed, before or now. Values are signed; a row with two zeros is left out.
    """
    columns = ["url", "title", "text", "status_code", "error"]
    fetched = fetched.select("url", F.struct(*columns).alias("new"))
    old = only_keys(old.select(*columns), fetched, ["url"]).select("url", F.struct(*columns).alias("old"))
    both = fetched.join(old, "url", "left")
    signed = both.select("url", F.inline(F.concat(_counts("new", 1), _counts("old", -1))))
    changes = signed.groupBy("url", "term").agg(*[F.sum(c).alias(c) for c in _FIELDS])
    return changes.filter("frequency <> 0 OR title_hits <> 0").select("term", "url", *_FIELDS)


def entry_changes(changes: DataFrame, discoveries: DataFrame) -> DataFrame:
    """The same for word entries: every origin and depth of a URL gets its change."""
    places = only_keys(discoveries, changes, ["url"]).select("url", "origin_url", "depth").distinct()
    text = changes.filter("frequency <> 0").select(F.col("term").alias("word"), "url", "frequency")
    joined = match_join(text, places, ["url"], ["word"], ["origin_url", "depth"])
    return joined.select(*WORD_ENTRY_KEY, "frequency")


def _applied(stored: DataFrame, changes: DataFrame, key: list[str], values: list[str]) -> DataFrame:
    """Stored rows plus their changes; rows whose values have all become zero go."""
    changes = stage(changes, "changes")
    same = stored.schema
    rest = drop_known(stored, changes, key)
    touched = only_keys(stored, changes, key).select(*key, *values).unionByName(
        changes.select(*key, *[F.col(c).cast(same[c].dataType).alias(c) for c in values]))
    summed = touched.groupBy(*key).agg(*[F.sum(c).cast(same[c].dataType).alias(c) for c in values])
    left = summed.filter(" OR ".join(f"{c} <> 0" for c in values))
    return rest.select(*key, *values).unionByName(left)


def change_postings(postings: DataFrame, changes: DataFrame) -> DataFrame:
    """Postings after the changes of `posting_changes`."""
    return _applied(postings, changes, ["term", "url"], _FIELDS)


def change_entries(entries: DataFrame, changes: DataFrame) -> DataFrame:
    """Word entries after the changes of `entry_changes`."""
    return _applied(entries, changes, WORD_ENTRY_KEY, ["frequency"])

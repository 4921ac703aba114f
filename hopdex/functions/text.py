"""Text expressions: tokens, per-row term counts, whitespace, letter buckets.

Everything here is a plain Column expression, so it runs inside the JVM.
"""

from pyspark.sql import Column
from pyspark.sql import functions as F

# The token shape (applied to lower-cased text) and the code
# points that count as white space when text chunks are collapsed.
TOKEN_PATTERN = r"[a-z0-9]+(?:'[a-z0-9]+)?"
SPACE_RANGES = [
    (0x0009, 0x000D), (0x001C, 0x0020), (0x0085, 0x0085), (0x00A0, 0x00A0),
    (0x1680, 0x1680), (0x2000, 0x200A), (0x2028, 0x2029), (0x202F, 0x202F),
    (0x205F, 0x205F), (0x3000, 0x3000),
]
_SPACES = "".join(chr(c) for first, last in SPACE_RANGES for c in range(first, last + 1))


def tokenize(text: Column) -> Column:
    """Array of lower-case ASCII tokens, in text order, repeats kept."""
    return F.regexp_extract_all(F.lower(text), F.lit(TOKEN_PATTERN), F.lit(0))


def plain_spaces(text: Column) -> Column:
    """Every white-space character becomes a blank.

    A character map and a regex over blanks runs ten times as fast as a regex
    with the whole class.
    """
    return F.translate(text, _SPACES, " " * len(_SPACES))


def collapse_ws(text: Column) -> Column:
    """White-space runs become one space; leading and trailing space goes."""
    return F.trim(F.regexp_replace(plain_spaces(text), " +", " "))


def letter_of(word: Column) -> Column:
    """Bucket of a word: its lower-cased first character, `_` when empty."""
    return F.coalesce(F.nullif(F.lower(F.left(word, F.lit(1))), F.lit("")), F.lit("_"))


_DAY = 86_400_000_000


def utc_iso(at: Column) -> Column:
    """ISO 8601 text of a timestamp in UTC, microseconds only where there are some.

    Reckoned from the microseconds since 1970, so that the session's time zone has no part in it.
    """
    micros = F.unix_micros(at)
    inside = F.pmod(micros, F.lit(_DAY))
    day = F.date_add(F.lit("1970-01-01").cast("date"), ((micros - inside) / _DAY).cast("int"))
    seconds, fraction = F.floor(inside / 1_000_000), F.pmod(inside, F.lit(1_000_000))
    clock = F.format_string(
        "T%02d:%02d:%02d", F.floor(seconds / 3600), F.floor(seconds / 60) % 60, seconds % 60)
    part = F.when(fraction == 0, "").otherwise(F.format_string(".%06d", fraction))
    return F.when(at.isNotNull(), F.concat(day.cast("string"), clock, part, F.lit("+00:00")))


def let(value: Column, body) -> Column:
    """Bind `value` to a lambda variable so that it is evaluated once.

    The optimizer inlines projected columns into the expressions that use
    them; inside a per-element lambda that would redo the work per element.
    """
    return F.get(F.transform(F.array(value), body), F.lit(0))


def run_ends(ordered: Column) -> Column:
    """1-based end position of every run of equal values in a sorted array."""
    positions = F.when(F.size(ordered) > 0, F.sequence(F.lit(1), F.size(ordered)))
    return F.filter(
        F.coalesce(positions, F.array().cast("array<int>")),
        lambda i: ~F.get(ordered, i).eqNullSafe(F.get(ordered, i - 1)),
    )


def term_counts(tokens: Column) -> Column:
    """array<struct<term, n>> of a token array: sort, then measure the runs.

    Counting inside the row needs no shuffle and no hash table over the whole
    partition, because one row holds all tokens of its page.
    """
    def measure(ordered):
        return let(
            run_ends(ordered),
            lambda ends: F.transform(
                ends,
                lambda end, k: F.struct(
                    F.get(ordered, end - 1).alias("term"),
                    (end - F.coalesce(F.get(ends, k - 1), F.lit(0))).alias("n"),
                ),
            ),
        )

    return let(F.sort_array(tokens), measure)


# Sorts directly behind the bare token and cannot occur inside one.
_TITLE_MARK = "\u0001"


def field_counts(text_tokens: Column, title_tokens: Column) -> Column:
    """array<struct<term, frequency, title_hits>> over both fields of a page.

    Title tokens carry a mark that makes them sort right behind the same text
    token, so one sort puts the (at most two) runs of a term side by side.
    """
    mark = F.lit(_TITLE_MARK)
    zero = F.lit(0)

    def measure(tokens, ends):
        def last_of(k):
            return F.get(tokens, F.get(ends, k) - 1)

        def length_of(k):
            return F.get(ends, k) - F.coalesce(F.get(ends, k - 1), zero)

        def entry(end, k):
            term = F.get(tokens, end - 1)
            following = F.get(tokens, end)
            bare = F.substring(term, F.lit(1), F.length(term) - 1)
            text_run = F.struct(
                term.alias("term"), length_of(k).alias("frequency"), zero.alias("title_hits")
            )
            title_run = F.struct(
                bare.alias("term"),
                F.when(last_of(k - 1) == bare, length_of(k - 1)).otherwise(zero)
                .alias("frequency"),
                length_of(k).alias("title_hits"),
            )
            # A text run directly before the title run of the same term is
            # reported by that title run.
            joined_next = F.endswith(following, mark) & (F.concat(term, mark) == following)
            return F.when(F.endswith(term, mark), title_run).when(
                ~F.coalesce(joined_next, F.lit(False)), text_run
            )

        return F.filter(F.transform(ends, entry), lambda e: e.isNotNull())

    marked = F.transform(title_tokens, lambda t: F.concat(t, mark))
    return let(
        F.sort_array(F.concat(text_tokens, marked)),
        lambda tokens: let(run_ends(tokens), lambda ends: measure(tokens, ends)),
    )

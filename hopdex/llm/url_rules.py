"""URL filters: host rules, and pattern rules that are indexed by their rarest token."""

import re

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# Host and path rules: (host/path, verdict). Fixed values of the query's contract.
HOST_RULES = [
    ("org/", "allow"),
    ("example.org/es/", "block"),
    ("example.org/en/1", "block"),
    ("com/fr/", "allow"),
    ("com/de/", "block"),
]

# Pattern rules: (pattern, verdict). `*` is any run, `^` a separator or an end, `||` the
# start of a host name. An allowing rule beats all blocking ones.
PATTERN_RULES = [
    ("||spam-farm.", "block"),
    ("cheap-pills.", "block"),
    ("^casino^", "block"),
    ("^viagra^", "block"),
    ("^adult^", "block"),
    ("^login^", "block"),
    ("?utm_source=feed^", "block"),
    ("^page=2&ref=", "block"),
    ("||blog.*.net/en/", "block"),
    ("||www.*/en/*.html^", "block"),
    ("^track*pixel^", "block"),
    ("||m.*^page=2^", "allow"),
    ("||www.*utm_source=feed^", "allow"),
]
# Rules that one broadcast may hold; more of them are joined by a shuffle.
BROADCAST_RULES = 20_000


def rule_regex(pattern: str) -> str:
    """The regular expression of a pattern, for lower-cased URLs."""
    out, rest = "", pattern.lower()
    if rest.startswith("||"):
        out, rest = r"://([^/?#]*\.)?", rest[2:]
    for char in rest:
        out += {"*": ".*", "^": r"([^a-z0-9_.%-]|$)"}.get(char, re.escape(char))
    return out.replace(r"\-", "-")


def rule_tokens(pattern: str) -> list[str]:
    """Tokens that every matching URL has as whole tokens.

    A run of letters and digits counts if the pattern itself says that it ends on
    both sides: not at `*`, nor at an open end of the pattern.
    """
    rest = pattern.lower()
    rest = "^" + rest[2:] if rest.startswith("||") else rest
    found = []
    for match in re.finditer(r"[a-z0-9]+", rest):
        before = rest[match.start() - 1] if match.start() else "*"
        after = rest[match.end()] if match.end() < len(rest) else "*"
        if before != "*" and after != "*":
            found.append(match.group())
    return sorted(set(found))


def _lower(column: Column) -> Column:
    return F.translate(column, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def url_parts(url: Column) -> tuple[Column, Column]:
    """(host, path) of a URL; both are empty without `://`."""
    whole = F.coalesce(url, F.lit(""))
    rest = F.when(whole.contains("://"), F.regexp_extract(whole, r"(?s)^.*?://(.*)$", 1)).otherwise("")
    host = F.regexp_extract(rest, r"^[^/?#]*", 0)
    path = F.regexp_extract(rest, r"^[^/?#]*([^?#]*)", 1)
    return _lower(host), path


def host_rule(host: Column, path: Column, rules=HOST_RULES) -> Column:
    """The longest rule that fits, as a struct of rule and verdict, or null."""
    found = F.lit(None)
    for rule, verdict in sorted(rules, key=lambda x: len(x[0])):
        name, start = rule.partition("/")[::2]
        fits = ((host == name) | host.endswith("." + name)) & path.startswith("/" + start)
        found = F.when(fits, F.struct(F.lit(rule).alias("rule"), F.lit(verdict).alias("verdict"))).otherwise(found)
    return found


def rule_index(spark: SparkSession, tokens: DataFrame, rules=PATTERN_RULES) -> DataFrame:
    """(token, regex, verdict): each rule under the one of its tokens that fewest URLs have.

    `tokens` holds one row per URL and distinct token. Rules without a token stand
    under the token that all URLs have, the empty one.
    """
    rows = [
        (number, rule_regex(pattern), verdict, token)
        for number, (pattern, verdict) in enumerate(rules)
        for token in rule_tokens(pattern) or [""]
    ]
    table = spark.createDataFrame(rows, "number int, regex string, verdict string, token string")
    table = F.broadcast(table) if len(rows) <= BROADCAST_RULES else table
    counts = tokens.join(table.select("token").distinct(), "token", "left_semi")
    counts = counts.groupBy("token").agg(F.count("*").alias("urls"))
    ranked = table.join(counts, "token", "left")
    rarest = ranked.groupBy("number", "regex", "verdict").agg(
        F.min(F.struct(F.coalesce("urls", F.lit(0)), "token"))["token"].alias("token"))
    return rarest.select("token", "regex", "verdict")


def pattern_verdicts(urls: DataFrame, rules=PATTERN_RULES) -> DataFrame:
    """(url, verdict) of the distinct URLs of `urls` that a pattern rule matches."""
    spark = urls.sparkSession
    urls = urls.filter("url is not null").distinct()
    low = _lower(F.col("url"))
    words = F.array_distinct(F.split(low, "[^a-z0-9]+"))
    # The empty token leads to the rules that have none.
    tokens = urls.select("url", F.explode(F.array_union(words, F.array(F.lit("")))).alias("token"))
    index = rule_index(spark, tokens, rules)
    index = F.broadcast(index) if len(rules) <= BROADCAST_RULES else index
    candidates = tokens.join(index, "token")
    hits = candidates.filter(F.call_function("rlike", _lower(F.col("url")), F.col("regex")))
    return hits.groupBy("url").agg(F.min("verdict").alias("verdict"))  # allow comes before block


def judge_urls(pages: DataFrame, host_rules=HOST_RULES, rules=PATTERN_RULES) -> DataFrame:
    """page_id, host, path, rule and verdict of every page.

    The longest host rule decides. Without one, a URL is blocked if a pattern rule
    matches it and no allowing pattern does. Only rules whose rarest token the URL
    holds are tried. A null URL, or one without `://`, has an empty host and path; a
    null one is allowed. Repeated rows and URLs get a result each; other columns are
    ignored; an empty table gives none.
    """
    pages = pages.select("page_id", "url")
    verdicts = pattern_verdicts(pages.select("url"), rules).withColumnRenamed("verdict", "_pattern")
    host, path = url_parts(F.col("url"))
    parted = pages.join(verdicts, "url", "left").select("page_id", "_pattern", host.alias("host"), path.alias("path"))
    fit = host_rule(F.col("host"), F.col("path"), host_rules)
    return parted.select("page_id", "host", "path", "_pattern", fit.alias("_fit")).select(
        "page_id", "host", "path", F.col("_fit.rule").alias("rule"),
        F.coalesce("_fit.verdict", "_pattern", F.lit("allow")).alias("verdict"),
    )


def _oracle() -> str:
    quoted = lambda text: "'" + text.replace("'", "''") + "'"
    cases = "\n".join(
        f"    WHEN (host = {quoted(h)} OR host LIKE {quoted('%.' + h)}) AND starts_with(path, {quoted('/' + p)})"
        f" THEN {quoted(rule + ' ' + verdict)}"
        for rule, verdict in sorted(HOST_RULES, key=lambda x: -len(x[0]))
        for h, _, p in [rule.partition("/")]
    )

    def any_of(verdict):
        tests = [f"regexp_matches(low, {quoted(rule_regex(p))})" for p, v in PATTERN_RULES if v == verdict]
        return " OR ".join(tests)

    return rf"""
WITH u AS (SELECT page_id, url, translate(url, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS low,
             CASE WHEN contains(url, '://') THEN substr(url, strpos(url, '://') + 3) ELSE '' END AS rest FROM pages),
p AS (SELECT page_id, low,
        translate(regexp_extract(rest, '^[^/?#]*', 0), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
        regexp_extract(rest, '^[^/?#]*([^?#]*)', 1) AS path FROM u),
r AS (SELECT *, CASE
{cases}
    END AS fit FROM p)
SELECT page_id, host, path, split_part(fit, ' ', 1) AS rule,
       coalesce(split_part(fit, ' ', 2),
                CASE WHEN {any_of("allow")} THEN 'allow' WHEN {any_of("block")} THEN 'block' ELSE 'allow' END) AS verdict
FROM r
"""


ORACLE = _oracle()

"""URL canonicalisation.

A URL that already has canonical shape only needs its fragment cut off, which
is a Column expression. Everything else goes to an Arrow-batched UDF over the
standard library's URL functions; rows that the expression answered reach the
UDF as NULL, so it only works on the rest.
"""

import re
from urllib.parse import urljoin, urlsplit

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

# Accepted schemes with the port that is left out of the result.
DEFAULT_PORTS = {"http": 80, "https": 443}

# Lower-case ASCII host without port, a path, printable characters only. No ';'
# (the standard library may drop it); '/.' is tested apart, as it may be a dot
# segment. The same text is valid for Java and for Python.
_PATH = r"[!\"$-:<->@-~¡-ɏ]"
_QUERY = r"[!\"$-:<-~¡-ɏ]"
_FRAGMENT = r"[!-:<-~¡-ɏ]"
_END = r"(?![\s\S])"
PLAIN = rf"^https?://[a-z0-9.-]+/{_PATH}*(?:\?{_QUERY}+)?(?:#{_FRAGMENT}*)?{_END}"
PLAIN_SITE = rf"^(https?://[a-z0-9.-]+)(?:[/?#]|{_END})"

_site = re.compile(PLAIN_SITE)
_plain = re.compile(PLAIN)


def page_links(hrefs: list[str | None], page_url: str) -> list[str]:
    """Canonical targets of a page's links: usable ones only, first of each kept."""
    site = _site.match(page_url)
    found = {}
    for href in hrefs:
        rooted = site and href and href[0] == "/" and href[1:2] != "/"
        target = site[1] + href if rooted else ""
        if _plain.match(target) and "/." not in target:
            found[target.partition("#")[0]] = None
        else:
            found[canonical_url(href, page_url)] = None
    found.pop(None, None)
    return list(found)


def canonical_url(raw: str | None, base: str | None = None) -> str | None:
    """One URL, absolute or relative to `base`; None when it is not a web URL."""
    target = (raw or "").strip()
    if not target:
        return None
    try:
        parts = urlsplit(urljoin(base, target) if base else target)
        port = parts.port
    except ValueError:  # malformed host or port: this link is dropped
        return None
    if parts.scheme not in DEFAULT_PORTS or not parts.netloc:
        return None
    authority = parts.hostname or ""
    if port and port != DEFAULT_PORTS[parts.scheme]:
        authority += f":{port}"
    query = parts.query and "?" + parts.query
    return f"{parts.scheme}://{authority}{parts.path or '/'}{query}"


@F.pandas_udf(StringType())
def _canonical_udf(raw: pd.Series, base: pd.Series) -> pd.Series:
    return pd.Series(
        [canonical_url(r, b) if isinstance(r, str) else None for r, b in zip(raw, base)],
        dtype=object,
    )


def normalize_url(raw: Column, base: Column | None = None) -> Column:
    """Canonical form of a column of raw URLs, NULL for anything unusable.

    With `base`, links relative to that page URL are resolved first.
    """
    if base is None:
        target, against = raw, F.lit(None).cast("string")
    else:
        site = F.regexp_extract(base, PLAIN_SITE, 1)
        rooted = F.startswith(raw, F.lit("/")) & ~F.startswith(raw, F.lit("//"))
        target, against = F.when(site != "", F.when(rooted, F.concat(site, raw)).otherwise(raw)), base
    plain = F.rlike(target, F.lit(PLAIN)) & ~F.contains(target, F.lit("/."))
    native = F.when(plain, F.substring_index(target, "#", 1))
    return F.coalesce(native, _canonical_udf(F.when(native.isNull(), raw), against))


def host_of(url: Column) -> Column:
    """Host of a canonical URL."""
    return F.regexp_extract(url, r"^https?://([^/:?#]*)", 1)

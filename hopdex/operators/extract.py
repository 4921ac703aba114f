"""From fetched responses to page rows."""

import gzip

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from hopdex.functions.markup import PARSED, parse_markup
from hopdex.schemas import PAGES

# Bytes that a capped reader takes of a body, and the note put behind a cut one.
MAX_BODY_BYTES = 1_000_000
CUT_NOTE = "\n[truncated after {} bytes]"

_DECODED = T.StructType(
    [T.StructField("text", T.StringType()), T.StructField("failure", T.StringType())]
)


def header(headers: Column, name: str) -> Column:
    """Value of a header, whatever the case of its name; NULL when absent."""
    match = F.filter(F.map_entries(headers), lambda e: F.lower(e["key"]) == name)
    return F.get(match, F.lit(0))["value"]


def media_type(content_type: Column) -> Column:
    """`type/subtype` in lower case; anything malformed counts as text/plain."""
    main = F.lower(F.trim(F.substring_index(content_type, ";", 1)))
    return F.when(F.rlike(main, F.lit(r"^[^/]*/[^/]*$")), main).otherwise("text/plain")


def charset(content_type: Column) -> Column:
    named = F.regexp_extract(F.lower(content_type), r";\s*charset\s*=\s*\"?([^\";\s]*)", 1)
    return F.coalesce(F.nullif(named, F.lit("")), F.lit("utf-8"))


def decode_body(body: bytes, encoding: str, zipped: bool) -> tuple:
    try:
        if zipped:
            try:
                body = gzip.decompress(body)
            except OSError:  # not gzip after all: the bytes are kept
                pass
        return body.decode(encoding, errors="replace"), None
    except Exception as error:  # cut-off gzip data, unknown charset
        return None, f"unexpected error: {error}"


@F.pandas_udf(_DECODED)
def _decode_udf(body: pd.Series, encoding: pd.Series, zipped: pd.Series) -> pd.DataFrame:
    rows = [
        decode_body(b, e, z) if b is not None else (None, None)
        for b, e, z in zip(body, encoding, zipped)
    ]
    return pd.DataFrame(rows, columns=_DECODED.names, index=body.index)


def error_text(status: Column, error: Column) -> Column:
    """Error column of a page: transport failures, then HTTP status, else NULL."""
    ready = F.startswith(error, F.lit("URL error: ")) | F.startswith(
        error, F.lit("unexpected error: ")
    )
    return (
        F.when(ready, error)
        .when(error.isNotNull(), F.concat(F.lit("URL error: "), error))
        .when(~status.between(200, 299), F.concat(F.lit("HTTP "), status.cast("string")))
    )


def url_path(url: Column) -> Column:
    """Path of a canonical URL."""
    return F.regexp_extract(url, r"^https?://[^/?#]*([^?#]*)", 1)


def parse_responses(responses: DataFrame, fetched_at: Column | None = None,
                    max_body_bytes: int | None = None) -> DataFrame:
    """One page row per response, no shuffle.

    Bodies are taken whole. With `max_body_bytes` a longer one is cut there, before
    it is unpacked, and its text says so.

    Plain UTF-8 bodies are decoded in the JVM; compressed, oddly encoded or
    invalid ones reach the decoding UDF, the others pass it as NULL. Failed responses
    and plain bodies that are not HTML go past Python on a branch of their own: a row
    that waits for a UDF is held with all its columns, which for rows that the UDF gets
    as NULL would be any number of bodies. `responses` is read once for each branch.
    """
    body, cut = F.coalesce("body", F.lit(b"")), F.lit(False)
    if max_body_bytes is not None:
        body, cut = F.substring(body, 1, max_body_bytes), F.length("body") > max_body_bytes
    r = responses.withColumn("_failed", error_text(F.col("status"), F.col("error")))
    content_type = header(F.col("headers"), "content-type")
    r = r.select(
        "url",
        "status",
        "_failed",
        media_type(content_type).alias("_media"),
        charset(content_type).alias("_charset"),
        F.contains(F.lower(F.coalesce(header(F.col("headers"), "content-encoding"), F.lit(""))),
                   F.lit("gzip")).alias("_zipped"),
        F.when(F.col("_failed").isNull(), body).alias("_body"),
        cut.alias("_cut"),
        (fetched_at if fetched_at is not None else F.current_timestamp()).alias("fetched_at"),
    )
    plain = (
        ~F.col("_zipped")
        & F.col("_charset").isin("utf-8", "utf8")
        & F.is_valid_utf8(F.col("_body").cast("string"))
    )
    is_html = F.contains("_media", F.lit("html"))
    native = F.col("_failed").isNotNull() | (~is_html & F.coalesce(plain, F.lit(False)))
    past = r.filter(native).withColumns({
        "_rest": F.lit(None).cast(_DECODED), "_text": F.col("_body").cast("string"),
        "_html": F.lit(None).cast(PARSED)})
    r = r.filter(~native)
    rest = _decode_udf(F.when(~plain, F.col("_body")), F.col("_charset"), F.col("_zipped"))
    r = r.withColumn("_rest", rest).withColumn(
        "_text", F.when(plain, F.col("_body").cast("string")).otherwise(F.col("_rest.text"))
    )
    r = r.withColumn("_html", parse_markup(F.when(is_html, F.col("_text")), F.col("url")))
    note = CUT_NOTE.format(max_body_bytes)
    return _page_columns(past, is_html, note).unionByName(_page_columns(r, is_html, note))


def _page_columns(r: DataFrame, is_html: Column, note: str) -> DataFrame:
    failure = F.coalesce("_failed", "_rest.failure", "_html.failure")
    ok = failure.isNull()
    path = F.coalesce(F.nullif(url_path(F.col("url")), F.lit("")), F.col("url"))
    text = F.when(is_html, F.col("_html.text")).otherwise(F.col("_text"))
    noted = F.when(F.col("_cut"), F.concat(text, F.lit(note))).otherwise(text)
    no_links = F.array().cast("array<string>")
    http_status = F.when(F.startswith("_failed", F.lit("HTTP ")), F.col("status")).otherwise(0)
    return r.select(
        "url",
        F.when(ok, F.when(is_html, F.col("_html.title")).otherwise(path)).otherwise("")
        .alias("title"),
        F.when(ok, noted).otherwise("").alias("text"),
        F.when(ok & is_html, F.col("_html.links")).otherwise(no_links).alias("links"),
        "fetched_at",
        F.when(ok, F.col("status")).otherwise(http_status).cast("int").alias("status_code"),
        failure.alias("error"),
    ).select(*PAGES.names)


def parse_html_pages(raw: DataFrame, fetched_at: Column | None = None, keep: list[str] = ()) -> DataFrame:
    """Page rows from (url, html) rows that are known to be answered HTML; `keep` names more columns."""
    parsed = raw.withColumn("_html", parse_markup(F.col("html"), F.col("url")))
    ok = F.col("_html.failure").isNull()
    return parsed.select(
        "url",
        "_html.title",
        "_html.text",
        "_html.links",
        (fetched_at if fetched_at is not None else F.current_timestamp()).alias("fetched_at"),
        F.when(ok, 200).otherwise(0).alias("status_code"),
        F.col("_html.failure").alias("error"),
        *keep,
    )


def is_success(error: Column | None = None, status: Column | None = None) -> Column:
    """A page counts as fetched well without error and with a 2xx or 3xx status."""
    error = F.col("error") if error is None else error
    status = F.col("status_code") if status is None else status
    return error.isNull() & (status >= 200) & (status < 400)


def fetch_state(error: Column) -> Column:
    return F.when(F.coalesce(error, F.lit("")) != "", "failed").otherwise("fetched")


def edges(pages: DataFrame) -> DataFrame:
    """Link graph (src, position, dst) of the successful pages."""
    good = pages.filter(is_success())
    return good.select(F.col("url").alias("src"), F.posexplode("links").alias("position", "dst"))

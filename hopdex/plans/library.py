"""The queries, by name. Each takes (spark, folder) and returns a DataFrame."""

import gzip
from concurrent.futures import ThreadPoolExecutor

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import BinaryType

from hopdex.functions.text import collapse_ws, letter_of, term_counts, tokenize, utc_iso
from hopdex.functions.urls import host_of, normalize_url
from hopdex.operators import crawl as walk
from hopdex.operators import blocks, index, refetch, search, status
from hopdex.operators.extract import MAX_BODY_BYTES, edges, parse_html_pages, parse_responses
from hopdex.operators.joins import newest
from hopdex.operators.upsert import mark_interrupted, upsert
from hopdex.plans import corpus
from hopdex.session import shared_folder, stage
from hopdex.sources import tables, word_lines
from hopdex.sources.store import IndexStore
from hopdex.streaming import ingest

QUERIES = {}


def query(function):
    QUERIES[function.__name__] = function
    return function


# -- pages -------------------------------------------------------------------

@query
def pages_scan(spark: SparkSession, folder: str) -> DataFrame:
    return corpus.fetched_pages(spark, folder).select(
        "url", "title", "text", F.array_join("links", " ").alias("links"),
        F.size("links").cast("bigint").alias("n_links"), "status_code",
    )


@query
def page_titles(spark, folder):
    return corpus.fetched_pages(spark, folder).select("url", "title")


@query
def page_text(spark, folder):
    return corpus.fetched_pages(spark, folder).select("url", "text")


@query
def page_links(spark, folder):
    links = edges(corpus.fetched_pages(spark, folder))
    return links.select("src", F.col("position").cast("bigint").alias("position"), "dst")


@query
def links_distinct(spark, folder):
    """Pages that hold every link twice, through the parser: distinct links, order kept."""
    raw = corpus.raw_pages(spark, folder).withColumn("html", F.concat("html", "html"))
    hrefs = F.regexp_extract_all("html", F.lit('<a href="([^"]*)"'), F.lit(1))
    counts = raw.withColumn("n_raw", F.size(hrefs).cast("bigint"))
    parsed = parse_html_pages(counts, F.lit(0).cast("timestamp"), keep=["n_raw"])
    return parsed.select("url", "n_raw", F.array_join("links", " ").alias("links"))


@query
def links_json(spark, folder):
    stored = tables.pages_with_json_links(corpus.fetched_pages(spark, folder))
    loaded = tables.pages_from_json_links(stored, keep_json=True)
    return loaded.select("url", "links_json", F.size("links").cast("bigint").alias("n_links"))


@query
def content_dispatch(spark, folder):
    """Pages as responses of two media types, through the response parser."""
    media = F.when(F.contains("url", F.lit("?")), "text/plain").otherwise(
        "Text/HTML; charset=UTF-8"
    )
    responses = corpus.raw_pages(spark, folder).select(
        "url", F.lit(200).alias("status"), F.create_map(F.lit("CONTENT-TYPE"), media).alias("headers"),
        F.encode("html", "utf-8").alias("body"), F.lit(None).cast("string").alias("error"),
    )
    return parse_responses(responses).select(
        "url", "title", F.md5(F.encode("text", "utf-8")).alias("text_md5"),
        F.size("links").cast("bigint").alias("n_links"),
    )


@query
def truncate_body(spark, folder):
    """Documents repeated into bodies, every tenth far above the size limit, as plain text."""
    times = F.when(F.col("doc_id") % 10 == 0, 500).otherwise(2)
    text = F.repeat(F.regexp_replace("text", "[^ -~]", "?"), times)
    responses = tables.spread_if_few(corpus.table(spark, folder, "documents")).select(
        F.concat(F.lit("http://site.test/doc/"), F.col("doc_id").cast("string")).alias("url"),
        F.lit(200).alias("status"),
        F.create_map(F.lit("Content-Type"), F.lit("text/plain")).alias("headers"),
        F.encode(text, "utf-8").alias("body"), F.lit(None).cast("string").alias("error"),
    )
    return parse_responses(responses, max_body_bytes=MAX_BODY_BYTES).select(
        "url", F.length("text").cast("bigint").alias("n_chars"),
        F.md5(F.encode("text", "utf-8")).alias("text_md5"), "title",
    )


@query
def error_classes(spark, folder):
    """Orders as responses: answered, moved, refused or broken by status, failed in transport or within."""
    kind = F.col("o_orderkey") % 6
    body = F.encode("o_orderpriority", "utf-8")
    responses = corpus.table(spark, folder, "orders").select(
        corpus.node_url("order", "o_orderkey").alias("url"),
        F.element_at(F.array(*map(F.lit, [200, 404, 503, 302, 0, 0])), (kind + 1).cast("int")).alias("status"),
        F.create_map(F.lit("Content-Type"), F.lit("text/plain")).alias("headers"),
        F.when(kind == 0, body).alias("body"),
        F.when(kind == 4, "timed out").when(kind == 5, "unexpected error: no memory").alias("error"),
    )
    return parse_responses(responses).select("url", "status_code", "error", "text")


@F.pandas_udf(BinaryType())
def _gzipped(bodies: pd.Series) -> pd.Series:
    return bodies.map(lambda b: None if b is None else gzip.compress(b))


@query
def decode_bodies(spark, folder):
    """Documents in three encodings, one of them packed, as they come out of the reader."""
    kind = F.col("doc_id") % 3
    text = F.regexp_replace("text", "[^\\x00-\\xff]", "?")
    body = (
        F.when(kind == 0, F.encode(text, "ISO-8859-1")).when(kind == 1, F.encode(text, "UTF-16LE"))
        .otherwise(F.encode(text, "UTF-8"))
    )
    packed = _gzipped(F.when(kind == 2, body))
    charset = F.when(kind == 0, "ISO-8859-1").when(kind == 1, "utf-16le").otherwise("UTF-8")
    responses = corpus.table(spark, folder, "documents").select(
        F.concat(F.lit("http://site.test/doc/"), F.col("doc_id").cast("string")).alias("url"),
        F.lit(200).alias("status"),
        F.create_map(F.lit("Content-Type"), F.concat(F.lit("text/plain; charset="), charset),
                     F.lit("Content-Encoding"), F.when(kind == 2, "gzip").otherwise("identity")).alias("headers"),
        F.coalesce(packed, body).alias("body"), F.lit(None).cast("string").alias("error"),
    )
    return parse_responses(responses).select("url", F.md5(F.encode("text", "utf-8")).alias("text_md5"), "error")


# -- text and URLs -----------------------------------------------------------

@query
def tokenize_docs(spark, folder):
    docs = tables.spread_if_few(corpus.table(spark, folder, "documents"))
    return docs.select("doc_id", F.array_join(tokenize(F.col("text")), " ").alias("tokens"))


@query
def term_frequency(spark, folder):
    docs = tables.spread_if_few(corpus.table(spark, folder, "documents"))
    counted = docs.select("doc_id", F.inline(term_counts(tokenize(F.col("text")))))
    return counted.select("doc_id", "term", F.col("n").cast("bigint").alias("n"))


@query
def letter_histogram(spark, folder):
    """Words and their occurrences per letter bucket."""
    docs = tables.spread_if_few(corpus.table(spark, folder, "documents"))
    counted = docs.select(F.inline(term_counts(tokenize(F.col("text")))))
    words = counted.groupBy("term").agg(F.sum("n").alias("n"))
    return words.groupBy(letter_of(F.col("term")).alias("letter")).agg(
        F.count("*").alias("n_words"), F.sum("n").alias("n_tokens")
    )


@query
def collapse_whitespace(spark, folder):
    docs = corpus.table(spark, folder, "documents")
    return docs.select("doc_id", collapse_ws(F.col("text")).alias("text"))


@query
def normalize_urls(spark, folder):
    """Every page URL in eight spellings."""
    parts = corpus.table(spark, folder, "pages").select(
        "page_id", "url",
        F.regexp_extract("url", "^(https?)://([^/]*)(.*)$", 1).alias("s"),
        F.regexp_extract("url", "^(https?)://([^/]*)(.*)$", 2).alias("h"),
        F.regexp_extract("url", "^(https?)://([^/]*)(.*)$", 3).alias("r"),
    )
    spellings = {
        "plain": "url",
        "upper": "concat(upper(s), '://', upper(h), r)",
        "port_80": "concat(s, '://', h, ':80', r)",
        "port_8443": "concat(s, '://', h, ':8443', r)",
        "user": "concat(s, '://me:pw@', h, r)",
        "mail": "concat('mailto:me@', h)",
        "ftp": "concat('ftp://', h, r)",
        "padded": "concat('  ', url, '\\n')",
    }
    raws = F.explode(
        F.array(*[F.struct(F.lit(k).alias("kind"), F.expr(v).alias("raw")) for k, v in spellings.items()])
    )
    rows = parts.select("page_id", raws.alias("x")).select("page_id", "x.kind", "x.raw")
    return rows.select("page_id", "kind", normalize_url(F.col("raw")).alias("url"))


@query
def resolve_links(spark, folder):
    """Every link of every page, also in four relative spellings."""
    raw = corpus.raw_pages(spark, folder)
    hrefs = F.regexp_extract_all("html", F.lit('<a href="([^"]*)"'), F.lit(1))
    links = raw.select("page_id", "url", F.posexplode(hrefs).alias("position", "href"))
    spellings = {
        "rooted": "href",
        "other_host": "concat('//CDN.test', href)",
        "dots": "concat('/a/./b/../..', href)",
        "query": "concat('?p=', position)",
        "fragment": "concat('#p', position)",
    }
    kinds = F.explode(
        F.array(*[F.struct(F.lit(k).alias("kind"), F.expr(v).alias("raw")) for k, v in spellings.items()])
    )
    rows = links.select("page_id", "url", "position", kinds.alias("x"))
    return rows.select(
        "page_id", F.col("position").cast("bigint").alias("position"), "x.kind",
        normalize_url(F.col("x.raw"), F.col("url")).alias("link"),
    )


# -- crawl -------------------------------------------------------------------

@query
def seed_validation(spark, folder):
    """Customers as seeds, broken in every way that a rule knows."""
    key = F.col("c_custkey")
    origin = F.when(key % 9 == 0, F.lit("mailto:x@y")).otherwise(
        F.concat(F.lit("HTTP://Site.Test:80/c/"), key.cast("string"))
    )
    seeds = corpus.table(spark, folder, "customer").select(
        key.cast("string").alias("job_id"), origin.alias("origin"),
        (key % 5 - 1).alias("max_depth"), (key % 7).alias("queue_capacity"),
        F.col("c_acctbal").alias("rate_limit"),
        F.when(key % 11 == 0, "many").otherwise((key % 4).cast("string")).alias("worker_count"),
    )
    return walk.check_seeds(seeds).select(
        "job_id", "origin_url", F.col("max_depth").cast("bigint").alias("max_depth"), "reject_reason")


@query
def seed_duplicates(spark, folder):
    """Equal requests without ids, one per customer of a nation: each is a job of its own."""
    seeds = corpus.table(spark, folder, "customer").select(
        corpus.node_url("nation", "c_nationkey").alias("origin"), (F.col("c_nationkey") % 3).alias("max_depth"))
    jobs = walk.accepted(walk.check_seeds(seeds))
    return jobs.groupBy("origin_url").agg(
        F.count_distinct("job_id").alias("n_jobs"), F.max("max_depth").cast("bigint").alias("max_depth"))


@query
def bfs_depths(spark, folder):
    """From every region down the tree, three hops."""
    origin = corpus.node_url("region", "r_regionkey")
    seeds = corpus.table(spark, folder, "region").select(
        F.concat(F.lit("r"), F.col("r_regionkey").cast("string")).alias("job_id"),
        origin.alias("origin_url"), F.lit(3).alias("max_depth"),
    )
    return walk.crawl_edges(seeds, corpus.tree_edges(spark, folder))


@query
def bfs_multi_seed(spark, folder):
    """From every customer through the cyclic customer-order graph, own depth each."""
    depth = F.when(F.col("c_acctbal") < 0, 1).otherwise(3)
    seeds = corpus.table(spark, folder, "customer").select(
        F.concat(F.lit("c"), F.col("c_custkey").cast("string")).alias("job_id"),
        corpus.node_url("customer", "c_custkey").alias("origin_url"), depth.alias("max_depth"),
    )
    return walk.crawl_edges(seeds, stage(corpus.order_edges(spark, folder), "edges"))


def _page_crawl(spark, folder):
    """Every page as the origin of a one-hop job; (discoveries, outcomes)."""
    outcomes = stage(corpus.page_outcomes(spark, folder), "outcomes")
    pages = corpus.fetched_pages(spark, folder).drop("error", "status_code").join(outcomes, "url")
    seeds = corpus.raw_pages(spark, folder, ("page_id", "url")).select(
        F.col("page_id").cast("string").alias("job_id"), F.col("url").alias("origin_url"),
        F.lit(1).alias("max_depth"),
    )
    return walk.crawl(seeds, pages), outcomes


@query
def dead_links(spark, folder):
    found, outcomes = _page_crawl(spark, folder)
    return walk.dead_links(found, outcomes).select("job_id", "url", "depth")


@query
def fetch_list(spark, folder):
    found, outcomes = _page_crawl(spark, folder)
    return walk.fetch_list(found, outcomes)


@query
def frontier_actions(spark, folder):
    found, outcomes = _page_crawl(spark, folder)
    return walk.frontier_actions(found.select("job_id", "url", "depth"), outcomes)


@query
def shared_page_delivery(spark, folder):
    """Finished pages handed to every job that waits for them."""
    found, outcomes = _page_crawl(spark, folder)
    finished = walk.fetch_states(outcomes)
    return walk.deliver(found.select("job_id", "url", "depth"), finished)


@query
def fetch_state(spark, folder):
    return walk.fetch_states(corpus.page_outcomes(spark, folder))


# -- index -------------------------------------------------------------------

@query
def build_postings(spark, folder):
    return _bigints(index.build_postings(corpus.fetched_pages(spark, folder)))


@query
def document_postings(spark, folder):
    return _bigints(index.build_postings(corpus.document_pages(spark, folder)))


def _entries(spark, folder):
    found = stage(corpus.host_discoveries(spark, folder), "discoveries")
    return index.build_word_entries(corpus.fetched_pages(spark, folder), found)


def _bigints(df):
    ints = [f.name for f in df.schema.fields if f.dataType.simpleString() == "int"]
    return df.withColumns({c: F.col(c).cast("bigint") for c in ints})


@query
def build_word_entries(spark, folder):
    return _bigints(_entries(spark, folder))


@query
def word_entry_delta(spark, folder):
    """Entries of all jobs that a store holding every http origin still lacks."""
    entries = stage(_entries(spark, folder), "entries")
    held = entries.filter(F.startswith("origin_url", F.lit("http://")))
    stale = F.when(F.startswith("word", F.lit("a")), F.col("frequency") + 1)
    held = held.withColumn("frequency", F.coalesce(stale, F.col("frequency")))
    return _bigints(index.changed_entries(entries, held))


@query
def word_entry_upsert(spark, folder):
    """The same store after the changed entries went in as a second batch."""
    store = IndexStore(spark, shared_folder(spark, "store"))
    entries = stage(_entries(spark, folder), "entries")
    held = entries.filter(F.startswith("origin_url", F.lit("http://")))
    stale = F.when(F.startswith("word", F.lit("a")), F.col("frequency") + 1)
    held = held.withColumn("frequency", F.coalesce(stale, F.col("frequency")))
    store.insert("word_entries", held, scanned=True)
    store.upsert("word_entries", index.changed_entries(entries, store.read("word_entries")))
    return _bigints(store.read("word_entries"))


@query
def word_entries_rebuild(spark, folder):
    """A store rebuilt from pages and discoveries replaces what it held before."""
    store = IndexStore(spark, shared_folder(spark, "store"))
    entries = stage(_entries(spark, folder), "entries")
    store.insert("word_entries", entries.withColumn("frequency", F.lit(-1)), scanned=True)
    store.replace("word_entries", entries, scanned=True)
    return _bigints(store.read("word_entries"))


@query
def word_entries_dedup(spark, folder):
    """Conflicting copies of each entry; the one at the highest position wins."""
    entries = stage(_entries(spark, folder), "entries")
    older = entries.withColumn("frequency", F.lit(0)).withColumn("_position", F.lit(1))
    newer = entries.withColumn("_position", F.lit(2))
    return _bigints(index.dedup_entries(newer.unionByName(older)))


@query
def word_lines_export(spark, folder):
    return word_lines.to_lines(_entries(spark, folder))


@query
def word_lines_roundtrip(spark, folder):
    """Written as text files, with unusable lines added, and read again."""
    path = shared_folder(spark, "lines")
    entries = _entries(spark, folder)
    word_lines.write_lines(entries, path)
    noise = corpus.table(spark, folder, "documents").select(
        F.concat(F.lit("# "), F.translate("text", "\n", " ")).alias("value")
    )
    noise.write.mode("append").text(path + "/letter=_")
    return _bigints(word_lines.read_lines(spark, path))


# -- search ------------------------------------------------------------------

def _search_inputs(spark, folder):
    pages = corpus.fetched_pages(spark, folder)
    found = stage(corpus.host_discoveries(spark, folder), "discoveries")
    return corpus.benchmark_queries(spark, folder), pages, found


def _default_results(spark, folder):
    queries, pages, found = _search_inputs(spark, folder)
    asked = queries.filter("sort_by = 'default'")
    return search.search_default(asked, index.build_postings(pages), pages, found)


def _search_all(spark, folder):
    queries, pages, found = _search_inputs(spark, folder)
    entries = index.build_word_entries(pages, found)
    return search.search(queries, index.build_postings(pages), entries, pages, found)


@query
def search_default(spark, folder):
    return _bigints(_default_results(spark, folder))


@query
def search_relevance(spark, folder):
    queries, pages, found = _search_inputs(spark, folder)
    asked = queries.filter("sort_by = 'relevance'")
    return _bigints(
        search.search_relevance(asked, index.build_word_entries(pages, found), pages)
    )


@query
def search_ranked(spark, folder):
    results = search.ranked(_default_results(spark, folder))
    return _bigints(results.drop("title", "frequency"))


@query
def search_mixed(spark, folder):
    return _bigints(_search_all(spark, folder))


@query
def search_plain_json(spark, folder):
    return search.plain_result_json(_default_results(spark, folder))


@query
def search_json(spark, folder):
    return search.result_json(_search_all(spark, folder))


@query
def search_stored_index(spark, folder):
    """Default search over postings read back from the store."""
    queries, pages, found = _search_inputs(spark, folder)
    store = IndexStore(spark, shared_folder(spark, "store"))
    store.replace("postings", index.build_postings(pages))
    asked = queries.filter("sort_by = 'default'")
    return _bigints(search.search_default(asked, store.read("postings"), pages, found))


@query
def search_posting_blocks(spark, folder):
    """Default search over blocks of postings; only blocks are shuffled, pages go by number."""
    queries, pages, found = _search_inputs(spark, folder)
    asked = queries.filter("sort_by = 'default'")
    return _bigints(blocks.search_blocks(asked, blocks.index_blocks(pages, found)))


@query
def posting_block_layout(spark, folder):
    """Blocks of the documents' words, a word's blocks put side by side again."""
    pages = corpus.document_pages(spark, folder)
    index_ = blocks.index_blocks(pages, pages.select(
        F.lit("j").alias("job_id"), "url", F.col("url").alias("origin_url"), F.lit(0).alias("depth")))
    entries = F.col("entries")
    return index_.blocks.groupBy("term").agg(
        F.sum(F.size(entries)).alias("n_pages"),
        F.sum(F.aggregate(entries, F.lit(0).cast("bigint"), lambda a, e: a + e["frequency"])).alias("frequency"),
        F.sum(F.aggregate(entries, F.lit(0).cast("bigint"), lambda a, e: a + e["title_hits"])).alias("title_hits"),
    )


# -- pages fetched anew ------------------------------------------------------

def _fetched_anew(spark, folder):
    """All pages, and about a third of them with another text and title."""
    pages = corpus.fetched_pages(spark, folder)
    anew = pages.filter(F.length("url") % 3 == 0).withColumns({
        "text": F.concat(F.coalesce("title", F.lit("")), F.lit(" fetched anew "), F.substring("text", 1, 200)),
        "title": F.concat(F.lit("Anew "), F.coalesce("title", F.lit(""))),
    })
    return pages, anew


@query
def refetch_postings(spark, folder):
    """Postings after pages came again, by signed changes; equal to a rebuild."""
    pages, anew = _fetched_anew(spark, folder)
    changes = stage(refetch.posting_changes(pages, anew), "changes")
    return _bigints(refetch.change_postings(stage(index.build_postings(pages), "postings"), changes))


@query
def refetch_word_entries(spark, folder):
    """The same for the word entries of all jobs."""
    pages, anew = _fetched_anew(spark, folder)
    found = stage(corpus.host_discoveries(spark, folder), "discoveries")
    changes = stage(refetch.posting_changes(pages, anew), "changes")
    entries = stage(index.build_word_entries(pages, found), "entries")
    return _bigints(refetch.change_entries(entries, refetch.entry_changes(changes, found)))


# -- keyed writes ------------------------------------------------------------

@query
def page_upsert(spark, folder):
    """Fetches of host pages: https fetches written over http ones, last one wins."""
    fetches = corpus.raw_pages(spark, folder).select(
        F.concat(F.lit("http://"), host_of(F.col("url")), F.lit("/")).alias("url"),
        F.col("url").alias("title"), "html", "page_id",
    )
    secure = F.startswith("title", F.lit("https://"))
    first = newest(fetches.filter(~secure), ["url"], ["page_id"])
    merged = upsert(first, fetches.filter(secure), ["url"], ["page_id"])
    return merged.select("url", "title", "page_id", F.length("html").cast("bigint").alias("n_chars"))


@query
def job_upsert(spark, folder):
    """Job states from two halves of the event log; the later half is written over."""
    events = corpus.event_logs(spark, folder).select("job_id", "message", "id")
    later = F.col("message").isin("error", "purchase")
    first = newest(events.filter(~later), ["job_id"], ["id"])
    return upsert(first, events.filter(later), ["job_id"], ["id"])


@query
def discovery_upsert(spark, folder):
    """Discoveries keyed by (job, URL): a job's later line replaces the earlier."""
    found = corpus.table(spark, folder, "lineitem").select(
        F.col("l_suppkey").cast("string").alias("job_id"),
        corpus.node_url("part", "l_partkey").alias("url"),
        (F.col("l_orderkey") * 10 + F.col("l_linenumber")).alias("written"),
        F.col("l_linenumber").alias("depth"),
    )
    early = F.col("depth") <= 3
    first = newest(found.filter(early), ["job_id", "url"], ["written"])
    return upsert(first, found.filter(~early), ["job_id", "url"], ["written"])


@query
def mark_interrupted_jobs(spark, folder):
    return mark_interrupted(corpus.order_jobs(spark, folder)).select("job_id", "status")


# -- status ------------------------------------------------------------------

@query
def jobs_newest(spark, folder):
    jobs = corpus.order_jobs(spark, folder).select("job_id", "origin_url", "created_at")
    return status.with_newest_position(jobs)


@query
def discoveries_with_origin(spark, folder):
    """Only running and completed orders are jobs; lines of others are orphans."""
    known = corpus.order_jobs(spark, folder).filter("status <> 'created'")
    return tables.with_origin(corpus.line_discoveries(spark, folder), known).select(
        "job_id", "url", "depth", "origin_url")


def _live_jobs(spark, folder):
    """Open and recently priced jobs as live ones, with their live-only columns."""
    jobs = corpus.order_jobs(spark, folder).drop("priority")
    urgent = F.col("rate_limit") > 200000
    return jobs.filter("status <> 'completed'").withColumns(
        {
            "queue_depth": F.floor(F.col("rate_limit") / 1000).cast("int"),
            "active_workers": F.lit(4),
            "pending_shared_pages": F.lit(0),
            "queue_backpressure_active": urgent,
            "rate_backpressure_active": ~urgent & (F.col("rate_limit") > 150000),
        }
    )


@query
def status_rollup(spark, folder):
    return status.global_status(_live_jobs(spark, folder), corpus.page_outcomes(spark, folder))


@query
def job_counters(spark, folder):
    """Suppliers as jobs, their parts as URLs; parts of some size have pages."""
    found = corpus.table(spark, folder, "lineitem").select(
        F.col("l_suppkey").alias("job_id"), corpus.node_url("part", "l_partkey").alias("url")
    ).distinct()
    pages = corpus.table(spark, folder, "part").filter("p_size > 10").select(
        corpus.node_url("part", "p_partkey").alias("url")
    )
    return status.page_counters(stage(found, "found"), pages)


@query
def event_counters(spark, folder):
    kinds = {"queue_backpressure_count": "error", "rate_backpressure_count": "click"}
    return status.event_counters(corpus.event_logs(spark, folder), kinds)


@query
def jobs_live_union_history(spark, folder):
    history = corpus.order_jobs(spark, folder).drop("priority").withColumn("status", F.lit("stored"))
    both = status.live_and_history(_live_jobs(spark, folder), history)
    return _bigints(both.drop("created_at", "rate_limit"))


@query
def backpressure_recent(spark, folder):
    return status.backpressure_recent(corpus.event_logs(spark, folder), "error")


@query
def recent_logs(spark, folder):
    """Event types as jobs, each with far more lines than a view shows."""
    logs = corpus.event_logs(spark, folder).withColumn("job_id", F.col("message"))
    return _bigints(status.recent_logs(logs))


@query
def recent_logs_long(spark, folder):
    """The same with a view that is too long for a rank limit."""
    logs = corpus.event_logs(spark, folder).withColumn("job_id", F.col("message"))
    return _bigints(status.recent_logs(logs, rows=1500))


@query
def log_append(spark, folder):
    """Job logs appended to the store in three writes, read back for the jobs that have errors."""
    store = IndexStore(spark, shared_folder(spark, "store"))
    logs = corpus.event_logs(spark, folder)
    for part in range(3):
        store.insert("logs", logs.filter(F.col("id") % 3 == part))
    return store.read("logs").groupBy("job_id").agg(
        F.count("*").alias("n_lines"), F.max("id").alias("last_id"),
        F.count_if(F.col("message") == "error").alias("n_errors"))


@query
def log_times(spark, folder):
    """Times of the log lines as UTC text, also a millisecond and a microsecond part of them."""
    logs = corpus.event_logs(spark, folder)
    odd = F.when(F.col("id") % 3 == 0, F.col("id") % 1000 * 1000).when(F.col("id") % 3 == 1, 7).otherwise(0)
    at = F.timestamp_micros(F.unix_micros(F.date_trunc("second", "logged_at")) + odd)
    return logs.select("id", utc_iso(at).alias("logged_at"))


@query
def job_lookup(spark, folder):
    """One live order and its place among live and stored jobs."""
    history = corpus.order_jobs(spark, folder).drop("priority").withColumn("status", F.lit("stored"))
    both = status.live_and_history(_live_jobs(spark, folder), history)
    return status.job_lookup(both, "1").select("job_id", "origin_url", "status").unionByName(
        status.job_lookup(both, "no such job").select("job_id", "origin_url", "status"))


@query
def job_status_latest(spark, folder):
    """Job status from the event log, final states stick."""
    message = F.col("message")
    state = (
        F.when(message == "signup", "created").when(message == "purchase", "completed")
        .when(message == "error", "interrupted").otherwise("running")
    )
    events = corpus.event_logs(spark, folder).select(
        "job_id", state.alias("status"), F.col("logged_at").alias("at"), "id"
    )
    return status.latest_status(events)


# -- streams -----------------------------------------------------------------

def _responses(raw):
    """Pages as responses; cut-off ones were answered with an error."""
    whole = F.endswith("html", F.lit("</html>"))
    html = F.create_map(F.lit("Content-Type"), F.lit("text/html; charset=utf-8"))
    return raw.select(
        "url", F.when(whole, 200).otherwise(503).alias("status"), html.alias("headers"),
        F.encode("html", "utf-8").alias("body"), F.lit(None).cast("string").alias("error"),
    )


class _Arrivals:
    """Three deliveries of pages; each offers the one before again, spelled otherwise."""

    def __init__(self, spark, folder):
        self.spark, self.inbox = spark, shared_folder(spark, "inbox")
        self.store = IndexStore(spark, shared_folder(spark, "store"))
        self.offsets = shared_folder(spark, "offsets")
        self.raw = corpus.raw_pages(spark, folder)

    def deliver(self, part):
        again = self.raw.filter(F.col("page_id") % 3 == part - 1).select(
            "page_id", F.regexp_replace("url", "^http", "HTTP").alias("url"),
            F.lit("<p>offered before</p></html>").alias("html"))
        # A file for every core of each side, so that a batch is worked on by all of them.
        files = max(4, self.spark.sparkContext.defaultParallelism)
        rows = self.raw.filter(F.col("page_id") % 3 == part).coalesce(files).unionByName(again.coalesce(files))
        _responses(rows).write.mode("append").parquet(self.inbox)

    def stream(self, max_files=1000):
        """Index what has arrived, always from the same offsets into the same store."""
        source = ingest.read_response_stream(self.spark, self.inbox, max_files=max_files)
        ingest.index_stream(source, self.store, self.offsets).awaitTermination()

    def known_jobs(self, nth):
        """Record the first or the second job of every host."""
        found = corpus.host_jobs(self.raw.select("page_id", "url")).filter(F.endswith("job_id", F.lit(f"#{nth}")))
        found = stage(found, "found")
        at = F.timestamp_seconds(F.lit(0))
        jobs = found.select("job_id", "origin_url").distinct().select(
            "job_id", "origin_url", F.lit(3).alias("max_depth"), F.lit(4.0).alias("rate_limit"),
            F.lit(100).alias("queue_capacity"), F.lit(4).alias("worker_count"), F.lit("running").alias("status"),
            at.alias("created_at"), at.alias("updated_at"),
            *[F.lit(0).cast("bigint").alias(c) for c in (
                "pages_discovered", "pages_indexed", "queue_backpressure_count", "rate_backpressure_count")])
        ingest.record_discoveries(self.store, jobs, found.select("job_id", "url", "depth"))


@query
def stream_postings(spark, folder):
    """Pages streamed into the store in three batches with repeats; the postings they leave."""
    arrivals = _Arrivals(spark, folder)
    for part in range(3):
        arrivals.deliver(part)
        arrivals.stream()
    return _bigints(arrivals.store.read("postings").drop("letter"))


@query
def store_compact_then_stream(spark, folder):
    """As `stream_postings`, the tables compacted between the batches."""
    arrivals = _Arrivals(spark, folder)
    for part in range(3):
        arrivals.deliver(part)
        arrivals.stream()
        arrivals.store.compact("pages")
        arrivals.store.compact("postings")
    return _bigints(arrivals.store.read("postings").drop("letter"))


@query
def store_late_job(spark, folder):
    """Half of the jobs come between the batches; the word entries are those of all."""
    arrivals = _Arrivals(spark, folder)
    arrivals.known_jobs(1)
    for part in range(3):
        arrivals.deliver(part)
        arrivals.stream()
        if part == 1:
            arrivals.known_jobs(2)
    return _bigints(arrivals.store.read("word_entries").drop("letter"))


@query
def store_recover_then_stream(spark, folder):
    """Jobs that a recovery has interrupted stay so while the stream goes on."""
    arrivals = _Arrivals(spark, folder)
    arrivals.known_jobs(1)
    arrivals.deliver(0)
    arrivals.stream()
    ingest.recover(arrivals.store)
    for part in (1, 2):
        arrivals.deliver(part)
        arrivals.stream()
    jobs = arrivals.store.read("jobs").select("job_id", "status")
    entries = arrivals.store.read("word_entries").groupBy("origin_url").agg(F.count("*").alias("n_entries"))
    origins = arrivals.store.read("jobs").select("job_id", "origin_url")
    return jobs.join(origins, "job_id").join(entries, "origin_url", "left").select(
        "job_id", "status", F.coalesce("n_entries", F.lit(0)).alias("n_entries"))


@query
def store_two_writers(spark, folder):
    """Two writers at the same time, each with half of the origins; no entry of either is lost."""
    store = IndexStore(spark, shared_folder(spark, "store"))
    entries = stage(_entries(spark, folder), "entries")
    with ThreadPoolExecutor(2) as writers:
        parts = [entries.filter(F.length("origin_url") % 2 == part) for part in range(2)]
        for done in [writers.submit(store.insert, "word_entries", part) for part in parts]:
            done.result()
    return _bigints(store.read("word_entries"))


@query
def job_run(spark, folder):
    """Every page as the origin of a one-hop job, run over the store to its end."""
    store = IndexStore(spark, shared_folder(spark, "store"))
    raw = corpus.raw_pages(spark, folder)
    ingest.index_responses(store, _responses(raw))
    seeds = raw.select(
        F.col("page_id").cast("string").alias("job_id"), F.col("url").alias("origin"), F.lit(1).alias("max_depth"))
    ingest.run_jobs(store, seeds)
    return store.read("jobs").select("job_id", "status", "pages_discovered", "pages_indexed")


@query
def stream_event_counters(spark, folder):
    """Events streamed into running per-job counts; the latest count of each."""
    where = shared_folder(spark, "counters")
    schema = corpus.table(spark, folder, "events").schema
    source = tables.stream_of_table(spark, folder, "events", schema)
    events = source.select(
        F.col("user_id").cast("string").alias("job_id"), F.col("event_type").alias("message")
    )

    def sink(batch, number):
        batch.withColumn("batch", F.lit(number)).write.mode("overwrite").parquet(f"{where}/{number}")

    ingest.counter_stream(events, sink, shared_folder(spark, "offsets")).awaitTermination()
    updates = spark.read.parquet(f"{where}/*")
    return updates.groupBy("job_id", "message").agg(F.max_by("events", "batch").alias("events"))


@query
def stream_pressure_sessions(spark, folder):
    """Error events streamed into the times of back-pressure that have ended, a minute of lateness allowed."""
    where = shared_folder(spark, "sessions")
    schema = corpus.table(spark, folder, "events").schema
    source = corpus.as_logs(tables.stream_of_table(spark, folder, "events", schema))
    events = source.withColumn("logged_at", F.col("logged_at").cast("timestamp"))
    ingest.session_stream(events, "error", where, shared_folder(spark, "offsets"), "60 seconds").awaitTermination()
    ended = spark.read.parquet(where)
    return ended.select("job_id", *[F.col(c).cast("timestamp_ntz").alias(c) for c in ("active_from", "active_until")], "n_events")

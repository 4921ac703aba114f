"""What each query must return, as SQL over the given tables (DuckDB dialect)."""

TOKENS = "[a-z0-9]+(?:''[a-z0-9]+)?"

# -- shared common table expressions -----------------------------------------

RAW = r"""
raw AS (
  SELECT page_id, regexp_replace(url, '#.*$', '') AS url, html FROM pages
  QUALIFY row_number() OVER (PARTITION BY regexp_replace(url, '#.*$', '') ORDER BY page_id DESC) = 1
)"""


def _unescape(text: str) -> str:
    for entity, character in [("&copy;", "©"), ("&middot;", "·"), ("&quot;", '"')]:
        text = f"replace({text}, '{entity}', '{character}')"
    return rf"regexp_replace({text}, '&amp;?', '&', 'g')"


def _collapsed(text: str) -> str:
    return rf"trim(regexp_replace({text}, '\s+', ' ', 'g'))"


PARSED = RAW + rf""",
opened AS (
  SELECT url, page_id, html, regexp_replace(html,
    '(?is)<!--.*?-->|<!doctype[^>]*>|<script[^>]*>.*?</script>|<style[^>]*>.*?</style>', ' ', 'g') AS body
  FROM raw
),
parsed AS (
  SELECT url, page_id, html,
    {_collapsed(_unescape("regexp_extract(body, '(?is)<title>(.*?)</title>', 1)"))} AS title,
    {_collapsed(_unescape("regexp_replace(body, '(?is)<title>.*?</title>|<[^>]*>', ' ', 'g')"))} AS text
  FROM opened
),
answered AS (SELECT * FROM parsed WHERE html LIKE '%</html>'),
hrefs AS (
  SELECT url, unnest(regexp_extract_all(html, '<a href="([^"]*)"', 1)) AS href,
    generate_subscripts(regexp_extract_all(html, '<a href="([^"]*)"', 1), 1) AS pos
  FROM raw
),
linked AS (
  SELECT url, dst, row_number() OVER (PARTITION BY url ORDER BY pos) - 1 AS position FROM (
    SELECT url, regexp_extract(url, '^https?://[^/]*') || href AS dst, min(pos) AS pos
    FROM hrefs GROUP BY ALL)
),
link_lists AS (
  SELECT url, string_agg(dst, ' ' ORDER BY position) AS links,
    list(dst ORDER BY position) AS link_list, count(*) AS n_links
  FROM linked GROUP BY url
)"""


def _words(source: str, key: str, column: str) -> str:
    return f"""SELECT {key}, unnest(regexp_extract_all(lower({column}), '{TOKENS}')) AS term FROM {source}"""


def _postings(source: str) -> str:
    return f"""
words AS (
  SELECT url, term, 1 AS f, 0 AS t FROM ({_words(source, 'url', 'text')})
  UNION ALL
  SELECT url, term, 0, 1 FROM ({_words(source, 'url', 'title')})
),
postings AS (
  SELECT term, url, sum(f)::BIGINT AS frequency, sum(t)::BIGINT AS title_hits FROM words GROUP BY ALL
)"""


DISCOVERIES = """
hosted AS (
  SELECT url, page_id, regexp_extract(url, '^https?://([^/:?#]*)', 1) AS host FROM raw
),
origins AS (SELECT host, arg_min(url, page_id) AS origin_url FROM hosted GROUP BY host),
discoveries AS (
  SELECT host || job AS job_id, origin_url, url,
    CASE WHEN url = origin_url THEN 0 WHEN contains(url, '?') THEN 1
         WHEN url LIKE '%/' THEN 3 ELSE 2 END AS depth
  FROM hosted JOIN origins USING (host), (VALUES ('#1'), ('#2')) j(job)
)"""

ENTRIES = PARSED + "," + DISCOVERIES + f""",
entries AS (
  SELECT term AS word, url, origin_url, depth::BIGINT AS depth, n AS frequency
  FROM (SELECT url, term, count(*) AS n FROM ({_words('parsed', 'url', 'text')}) GROUP BY ALL)
  JOIN (SELECT DISTINCT url, origin_url, depth FROM discoveries) USING (url)
)"""

SEARCH = ENTRIES + "," + _postings("parsed") + f""",
asked AS (
  SELECT query_id, term, count(*) AS times
  FROM ({_words('(SELECT item_id AS query_id, text FROM benchmark)', 'query_id', 'text')}) GROUP BY ALL
),
scored AS (
  SELECT query_id, url, sum(times * (frequency + 5 * title_hits))::BIGINT AS score,
    sum(times * frequency)::BIGINT AS frequency
  FROM asked JOIN postings USING (term) GROUP BY ALL
),
plain AS (
  SELECT query_id, url AS relevant_url, origin_url, depth::BIGINT AS depth, score, frequency,
    coalesce(nullif(title, ''), url) AS title
  FROM scored JOIN discoveries USING (url) JOIN parsed USING (url)
),
exact AS (
  SELECT query_id, url AS relevant_url, origin_url, depth,
    (sum(10 * entries.frequency + 1000) - 5 * depth)::BIGINT AS score,
    sum(entries.frequency)::BIGINT AS frequency, coalesce(nullif(title, ''), url) AS title
  FROM asked JOIN entries ON term = word JOIN parsed USING (url) GROUP BY query_id, url, origin_url, depth, title
)"""

# A third of the pages with the text and title of a second fetch.
ANEW = PARSED + """,
anew AS (
  SELECT url, CASE WHEN length(url) % 3 = 0
      THEN coalesce(title, '') || ' fetched anew ' || left(text, 200) ELSE text END AS text,
    CASE WHEN length(url) % 3 = 0 THEN 'Anew ' || coalesce(title, '') ELSE title END AS title
  FROM parsed
)"""

OUTCOMES = RAW + """,
outcomes AS (
  SELECT url, html LIKE '%</html>' AS good,
    CASE WHEN html LIKE '%</html>' THEN 200 ELSE 0 END AS status_code,
    CASE WHEN html NOT LIKE '%</html>' THEN 'unexpected error: incomplete body' END AS error
  FROM raw
)"""

# Every page is the origin of a job; links of good pages are found one hop on.
PAGE_CRAWL = OUTCOMES + r""",
found AS (
  SELECT page_id::VARCHAR AS job_id, url, 0 AS depth FROM raw
  UNION ALL
  SELECT DISTINCT page_id::VARCHAR, dst, 1 FROM (
    SELECT page_id, url, regexp_extract(url, '^https?://[^/]*')
      || unnest(regexp_extract_all(html, '<a href="([^"]*)"', 1)) AS dst
    FROM raw JOIN (SELECT url FROM outcomes WHERE good) USING (url))
  WHERE dst <> url
)"""

SITE = "'http://site.test/"
ORDER_STATUS = "CASE o_orderstatus WHEN 'O' THEN 'running' WHEN 'P' THEN 'created' ELSE 'completed' END"


def _with(tables: str, select: str) -> str:
    return f"WITH RECURSIVE {tables}\n{select}"


ORACLES = {
    "pages_scan": _with(PARSED, """
SELECT url, title, text, coalesce(links, '') AS links, coalesce(n_links, 0)::BIGINT AS n_links, 200 AS status_code
FROM parsed LEFT JOIN link_lists USING (url)"""),
    "page_titles": _with(PARSED, "SELECT url, title FROM parsed"),
    "page_text": _with(PARSED, "SELECT url, text FROM parsed"),
    "page_links": _with(PARSED, "SELECT url AS src, position, dst FROM linked"),
    "links_distinct": _with(PARSED, """
SELECT url, 2 * coalesce(n, 0) AS n_raw, coalesce(links, '') AS links FROM raw
LEFT JOIN (SELECT url, count(*) AS n FROM hrefs GROUP BY url) USING (url) LEFT JOIN link_lists USING (url)"""),
    "links_json": _with(PARSED, """
SELECT url, coalesce(to_json(link_list)::VARCHAR, '[]') AS links_json, coalesce(n_links, 0)::BIGINT AS n_links
FROM parsed LEFT JOIN link_lists USING (url)"""),
    "content_dispatch": _with(PARSED, """
SELECT url,
  CASE WHEN contains(url, '?') THEN regexp_extract(url, '^https?://[^/?#]*([^?#]*)', 1) ELSE title END AS title,
  md5(CASE WHEN contains(url, '?') THEN html ELSE text END) AS text_md5,
  CASE WHEN contains(url, '?') THEN 0 ELSE coalesce(n_links, 0) END::BIGINT AS n_links
FROM parsed LEFT JOIN link_lists USING (url)"""),
    "truncate_body": r"""
WITH bodies AS (
  SELECT doc_id, repeat(regexp_replace(text, '[^ -~]', '?', 'g'), CASE WHEN doc_id % 10 = 0 THEN 500 ELSE 2 END)
    AS body FROM documents),
cut AS (
  SELECT doc_id, CASE WHEN length(body) > 1000000
    THEN left(body, 1000000) || chr(10) || '[truncated after 1000000 bytes]' ELSE body END AS text FROM bodies)
SELECT 'http://site.test/doc/' || doc_id AS url, length(text) AS n_chars, md5(text) AS text_md5,
  '/doc/' || doc_id AS title FROM cut""",
    "error_classes": f"""
SELECT {SITE}order/' || o_orderkey AS url,
  [200, 404, 503, 302, 0, 0][o_orderkey % 6 + 1] AS status_code,
  [NULL, 'HTTP 404', 'HTTP 503', 'HTTP 302', 'URL error: timed out',
   'unexpected error: no memory'][o_orderkey % 6 + 1] AS error,
  CASE o_orderkey % 6 WHEN 0 THEN o_orderpriority ELSE '' END AS text
FROM orders""",
    "decode_bodies": r"""
SELECT 'http://site.test/doc/' || doc_id AS url, md5(regexp_replace(text, '[^\x00-\xff]', '?', 'g')) AS text_md5,
  NULL::VARCHAR AS error FROM documents""",
    "tokenize_docs": f"""
SELECT doc_id, array_to_string(regexp_extract_all(lower(text), '{TOKENS}'), ' ') AS tokens FROM documents""",
    "term_frequency": f"""
SELECT doc_id, term, count(*) AS n FROM ({_words('documents', 'doc_id', 'text')}) GROUP BY ALL""",
    "letter_histogram": f"""
SELECT left(term, 1) AS letter, count(DISTINCT term) AS n_words, count(*) AS n_tokens
FROM ({_words('documents', 'doc_id', 'text')}) GROUP BY ALL""",
    "collapse_whitespace": f"SELECT doc_id, {_collapsed('text')} AS text FROM documents",
    "normalize_urls": r"""
WITH parts AS (
  SELECT page_id, regexp_extract(url, '^(https?)://([^/]*)(.*)$', 1) AS s,
    regexp_extract(url, '^(https?)://([^/]*)(.*)$', 2) AS h,
    regexp_replace(regexp_extract(url, '^(https?)://([^/]*)(.*)$', 3), '#.*$', '') AS r FROM pages)
SELECT page_id, kind, CASE
  WHEN kind IN ('mail', 'ftp') THEN NULL
  WHEN kind = 'port_8443' THEN s || '://' || h || ':8443' || r
  WHEN kind = 'port_80' AND s = 'https' THEN s || '://' || h || ':80' || r
  ELSE s || '://' || h || r END AS url
FROM parts, (VALUES ('plain'), ('upper'), ('port_80'), ('port_8443'), ('user'), ('mail'), ('ftp'), ('padded')) k(kind)""",
    "resolve_links": _with(PARSED, r"""
SELECT page_id, pos - 1 AS position, kind, CASE kind
  WHEN 'other_host' THEN regexp_extract(url, '^https?') || '://cdn.test' || href
  WHEN 'query' THEN regexp_replace(url, '\?.*$', '') || '?p=' || (pos - 1)
  WHEN 'fragment' THEN url
  ELSE regexp_extract(url, '^https?://[^/]*') || href END AS link
FROM hrefs JOIN raw USING (url),
  (VALUES ('rooted'), ('other_host'), ('dots'), ('query'), ('fragment')) k(kind)"""),
    "seed_validation": """
SELECT c_custkey::VARCHAR AS job_id,
  CASE WHEN c_custkey % 9 <> 0 THEN 'http://site.test/c/' || c_custkey END AS origin_url,
  c_custkey % 5 - 1 AS max_depth,
  CASE WHEN c_custkey % 9 = 0 THEN 'origin must be a valid http or https URL'
    WHEN c_custkey % 11 = 0 THEN 'worker_count must be a number'
    WHEN c_custkey % 5 = 0 THEN 'max_depth must be >= 0'
    WHEN c_custkey % 7 = 0 THEN 'queue_capacity must be >= 1'
    WHEN c_acctbal <= 0 THEN 'rate_limit must be > 0'
    WHEN c_custkey % 4 = 0 THEN 'worker_count must be >= 1' END AS reject_reason
FROM customer""",
    "seed_duplicates": f"""
SELECT {SITE}nation/' || c_nationkey AS origin_url, count(*) AS n_jobs, c_nationkey % 3 AS max_depth
FROM customer GROUP BY c_nationkey""",
    "bfs_depths": f"""
WITH RECURSIVE edges AS (
  SELECT {SITE}region/' || n_regionkey AS src, {SITE}nation/' || n_nationkey AS dst FROM nation
  UNION ALL SELECT {SITE}nation/' || c_nationkey, {SITE}customer/' || c_custkey FROM customer
  UNION ALL SELECT {SITE}customer/' || o_custkey, {SITE}order/' || o_orderkey FROM orders
), walk AS (
  SELECT 'r' || r_regionkey AS job_id, {SITE}region/' || r_regionkey AS origin_url,
    {SITE}region/' || r_regionkey AS url, 0 AS depth FROM region
  UNION SELECT job_id, origin_url, dst, depth + 1 FROM walk JOIN edges ON src = url WHERE depth < 3
) SELECT job_id, origin_url, url, min(depth) AS depth FROM walk GROUP BY ALL""",
    "bfs_multi_seed": f"""
WITH RECURSIVE pairs AS (
  SELECT {SITE}customer/' || o_custkey AS a, {SITE}order/' || o_orderkey AS b FROM orders
), edges AS (SELECT a AS src, b AS dst FROM pairs UNION ALL SELECT b, a FROM pairs
), walk AS (
  SELECT 'c' || c_custkey AS job_id, {SITE}customer/' || c_custkey AS origin_url,
    CASE WHEN c_acctbal < 0 THEN 1 ELSE 3 END AS k, {SITE}customer/' || c_custkey AS url, 0 AS depth
  FROM customer
  UNION SELECT job_id, origin_url, k, dst, depth + 1 FROM walk JOIN edges ON src = url WHERE depth < k
) SELECT job_id, origin_url, url, min(depth) AS depth FROM walk GROUP BY job_id, origin_url, url""",
    "dead_links": _with(PAGE_CRAWL, """
SELECT job_id, url, depth FROM found WHERE url NOT IN (SELECT url FROM outcomes WHERE good)"""),
    "fetch_list": _with(PAGE_CRAWL, """
SELECT DISTINCT url FROM found WHERE url NOT IN (SELECT url FROM outcomes)"""),
    "frontier_actions": _with(PAGE_CRAWL, """
SELECT job_id, url, depth, CASE WHEN good THEN 'ready' WHEN NOT good THEN 'failed'
  WHEN row_number() OVER (PARTITION BY url ORDER BY depth, job_id) = 1 THEN 'fetch' ELSE 'wait' END AS action
FROM found LEFT JOIN outcomes USING (url)"""),
    "shared_page_delivery": _with(PAGE_CRAWL, """
SELECT job_id, url, depth, CASE WHEN good THEN 'fetched' ELSE 'failed' END AS state
FROM found JOIN outcomes USING (url)"""),
    "fetch_state": _with(OUTCOMES, """
SELECT url, CASE WHEN good THEN 'fetched' ELSE 'failed' END AS state FROM outcomes"""),
    "build_postings": _with(PARSED + "," + _postings("parsed"), "SELECT * FROM postings"),
    "document_postings": _with("""
docs AS (SELECT 'doc:' || doc_id AS url, split_part(text, chr(10), 1) AS title, text FROM documents)"""
                               + "," + _postings("docs"), "SELECT * FROM postings"),
    "build_word_entries": _with(ENTRIES, "SELECT * FROM entries"),
    "word_entry_delta": _with(ENTRIES, """
SELECT * FROM entries WHERE origin_url NOT LIKE 'http://%' OR word LIKE 'a%'"""),
    "word_entry_upsert": _with(ENTRIES, "SELECT *, left(word, 1) AS letter FROM entries"),
    "word_entries_rebuild": _with(ENTRIES, "SELECT *, left(word, 1) AS letter FROM entries"),
    "word_entries_dedup": _with(ENTRIES, "SELECT * FROM entries"),
    "word_lines_export": _with(ENTRIES, """
SELECT left(word, 1) AS letter, concat_ws(' ', word, url, origin_url, depth, frequency) AS line FROM entries"""),
    "word_lines_roundtrip": _with(ENTRIES, "SELECT * FROM entries"),
    "search_default": _with(SEARCH, "SELECT * FROM plain"),
    "search_relevance": _with(SEARCH, "SELECT * FROM exact"),
    "search_ranked": _with(SEARCH, """
SELECT query_id, relevant_url, origin_url, depth, score, row_number() OVER (
  PARTITION BY query_id ORDER BY score DESC, depth, relevant_url, origin_url) AS position FROM plain"""),
    "search_mixed": _with(SEARCH, """
SELECT *, 'default' AS sort_by FROM plain UNION ALL SELECT *, 'relevance' FROM exact"""),
    "search_json": _with(SEARCH, """
SELECT query_id, sort_by, json_object('url', relevant_url, 'relevant_url', relevant_url,
  'origin_url', origin_url, 'origin', origin_url, 'depth', depth, 'frequency', frequency,
  'relevance_score', CASE WHEN sort_by = 'relevance' THEN score END, 'score', score,
  'title', title)::VARCHAR AS result
FROM (SELECT *, 'default' AS sort_by FROM plain UNION ALL SELECT *, 'relevance' FROM exact)"""),
    "search_plain_json": _with(SEARCH, """
SELECT query_id, json_object('url', relevant_url, 'relevant_url', relevant_url, 'origin_url', origin_url,
  'depth', depth, 'frequency', frequency, 'score', score, 'title', title)::VARCHAR AS result FROM plain"""),
    "search_stored_index": _with(SEARCH, "SELECT * FROM plain"),
    "search_posting_blocks": _with(SEARCH, "SELECT * FROM plain"),
    "posting_block_layout": _with("""
docs AS (SELECT 'doc:' || doc_id AS url, split_part(text, chr(10), 1) AS title, text FROM documents)"""
                                  + "," + _postings("docs"), """
SELECT term, count(*) AS n_pages, sum(frequency)::BIGINT AS frequency, sum(title_hits)::BIGINT AS title_hits
FROM postings GROUP BY term"""),
    "refetch_postings": _with(ANEW + "," + _postings("anew"), "SELECT * FROM postings"),
    "refetch_word_entries": _with(ANEW + "," + DISCOVERIES, f"""
SELECT term AS word, url, origin_url, depth::BIGINT AS depth, n AS frequency
FROM (SELECT url, term, count(*) AS n FROM ({_words('anew', 'url', 'text')}) GROUP BY ALL)
JOIN (SELECT DISTINCT url, origin_url, depth FROM discoveries) USING (url)"""),
    "page_upsert": _with(RAW, """
SELECT 'http://' || regexp_extract(url, '^https?://([^/:?#]*)', 1) || '/' AS url, url AS title, page_id,
  length(html) AS n_chars FROM raw
QUALIFY row_number() OVER (PARTITION BY regexp_extract(url, '^https?://([^/:?#]*)', 1)
  ORDER BY url LIKE 'https://%' DESC, page_id DESC) = 1"""),
    "job_upsert": """
SELECT user_id::VARCHAR AS job_id, event_type AS message, event_id AS id FROM events
QUALIFY row_number() OVER (PARTITION BY user_id
  ORDER BY event_type IN ('error', 'purchase') DESC, event_id DESC) = 1""",
    "discovery_upsert": f"""
SELECT l_suppkey::VARCHAR AS job_id, {SITE}part/' || l_partkey AS url,
  l_orderkey * 10 + l_linenumber AS written, l_linenumber AS depth FROM lineitem
QUALIFY row_number() OVER (PARTITION BY l_suppkey, l_partkey
  ORDER BY l_linenumber > 3 DESC, l_orderkey * 10 + l_linenumber DESC) = 1""",
    "mark_interrupted_jobs": """
SELECT o_orderkey::VARCHAR AS job_id,
  CASE WHEN o_orderstatus IN ('O', 'P') THEN 'interrupted' ELSE 'completed' END AS status FROM orders""",
    "jobs_newest": f"""
SELECT o_orderkey::VARCHAR AS job_id, {SITE}customer/' || o_custkey AS origin_url, o_orderdate AS created_at,
  row_number() OVER (ORDER BY o_orderdate DESC, o_orderkey::VARCHAR) AS position FROM orders""",
    "discoveries_with_origin": f"""
SELECT l_orderkey::VARCHAR AS job_id, {SITE}part/' || l_partkey AS url, l_linenumber AS depth,
  {SITE}customer/' || o_custkey AS origin_url FROM lineitem JOIN orders ON o_orderkey = l_orderkey
WHERE o_orderstatus <> 'P'""",
    "status_rollup": _with(OUTCOMES, f"""
SELECT * FROM (
  SELECT bool_or(o_orderstatus = 'O') AS indexing_active,
    bool_or(o_orderstatus = 'O' AND o_totalprice > 150000) AS backpressure_active,
    sum(CASE WHEN o_orderstatus = 'O' THEN floor(o_totalprice / 1000)::BIGINT END)::BIGINT AS queue_depth
  FROM orders WHERE o_orderstatus <> 'F'),
 (SELECT count_if(good)::BIGINT AS pages_indexed, count_if(NOT good)::BIGINT AS pages_failed,
    count(*) AS visited_urls FROM outcomes)"""),
    "job_counters": """
SELECT l_suppkey AS job_id, count(*) AS pages_discovered, count_if(p_size > 10)::BIGINT AS pages_indexed,
  count_if(NOT coalesce(p_size > 10, false))::BIGINT AS pages_waiting
FROM (SELECT DISTINCT l_suppkey, l_partkey FROM lineitem) LEFT JOIN part ON p_partkey = l_partkey GROUP BY ALL""",
    "event_counters": """
SELECT user_id::VARCHAR AS job_id, count_if(event_type = 'error')::BIGINT AS queue_backpressure_count,
  count_if(event_type = 'click')::BIGINT AS rate_backpressure_count FROM events GROUP BY ALL""",
    "jobs_live_union_history": f"""
SELECT o_orderkey::VARCHAR AS job_id, {SITE}customer/' || o_custkey AS origin_url,
  CASE WHEN live THEN {ORDER_STATUS} ELSE 'stored' END AS status,
  CASE WHEN live THEN floor(o_totalprice / 1000)::BIGINT ELSE 0 END AS queue_depth,
  CASE WHEN live THEN 4 ELSE 0 END::BIGINT AS active_workers, 0::BIGINT AS pending_shared_pages,
  live AND o_totalprice > 200000 AS queue_backpressure_active,
  live AND o_totalprice > 150000 AND o_totalprice <= 200000 AS rate_backpressure_active
FROM (SELECT *, o_orderstatus <> 'F' AS live FROM orders)""",
    "backpressure_recent": """
SELECT job_id, last_at, last_at > present - INTERVAL 2 SECONDS AS active FROM (
  SELECT user_id::VARCHAR AS job_id, max(CASE WHEN event_type = 'error' THEN ts END) AS last_at,
    max(ts) AS present FROM events GROUP BY user_id) WHERE last_at IS NOT NULL""",
    "recent_logs": """
SELECT id, job_id, logged_at, message, row_number() OVER (PARTITION BY job_id ORDER BY id) AS line FROM (
  SELECT event_id AS id, event_type AS job_id, ts AS logged_at, event_type AS message FROM events
  QUALIFY row_number() OVER (PARTITION BY event_type ORDER BY event_id DESC) <= 100)""",
    "recent_logs_long": """
SELECT id, job_id, logged_at, message, row_number() OVER (PARTITION BY job_id ORDER BY id) AS line FROM (
  SELECT event_id AS id, event_type AS job_id, ts AS logged_at, event_type AS message FROM events
  QUALIFY row_number() OVER (PARTITION BY event_type ORDER BY event_id DESC) <= 1500)""",
    "log_append": """
SELECT user_id::VARCHAR AS job_id, count(*) AS n_lines, max(event_id) AS last_id,
  count_if(event_type = 'error')::BIGINT AS n_errors FROM events GROUP BY ALL""",
    "job_lookup": f"""
SELECT o_orderkey::VARCHAR AS job_id, {SITE}customer/' || o_custkey AS origin_url,
  CASE WHEN o_orderstatus <> 'F' THEN {ORDER_STATUS} ELSE 'stored' END AS status FROM orders WHERE o_orderkey = 1""",
    "job_status_latest": """
SELECT user_id::VARCHAR AS job_id, coalesce(
  arg_min(status, (ts, event_id)) FILTER (status IN ('completed', 'interrupted')),
  arg_max(status, (ts, event_id))) AS status
FROM (SELECT *, CASE event_type WHEN 'signup' THEN 'created' WHEN 'purchase' THEN 'completed'
  WHEN 'error' THEN 'interrupted' ELSE 'running' END AS status FROM events) GROUP BY user_id""",
    "stream_postings": _with(PARSED + "," + _postings("answered"), "SELECT * FROM postings"),
    "store_compact_then_stream": _with(PARSED + "," + _postings("answered"), "SELECT * FROM postings"),
    "store_late_job": _with(ENTRIES, """
SELECT * FROM entries WHERE url IN (SELECT url FROM answered)"""),
    "store_two_writers": _with(ENTRIES, "SELECT *, left(word, 1) AS letter FROM entries"),
    "log_times": """
SELECT event_id AS id, strftime(date_trunc('second', ts), '%Y-%m-%dT%H:%M:%S') || CASE event_id % 3
  WHEN 0 THEN CASE WHEN event_id % 1000 = 0 THEN '' ELSE printf('.%06d', event_id % 1000 * 1000) END
  WHEN 1 THEN '.000007' ELSE '' END || '+00:00' AS logged_at FROM events""",
    "store_recover_then_stream": _with(ENTRIES, """
SELECT DISTINCT job_id, 'interrupted' AS status, coalesce(n, 0) AS n_entries FROM discoveries
LEFT JOIN (SELECT origin_url, count(*) AS n FROM entries WHERE url IN (SELECT url FROM answered) GROUP BY ALL)
  USING (origin_url) WHERE job_id LIKE '%#1'"""),
    "job_run": _with(PAGE_CRAWL, """
SELECT job_id, 'completed' AS status, count(*) AS pages_discovered,
  count(good)::BIGINT AS pages_indexed FROM found LEFT JOIN outcomes USING (url) GROUP BY job_id"""),
    "stream_event_counters": """
SELECT user_id::VARCHAR AS job_id, event_type AS message, count(*) AS events FROM events GROUP BY ALL""",
    "stream_pressure_sessions": """
WITH logs AS (SELECT user_id::VARCHAR AS job_id, ts FROM events WHERE event_type = 'error'),
marked AS (SELECT job_id, ts, coalesce(ts - lag(ts) OVER (PARTITION BY job_id ORDER BY ts) > INTERVAL 2 SECONDS, true)
    ::INT AS begins FROM logs),
numbered AS (SELECT job_id, ts, sum(begins) OVER (PARTITION BY job_id ORDER BY ts RANGE UNBOUNDED PRECEDING) AS nth
  FROM marked)
SELECT job_id, min(ts) AS active_from, max(ts) + INTERVAL 2 SECONDS AS active_until, count(*) AS n_events
FROM numbered GROUP BY job_id, nth
HAVING max(ts) + INTERVAL 2 SECONDS <= date_trunc('millisecond', (SELECT max(ts) FROM events) - INTERVAL 60 SECONDS)""",
}

"""Table schemas. Field order is the column order of every written table."""

from pyspark.sql import types as T


_TYPES = {
    "string": T.StringType(),
    "int": T.IntegerType(),
    "bigint": T.LongType(),
    "double": T.DoubleType(),
    "timestamp": T.TimestampType(),
    "binary": T.BinaryType(),
    "strings": T.ArrayType(T.StringType()),
    "headers": T.MapType(T.StringType(), T.StringType()),
}


def _schema(columns: str) -> T.StructType:
    pairs = [column.split() for column in columns.split(",")]
    return T.StructType([T.StructField(name, _TYPES[kind]) for name, kind in pairs])


# What a fetcher hands over: one row per answered (or failed) request.
RESPONSES = _schema(
    "url string, status int, headers headers, body binary, error string"
)

# One row per fetched URL; `url` is the key.
PAGES = _schema(
    "url string, title string, text string, links strings, "
    "fetched_at timestamp, status_code int, error string"
)

# One row per crawl job; `job_id` is the key. Names and order of the columns.
JOBS = _schema(
    "job_id string, origin_url string, max_depth int, rate_limit double, "
    "queue_capacity int, worker_count int, status string, "
    "created_at timestamp, updated_at timestamp, pages_discovered bigint, "
    "pages_indexed bigint, queue_backpressure_count bigint, "
    "rate_backpressure_count bigint"
)

# Key (job_id, url). The origin is looked up from JOBS.
DISCOVERIES = _schema("job_id string, url string, depth int")

# Append-only; `id` grows with time inside a job.
JOB_LOGS = _schema("id bigint, job_id string, logged_at timestamp, message string")

# Key (term, url).
POSTINGS = _schema("term string, url string, frequency int, title_hits int")

# Key (word, url, origin_url, depth).
WORD_ENTRIES = _schema(
    "word string, url string, origin_url string, depth int, frequency int"
)
WORD_ENTRY_KEY = ["word", "url", "origin_url", "depth"]

# A batch of searches and a batch of crawl requests.
QUERIES = _schema("query_id bigint, text string, sort_by string")
SEEDS = _schema(
    "job_id string, origin string, max_depth int, queue_capacity int, "
    "rate_limit double, worker_count int"
)

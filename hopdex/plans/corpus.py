"""Inputs that Spark derives from the given tables.

pages          -> fetched pages, link discoveries, word entries
documents      -> plain-text pages
lineitem       -> a bag of discoveries
region..orders -> a link tree
orders         -> crawl jobs and a cyclic customer-order link graph
events         -> job logs
benchmark      -> search batches
"""

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from hopdex.functions.urls import host_of, normalize_url
from hopdex.operators.extract import parse_html_pages
from hopdex.operators.joins import match_join, newest_wide
from hopdex.session import stage
from hopdex.sources.tables import spread_if_few

SITE = "http://site.test"
EPOCH = "2024-01-01 00:00:00"


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def at_second(number: Column) -> Column:
    """A timestamp that many seconds after a fixed moment."""
    return F.timestamp_seconds(F.unix_timestamp(F.lit(EPOCH)) + number)


def raw_pages(spark: SparkSession, folder: str, columns: tuple = ("page_id", "url", "html")) -> DataFrame:
    """(page_id, url, html) or fewer of them, one row per canonical URL: the last fetch counts.

    Written with its canonical URLs: the plans that follow then have no Python worker for
    them next to that of the parser, and none does that work again.
    """
    raw = spread_if_few(table(spark, folder, "pages")).select(*columns)
    raw = stage(raw.withColumn("url", normalize_url(F.col("url"))), "raw")
    return newest_wide(raw.filter("url IS NOT NULL"), "url", "page_id")


def fetched_pages(spark: SparkSession, folder: str) -> DataFrame:
    """Parsed page rows, computed once and written."""
    raw = raw_pages(spark, folder)
    return stage(parse_html_pages(raw, at_second(F.col("page_id"))), "pages")


def page_outcomes(spark: SparkSession, folder: str) -> DataFrame:
    """(url, status_code, error) of every page, without parsing: cut-off HTML failed."""
    whole = F.endswith("html", F.lit("</html>")).alias("whole")
    return raw_pages(spark, folder, ("page_id", "url", whole)).select(
        "url",
        F.when(F.col("whole"), 200).otherwise(0).alias("status_code"),
        F.when(~F.col("whole"), F.lit("unexpected error: incomplete body")).alias("error"),
    )


def host_jobs(urls: DataFrame) -> DataFrame:
    """Two jobs per host over (page_id, url) rows; origin is the host's first page.

    Depth is a function of the URL: 0 for the origin, else 1 with a query, 3 with
    a trailing slash, 2 for the rest.
    """
    hosted = urls.withColumn("host", host_of(F.col("url")))
    origins = hosted.groupBy("host").agg(F.min_by("url", "page_id").alias("origin_url"))
    joined = match_join(hosted, origins, ["host"], ["url"])
    depth = (
        F.when(F.col("url") == F.col("origin_url"), 0)
        .when(F.contains("url", F.lit("?")), 1)
        .when(F.endswith("url", F.lit("/")), 3)
        .otherwise(2)
    )
    return joined.select(
        F.explode(F.array(F.lit("#1"), F.lit("#2"))).alias("_job"), "host", "url", "origin_url",
        depth.alias("depth"),
    ).select(F.concat("host", "_job").alias("job_id"), "origin_url", "url", "depth")


def host_discoveries(spark: SparkSession, folder: str) -> DataFrame:
    return host_jobs(raw_pages(spark, folder, ("page_id", "url")))


def document_pages(spark: SparkSession, folder: str) -> DataFrame:
    """Documents as pages: the first line is the title, the whole text is the text."""
    docs = spread_if_few(table(spark, folder, "documents"))
    return docs.select(
        F.concat(F.lit("doc:"), F.col("doc_id").cast("string")).alias("url"),
        F.substring_index("text", "\n", 1).alias("title"),
        "text",
        F.lit(200).alias("status_code"),
        F.lit(None).cast("string").alias("error"),
    )


def benchmark_queries(spark: SparkSession, folder: str) -> DataFrame:
    """Every benchmark text as a search, in both modes."""
    modes = F.explode(F.array(F.lit("default"), F.lit("relevance"))).alias("sort_by")
    return table(spark, folder, "benchmark").select(
        F.col("item_id").alias("query_id"), "text", modes
    )


def node_url(kind: str, key: str) -> Column:
    return F.concat(F.lit(f"{SITE}/{kind}/"), F.col(key).cast("string"))


def tree_edges(spark: SparkSession, folder: str) -> DataFrame:
    """region -> nation -> customer -> order links."""
    def step(name, parent, parent_key, child, child_key):
        return table(spark, folder, name).select(
            node_url(parent, parent_key).alias("src"), node_url(child, child_key).alias("dst")
        )

    nations = step("nation", "region", "n_regionkey", "nation", "n_nationkey")
    customers = step("customer", "nation", "c_nationkey", "customer", "c_custkey")
    orders = step("orders", "customer", "o_custkey", "order", "o_orderkey")
    return nations.unionByName(customers).unionByName(orders)


def order_edges(spark: SparkSession, folder: str) -> DataFrame:
    """customer <-> order links in both directions: as many as orders, with cycles."""
    pairs = table(spark, folder, "orders").select(
        node_url("customer", "o_custkey").alias("a"), node_url("order", "o_orderkey").alias("b"))
    forth = pairs.select(F.col("a").alias("src"), F.col("b").alias("dst"))
    return forth.unionByName(pairs.select(F.col("b").alias("src"), F.col("a").alias("dst")))


def order_jobs(spark: SparkSession, folder: str) -> DataFrame:
    """Orders as crawl jobs."""
    letter = F.col("o_orderstatus")
    status = F.when(letter == "O", "running").when(letter == "P", "created").otherwise("completed")
    return table(spark, folder, "orders").select(
        F.col("o_orderkey").cast("string").alias("job_id"),
        node_url("customer", "o_custkey").alias("origin_url"),
        status.alias("status"),
        F.col("o_orderdate").alias("created_at"),
        F.col("o_totalprice").alias("rate_limit"),
        F.col("o_orderpriority").alias("priority"),
    )


def line_discoveries(spark: SparkSession, folder: str) -> DataFrame:
    """Line items as discoveries: the order is the job, the part is the URL."""
    return table(spark, folder, "lineitem").select(
        F.col("l_orderkey").cast("string").alias("job_id"),
        node_url("part", "l_partkey").alias("url"),
        F.col("l_linenumber").alias("depth"),
    )


def event_logs(spark: SparkSession, folder: str) -> DataFrame:
    """Events as job logs: the user is the job, the event type is the message."""
    return as_logs(table(spark, folder, "events"))


def as_logs(events: DataFrame) -> DataFrame:
    return events.select(
        F.col("event_id").alias("id"),
        F.col("user_id").cast("string").alias("job_id"),
        F.col("ts").alias("logged_at"),
        F.col("event_type").alias("message"),
    )

"""Breadth-first crawl over tables of fetched pages."""

import uuid
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from hopdex.functions.urls import normalize_url
from hopdex.operators.extract import fetch_state, is_success
from hopdex.operators.joins import HOT_ROWS, drop_known, is_small, match_join, only_keys
from hopdex.operators.ranking import rank_within
from hopdex.schemas import SEEDS
from hopdex.session import shared_folder, stage

# What a seed gets for fields it leaves empty, and the messages of
# refused seeds.
SEED_DEFAULTS = {"max_depth": 0, "queue_capacity": 100, "rate_limit": 4.0, "worker_count": 4}
SEED_RULES = [
    ("origin_url IS NOT NULL", "origin must be a valid http or https URL"),
    ("max_depth >= 0", "max_depth must be >= 0"),
    ("queue_capacity >= 1", "queue_capacity must be >= 1"),
    ("rate_limit > 0", "rate_limit must be > 0"),
    ("worker_count >= 1", "worker_count must be >= 1"),
]


def check_seeds(seeds: DataFrame) -> DataFrame:
    """Seeds with canonical `origin_url` and the first broken rule in `reject_reason`.

    A field that is not a number of its type refuses its seed and no other.
    """
    malformed = []
    for name, value in SEED_DEFAULTS.items():
        given = F.col(name) if name in seeds.columns else F.lit(None)
        number = given.cast("string").try_cast(SEEDS[name].dataType)
        malformed.append(F.when(F.col(f"_{name}"), F.lit(f"{name} must be a number")))
        seeds = seeds.withColumns({
            f"_{name}": given.isNotNull() & number.isNull(),
            name: F.when(given.isNull(), F.lit(value).cast(SEEDS[name].dataType)).otherwise(number),
        })
    seeds = seeds.withColumn("origin_url", normalize_url(F.col("origin")))
    broken = [F.when(~F.expr(rule), F.lit(message)) for rule, message in SEED_RULES]
    # The origin first, then malformed fields, then the ranges.
    reason = F.coalesce(broken[0], *malformed, *broken[1:])
    return seeds.withColumn("reject_reason", reason).drop(*[f"_{name}" for name in SEED_DEFAULTS])


def job_id_for(origin_url, max_depth, ordinal):
    """A repeatable id for jobs that come without one; equal requests differ in `ordinal`."""
    nth = F.when(ordinal > 1, ordinal.cast("string"))
    return F.sha2(F.concat_ws("#", origin_url, max_depth.cast("string"), nth), 256)


def accepted(checked: DataFrame) -> DataFrame:
    """The jobs of the good seeds with their settings. Two equal requests are two jobs."""
    settings = ["rate_limit", "queue_capacity", "worker_count"]
    given = F.col("job_id") if "job_id" in checked.columns else F.lit(None).cast("string")
    good = checked.filter("reject_reason IS NULL").select(
        given.alias("job_id"), "origin_url", "max_depth", *settings)
    # Equal rows are alike, so it does not matter which of them comes first.
    order = [F.col(c) for c in settings]
    placed = rank_within(good, ["job_id", "origin_url", "max_depth"], order, "_nth")
    made = job_id_for(F.col("origin_url"), F.col("max_depth"), F.col("_nth"))
    return placed.select(F.coalesce("job_id", made).alias("job_id"), "origin_url", "max_depth", *settings)


@dataclass
class LinkGraph:
    """Links between URLs as numbers.

    nodes: (url, node), a number for every URL. links: (src, dst), a table bucketed by
    src. heavy: the links of sources that have too many for one bucket, in no order.
    """

    nodes: DataFrame
    links: DataFrame
    heavy: DataFrame


def _buckets(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def _append_bucketed(rows: DataFrame, table: str, where: str, by: list[str]) -> DataFrame:
    """Add rows to a table in the shared folder that is bucketed by the columns `by`.

    A join or an aggregate by these columns reads it without a shuffle, however often
    it was added to.
    """
    spark = rows.sparkSession
    buckets = _buckets(spark)
    # One task writes a bucket, so that each addition has one file of it.
    rows = rows.repartition(buckets, *by)
    rows.write.mode("append").option("path", where).bucketBy(buckets, *by).sortBy(*by).saveAsTable(table)
    return spark.table(table)


def link_graph(edges: DataFrame, others: DataFrame, hot_rows: int = HOT_ROWS) -> LinkGraph:
    """The graph of edges (src, dst); `others` are URLs (url) that may have no link.

    URLs are shuffled as text here and never again: to number the distinct ones and to
    put their numbers in place of them. Hot targets are cut like any hot key.
    """
    spark = edges.sparkSession
    urls = edges.select(F.col("src").alias("url")).union(edges.select("dst")).union(others.select("url"))
    nodes = urls.filter("url is not null").distinct().withColumn("node", F.monotonically_increasing_id())
    nodes = stage(nodes, "nodes")  # numbers hold once they are written
    coded = match_join(edges, nodes.select(F.col("url").alias("dst"), F.col("node").alias("to")), ["dst"], ["src"])
    coded = match_join(coded, nodes.select(F.col("url").alias("src"), F.col("node").alias("from")), ["src"], ["to"])
    coded = stage(coded.select(F.col("from").alias("src"), F.col("to").alias("dst")), "links")
    sources = coded.groupBy("src").agg(F.count("*").alias("n")).filter(F.col("n") > hot_rows)
    sources = stage(sources.select("src"), "heavy")
    name = f"links_{uuid.uuid4().hex}"
    links = _append_bucketed(drop_known(coded, sources, ["src"]), name, shared_folder(spark, "graph"), ["src"])
    return LinkGraph(nodes, links, only_keys(coded, sources, ["src"]))


def _next(frontier: DataFrame, graph: LinkGraph, hot_rows: int) -> DataFrame:
    """(job, max_depth, node): what the links of a frontier lead to, repeats included."""
    all_links = graph.links.unionByName(graph.heavy)
    starts = frontier.select("job", "max_depth", F.col("node").alias("src"))
    if is_small(starts):
        met = all_links.join(F.broadcast(starts), "src")
        return met.select("job", "max_depth", F.col("dst").alias("node"))
    # Sources with many links, and those where many jobs are, are cut into pieces.
    busy = starts.groupBy("src").agg(F.count("*").alias("n")).filter(F.col("n") > hot_rows).select("src")
    apart = stage(busy.unionByName(graph.heavy.select("src").distinct()).distinct(), "apart")
    met = drop_known(starts, apart, ["src"]).repartition(_buckets(starts.sparkSession), "src").join(graph.links, "src")
    met = met.select("job", "max_depth", "dst")
    if not apart.isEmpty():
        cut = match_join(only_keys(starts, apart, ["src"]), only_keys(all_links, apart, ["src"]),
                         ["src"], ["job"], ["dst"], broadcast=None, hot_rows=hot_rows)
        met = met.unionByName(cut.select("job", "max_depth", "dst"))
    return met.select("job", "max_depth", F.col("dst").alias("node"))


def not_visited(reached: DataFrame, visited: DataFrame) -> DataFrame:
    """(job, node, max_depth): each reached node of a job once, without those it has visited.

    `visited` is bucketed by (job, node), so only what was reached is shuffled, by three
    numbers a row and without the repeats inside a task.
    """
    once = reached.groupBy("job", "node").agg(F.min("max_depth").alias("max_depth"))
    return once.join(visited.select("job", "node"), ["job", "node"], "left_anti")


def walk(seeds: DataFrame, graph: LinkGraph, hot_rows: int = HOT_ROWS) -> DataFrame:
    """Discoveries of the seeds over a graph that has their URLs, level by level.

    Jobs and URLs are numbers on the way. Visited nodes are one bucketed table in the
    shared folder to which every level is added: that cuts the lineage, survives lost
    executors, tells the frontier's true size, and no level shuffles an earlier one.
    """
    spark = seeds.sparkSession
    # A job that names an origin twice goes as deep as the deeper request.
    jobs = seeds.filter("max_depth >= 0").groupBy("job_id", "origin_url").agg(F.max("max_depth").alias("max_depth"))
    jobs = match_join(jobs, graph.nodes.withColumnRenamed("url", "origin_url"), ["origin_url"], ["job_id"])
    jobs = stage(jobs.withColumn("job", F.monotonically_increasing_id()), "jobs")
    name, where = f"visited_{uuid.uuid4().hex}", shared_folder(spark, "visited")
    depth = 0
    fresh = jobs.select("job", "node", "max_depth")
    while True:
        visited = _append_bucketed(fresh.withColumn("depth", F.lit(depth)), name, where, ["job", "node"])
        # Files of a level hold one depth, by which the others are skipped.
        frontier = visited.filter((F.col("depth") == depth) & (F.col("max_depth") > depth))
        if frontier.isEmpty():
            break
        fresh = not_visited(_next(frontier, graph, hot_rows), visited)
        depth += 1
    found = spark.read.schema(visited.schema).parquet(where)
    found = match_join(found.select("job", "node", "depth"), jobs.select("job", "job_id", "origin_url"), ["job"], ["node"])
    found = match_join(found, graph.nodes, ["node"], ["job"])
    return found.select("job_id", "origin_url", "url", "depth")


def crawl(seeds: DataFrame, pages: DataFrame) -> DataFrame:
    """Discoveries (job_id, origin_url, url, depth) of all seeds.

    `seeds` has (job_id, origin_url, max_depth), `pages` at least (url, links,
    error, status_code) with one row per URL. Every level joins the frontier of
    all jobs with the links once, whatever the number of jobs; depth is the hop
    count at which a job first meets a URL. Only successful pages lead further.
    """
    links = pages.filter(is_success()).select(F.col("url").alias("src"), F.explode("links").alias("dst"))
    return crawl_edges(seeds, links)


def crawl_edges(seeds: DataFrame, edges: DataFrame) -> DataFrame:
    """As `crawl`, over a link table (src, dst) in which every source is a good page."""
    graph = link_graph(edges.select("src", "dst"), seeds.select(F.col("origin_url").alias("url")))
    return walk(seeds, graph)


def dead_links(discoveries: DataFrame, pages: DataFrame) -> DataFrame:
    """Discovered URLs without a successful page: never answered, or failed."""
    good = pages.filter(is_success()).select("url")
    dead = stage(discoveries.select("url").distinct().join(good, "url", "left_anti"), "dead")
    return match_join(discoveries, dead, ["url"], ["job_id"])


def fetch_list(discoveries: DataFrame, pages: DataFrame) -> DataFrame:
    """URLs to fetch: discovered by any job, each once, without a page so far."""
    return discoveries.select("url").distinct().join(pages.select("url"), "url", "left_anti")


def fetch_states(pages: DataFrame) -> DataFrame:
    return pages.select("url", fetch_state(F.col("error")).alias("state"))


def frontier_actions(frontier: DataFrame, pages: DataFrame) -> DataFrame:
    """What to do with each frontier row (job_id, url, depth).

    `ready` or `failed` if the page is there. Otherwise the lowest (depth, job_id)
    of a URL claims the `fetch` and all others `wait`. The claim is an aggregate,
    so a URL that a large share of the jobs wants needs no task of its own.
    """
    state = F.when(fetch_state(F.col("error")) == "failed", "failed").otherwise("ready")
    claims = frontier.groupBy("url").agg(
        F.min(F.struct("depth", "job_id")).alias("_claim")
    )
    known = claims.join(pages.select("url", state.alias("_state")), "url", "left")
    joined = match_join(frontier, stage(known, "claims"), ["url"], ["job_id"])
    mine = F.struct("depth", "job_id") == F.col("_claim")
    action = F.coalesce("_state", F.when(mine, "fetch").otherwise("wait"))
    return joined.select("job_id", "url", "depth", action.alias("action"))


def deliver(frontier: DataFrame, finished: DataFrame) -> DataFrame:
    """Hand each finished page to every (job, depth) that asked for its URL."""
    return match_join(frontier, finished, ["url"], ["job_id"])

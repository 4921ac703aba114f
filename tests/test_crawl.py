"""The crawl over numbered links: against a plain walk, and the plan of a level."""

import random
from collections import Counter

import pytest
from pyspark.sql import functions as F

from hopdex.operators import crawl as walks
from hopdex.operators import joins


def graph_rows():
    rng = random.Random(4)
    name = lambda i: f"http://s.test/{i}"
    edges = [(name(rng.randrange(30)), name(rng.randrange(40))) for _ in range(90)]
    edges += [(name(0), name(i)) for i in range(40)] + [(name(i), name(3)) for i in range(30)] + [(name(1), name(2))] * 5
    seeds = [(f"j{i}", name(rng.randrange(35)), rng.randrange(4)) for i in range(12)]
    seeds += [("j0", seeds[0][1], 5), ("twice", name(1), 0), ("twice", name(1), 2), ("twice", name(2), 1)]
    return edges, seeds + [("alone", "http://other.test/", 3), ("never", name(5), -1)]


def brute(edges, seeds):
    deepest = {}
    for job, origin, depth in seeds:
        if depth >= 0:
            deepest[job, origin] = max(depth, deepest.get((job, origin), 0))
    out = []
    for (job, origin), most in deepest.items():
        seen = {origin: 0}
        level = [origin]
        for depth in range(1, most + 1):
            level = sorted({d for s, d in edges if s in level} - set(seen))
            seen |= dict.fromkeys(level, depth)
        out += [(job, origin, url, depth) for url, depth in seen.items()]
    return Counter(out)


@pytest.mark.parametrize("small, hot_rows", [(True, 500_000), (False, 500_000), (False, 3)])
def test_equals_a_plain_walk(spark, monkeypatch, small, hot_rows):
    """With a broadcast frontier, with bucketed links, and with hot sources and nodes cut."""
    if not small:
        monkeypatch.setattr(walks, "is_small", lambda df, rows=0: False)
        monkeypatch.setattr(joins, "is_small", lambda df, rows=0: False)
    edges, seeds = graph_rows()
    links = spark.createDataFrame(edges, "src string, dst string").repartition(3)
    starts = spark.createDataFrame(seeds, "job_id string, origin_url string, max_depth int")
    graph = walks.link_graph(links, starts.select(F.col("origin_url").alias("url")), hot_rows)
    found = walks.walk(starts, graph, hot_rows)
    assert found.columns == ["job_id", "origin_url", "url", "depth"]
    assert Counter(tuple(r) for r in found.collect()) == brute(edges, seeds)


def test_a_level_shuffles_its_frontier_only(spark, tmp_path):
    """The visited table has three levels; the plan of the next one exchanges none of them."""
    rows = spark.range(1000).select((F.col("id") % 7).alias("job"), F.col("id").alias("node"), F.lit(5).alias("max_depth"))
    reached = walks.stage(rows.withColumn("node", F.col("node") + 500), "reached")
    with_sort = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        for depth in range(3):
            part = rows.filter(F.col("node") % 3 == depth).withColumn("depth", F.lit(depth))
            visited = walks._append_bucketed(part, "visited_in_a_test", str(tmp_path / "visited"), ["job", "node"])
        fresh = walks.not_visited(reached, visited)
        plan = fresh._jdf.queryExecution().executedPlan().toString()
        assert plan.count("Exchange hashpartitioning") == 1 and "Bucketed: true" in plan
        assert fresh.count() == 1000  # the moved nodes belong to other jobs or are new
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", with_sort)
        spark.sql("DROP TABLE IF EXISTS visited_in_a_test")

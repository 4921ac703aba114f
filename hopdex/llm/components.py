"""Connected components of a graph of links, by label passing between stars."""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from hopdex.session import stage


def components(links: DataFrame, one: str = "a", two: str = "b") -> DataFrame:
    """(node, root): the smallest node of the component of every node that has a link.

    Alternates two steps until nothing changes. Large star: every neighbour larger
    than a node is linked to the smallest neighbour. Small star: all smaller
    neighbours of a node, and itself, are linked to the smallest. Both keep the
    components and end in stars. Each step is aggregates and joins over link rows,
    and is written to the shared folder. Null ends are ignored.
    """
    links = links.select(F.least(one, two).alias("low"), F.greatest(one, two).alias("high"))
    links = stage(links.filter("low < high").distinct(), "links")
    while True:
        both = links.union(links.select(F.col("high").alias("low"), F.col("low").alias("high")))
        nearest = both.groupBy("low").agg(F.min(F.least("low", "high")).alias("root"))
        large = (
            both.filter("high > low").join(nearest, "low")
            .select(F.col("root").alias("low"), "high").filter("low < high").distinct()
        )
        smallest = large.groupBy("high").agg(F.min("low").alias("root"))
        small = large.join(smallest, "high")
        small = small.select(F.col("root").alias("low"), F.col("low").alias("high")).filter("low < high")
        after = stage(
            small.union(smallest.select(F.col("root").alias("low"), "high")).distinct(), "links")
        same = after.count() == links.count() and after.join(links, ["low", "high"], "left_anti").isEmpty()
        links = after
        if same:
            return links.select(F.col("high").alias("node"), F.col("low").alias("root")).union(
                links.select(F.col("low").alias("node"), F.col("low").alias("root")).distinct())

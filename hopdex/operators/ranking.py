"""Row numbers over groups of any size."""

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from hopdex.operators.joins import is_small
from hopdex.session import stage


def rank_within(df: DataFrame, group: list[str], order: list[Column], name: str) -> DataFrame:
    """Add the 1-based position of every row in its group.

    A window over the group would put a whole group into one task. Here the rows
    are range-partitioned and sorted by (group, order) and get their place in that
    sequence; a group's first place in each partition and its row count in earlier
    partitions turn the place into a rank. The sequence is written once, because
    both steps must see the same places even when an executor is lost in between.
    """
    keys = [F.col(c) for c in group] + order
    # Ranging samples its input, which is therefore written first.
    placed = stage(df, "unranked").repartitionByRange(*keys).sortWithinPartitions(*keys).withColumn(
        "_place", F.monotonically_increasing_id()
    )
    placed = stage(placed, "ranked").withColumn("_part", F.shiftright("_place", 33))

    # At most (groups + partitions) rows, as neighbouring ranges share one group.
    runs = placed.groupBy(*group, "_part").agg(
        F.count("*").alias("_size"), F.min("_place").alias("_first")
    )
    earlier = Window.partitionBy(*group).orderBy("_part").rowsBetween(
        Window.unboundedPreceding, -1
    )
    before = F.coalesce(F.sum("_size").over(earlier), F.lit(0))
    runs = stage(runs.select(*group, "_part", "_first", before.alias("_before")), "runs")
    if is_small(runs):
        runs = F.broadcast(runs)
    # Partition numbers are never NULL; group values can be (a NULL query id).
    left, right = placed.alias("p"), runs.alias("r")
    match = F.col("p._part") == F.col("r._part")
    for column in group:
        match = match & F.col(f"p.{column}").eqNullSafe(F.col(f"r.{column}"))
    rank = (F.col("_place") - F.col("_first") + 1 + F.col("_before")).cast("bigint")
    return left.join(right, match).select(*[F.col(f"p.{c}") for c in df.columns], rank.alias(name))

"""Joins and row selections that hold up when one key owns a large share of rows."""

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from hopdex.session import stage

# A side with at most this many narrow rows is broadcast.
BROADCAST_ROWS = 200_000
# A key with more rows than this is split into pieces of about this size.
HOT_ROWS = 500_000


def is_small(df: DataFrame, rows: int = BROADCAST_ROWS) -> bool:
    """Whether `df` has at most `rows` rows.

    Asks for the row after those. Spark answers that by taking partitions step by
    step, so a large table is not scanned for it.
    """
    return not df.select(F.lit(1).alias("_one")).offset(rows).limit(1).collect()


# A side with rows of any width is broadcast up to this many bytes.
BROADCAST_BYTES = 32 << 20


def is_light(df: DataFrame, most: int = BROADCAST_BYTES) -> bool:
    """Whether the rows of `df`, a written table, take at most `most` bytes.

    Text and nested columns count by their JSON or text length, others as eight bytes.
    """
    size = F.lit(16)
    for column in df.schema.fields:
        kind = column.dataType.typeName()
        if kind in ("string", "binary"):
            size = size + F.coalesce(F.octet_length(column.name), F.lit(0))
        elif kind in ("array", "map", "struct"):
            size = size + F.coalesce(F.octet_length(F.to_json(F.struct(column.name))), F.lit(0))
        else:
            size = size + 8
    total = df.agg(F.sum(size.cast("bigint"))).first()[0]
    return (total or 0) <= most


def _hot_keys(df: DataFrame, on: list[str], hot_rows: int, name: str) -> DataFrame | None:
    """Keys with more than `hot_rows` rows and the number of pieces to cut them in.

    Reads only the key columns; has at most (rows / hot_rows) rows.
    """
    hot = (
        df.groupBy(*on)
        .agg(F.count("*").alias("_n"))
        .filter(F.col("_n") > hot_rows)
        .select(*on, F.ceil(F.col("_n") / hot_rows).cast("int").alias(name))
    )
    hot = stage(hot, "hot")  # counted once, used on both sides
    if hot.isEmpty():
        return None
    return F.broadcast(hot) if is_small(hot) else hot


def _cut(df: DataFrame, hot: DataFrame, on: list[str], name: str, by: list[str]) -> DataFrame:
    """Give every row one piece number of its key."""
    pieces = F.coalesce(name, F.lit(1))
    cut = df.join(hot, on, "left").withColumn("_at", F.pmod(F.xxhash64(*by), pieces).cast("int"))
    return cut.drop(name).withColumnRenamed("_at", name)


def _repeat(df: DataFrame, hot: DataFrame, on: list[str], name: str) -> DataFrame:
    """Repeat every row once for each piece of its key."""
    last = F.coalesce(name, F.lit(1)) - 1
    repeated = df.join(hot, on, "left").withColumn("_at", F.explode(F.sequence(F.lit(0), last)))
    return repeated.drop(name).withColumnRenamed("_at", name)


def match_join(
    left: DataFrame,
    right: DataFrame,
    on: list[str],
    left_spread: list[str] | None = None,
    right_spread: list[str] | None = None,
    how: str = "inner",
    broadcast: str | None = "right",
    left_counts: DataFrame | None = None,
    hot_rows: int = HOT_ROWS,
    small_rows: int = BROADCAST_ROWS,
) -> DataFrame:
    """Equi-join of tables of any size and any skew.

    The side named by `broadcast` is broadcast if a check finds it small.
    Otherwise both sides are shuffled, and a key with more than `hot_rows` rows on
    a side is cut into pieces there by a hash of that side's spread columns, while
    the matching rows of the other side are repeated once per piece. A side
    without spread columns has few rows per key. `left_counts` may name a cheaper
    table with the same keys to count. `how` is "inner", or "left" for a join that
    only cuts the left side.
    """
    if how != "inner" and (right_spread or broadcast == "left"):
        raise ValueError("only an inner join can cut or broadcast both sides")
    if broadcast == "right" and is_small(right, small_rows) and _narrow(right):
        return left.join(F.broadcast(right), on, how)
    if broadcast == "left" and is_small(left, small_rows) and _narrow(left):
        return F.broadcast(left).join(right, on, how)
    keys = list(on)
    if left_spread:
        hot = _hot_keys(left if left_counts is None else left_counts, on, hot_rows, "_left_piece")
        if hot is not None:
            left = _cut(left, hot, on, "_left_piece", left_spread)
            right = _repeat(right, hot, on, "_left_piece")
            keys.append("_left_piece")
    if right_spread:
        hot = _hot_keys(right, on, hot_rows, "_right_piece")
        if hot is not None:
            right = _cut(right, hot, on, "_right_piece", right_spread)
            left = _repeat(left, hot, on, "_right_piece")
            keys.append("_right_piece")
    return left.join(right, keys, how).drop("_left_piece", "_right_piece")


def _narrow(df: DataFrame) -> bool:
    """Whether a side with few rows may be broadcast: no wide column, or few bytes by count."""
    kinds = {f.dataType.typeName() for f in df.schema.fields}
    return not kinds & {"string", "binary", "array", "map", "struct"} or is_light(df)


def only_keys(df: DataFrame, wanted: DataFrame, on: list[str]) -> DataFrame:
    """Rows of `df` whose key occurs in `wanted`; a short `wanted` is broadcast."""
    keys = wanted.select(*on)
    short = is_small(keys)
    keys = keys.distinct()
    return df.join(F.broadcast(keys) if short else keys, on, "left_semi")


def drop_known(df: DataFrame, known: DataFrame, on: list[str]) -> DataFrame:
    """Rows of `df` whose key does not occur in `known`.

    If either side is short the other one is not shuffled: a short `df` first picks
    its own keys out of `known`, which are then no more than its rows.
    """
    keys = known.select(*on)
    if is_small(keys):
        keys = F.broadcast(keys)
    elif is_small(df.select(*on)):
        wanted = F.broadcast(df.select(*on).distinct())
        keys = F.broadcast(keys.join(wanted, on, "left_semi").distinct())
    return df.join(keys, on, "left_anti")


def newest(df: DataFrame, key: list[str], by: list) -> DataFrame:
    """The last row of every key in the order of `by`.

    A rank filter of this form also runs before the shuffle, so a task passes on
    at most one row per key however many copies it holds.
    """
    window = Window.partitionBy(*key).orderBy(*[F.desc(c) for c in by])
    return df.withColumn("_rank", F.row_number().over(window)).filter("_rank = 1").drop("_rank")


def newest_wide(df: DataFrame, key: str, by: str) -> DataFrame:
    """As `newest` for one key column and rows too wide to shuffle.

    Only (key, by) is aggregated; the wide rows meet just the list of repeated
    keys. `by` must differ between the rows of a key.
    """
    repeated = (
        df.groupBy(key)
        .agg(F.max(by).alias("_last"), F.count("*").alias("_copies"))
        .filter("_copies > 1")
        .select(key, "_last")
    )
    joined = match_join(df, stage(repeated, "repeated"), [key], [by], how="left")
    return joined.filter(F.coalesce(F.col("_last") == F.col(by), F.lit(True))).drop("_last")

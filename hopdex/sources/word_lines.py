"""Word entries as text lines, `word url origin_url depth frequency`."""

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from hopdex.functions.text import let, letter_of, plain_spaces
from hopdex.operators.index import dedup_entries
from hopdex.schemas import WORD_ENTRIES
from hopdex.session import stage

_INT = r"^[+-]?[0-9]+$"


def to_lines(entries: DataFrame) -> DataFrame:
    """(letter, line) rows."""
    columns = [F.col(c).cast("string") for c in WORD_ENTRIES.names]
    return entries.select(letter_of(F.col("word")).alias("letter"), F.concat_ws(" ", *columns).alias("line"))


def parse_lines(lines: DataFrame) -> DataFrame:
    """Word entries from rows with a `line` column; unusable lines are skipped.

    Further columns of `lines` are kept. A line is taken apart once; the generator
    keeps the optimizer from repeating that for the filter.
    """
    def number(text: Column) -> Column:
        return F.when(F.rlike(text, F.lit(_INT)), text.try_cast("int"))

    def entry(parts: Column) -> Column:
        fields = F.struct(
            F.get(parts, F.lit(0)).alias("word"),
            F.get(parts, F.lit(1)).alias("url"),
            F.get(parts, F.lit(2)).alias("origin_url"),
            number(F.get(parts, F.lit(3))).alias("depth"),
            number(F.get(parts, F.lit(4))).alias("frequency"),
        )
        comment = F.startswith(F.get(parts, F.lit(0)), F.lit("#"))
        return F.when((F.size(parts) == 5) & ~comment, F.array(fields))

    parts = F.regexp_extract_all(plain_spaces(F.col("line")), F.lit("[^ ]+"), F.lit(0))
    usable = F.filter(
        let(parts, entry), lambda e: e["depth"].isNotNull() & e["frequency"].isNotNull()
    )
    extra = [c for c in lines.columns if c != "line"]
    return lines.select(*extra, F.inline(usable)).select(*WORD_ENTRIES.names, *extra)


def write_lines(entries: DataFrame, path: str) -> None:
    """Sorted text files below one `letter=` folder per first character.

    Rows are range-partitioned by the whole sort key, so a frequent letter or
    word is spread over several files instead of one writer.
    """
    # Ranging samples its input, which is therefore written first.
    keyed = stage(entries, "entries").repartitionByRange("word", "url", "origin_url", "depth")
    keyed = keyed.sortWithinPartitions("word", "url", "origin_url", "depth")
    to_lines(keyed).write.mode("overwrite").partitionBy("letter").text(path)


def read_lines(spark: SparkSession, path: str) -> DataFrame:
    """All entries below `path`, one row per key. The last line of a key wins."""
    lines = spark.read.option("recursiveFileLookup", "true").text(path).select(
        F.col("value").alias("line"),
        F.struct(F.col("_metadata.file_path"), F.col("_metadata.file_block_start"),
                 F.monotonically_increasing_id()).alias("_position"),
    )
    return dedup_entries(parse_lines(lines))

"""Readers for tables that other systems write."""

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from hopdex.operators.joins import match_join
from hopdex.schemas import PAGES, RESPONSES


def spread_if_few(df: DataFrame) -> DataFrame:
    """Use all cores when a small input comes in fewer splits than there are.

    A large input has more splits than cores and is left as it is. Meant for plain
    scans: asking a plan with joins for its splits would run parts of it.
    """
    cores = df.sparkSession.sparkContext.defaultParallelism
    return df.repartition(cores) if df.rdd.getNumPartitions() < cores else df


def read_responses(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(RESPONSES).parquet(path)


def read_body_files(spark: SparkSession, path: str, site: str, media: str) -> DataFrame:
    """Response rows from a folder of saved bodies; the file name gives the URL."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(path)
    name = F.regexp_extract("path", r"([^/]*)$", 1)
    return files.select(
        F.concat(F.lit(site.rstrip("/") + "/"), name).alias("url"),
        F.lit(200).alias("status"),
        F.create_map(F.lit("Content-Type"), F.lit(media)).alias("headers"),
        F.col("content").alias("body"),
        F.lit(None).cast("string").alias("error"),
    )


def stream_of_table(spark: SparkSession, folder: str, name: str, schema) -> DataFrame:
    """The files of a given table as a stream, be the table one file or a folder of them."""
    path = f"{folder}/{name}.parquet"
    reader = spark.readStream.schema(schema)
    files = spark.read.schema(schema).parquet(path).inputFiles()
    if len(files) == 1 and files[0].endswith(f"/{name}.parquet"):
        return reader.option("pathGlobFilter", f"{name}.parquet").parquet(folder)
    return reader.parquet(path)


def pages_with_json_links(pages: DataFrame) -> DataFrame:
    """Page rows for stores that keep the link list as JSON text."""
    return pages.withColumn("links_json", F.to_json("links")).drop("links")


def pages_from_json_links(rows: DataFrame, keep_json: bool = False) -> DataFrame:
    """The reverse of `pages_with_json_links`, in page column order."""
    links = F.from_json("links_json", "array<string>")
    kept = ["links_json"] if keep_json else []
    return rows.withColumn("links", links).select(*PAGES.names, *kept)


def with_origin(discoveries: DataFrame, jobs: DataFrame) -> DataFrame:
    """Discoveries of known jobs with the job's origin. Orphans drop out.

    One job may own a large share of the discoveries.
    """
    origins = jobs.select("job_id", "origin_url")
    return match_join(discoveries, origins, ["job_id"], ["url"])

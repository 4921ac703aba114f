"""Session settings and the shared folder for work that must survive executors."""

import shutil
import tempfile
import uuid
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession

# Only settings that hold at any size. Memory, cores and partition counts
# belong to the deployment.
SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    # A page can be a megabyte: bound what one Python worker holds at a time.
    "spark.sql.execution.arrow.maxRecordsPerBatch": "500",
}


def build_session(master: str, name: str, extra: dict[str, str] | None = None) -> SparkSession:
    builder = SparkSession.builder.master(master).appName(name)
    builder = builder.config("spark.ui.enabled", "false")
    builder = builder.config("spark.ui.showConsoleProgress", "false")
    for key, value in {**SETTINGS, **(extra or {})}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def bound_batches(spark: SparkSession) -> None:
    """Set the Arrow batch bound in a session that was built elsewhere."""
    key = "spark.sql.execution.arrow.maxRecordsPerBatch"
    spark.conf.set(key, SETTINGS[key])


_shipped: set[str] = set()


def ship_package(spark: SparkSession) -> None:
    """Let Python workers import this package, from whatever folder the program is run."""
    context = spark.sparkContext
    if context.applicationId in _shipped:
        return
    root = Path(__file__).resolve().parents[1]
    archive = shutil.make_archive(
        str(Path(tempfile.mkdtemp()) / "hopdex"), "zip", root_dir=root, base_dir="hopdex"
    )
    context.addPyFile(archive)  # Spark hands the archive to every executor
    _shipped.add(context.applicationId)


def shared_folder(spark: SparkSession, purpose: str) -> str:
    """A new folder below the checkpoint directory that the cluster names.

    A local run without one gets a temporary directory, which is then also the
    session's checkpoint directory. A cluster has to name a shared one.
    """
    context = spark.sparkContext
    root = spark.conf.get("spark.checkpoint.dir", None) or context.getCheckpointDir()
    if not root:
        if not context.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder all executors share")
        root = tempfile.mkdtemp(prefix="hopdex-")
        context.setCheckpointDir(root)
    return f"{root.rstrip('/')}/{purpose}-{uuid.uuid4().hex}"


def stage(df: DataFrame, purpose: str) -> DataFrame:
    """Write `df` to the shared folder and read it back.

    Cuts the lineage with files that outlive any executor, gives the optimizer
    true sizes, and lets several consumers share one computation.
    """
    where = shared_folder(df.sparkSession, purpose)
    df.write.parquet(where)
    return df.sparkSession.read.schema(df.schema).parquet(where)

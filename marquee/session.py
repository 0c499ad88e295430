"""Session settings and the shared checkpoint folder."""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def local_session(app: str = "marquee", cores: int | str = "*", partitions: int = 8) -> SparkSession:
    """A local session for tests and bench; a cluster brings its own."""
    return (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.sql.shuffle.partitions", str(partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.driver.memory", "16g")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .getOrCreate()
    )


def shared_dir(spark: SparkSession) -> str:
    """Folder all executors see: `spark.checkpoint.dir`, or a temporary one in local mode only."""
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if configured:
        return configured
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder that all executors can reach")
    local = getattr(spark, "_marquee_shared_dir", None)
    if local is None:
        local = tempfile.mkdtemp(prefix="marquee-")
        spark._marquee_shared_dir = local
    return local


def scratch_path(spark: SparkSession, label: str) -> str:
    """A fresh path below the shared folder."""
    return f"{shared_dir(spark).rstrip('/')}/{label}-{uuid.uuid4().hex}"


def ensure_checkpoint_dir(spark: SparkSession) -> None:
    """Iterative training cuts its lineage in the shared folder."""
    if spark.sparkContext.getCheckpointDir() is None:
        spark.sparkContext.setCheckpointDir(shared_dir(spark))


_ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))


def ship(spark: SparkSession) -> None:
    """Python workers on machines that hold the repository find it without an installed package."""
    have = spark.sparkContext.environment.get("PYTHONPATH", "")
    if _ROOT not in have.split(os.pathsep):
        spark.sparkContext.environment["PYTHONPATH"] = os.pathsep.join(x for x in (_ROOT, have) if x)


_CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def materialise(df: DataFrame) -> DataFrame:
    """Write once to the shared folder and read back: the lineage ends there and survives the loss of executors.

    The shuffle files of the write go as soon as the table is there, instead of staying until the driver collects garbage."""
    spark = df.sparkSession
    path = scratch_path(spark, "table")
    before = spark.conf.get(_CLEANUP, "false")
    spark.conf.set(_CLEANUP, "true")
    try:
        df.write.parquet(path)
    finally:
        spark.conf.set(_CLEANUP, before)
    out = spark.read.schema(df.schema).parquet(path)
    out._scratch = path
    return out


def discard(df: DataFrame) -> None:
    """Remove a table that `materialise` wrote, once nothing that is still to be computed reads it."""
    remove(df.sparkSession, df._scratch)


def remove(spark: SparkSession, path: str) -> None:
    """Remove a scratch folder."""
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    target.getFileSystem(spark._jsc.hadoopConfiguration()).delete(target, True)

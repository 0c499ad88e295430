"""Writers: CSV exports, JSON results, rejects and the all-or-nothing publication of a set of tables."""

from __future__ import annotations

import uuid
import warnings
from collections.abc import Mapping

from py4j.protocol import Py4JJavaError
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from marquee.operators.quality import Expectations, enforce
from marquee.schemas import CATALOGUE_COLUMNS
from marquee.sources.catalogue import read_or_empty

RAW_ZONE = "data/raw"


def export_to_csv(df: DataFrame, name: str, folder: str = "data/processed") -> str:
    """A folder of CSV parts with header."""
    path = f"{folder.rstrip('/')}/{name}"
    if folder.rstrip("/").endswith(RAW_ZONE):
        warnings.warn("raw zone as export folder: what is read as source is about to be replaced", UserWarning, stacklevel=2)
    _csv(df, path)
    return path


def _csv(df: DataFrame, path: str) -> None:
    writer = df.write.mode("overwrite").option("header", True).option("quote", '"').option("escape", '"')
    writer.option("ignoreLeadingWhiteSpace", False).option("ignoreTrailingWhiteSpace", False).csv(path)


def write_catalogue(catalogue: DataFrame, path: str) -> None:
    """The consolidated catalogue with its fixed columns in order."""
    rows = catalogue.select(*[F.col(f"`{c}`").cast("string").alias(c) for c in CATALOGUE_COLUMNS])
    _csv(rows, path)


def write_json(df: DataFrame, path: str) -> str:
    """JSON lines in a folder of their own, which then becomes the current one. Readers that follow `read_json` see the old
    or the new content whole, and one that began before goes on reading the old."""
    path = path.rstrip("/")
    run = f"run-{uuid.uuid4().hex}"
    df.write.json(f"{path}/{run}")
    commit(df.sparkSession, path, run)
    return run


def read_json(spark: SparkSession, path: str, schema: T.StructType | str) -> DataFrame | None:
    """The content written last, or None when nothing was."""
    run = current_run(spark, path)
    return None if run is None else spark.read.schema(schema).option("mode", "FAILFAST").json(f"{path.rstrip('/')}/{run}")


def append_rejects(rejects: DataFrame, path: str) -> None:
    rejects.select(F.col("id").cast("string").alias("id"), "reason").write.mode("append").json(path)


def read_rejects(spark: SparkSession, path: str) -> DataFrame:
    """Failed keys, each once."""
    return read_or_empty(spark, path, "id STRING, reason STRING").select("id").distinct()


def publish(tables: Mapping[str, DataFrame], root: str, expected: Mapping[str, Expectations] | None = None) -> str:
    """Write all tables into a new run folder, check them there, and then name the run in the next version file.

    Readers follow the versions, so they see all tables of a load or none. Checks read the written tables, so the
    load itself is computed once. Publishers do not wait for each other: each version has one writer, see `commit`.
    """
    spark = next(iter(tables.values())).sparkSession
    root = root.rstrip("/")
    run = f"run-{uuid.uuid4().hex}"
    for name, df in tables.items():
        df.write.parquet(f"{root}/{run}/{name}")
    if expected:
        written = {name: spark.read.schema(df.schema).parquet(f"{root}/{run}/{name}") for name, df in tables.items()}
        enforce(written, {n: e for n, e in expected.items() if n in written})
    commit(spark, root, run)
    return run


def _versions(spark: SparkSession, root: str):
    """(file system, folder of the version files)."""
    path = spark._jvm.org.apache.hadoop.fs.Path(f"{root.rstrip('/')}/_versions")
    return path.getFileSystem(spark._jsc.hadoopConfiguration()), path


def _listed(fs, folder) -> list[int]:
    """Numbers of the versions that are there; a version file is named by its number and its run."""
    if not fs.exists(folder):
        return []
    names = [s.getPath().getName() for s in fs.listStatus(folder)]
    return sorted(int(n) for n in names if n.isdigit())


def commit(spark: SparkSession, root: str, run: str) -> int:
    """Make `run` the current one under the next free version number.

    A version is a folder that is there or not: its name is claimed by moving a folder made before, which holds the run's
    name, onto it. The move fails if another publisher has the number, who then took it whole, and the next one is tried.
    No version is lost or overwritten, and what a reader finds is complete. The local file system may copy a folder below one
    that came in between instead of failing: readers do not look there, and the next number is tried with a new claim."""
    fs, folder = _versions(spark, root)
    jpath = spark._jvm.org.apache.hadoop.fs.Path
    context = spark._jvm.org.apache.hadoop.fs.FileContext.getFileContext(folder.toUri(), spark._jsc.hadoopConfiguration())
    option = spark._jvm.org.apache.hadoop.fs.Options.Rename
    plain = spark.sparkContext._gateway.new_array(option, 0)

    def claimed():
        claim = jpath(folder, f"_claim-{uuid.uuid4().hex}")
        fs.mkdirs(claim)
        fs.create(jpath(claim, run), False).close()
        return claim

    claim = claimed()
    version = (_listed(fs, folder) or [0])[-1]
    while True:
        version += 1
        target = jpath(folder, f"{version:020d}")
        try:
            context.rename(claim, target, plain)
        except Py4JJavaError:
            if not fs.exists(target):
                raise
            continue
        if fs.exists(jpath(target, claim.getName())):
            claim = claimed()
            continue
        if not fs.exists(jpath(target, run)):
            raise RuntimeError(f"version {version} of {root} was taken while it was claimed")
        return version


def current_run(spark: SparkSession, root: str) -> str | None:
    """The run that was committed last, or None."""
    fs, folder = _versions(spark, root)
    versions = _listed(fs, folder)
    if not versions:
        return None
    held = fs.listStatus(spark._jvm.org.apache.hadoop.fs.Path(folder, f"{versions[-1]:020d}"))
    return next(s.getPath().getName() for s in held if not s.getPath().getName().startswith((".", "_")))


def read_published(spark: SparkSession, root: str, names) -> dict[str, DataFrame] | None:
    """Tables of the latest published run, or None when nothing was published."""
    run = current_run(spark, root)
    return None if run is None else {n: spark.read.parquet(f"{root.rstrip('/')}/{run}/{n}") for n in names}

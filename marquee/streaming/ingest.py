"""Resumable ingest of fetched score lists, and the retry of failed keys."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from marquee.operators.dedupe import last_wins, not_yet_loaded
from marquee.session import materialise
from marquee.sources.catalogue import read_or_empty

# Classes of failure kept apart in the rejects.
REASONS = ["connection", "timeout", "data"]
OTHER = "other"
#: Folders that results are dealt into by key.
BUCKETS = 64

RESULT_DDL = "id STRING, scores ARRAY<DOUBLE>, attempt INT"
OUTCOME_DDL = "id STRING, scores ARRAY<DOUBLE>, error STRING, attempt INT"


def pending(keys: DataFrame, done: DataFrame) -> DataFrame:
    """Keys without a result yet. Keys that failed before are among them."""
    return keys.filter(F.col("id").isNotNull()).join(done.select("id"), "id", "left_anti")


def error_class(error):
    kind = F.lower(error)
    return F.when(kind.isin(REASONS), kind).otherwise(F.lit(OTHER))


def named_results(results: DataFrame, order: str = "completed") -> DataFrame:
    """Results keyed by name: blank names are left out, and the one completed last stays."""
    named = results.filter(F.col("name").isNotNull() & (F.col("name") != ""))
    return last_wins(named, ["name"], [order])


def split_outcomes(outcomes: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Results, and failures as (id, reason, attempt)."""
    good = outcomes.filter(F.col("error").isNull()).drop("error")
    bad = outcomes.filter(F.col("error").isNotNull())
    return good, bad.select("id", error_class(F.col("error")).alias("reason"), "attempt")


def in_bucket(keys: Sequence[str], buckets: int = BUCKETS) -> Column:
    return F.pmod(F.xxhash64(*keys), F.lit(buckets)).cast("int")


def read_results(spark: SparkSession, path: str, schema: T.StructType | str = RESULT_DDL) -> DataFrame:
    """Results taken in so far, none if there are none yet, with the bucket of their key as last column: a filter on it
    reads the folders of these buckets only."""
    fields = T.StructType.fromDDL(schema) if isinstance(schema, str) else schema
    return read_or_empty(spark, path, T.StructType([*fields.fields, T.StructField("bucket", T.IntegerType())]), "parquet")


def ingest_available(
    spark: SparkSession, outcomes: DataFrame, results: str, rejects: str, checkpoint: str, keys=("id",), order=("attempt",), buckets: int = BUCKETS
) -> None:
    """Take in all outcome files that arrived since the last run, and stop.

    `outcomes` is a streaming frame. A key that has a result keeps it. The checkpoint says which files are done;
    a batch that is repeated after a failure adds nothing twice, because its keys are then already there.

    Results lie in a folder for each bucket of keys. A batch looks for its keys in the buckets they fall into, and reads no
    other folder, so a small batch costs a small part of what was taken in before. `buckets` stays as it was at first.
    """
    result_schema = outcomes.drop("error").schema

    def take(batch: DataFrame, batch_id: int) -> None:
        batch = batch.persist()
        try:
            good, bad = split_outcomes(batch)
            good = good.withColumn("bucket", in_bucket(keys, buckets))
            touched = [r["bucket"] for r in good.select("bucket").distinct().collect()]  # a number for each bucket at most
            existing = read_results(spark, results, result_schema).filter(F.col("bucket").isin(touched))
            fresh = not_yet_loaded(good, existing, list(keys), list(order))
            fresh.repartition("bucket").write.mode("append").partitionBy("bucket").parquet(results)
            bad.write.mode("overwrite").json(f"{rejects.rstrip('/')}/batch={batch_id}")
        finally:
            batch.unpersist()

    query = outcomes.writeStream.foreachBatch(take).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
    query.awaitTermination()


def failed_keys(rejects: DataFrame) -> DataFrame:
    """The error list: each failed key once."""
    return rejects.select("id").distinct()


def retry_keys(errors: DataFrame, recovered: DataFrame) -> DataFrame:
    """Keys of the error list that were not recovered by an earlier retry."""
    return errors.select("id").distinct().join(recovered.select("id"), "id", "left_anti")


def latest_outcomes(outcomes: DataFrame) -> DataFrame:
    """Of several attempts the last one counts."""
    return last_wins(outcomes, ["id"], ["attempt"])


def retry_pass(errors: DataFrame, recovered: DataFrame, outcomes: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Newly recovered results, and the keys that still fail.

    Write the second only when it is not empty: the error list stays as it was when every retry succeeded.
    """
    tried = latest_outcomes(outcomes).join(retry_keys(errors, recovered), "id", "left_semi")
    good, bad = split_outcomes(tried)
    return good, bad


def rewrite_if_any(still_failing: DataFrame, path: str) -> bool:
    failing = materialise(still_failing)  # the keys may come from the very folder that is rewritten
    if failing.isEmpty():
        return False
    failing.select("id", "reason").write.mode("overwrite").json(path)
    return True

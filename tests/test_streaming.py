import json
import os

from pyspark.sql import functions as F

from marquee.sources.catalogue import read_or_empty
from marquee.streaming import ingest


def put(folder, name, rows):
    os.makedirs(f"{folder}/in", exist_ok=True)
    with open(f"{folder}/in/{name}.json", "w") as f:
        f.write("\n".join(json.dumps(r) for r in rows))


def run(spark, folder):
    stream = spark.readStream.schema(ingest.OUTCOME_DDL).json(f"{folder}/in")
    ingest.ingest_available(spark, stream, f"{folder}/results", f"{folder}/rejects", f"{folder}/checkpoint")
    return {r["id"]: r["scores"] for r in spark.read.parquet(f"{folder}/results").collect()}


def test_resume(spark, folder):
    put(folder, "1", [
        {"id": "a", "scores": [1.0], "attempt": 1},
        {"id": "a", "scores": [9.0], "attempt": 2},
        {"id": "b", "error": "Timeout", "attempt": 1},
        {"id": "c", "error": "strange", "attempt": 1},
    ])
    assert run(spark, folder) == {"a": [1.0]}
    assert run(spark, folder) == {"a": [1.0]}
    put(folder, "2", [{"id": "a", "scores": [5.0], "attempt": 3}, {"id": "b", "scores": [2.0], "attempt": 2}])
    assert run(spark, folder) == {"a": [1.0], "b": [2.0]}
    rejects = read_or_empty(spark, f"{folder}/rejects", "id STRING, reason STRING, attempt INT")
    assert sorted((r["id"], r["reason"]) for r in rejects.collect()) == [("b", "timeout"), ("c", "other")]
    keys = spark.createDataFrame([("a",), ("b",), ("c",), (None,)], "id STRING")
    assert [r["id"] for r in ingest.pending(keys, spark.read.parquet(f"{folder}/results")).collect()] == ["c"]


def test_a_batch_reads_its_buckets_only(spark, folder):
    """A file that cannot be read lies in a bucket that no key of the second batch falls into."""
    put(folder, "1", [{"id": f"k{i}", "scores": [1.0], "attempt": 1} for i in range(300)])
    run(spark, folder)
    bucket = lambda k: spark.createDataFrame([(k,)], "id STRING").select(ingest.in_bucket(["id"])).first()[0]
    mine = bucket("k5")
    other = next(b for b in os.listdir(f"{folder}/results") if b.startswith("bucket=") and b != f"bucket={mine}")
    with open(f"{folder}/results/{other}/part-broken.parquet", "wb") as f:
        f.write(b"PAR1 broken PAR1")
    put(folder, "2", [{"id": "k5", "scores": [7.0], "attempt": 2}])
    stream = spark.readStream.schema(ingest.OUTCOME_DDL).json(f"{folder}/in")
    ingest.ingest_available(spark, stream, f"{folder}/results", f"{folder}/rejects", f"{folder}/checkpoint")
    os.remove(f"{folder}/results/{other}/part-broken.parquet")
    results = ingest.read_results(spark, f"{folder}/results")
    assert results.count() == 300 and results.filter("id = 'k5'").first()["scores"] == [1.0]
    plan = results.filter(F.col("bucket").isin([mine]))._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(bucket" in plan


def test_retry(spark, folder):
    errors = spark.createDataFrame([("a",), ("b",), ("b",), ("c",)], "id STRING")
    recovered = spark.createDataFrame([("c",)], "id STRING")
    outcomes = spark.createDataFrame(
        [("a", None, "data", 1), ("a", [1.0], None, 2), ("b", [1.0], None, 1), ("b", None, "connection", 2), ("c", None, "data", 3)],
        ingest.OUTCOME_DDL,
    )
    good, bad = ingest.retry_pass(errors, recovered, outcomes)
    assert [r["id"] for r in good.collect()] == ["a"]
    assert [(r["id"], r["reason"]) for r in bad.collect()] == [("b", "connection")]
    path = f"{folder}/errors"
    assert ingest.rewrite_if_any(bad, path)
    assert not ingest.rewrite_if_any(bad.filter("false"), path)
    kept = spark.read.schema("id STRING, reason STRING").json(path)
    assert ingest.rewrite_if_any(kept, path)  # onto the folder it came from
    assert [r["id"] for r in spark.read.json(path).collect()] == ["b"]

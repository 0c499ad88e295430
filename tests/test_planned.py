import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from marquee.operators import planned
from marquee.plans import train
from marquee.streaming.ingest import named_results


def test_folds_look_forward():
    assert planned.forward_folds(2000, 2009, 2, 5) == [((2000, 2004), (2005, 2006)), ((2000, 2006), (2007, 2008))]
    assert planned.forward_folds(2000, 2004, 1, 9) == []


def test_shuffled_column_keeps_the_values(spark):
    df = spark.range(500).select(F.col("id").cast("string").alias("imdb_id"), (F.col("id") % 7).alias("v"), F.lit(1).alias("w"))
    out = planned.shuffled_column(df, "v", "imdb_id")
    before, after = [r["v"] for r in df.orderBy("imdb_id").collect()], [r["v"] for r in out.orderBy("imdb_id").collect()]
    assert out.columns == df.columns and sorted(before) == sorted(after) and before != after


def test_permutation_importance(spark):
    rng = np.random.default_rng(0)
    rows = [(f"m{i}", float(rng.normal(2 * (i % 2))), float(rng.normal()), i % 2) for i in range(400)]
    df = spark.createDataFrame(rows, "imdb_id STRING, signal DOUBLE, noise DOUBLE, label INT")
    fitted = train.fit(df, "logistic", ["signal", "noise"])
    table = planned.permutation_importance(fitted, df, ["noise", "signal"]).collect()
    assert table[0]["feature"] == "signal" and table[0]["loss"] > 0.2 and abs(table[1]["loss"]) < 0.1


def test_undersample_and_baseline(spark):
    df = spark.range(4000).select((F.col("id") % 10 == 0).cast("int").alias("label"))
    counts = {r["label"]: r["count"] for r in planned.undersample(df).groupBy("label").count().collect()}
    assert counts[1] == 400 and counts[0] == pytest.approx(400, rel=0.25)
    assert planned.random_scores(df).agg(F.avg("prob")).first()[0] == pytest.approx(0.5, abs=0.05)


def test_redundant_features(spark):
    rows = [(float(i), 2.0 * i, float((i * 7919) % 13)) for i in range(50)]
    df = spark.createDataFrame(rows, "a DOUBLE, b DOUBLE, c DOUBLE")
    assert planned.redundant_features(df, ["a", "b", "c"]) == ["b"]


def test_named_results(spark):
    df = spark.createDataFrame([("x", 1, 1), ("x", 2, 2), ("", 3, 3), (None, 4, 4)], "name STRING, v INT, completed INT")
    assert [(r["name"], r["v"]) for r in named_results(df).collect()] == [("x", 2)]


@pytest.mark.parametrize("frequent", [0, 2, 1000])
def test_tf_idf_moves_texts_once(spark, frequent):
    """Weights by hand, with a repeated key; counts are shuffled by term only for terms that are not frequent."""
    rows = [(1, "a b a C"), (1, "a"), (2, " b\tc "), (3, None), (4, "d"), (None, "a a")]
    counts = {}
    for key, text in rows:
        for word in (text or "").lower().split():
            counts.setdefault((key, word), 0)
            counts[key, word] += 1
    df = {w: len({k for k, x in counts if x == w}) for _, w in counts}
    out = planned.tf_idf(spark.createDataFrame(rows, "id INT, text STRING"), "id", "text", frequent)
    got = {(r.id, r.term): (r.tf, r.df, round(r.weight, 9)) for r in out.collect()}
    assert got == {(k, w): (n, df[w], round(n * math.log(7 / (df[w] + 1)), 9)) for (k, w), n in counts.items()}
    assert out.count() == len(counts)
    if frequent == 1000:
        plan = out._jdf.queryExecution().executedPlan().toString()
        assert "hashpartitioning(term" not in plan and "SortMergeJoin" not in plan

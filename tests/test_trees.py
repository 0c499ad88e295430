import numpy as np
import pytest
from pyspark.errors import PythonException
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.sql import functions as F

from marquee.operators import trees
from marquee.plans import train
from marquee.session import ensure_checkpoint_dir, materialise


def _rows(spark, n, seed=3):
    """Seven features: plain, whole, rounded, half of them zero, constant, two values, equal to another one in order."""
    rng = np.random.default_rng(seed)
    x = rng.normal(size=(n, 7))
    x[:, 1], x[:, 2], x[:, 3], x[:, 4] = rng.integers(0, 5, n), np.round(x[:, 2], 1), np.maximum(x[:, 3], 0), 2.5
    x[:, 5], x[:, 6] = x[:, 5] > 0, np.exp(x[:, 0])
    y = x[:, 0] + x[:, 1] / 3 + rng.normal(size=n) > 0.5
    rows = [(r, float(k), 1.5 if k else 1.0) for r, k in zip(x.tolist(), y.tolist())]
    df = spark.createDataFrame(rows, "x array<double>, label double, weight double")
    return materialise(df.select(array_to_vector("x").alias("features"), "label", "weight"))


def _probabilities(model, rows):
    return np.array([r.p for r in model.transform(rows).select(vector_to_array("probability")[1].alias("p")).collect()])


@pytest.mark.parametrize("n", [700, 14000])  # thresholds from all rows, and from a sample
def test_boosted_trees_are_those_of_spark(spark, n):
    rows = _rows(spark, n)
    ensure_checkpoint_dir(spark)
    estimator = train.boosted(rounds=6, depth=3, rate=0.3)
    want, got = estimator.fit(rows), train.grow(estimator, rows)
    assert isinstance(got, trees.BoostedTrees) and len(got.trees) == 6
    shares = lambda model: np.delete(x := model.featureImportances.toArray(), (0, 6)).tolist() + [x[0] + x[6]]  # noqa: E731  these two split alike
    assert np.allclose(shares(got), shares(want), atol=1e-9)
    assert np.allclose(_probabilities(got, rows), _probabilities(want, rows), atol=1e-9)
    scored = got.transform(rows).agg(F.sum(F.abs(F.col("prediction") - (vector_to_array("probability")[1] > 0.5).cast("double"))).alias("d"))
    assert scored.first().d == 0


def test_boosted_trees_in_many_blocks(spark, monkeypatch):
    """Blocks, parts and the rounds after which margins are written do not show in the trees."""
    rows = _rows(spark, 900)
    ensure_checkpoint_dir(spark)
    whole = trees.boost(rows, 5, 0.3, 3, 32, 42)
    monkeypatch.setattr(trees, "BLOCK", 100)
    monkeypatch.setattr(trees, "WRITTEN", 2)
    parts = trees.boost(rows, 5, 0.3, 3, 32, 42)
    assert np.allclose(_probabilities(whole, rows), _probabilities(parts, rows), atol=1e-12)


def test_boosted_trees_of_one_class_and_of_broken_rows(spark):
    rows = _rows(spark, 50)
    ensure_checkpoint_dir(spark)
    alone = trees.boost(rows.withColumn("label", F.lit(0.0)), 3, 0.1, 2, 32, 42)
    assert not alone.featureImportances.toArray().any() and (_probabilities(alone, rows) < 0.2).all()
    with pytest.raises(ValueError):
        trees.boost(rows.limit(0), 3, 0.1, 2, 32, 42)
    with pytest.raises(PythonException, match="labels must be 0 or 1"):
        trees.boost(rows.withColumn("label", F.when(F.col("label") == 1, 1.0)), 3, 0.1, 2, 32, 42)


def _plain_tree(spark, rows):
    from pyspark.ml.classification import DecisionTreeClassifier

    return DecisionTreeClassifier(weightCol="weight", maxDepth=30, maxBins=32, seed=42).fit(rows)


@pytest.mark.parametrize("part", [1 << 18, 200, 20])  # grown by one task, and below nodes that passes over all rows split
def test_tree_of_a_forest_is_that_of_spark(spark, monkeypatch, part):
    """One tree with all rows and features has no chance in it."""
    monkeypatch.setattr(trees, "PART", part)
    monkeypatch.setattr(trees, "BLOCK", 256)
    rows = _rows(spark, 700).drop("x")
    want, got = _plain_tree(spark, rows), trees.grow_forest(rows, 1, 30, 32, 42)
    assert (len(got.tops[0][0]) > 1) == (part < 700)
    assert np.allclose(_by_features(got, rows), _by_features(want, rows), atol=1e-9)
    shares = lambda model: np.delete(x := model.featureImportances.toArray(), (0, 6)).tolist() + [x[0] + x[6]]
    assert np.allclose(shares(got), shares(want), atol=1e-9)


def _by_features(model, rows):
    scored = model.transform(rows).select(vector_to_array("features")[0].alias("k"), vector_to_array("probability")[1].alias("p"))
    return np.array([r.p for r in scored.orderBy("k").collect()])


def test_forest_learns_as_that_of_spark(spark, monkeypatch):
    from marquee.operators import metrics

    rows, ahead = _rows(spark, 3000), _rows(spark, 1500, seed=8)
    estimator = train.forest(12)
    area = lambda model: metrics.roc_auc(model.transform(ahead).withColumn("prob", vector_to_array("probability")[1]), "prob").first()[0]
    monkeypatch.setattr(trees, "PART", 700)
    got = train.grow(estimator, rows)
    assert isinstance(got, trees.Forest) and got.transform(ahead).count() == 1500
    assert area(got) == pytest.approx(area(estimator.fit(rows)), abs=0.02)
    assert got.featureImportances.toArray().sum() == pytest.approx(1.0)
    one = train.grow(estimator, rows.withColumn("label", F.lit(1.0)))
    assert (_probabilities(one, ahead) == 1).all()


def test_forest_of_few_rows(spark):
    """A tree may draw none of three rows; the others answer for it."""
    rows = _rows(spark, 3)
    got = _probabilities(trees.grow_forest(rows, 9, 30, 32, 42), rows)
    assert len(got) == 3 and ((got >= 0) & (got <= 1)).all()

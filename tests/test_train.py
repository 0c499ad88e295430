import numpy as np
import pytest
from pyspark.ml.linalg import Vectors
from pyspark.sql import functions as F

from marquee.operators import metrics
from marquee.plans import train
from marquee.session import materialise

COLUMNS = ["a", "b", "flat"]


@pytest.fixture(scope="module")
def data(spark):
    rng = np.random.default_rng(42)
    rows = []
    for i in range(1200):
        y = int(rng.random() < 0.15)
        a = float(rng.normal(2.0 * y, 1.0))
        b = None if rng.random() < 0.1 else float(rng.normal(100 + 30 * y, 20))
        rows.append((f"m{i}", 2000 + i % 6, a, b, 3, y))
    return materialise(spark.createDataFrame(rows, "imdb_id STRING, release_year INT, a DOUBLE, b DOUBLE, flat INT, label INT"))


SPLITS = {"train": (2000, 2002), "validation": (2003, 2003), "test": (2004, 2004), "prediction": (2005, 2005)}


def test_preprocessor(data):
    fitted = train.Preprocessor.fit(data, COLUMNS)
    b = np.array([np.nan if r["b"] is None else r["b"] for r in data.select("b").collect()], dtype=float)
    assert fitted.medians[1] == pytest.approx(np.nanmedian(b))
    filled = np.where(np.isnan(b), np.nanmedian(b), b)
    assert fitted.means[1] == pytest.approx(filled.mean()) and fitted.deviations[1] == pytest.approx(filled.std())
    assert fitted.deviations[2] == 1.0
    row = fitted.transform(data).agg(F.count("features").alias("n")).first()
    assert row["n"] == 1200
    assert "a" in fitted.transform(data).columns
    rough = train.Preprocessor.fit(data, COLUMNS, approximate=True)
    assert rough.medians[1] == pytest.approx(fitted.medians[1], rel=0.02)


def test_weights(data):
    negatives, positives = train.class_counts(data)
    total = {r["label"]: r["s"] for r in train.balanced_weights(data).groupBy("label").agg(F.sum("weight").alias("s")).collect()}
    assert total[0] == pytest.approx(600) and total[1] == pytest.approx(600)
    heavy = train.positive_weights(data).filter("label = 1").first()["weight"]
    assert heavy == pytest.approx(negatives / positives)


def test_logistic_meets_the_penalised_optimum(data):
    """Gradient of the weighted loss plus half the squared norm of the coefficients is zero."""
    fitted = train.fit(data, "logistic", COLUMNS)
    rows = train.balanced_weights(fitted.preprocessor.transform(data)).select("features", "label", "weight").collect()
    x = np.array([r["features"].toArray() for r in rows])
    y, w = np.array([r["label"] for r in rows]), np.array([r["weight"] for r in rows])
    beta, bias = fitted.model.coefficients.toArray(), fitted.model.intercept
    gap = w * (1 / (1 + np.exp(-(x @ beta + bias))) - y)
    assert np.abs(x.T @ gap + beta).max() < 0.5 and abs(gap.sum()) < 0.5
    assert metrics.roc_auc(fitted.score(data), "prob").first()[0] > 0.9


def test_master_run(data):
    out = train.run_master(data, SPLITS, "logistic", COLUMNS)
    assert 0 < out.threshold < 1 and out.validation_auc > 0.85 and out.test_auc > 0.85
    recall = {r["class"]: r["recall"] for r in out.validation_report.collect()}["1"]
    assert recall <= 0.9
    predictions = out.predictions.collect()
    assert len(predictions) == 200
    probs = [r["oscar_probability"] for r in predictions]
    assert probs == sorted(probs, reverse=True)
    assert all((r["oscar_probability"] >= out.threshold) == bool(r["predicted_nominee"]) for r in predictions)
    found = {r["class"]: r["support"] for r in out.test_report.collect()}["1"]
    assert out.missed.count() + out.hits.count() == found


def test_tree_models(spark, data):
    models = {
        "forest": (lambda: train.forest(10), train.balanced_weights),
        "boosted": (lambda: train.boosted(5, 3, 0.1), train.positive_weights),
    }
    first, last = SPLITS["train"]
    part = data.filter(F.col("release_year").between(first, last))
    report = train.compare_models(part, data.filter("release_year = 2003"), models, COLUMNS)
    assert {r["model"] for r in report.collect()} == set(models)
    assert report.agg(F.min("roc_auc")).first()[0] > 0.8
    fitted = train.fit(part, models["boosted"][0], COLUMNS)
    table = fitted.importance(spark).collect()
    assert sum(r["importance"] for r in table) == pytest.approx(1.0) and table[-1]["feature"] == "flat"


def test_forward_validation(spark, folder):
    import numpy as np
    from pyspark.sql import functions as F

    from marquee.operators.planned import forward_folds
    from marquee.plans.features import store_dataset
    from marquee.plans.train import expand_folds, forward_validation

    rng = np.random.default_rng(4)
    rows = [(f"m{i}", 2000 + i % 6, float(x := rng.normal()), int(x + rng.normal() > 0.5)) for i in range(600)]
    data = store_dataset(spark.createDataFrame(rows, "imdb_id STRING, release_year INT, a DOUBLE, label INT"), f"{folder}/f")
    folds = forward_folds(2000, 2005, 1, 3)
    assert folds == [((2000, 2002), (2003, 2003)), ((2000, 2003), (2004, 2004)), ((2000, 2004), (2005, 2005))]
    places = {(r.fold, r.part): r.n for r in expand_folds(data, folds).groupBy("fold", "part").agg(F.count("*").alias("n")).collect()}
    assert places == {(k, p): n for k in (1, 2, 3) for p, n in (("train", 100 * (k + 2)), ("test", 100))}
    scores, found = forward_validation(data, folds, "logistic", ["a"])
    kept = {}
    for r in scores.collect():
        kept.setdefault(r.fold, []).append((r.prob, r.label))
    for r in found.collect():
        pos, neg = [p for p, y in kept[r.fold] if y], [p for p, y in kept[r.fold] if not y]
        area = sum((p > q) + (p == q) / 2 for p in pos for q in neg) / (len(pos) * len(neg))
        assert r.roc_auc == pytest.approx(area) and area > 0.6 and (r.n, r.positives) == (100, len(pos))
        assert r.train_n == 100 * (r.fold + 2)


def test_areas_by_group(spark):
    from marquee.operators.metrics import scores_by_group

    rows = [("a", 0.5, 1), ("a", 0.5, 0), ("a", 0.2, 0), ("b", 0.1, 1), ("b", 0.9, 0), ("c", 0.3, 1)]
    got = scores_by_group(spark.createDataFrame(rows, "g STRING, prob DOUBLE, label INT"), "g", "prob").collect()
    assert {r.g: (r.n, r.positives, r.roc_auc) for r in got} == {"a": (3, 1, 0.75), "b": (2, 1, 0.0), "c": (1, 1, None)}


def test_boosted_trees_write_no_node_ids(spark):
    """Node ids are no part of the model: with and without a cache of them the trees are the same, and none is asked for."""
    rows = [(Vectors.dense(float(i % 7), float(i * 37 % 11)), float(i % 3 == 0), 1.0 + i % 2) for i in range(200)]
    df = spark.createDataFrame(rows, ["features", "label", "weight"])
    plain = train.boosted(rounds=3, depth=3)
    assert not plain.getCacheNodeIds()
    trees = lambda model: [t.toDebugString.split("\n", 1)[1] for t in model.trees]
    assert trees(plain.fit(df)) == trees(train.boosted(rounds=3, depth=3).setCacheNodeIds(True).fit(df))

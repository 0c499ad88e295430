import numpy as np
import pytest

from marquee.functions.stats import at_least
from marquee.operators import metrics
from pyspark.sql import functions as F


def frame(spark, y, p):
    return spark.createDataFrame([(int(a), float(b)) for a, b in zip(y, p)], "label INT, prob DOUBLE")


def brute_curve(y, p):
    out = {}
    for t in sorted(set(p)):
        called = p >= t
        out[t] = ((y & called).sum() / called.sum(), (y & called).sum() / y.sum())
    return out


@pytest.mark.parametrize("parts", [1, 8])
@pytest.mark.parametrize("digits", [1, 3])
def test_curve_area_and_threshold(spark, parts, digits):
    rng = np.random.default_rng(digits)
    y = rng.random(400) < 0.2
    p = np.round(np.clip(rng.normal(0.3 + 0.3 * y, 0.2), 0, 1), digits)
    df = frame(spark, y, p)
    curve = metrics.precision_recall_curve(df, "prob", parts=parts)
    got = {r["threshold"]: (r["precision"], r["recall"]) for r in curve.collect()}
    assert got.pop(None) == (1.0, 0.0)
    want = brute_curve(y, p)
    assert got.keys() == want.keys()
    for t, pair in want.items():
        assert got[t] == pytest.approx(pair)
    pos, neg = p[y], p[~y]
    area = ((pos[:, None] > neg).sum() + 0.5 * (pos[:, None] == neg).sum()) / (len(pos) * len(neg))
    assert metrics.roc_auc(df, "prob", parts=parts).first()[0] == pytest.approx(area)
    assert metrics.best_threshold(curve).first()[0] == min(t for t, (_, r) in want.items() if r <= 0.9)
    assert metrics.best_threshold(curve, mode="at_least").first()[0] == max(t for t, (_, r) in want.items() if r >= 0.9)


def test_threshold_edges(spark):
    single = frame(spark, [1, 0], [0.9, 0.1])
    assert metrics.best_threshold(metrics.precision_recall_curve(single, "prob")).first()[0] is None
    exact = frame(spark, [1] * 10 + [0], [i / 10 for i in range(1, 11)] + [0.05])
    assert metrics.best_threshold(metrics.precision_recall_curve(exact, "prob")).first()[0] == pytest.approx(0.2)
    with pytest.raises(ValueError):
        metrics.best_threshold(metrics.precision_recall_curve(single, "prob"), mode="x")


def test_one_class_only(spark):
    assert metrics.roc_auc(frame(spark, [1, 1], [0.2, 0.3]), "prob").first()[0] is None


def test_report(spark):
    y, p = [1, 1, 1, 0, 0, 0, 0, 0], [0.9, 0.8, 0.1, 0.7, 0.2, 0.1, 0.1, 0.1]
    judged = frame(spark, y, p).withColumn("pred", at_least(F.col("prob"), 0.5))
    got = {r["class"]: r for r in metrics.classification_report(judged).collect()}
    assert got["1"]["precision"] == pytest.approx(2 / 3) and got["1"]["recall"] == pytest.approx(2 / 3)
    assert got["0"]["precision"] == pytest.approx(4 / 5) and got["0"]["support"] == 5
    assert got["accuracy"]["f1"] == pytest.approx(6 / 8)
    assert got["macro avg"]["recall"] == pytest.approx((2 / 3 + 4 / 5) / 2)
    assert got["weighted avg"]["recall"] == pytest.approx(6 / 8)


def test_report_zero_division(spark):
    got = {r["class"]: r for r in metrics.classification_report(frame(spark, [1, 0], [0, 0]).withColumn("pred", F.lit(0))).collect()}
    assert got["1"]["precision"] == 0 and got["1"]["f1"] == 0

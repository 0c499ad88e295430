"""Classifier metrics as DataFrame jobs: curve, threshold, area, report and error lists."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from marquee.functions.stats import ratio
from marquee.operators.ordering import split_points, with_running_totals, with_slot


def _score_groups(scored: DataFrame, score: str, label: str, parts: int | None) -> DataFrame:
    """Positives and negatives per distinct score, and how many rank above it.

    Equal scores are one row before anything is sorted; the sort is cut into slots of the score.
    """
    rows = scored.select(F.col(score).cast("double").alias("score"), F.col(label).cast("long").alias("y"))
    groups = rows.groupBy("score").agg(F.sum("y").alias("pos"), (F.count(F.lit(1)) - F.sum("y")).alias("neg"))
    slotted = with_slot(groups, "score", split_points(rows, "score", parts), "_slot", descending=True)
    return with_running_totals(
        slotted, {"pos_above": "pos", "neg_above": "neg"}, [F.col("score").desc()], bounded_slots=True
    )


def _class_totals(scored: DataFrame, label: str) -> tuple[int, int]:
    row = scored.agg(F.sum(F.col(label).cast("long")).alias("p"), F.count(F.lit(1)).alias("n")).first()
    positives = row["p"] or 0
    return positives, row["n"] - positives


def precision_recall_curve(scored: DataFrame, score: str, label: str = "label", parts: int | None = None) -> DataFrame:
    """One point per distinct score, taken as `score >= threshold`, and the end point (precision 1, recall 0)."""
    positives, _ = _class_totals(scored, label)
    tp, fp = F.col("pos_above") + F.col("pos"), F.col("neg_above") + F.col("neg")
    recall = tp / F.lit(float(positives)) if positives else F.lit(1.0)
    points = _score_groups(scored, score, label, parts).select(
        F.col("score").alias("threshold"), (tp / (tp + fp)).alias("precision"), recall.alias("recall")
    )
    end = scored.sparkSession.createDataFrame([(None, 1.0, 0.0)], points.schema)
    return points.unionByName(end)


def best_threshold(curve: DataFrame, target: float = 0.90, mode: str = "at_most") -> DataFrame:
    """Threshold for a recall target; null when no threshold qualifies.

    `at_most`: the lowest threshold whose recall is at or below the target. `at_least`: the highest one that keeps it.
    """
    known = F.col("threshold").isNotNull()
    if mode == "at_most":
        pick = F.min(F.when(known & (F.col("recall") <= target), F.col("threshold")))
    elif mode == "at_least":
        pick = F.max(F.when(known & (F.col("recall") >= target), F.col("threshold")))
    else:
        raise ValueError(f"unknown mode {mode!r}")
    return curve.agg(pick.alias("threshold"))


def roc_auc(scored: DataFrame, score: str, label: str = "label", parts: int | None = None) -> DataFrame:
    """Area under the ROC curve, ties counted half; null when one class is absent."""
    positives, negatives = _class_totals(scored, label)
    wins = F.sum(F.col("neg").cast("double") * (F.col("pos_above") + F.col("pos") / 2))
    return _score_groups(scored, score, label, parts).agg(
        ratio(wins, F.lit(float(positives) * float(negatives))).alias("roc_auc")
    )


def scores_by_group(scored: DataFrame, by: str, score: str, label: str = "label", parts: int | None = None) -> DataFrame:
    """(by, n, positives, roc_auc) of every group, all in one pass: scores are counted, cut into slots of the score, and
    ranked within group and slot, so that a group with a third of all rows is spread as well."""
    rows = scored.select(F.col(by).alias("_by"), F.col(score).cast("double").alias("score"), F.col(label).cast("long").alias("y"))
    groups = rows.groupBy("_by", "score").agg(F.sum("y").alias("pos"), (F.count(F.lit(1)) - F.sum("y")).alias("neg"))
    slotted = with_slot(groups, "score", split_points(rows, "score", parts), "_slot", descending=True)
    ranked = with_running_totals(slotted, {"pos_above": "pos"}, [F.col("score").desc()], ["_by"], bounded_slots=True)
    wins = F.sum(F.col("neg").cast("double") * (F.col("pos_above") + F.col("pos") / 2))
    positives, negatives = F.sum("pos"), F.sum("neg")
    return ranked.groupBy(F.col("_by").alias(by)).agg(
        (positives + negatives).alias("n"), positives.alias("positives"), ratio(wins, positives.cast("double") * negatives).alias("roc_auc")
    )


def _zero_ratio(part: Column, whole: Column) -> Column:
    return F.coalesce(ratio(part, whole), F.lit(0.0))


def classification_report(predicted: DataFrame, label: str = "label", prediction: str = "pred") -> DataFrame:
    """Precision, recall, F1 and support per class, accuracy, and macro and weighted means; 0/0 counts as 0."""
    y, p = F.col(label).cast("int"), F.col(prediction).cast("int")
    counts = predicted.agg(
        F.count_if((y == 1) & (p == 1)).alias("tp"),
        F.count_if((y == 0) & (p == 1)).alias("fp"),
        F.count_if((y == 1) & (p == 0)).alias("fn"),
        F.count_if((y == 0) & (p == 0)).alias("tn"),
    )
    tp, fp, fn, tn = (F.col(c) for c in ("tp", "fp", "fn", "tn"))
    scores = counts.select(
        "*",
        _zero_ratio(tn, tn + fn).alias("p0"),
        _zero_ratio(tn, tn + fp).alias("r0"),
        _zero_ratio(tp, tp + fp).alias("p1"),
        _zero_ratio(tp, tp + fn).alias("r1"),
        (tn + fp).alias("s0"),
        (tp + fn).alias("s1"),
        _zero_ratio(tp + tn, tp + tn + fp + fn).alias("acc"),
    )
    f1 = lambda k: _zero_ratio(2 * F.col(f"p{k}") * F.col(f"r{k}"), F.col(f"p{k}") + F.col(f"r{k}")).alias(f"f{k}")
    scores = scores.select("*", f1(0), f1(1))
    s0, s1 = F.col("s0"), F.col("s1")
    total = s0 + s1
    mean = lambda m: (F.col(f"{m}0") + F.col(f"{m}1")) / 2
    weighted = lambda m: _zero_ratio(F.col(f"{m}0") * s0 + F.col(f"{m}1") * s1, total)
    entry = lambda name, p_, r_, f_, s_: F.struct(
        F.lit(name).alias("class"), p_.alias("precision"), r_.alias("recall"), f_.alias("f1"), s_.alias("support")
    )
    acc = F.col("acc")
    rows = [
        entry("0", F.col("p0"), F.col("r0"), F.col("f0"), s0),
        entry("1", F.col("p1"), F.col("r1"), F.col("f1"), s1),
        entry("accuracy", acc, acc, acc, total),
        entry("macro avg", mean("p"), mean("r"), mean("f"), total),
        entry("weighted avg", weighted("p"), weighted("r"), weighted("f"), total),
    ]
    return scores.select(F.explode(F.array(*rows)).alias("e")).select("e.*")


def missed(predicted: DataFrame, score: str = "prob", label: str = "label", prediction: str = "pred") -> DataFrame:
    """Positives the threshold lost."""
    return predicted.filter((F.col(label) == 1) & (F.col(prediction) == 0))


def hits(predicted: DataFrame, score: str = "prob", label: str = "label", prediction: str = "pred", key: str = "imdb_id") -> DataFrame:
    """Positives found, most likely first."""
    found = predicted.filter((F.col(label) == 1) & (F.col(prediction) == 1))
    return found.orderBy(F.col(score).desc_nulls_last(), F.col(key))


def top_candidates(scored: DataFrame, score: str, k: int, key: str = "imdb_id") -> DataFrame:
    return scored.orderBy(F.col(score).desc_nulls_last(), F.col(key)).limit(k)

"""Preprocessing, training, evaluation and prediction on the feature table."""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.ml.classification import GBTClassifier, LogisticRegression, RandomForestClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from marquee.functions.stats import at_least
from marquee.operators import metrics, trees
from marquee.operators.quantiles import SMALL_ROWS, exact_quantiles
from marquee.schemas import FINAL_FEATURES
from marquee.session import ensure_checkpoint_dir, materialise

SEED = 42


@dataclass(frozen=True)
class Preprocessor:
    """Medians for missing values, then zero mean and unit population deviation; fitted on training rows only."""

    columns: tuple[str, ...]
    medians: tuple[float, ...]
    means: tuple[float, ...]
    deviations: tuple[float, ...]

    @staticmethod
    def fit(train: DataFrame, columns: Sequence[str], small_rows: int = SMALL_ROWS, approximate: bool = False) -> Preprocessor:
        """`approximate` takes medians from Spark's sketch: one pass, but an observed value near the median."""
        if approximate:
            typed = train.select(*[F.col(c).cast("double").alias(c) for c in columns])
            medians = [q[0] if q else None for q in typed.approxQuantile(list(columns), [0.5], 0.001)]
        else:
            exact = exact_quantiles(train, columns, [0.5], small_rows)
            medians = [exact[c][0] for c in columns]
        medians = [0.0 if m is None else m for m in medians]
        filled = [F.coalesce(F.col(c).cast("double"), F.lit(m)) for c, m in zip(columns, medians)]
        row = train.agg(
            *[F.avg(x).alias(f"m{i}") for i, x in enumerate(filled)],
            *[F.stddev_pop(x).alias(f"s{i}") for i, x in enumerate(filled)],
        ).first()
        means = tuple(row[f"m{i}"] or 0.0 for i in range(len(columns)))
        deviations = tuple(row[f"s{i}"] or 1.0 for i in range(len(columns)))
        return Preprocessor(tuple(columns), tuple(medians), means, deviations)

    def impute(self, df: DataFrame) -> DataFrame:
        fills = dict(zip(self.columns, self.medians))
        return df.withColumns({c: F.coalesce(F.col(c).cast("double"), F.lit(m)) for c, m in fills.items()})

    def scale(self, df: DataFrame) -> DataFrame:
        steps = zip(self.columns, self.means, self.deviations)
        return df.withColumns({c: (F.col(c) - F.lit(m)) / F.lit(s) for c, m, s in steps})

    def transform(self, df: DataFrame, vector: str = "features") -> DataFrame:
        """All columns of the input and the feature vector."""
        scaled = {f"_f_{c}": F.col(c) for c in self.columns}
        inner = df.withColumns(scaled)
        work = Preprocessor(tuple(scaled), self.medians, self.means, self.deviations)
        assembled = VectorAssembler(inputCols=list(scaled), outputCol=vector).transform(work.scale(work.impute(inner)))
        return assembled.drop(*scaled)


def class_counts(df: DataFrame, label: str = "label") -> tuple[int, int]:
    """Negatives and positives."""
    row = df.agg(F.count_if(F.col(label) == 0).alias("n"), F.count_if(F.col(label) == 1).alias("p")).first()
    return row["n"], row["p"]


def balanced_weights(df: DataFrame, label: str = "label", out: str = "weight") -> DataFrame:
    """n / (2 * size of the class)."""
    negatives, positives = class_counts(df, label)
    total = negatives + positives
    weight = lambda k: total / (2 * k) if k else 0.0
    return df.withColumn(out, F.when(F.col(label) == 1, weight(positives)).otherwise(weight(negatives)))


def positive_weights(df: DataFrame, label: str = "label", out: str = "weight") -> DataFrame:
    """Negatives over positives for the positives, one for the rest."""
    negatives, positives = class_counts(df, label)
    ratio = negatives / positives if positives else 1.0
    return df.withColumn(out, F.when(F.col(label) == 1, ratio).otherwise(1.0))


def logistic(weight_total: float) -> LogisticRegression:
    """L2 with unit penalty on the sum of weighted losses; Spark divides the losses by the sum of weights."""
    return LogisticRegression(
        weightCol="weight", maxIter=1000, regParam=1.0 / weight_total, elasticNetParam=0.0, standardization=False
    )


def forest(trees: int = 200) -> RandomForestClassifier:
    """Trees as deep as Spark lets them grow. `fit` grows them part by part and keeps them in a table; fitted by Spark, they lie in
    the driver, and with more memory for statistics a pass over the rows splits more nodes."""
    return RandomForestClassifier(weightCol="weight", numTrees=trees, maxDepth=30, seed=SEED, maxMemoryInMB=1024)


def boosted(rounds: int = 1000, depth: int = 6, rate: float = 0.03) -> GBTClassifier:
    """Large round counts make long plans of dependent trees; the errors that a round hands on are cut every few rounds. Trees
    are shallow, so rows find their node again from the root: a cache of node ids would be written for each level of each."""
    return GBTClassifier(
        weightCol="weight", maxIter=rounds, maxDepth=depth, stepSize=rate, seed=SEED, checkpointInterval=10, cacheNodeIds=False
    )


# Rounds, depth and rate of the three boosted models.
BOOSTED = {"small": (200, 4, 0.05), "medium": (500, 6, 0.05), "final": (1000, 6, 0.03)}


def boosted_model(name: str) -> GBTClassifier:
    return boosted(*BOOSTED[name])


@dataclass(frozen=True)
class Fitted:
    preprocessor: Preprocessor
    model: object

    def score(self, df: DataFrame, out: str = "prob") -> DataFrame:
        """Adds the probability of the positive class."""
        scored = self.model.transform(self.preprocessor.transform(df))
        return scored.withColumn(out, vector_to_array("probability")[1]).drop(
            "features", "rawPrediction", "probability", "prediction"
        )

    def importance(self, spark) -> DataFrame:
        """One row per input column, most important first."""
        values = self.model.featureImportances.toArray().tolist()
        rows = [(c, float(v)) for c, v in zip(self.preprocessor.columns, values)]
        table = spark.createDataFrame(rows, "feature STRING, importance DOUBLE")
        return table.orderBy(F.col("importance").desc(), F.col("feature"))


def fit(
    train: DataFrame,
    make: Callable[[], object] | str = boosted,
    columns: Sequence[str] = FINAL_FEATURES,
    weights: Callable[[DataFrame], DataFrame] = balanced_weights,
    approximate: bool = False,
) -> Fitted:
    """Fit the preprocessing and the classifier. The training columns are written once, as they are read often."""
    ensure_checkpoint_dir(train.sparkSession)
    train = materialise(train.select(*columns, "label"))
    prepared = Preprocessor.fit(train, columns, approximate=approximate)
    rows = weights(prepared.transform(train)).select("features", "label", "weight")
    if make == "logistic":
        total = rows.agg(F.sum("weight").alias("w")).first()["w"]
        return Fitted(prepared, logistic(total).fit(rows))
    return Fitted(prepared, grow(make(), rows))


#: Settings that `operators/trees.py` takes from Spark's defaults; an estimator that has others is fitted by Spark.
_DEFAULT = ["subsamplingRate", "minInstancesPerNode", "minInfoGain", "minWeightFractionPerNode", "featureSubsetStrategy", "impurity"]
_DEFAULT += ["bootstrap", "lossType", "validationIndicatorCol", "thresholds"]


def grow(estimator, rows: DataFrame):
    """The model of an estimator; trees are grown by `operators/trees.py`, by the estimator's sizes."""
    kind = type(estimator)
    if kind not in (GBTClassifier, RandomForestClassifier) or any(estimator.hasParam(x) and estimator.isSet(x) for x in _DEFAULT):
        return estimator.fit(rows)
    size = estimator.getMaxDepth(), estimator.getMaxBins(), estimator.getSeed()
    if kind is GBTClassifier:
        return trees.boost(rows, estimator.getMaxIter(), estimator.getStepSize(), *size)
    return trees.grow_forest(rows, estimator.getNumTrees(), *size)


def compare_models(
    train: DataFrame, validation: DataFrame, models: Mapping[str, tuple], columns: Sequence[str]
) -> DataFrame:
    """Report rows and area under the curve of each model on one validation split. `models`: name -> (make, weights)."""
    score = lambda make, weights: materialise(fit(train, make, columns, weights).score(validation).select("label", "prob"))
    return compare_scores({name: score(*how) for name, how in models.items()})


def compare_scores(scores: Mapping[str, DataFrame]) -> DataFrame:
    """The same from stored scores (label, prob) of each model."""
    out = None
    for name, scored in scores.items():
        area = metrics.roc_auc(scored, "prob").first()["roc_auc"]
        report = metrics.classification_report(scored.withColumn("pred", at_least(F.col("prob"), 0.5)))
        rows = report.withColumns({"model": F.lit(name), "roc_auc": F.lit(area).cast("double")})
        out = rows if out is None else out.unionByName(rows)
    return out


def expand_folds(df: DataFrame, folds: Sequence[tuple[tuple[int, int], tuple[int, int]]], year: str = "release_year") -> DataFrame:
    """Every row once for each fold it belongs to, with `fold` (from 1) and `part`, train or test. A row without a year is in
    none."""
    places = [
        F.when(F.col(year).between(*years), F.struct(F.lit(k).alias("fold"), F.lit(part).alias("part")))
        for k, fold in enumerate(folds, 1)
        for part, years in zip(("train", "test"), fold)
    ]
    return df.select("*", F.inline(F.filter(F.array(*places), lambda p: p.isNotNull())))


def forward_validation(
    dataset: DataFrame,
    folds: Sequence[tuple[tuple[int, int], tuple[int, int]]],
    make: Callable[[], object] | str = boosted,
    columns: Sequence[str] = FINAL_FEATURES,
    weights: Callable[[DataFrame], DataFrame] = balanced_weights,
) -> tuple[DataFrame, DataFrame]:
    """(scores, metrics) of a model trained on the past and tested on the years after it, fold by fold.

    `scores`: fold, imdb_id, label, prob of every test row, written once. `metrics`: fold, n, positives, roc_auc, train_n and
    train_positives, from one aggregate over all scores and one over the expanded rows. `dataset` is a stored feature table
    (`features.store_dataset`), so a fold reads the folders of its own years; a fold without both classes in its training
    years cannot be fitted and is an error."""
    parts = []
    for k, (past, ahead) in enumerate(folds, 1):
        within = lambda years: dataset.filter(F.col("release_year").between(*years))
        fitted = fit(within(past), make, columns, weights)
        parts.append(fitted.score(within(ahead)).select(F.lit(k).alias("fold"), "imdb_id", "label", "prob"))
    scores = materialise(reduce(DataFrame.unionByName, parts))
    trained = expand_folds(dataset.select("release_year", "label"), folds).filter(F.col("part") == "train")
    sizes = trained.groupBy("fold").agg(F.count(F.lit(1)).alias("train_n"), F.sum("label").alias("train_positives"))
    return scores, metrics.scores_by_group(scores, "fold", "prob").join(sizes, "fold")


@dataclass(frozen=True)
class Outcome:
    threshold: float | None
    validation_auc: float | None
    test_auc: float | None
    validation: DataFrame
    test: DataFrame
    validation_report: DataFrame
    test_report: DataFrame
    missed: DataFrame
    hits: DataFrame
    predictions: DataFrame


def _judged(model: Fitted, df: DataFrame, threshold: float | None) -> DataFrame:
    scored = model.score(df)
    return materialise(scored.withColumn("pred", at_least(F.col("prob"), F.lit(threshold).cast("double"))))


def run_master(
    dataset: DataFrame,
    splits: Mapping[str, tuple[int, int]],
    make: Callable[[], object] | str = boosted,
    columns: Sequence[str] = FINAL_FEATURES,
    target: float = 0.90,
    mode: str = "at_most",
) -> Outcome:
    """Train, choose the threshold on validation, test once, refit on all labelled years and rank the candidates.

    `splits` holds year ranges for train, validation, test and prediction.
    """
    data = materialise(dataset)
    part = {k: data.filter(F.col("release_year").between(*r)) for k, r in splits.items()}
    first = fit(part["train"], make, columns)
    on_validation = materialise(first.score(part["validation"]))
    curve = metrics.precision_recall_curve(on_validation, "prob")
    threshold = metrics.best_threshold(curve, target, mode).first()["threshold"]
    judged = on_validation.withColumn("pred", at_least(F.col("prob"), F.lit(threshold).cast("double")))
    on_test = _judged(first, part["test"], threshold)
    whole = part["train"].unionByName(part["validation"]).unionByName(part["test"])
    final = fit(whole, make, columns)
    ranked = final.score(part["prediction"], "oscar_probability").withColumn(
        "predicted_nominee", at_least(F.col("oscar_probability"), F.lit(threshold).cast("double"))
    )
    return Outcome(
        threshold=threshold,
        validation_auc=metrics.roc_auc(on_validation, "prob").first()["roc_auc"],
        test_auc=metrics.roc_auc(on_test, "prob").first()["roc_auc"],
        validation=judged,
        test=on_test,
        validation_report=metrics.classification_report(judged),
        test_report=metrics.classification_report(on_test),
        missed=metrics.missed(on_test),
        hits=metrics.hits(on_test),
        predictions=ranked.orderBy(F.col("oscar_probability").desc_nulls_last(), F.col("imdb_id")),
    )

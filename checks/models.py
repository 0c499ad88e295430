"""Training and prediction on the derived feature table."""

from __future__ import annotations

from pyspark.sql import functions as F

from checks import film
from checks.features import dataset
from checks.film import film_sql
from checks.registry import query, rounded
from marquee.operators import metrics, planned
from marquee.plans import train
from marquee.schemas import BASELINE_FEATURES, FINAL_FEATURES
from marquee.session import materialise

_SCALED = ["imdb_rating", "imdb_votes", "runtime_minutes", "metascore"]


def _split(spark, sf, name):
    first, last = film.SPLITS[name]
    return dataset(spark, sf).filter(F.col("release_year").between(first, last))


def _movies_in(spark, sf, name):
    first, last = film.SPLITS[name]
    return film.movies(spark, sf).filter(F.col("release_year").between(first, last))


@query(
    "impute_scale",
    film_sql("").rstrip()
    + ", t AS (SELECT * FROM movies WHERE release_year BETWEEN 1995 AND 1999), "
    + ", ".join(
        f"f_{c} AS (SELECT avg(x) AS m, stddev_pop(x) AS s, min(d) AS d FROM (SELECT coalesce(CAST({c} AS DOUBLE), d) AS x, d FROM t, "
        f"(SELECT quantile_cont(CAST({c} AS DOUBLE), 0.5) AS d FROM t)))"
        for c in _SCALED
    )
    + " SELECT imdb_id, "
    + ", ".join(f"round((coalesce(CAST({c} AS DOUBLE), f_{c}.d) - f_{c}.m) / f_{c}.s, 6) AS {c}" for c in _SCALED)
    + " FROM movies, "
    + ", ".join(f"f_{c}" for c in _SCALED)
    + " WHERE release_year = 2000",
)
def _(spark, sf):
    fitted = train.Preprocessor.fit(_movies_in(spark, sf, "train"), _SCALED)
    return rounded(fitted.scale(fitted.impute(_movies_in(spark, sf, "validation"))).select("imdb_id", *_SCALED))


@query(
    "class_weights",
    film_sql(
        "SELECT label, round(sum(count(*)) OVER () / (2.0 * count(*)), 6) AS weight, count(*) AS n "
        "FROM (SELECT CAST(nominated_oscar AS INTEGER) AS label FROM movies) GROUP BY label"
    ),
)
def _(spark, sf):
    labelled = film.movies(spark, sf).select(F.col("nominated_oscar").cast("int").alias("label"))
    weighted = train.balanced_weights(labelled)
    return rounded(weighted.groupBy("label", "weight").agg(F.count(F.lit(1)).alias("n")))


#: name -> (model, columns, weights) of the models that queries train. Boosted trees have the full size of the small model;
#: the forest has 20 of 200 trees, see the README for times.
_MODELS = {
    "logistic": ("logistic", BASELINE_FEATURES, train.balanced_weights),
    "forest": (lambda: train.forest(20), BASELINE_FEATURES, train.balanced_weights),
    "gbt": (lambda: train.boosted_model("small"), FINAL_FEATURES, train.positive_weights),
}
_KEPT: dict[tuple, object] = {}


def _once(spark, sf, name, make):
    """What several queries of a session share is computed by the first of them."""
    key = spark.sparkContext.applicationId, sf, name
    if key not in _KEPT:
        _KEPT[key] = make()
    return _KEPT[key]


def _fitted(spark, sf, name):
    return _once(spark, sf, ("fit", name), lambda: train.fit(_split(spark, sf, "train"), *_MODELS[name]))


def _validation(spark, sf, name):
    """Written scores of the validation years."""
    score = lambda: _fitted(spark, sf, name).score(_split(spark, sf, "validation")).select("imdb_id", "label", "prob")
    return _once(spark, sf, ("scores", name), lambda: materialise(score()))


_AREA = (
    "SELECT (sum(if(label = 1, r, 0)) - sum(label) * (sum(label) + 1) / 2) / (sum(label) * (count(*) - sum(label))) AS area "
    "FROM (SELECT label, rank() OVER (ORDER BY prob) + (count(*) OVER (PARTITION BY prob) - 1) / 2 AS r FROM {scores})"
)


def _model(name):
    query(f"model_{name}")(lambda spark, sf: _validation(spark, sf, name))

    @query(
        f"model_{name}_verified",
        film_sql("SELECT imdb_id, label, true AS in_range, true AS area_as_in_sql FROM ml_training_dataset WHERE release_year = 2000"),
    )
    def _(spark, sf):
        """Every film of the validation year with a probability; the area under the curve is the one of a rank sum in SQL."""
        scores = _validation(spark, sf, name)
        area = metrics.roc_auc(scores, "prob").crossJoin(spark.sql(_AREA, scores=scores))  # one row each
        judged = area.select((F.abs(F.col("roc_auc") - F.col("area")) < 1e-9).alias("area_as_in_sql"))
        return scores.select("imdb_id", "label", F.col("prob").between(0, 1).alias("in_range")).crossJoin(F.broadcast(judged))


for _name in _MODELS:
    _model(_name)


@query("importance")
def _(spark, sf):
    return _fitted(spark, sf, "gbt").importance(spark)


@query(
    "importance_verified",
    "SELECT feature, true AS in_range, true AS sums_to_one FROM (VALUES " + ", ".join(f"('{c}')" for c in FINAL_FEATURES) + ") AS t(feature)",
)
def _(spark, sf):
    found = _fitted(spark, sf, "gbt").importance(spark)
    total = found.agg(F.sum("importance").alias("total"))
    return found.crossJoin(total).select("feature", F.col("importance").between(0, 1).alias("in_range"), (F.abs(F.col("total") - 1) < 1e-9).alias("sums_to_one"))


def _master(spark, sf):
    splits = {"train": (1995, 1998), "validation": (1999, 1999), "test": (2000, 2000), "prediction": (2001, 2001)}
    return _once(spark, sf, "master", lambda: train.run_master(dataset(spark, sf), splits, _MODELS["gbt"][0], FINAL_FEATURES))


@query("master_run")
def _(spark, sf):
    return _master(spark, sf).predictions.select("imdb_id", "oscar_probability", "predicted_nominee")


@query(
    "master_run_verified",
    film_sql(
        "SELECT imdb_id, true AS in_range, true AS flag_follows_threshold, true AS threshold_as_in_sql, true AS test_report_as_in_sql "
        "FROM ml_training_dataset WHERE release_year = 2001"
    ),
)
def _(spark, sf):
    """Threshold and test report are computed again in SQL from the written scores; every candidate is ranked."""
    run = _master(spark, sf)
    again = spark.sql(
        "SELECT min(prob) AS t FROM (SELECT prob, sum(sum(label)) OVER (ORDER BY prob DESC) / sum(sum(label)) OVER () AS recall FROM {v} GROUP BY prob) "
        "WHERE recall <= 0.9",
        v=run.validation,
    )
    counted = spark.sql(
        f"SELECT count_if(label = 1 AND prob >= {run.threshold!r}D) AS tp, count_if(prob >= {run.threshold!r}D) AS flagged, count_if(label = 1) AS good FROM {{test}}",
        test=run.test,
    )
    ones = run.test_report.filter("class = '1'").select("precision", "recall", "support")
    same = lambda a, b: F.abs(a - F.coalesce(b, F.lit(0.0))) < 1e-9
    judged = again.crossJoin(counted).crossJoin(ones).select(
        (F.abs(F.col("t") - run.threshold) < 1e-12).alias("threshold_as_in_sql"),
        (same(F.col("precision"), F.try_divide("tp", "flagged")) & same(F.col("recall"), F.try_divide("tp", "good")) & (F.col("support") == F.col("good"))).alias("test_report_as_in_sql"),
    )
    follows = F.col("predicted_nominee") == (F.col("oscar_probability") >= run.threshold).cast("int")
    ranked = run.predictions.select("imdb_id", F.col("oscar_probability").between(0, 1).alias("in_range"), follows.alias("flag_follows_threshold"))
    return ranked.crossJoin(F.broadcast(judged))


@query("model_comparison")
def _(spark, sf):
    return train.compare_scores({name: _validation(spark, sf, name) for name in _MODELS})


@query(
    "model_comparison_verified",
    film_sql("").rstrip()
    + ", s AS (SELECT label FROM ml_training_dataset WHERE release_year = 2000), c(class, wanted) AS (VALUES ('0', 0), ('1', 1), ('accuracy', NULL), ('macro avg', NULL), ('weighted avg', NULL)) "
    "SELECT model, class, (SELECT count(*) FROM s WHERE wanted IS NULL OR label = wanted) AS support, true AS in_range, true AS area_in_range "
    "FROM c, (VALUES ('logistic'), ('forest'), ('gbt')) AS m(model)",
)
def _(spark, sf):
    found = train.compare_scores({name: _validation(spark, sf, name) for name in _MODELS})
    in_range = F.forall(F.array("precision", "recall", "f1"), lambda x: x.between(0, 1))
    return found.select("model", "class", "support", in_range.alias("in_range"), F.col("roc_auc").between(0, 1).alias("area_in_range"))


_FOLDS = planned.forward_folds(1995, 2000, 1, 3)
_FOLD_ROWS = ", ".join(f"({k}, {a}, {b}, {c}, {d})" for k, ((a, b), (c, d)) in enumerate(_FOLDS, 1))


@query(
    "forward_cv",
    film_sql("").rstrip()
    + f", folds(fold, a, b, c, d) AS (VALUES {_FOLD_ROWS}) "
    "SELECT fold, count(*) FILTER (release_year BETWEEN c AND d) AS n, CAST(sum(label) FILTER (release_year BETWEEN c AND d) AS BIGINT) AS positives, "
    "count(*) FILTER (release_year BETWEEN a AND b) AS train_n, CAST(sum(label) FILTER (release_year BETWEEN a AND b) AS BIGINT) AS train_positives, "
    "true AS area_as_in_sql, true AS area_in_range, true AS scores_in_range FROM ml_training_dataset, folds GROUP BY fold",
)
def _(spark, sf):
    """Three folds that only look forward. The area of each fold is compared with a rank sum in SQL over the same scores."""
    scores, found = train.forward_validation(dataset(spark, sf), _FOLDS, "logistic", BASELINE_FEATURES)
    by_sql = spark.sql(
        "SELECT fold AS f, (sum(if(label = 1, r, 0)) - sum(label) * (sum(label) + 1) / 2) / (sum(label) * (count(*) - sum(label))) AS area, "
        "min(prob) >= 0 AND max(prob) <= 1 AS bounded FROM (SELECT *, rank() OVER (PARTITION BY fold ORDER BY prob) "
        "+ (count(*) OVER (PARTITION BY fold, prob) - 1) / 2 AS r FROM {scores}) GROUP BY fold",
        scores=scores,
    )
    joined = found.join(by_sql, F.col("fold") == F.col("f"))
    return joined.select(
        "fold", "n", "positives", "train_n", "train_positives", (F.abs(F.col("roc_auc") - F.col("area")) < 1e-9).alias("area_as_in_sql"),
        F.col("roc_auc").between(0, 1).alias("area_in_range"), F.col("bounded").alias("scores_in_range"),
    )

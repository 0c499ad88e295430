"""Classifier metrics on two labelled scores: document length against toxicity, and order price against status."""

from __future__ import annotations

from pyspark.sql import functions as F

from checks.registry import query, rounded, table
from marquee.functions.stats import at_least
from marquee.operators import metrics

CUT = 250000.0


def documents(spark, sf):
    labels = table(spark, sf, "labels").select("doc_id", F.col("toxic").alias("label"))
    return labels.join(table(spark, sf, "documents").select("doc_id", F.col("n_chars").cast("double").alias("prob")), "doc_id")


def orders(spark, sf):
    label = (F.col("o_orderstatus") == "F").cast("int")
    prob = F.floor(F.col("o_totalprice") / 10) / 50000
    scored = table(spark, sf, "orders").select(F.col("o_orderkey").alias("imdb_id"), label.alias("label"), prob.alias("prob"))
    return scored.withColumn("pred", at_least(F.col("prob"), 0.5))


_DOCUMENTS_SQL = "s AS (SELECT toxic AS label, CAST(n_chars AS DOUBLE) AS prob FROM labels JOIN documents USING (doc_id))"
_ORDERS_SQL = (
    "s AS (SELECT o_orderkey AS imdb_id, CAST(o_orderstatus = 'F' AS INTEGER) AS label, floor(o_totalprice / 10) / 50000 AS prob, "
    "CAST(floor(o_totalprice / 10) / 50000 >= 0.5 AS INTEGER) AS pred FROM orders)"
)
_CURVE_SQL = """g AS (SELECT prob, sum(label) AS pos, count(*) AS n FROM s GROUP BY prob),
c AS (SELECT prob AS threshold, sum(pos) OVER w AS tp, sum(n) OVER w AS called, (SELECT sum(label) FROM s) AS p FROM g WINDOW w AS (ORDER BY prob DESC)),
curve AS (SELECT threshold, CAST(tp AS DOUBLE) / called AS precision, CAST(tp AS DOUBLE) / p AS recall FROM c
  UNION ALL SELECT NULL, 1.0, 0.0)"""

for _name, _sql, _frame in (("documents", _DOCUMENTS_SQL, documents), ("orders", _ORDERS_SQL, orders)):

    def _curve(frame=_frame):
        return lambda spark, sf: rounded(metrics.precision_recall_curve(frame(spark, sf), "prob"))

    def _auc(frame=_frame):
        return lambda spark, sf: rounded(metrics.roc_auc(frame(spark, sf), "prob"))

    def _threshold(mode, frame=_frame):
        return lambda spark, sf: rounded(metrics.best_threshold(metrics.precision_recall_curve(frame(spark, sf), "prob"), 0.90, mode))

    query(
        f"pr_curve_{_name}",
        f"WITH {_sql}, {_CURVE_SQL} SELECT round(threshold, 6) AS threshold, round(precision, 6) AS precision, round(recall, 6) AS recall FROM curve",
    )(_curve())
    query(
        f"roc_auc_{_name}",
        f"WITH {_sql}, r AS (SELECT label, rank() OVER (ORDER BY prob) + (count(*) OVER (PARTITION BY prob) - 1) / 2.0 AS r FROM s) "
        "SELECT round((sum(r) FILTER (label = 1) - count(*) FILTER (label = 1) * (count(*) FILTER (label = 1) + 1) / 2.0) "
        "/ (CAST(count(*) FILTER (label = 1) AS DOUBLE) * count(*) FILTER (label = 0)), 6) AS roc_auc FROM r",
    )(_auc())
    query(
        f"best_threshold_{_name}",
        f"WITH {_sql}, {_CURVE_SQL} SELECT round(min(threshold), 6) AS threshold FROM curve WHERE recall <= 0.9 AND threshold IS NOT NULL",
    )(_threshold("at_most"))
    query(
        f"safe_threshold_{_name}",
        f"WITH {_sql}, {_CURVE_SQL} SELECT round(max(threshold), 6) AS threshold FROM curve WHERE recall >= 0.9 AND threshold IS NOT NULL",
    )(_threshold("at_least"))


@query(
    "class_report",
    f"""WITH {_ORDERS_SQL}, k AS (
      SELECT CAST(count(*) FILTER (label = 1 AND pred = 1) AS DOUBLE) AS tp, CAST(count(*) FILTER (label = 0 AND pred = 1) AS DOUBLE) AS fp,
        CAST(count(*) FILTER (label = 1 AND pred = 0) AS DOUBLE) AS fn, CAST(count(*) FILTER (label = 0 AND pred = 0) AS DOUBLE) AS tn FROM s),
    c AS (SELECT '0' AS class, tn / (tn + fn) AS p, tn / (tn + fp) AS r, tn + fp AS s FROM k UNION ALL SELECT '1', tp / (tp + fp), tp / (tp + fn), tp + fn FROM k),
    f AS (SELECT class, p, r, 2 * p * r / (p + r) AS f1, s FROM c)
    SELECT class, round(p, 6) AS precision, round(r, 6) AS recall, round(f1, 6) AS f1, CAST(s AS BIGINT) AS support FROM f
    UNION ALL SELECT 'accuracy', round((tp + tn) / (tp + fp + fn + tn), 6), round((tp + tn) / (tp + fp + fn + tn), 6), round((tp + tn) / (tp + fp + fn + tn), 6), CAST(tp + fp + fn + tn AS BIGINT) FROM k
    UNION ALL SELECT 'macro avg', round(avg(p), 6), round(avg(r), 6), round(avg(f1), 6), CAST(sum(s) AS BIGINT) FROM f
    UNION ALL SELECT 'weighted avg', round(sum(p * s) / sum(s), 6), round(sum(r * s) / sum(s), 6), round(sum(f1 * s) / sum(s), 6), CAST(sum(s) AS BIGINT) FROM f""",
)
def _(spark, sf):
    return rounded(metrics.classification_report(orders(spark, sf)))


@query("misses", f"WITH {_ORDERS_SQL} SELECT imdb_id, label, round(prob, 6) AS prob, pred FROM s WHERE label = 1 AND pred = 0")
def _(spark, sf):
    return rounded(metrics.missed(orders(spark, sf)))


@query("hits", f"WITH {_ORDERS_SQL} SELECT imdb_id, label, round(prob, 6) AS prob, pred FROM s WHERE label = 1 AND pred = 1")
def _(spark, sf):
    return rounded(metrics.hits(orders(spark, sf)))


@query("top_candidates", f"WITH {_ORDERS_SQL} SELECT imdb_id, round(prob, 6) AS prob FROM s ORDER BY s.prob DESC, imdb_id LIMIT 20")
def _(spark, sf):
    return rounded(metrics.top_candidates(orders(spark, sf), "prob", 20).select("imdb_id", "prob"))

"""Score features of whole-number and fractional scores."""

from __future__ import annotations

from pyspark.sql import functions as F

from checks import film
from checks.registry import query, rounded, table
from marquee.operators.scores import score_features

_LINES = film.FILM_SQL[film.FILM_SQL.index("lines AS") : film.FILM_SQL.index("rating_samples AS")]


def score_sql(samples: str) -> str:
    """`samples` selects film and v, the cleaned score."""
    return f"""
WITH {_LINES}
s AS ({samples}),
base AS (
  SELECT film, count(v) AS n, avg(v) AS mean, quantile_cont(v, 0.5) AS med, quantile_cont(v, 0.75) - quantile_cont(v, 0.25) AS iqr,
    avg(CAST(v >= 90 AS INTEGER)) AS p90, avg(CAST(v >= 80 AS INTEGER)) AS p80,
    avg(CAST(v >= 61 AND v <= 100 AS INTEGER)) AS pg, avg(CAST(v >= 40 AND v <= 60 AS INTEGER)) AS py,
    avg(CAST(v >= 0 AND v <= 39 AS INTEGER)) AS pr
  FROM s GROUP BY film),
r AS (SELECT film, v, row_number() OVER (PARTITION BY film ORDER BY v) AS rn FROM s WHERE v IS NOT NULL),
t AS (
  SELECT film, n,
    avg(v) FILTER (rn > floor(n * CAST(0.1 AS DOUBLE)) AND rn <= n - floor(n * CAST(0.1 AS DOUBLE))) AS tm10,
    avg(v) FILTER (rn > floor(n * CAST(0.2 AS DOUBLE)) AND rn <= n - floor(n * CAST(0.2 AS DOUBLE))) AS tm20,
    CASE WHEN min(v) = max(v) THEN 0 ELSE avg(pow(v - mean, 2)) END AS m2, avg(pow(v - mean, 3)) AS m3,
    avg(pow(v - mean, 4)) AS m4, 1.4826 * quantile_cont(abs(v - med), 0.5) AS mad
  FROM r JOIN base USING (film) GROUP BY film, n)
SELECT film, base.n AS n_reviews, round(mean, 6) AS mean, round(med, 6) AS median, round(tm10, 6) AS trimmed_mean_10,
  round(tm20, 6) AS trimmed_mean_20,
  round(CASE WHEN base.n = 1 THEN 0 WHEN base.n > 1 THEN sqrt(m2 * base.n / (base.n - 1)) END, 6) AS std, round(iqr, 6) AS iqr,
  round(mad, 6) AS mad,
  round(CASE WHEN base.n >= 3 THEN CASE WHEN m2 = 0 THEN 0 ELSE sqrt(CAST(base.n AS DOUBLE) * (base.n - 1)) / (base.n - 2) * m3 / pow(m2, 1.5) END END, 6) + 0 AS skewness,
  round(CASE WHEN base.n >= 4 THEN CASE WHEN m2 = 0 THEN 0 ELSE m4 / (m2 * m2) - 3 END END, 6) + 0 AS excess_kurtosis,
  round(p90, 6) AS p_ge_90, round(p80, 6) AS p_ge_80, round(pg, 6) AS p_green_61_100, round(py, 6) AS p_yellow_40_60,
  round(pr, 6) AS p_red_0_39,
  round(CASE WHEN pg > 0 OR py > 0 OR pr > 0 THEN
    CASE WHEN pg > 0 THEN -pg * log2(pg) ELSE 0 END + CASE WHEN py > 0 THEN -py * log2(py) ELSE 0 END
    + CASE WHEN pr > 0 THEN -pr * log2(pr) ELSE 0 END END, 6) AS entropy_gyr_bits
FROM base LEFT JOIN t USING (film)
""".strip()


@query("score_features", score_sql("SELECT l_orderkey AS film, CAST(l_quantity * 2 AS INTEGER) AS v FROM lines"))
def _(spark, sf):
    scores = film.lines(spark, sf).select(F.col("l_orderkey").alias("film"), (F.col("l_quantity") * 2).cast("int").alias("score"))
    return rounded(score_features(scores))


_FRACTION_SQL = (
    "SELECT l_orderkey AS film, CASE WHEN l_tax > 0 THEN greatest(0, least(100, l_extendedprice / 487 - 5)) END AS v FROM lineitem"
)


@query("score_features_fractional", score_sql(_FRACTION_SQL))
def _(spark, sf):
    score = F.when(F.col("l_tax") > 0, F.col("l_extendedprice") / 487 - 5).when(F.col("l_discount") > 0, F.lit(float("nan")))
    return rounded(score_features(table(spark, sf, "lineitem").select(F.col("l_orderkey").alias("film"), score.alias("score"))))


@query("score_features_by_part", score_sql("SELECT l_partkey AS film, CAST(l_quantity * 2 AS INTEGER) AS v FROM lineitem"))
def _(spark, sf):
    lines = table(spark, sf, "lineitem")
    return rounded(score_features(lines.select(F.col("l_partkey").alias("film"), (F.col("l_quantity") * 2).cast("int").alias("score"))))


@query(
    "score_features_hub",
    score_sql(
        "SELECT CASE WHEN l_linenumber <= 2 THEN -1 ELSE l_orderkey END AS film, greatest(0, least(100, l_extendedprice / 487 - 5)) AS v FROM lineitem"
    ),
)
def _(spark, sf):
    """One film holds more than a quarter of all scores, with thousands of distinct values."""
    hub = F.when(F.col("l_linenumber") <= 2, F.lit(-1)).otherwise(F.col("l_orderkey"))
    scores = table(spark, sf, "lineitem").select(hub.alias("film"), (F.col("l_extendedprice") / 487 - 5).alias("score"))
    return rounded(score_features(scores))

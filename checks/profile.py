"""Exploration queries on the derived film tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from checks import film
from checks.features import dataset
from checks.film import film_sql
from checks.registry import query, rounded, table
from marquee.operators import profile, relations

DESCRIBED = ["imdb_rating", "imdb_votes", "runtime_minutes", "metascore"]
CORRELATED = ["release_year", "imdb_rating", "imdb_votes", "runtime_minutes", "metascore"]


def labelled(spark, sf):
    return film.movies(spark, sf).withColumn("label", F.col("nominated_oscar").cast("int"))


@query(
    "class_balance",
    film_sql(
        "SELECT CAST(nominated_oscar AS INTEGER) AS label, count(*) AS n, round(100.0 * count(*) / sum(count(*)) OVER (), 6) AS percentage, "
        "round(CAST(max(count(*)) OVER () AS DOUBLE) / count(*), 6) AS ratio FROM movies GROUP BY nominated_oscar"
    ),
)
def _(spark, sf):
    return rounded(profile.class_balance(labelled(spark, sf)))


@query(
    "per_year",
    film_sql("SELECT release_year, count(*) AS films, count(*) FILTER (nominated_oscar) AS nominated FROM movies GROUP BY release_year"),
)
def _(spark, sf):
    return profile.per_year(labelled(spark, sf))


@query(
    "missing_summary",
    film_sql(
        "SELECT * FROM (SELECT 'metascore' AS \"column\", count(*) FILTER (metascore IS NULL) AS missing_count, "
        "round(100.0 * count(*) FILTER (metascore IS NULL) / count(*), 6) AS missing_percentage FROM movies "
        "UNION ALL SELECT 'worldwide_gross', count(*) FILTER (worldwide_gross IS NULL), round(100.0 * count(*) FILTER (worldwide_gross IS NULL) / count(*), 6) FROM movie_box_office) "
        "WHERE missing_count > 0"
    ),
)
def _(spark, sf):
    wide = labelled(spark, sf).join(film.box_office(spark, sf).withColumnRenamed("movie_id", "imdb_id"), "imdb_id")
    return rounded(profile.missing_summary(wide.select("imdb_id", "release_year", "metascore", "worldwide_gross", "budget")))


@query(
    "describe",
    film_sql(
        " UNION ALL ".join(
            f"SELECT '{c}' AS \"column\", count({c}) AS count, round(avg(CAST({c} AS DOUBLE)), 4) AS mean, round(stddev_samp(CAST({c} AS DOUBLE)), 4) AS std, "
            f"round(min(CAST({c} AS DOUBLE)), 4) AS min, round(quantile_cont(CAST({c} AS DOUBLE), 0.25), 4) AS q25, round(quantile_cont(CAST({c} AS DOUBLE), 0.5), 4) AS q50, "
            f"round(quantile_cont(CAST({c} AS DOUBLE), 0.75), 4) AS q75, round(max(CAST({c} AS DOUBLE)), 4) AS max FROM movies"
            for c in DESCRIBED
        )
    ),
)
def _(spark, sf):
    return rounded(profile.describe(film.movies(spark, sf), DESCRIBED), 4)


_LINE_NUMBERS = ["l_quantity", "l_extendedprice", "l_discount"]


@query(
    "describe_lines",
    " UNION ALL ".join(
        f"SELECT '{c}' AS \"column\", count({c}) AS count, round(avg({c}), 4) AS mean, round(stddev_samp({c}), 4) AS std, round(min({c}), 4) AS min, "
        f"round(quantile_cont({c}, 0.25), 4) AS q25, round(quantile_cont({c}, 0.5), 4) AS q50, round(quantile_cont({c}, 0.75), 4) AS q75, round(max({c}), 4) AS max FROM lineitem"
        for c in _LINE_NUMBERS
    ),
)
def _(spark, sf):
    """The way for large data: ranks are narrowed in passes instead of collected in one task."""
    return rounded(profile.describe(table(spark, sf, "lineitem"), _LINE_NUMBERS, small_rows=0), 4)


@query(
    "corr_matrix",
    film_sql(
        " UNION ALL ".join(
            f"SELECT '{a}' AS a, '{b}' AS b, round(corr(CAST({a} AS DOUBLE), CAST({b} AS DOUBLE)), 6) AS correlation FROM movies"
            for a in CORRELATED
            for b in CORRELATED
        )
    ),
)
def _(spark, sf):
    return rounded(profile.correlation_matrix(film.movies(spark, sf), CORRELATED))


@query(
    "histogram",
    """WITH e AS (SELECT min(o_totalprice) AS lo, max(o_totalprice) AS hi FROM orders),
       c AS (SELECT CAST(least(floor((o_totalprice - lo) * 30 / (hi - lo)), 29) AS INTEGER) AS bin, count(*) AS n FROM orders, e GROUP BY 1)
       SELECT CAST(b AS INTEGER) AS bin, round(lo + b * ((hi - lo) / 30), 4) AS low, round(lo + (b + 1) * ((hi - lo) / 30), 4) AS high, coalesce(n, 0) AS n
       FROM range(30) AS r(b) CROSS JOIN e LEFT JOIN c ON c.bin = b""",
)
def _(spark, sf):
    return rounded(profile.histogram(table(spark, sf, "orders"), "o_totalprice"), 4)


@query(
    "by_class",
    film_sql(
        " UNION ALL ".join(
            f"SELECT '{c}' AS feature, CAST(nominated_oscar AS INTEGER) AS label, count({c}) AS n, round(avg(CAST({c} AS DOUBLE)), 4) AS mean, "
            f"round(quantile_cont(CAST({c} AS DOUBLE), 0.5), 4) AS median, round(min(CAST({c} AS DOUBLE)), 4) AS min, round(max(CAST({c} AS DOUBLE)), 4) AS max "
            "FROM movies GROUP BY nominated_oscar"
            for c in DESCRIBED
        )
    ),
)
def _(spark, sf):
    return rounded(profile.by_class(labelled(spark, sf), DESCRIBED), 4)


@query(
    "top_categories",
    film_sql(
        "SELECT name, count(*) AS n FROM movie_languages JOIN languages ON id = language_id GROUP BY name ORDER BY n DESC, name LIMIT 15"
    ),
)
def _(spark, sf):
    named = relations.bridge_with_names(
        film.part_bridge(spark, sf, "p_brand", "language_id"), film.part_dimension(spark, sf, "p_brand"), "language_id", "name"
    )
    return profile.top_categories(named, "name", 15)


@query("role_totals", film_sql("SELECT role, count(*) AS n FROM movie_people GROUP BY role"))
def _(spark, sf):
    return profile.role_totals(film.movie_people(spark, sf))


@query(
    "corpus_summary",
    film_sql(
        "SELECT count(*) AS films, count(*) FILTER (nominated_oscar) AS nominated, min(release_year) AS first_year, max(release_year) AS last_year FROM movies"
    ),
)
def _(spark, sf):
    return profile.corpus_summary(film.movies(spark, sf))


@query(
    "collection_summary",
    film_sql(
        "SELECT count(*) AS films, count(*) FILTER (nominated_oscar) AS nominees, count(*) FILTER (won_oscar) AS winners, "
        "count(*) FILTER (NOT nominated_oscar) AS others, round(sum(coalesce(CAST(imdb_rating AS DOUBLE), 0)) / count(*), 2) AS mean_rating, "
        "CAST(sum(imdb_votes) // count(*) AS BIGINT) AS mean_votes, (SELECT count(*) FROM events WHERE event_type = 'error') AS errors FROM movies"
    ),
)
def _(spark, sf):
    rows = film.movies(spark, sf).select(
        F.col("nominated_oscar").alias("nominated"), F.col("won_oscar").alias("winner"), F.col("imdb_rating").alias("rating"), F.col("imdb_votes").alias("votes")
    )
    return profile.collection_summary(rows, table(spark, sf, "events").filter(F.col("event_type") == "error"))


@query(
    "run_tally",
    """SELECT count(*) AS processed, count(*) FILTER (event_type <> 'error') AS success, count(*) FILTER (event_type = 'error') AS errors,
       round(100.0 * count(*) FILTER (event_type <> 'error') / count(*), 6) AS success_rate FROM events""",
)
def _(spark, sf):
    status = F.when(F.col("event_type") == "error", "error").otherwise("ok")
    return rounded(profile.run_tally(table(spark, sf, "events").select(status.alias("status"))))


@query(
    "feature_missing",
    film_sql(
        "SELECT * FROM (SELECT 'metascore' AS \"column\", count(*) FILTER (metascore IS NULL) AS missing_count, "
        "round(100.0 * count(*) FILTER (metascore IS NULL) / count(*), 6) AS missing_percentage FROM ml_training_dataset) WHERE missing_count > 0"
    ),
)
def _(spark, sf):
    return rounded(profile.missing_summary(dataset(spark, sf)))

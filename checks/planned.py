"""Further features and evaluations."""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from checks import film
from checks.features import dataset
from checks.film import film_sql
from checks.metrics import _ORDERS_SQL, orders
from checks.profile import labelled
from checks.registry import query, rounded, table
from marquee.functions import stats, text
from marquee.operators import planned, relations
from marquee.operators.history import earlier_successes
from marquee.plans import features

_NUMBERS = ["imdb_rating", "imdb_votes", "runtime_minutes"]


@query(
    "money_ratios",
    film_sql(
        "SELECT imdb_id, CAST(worldwide_gross AS DOUBLE) / CAST(budget AS DOUBLE) AS roi_worldwide, "
        "CAST(domestic_gross AS DOUBLE) / CAST(worldwide_gross AS DOUBLE) AS us_market_share, "
        "CAST(worldwide_gross AS DOUBLE) / runtime_minutes AS revenue_per_minute, "
        "CASE WHEN budget < 50000 THEN 'low' WHEN budget < 150000 THEN 'medium' ELSE 'high' END AS budget_category "
        "FROM movies JOIN movie_box_office ON movie_id = imdb_id"
    ),
)
def _(spark, sf):
    wide = film.movies(spark, sf).join(film.box_office(spark, sf).withColumnRenamed("movie_id", "imdb_id"), "imdb_id")
    out = planned.money_ratios(wide, 50000, 150000)
    return out.select("imdb_id", "roi_worldwide", "us_market_share", "revenue_per_minute", "budget_category")


@query(
    "director_wins",
    film_sql(
        "SELECT m.imdb_id AS movie_id, count(DISTINCT m2.imdb_id) AS prev_wins FROM movies m JOIN movie_people a ON a.movie_id = m.imdb_id AND a.role = 'director' "
        "JOIN movie_people b ON b.person_id = a.person_id JOIN movies m2 ON m2.imdb_id = b.movie_id "
        "WHERE m2.release_year < m.release_year AND m2.won_oscar GROUP BY m.imdb_id"
    ),
)
def _(spark, sf):
    return earlier_successes(film.movies(spark, sf), film.movie_people(spark, sf), {"prev_wins": "director"}, success="won_oscar")


@query(
    "winsorised",
    film_sql("").rstrip()
    + ", q AS (SELECT quantile_cont(CAST(imdb_votes AS DOUBLE), 0.05) AS lo, quantile_cont(CAST(imdb_votes AS DOUBLE), 0.95) AS hi FROM movies) "
    "SELECT imdb_id, round(greatest(lo, least(hi, CAST(imdb_votes AS DOUBLE))), 4) AS imdb_votes, "
    "round(ln(1 + greatest(lo, least(hi, CAST(imdb_votes AS DOUBLE)))), 6) AS log_imdb_votes, CAST(metascore IS NULL AS INTEGER) AS metascore_missing FROM movies, q",
)
def _(spark, sf):
    clipped = planned.winsorise(film.movies(spark, sf), ["imdb_votes"], 0.05, 0.95)
    out = planned.missing_flags(planned.log_columns(clipped, ["imdb_votes"]), ["metascore"])
    out = out.select("imdb_id", F.round("imdb_votes", 4).alias("imdb_votes"), F.round("log_imdb_votes", 6).alias("log_imdb_votes"), "metascore_missing")
    return out


@query(
    "scaled",
    film_sql("").rstrip()
    + ", q AS (SELECT min(imdb_votes) AS lo, max(imdb_votes) AS hi, quantile_cont(CAST(runtime_minutes AS DOUBLE), 0.5) AS med, "
    "quantile_cont(CAST(runtime_minutes AS DOUBLE), 0.75) - quantile_cont(CAST(runtime_minutes AS DOUBLE), 0.25) AS iqr FROM movies) "
    "SELECT imdb_id, round((imdb_votes - lo) / CAST(hi - lo AS DOUBLE), 6) AS imdb_votes, round((runtime_minutes - med) / iqr, 6) AS runtime_minutes FROM movies, q",
)
def _(spark, sf):
    out = planned.robust_scale(planned.min_max_scale(film.movies(spark, sf), ["imdb_votes"]), ["runtime_minutes"])
    return rounded(out.select("imdb_id", "imdb_votes", "runtime_minutes"))


@query(
    "mode_filled",
    film_sql("").rstrip()
    + ", m AS (SELECT metascore AS v FROM movies WHERE metascore IS NOT NULL GROUP BY metascore ORDER BY count(*) DESC, metascore LIMIT 1) "
    "SELECT imdb_id, coalesce(metascore, v) AS metascore FROM movies, m",
)
def _(spark, sf):
    return planned.fill_with_mode(film.movies(spark, sf), "metascore").select("imdb_id", "metascore")


@query(
    "keyword_flags",
    r"SELECT doc_id, CAST(regexp_matches(text, '(?i)(?:^|[^\p{L}\p{N}_])(?:the|and)(?:$|[^\p{L}\p{N}_])') AS INTEGER) AS english, "
    r"CAST(regexp_matches(text, '(?i)(?:^|[^\p{L}\p{N}_])(?:le|la)(?:$|[^\p{L}\p{N}_])') AS INTEGER) AS french FROM documents",
)
def _(spark, sf):
    flagged = planned.keyword_flags(table(spark, sf, "documents"), "text", {"english": "the|and", "french": "le|la"})
    return flagged.select("doc_id", "english", "french")


@query(
    "tf_idf",
    r"""
WITH word AS (SELECT doc_id, unnest(regexp_split_to_array(lower(coalesce(text, '')), '\s+')) AS term FROM documents),
tf AS (SELECT doc_id, term, count(*) AS tf FROM word WHERE term <> '' GROUP BY doc_id, term),
df AS (SELECT term, count(*) AS df FROM tf GROUP BY term)
SELECT doc_id, term, tf, df, round(tf * ln(((SELECT count(*) FROM documents) + 1) / (df + 1)), 6) AS weight FROM tf JOIN df USING (term)
""",
)
def tf_idf(spark, sf):
    return rounded(planned.tf_idf(table(spark, sf, "documents"), "doc_id", "text"))


@query(
    "top_indicators",
    film_sql("").rstrip()
    + ", n AS (SELECT movie_id, name FROM movie_languages JOIN languages ON id = language_id), "
    "t AS (SELECT name, row_number() OVER (ORDER BY count(*) DESC, name) AS k FROM n GROUP BY name) "
    "SELECT movie_id, CAST(max(CASE WHEN k = 1 THEN 1 ELSE 0 END) AS INTEGER) AS top_1, CAST(max(CASE WHEN k = 2 THEN 1 ELSE 0 END) AS INTEGER) AS top_2, "
    "CAST(max(CASE WHEN k = 3 THEN 1 ELSE 0 END) AS INTEGER) AS top_3 FROM n JOIN t USING (name) GROUP BY movie_id",
)
def _(spark, sf):
    named = relations.bridge_with_names(
        film.part_bridge(spark, sf, "p_brand", "language_id"), film.part_dimension(spark, sf, "p_brand"), "language_id", "name"
    )
    return planned.indicator_columns(named, "name", 3, "top_")


@query(
    "inflation_adjusted",
    film_sql("").rstrip()
    + ", i AS (SELECT release_year AS year, 1000.0 / count(*) AS factor FROM movies GROUP BY release_year) "
    "SELECT imdb_id, round(CAST(imdb_votes AS DOUBLE) * CAST(factor AS DOUBLE), 4) AS imdb_votes_adjusted FROM movies JOIN i ON year = release_year",
)
def _(spark, sf):
    movies = film.movies(spark, sf)
    index = movies.groupBy(F.col("release_year").alias("year")).agg((F.lit(1000.0) / F.count(F.lit(1))).alias("factor"))
    return rounded(planned.adjust_for_inflation(movies, index, ["imdb_votes"]).select("imdb_id", "imdb_votes_adjusted"), 4)


@query(
    "welch_test",
    film_sql("").rstrip()
    + ", u AS (SELECT nominated_oscar AS k, unnest(['imdb_rating', 'imdb_votes', 'runtime_minutes']) AS feature, "
    "unnest([CAST(imdb_rating AS DOUBLE), CAST(imdb_votes AS DOUBLE), CAST(runtime_minutes AS DOUBLE)]) AS x FROM movies), "
    "g AS (SELECT feature, count(x) FILTER (NOT k) AS n0, count(x) FILTER (k) AS n1, avg(x) FILTER (NOT k) AS m0, avg(x) FILTER (k) AS m1, "
    "var_samp(x) FILTER (NOT k) / count(x) FILTER (NOT k) AS e0, var_samp(x) FILTER (k) / count(x) FILTER (k) AS e1 FROM u GROUP BY feature) "
    "SELECT feature, round((m1 - m0) / sqrt(e0 + e1), 6) AS t, round(pow(e0 + e1, 2) / (e0 * e0 / (n0 - 1) + e1 * e1 / (n1 - 1)), 4) AS degrees_of_freedom FROM g",
)
def _(spark, sf):
    out = planned.welch_test(labelled(spark, sf), _NUMBERS)
    return out.select("feature", F.round("t", 6).alias("t"), F.round("degrees_of_freedom", 4).alias("degrees_of_freedom"))


@query(
    "yearly_trend",
    film_sql(
        "SELECT release_year, count(*) AS films, round(avg(CAST(nominated_oscar AS DOUBLE)), 6) AS positive_share, "
        "round(avg(CAST(imdb_rating AS DOUBLE)), 6) AS mean_imdb_rating FROM movies GROUP BY release_year"
    ),
)
def _(spark, sf):
    return rounded(planned.yearly_trend(labelled(spark, sf), ["imdb_rating"]))


@query(
    "category_by_class",
    film_sql(
        "SELECT name, count(*) FILTER (NOT nominated_oscar) AS n_0, count(*) FILTER (nominated_oscar) AS n_1 "
        "FROM movie_genres JOIN genres ON genres.id = genre_id JOIN movies ON imdb_id = movie_id GROUP BY name"
    ),
)
def _(spark, sf):
    named = relations.bridge_with_names(
        film.part_bridge(spark, sf, "p_type", "genre_id"), film.part_dimension(spark, sf, "p_type"), "genre_id", "name"
    )
    return planned.category_by_class(named, labelled(spark, sf), "name")


@query(
    "calibration",
    f"WITH {_ORDERS_SQL} SELECT CAST(least(floor(prob * 10), 9) AS INTEGER) AS bin, count(*) AS n, round(avg(prob), 6) AS mean_score, "
    "round(avg(CAST(label AS DOUBLE)), 6) AS observed_share FROM s GROUP BY 1",
)
def _(spark, sf):
    return rounded(planned.calibration(orders(spark, sf)))


@query(
    "release_dates",
    "SELECT o_orderkey, CAST(month(o_orderdate) AS INTEGER) AS release_month, CAST(month(o_orderdate) >= 10 AS INTEGER) AS is_late_year_release, "
    "CAST(date_diff('day', CAST(o_orderdate AS DATE), make_date(year(o_orderdate) + 1, 3, 10)) AS INTEGER) AS days_to_oscar_ceremony, "
    "CAST(date_sub('month', CAST(o_orderdate AS DATE), make_date(year(o_orderdate) + 1, 3, 10)) AS INTEGER) AS ceremony_delay FROM orders WHERE year(o_orderdate) < 2001 "
    "UNION ALL SELECT o_orderkey, CAST(month(o_orderdate) AS INTEGER), CAST(month(o_orderdate) >= 10 AS INTEGER), NULL, NULL FROM orders WHERE year(o_orderdate) >= 2001",
)
def _(spark, sf):
    """The ceremony is on the tenth of March of the year after; the last years have none yet."""
    films = table(spark, sf, "orders").select("o_orderkey", "o_orderdate", F.year("o_orderdate").alias("release_year"))
    held = films.filter("release_year < 2001").select(F.col("release_year").alias("year")).distinct()
    held = held.withColumn("ceremony_date", F.make_date(F.col("year") + 1, F.lit(3), F.lit(10)))
    return planned.release_date_features(films, "o_orderdate", held).drop("o_orderdate", "release_year")


@query(
    "scores_as_int",
    "SELECT l_orderkey, l_linenumber, CAST(trunc((l_extendedprice - 30000) / 1000) AS INTEGER) AS score, "
    "round_even(CAST(l_extendedprice AS DOUBLE) - 30000, 0) / 1000 AS shown FROM lineitem",
)
def _(spark, sf):
    """Scores with fractions and signs as whole numbers, and as they are shown."""
    x = ((F.col("l_extendedprice") - 30000) / 1000).cast("double")
    return table(spark, sf, "lineitem").select("l_orderkey", "l_linenumber", text.score_to_int(x).alias("score"), stats.display_round(x).alias("shown"))


@query("retrain_range", film_sql("SELECT imdb_id, label FROM ml_training_dataset WHERE release_year BETWEEN 1995 AND 2000"))
def _(spark, sf):
    """All labelled years up to the last one tested."""
    return features.split(dataset(spark, sf), 1995, 2000).select("imdb_id", "label")


@query(
    "undersampled",
    film_sql(
        "SELECT CAST(nominated_oscar AS INTEGER) AS label, count(*) AS n, true AS as_many_as_the_smaller FROM movies GROUP BY nominated_oscar"
    ),
)
def _(spark, sf):
    """The smaller class stays whole; the larger one comes down to its size, to within six standard deviations."""
    films = labelled(spark, sf)
    count = lambda df, name: df.groupBy("label").agg(F.count(F.lit(1)).alias(name))
    both = count(films, "n").join(count(planned.undersample(films), "kept"), "label")
    least = both.agg(F.min("n").alias("least"))
    near = F.abs(F.col("kept") - F.col("least")) <= F.when(F.col("n") == F.col("least"), 0).otherwise(6 * F.sqrt("least"))
    return both.crossJoin(F.broadcast(least)).select(F.col("label").cast("int").alias("label"), "n", near.alias("as_many_as_the_smaller"))


@query(
    "redundant_features",
    "SELECT name FROM (SELECT abs(corr(l_quantity, 2 * l_quantity + l_discount)) AS twice, abs(corr(l_quantity, l_tax)) AS tax, "
    "greatest(abs(corr(l_tax, -l_tax)), 0) AS less FROM lineitem), (VALUES ('twice'), ('l_tax'), ('less')) AS t(name) "
    "WHERE CASE name WHEN 'twice' THEN twice > 0.95 WHEN 'l_tax' THEN tax > 0.95 ELSE less > 0.95 END",
)
def _(spark, sf):
    lines = table(spark, sf, "lineitem").select("l_quantity", (2 * F.col("l_quantity") + F.col("l_discount")).alias("twice"), "l_tax", (-F.col("l_tax")).alias("less"))
    return spark.createDataFrame([(c,) for c in planned.redundant_features(lines, lines.columns)], "name STRING")


@query("shuffled_column", film_sql("SELECT imdb_votes, count(*) AS n, true AS most_moved FROM movies GROUP BY imdb_votes"))
def _(spark, sf):
    """A shuffled column has the same values, on other films."""
    films = film.movies(spark, sf).select("imdb_id", "imdb_votes")
    moved = planned.shuffled_column(films, "imdb_votes", "imdb_id")
    both = moved.join(films.withColumnRenamed("imdb_votes", "was"), "imdb_id")
    share = both.agg((F.avg((F.col("was") != F.col("imdb_votes")).cast("double")) > 0.9).alias("most_moved"))
    return moved.groupBy("imdb_votes").agg(F.count(F.lit(1)).alias("n")).crossJoin(F.broadcast(share))


@query(
    "people_in_order",
    film_sql(
        "SELECT movie_id, person_id, role, row_number() OVER (PARTITION BY movie_id ORDER BY CASE role WHEN 'director' THEN 0 WHEN 'writer' THEN 1 ELSE 2 END, "
        "cast_order NULLS LAST, person_id) AS place FROM movie_people"
    ),
)
def _(spark, sf):
    """The loader's order, read off the rows as they come."""
    ordered = relations.order_people(film.movie_people(spark, sf)).withColumn("at", F.monotonically_increasing_id())
    place = F.row_number().over(Window.partitionBy("movie_id").orderBy("at")).cast("long")
    return ordered.select("movie_id", "person_id", "role", place.alias("place"))

"""Feature table queries."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from checks import film
from checks.film import film_sql
from checks.registry import query, rounded, table
from marquee.operators import relations
from marquee.operators.history import coworkers, earlier_successes
from marquee.operators.ordering import rank_in_group
from marquee.operators.scores import rating_stats
from marquee.plans import features
from marquee.session import materialise, scratch_path

DATASET = "SELECT * FROM ml_training_dataset"


_STORED: dict[tuple[str, str], DataFrame] = {}


def dataset(spark, sf):
    """The feature table, stored by year when a query of the session first needs it."""
    key = spark.sparkContext.applicationId, sf
    if key not in _STORED:
        tables = film.tables(spark, sf)
        for name in ("movies", "movie_people"):  # each is read several times, and derived once
            tables[name] = materialise(tables[name])
        links = materialise(film.part_links(spark, sf))
        for name, id_column in (("movie_genres", "genre_id"), ("movie_languages", "language_id")):
            tables[name] = film.bridge_of(links, id_column)
        computed = features.ml_training_dataset(tables, flags=film.FLAGS)
        _STORED[key] = features.store_dataset(computed, scratch_path(spark, "features"))
    return _STORED[key]


@query(
    "rating_stats",
    film_sql(
        "SELECT movie_id, n_samples, round(mean_score, 6) AS mean_score, round(median_score, 6) AS median_score, "
        "round(stddev_score, 6) AS stddev_score, round(p90_score, 6) AS p90_score, min_score, max_score FROM movie_rating_stats"
    ),
)
def _(spark, sf):
    return rounded(rating_stats(film.movies(spark, sf), film.rating_samples(spark, sf)))


@query("year_rank", film_sql("SELECT imdb_id, box_office_rank_in_year FROM ml_training_dataset"))
def _(spark, sf):
    return features.year_ranks({"movies": film.movies(spark, sf), "movie_box_office": film.box_office(spark, sf)})


@query(
    "year_zscore",
    film_sql("SELECT imdb_id, votes_normalized_by_year, rating_normalized_by_year FROM ml_training_dataset"),
)
def _(spark, sf):
    z = features.with_year_zscores(film.movies(spark, sf))
    return rounded(z.select("imdb_id", "votes_normalized_by_year", "rating_normalized_by_year"))


@query("bridge_counts", film_sql("SELECT movie_id, count(*) AS num_countries FROM movie_countries GROUP BY movie_id"))
def _(spark, sf):
    return relations.links_per_film(film.movie_countries(spark, sf), "num_countries")


@query(
    "role_counts",
    film_sql(
        "SELECT movie_id, count(*) FILTER (role = 'director') AS num_directors, count(*) FILTER (role = 'writer') AS num_writers, "
        "count(*) FILTER (role = 'cast') AS num_cast FROM movie_people GROUP BY movie_id"
    ),
)
def _(spark, sf):
    return relations.roles_per_film(film.movie_people(spark, sf), features.ROLE_COUNTS)


@query(
    "type_flags",
    film_sql(
        "SELECT movie_id, count(*) AS num_genres, max(CAST(name = 'ECONOMY' AS INTEGER)) AS is_drama, "
        "max(CAST(name = 'STANDARD' AS INTEGER)) AS is_biography, max(CAST(name = 'PROMO' AS INTEGER)) AS is_history "
        "FROM movie_genres JOIN genres ON genres.id = genre_id GROUP BY movie_id"
    ),
)
def _(spark, sf):
    return relations.genre_summary(
        film.part_bridge(spark, sf, "p_type", "genre_id"), film.part_dimension(spark, sf, "p_type"), film.FLAGS
    )


def _history(role):
    def run(spark, sf):
        return earlier_successes(film.movies(spark, sf), film.movie_people(spark, sf), {"prev_nominations": role})

    return run


query("pedigree_director", film_sql("SELECT imdb_id AS movie_id, n AS prev_nominations FROM director_history"))(_history("director"))
query("pedigree_cast", film_sql("SELECT imdb_id AS movie_id, n AS prev_nominations FROM cast_history"))(_history("cast"))


@query(
    "pedigree_hub",
    film_sql("").rstrip()
    + """, hub AS (SELECT CAST(l_orderkey AS VARCHAR) AS movie_id, CASE WHEN l_linenumber <= 2 THEN -1 ELSE l_partkey END AS person_id,
  CASE l_returnflag WHEN 'R' THEN 'director' WHEN 'N' THEN 'writer' ELSE 'cast' END AS role FROM lineitem),
mine AS (SELECT DISTINCT movie_id, person_id, release_year FROM hub JOIN movies ON imdb_id = movie_id WHERE role = 'director'),
theirs AS (SELECT DISTINCT movie_id AS earlier, person_id, release_year AS yr FROM hub JOIN movies ON imdb_id = movie_id WHERE nominated_oscar)
SELECT movie_id, count(DISTINCT earlier) AS prev_nominations FROM mine JOIN theirs USING (person_id) WHERE yr < release_year GROUP BY movie_id""",
)
def _(spark, sf):
    """One person holds more than a quarter of all rows."""
    person = F.when(F.col("l_linenumber") <= 2, F.lit(-1)).otherwise(F.col("l_partkey"))
    involved = table(spark, sf, "lineitem").select(
        F.col("l_orderkey").cast("string").alias("movie_id"), person.alias("person_id"), film.role_of_flag(F.col("l_returnflag")).alias("role")
    )
    return earlier_successes(film.movies(spark, sf), involved, {"prev_nominations": "director"})


_HUBS = """, hub AS (SELECT CAST(l_orderkey AS VARCHAR) AS movie_id, CASE WHEN l_linenumber <= 3 THEN -1 - l_suppkey % 40 ELSE l_partkey END AS person_id,
  CASE l_returnflag WHEN 'R' THEN 'director' WHEN 'N' THEN 'writer' ELSE 'cast' END AS role FROM lineitem)"""


def _hubs(spark, sf):
    """Forty people hold more than a third of all rows and share films."""
    person = F.when(F.col("l_linenumber") <= 3, -1 - F.col("l_suppkey") % 40).otherwise(F.col("l_partkey"))
    return table(spark, sf, "lineitem").select(
        F.col("l_orderkey").cast("string").alias("movie_id"), person.alias("person_id"), film.role_of_flag(F.col("l_returnflag")).alias("role")
    )


@query(
    "pedigree_many_hubs",
    film_sql("").rstrip()
    + _HUBS
    + """, good AS (SELECT DISTINCT movie_id AS earlier, person_id, release_year AS yr FROM hub JOIN movies ON imdb_id = movie_id WHERE nominated_oscar),
mine AS (SELECT DISTINCT movie_id, person_id, release_year FROM hub JOIN movies ON imdb_id = movie_id WHERE role = 'director')
SELECT movie_id, count(DISTINCT earlier) AS prev_nominations FROM mine JOIN good USING (person_id) WHERE yr < release_year GROUP BY movie_id""",
)
def _(spark, sf):
    return earlier_successes(film.movies(spark, sf), _hubs(spark, sf), {"prev_nominations": "director"})


def _coworkers(role):
    return lambda spark, sf: coworkers(film.movie_people(spark, sf), role)


for _role in ("director", "cast"):
    query(
        f"coworkers_{_role}",
        film_sql(
            "SELECT a.person_id, count(DISTINCT b.person_id) - 1 AS coworkers FROM movie_people a JOIN movie_people b USING (movie_id) "
            f"WHERE a.role = '{_role}' GROUP BY a.person_id"
        ),
    )(_coworkers(_role))


@query(
    "coworkers_crowd",
    """WITH crowd AS (SELECT CASE WHEN l_linenumber = 1 THEN -1 ELSE l_orderkey END AS movie_id, l_partkey AS person_id FROM lineitem),
link AS (SELECT DISTINCT movie_id, person_id FROM crowd), big AS (SELECT person_id FROM link WHERE movie_id = -1),
small AS (SELECT a.person_id, b.person_id AS other FROM link a JOIN link b USING (movie_id) WHERE movie_id <> -1),
every AS (SELECT a.person_id, b.person_id AS other FROM big a CROSS JOIN big b UNION SELECT person_id, other FROM small UNION SELECT person_id, person_id FROM link)
SELECT person_id, count(*) - 1 AS coworkers FROM every GROUP BY person_id""",
)
def _(spark, sf):
    """One film holds a quarter of all rows."""
    crew = table(spark, sf, "lineitem").select(
        F.when(F.col("l_linenumber") == 1, F.lit(-1)).otherwise(F.col("l_orderkey")).alias("movie_id"), F.col("l_partkey").alias("person_id")
    )
    return coworkers(crew)


@query(
    "rank_with_ties",
    """SELECT o_orderkey, rank() OVER (PARTITION BY year(o_orderdate) ORDER BY CASE WHEN o_orderpriority < '3' THEN 1000.0
       WHEN o_orderpriority < '5' THEN o_totalprice END DESC NULLS LAST) AS rank_in_year FROM orders""",
)
def _(spark, sf):
    """Two fifths of the rows share one value and a fifth has none."""
    priority = F.col("o_orderpriority")
    gross = F.when(priority < "3", F.lit(1000.0)).when(priority < "5", F.col("o_totalprice"))
    rows = table(spark, sf, "orders").select("o_orderkey", F.year("o_orderdate").alias("year"), gross.alias("gross"))
    ranked = rank_in_group(rows, "year", "gross", "o_orderkey", "rank_in_year")
    return ranked.select("o_orderkey", F.col("rank_in_year").cast("long").alias("rank_in_year"))


@query(
    "rank_large_decimals",
    """SELECT o_orderkey, rank() OVER (PARTITION BY year(o_orderdate) ORDER BY CASE WHEN o_orderpriority <> '5-LOW' THEN
       CAST(floor(o_totalprice / 20000) AS HUGEINT) * 100000000000000000000::HUGEINT + o_orderkey % 7 END DESC NULLS LAST) AS rank_in_year FROM orders""",
)
def _(spark, sf):
    """Values that a double cannot tell apart, many of them equal."""
    steps = F.floor(F.col("o_totalprice") / 20000).cast("decimal(10,0)")
    gross = (steps * F.lit("100000000000000000000").cast("decimal(21,0)")).cast("decimal(38,0)") + F.col("o_orderkey") % 7
    rows = table(spark, sf, "orders").select(
        "o_orderkey", F.year("o_orderdate").alias("year"), F.when(F.col("o_orderpriority") != "5-LOW", gross.cast("decimal(38,0)")).alias("gross")
    )
    ranked = rank_in_group(rows, "year", "gross", "o_orderkey", "rank_in_year")
    return ranked.select("o_orderkey", F.col("rank_in_year").cast("long").alias("rank_in_year"))


@query("feature_table", film_sql(DATASET))
def _(spark, sf):
    return rounded(dataset(spark, sf))


def _split(first, last):
    return lambda spark, sf: rounded(features.split(dataset(spark, sf), first, last))


for _name, (_first, _last) in film.SPLITS.items():
    query(f"split_{_name}", film_sql(f"{DATASET} WHERE release_year BETWEEN {_first} AND {_last}"))(_split(_first, _last))


@query(
    "next_year_films",
    film_sql(
        "SELECT f.imdb_id, f.release_year, f.label FROM ml_training_dataset f JOIN (SELECT release_year + 1 AS year FROM movies "
        "WHERE won_oscar GROUP BY release_year HAVING count(*) >= 100 ORDER BY count(*) DESC, release_year LIMIT 2) y ON y.year = f.release_year"
    ),
)
def _(spark, sf):
    """The years are only known while the query runs: they prune the folders of the feature table as it is read."""
    won = film.movies(spark, sf).filter("won_oscar").groupBy("release_year").agg(F.count(F.lit(1)).alias("n")).filter("n >= 100")
    years = won.orderBy(F.col("n").desc(), "release_year").limit(2).select((F.col("release_year") + 1).alias("year"))
    return dataset(spark, sf).join(F.broadcast(years), F.col("release_year") == F.col("year")).select("imdb_id", "release_year", "label")

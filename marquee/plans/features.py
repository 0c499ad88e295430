"""The feature table, its temporal splits and the SQL views on them."""

from __future__ import annotations

from collections.abc import Mapping
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from marquee.functions.stats import zscore
from marquee.operators.history import HOT_PERSON, success_counts
from marquee.operators.ordering import rank_in_group
from marquee.operators.scores import rating_stats, sample_stats
from marquee.operators.sizing import broadcast_if_small
from marquee.schemas import GENRE_FLAGS, SPLITS

Tables = Mapping[str, DataFrame]

_STATS = ["n_samples", "mean_score", "median_score", "stddev_score", "p90_score", "min_score", "max_score"]
_COUNTS = ["num_genres", "num_countries", "num_languages", "num_directors", "num_writers", "num_cast"]
ROLE_COUNTS = {"num_directors": "director", "num_writers": "writer", "num_cast": "cast"}
_HISTORY = {"director_prev_nominations": "director", "cast_prev_nominations": "cast"}


def year_ranks(tables: Tables, parts: int | None = None) -> DataFrame:
    """imdb_id and its box office rank within the year; unknown grosses share the last rank."""
    gross = tables["movie_box_office"].select(F.col("movie_id").alias("imdb_id"), "worldwide_gross")
    films = tables["movies"].select("imdb_id", "release_year").join(gross, "imdb_id", "left")
    return rank_in_group(films, "release_year", "worldwide_gross", "imdb_id", "box_office_rank_in_year", parts=parts).select(
        "imdb_id", F.col("box_office_rank_in_year").cast("long").alias("box_office_rank_in_year")
    )


def with_year_zscores(movies: DataFrame) -> DataFrame:
    """Votes and rating against their year: one small row per year, joined back without moving the films."""
    votes, rating = F.col("imdb_votes").cast("double"), F.col("imdb_rating").cast("double")
    years = movies.groupBy(F.col("release_year").alias("_year")).agg(
        F.avg(votes).alias("_votes_mean"),
        F.stddev_samp(votes).alias("_votes_sd"),
        F.avg(rating).alias("_rating_mean"),
        F.stddev_samp(rating).alias("_rating_sd"),
    )
    joined = movies.join(broadcast_if_small(years), F.col("release_year").eqNullSafe(F.col("_year")), "left")
    return (
        joined.withColumn("votes_normalized_by_year", zscore(votes, F.col("_votes_mean"), F.col("_votes_sd")))
        .withColumn("rating_normalized_by_year", zscore(rating, F.col("_rating_mean"), F.col("_rating_sd")))
        .drop("_year", "_votes_mean", "_votes_sd", "_rating_mean", "_rating_sd")
    )


def relation_counts(tables: Tables, flags: Mapping[str, str] = GENRE_FLAGS) -> list[DataFrame]:
    """Per bridge, partial counts by film; still to be summed by film."""
    genres, people = tables["genres"], tables["movie_people"]
    named = genres.filter(F.col("name").isin(list(flags.values()))).select(F.col("id").alias("genre_id"), "name")
    one = F.lit(1).cast("long")
    is_role = lambda r: (F.col("role") == r).cast("long")
    return [
        tables["movie_genres"]
        .join(named, "genre_id", "left")
        .select("movie_id", one.alias("num_genres"), *[(F.col("name") == g).cast("int").alias(f) for f, g in flags.items()]),
        tables["movie_countries"].select("movie_id", one.alias("num_countries")),
        tables["movie_languages"].select("movie_id", one.alias("num_languages")),
        people.select("movie_id", *[is_role(r).alias(o) for o, r in ROLE_COUNTS.items()]),
    ]


def ml_training_dataset(
    tables: Tables,
    flags: Mapping[str, str] = GENRE_FLAGS,
    parts: int | None = None,
    hot: int = HOT_PERSON,
) -> DataFrame:
    """One row per film with 29 columns.

    Everything counted per film (relations, flags, history, rank) is put in one long frame and combined in one
    aggregate: one shuffle by film with partial sums before it, instead of a join per bridge.
    """
    movies = tables["movies"]
    pieces = [
        *relation_counts(tables, flags),
        success_counts(movies, tables["movie_people"], _HISTORY, hot=hot),
        year_ranks(tables, parts).withColumnRenamed("imdb_id", "movie_id"),
    ]
    long = reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), pieces)
    per_film = long.groupBy(F.col("movie_id").alias("imdb_id")).agg(
        *[F.sum(c).alias(c) for c in [*_COUNTS, *_HISTORY]],
        *[F.max(c).alias(c) for c in [*flags, "box_office_rank_in_year"]],
    )
    samples = sample_stats(tables["rating_samples"]).withColumnRenamed("movie_id", "imdb_id")
    wide = with_year_zscores(movies).join(per_film, "imdb_id", "left").join(samples, "imdb_id", "left")
    or_zero = lambda c: F.coalesce(F.col(c), F.lit(0)).alias(c)
    return wide.select(
        "imdb_id",
        "original_title",
        "release_year",
        "imdb_rating",
        "imdb_votes",
        "runtime_minutes",
        "metascore",
        "box_office_rank_in_year",
        "votes_normalized_by_year",
        "rating_normalized_by_year",
        *[or_zero(c) for c in _STATS],
        *[or_zero(c) for c in _COUNTS],
        *[or_zero(c) for c in _HISTORY],
        *[or_zero(c) for c in flags],
        F.col("nominated_oscar").cast("int").alias("label"),
    )


def store_dataset(dataset: DataFrame, path: str) -> DataFrame:
    """The feature table written once, a folder for each year, and read back. Years are cut into files of an even size, so
    a year with a third of all films is not one file."""
    dataset.hint("rebalance", "release_year").write.partitionBy("release_year").parquet(path)
    return read_dataset(dataset.sparkSession, path, dataset.schema)


def read_dataset(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """A stored feature table. A filter or join on release_year reads the folders of its years only."""
    return spark.read.schema(schema).parquet(path).select(*schema.names)


def split(dataset: DataFrame, first: int, last: int) -> DataFrame:
    """Films of a year range. Ranks, z-scores and history were computed on all films before; of a stored feature table only
    the years asked for are read."""
    return dataset.filter(F.col("release_year").between(first, last))


def order_dataset(dataset: DataFrame) -> DataFrame:
    return dataset.orderBy(F.col("release_year").asc_nulls_last(), F.col("imdb_id").asc_nulls_last())


def register_views(
    spark: SparkSession, tables: Tables, splits: Mapping[str, tuple[int, int]] = SPLITS, path: str | None = None, **options
) -> DataFrame:
    """Temp views for the base tables, the statistics, the feature table and its splits. With `path` the feature table is
    stored there by year, and a split reads its years; without, each use of a view computes what it shows."""
    for name, df in tables.items():
        df.createOrReplaceTempView(name)
    rating_stats(tables["movies"], tables["rating_samples"]).createOrReplaceTempView("movie_rating_stats")
    dataset = ml_training_dataset(tables, **options)
    if path is not None:
        dataset = store_dataset(dataset, path)
    dataset.createOrReplaceTempView("ml_training_dataset")
    for name, (first, last) in splits.items():
        split(dataset, first, last).createOrReplaceTempView(name)
    return dataset

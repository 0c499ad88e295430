"""Stored tables, the bundle of frames, and parameterised SQL."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from marquee.operators.relations import bridge_with_names, order_bridge, order_people
from marquee.plans.features import ml_training_dataset, order_dataset
from marquee.schemas import TABLE_DDL, table_schema


def read_tables(spark: SparkSession, folder: str) -> dict[str, DataFrame]:
    """The relational tables as written by the load, one Parquet folder each."""
    return {n: spark.read.schema(table_schema(n)).parquet(f"{folder.rstrip('/')}/{n}") for n in TABLE_DDL}


def run_custom_query(spark: SparkSession, query: str, params: Mapping | None = None) -> DataFrame:
    """SQL over the registered views with `:name` parameters."""
    return spark.sql(query, args=dict(params)) if params else spark.sql(query)


def load_ml_dataset(tables: Mapping[str, DataFrame], **options) -> DataFrame:
    return order_dataset(ml_training_dataset(tables, **options))


def _by_name(dimension: DataFrame) -> DataFrame:
    return dimension.orderBy(F.col("name").asc_nulls_last())


def _pair(tables: Mapping[str, DataFrame], dimension: str, bridge: str, one: str) -> tuple[DataFrame, DataFrame]:
    named = bridge_with_names(tables[bridge], tables[dimension], f"{one}_id", f"{one}_name")
    return _by_name(tables[dimension]), order_bridge(named, f"{one}_name")


def load_genres_data(tables):
    return _pair(tables, "genres", "movie_genres", "genre")


def load_countries_data(tables):
    return _pair(tables, "countries", "movie_countries", "country")


def load_languages_data(tables):
    return _pair(tables, "languages", "movie_languages", "language")


def load_people_data(tables):
    named = bridge_with_names(tables["movie_people"], tables["people"], "person_id", "person_name")
    return _by_name(tables["people"]), order_people(named)


def load_all_data(tables: Mapping[str, DataFrame], **options) -> dict[str, DataFrame]:
    """Nine named frames; nothing runs until one is used."""
    bundle = {"ml_dataset": load_ml_dataset(tables, **options)}
    for dimension, bridge, load in (
        ("genres", "movie_genres", load_genres_data),
        ("people", "movie_people", load_people_data),
        ("countries", "movie_countries", load_countries_data),
        ("languages", "movie_languages", load_languages_data),
    ):
        bundle[dimension], bundle[bridge] = load(tables)
    return bundle

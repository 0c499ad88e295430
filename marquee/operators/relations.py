"""Joins between films, bridges and dimensions, and one-pass summaries of a bridge."""

from __future__ import annotations

from collections.abc import Iterable, Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from marquee.functions.text import role_position
from marquee.schemas import ROLES


def links_per_film(bridge: DataFrame, out: str) -> DataFrame:
    return bridge.groupBy("movie_id").agg(F.count(F.lit(1)).alias(out))


def roles_per_film(movie_people: DataFrame, names: Mapping[str, str]) -> DataFrame:
    """One pass for all role counts; `names` maps output column to role."""
    return movie_people.groupBy("movie_id").agg(*[F.count_if(F.col("role") == r).alias(o) for o, r in names.items()])


def genre_summary(movie_genres: DataFrame, genres: DataFrame, flags: Mapping[str, str]) -> DataFrame:
    """Number of genres and one 0/1 flag per named genre, in one pass over the bridge."""
    named = genres.filter(F.col("name").isin(list(flags.values()))).select(F.col("id").alias("genre_id"), "name")
    joined = movie_genres.join(named, "genre_id", "left")
    has = lambda g: F.coalesce(F.max(F.when(F.col("name") == g, 1)), F.lit(0))
    return joined.groupBy("movie_id").agg(
        F.count(F.lit(1)).alias("num_genres"), *[has(g).alias(o) for o, g in flags.items()]
    )


def bridge_with_names(bridge: DataFrame, dimension: DataFrame, id_column: str, name_column: str) -> DataFrame:
    """Bridge rows with the dimension's name; Spark broadcasts the dimension when its size allows it."""
    named = dimension.select(F.col("id").alias(id_column), F.col("name").alias(name_column))
    rest = [c for c in bridge.columns if c not in ("movie_id", id_column)]
    return bridge.join(named, id_column).select("movie_id", name_column, id_column, *rest)


def order_bridge(named: DataFrame, name_column: str) -> DataFrame:
    return named.orderBy(F.col("movie_id").asc_nulls_last(), F.col(name_column).asc_nulls_last())


def order_people(named: DataFrame) -> DataFrame:
    """By film, then role in its declared order, then position with unknown positions last."""
    return named.orderBy(
        F.col("movie_id").asc_nulls_last(),
        role_position(F.col("role"), ROLES).asc_nulls_last(),
        F.col("cast_order").asc_nulls_last(),
        F.col("person_id").asc_nulls_last(),
    )


def without_keys(df: DataFrame, keys: DataFrame, on: str | Sequence[str]) -> DataFrame:
    return df.join(keys, on, "left_anti")


def only_keys(df: DataFrame, keys: DataFrame, on: str | Sequence[str]) -> DataFrame:
    return df.join(keys, on, "left_semi")


def orphans(child: DataFrame, child_key: str, parent: DataFrame, parent_key: str) -> DataFrame:
    """Child rows whose parent is missing; a null reference is no orphan."""
    known = parent.select(F.col(parent_key).alias(child_key))
    return child.filter(F.col(child_key).isNotNull()).join(known, child_key, "left_anti")


def delete_cascade(
    tables: Mapping[str, DataFrame], films: DataFrame, children: Iterable[str], key: str = "movie_id"
) -> dict[str, DataFrame]:
    """Remove the given films (column `imdb_id`) and every child row that refers to them."""
    gone = films.select("imdb_id")
    result = dict(tables)
    result["movies"] = tables["movies"].join(gone, "imdb_id", "left_anti")
    for name in children:
        result[name] = tables[name].join(gone.withColumnRenamed("imdb_id", key), key, "left_anti")
    return result


def flagged_lookup(df: DataFrame, lookup: DataFrame, on: str, flag: str) -> DataFrame:
    """Left join that also tells whether the key was found."""
    return df.join(lookup.withColumn(flag, F.lit(True)), on, "left").withColumn(flag, F.coalesce(flag, F.lit(False)))


def top_per_key(df: DataFrame, key: str, order: Sequence[Column], n: int, position: str = "position") -> DataFrame:
    """First n rows per key; each task keeps only n rows per key before the shuffle."""
    w = Window.partitionBy(key).orderBy(*order)
    return df.withColumn(position, F.row_number().over(w)).filter(F.col(position) <= n)


def name_list(df: DataFrame, key: str, name: str, order: str, out: str) -> DataFrame:
    """Names of a key in one text, by order then name. The text is the result, so it holds all names."""
    entries = F.array_sort(F.collect_list(F.struct(F.col(order).alias("o"), F.col(name).alias("s"))))
    return df.groupBy(key).agg(F.array_join(F.transform(entries, lambda e: e["s"]), ", ").alias(out))


def first_alias(aliases: DataFrame, region: int) -> DataFrame:
    """The alias with the lowest id of a region, per title."""
    return (
        aliases.filter(F.col("region_id") == region)
        .groupBy("title_id")
        .agg(F.min_by("name", "id").alias("local_title"))
    )

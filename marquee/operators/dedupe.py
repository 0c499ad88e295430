"""Keep one row per key, and loads that leave existing rows alone."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def _one_per_key(df: DataFrame, keys: Sequence[str], order: Sequence[Column]) -> DataFrame:
    """Spark keeps one row per key and task before the shuffle, so a key with many copies stays cheap."""
    ranked = df.withColumn("_rn", F.row_number().over(Window.partitionBy(*keys).orderBy(*order)))
    return ranked.filter(F.col("_rn") == 1).drop("_rn")


def first_wins(df: DataFrame, keys: Sequence[str], order: Sequence[str]) -> DataFrame:
    """The first row of each key; `order` must be a total order within a key."""
    return _one_per_key(df, keys, [F.col(c).asc_nulls_last() for c in order])


def last_wins(df: DataFrame, keys: Sequence[str], order: Sequence[str]) -> DataFrame:
    return _one_per_key(df, keys, [F.col(c).desc_nulls_last() for c in order])


def not_yet_loaded(incoming: DataFrame, existing: DataFrame | None, keys: Sequence[str], order: Sequence[str]) -> DataFrame:
    """Rows an insert that ignores conflicts would add: first per key, and no key that is there already."""
    fresh = first_wins(incoming, keys, order)
    if existing is None:
        return fresh
    return fresh.join(existing.select(*keys), list(keys), "left_anti")


def merge_objects(left: DataFrame, right: DataFrame, key: str, out: str = "fields") -> DataFrame:
    """Merge two map columns per key; fields of the right side win."""
    empty = F.create_map().cast("map<string,string>")
    l, r = left.select(key, F.col(out).alias("_l")), right.select(key, F.col(out).alias("_r"))
    old, new = F.coalesce("_l", empty), F.coalesce("_r", empty)
    kept = F.map_filter(old, lambda k, v: ~F.map_contains_key(new, k))
    return l.join(r, key, "full").select(key, F.map_concat(kept, new).alias(out))

"""The collector's inputs: popular titles, the curated list and the related names of a title."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from marquee.operators.dedupe import last_wins
from marquee.operators.relations import name_list, top_per_key
from marquee.schemas import CAST_CATEGORIES, CAST_SIZE, MAX_YEAR, MIN_VOTES, MIN_YEAR


def popular_titles(
    titles: DataFrame,
    min_votes: int = MIN_VOTES,
    first_year: int = MIN_YEAR,
    last_year: int = MAX_YEAR,
    title_type: str = "movie",
) -> DataFrame:
    return titles.filter(
        (F.col("title_type") == title_type)
        & (F.col("votes") >= min_votes)
        & F.col("rating").isNotNull()
        & F.col("start_year").between(first_year, last_year)
    )


def order_titles(titles: DataFrame) -> DataFrame:
    return titles.orderBy(F.col("votes").desc_nulls_first(), F.col("rating").desc_nulls_first(), F.col("id"))


def curated_by_id(curated: DataFrame) -> DataFrame:
    """The list as a keyed table: of entries with the same id the last one stays."""
    return last_wins(curated, ["unique_id"], ["ordinal"])


def main_cast(principals: DataFrame, size: int = CAST_SIZE, categories=tuple(CAST_CATEGORIES)) -> DataFrame:
    """The first names of each title by billing."""
    actors = principals.filter(F.col("principal_category").isin(list(categories)))
    return top_per_key(actors, "title_id", [F.col("ordering").asc_nulls_last(), F.col("name")], size)


def cast_list(principals: DataFrame, size: int = CAST_SIZE, categories=tuple(CAST_CATEGORIES)) -> DataFrame:
    return name_list(main_cast(principals, size, categories), "title_id", "name", "position", "main_cast")

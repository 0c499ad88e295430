"""The consolidated catalogue from titles, curated labels, names and stored payloads."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from marquee.functions.text import award_status, yes_no
from marquee.operators.relations import first_alias, flagged_lookup, name_list
from marquee.schemas import ALIAS_REGION, CATALOGUE_COLUMNS
from marquee.sources.payloads import payload_fields
from marquee.sources.titles import cast_list, curated_by_id

_NO_TITLE = "title without id or year"


def assemble(
    titles: DataFrame,
    curated: DataFrame,
    names: Mapping[str, DataFrame],
    aliases: DataFrame,
    payloads: DataFrame,
    region: int = ALIAS_REGION,
) -> tuple[DataFrame, DataFrame]:
    """Catalogue rows with the fixed columns, and rejects (id, reason) for titles that cannot be placed.

    `names` holds genres, directors and writers as (title_id, name, ordinal), and principals with category and
    ordering. Each is reduced to one row per title before it is joined.
    """
    usable = F.col("unique_id").isNotNull() & F.col("start_year").isNotNull()
    rejects = titles.filter(~usable).select(F.col("id").cast("string").alias("id"), F.lit(_NO_TITLE).alias("reason"))
    picked = curated_by_id(curated).select(
        "unique_id", "ceremony_year", F.col("local_title").alias("curated_title"), F.col("winner").alias("is_winner")
    )
    wide = flagged_lookup(titles.filter(usable), picked, "unique_id", "listed")
    wide = wide.join(first_alias(aliases, region).withColumnRenamed("title_id", "id"), "id", "left")
    for part in ("genres", "directors", "writers"):
        listed = name_list(names[part], "title_id", "name", "ordinal", part)
        wide = wide.join(listed.withColumnRenamed("title_id", "id"), "id", "left")
    wide = wide.join(cast_list(names["principals"]).withColumnRenamed("title_id", "id"), "id", "left")
    wide = wide.join(payload_fields(payloads).withColumnRenamed("imdb_id", "unique_id"), "unique_id", "left")

    listed, winner = F.col("listed"), F.coalesce("is_winner", F.lit(False))
    local = F.coalesce("local_title", "original_title")
    or_blank = lambda c: F.coalesce(F.col(c), F.lit(""))
    values = [
        F.col("unique_id"),
        F.col("title"),
        F.when(listed, F.col("curated_title")).otherwise(local),
        F.col("start_year"),
        F.col("rating"),
        F.col("votes"),
        F.col("runtime"),
        yes_no(listed),
        yes_no(listed & winner),
        F.when(listed, F.col("ceremony_year").cast("string")).otherwise(F.lit("")),
        award_status(listed, winner),
        or_blank("genres"),
        or_blank("directors"),
        or_blank("writers"),
        or_blank("main_cast"),
        F.col("countries"),
        F.col("languages"),
        F.col("budget"),
        F.col("worldwide_gross"),
        F.col("domestic_gross"),
        F.col("metascore"),
        F.col("synopsis"),
    ]
    return wide.select(*[v.alias(c) for c, v in zip(CATALOGUE_COLUMNS, values)]), rejects

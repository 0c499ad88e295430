"""From raw catalogue rows and score lists to the relational tables."""

from __future__ import annotations

from collections.abc import Mapping
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from marquee.functions import text
from marquee.operators.dedupe import first_wins, not_yet_loaded
from marquee.operators.dimensions import extend_dimension, link
from marquee.operators.relations import only_keys, orphans, without_keys
from marquee.session import materialise

_ORDER = ["ordinal", "block", "position"]
_LISTS = {
    "genres": ("movie_genres", "genre_id", "Gêneros"),
    "countries": ("movie_countries", "country_id", "Países"),
    "languages": ("movie_languages", "language_id", "Idiomas"),
}
_ROLE_COLUMNS = {"director": "Diretores", "writer": "Roteiristas", "cast": "Elenco Principal"}


def skip_errors(raw: DataFrame, error_ids: DataFrame | None) -> tuple[DataFrame, DataFrame | None]:
    """Rows to load, and the skipped ones as (id, title)."""
    if error_ids is None:
        return raw, None
    keys = error_ids.select(F.col("id").alias("ID IMDb"))
    skipped = only_keys(raw, keys, "ID IMDb").select(F.col("ID IMDb").alias("id"), F.col("Título Original").alias("title"))
    return without_keys(raw, keys, "ID IMDb"), skipped


def typed_movies(raw: DataFrame) -> DataFrame:
    c = lambda name: F.col(f"`{name}`")
    return raw.select(
        c("ID IMDb").alias("imdb_id"),
        c("Título Original").alias("original_title"),
        c("Título Brasileiro").alias("br_title"),
        text.whole_number(c("Ano Lançamento")).alias("release_year"),
        c("Nota IMDb").try_cast("double").try_cast("decimal(3,1)").alias("imdb_rating"),
        text.whole_number(c("Votos")).alias("imdb_votes"),
        text.whole_number(c("Duração (min)")).alias("runtime_minutes"),
        text.is_affirmative(c("Indicado Oscar")).alias("nominated_oscar"),
        text.is_affirmative(c("Vencedor Oscar")).alias("won_oscar"),
        text.whole_number(c("Ano Cerimônia Oscar")).alias("oscar_ceremony_year"),
        c("Status Oscar").alias("oscar_status"),
        text.whole_number(c("Metascore")).alias("metascore"),
        c("Sinopse").alias("synopsis"),
        "ordinal",
    )


def typed_box_office(raw: DataFrame) -> DataFrame:
    return raw.select(
        F.col("ID IMDb").alias("movie_id"),
        text.parse_money(F.col("Orçamento")).alias("budget"),
        text.parse_money(F.col("Bilheteria Mundial")).alias("worldwide_gross"),
        text.parse_money(F.col("Bilheteria Doméstica")).alias("domestic_gross"),
        "ordinal",
    )


def mentions(raw: DataFrame, column: str, block: int = 0, null_token: str | None = None) -> DataFrame:
    """(movie_id, name, ordinal, block, position) for each entry of a comma list, numbered from 1 without blanks."""
    listed = text.tokens(F.col(f"`{column}`"), null_token)
    return raw.select(F.col("ID IMDb").alias("movie_id"), "ordinal", F.posexplode(listed).alias("p", "name")).select(
        "movie_id", "name", "ordinal", F.lit(block).alias("block"), (F.col("p") + 1).alias("position")
    )


def people_mentions(raw: DataFrame, null_token: str | None = None) -> DataFrame:
    """All roles of a row in the order directors, writers, cast; only cast has a position of its own."""
    parts = []
    for block, (role, column) in enumerate(_ROLE_COLUMNS.items()):
        order: Column = F.col("position") if role == "cast" else F.lit(None).cast("int")
        parts.append(mentions(raw, column, block, null_token).withColumns({"role": F.lit(role), "cast_order": order}))
    return reduce(DataFrame.unionByName, parts)


def load_samples(scores: DataFrame) -> DataFrame:
    """(movie_id, score_value, sample_index), one per film and index."""
    known = scores.filter(F.col("score").isNotNull())
    rows = known.select(
        F.col("film").alias("movie_id"), text.score_to_int(F.col("score")).alias("score_value"), "sample_index"
    )
    kept = first_wins(rows, ["movie_id", "sample_index"], ["score_value"])
    return kept.withColumn("score_value", F.col("score_value").try_cast("smallint"))


def build_tables(
    raw: DataFrame,
    scores: DataFrame,
    error_ids: DataFrame | None = None,
    existing: Mapping[str, DataFrame] | None = None,
    null_token: str | None = None,
) -> tuple[dict[str, DataFrame], dict[str, DataFrame]]:
    """New rows of every table, and reports: skipped films and samples of unknown films.

    A film that comes twice keeps its first scalars and has the relations of all its rows. With `existing`, rows that
    are there already stay as they are and only additions are returned; dimensions are returned in full.
    """
    old = existing or {}
    kept, skipped = skip_errors(raw, error_ids)
    rows = materialise(kept)  # read by every table below
    add = lambda df, name, keys, order: not_yet_loaded(df, old.get(name), keys, order).drop(*order)
    tables = {
        "movies": add(typed_movies(rows), "movies", ["imdb_id"], ["ordinal"]),
        "movie_box_office": add(typed_box_office(rows), "movie_box_office", ["movie_id"], ["ordinal"]),
    }
    for dimension, (bridge, id_column, column) in _LISTS.items():
        named = mentions(rows, column, null_token=null_token)
        tables[dimension] = extend_dimension(named, old.get(dimension), _ORDER)
        linked = link(named, tables[dimension], id_column, _ORDER)
        tables[bridge] = without_keys(linked, old[bridge], ["movie_id", id_column]) if bridge in old else linked
    named = people_mentions(rows, null_token)
    tables["people"] = extend_dimension(named, old.get("people"), _ORDER)
    linked = link(named, tables["people"], "person_id", _ORDER, ["role", "cast_order"])
    keys = ["movie_id", "person_id", "role"]
    tables["movie_people"] = without_keys(linked, old["movie_people"], keys) if "movie_people" in old else linked

    samples = load_samples(scores)
    if "rating_samples" in old:
        samples = without_keys(samples, old["rating_samples"], ["movie_id", "sample_index"])
    known = tables["movies"].select("imdb_id")
    if "movies" in old:
        known = known.unionByName(old["movies"].select("imdb_id"))
    reports = {"orphan_samples": orphans(samples, "movie_id", known, "imdb_id")}
    tables["rating_samples"] = samples.join(known.select(F.col("imdb_id").alias("movie_id")), "movie_id", "left_semi")
    if skipped is not None:
        reports["skipped"] = skipped
    return tables, reports

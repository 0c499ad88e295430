"""Table schemas, domains and other values fixed by the data formats."""

from __future__ import annotations

from pyspark.sql import types as T

# The catalogue CSV header, in file order.
CATALOGUE_COLUMNS = [
    "ID IMDb",
    "Título Original",
    "Título Brasileiro",
    "Ano Lançamento",
    "Nota IMDb",
    "Votos",
    "Duração (min)",
    "Indicado Oscar",
    "Vencedor Oscar",
    "Ano Cerimônia Oscar",
    "Status Oscar",
    "Gêneros",
    "Diretores",
    "Roteiristas",
    "Elenco Principal",
    "Países",
    "Idiomas",
    "Orçamento",
    "Bilheteria Mundial",
    "Bilheteria Doméstica",
    "Metascore",
    "Sinopse",
]

# Strings the pandas CSV reader takes as missing.
NA_TOKENS = [
    "",
    "#N/A",
    "#N/A N/A",
    "#NA",
    "-1.#IND",
    "-1.#QNAN",
    "-NaN",
    "-nan",
    "1.#IND",
    "1.#QNAN",
    "<NA>",
    "N/A",
    "NA",
    "NULL",
    "NaN",
    "None",
    "n/a",
    "nan",
    "null",
]

# Roles in the order they sort.
ROLES = ["director", "writer", "cast"]

# Status and yes/no texts of the catalogue.
YES, NO = "Sim", "Não"
STATUS_WINNER, STATUS_NOMINEE, STATUS_NONE = "🏆 Vencedor", "🎬 Indicado", ""

# Genres that get a flag of their own.
GENRE_FLAGS = {"is_drama": "Drama", "is_biography": "Biography", "is_history": "History"}

# First and last release year of each split.
SPLITS = {
    "ml_split_train": (2000, 2019),
    "ml_split_validation": (2020, 2022),
    "ml_split_test": (2023, 2024),
    "ml_split_prediction_2025": (2025, 2025),
}

# Model inputs.
BASELINE_FEATURES = [
    "imdb_rating",
    "imdb_votes",
    "runtime_minutes",
    "metascore",
    "n_samples",
    "mean_score",
    "median_score",
    "stddev_score",
    "box_office_rank_in_year",
    "votes_normalized_by_year",
    "rating_normalized_by_year",
    "num_genres",
    "num_countries",
    "num_languages",
    "num_cast",
]
FINAL_FEATURES = BASELINE_FEATURES + [
    "director_prev_nominations",
    "cast_prev_nominations",
    "is_drama",
    "is_biography",
    "is_history",
]

# Popular-title limits, alias region and cast size of the collector.
MIN_VOTES, MIN_YEAR, MAX_YEAR = 50000, 1999, 2024
ALIAS_REGION, CAST_SIZE = 15, 5
CAST_CATEGORIES = ["actor", "actress"]


def catalogue_schema() -> T.StructType:
    return T.StructType([T.StructField(name, T.StringType()) for name in CATALOGUE_COLUMNS])


_DIMENSION = "id BIGINT, name STRING"

TABLE_DDL = {
    "movies": (
        "imdb_id STRING, original_title STRING, br_title STRING, release_year INT, imdb_rating DECIMAL(3,1), "
        "imdb_votes INT, runtime_minutes INT, nominated_oscar BOOLEAN, won_oscar BOOLEAN, oscar_ceremony_year INT, "
        "oscar_status STRING, metascore INT, synopsis STRING"
    ),
    "movie_box_office": (
        "movie_id STRING, budget DECIMAL(18,2), worldwide_gross DECIMAL(18,2), domestic_gross DECIMAL(18,2)"
    ),
    "genres": _DIMENSION,
    "people": _DIMENSION,
    "countries": _DIMENSION,
    "languages": _DIMENSION,
    "movie_genres": "movie_id STRING, genre_id BIGINT",
    "movie_countries": "movie_id STRING, country_id BIGINT",
    "movie_languages": "movie_id STRING, language_id BIGINT",
    "movie_people": "movie_id STRING, person_id BIGINT, role STRING, cast_order INT",
    "rating_samples": "id BIGINT, movie_id STRING, score_value SMALLINT, sample_index INT",
}

PAYLOAD_TITLE_DDL = (
    "originCountries ARRAY<STRUCT<name: STRING>>, spokenLanguages ARRAY<STRUCT<name: STRING>>, "
    "metacritic STRUCT<score: INT>, plot STRING"
)
_MONEY = "STRUCT<amount: STRING, currency: STRING>"
PAYLOAD_BOX_DDL = (
    f"productionBudget {_MONEY}, worldwideGross {_MONEY}, domesticGross {_MONEY}, openingWeekendGross {_MONEY}, "
    "weekendEndDate STRUCT<year: INT, month: INT, day: INT>"
)


def table_schema(name: str) -> T.StructType:
    return T.StructType.fromDDL(TABLE_DDL[name])

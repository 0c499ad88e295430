"""Expectations on tables before they are written."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass, field
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from marquee.operators.relations import orphans
from marquee.schemas import ROLES


class ExpectationFailed(ValueError):
    pass


@dataclass
class Expectations:
    """What must hold for one table. `rules` name a condition that is true, or unknown, for good rows."""

    required: Sequence[str] = ()
    unique: Sequence[Sequence[str]] = ()
    rules: dict[str, Column] = field(default_factory=dict)
    parents: dict[str, tuple[str, str]] = field(default_factory=dict)  # column -> (table, key)


def _between(column: str, low, high) -> Column:
    return F.col(column).between(low, high)


def table_expectations() -> dict[str, Expectations]:
    """Keys, ranges, domains and references of the relational tables."""
    film = {"movie_id": ("movies", "imdb_id")}
    dimension = Expectations(required=["id", "name"], unique=[["id"], ["name"]])
    bridge = lambda column, table: Expectations(
        required=["movie_id", column], unique=[["movie_id", column]], parents={**film, column: (table, "id")}
    )
    return {
        "movies": Expectations(
            required=["imdb_id", "original_title", "release_year", "nominated_oscar", "won_oscar"],
            unique=[["imdb_id"]],
            rules={
                "imdb_id_length": F.length("imdb_id") <= 15,
                "imdb_rating_range": _between("imdb_rating", 0, 10),
                "imdb_votes_range": F.col("imdb_votes") >= 0,
                "runtime_minutes_range": F.col("runtime_minutes") > 0,
                "metascore_range": _between("metascore", 0, 100),
            },
        ),
        "movie_box_office": Expectations(required=["movie_id"], unique=[["movie_id"]], parents=film),
        "genres": dimension,
        "people": dimension,
        "countries": dimension,
        "languages": dimension,
        "movie_genres": bridge("genre_id", "genres"),
        "movie_countries": bridge("country_id", "countries"),
        "movie_languages": bridge("language_id", "languages"),
        "movie_people": Expectations(
            required=["movie_id", "person_id", "role"],
            unique=[["movie_id", "person_id", "role"]],
            rules={"role_domain": F.col("role").isin(ROLES)},
            parents={**film, "person_id": ("people", "id")},
        ),
        "rating_samples": Expectations(
            required=["movie_id", "score_value", "sample_index"],
            unique=[["movie_id", "sample_index"]],
            rules={"score_value_range": _between("score_value", 0, 100)},
            parents=film,
        ),
    }


def missing_columns(df: DataFrame, columns: Sequence[str]) -> list[str]:
    return [c for c in columns if c not in df.columns]


def report(tables: dict[str, DataFrame], expected: dict[str, Expectations]) -> DataFrame:
    """(table, rule, violations) for every rule: one aggregate per table, one per key, one anti join per reference."""
    parts = []
    for name, e in expected.items():
        df = tables[name]
        counts = {f"required:{c}": F.count_if(F.col(c).isNull()) for c in e.required}
        counts |= {f"rule:{r}": F.count_if(~c) for r, c in e.rules.items()}
        if counts:
            wide = df.agg(*[c.alias(r) for r, c in counts.items()])
            pairs = F.array(*[F.struct(F.lit(r).alias("rule"), F.col(f"`{r}`").alias("violations")) for r in counts])
            parts.append(wide.select(F.explode(pairs).alias("p")).select(F.lit(name).alias("table"), "p.*"))
        for key in e.unique:
            extra = df.groupBy(*key).agg((F.count(F.lit(1)) - 1).alias("extra"))
            parts.append(
                extra.agg(F.coalesce(F.sum("extra"), F.lit(0)).alias("violations")).select(
                    F.lit(name).alias("table"), F.lit(f"unique:{','.join(key)}").alias("rule"), "violations"
                )
            )
        for column, (parent, parent_key) in e.parents.items():
            lost = orphans(df.select(column), column, tables[parent], parent_key)
            parts.append(
                lost.agg(F.count(F.lit(1)).alias("violations")).select(
                    F.lit(name).alias("table"), F.lit(f"parent:{column}").alias("rule"), "violations"
                )
            )
    return reduce(DataFrame.unionByName, parts)


def enforce(tables: dict[str, DataFrame], expected: dict[str, Expectations]) -> None:
    """Stop the load when a rule is broken; the report has one row per rule, so it is small."""
    broken = report(tables, expected).filter(F.col("violations") > 0).collect()
    if broken:
        raise ExpectationFailed("; ".join(f"{r['table']}.{r['rule']}: {r['violations']}" for r in broken))


def quarantine(df: DataFrame, e: Expectations, tables: dict[str, DataFrame] | None = None) -> tuple[DataFrame, DataFrame]:
    """Good rows, and the others with the rules they break, in the order required, rule, unique, parent.

    All rows of a key that comes more than once go, as nothing says which is right; a key with a null part is no key. A row
    goes if what it refers to is missing in `tables`, which the references of `e` need; a null reference is none. Keys that
    come twice are counted before they meet the rows, and a hot one is a single row then. Repeated rows are one key twice.
    Columns may have any names; one called reasons is replaced."""
    marks = [f"_mark{i}" for i in range(len(e.unique) + len(e.parents))]
    while any(c.lower().startswith(tuple(marks)) for c in df.columns if marks):
        marks = [f"_{m}" for m in marks]
    tests = {f"required:{c}": F.col(c).isNull() for c in e.required}
    tests |= {f"rule:{r}": F.coalesce(~c, F.lit(False)) for r, c in e.rules.items()}
    marked = df
    for mark, key in zip(marks, e.unique):
        twice = df.select(*[F.col(c).alias(f"{mark}_{i}") for i, c in enumerate(key)]).dropna()
        names = twice.columns
        twice = twice.groupBy(*names).agg(F.count(F.lit(1)).alias(mark)).filter(F.col(mark) > 1)
        same = reduce(lambda a, b: a & b, [F.col(c) == F.col(n) for c, n in zip(key, names)])
        marked = marked.join(twice, same, "left").drop(*names)
        tests[f"unique:{','.join(key)}"] = F.col(mark).isNotNull()
    for mark, (column, (parent, parent_key)) in zip(marks[len(e.unique) :], e.parents.items()):
        known = tables[parent].select(F.col(parent_key).alias(mark)).dropna().distinct()
        marked = marked.join(known, F.col(column) == F.col(mark), "left")
        tests[f"parent:{column}"] = F.col(column).isNotNull() & F.col(mark).isNull()
    reasons = F.filter(F.array(*[F.when(t, F.lit(r)) for r, t in tests.items()]), lambda r: r.isNotNull())
    marked = marked.withColumn("reasons", reasons).drop(*marks)
    return marked.filter(F.size("reasons") == 0).drop("reasons"), marked.filter(F.size("reasons") > 0)

"""Exploration: class balance, missing values, distributions, correlations and summaries."""

from __future__ import annotations

from collections.abc import Sequence
from itertools import combinations_with_replacement

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from marquee.functions.stats import ratio
from marquee.operators.quantiles import SMALL_ROWS, exact_quantiles


def _long(wide: DataFrame, entries: Sequence[Column]) -> DataFrame:
    """One row per struct of a one-row frame."""
    return wide.select(F.explode(F.array(*entries)).alias("e")).select("e.*")


def class_balance(df: DataFrame, label: str = "label") -> DataFrame:
    """Count, percentage and share per class; `ratio` is the largest class over this one."""
    counts = df.groupBy(label).agg(F.count(F.lit(1)).alias("n"))
    totals = counts.agg(F.sum("n").alias("total"), F.max("n").alias("largest")).first()
    total, largest = F.lit(totals["total"]).cast("double"), F.lit(totals["largest"]).cast("double")
    return counts.select(
        label, "n", ratio(F.col("n"), total, 100.0).alias("percentage"), ratio(largest, F.col("n")).alias("ratio")
    )


def per_year(df: DataFrame, label: str = "label", year: str = "release_year") -> DataFrame:
    return df.groupBy(year).agg(F.count(F.lit(1)).alias("films"), F.count_if(F.col(label) == 1).alias("nominated"))


def missing_summary(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """Columns with missing values, most first. One pass for all columns."""
    columns = list(columns or df.columns)
    wide = df.agg(F.count(F.lit(1)).alias("total"), *[F.count_if(F.col(c).isNull()).alias(f"m_{c}") for c in columns])
    entries = [
        F.struct(
            F.lit(c).alias("column"),
            F.col(f"m_{c}").alias("missing_count"),
            ratio(F.col(f"m_{c}"), F.col("total"), 100.0).alias("missing_percentage"),
        )
        for c in columns
    ]
    found = _long(wide, entries).filter(F.col("missing_count") > 0)
    return found.orderBy(F.col("missing_percentage").desc(), F.col("column"))


_DESCRIBE = ["column", "count", "mean", "std", "min", "q25", "q50", "q75", "max"]


def describe(df: DataFrame, columns: Sequence[str], small_rows: int = SMALL_ROWS) -> DataFrame:
    """Count, mean, sample deviation, extremes and exact quartiles; one row per column."""
    cuts = exact_quantiles(df, columns, [0.25, 0.5, 0.75], small_rows)
    quartiles = df.sparkSession.createDataFrame(
        [(c, *cuts[c]) for c in columns], "column STRING, q25 DOUBLE, q50 DOUBLE, q75 DOUBLE"
    )
    wide = df.agg(
        *[
            F.struct(
                F.lit(c).alias("column"),
                F.count(c).alias("count"),
                F.avg(F.col(c).cast("double")).alias("mean"),
                F.stddev_samp(F.col(c).cast("double")).alias("std"),
                F.min(F.col(c).cast("double")).alias("min"),
                F.max(F.col(c).cast("double")).alias("max"),
            ).alias(f"s{i}")
            for i, c in enumerate(columns)
        ]
    )
    rows = _long(wide, [F.col(f"s{i}") for i in range(len(columns))])
    return rows.join(F.broadcast(quartiles), "column").select(*_DESCRIBE)


def numeric_columns(df: DataFrame) -> list[str]:
    """Numeric columns whose name holds no `id`."""
    return [f.name for f in df.schema.fields if isinstance(f.dataType, T.NumericType) and "id" not in f.name.lower()]


def correlation_matrix(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """Pearson correlation of each pair over the rows where both are known, as (a, b, correlation)."""
    columns = list(columns or numeric_columns(df))
    pairs = list(combinations_with_replacement(range(len(columns)), 2))
    typed = df.select(*[F.col(c).cast("double").alias(f"c{i}") for i, c in enumerate(columns)])
    wide = typed.agg(*[F.corr(f"c{i}", f"c{j}").alias(f"r{i}_{j}") for i, j in pairs])
    entries = []
    for i, j in pairs:
        value = F.nanvl(F.col(f"r{i}_{j}"), F.lit(None).cast("double")).alias("correlation")
        entries.append(F.struct(F.lit(columns[i]).alias("a"), F.lit(columns[j]).alias("b"), value))
        if i != j:
            entries.append(F.struct(F.lit(columns[j]).alias("a"), F.lit(columns[i]).alias("b"), value))
    return _long(wide, entries)


def histogram(df: DataFrame, column: str, bins: int = 30) -> DataFrame:
    """Equal-width bins over the range of the known values; the last bin includes the highest value."""
    x = F.col(column).cast("double")
    known = df.select(x.alias("x")).filter(F.col("x").isNotNull() & ~F.isnan("x"))
    ends = known.agg(F.min("x").alias("lo"), F.max("x").alias("hi")).first()
    lo, hi = ends["lo"], ends["hi"]
    if lo is None:
        lo, hi = 0.0, 1.0
    elif lo == hi:
        lo, hi = lo - 0.5, hi + 0.5
    place = F.least(F.floor((F.col("x") - lo) * bins / F.lit(hi - lo)), F.lit(bins - 1)).cast("int")
    counts = known.groupBy(place.alias("bin")).agg(F.count(F.lit(1)).alias("n"))
    edges = df.sparkSession.range(bins).select(F.col("id").cast("int").alias("bin"))
    width = (hi - lo) / bins
    return edges.join(counts, "bin", "left").select(
        "bin",
        (F.lit(lo) + F.col("bin") * width).alias("low"),
        (F.lit(lo) + (F.col("bin") + 1) * width).alias("high"),
        F.coalesce("n", F.lit(0)).alias("n"),
    )


def by_class(
    df: DataFrame, features: Sequence[str], label: str = "label", classes: Sequence[int] = (0, 1), small_rows: int = SMALL_ROWS
) -> DataFrame:
    """Size, mean, exact median and extremes of each feature within each class."""
    split = {f"{f}|{k}": F.when(F.col(label) == k, F.col(f).cast("double")) for f in features for k in classes}
    wide = df.select(*[c.alias(n) for n, c in split.items()])
    names = list(split)
    medians = exact_quantiles(wide, [f"`{n}`" for n in names], [0.5], small_rows)
    entry = lambda n: F.struct(
        F.lit(n.split("|")[0]).alias("feature"),
        F.lit(int(n.split("|")[1])).alias(label),
        F.count(f"`{n}`").alias("n"),
        F.avg(f"`{n}`").alias("mean"),
        F.lit(medians[f"`{n}`"][0]).cast("double").alias("median"),
        F.min(f"`{n}`").alias("min"),
        F.max(f"`{n}`").alias("max"),
    )
    one = wide.agg(*[entry(n).alias(f"s{i}") for i, n in enumerate(names)])
    return _long(one, [F.col(f"s{i}") for i in range(len(names))])


def top_categories(df: DataFrame, category: str, k: int = 15) -> DataFrame:
    counts = df.groupBy(category).agg(F.count(F.lit(1)).alias("n"))
    return counts.orderBy(F.col("n").desc(), F.col(category).asc_nulls_last()).limit(k)


def role_totals(movie_people: DataFrame) -> DataFrame:
    return movie_people.groupBy("role").agg(F.count(F.lit(1)).alias("n"))


def corpus_summary(movies: DataFrame) -> DataFrame:
    return movies.agg(
        F.count(F.lit(1)).alias("films"),
        F.count_if("nominated_oscar").alias("nominated"),
        F.min("release_year").alias("first_year"),
        F.max("release_year").alias("last_year"),
    )


def collection_summary(catalogue: DataFrame, errors: DataFrame) -> DataFrame:
    """Totals of an assembled catalogue. A missing rating or vote count adds zero, and the mean of votes is whole.

    Catalogue rows and errors are stacked and counted in one aggregate.
    """
    rows = catalogue.select(
        "nominated",
        "winner",
        F.coalesce(F.col("rating").cast("double"), F.lit(0.0)).alias("rating"),
        F.coalesce(F.col("votes").cast("long"), F.lit(0)).alias("votes"),
        F.lit(1).alias("film"),
    )
    stacked = rows.unionByName(errors.select(F.lit(1).alias("error")), allowMissingColumns=True)
    films = F.count("film")
    return stacked.agg(
        films.alias("films"),
        F.count_if("nominated").alias("nominees"),
        F.count_if(F.col("nominated") & F.col("winner")).alias("winners"),
        F.count_if(~F.col("nominated")).alias("others"),
        F.round(ratio(F.sum("rating"), films), 2).alias("mean_rating"),
        F.floor(ratio(F.sum("votes"), films)).cast("long").alias("mean_votes"),
        F.count("error").alias("errors"),
    )


def first_errors(rejects: DataFrame, order: str = "id", n: int = 10) -> DataFrame:
    """The first errors for a report."""
    return rejects.orderBy(F.col(order).asc_nulls_last()).limit(n)


def run_tally(log: DataFrame, ok: str = "ok", seconds: float | None = None) -> DataFrame:
    """Processed, successful and failed keys of an ingest log, with the success rate in percent."""
    total, good = F.count(F.lit(1)), F.count_if(F.col("status") == ok)
    out = log.agg(
        total.alias("processed"),
        good.alias("success"),
        (total - good).alias("errors"),
        ratio(good, total, 100.0).alias("success_rate"),
    )
    if seconds is None:
        return out
    return out.withColumn("per_second", ratio(F.col("processed"), F.lit(float(seconds))))

"""Per-film statistics of score lists."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from marquee.functions import stats

# Columns of a feature row, in order.
FEATURE_COLUMNS = [
    "film",
    "n_reviews",
    "mean",
    "median",
    "trimmed_mean_10",
    "trimmed_mean_20",
    "std",
    "iqr",
    "mad",
    "skewness",
    "excess_kurtosis",
    "p_ge_90",
    "p_ge_80",
    "p_green_61_100",
    "p_yellow_40_60",
    "p_red_0_39",
    "entropy_gyr_bits",
]
# Fixed value: what turns a median deviation into a standard deviation of a normal distribution.
MAD_SCALE = 1.4826


_INTEGRAL = (T.ByteType, T.ShortType, T.IntegerType, T.LongType)


def rating_stats(movies: DataFrame, samples: DataFrame) -> DataFrame:
    """One row per film, also for films without samples."""
    return (
        movies.select(F.col("imdb_id").alias("movie_id"))
        .join(sample_stats(samples), "movie_id", "left")
        .withColumn("n_samples", F.coalesce("n_samples", F.lit(0).cast("long")))
    )


def sample_stats(samples: DataFrame) -> DataFrame:
    """Statistics of the films with samples. Scores are whole numbers from 0 to 100, so the exact percentile keeps at
    most 101 counts per film and is combined before the shuffle."""
    score = F.col("score_value")
    per_film = samples.groupBy("movie_id").agg(
        F.count(score).alias("n_samples"),
        F.avg(score).alias("mean_score"),
        F.percentile(score, F.array(F.lit(0.5), F.lit(0.9))).alias("_cuts"),
        F.stddev_pop(score).alias("stddev_score"),
        F.min(score).alias("min_score"),
        F.max(score).alias("max_score"),
    )
    return per_film.select(
        "movie_id",
        "n_samples",
        "mean_score",
        F.col("_cuts")[0].alias("median_score"),
        "stddev_score",
        F.col("_cuts")[1].alias("p90_score"),
        "min_score",
        "max_score",
    )


def check_cut(share: float) -> float:
    if not 0.0 <= share < 0.5:
        raise ValueError("the share to cut must be in [0, 0.5)")
    return share


def score_features(samples: DataFrame, film: str = "film", score: str = "score", cuts=(0.10, 0.20)) -> DataFrame:
    """The full feature row of each film.

    Scores are counted per film and value. A value knows how many scores come before it, so quantiles and trimmed means are
    sums over rows, for short and long lists alike, and no list is ever held. Whole scores have 101 values at most, so a film
    is a few rows; the order of fractional ones is cut into slots, the whole points of the range, and a film with a third of
    all scores is spread over them.
    """
    for share in cuts:
        check_cut(share)
    cleaned = samples.select(F.col(film).alias("film"), stats.clean_score(F.col(score)).alias("v"))
    counted = cleaned.groupBy("film", "v").agg(F.count("v").alias("n"))
    whole = isinstance(samples.schema[score].dataType, _INTEGRAL)
    if whole:
        counted = counted.repartition("film")  # everything below then stays where it is
    known, v, n, total = counted.filter(F.col("v").isNotNull()), F.col("v"), F.col("n"), F.col("total")
    orders = _ranked(known, whole).groupBy("film").agg(
        _quantile_of(0.5, total).alias("median"),
        (_quantile_of(0.75, total) - _quantile_of(0.25, total)).alias("iqr"),
        _trimmed_of(cuts[0], total).alias("trimmed_mean_10"),
        _trimmed_of(cuts[1], total).alias("trimmed_mean_20"),
        (F.sum(v * n) / F.sum(n)).alias("mean"),
    )
    centred = counted.join(orders.select("film", "median", "mean"), "film", "left").select(
        "film", "n", F.abs(v - F.col("median")).alias("v"), (v - F.col("mean")).alias("c"), v.alias("x")
    )
    spread = centred.filter(v.isNotNull()).groupBy("film", "v").agg(F.sum("n").alias("n"))
    mads = _ranked(spread, whole).groupBy("film").agg((F.lit(MAD_SCALE) * _quantile_of(0.5, total)).alias("mad"))
    size = F.sum(n)
    moment = lambda k: stats.ratio(F.sum(n * F.pow(F.col("c"), F.lit(k))), size).alias(f"m{k}")
    shares = [stats.ratio(F.sum(F.when(t, n).otherwise(0)), size).alias(name) for name, t in _bucket_tests(F.col("x")).items()]
    central = centred.groupBy("film").agg(
        size.alias("n_reviews"), moment(2), moment(3), moment(4), (F.min("x") == F.max("x")).alias("constant"), *shares
    )
    central = central.withColumn("m2", F.when(F.col("constant"), F.lit(0.0)).otherwise(F.col("m2")))  # whatever rounding says
    wide = central.join(orders, "film", "left").join(mads, "film", "left")
    m2, size = F.col("m2"), F.col("n_reviews")
    g1 = F.when(m2 > 0, F.col("m3") / F.pow(m2, F.lit(1.5)))
    g2 = F.when(m2 > 0, F.col("m4") / (m2 * m2) - 3)
    out = (
        wide.withColumn("std", stats.sample_std_or_zero(size, F.sqrt(stats.ratio(m2 * size, size - 1))))
        .withColumn("skewness", stats.corrected_skewness(size, g1))
        .withColumn("excess_kurtosis", stats.guarded_kurtosis(size, g2))
    )
    return _with_entropy(out).select(*FEATURE_COLUMNS)


def features_from_lists(lists: DataFrame, film: str = "film", scores: str = "scores") -> DataFrame:
    """The same from one array of scores per film; a film with an empty list has a row with zero reviews."""
    rows = lists.select(F.col(film).alias("film"), F.explode_outer(scores).alias("score"))
    return score_features(rows)


def order_features(features: DataFrame) -> DataFrame:
    keys = ("p_ge_90", "median", "n_reviews")
    return features.orderBy(*[F.col(k).desc_nulls_last() for k in keys], F.col("film").asc_nulls_last())


def _bucket_tests(v: Column) -> dict[str, Column]:
    return {
        "p_ge_90": v >= 90,
        "p_ge_80": v >= 80,
        "p_green_61_100": (v >= 61) & (v <= 100),
        "p_yellow_40_60": (v >= 40) & (v <= 60),
        "p_red_0_39": (v >= 0) & (v <= 39),
    }


def _with_entropy(df: DataFrame) -> DataFrame:
    shares = [F.col("p_green_61_100"), F.col("p_yellow_40_60"), F.col("p_red_0_39")]
    return df.withColumn("entropy_gyr_bits", stats.entropy_bits(shares))


def _ranked(counted: DataFrame, whole: bool) -> DataFrame:
    """Adds `before`, the scores of the film below a value, and `total`, all of them."""
    if whole:
        film = Window.partitionBy("film")
        below = film.orderBy("v").rowsBetween(Window.unboundedPreceding, -1)
        return counted.select("*", F.coalesce(F.sum("n").over(below), F.lit(0)).alias("before"), F.sum("n").over(film).alias("total"))
    slotted = counted.withColumn("_slot", F.floor("v").cast("int"))
    film = Window.partitionBy("film")
    earlier = film.orderBy("_slot").rowsBetween(Window.unboundedPreceding, -1)
    sums = slotted.groupBy("film", "_slot").agg(F.sum("n").alias("_n"))
    starts = sums.select("film", "_slot", F.coalesce(F.sum("_n").over(earlier), F.lit(0)).alias("_start"), F.sum("_n").over(film).alias("total"))
    within = Window.partitionBy("film", "_slot").orderBy("v").rowsBetween(Window.unboundedPreceding, -1)
    local = slotted.withColumn("before", F.coalesce(F.sum("n").over(within), F.lit(0)))
    return local.join(starts, ["film", "_slot"]).withColumn("before", F.col("before") + F.col("_start")).drop("_slot", "_start")


def _value_at_rank(rank: Column) -> Column:
    return F.max(F.when((F.col("before") <= rank) & (rank < F.col("before") + F.col("n")), F.col("v")))


def _quantile_of(share: float, total: Column) -> Column:
    at = F.lit(share) * (total - 1)
    part = F.max(at - F.floor(at))
    low, high = _value_at_rank(F.floor(at)), _value_at_rank(F.ceil(at))
    return low + (high - low) * part


def _trimmed_of(share: float, total: Column) -> Column:
    k = F.floor(total * F.lit(share))
    before, n = F.col("before"), F.col("n")
    kept = F.greatest(F.lit(0), F.least(before + n, total - k) - F.greatest(before, k))
    return stats.ratio(F.sum(F.col("v") * kept), F.sum(kept))

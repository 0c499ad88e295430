"""Guarded arithmetic and statistic expressions."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F


def display_round(c: Column, digits: int = 3) -> Column:
    """Half to even, as numeric frames are shown."""
    return F.bround(c, digits)


def ratio(part: Column, whole: Column, scale: float = 1.0) -> Column:
    """Null when the whole is zero or missing."""
    return F.when(whole != 0, F.lit(scale) * part / whole)


def zscore(x: Column, mean: Column, sd: Column) -> Column:
    return F.when(sd > 0, (x - mean) / sd)


def clean_score(c: Column) -> Column:
    """Null for missing and NaN; the rest cut to 0..100. The NaN test comes first: clipping would make it 100."""
    x = c.cast("double")
    return F.when(x.isNotNull() & ~F.isnan(x), F.greatest(F.lit(0.0), F.least(F.lit(100.0), x)))


def at_least(prob: Column, threshold: Column | float) -> Column:
    return (prob >= threshold).cast("int")


def entropy_bits(shares: list[Column]) -> Column:
    """Shannon entropy of the non-zero shares; null when there is none."""
    terms = [F.when(p > 0, -p * F.log2(p)).otherwise(F.lit(0.0)) for p in shares]
    some = reduce(lambda a, b: a | b, [F.coalesce(p > 0, F.lit(False)) for p in shares])
    return F.when(some, reduce(lambda a, b: a + b, terms))


def corrected_skewness(n: Column, g1: Column) -> Column:
    """Bias-corrected skewness; null below three values, zero for constant values."""
    root = F.sqrt(n.cast("double") * (n - 1))
    return F.when(n >= 3, F.coalesce(root / (n - 2) * g1, F.lit(0.0)))


def guarded_kurtosis(n: Column, g2: Column) -> Column:
    """Excess kurtosis without correction; null below four values, zero for constant values."""
    return F.when(n >= 4, F.coalesce(g2, F.lit(0.0)))


def sample_std_or_zero(n: Column, sd: Column) -> Column:
    """Sample standard deviation, where a single value has zero."""
    return F.when(n == 1, F.lit(0.0)).when(n > 1, sd)

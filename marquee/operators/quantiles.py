"""Exact, linearly interpolated quantiles of whole columns with a fixed amount of memory per task."""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

SMALL_ROWS = 1_000_000


def _valid(name: str):
    x = F.col(name).cast("double")
    return F.when(x.isNotNull() & ~F.isnan(x), x)


def exact_quantiles(
    df: DataFrame, columns: Sequence[str], probabilities: Sequence[float], small_rows: int = SMALL_ROWS, accuracy: int = 10_000
) -> dict[str, list[float | None]]:
    """Quantiles per column over its non-null values.

    Up to `small_rows` values the built-in exact percentile is used. Beyond that its value map would grow with the
    data in one task, so the wanted ranks are found by narrowing: every pass takes at least two values and all their copies out of each
    rank's span, and with the default accuracy all but some thousandths of the rest.
    """
    if not columns:
        return {}
    data = df.select(*[_valid(c).alias(f"c{i}") for i, c in enumerate(columns)])
    first = data.agg(
        *[f(f"c{i}").alias(f"{n}{i}") for i in range(len(columns)) for n, f in (("n", F.count), ("lo", F.min), ("hi", F.max))]
    ).first()
    sizes = [first[f"n{i}"] for i in range(len(columns))]
    if max(sizes) <= small_rows:
        shares = F.array(*[F.lit(float(p)) for p in probabilities])
        row = data.agg(*[F.percentile(f"c{i}", shares).alias(f"c{i}") for i in range(len(columns))]).first()
        return {c: list(row[f"c{i}"]) if row[f"c{i}"] else [None] * len(probabilities) for i, c in enumerate(columns)}

    values = _values_at_ranks(
        data,
        {
            (i, r): (first[f"lo{i}"], first[f"hi{i}"])
            for i, n in enumerate(sizes)
            if n
            for p in probabilities
            for r in (math.floor(p * (n - 1)), math.ceil(p * (n - 1)))
        },
        sizes,
        accuracy,
    )
    result: dict[str, list[float | None]] = {}
    for i, c in enumerate(columns):
        n = sizes[i]
        result[c] = []
        for p in probabilities:
            if not n:
                result[c].append(None)
                continue
            at = p * (n - 1)
            low, high = values[(i, math.floor(at))], values[(i, math.ceil(at))]
            part = at - math.floor(at)
            result[c].append(low + (high - low) * part if part and low != high else low)
    return result


def _values_at_ranks(data: DataFrame, limits: dict, sizes: Sequence[int], accuracy: int) -> dict:
    """`limits` holds (lowest, highest) for each (column, rank); all ranks are narrowed together.

    A pass takes two approximate quantiles around the rank among the values between its limits, then counts the values
    below, equal to and above each of them. A rank among the equal ones is found; otherwise the values strictly between
    two edges remain, so both edges are gone for certain and, with distinct values, all but some thousandths as well.
    """
    found = {key: lo for key, (lo, hi) in limits.items() if lo == hi}
    spans = {key: (lo, hi, 0, sizes[key[0]]) for key, (lo, hi) in limits.items() if lo != hi}
    while spans:
        keys = list(spans)
        asked = []
        for j, (i, rank) in enumerate(keys):
            lo, hi, below, m = spans[(i, rank)]
            x = F.col(f"c{i}")
            share = (rank - below + 0.5) / m
            around = [max(0.0, share - 2 / accuracy), min(1.0, share + 2 / accuracy)]
            asked.append(F.percentile_approx(F.when(x.between(lo, hi), x), around, accuracy).alias(f"q{j}"))
        edges = data.agg(*asked).first()
        counts = []
        for j, (i, _) in enumerate(keys):
            x, (q0, q1) = F.col(f"c{i}"), edges[f"q{j}"]
            inner = (x > q0) & (x < q1)
            counts += [F.count_if(c).alias(f"{n}{j}") for n, c in (("a", x < q0), ("b", x <= q0), ("c", x < q1), ("d", x <= q1))]
            counts += [F.max(F.when(x < q0, x)).alias(f"e{j}"), F.min(F.when(inner, x)).alias(f"f{j}")]
            counts += [F.max(F.when(inner, x)).alias(f"g{j}"), F.min(F.when(x > q1, x)).alias(f"h{j}")]
        got = data.agg(*counts).first()
        for j, key in enumerate(keys):
            rank, (lo, hi, below, m), (q0, q1) = key[1], spans.pop(key), edges[f"q{j}"]
            under, upto, before, through = (got[f"{n}{j}"] for n in "abcd")
            if rank < under:
                left = lo, got[f"e{j}"], below, under - below
            elif rank < upto:
                left = q0, q0, under, upto - under
            elif rank < before:
                left = got[f"f{j}"], got[f"g{j}"], upto, before - upto
            elif rank < through:
                left = q1, q1, before, through - before
            else:
                left = got[f"h{j}"], hi, through, below + m - through
            if left[0] == left[1]:
                found[key] = left[0]
            else:
                spans[key] = left
    return found

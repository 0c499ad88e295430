import math

import numpy as np
import pytest

from marquee.operators.scores import FEATURE_COLUMNS, order_features, rating_stats, score_features

NAN = float("nan")


def expected(values):
    """Each statistic from its formula."""
    kept = [v for v in values if v is not None and not math.isnan(v)]
    x = np.sort(np.clip(np.array(kept, dtype=float), 0, 100))
    n = len(x)
    out = dict.fromkeys(FEATURE_COLUMNS[2:])
    out["n_reviews"] = n
    if not n:
        return out
    cut = lambda p: x[int(n * p) : n - int(n * p)].mean()
    d = x - x.mean()
    m2 = 0.0 if x.min() == x.max() else (d**2).mean()
    q = lambda p: np.percentile(x, p)
    shares = [((x >= 61) & (x <= 100)).mean(), ((x >= 40) & (x <= 60)).mean(), (x <= 39).mean()]
    out |= {
        "mean": x.mean(),
        "median": np.median(x),
        "trimmed_mean_10": cut(0.1),
        "trimmed_mean_20": cut(0.2),
        "std": x.std(ddof=1) if n > 1 else 0.0,
        "iqr": q(75) - q(25),
        "mad": 1.4826 * np.median(np.abs(x - np.median(x))),
        "p_ge_90": (x >= 90).mean(),
        "p_ge_80": (x >= 80).mean(),
        "p_green_61_100": shares[0],
        "p_yellow_40_60": shares[1],
        "p_red_0_39": shares[2],
    }
    positive = [p for p in shares if p > 0]
    out["entropy_gyr_bits"] = -sum(p * math.log2(p) for p in positive) if positive else None
    if n >= 3:
        out["skewness"] = 0.0 if m2 == 0 else math.sqrt(n * (n - 1)) / (n - 2) * (d**3).mean() / m2**1.5
    if n >= 4:
        out["excess_kurtosis"] = 0.0 if m2 == 0 else (d**4).mean() / m2**2 - 3
    return out


def edge_cases(whole):
    rng = np.random.default_rng(7)
    cases = {
        "none": [None],
        "one": [70],
        "two": [70, 80],
        "three": [10, 50, 90],
        "four": [10, 20, 30, 100],
        "equal": [60] * 5,
        "ten": list(range(5, 105, 10)),
        "nine": list(range(10, 100, 10)),
        "clip": [-5, 130, 50],
        "many": [int(v) for v in rng.integers(0, 101, 300)],
    }
    if not whole:
        cases |= {
            "nan": [NAN, 40.0, None],
            "between": [60.5],
            "fractions": [float(v) for v in rng.uniform(-5, 110, 200)],
            "equal_fractions": [60.1] * 3,
        }
    return cases


def check(got, cases):
    assert len(got) == len(cases)
    for row in got:
        want = expected(cases[row["film"]])
        for name, value in want.items():
            if value is None:
                assert row[name] is None, (row["film"], name, row[name])
            else:
                assert row[name] == pytest.approx(value, abs=1e-9), (row["film"], name)


@pytest.mark.parametrize("ddl", ["INT", "DOUBLE"])
def test_features_match_formulas(spark, ddl):
    cases = edge_cases(ddl == "INT")
    if ddl == "DOUBLE":
        cases = {k: [None if v is None else float(v) for v in vs] for k, vs in cases.items()}
    rows = [(film, v) for film, vs in cases.items() for v in vs]
    df = spark.createDataFrame(rows, f"film STRING, score {ddl}")
    check(score_features(df).collect(), cases)


def test_bad_cut(spark):
    df = spark.createDataFrame([("a", 1)], "film STRING, score INT")
    with pytest.raises(ValueError):
        score_features(df, cuts=(0.1, 0.5))


def test_order(spark):
    rows = [("low", 10), ("high", 95), ("high", 95), ("also", 95), ("none", None)]
    df = score_features(spark.createDataFrame(rows, "film STRING, score INT"))
    assert [r["film"] for r in order_features(df).collect()] == ["high", "also", "low", "none"]


def test_rating_stats_keeps_films_without_samples(spark):
    movies = spark.createDataFrame([("a",), ("b",)], "imdb_id STRING")
    samples = spark.createDataFrame([("a", 10), ("a", 20), ("a", 40)], "movie_id STRING, score_value SMALLINT")
    got = {r["movie_id"]: r for r in rating_stats(movies, samples).collect()}
    assert got["a"]["median_score"] == 20 and got["a"]["p90_score"] == pytest.approx(36)
    assert got["a"]["stddev_score"] == pytest.approx(np.std([10, 20, 40]))
    assert got["b"]["n_samples"] == 0 and got["b"]["mean_score"] is None


def test_equal_fractions_have_no_spread(spark):
    cases = {"tenths": [0.1] * 3, "thirds": [100 / 3] * 7, "one": [0.7], "mixed": [0.1, 0.1, 0.2, 0.7]}
    rows = [(k, v) for k, vs in cases.items() for v in vs]
    got = score_features(spark.createDataFrame(rows, "film STRING, score DOUBLE")).collect()
    assert len(got) == len(cases)
    for row in got:
        want = expected(cases[row["film"]])
        for name in FEATURE_COLUMNS[1:]:
            assert (row[name] is None) == (want[name] is None) and (want[name] is None or row[name] == pytest.approx(want[name], abs=1e-9)), (row["film"], name)
    equal = [r for r in got if r["film"] in ("tenths", "thirds")]
    assert all(r["std"] == 0 and r["skewness"] == 0 for r in equal)


def test_map_of_lists(spark):
    from marquee.operators.scores import features_from_lists

    lists = spark.createDataFrame([("a", [1.0, 2.0]), ("b", [])], "film STRING, scores ARRAY<DOUBLE>")
    got = {r["film"]: r["n_reviews"] for r in features_from_lists(lists).collect()}
    assert got == {"a": 2, "b": 0}

"""Further features and evaluations that the feature plan lists: ratios, encodings, outliers, tests, calibration."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from marquee.functions.stats import ratio
from marquee.operators.ordering import split_points, with_running_totals, with_slot
from marquee.operators.profile import correlation_matrix, top_categories
from marquee.operators.quantiles import SMALL_ROWS, exact_quantiles
from marquee.operators.sizing import MAX_BROADCAST_ROWS, broadcast_if_small
from marquee.session import materialise


# --- columns --------------------------------------------------------------------------------------------------


def money_ratios(df: DataFrame, low: float, high: float) -> DataFrame:
    """Return on budget, domestic share, gross per minute and a budget category cut at two amounts."""
    budget, world, home = (F.col(c).cast("double") for c in ("budget", "worldwide_gross", "domestic_gross"))
    category = F.when(budget < low, "low").when(budget < high, "medium").when(budget.isNotNull(), "high")
    return df.withColumns(
        {
            "roi_worldwide": ratio(world, budget),
            "us_market_share": ratio(home, world),
            "revenue_per_minute": ratio(world, F.col("runtime_minutes").cast("double")),
            "budget_category": category,
        }
    )


def missing_flags(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    return df.withColumns({f"{c}_missing": F.col(c).isNull().cast("int") for c in columns})


def log_columns(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    return df.withColumns({f"log_{c}": F.log1p(F.col(c).cast("double")) for c in columns})


def winsorise(df: DataFrame, columns: Sequence[str], low: float = 0.01, high: float = 0.99, small_rows: int = SMALL_ROWS) -> DataFrame:
    """Values beyond the two exact quantiles are set to them; missing values stay missing."""
    cuts = exact_quantiles(df, columns, [low, high], small_rows)
    clipped = lambda c: F.greatest(F.lit(cuts[c][0]), F.least(F.lit(cuts[c][1]), F.col(c).cast("double")))
    return df.withColumns({c: F.when(F.col(c).isNotNull(), clipped(c)) for c in columns})


def min_max_scale(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """To 0..1 over the known values; a constant column becomes 0."""
    row = df.agg(*[f(F.col(c).cast("double")).alias(f"{n}_{c}") for c in columns for n, f in (("lo", F.min), ("hi", F.max))]).first()
    spans = {c: (row[f"lo_{c}"] or 0.0, (row[f"hi_{c}"] or 0.0) - (row[f"lo_{c}"] or 0.0)) for c in columns}
    return df.withColumns({c: (F.col(c).cast("double") - F.lit(lo)) / F.lit(span or 1.0) for c, (lo, span) in spans.items()})


def robust_scale(df: DataFrame, columns: Sequence[str], small_rows: int = SMALL_ROWS) -> DataFrame:
    """Minus the median, over the distance of the quartiles."""
    cuts = exact_quantiles(df, columns, [0.25, 0.5, 0.75], small_rows)
    scaled = {}
    for c in columns:
        q1, median, q3 = cuts[c]
        if median is not None:
            scaled[c] = (F.col(c).cast("double") - F.lit(median)) / F.lit((q3 - q1) or 1.0)
    return df.withColumns(scaled)


def fill_with_mode(df: DataFrame, column: str) -> DataFrame:
    """Missing values become the most frequent one; of equally frequent ones the lowest."""
    known = df.filter(F.col(column).isNotNull()).groupBy(column).agg(F.count(F.lit(1)).alias("n"))
    best = known.orderBy(F.col("n").desc(), F.col(column)).first()
    return df if best is None else df.withColumn(column, F.coalesce(column, F.lit(best[column])))


def keyword_flags(df: DataFrame, text: str, keywords: Mapping[str, str]) -> DataFrame:
    """0/1 per keyword: whole words, any case. `keywords` maps output column to the words."""
    edge = r"[^\p{L}\p{N}_]"  # \b differs between Java versions for letters with accents
    pattern = lambda words: rf"(?i)(?:^|{edge})(?:{words})(?:$|{edge})"
    found = lambda words: F.coalesce(F.col(text).rlike(pattern(words)), F.lit(False)).cast("int")
    return df.withColumns({o: found(w) for o, w in keywords.items()})


def tf_idf(df: DataFrame, key: str, text: str, frequent: int = MAX_BROADCAST_ROWS) -> DataFrame:
    """(key, term, tf, df, weight): exact term weights, one row per document and term.

    Terms are lower-case runs between white space; weight = tf * ln((documents + 1) / (df + 1)). A document without a
    term has no row but counts as a document. Texts are shuffled by key and cut into terms after it, so a document's terms are
    counted where it lies, once: the counts are written. They meet the most frequent terms, or all if they are few, without
    moving; only rows of the rarer terms are shuffled by term. Parts of texts are not merged, as their terms are far larger."""
    terms = F.filter(F.split(F.lower(F.coalesce(text, F.lit(""))), r"\s+"), lambda t: t != "")
    parts = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    by_key = df.select(F.col(key), F.col(text)).repartition(parts, F.col(key))
    tf = materialise(by_key.select(F.col(key), F.explode(terms).alias("term")).groupBy(key, "term").agg(F.count("*").alias("tf")))
    per_term = materialise(tf.groupBy("term").agg(F.count("*").alias("df")))
    documents = df.agg(F.count("*").alias("documents"))  # one row
    often = per_term.orderBy(F.col("df").desc(), "term").limit(frequent)
    weighed = tf.join(F.broadcast(often), "term", "left")
    known = weighed.filter(F.col("df").isNotNull())
    if per_term.count() > frequent:
        known = known.unionByName(weighed.filter(F.col("df").isNull()).drop("df").join(per_term, "term").select(*known.columns))
    weight = F.col("tf") * F.log((F.col("documents") + 1) / (F.col("df") + 1))
    return known.join(F.broadcast(documents)).select(key, "term", "tf", "df", weight.alias("weight"))


def indicator_columns(named: DataFrame, name: str, k: int, prefix: str) -> DataFrame:
    """0/1 per film for each of the k most frequent names. The columns are the report's top-k names."""
    top = [r[name] for r in top_categories(named, name, k).collect()]
    has = lambda value: F.coalesce(F.max(F.when(F.col(name) == value, 1)), F.lit(0))
    return named.groupBy("movie_id").agg(*[has(v).alias(f"{prefix}{i + 1}") for i, v in enumerate(top)])


def adjust_for_inflation(df: DataFrame, index: DataFrame, columns: Sequence[str], year: str = "release_year") -> DataFrame:
    """Amounts in money of the index's base; a year without index gives null. `index`: year, factor."""
    factors = index.select(F.col("year").alias(year), "factor")
    joined = df.join(factors, year, "left")
    return joined.withColumns({f"{c}_adjusted": F.col(c).cast("double") * F.col("factor") for c in columns}).drop("factor")


def release_date_features(df: DataFrame, date: str, ceremonies: DataFrame, year: str = "release_year") -> DataFrame:
    """Adds release_month, is_late_year_release (October to December, 0 or 1), days_to_oscar_ceremony and ceremony_delay (whole
    months) to the ceremony that honours the release year. `ceremonies`: year, ceremony_date, a row a year. A missing date
    gives nulls, a year without ceremony nulls for what depends on it."""
    day, held = F.col(date).cast("date"), ceremonies.select(F.col("year").alias("_year"), F.col("ceremony_date").cast("date").alias("_held"))
    joined = df.join(broadcast_if_small(held), F.col(year) == F.col("_year"), "left")
    return joined.withColumns(
        {
            "release_month": F.month(day),
            "is_late_year_release": F.month(day).between(10, 12).cast("int"),
            "days_to_oscar_ceremony": F.datediff("_held", day),
            "ceremony_delay": F.floor(F.months_between("_held", day)).cast("int"),
        }
    ).drop("_year", "_held")


# --- reports --------------------------------------------------------------------------------------------------


def welch_test(df: DataFrame, features: Sequence[str], label: str = "label") -> DataFrame:
    """Welch's t statistic and degrees of freedom per feature between the two classes."""
    of = lambda f, c, k: f(F.when(F.col(label) == k, F.col(c).cast("double")))
    wide = df.agg(
        *[
            F.struct(
                F.lit(c).alias("feature"),
                *[of(f, c, k).alias(f"{n}{k}") for k in (0, 1) for n, f in (("n", F.count), ("m", F.avg), ("v", F.var_samp))],
            ).alias(f"s{i}")
            for i, c in enumerate(features)
        ]
    )
    rows = wide.select(F.explode(F.array(*[F.col(f"s{i}") for i in range(len(features))])).alias("s")).select("s.*")
    e0, e1 = F.col("v0") / F.col("n0"), F.col("v1") / F.col("n1")
    freedom = ratio((e0 + e1) ** 2, e0**2 / (F.col("n0") - 1) + e1**2 / (F.col("n1") - 1))
    return rows.select(
        "feature", ratio(F.col("m1") - F.col("m0"), F.sqrt(e0 + e1)).alias("t"), freedom.alias("degrees_of_freedom")
    )


def yearly_trend(df: DataFrame, columns: Sequence[str], year: str = "release_year", label: str = "label") -> DataFrame:
    """Per year: films, share of positives and the mean of each column; also shows drift."""
    return df.groupBy(year).agg(
        F.count(F.lit(1)).alias("films"),
        F.avg(F.col(label).cast("double")).alias("positive_share"),
        *[F.avg(F.col(c).cast("double")).alias(f"mean_{c}") for c in columns],
    )


def category_by_class(named: DataFrame, films: DataFrame, name: str, label: str = "label") -> DataFrame:
    """Films per category and class."""
    labelled = films.select(F.col("imdb_id").alias("movie_id"), label)
    return named.join(labelled, "movie_id").groupBy(name).agg(
        F.count_if(F.col(label) == 0).alias("n_0"), F.count_if(F.col(label) == 1).alias("n_1")
    )


def calibration(scored: DataFrame, score: str = "prob", label: str = "label", bins: int = 10) -> DataFrame:
    """Mean score and observed share per equal-width bin of the score."""
    place = F.least(F.floor(F.col(score) * bins), F.lit(bins - 1)).cast("int")
    return scored.groupBy(place.alias("bin")).agg(
        F.count(F.lit(1)).alias("n"),
        F.avg(score).alias("mean_score"),
        F.avg(F.col(label).cast("double")).alias("observed_share"),
    )


def redundant_features(df: DataFrame, columns: Sequence[str], limit: float = 0.95) -> list[str]:
    """Columns that correlate beyond the limit with a column kept before them."""
    rows = correlation_matrix(df, columns).filter(F.abs("correlation") > limit).collect()
    strong = {(r["a"], r["b"]) for r in rows}
    kept: list[str] = []
    dropped: list[str] = []
    for c in columns:
        (dropped if any((c, k) in strong for k in kept) else kept).append(c)
    return dropped


# --- splits, sampling and baselines ---------------------------------------------------------------------------


def forward_folds(first: int, last: int, test_years: int, min_train: int) -> list[tuple[tuple[int, int], tuple[int, int]]]:
    """(train, test) year ranges that only look forward."""
    out = []
    end = first + min_train - 1
    while end + test_years <= last:
        out.append(((first, end), (end + 1, end + test_years)))
        end += test_years
    return out


def undersample(df: DataFrame, label: str = "label", seed: int = 42) -> DataFrame:
    """Random subset of the larger class, about as large as the smaller one."""
    counts = {r[label]: r["n"] for r in df.groupBy(label).agg(F.count(F.lit(1)).alias("n")).collect()}
    smallest = min(counts.values(), default=0)
    return df.sampleBy(label, {k: smallest / n for k, n in counts.items()}, seed)


def random_scores(df: DataFrame, out: str = "prob", seed: int = 42) -> DataFrame:
    """A baseline that guesses."""
    return df.withColumn(out, F.rand(seed))


def _numbered(df: DataFrame, order: Column, out: str) -> DataFrame:
    placed = materialise(df.withColumns({"_order": order, "_one": F.lit(1).cast("long")}))
    slotted = with_slot(placed, "_order", split_points(placed, "_order"), "_slot")
    ties = [F.col(c) for c in df.columns]
    return with_running_totals(slotted, {out: "_one"}, [F.col("_order"), *ties], bounded_slots=True).drop("_order", "_one")


def shuffled_column(df: DataFrame, column: str, key: str, seed: int = 42) -> DataFrame:
    """The frame with the values of one column moved to random rows. Both sides are numbered in slots and joined."""
    slots = _numbered(df.select(key), F.xxhash64(key, F.lit(seed)).cast("double"), "_at")
    values = _numbered(df.select(F.col(key).alias("_k"), column), F.xxhash64("_k", F.lit(seed + 1)).cast("double"), "_at").drop("_k")
    moved = slots.join(values, "_at").drop("_at")
    return df.drop(column).join(moved, key).select(*df.columns)


def permutation_importance(fitted, df: DataFrame, columns: Sequence[str], key: str = "imdb_id", seed: int = 42) -> DataFrame:
    """Loss of area under the curve when one column is shuffled, largest first."""
    from marquee.operators.metrics import roc_auc

    data = materialise(df)
    area = lambda frame: roc_auc(materialise(fitted.score(frame).select("prob", "label")), "prob").first()["roc_auc"]
    base = area(data)
    rows = [(c, float(base - area(shuffled_column(data, c, key, seed)))) for c in columns]
    return df.sparkSession.createDataFrame(rows, "feature STRING, loss DOUBLE").orderBy(F.col("loss").desc(), "feature")

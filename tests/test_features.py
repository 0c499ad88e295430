import statistics
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from marquee.plans.features import ml_training_dataset, split
from marquee.schemas import SPLITS, TABLE_DDL

COLUMNS = (
    "imdb_id original_title release_year imdb_rating imdb_votes runtime_minutes metascore box_office_rank_in_year "
    "votes_normalized_by_year rating_normalized_by_year n_samples mean_score median_score stddev_score p90_score min_score "
    "max_score num_genres num_countries num_languages num_directors num_writers num_cast director_prev_nominations "
    "cast_prev_nominations is_drama is_biography is_history label"
).split()


def film(key, year, votes, rating, nominated=False):
    return (key, key.upper(), None, year, Decimal(rating), votes, 100, nominated, False, None, None, 50, None)


@pytest.fixture(scope="module")
def dataset(spark):
    rows = {name: [] for name in TABLE_DDL}
    rows["movies"] = [
        film("a", 2001, 10, "5.0"),
        film("b", 2001, 20, "5.0"),
        film("c", 2001, 60, "5.0", True),
        film("d", 2001, None, "5.0"),
        film("solo", 2002, 5, "9.0"),
        film("late", 2003, 7, "6.0"),
        film("late2", 2003, 7, "8.0"),
    ]
    rows["movies"] += [film(f"y{y}", y, 1, "1.0") for y in (1999, 2000, 2019, 2020, 2022, 2023, 2024, 2025)]
    gross = {"a": "5", "b": "5", "c": None, "d": None, "late": "1"}
    rows["movie_box_office"] = [(k, None, v and Decimal(v), None) for k, v in gross.items()]
    rows["genres"] = [(1, "Drama"), (2, "Biography"), (3, "War")]
    rows["people"] = [(1, "P"), (2, "Q")]
    rows["countries"], rows["languages"] = [(1, "X")], [(1, "Y")]
    rows["movie_genres"] = [("a", 1), ("a", 3), ("b", 2)]
    rows["movie_countries"], rows["movie_languages"] = [("a", 1)], [("b", 1)]
    rows["movie_people"] = [("c", 1, "writer", None), ("late", 1, "director", None), ("late", 2, "cast", 1)]
    rows["rating_samples"] = [(1, "a", 50, 1), (2, "a", 70, 2)]
    frames = {n: spark.createDataFrame(rows[n], ddl) for n, ddl in TABLE_DDL.items()}
    return ml_training_dataset(frames)


@pytest.fixture(scope="module")
def by_id(dataset):
    return {r["imdb_id"]: r for r in dataset.collect()}


def test_columns(dataset):
    assert dataset.columns == COLUMNS


def test_rank_shares_ties_and_nulls_last(by_id):
    assert [by_id[k]["box_office_rank_in_year"] for k in "abcd"] == [1, 1, 3, 3]


def test_zscores(by_id):
    sd = statistics.stdev([10, 20, 60])
    assert by_id["c"]["votes_normalized_by_year"] == pytest.approx((60 - 30) / sd)
    assert by_id["d"]["votes_normalized_by_year"] is None
    assert by_id["a"]["rating_normalized_by_year"] is None  # constant in its year
    assert by_id["solo"]["votes_normalized_by_year"] is None
    assert by_id["late"]["votes_normalized_by_year"] is None
    assert by_id["late2"]["rating_normalized_by_year"] == pytest.approx(2**-0.5)


def test_counts_and_history(by_id):
    a, late = by_id["a"], by_id["late"]
    assert (a["num_genres"], a["num_countries"], a["num_languages"], a["is_drama"], a["is_biography"]) == (2, 1, 0, 1, 0)
    assert (a["n_samples"], a["mean_score"], a["min_score"]) == (2, 60.0, 50)
    assert (by_id["b"]["n_samples"], by_id["b"]["mean_score"], by_id["b"]["max_score"]) == (0, 0.0, 0)
    assert (late["director_prev_nominations"], late["cast_prev_nominations"]) == (1, 0)
    assert by_id["c"]["label"] == 1 and by_id["c"]["num_writers"] == 1


def test_splits(dataset):
    found = {}
    for name, (first, last) in SPLITS.items():
        for r in split(dataset, first, last).select("imdb_id").filter(F.col("imdb_id").startswith("y")).collect():
            found.setdefault(r[0], []).append(name.removeprefix("ml_split_"))
    assert found == {
        "y2000": ["train"], "y2019": ["train"], "y2020": ["validation"], "y2022": ["validation"],
        "y2023": ["test"], "y2024": ["test"], "y2025": ["prediction_2025"],
    }


def test_year_filter_reaches_the_scan(spark, folder, dataset):
    from marquee.plans.features import with_year_zscores

    movies = spark.createDataFrame([film("a", 2001, 1, "1.0"), film("b", 2002, 1, "1.0")], TABLE_DDL["movies"])
    movies.write.parquet(f"{folder}/movies")
    plan = split(with_year_zscores(spark.read.parquet(f"{folder}/movies")), 2000, 2001)._jdf.queryExecution().toString()
    assert "PushedFilters: [IsNotNull(release_year), GreaterThanOrEqual(release_year,2000)" in plan


def test_splits_read_their_years(spark, folder):
    from pyspark.sql import functions as F

    from marquee.plans.features import read_dataset, split, store_dataset

    rows = spark.range(400).select(F.col("id").cast("string").alias("imdb_id"), F.when(F.col("id") % 7 > 0, 2000 + F.col("id") % 7).cast("int").alias("release_year"), F.lit(1).alias("label"))
    stored = store_dataset(rows, f"{folder}/features")
    assert stored.dtypes == rows.dtypes and stored.exceptAll(rows).isEmpty() and rows.exceptAll(stored).isEmpty()
    part = split(read_dataset(spark, f"{folder}/features", rows.schema), 2002, 2003)
    plan = part._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(release_year" in plan and "PushedFilters: []" in plan
    assert {r.release_year for r in part.collect()} == {2002, 2003}
    years = spark.createDataFrame([(2005, "x")], "year INT, why STRING").filter("why = 'x'")
    joined = stored.join(F.broadcast(years), F.col("release_year") == F.col("year"))
    assert "dynamicpruning" in joined._jdf.queryExecution().executedPlan().toString().lower()
    assert joined.count() == rows.filter("release_year = 2005").count()


def test_input_tables_move_only_what_they_need(spark, folder):
    """Scores are settled by the columns up to their own; both bridges of parts come from one join, null types and repeated parts
    included."""
    from checks import film

    part = [(1, "A", "x"), (1, "B", "x"), (2, None, "y"), (3, "A", None), (4, "C", "z"), (None, "A", "x")]
    spark.createDataFrame(part, "p_partkey BIGINT, p_type STRING, p_brand STRING").write.parquet(f"{folder}/part.parquet")
    kinds = "l_orderkey BIGINT, l_linenumber INT, l_partkey BIGINT, l_suppkey BIGINT, l_quantity DOUBLE, l_extendedprice DOUBLE, l_discount DOUBLE, l_tax DOUBLE, l_returnflag STRING, l_linestatus STRING, l_shipdate DATE"
    lines = [(k % 5, k % 2, p, s, q, float(-k), 0.0, 0.0, "R", "F", None) for k, (p, s, q) in enumerate((p, s, q) for p in (None, 1, 2, 3, 4, 9) for s in (None, 1) for q in (None, 1.0, 2.0))]
    spark.createDataFrame(lines, kinds).write.parquet(f"{folder}/lineitem.parquet")
    links = film.part_links(spark, folder)
    for column, id_column in (("p_type", "genre_id"), ("p_brand", "language_id")):
        got, want = film.bridge_of(links, id_column), film.part_bridge(spark, folder, column, id_column)
        assert sorted(map(tuple, got.collect())) == sorted(map(tuple, want.collect()))
    scores = film.rating_samples(spark, folder)
    want = film.lines(spark, folder).select(F.col("l_orderkey").cast("string"), (F.col("l_quantity") * 2).cast("smallint"), "l_linenumber")
    assert sorted(map(str, scores.collect())) == sorted(map(str, want.toDF(*scores.columns).collect()))
    assert "l_shipdate" not in scores._jdf.queryExecution().executedPlan().toString()

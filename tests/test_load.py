import csv
import json
import os
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from marquee.operators.dimensions import extend_dimension
from marquee.operators.quality import ExpectationFailed, Expectations, enforce, quarantine, table_expectations
from marquee.operators.relations import bridge_with_names
from marquee.plans.load import build_tables
from marquee.schemas import CATALOGUE_COLUMNS, TABLE_DDL
from marquee.sources import catalogue, sinks, tables


def film_row(key, title, **more):
    row = dict.fromkeys(CATALOGUE_COLUMNS, "")
    row |= {"ID IMDb": key, "Título Original": title, "Ano Lançamento": "2001", "Indicado Oscar": "Não", "Vencedor Oscar": "Não"}
    return row | more


def write_rows(path, rows):
    with open(path, "w", encoding="utf-8", newline="") as f:
        writer = csv.DictWriter(f, CATALOGUE_COLUMNS)
        writer.writeheader()
        writer.writerows(rows)


FIRST = [
    film_row(
        "tt1",
        'A "quoted", title',
        **{
            "Nota IMDb": "7.8",
            "Votos": "1200",
            "Indicado Oscar": " sim ",
            "Gêneros": "Drama, War,,Drama",
            "Diretores": "Ann",
            "Elenco Principal": "Bob, ,Cy, Ann",
            "Bilheteria Mundial": "USD 1,234,567",
            "Sinopse": "two\nlines, with comma",
        },
    ),
    film_row("tt2", "B", **{"Gêneros": "War", "Diretores": "Bob, Ann", "Metascore": "N/A", "Orçamento": "1.2.3"}),
    film_row("tt1", "ignored", **{"Gêneros": "History", "Nota IMDb": "1.0"}),
    film_row("tt9", "known to fail"),
]
SECOND = [film_row("tt3", "C", **{"Gêneros": "Comedy, Drama", "Diretores": "Dee"}), film_row("tt2", "again")]


@pytest.fixture(scope="module")
def inputs(spark, tmp_path_factory):
    root = tmp_path_factory.mktemp("load")
    os.mkdir(root / "csv")
    write_rows(root / "csv" / "part-1.csv", FIRST)
    write_rows(root / "csv" / "part-2.csv", SECOND)
    (root / "scores.json").write_text(json.dumps({"tt1": [90, 80.9, 70], "tt2": [], "tt8": [10]}))
    (root / "errors.json").write_text(json.dumps({"tt9": None}))
    raw = catalogue.read_catalogue(spark, str(root / "csv"))
    scores = catalogue.read_score_map(spark, str(root / "scores.json"))
    errors = catalogue.read_key_set(spark, str(root / "errors.json"))
    return raw, scores, errors


@pytest.fixture(scope="module")
def built(inputs):
    return build_tables(*inputs)


def test_order_follows_files_and_rows(inputs):
    rows = inputs[0].orderBy("ordinal").select("`ID IMDb`").collect()
    assert [r[0] for r in rows] == ["tt1", "tt2", "tt1", "tt9", "tt3", "tt2"]


def test_first_scalars_and_types(built):
    got = {r["imdb_id"]: r for r in built[0]["movies"].collect()}
    assert set(got) == {"tt1", "tt2", "tt3"}
    assert got["tt1"]["original_title"] == 'A "quoted", title' and got["tt1"]["imdb_rating"] == Decimal("7.8")
    assert got["tt1"]["nominated_oscar"] is True and got["tt1"]["synopsis"] == "two\nlines, with comma"
    assert got["tt2"]["original_title"] == "B" and got["tt2"]["metascore"] is None and got["tt2"]["br_title"] is None
    money = {r["movie_id"]: r for r in built[0]["movie_box_office"].collect()}
    assert money["tt1"]["worldwide_gross"] == Decimal("1234567.00") and money["tt2"]["budget"] is None


def names(tables_, bridge, dimension, id_column):
    return bridge_with_names(tables_[bridge], tables_[dimension], id_column, "name")


def test_relations_are_united(built):
    rows = names(built[0], "movie_genres", "genres", "genre_id").collect()
    assert sorted((r["movie_id"], r["name"]) for r in rows) == [
        ("tt1", "Drama"), ("tt1", "History"), ("tt1", "War"), ("tt2", "War"), ("tt3", "Comedy"), ("tt3", "Drama"),
    ]
    people = names(built[0], "movie_people", "people", "person_id").collect()
    assert sorted((r["movie_id"], r["role"], r["name"], r["cast_order"]) for r in people if r["movie_id"] == "tt1") == [
        ("tt1", "cast", "Ann", 3), ("tt1", "cast", "Bob", 1), ("tt1", "cast", "Cy", 2), ("tt1", "director", "Ann", None),
    ]


def test_ids_follow_first_appearance(built):
    ids = {r["name"]: r["id"] for r in built[0]["genres"].collect()}
    assert ids == {"Drama": 1, "War": 2, "History": 3, "Comedy": 4}
    ids = {r["name"]: r["id"] for r in built[0]["people"].collect()}
    assert ids == {"Ann": 1, "Bob": 2, "Cy": 3, "Dee": 4}


def test_samples_and_reports(built):
    rows = sorted(tuple(r) for r in built[0]["rating_samples"].select("movie_id", "sample_index", "score_value").collect())
    assert rows == [("tt1", 1, 90), ("tt1", 2, 80), ("tt1", 3, 70)]
    assert [r["movie_id"] for r in built[1]["orphan_samples"].collect()] == ["tt8"]
    assert [tuple(r) for r in built[1]["skipped"].collect()] == [("tt9", "known to fail")]


def test_second_load_adds_nothing_twice(inputs, built):
    again, _ = build_tables(*inputs, existing=built[0])
    for name in ("movies", "movie_box_office", "movie_genres", "movie_people", "rating_samples"):
        assert again[name].count() == 0, name
    assert sorted(map(tuple, again["people"].collect())) == sorted(map(tuple, built[0]["people"].collect()))


def test_null_token(inputs):
    out, _ = build_tables(*inputs, null_token="nan")
    assert "nan" in {r["name"] for r in out["languages"].collect()}


def test_dimension_extension(spark):
    old = spark.createDataFrame([(7, "x")], "id BIGINT, name STRING")
    rows = [("b", 2), ("x", 1), ("a", 3), ("b", 9), (None, 0)]
    new = extend_dimension(spark.createDataFrame(rows, "name STRING, ordinal BIGINT"), old, parts=2)
    assert {r["name"]: r["id"] for r in new.collect()} == {"x": 7, "b": 8, "a": 9}
    many = spark.range(1000).select(F.col("id").alias("ordinal"), (999 - F.col("id")).cast("string").alias("name"))
    got = {r["name"]: r["id"] for r in extend_dimension(many, parts=16).collect()}
    assert got == {str(999 - i): i + 1 for i in range(1000)}


def test_missing_column(spark, folder):
    with open(f"{folder}/bad.csv", "w") as f:
        f.write("ID IMDb,Votos\ntt1,3\n")
    with pytest.raises(ExpectationFailed, match="Sinopse"):
        catalogue.read_catalogue(spark, f"{folder}/bad.csv")


def test_tolerant_read(spark, folder):
    assert catalogue.read_or_empty(spark, f"{folder}/nothing", "id STRING").count() == 0
    with open(f"{folder}/some.json", "w") as f:
        f.write('{"id": "a"}\n{"id": \n{"id": "b"}\n')
    assert sorted(r["id"] for r in catalogue.read_or_empty(spark, f"{folder}/some.json", "id STRING").collect()) == ["a", "b"]


def test_broken_objects_are_errors(spark, folder):
    for i, text in enumerate(["{broken", '{"a": [1, 2', '{"a": null, "b"']):
        with open(f"{folder}/map{i}.json", "w") as f:
            f.write(text)
        for read in (catalogue.read_key_set, catalogue.read_score_map):
            with pytest.raises(Exception, match="MALFORMED|malformed|parse"):
                read(spark, f"{folder}/map{i}.json").collect()


def test_last_list_of_a_key_counts(spark, folder):
    with open(f"{folder}/map.json", "w") as f:
        f.write('{"a": [90, 10], "b": [], "a": [20, 80, 30]}')
    rows = sorted(map(tuple, catalogue.read_score_map(spark, f"{folder}/map.json").collect()), key=str)
    assert rows == [("a", 1, 20.0), ("a", 2, 80.0), ("a", 3, 30.0), ("b", None, None)]


def test_columns_in_another_order_are_an_error(spark, folder):
    for name, header, row in (("1", "id,text", "a,x"), ("2", "text,id", "y,b")):
        with open(f"{folder}/{name}.csv", "w") as f:
            f.write(header + "\n" + row + "\n")
    with pytest.raises(Exception, match="(?i)header"):
        catalogue.read_catalogue(spark, folder, ["id", "text"]).collect()


def test_score_lines(spark, folder):
    with open(f"{folder}/lines.json", "w") as f:
        f.write('{"id": "a", "scores": [1, 2.5]}\n{"id": "b", "scores": []}\n')
    rows = sorted(map(tuple, catalogue.read_score_lines(spark, f"{folder}/lines.json").collect()), key=str)
    assert rows == [("a", 1, 1.0), ("a", 2, 2.5), ("b", None, None)]


def complete(spark, built):
    out = dict(built[0])
    out["rating_samples"] = out["rating_samples"].withColumn("id", F.monotonically_increasing_id())
    return {n: out[n].select(*[c for c in spark.createDataFrame([], ddl).columns]) for n, ddl in TABLE_DDL.items()}


def test_publish_all_or_nothing(spark, built, folder):
    good = complete(spark, built)
    assert sinks.read_published(spark, folder, ["movies"]) is None
    sinks.publish(good, folder, table_expectations())
    bad = good | {"movies": good["movies"].withColumn("metascore", F.lit(101))}
    with pytest.raises(ExpectationFailed, match="metascore_range: 3"):
        sinks.publish(bad, folder, table_expectations())
    seen = sinks.read_published(spark, folder, ["movies", "genres"])
    assert seen["movies"].filter("metascore = 101").count() == 0 and seen["genres"].count() == 4
    run = sinks.publish(good, folder)
    assert set(tables.read_tables(spark, f"{folder}/{run}")) == set(TABLE_DDL)


def test_expectations_find_breaks(spark, built):
    good = complete(spark, built)
    enforce(good, table_expectations())
    twice = good | {"genres": good["genres"].unionByName(good["genres"])}
    with pytest.raises(ExpectationFailed, match="genres.unique:name: 4"):
        enforce(twice, table_expectations())
    orphan = good | {"people": good["people"].filter("name <> 'Ann'")}
    with pytest.raises(ExpectationFailed, match="movie_people.parent:person_id: 3"):
        enforce(orphan, table_expectations())


def test_quarantine(spark):
    df = spark.createDataFrame([("a", 5), (None, 5), ("b", 500), ("c", None)], "k STRING, v INT")
    good, bad = quarantine(df, Expectations(required=["k"], rules={"v_range": F.col("v").between(0, 100)}))
    assert sorted(r["k"] for r in good.collect()) == ["a", "c"]
    assert sorted(r["reasons"] for r in bad.collect()) == [["required:k"], ["rule:v_range"]]


def test_quarantine_of_keys_and_parents(spark):
    rows = [("a", 1, "x"), ("a", 1, "x"), ("b", 1, "y"), ("a", 2, None), (None, 1, "x"), (None, 1, "x"), ("c", 3, "gone")] + [("hot", 9, "x")] * 30
    df = spark.createDataFrame(rows, "k STRING, v INT, p STRING")
    parents = {"t": spark.createDataFrame([("x",), ("x",), ("y",), (None,)], "id STRING")}
    e = Expectations(required=["k"], unique=[["k", "v"]], rules={"v_range": F.col("v") < 9}, parents={"p": ("t", "id")})
    good, bad = quarantine(df, e, parents)
    assert sorted(map(str, good.collect())) == sorted(["Row(k='b', v=1, p='y')", "Row(k='a', v=2, p=None)"])
    got = [(r.k, r.reasons) for r in bad.collect()]
    want = [("a", ["unique:k,v"])] * 2 + [(None, ["required:k"])] * 2 + [("c", ["parent:p"])] + [("hot", ["rule:v_range", "unique:k,v"])] * 30
    assert sorted(map(str, got)) == sorted(map(str, want)) and good.columns == df.columns
    empty_good, empty_bad = quarantine(df.filter("false"), e, parents)
    assert empty_good.count() == empty_bad.count() == 0


def test_two_publishers(spark, folder):
    """All publishers of one moment get a version of their own, in the order in which they come."""
    from concurrent.futures import ThreadPoolExecutor

    with ThreadPoolExecutor(8) as pool:
        versions = list(pool.map(lambda i: sinks.commit(spark, folder, f"run-{i}"), range(16)))
    assert sorted(versions) == list(range(1, 17))
    assert sinks.current_run(spark, folder) == f"run-{versions.index(16)}"


def test_json_is_replaced_whole(spark, folder):
    frame = lambda n: spark.range(n).withColumn("v", F.lit(n))
    path = f"{folder}/json"
    assert sinks.read_json(spark, path, "id LONG, v INT") is None
    sinks.write_json(frame(20), path)
    before = sinks.read_json(spark, path, "id LONG, v INT")  # a reader that has begun
    sinks.write_json(frame(3).repartition(3), path)
    assert before.count() == 20 and {r.v for r in before.collect()} == {20}
    assert {r.v for r in sinks.read_json(spark, path, "id LONG, v INT").collect()} == {3}


def test_catalogue_round_trip(spark, inputs, folder):
    raw = inputs[0]
    sinks.write_catalogue(raw, f"{folder}/out")
    back = catalogue.read_catalogue(spark, f"{folder}/out")
    assert sorted(map(str, back.drop("ordinal").collect())) == sorted(map(str, raw.drop("ordinal").collect()))
    with pytest.warns(UserWarning, match="raw zone"):
        sinks.export_to_csv(raw.select("`ID IMDb`"), "x", f"{folder}/data/raw")


def test_pages_by_default_markers(spark):
    from marquee.sources import pages

    card = lambda inner: f'<div class="a c-siteReviewHeader_reviewScore b"><a href="#"><div><div>{inner}</div></div></a></div>'
    blocks = (
        '<div id="u" data-testid="critic-reviews-title"><div><div></div><div><a href="/first">1</a></div></div>'
        '<div><div><a href="/second">2</a></div><div><p><a id="x" href="https://www.metacritic.com/movie/a-b?x=1&amp;y">3</a></p></div></div></div>'
    )
    rows = [
        (1, "<script>Showing 9 Critic Reviews</script>Showing <b>3</b> Critic Reviews" + card("<span> 85 </span>") + card("tbd") + card("<span>&#57;&#x30;</span>") + card("<span>1</span>") + blocks),
        (2, "showing 1 critic reviews" + card("") + "<p><span>77</span></p>"),
        (3, "no count" + card("<span>5</span>") + '<div data-testid="critic-reviews-title"><div><a href="/x">x</a></div></div><div><div></div><div><a href="/y">y</a></div></div>'),
        (4, None),
        (5, ""),
    ]
    df = spark.createDataFrame([(i, "https://db.example/title/1", h) for i, h in rows], "page_id INT, url STRING, html STRING")
    found = pages.review_scores(df)
    assert {r.page_id: (r.declared, r.cards) for r in found.collect()} == {1: (3, ["85", "tbd", "90"]), 2: (1, [""]), 3: (None, None), 4: (None, None), 5: (None, None)}
    assert sorted((r.page_id, r.sample_index, r.score) for r in pages.score_rows(found).filter("score is not null").collect()) == [(1, 1, 85), (1, 3, 90)]
    assert sorted((r.id, r.sample_index, r.text) for r in pages.score_rejects(found).collect()) == [(1, 2, "tbd"), (2, 1, "")]
    assert sorted(r.id for r in pages.pages_without_count(found).collect()) == [3, 4, 5]
    links = {r.page_id: (r.link, r.slug) for r in pages.review_links(df).collect()}
    assert links[1] == ("https://www.metacritic.com/movie/a-b?x=1&y", "a-b") and all(links[k] == (None, None) for k in (2, 3, 4, 5))


def test_rejects(spark, folder):
    path = f"{folder}/rejects"
    assert sinks.read_rejects(spark, path).count() == 0
    rows = spark.createDataFrame([("a", "timeout")], "id STRING, reason STRING")
    sinks.append_rejects(rows, path)
    sinks.append_rejects(rows, path)
    assert sinks.read_rejects(spark, path).count() == 1


def test_bundle_and_views(spark, built):
    from marquee.plans.features import register_views

    frames = complete(spark, built)
    bundle = tables.load_all_data(frames)
    assert len(bundle) == 9 and len(bundle["ml_dataset"].columns) == 29
    assert [r["role"] for r in bundle["movie_people"].collect()][:4] == ["director", "cast", "cast", "cast"]
    register_views(spark, frames)
    got = tables.run_custom_query(spark, "SELECT imdb_id FROM ml_split_train WHERE num_genres >= :n", {"n": 2})
    assert sorted(r[0] for r in got.collect()) == ["tt1", "tt3"]

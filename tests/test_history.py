import random

import pytest

from marquee.operators import history
from marquee.operators.history import coworkers, distinct_reached, earlier_successes, success_counts
from marquee.operators.ordering import numbered

OUT = {"d": "director", "c": "cast"}


def brute(films, involved):
    year, good = {f: y for f, y, _ in films}, {f for f, _, g in films if g}
    out = {}
    for f, y, _ in films:
        for o, role in OUT.items():
            mine = {p for m, p, r in involved if m == f and r == role}
            n = len({m for m, p, _ in involved if p in mine and m in good and year[m] < y})
            if n:
                out.setdefault(f, {"d": 0, "c": 0})[o] = n
    return out


def run(spark, films, involved, hot):
    f = spark.createDataFrame(films, "imdb_id STRING, release_year INT, nominated_oscar BOOLEAN")
    i = spark.createDataFrame(involved, "movie_id STRING, person_id BIGINT, role STRING")
    got = earlier_successes(f, i, OUT, hot=hot).collect()
    return {r["movie_id"]: {"d": r["d"], "c": r["c"]} for r in got if r["d"] or r["c"]}


@pytest.mark.parametrize("hot", [0, 2, 10, 5000])
def test_against_brute_force(spark, hot):
    rng = random.Random(hot)
    films = [(f"m{i}", rng.randint(2000, 2010), rng.random() < 0.4) for i in range(150)]
    involved = set()
    for f, _, _ in films:
        for _ in range(rng.randint(1, 5)):
            person = 0 if rng.random() < 0.35 else rng.randint(1, 40)  # one person holds a third of the rows
            involved.add((f, person, rng.choice(["director", "writer", "cast"])))
    involved = sorted(involved)
    assert run(spark, films, involved, hot) == brute(films, involved)


def test_edges(spark):
    films = [
        ("now", 2010, False),
        ("same_year", 2010, True),
        ("later", 2011, True),
        ("earlier_loser", 2005, False),
        ("earlier_writer", 2006, True),
        ("shared", 2007, True),
    ]
    involved = [
        ("now", 1, "director"),
        ("now", 2, "director"),
        ("same_year", 1, "director"),
        ("later", 1, "director"),
        ("earlier_loser", 1, "director"),
        ("earlier_writer", 1, "writer"),
        ("shared", 1, "cast"),
        ("shared", 2, "director"),
    ]
    for hot in (0, 1, 100):
        got = run(spark, films, involved, hot)
        assert got["now"] == {"d": 2, "c": 0}
        assert got == brute(films, involved)


def test_forty_hubs_who_share_films(spark):
    rng = random.Random(8)
    films = [(f"m{i}", rng.randint(2000, 2006), rng.random() < 0.5) for i in range(300)]
    involved = sorted({(f, rng.choice([-1 - rng.randrange(40), rng.randint(1, 200)]), "director") for f, _, _ in films for _ in range(6)})
    for hot in (3, 20):
        assert run(spark, films, involved, hot) == brute(films, involved)


def test_busy_people_never_meet(spark):
    """Above the limit, no join has the person as key on two sides that both hold films: sets of people meet bitmaps."""
    films = spark.createDataFrame([(f"m{i}", 2000 + i % 5, i % 2 == 0) for i in range(60)], "imdb_id STRING, release_year INT, nominated_oscar BOOLEAN")
    involved = spark.createDataFrame([(f"m{i}", -1 - (i + k) % 4, "director") for i in range(60) for k in range(3)], "movie_id STRING, person_id BIGINT, role STRING")
    df = success_counts(films, involved, {"d": "director"}, hot=5)
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "bitmap_or_agg" in plan and "bitmap_construct_agg" in plan
    few = success_counts(films, involved, {"d": "director"}, hot=500)
    assert "bitmap_or_agg" not in few._jdf.queryExecution().executedPlan().toString()
    assert sorted(map(tuple, df.collect())) == sorted(map(tuple, few.collect()))


def test_short_sets_need_no_bitmaps(spark, monkeypatch):
    """Forty hubs, at most three a film: the sets are counted by their subsets, no link of a hub becomes a bitmap."""
    rng = random.Random(3)
    films = [(f"m{i}", rng.randint(2000, 2006), rng.random() < 0.5) for i in range(300)]
    involved = sorted({(f, -1 - rng.randrange(40), "director") for f, _, _ in films for _ in range(3)} | {(f, rng.randint(1, 90), "director") for f, _, _ in films})
    made, plain = [], history.item_bitmaps
    monkeypatch.setattr(history, "item_bitmaps", lambda links: made.append(links.count()) or plain(links))
    assert run(spark, films, involved, 15) == brute(films, involved)
    assert sum(made) == 0


def test_pairs_are_shuffled_once(spark):
    """What a film reaches through people with few films is shuffled by film once, as lists."""
    films = spark.createDataFrame([(f"m{i}", 2000 + i % 5, i % 2 == 0) for i in range(60)], "imdb_id STRING, release_year INT, nominated_oscar BOOLEAN")
    involved = spark.createDataFrame([(f"m{i}", i % 7, "director") for i in range(60)], "movie_id STRING, person_id BIGINT, role STRING")
    plan = success_counts(films, involved, {"d": "director"})._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange hashpartitioning(role") == 1
    assert plan.index("Generate explode(items") < plan.index("Exchange hashpartitioning(role")  # the plan is printed from its end


@pytest.mark.parametrize("few", [0, 1, 2, 6])
@pytest.mark.parametrize("hot", [1, 4, 12])
def test_sets_of_any_size(spark, few, hot):
    rng = random.Random(few * 100 + hot)
    mine = [(f"k{i}", rng.choice([*range(8)] * 3 + [*range(8, 60)]), 2000 + i % 4) for i in range(60) for _ in range(rng.randint(1, 7))]
    theirs = [(rng.choice([*range(8)] * 2 + [*range(8, 60)]), f"t{i}", 1999 + i % 4) for i in range(120) for _ in range(rng.randint(1, 5))]
    want = {}
    for k, via, year in mine:
        want.setdefault(k, set()).update(t for v, t, then in theirs if v == via and then < year)
    m, t = spark.createDataFrame(mine, "key STRING, via INT, year INT"), spark.createDataFrame([*theirs, (None, "t0", 1999)] * 2, "via INT, item STRING, then INT")
    got = {r.key: r.n for r in distinct_reached(m, t, ["key"], hot, few).collect()}
    assert {k: n for k, n in got.items() if n} == {k: len(s) for k, s in want.items() if s}


@pytest.mark.parametrize("role", [None, "director", "cast"])
@pytest.mark.parametrize("hot", [0, 8, 1000])
def test_coworkers(spark, hot, role):
    """One film holds a third of all rows, and some people work alone."""
    rng = random.Random(2)
    involved = [("big" if rng.random() < 0.33 else f"m{rng.randrange(80)}", rng.randrange(150), rng.choice(["director", "cast"])) for _ in range(500)]
    involved += [("alone", 999, "director"), ("alone2", 999, "cast"), ("big", 5, "cast"), ("big", 5, "cast"), (None, 5, "cast"), ("m1", None, "director")]
    crews = {}
    for m, p, _ in involved:
        if m is not None and p is not None:
            crews.setdefault(m, set()).add(p)
    want = {}
    for m, p, r in involved:
        if m is not None and p is not None and role in (None, r):
            want[p] = want.get(p, set()) | crews[m]
    df = spark.createDataFrame(involved, "movie_id STRING, person_id BIGINT, role STRING")
    got = {r.person_id: r.coworkers for r in coworkers(df, role, hot=hot).collect()}
    assert got == {p: len(s) - 1 for p, s in want.items()}


def test_numbered(spark):
    rng = random.Random(1)
    rows = [(rng.randrange(9) if rng.random() < 0.9 else None, i) for i in range(300)]
    got = numbered(spark.createDataFrame(rows, "a int, b int").repartition(7), ["a", "b"], "n").orderBy("n").collect()
    assert [r.n for r in got] == list(range(300))
    assert [(r.a, r.b) for r in got] == sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0, r[1]))


@pytest.mark.parametrize("lists", [0, 2, 16])
def test_keys_with_few_and_many_lists(spark, monkeypatch, lists):
    """Lists of a key are counted as one, or unfolded where there are more of them than the limit; the numbers are the same."""
    rng = random.Random(5)
    films = [(f"m{i}", rng.randint(2000, 2006), rng.random() < 0.5) for i in range(120)]
    films.append(("m0", 2006, True))  # a key of two years
    involved = [(f, rng.randrange(50), rng.choice(["director", "cast"])) for f, _, _ in films for _ in range(rng.randint(1, 6))]
    monkeypatch.setattr(history, "LISTS", lists)
    years = {}
    for f, y, g in films:
        years.setdefault(f, []).append((y, g))
    want = {}
    for f, ys in years.items():
        for o, role in OUT.items():
            mine = {p for m, p, r in involved if m == f and r == role}
            met = {m for m, p, _ in involved if p in mine and any(g and then < y for then, g in years[m] for y, _ in ys)}
            if met:
                want.setdefault(f, {"d": 0, "c": 0})[o] = len(met)
    assert run(spark, films, involved, 5000) == want


def test_lists_hold_numbers_and_are_not_unfolded(spark):
    """Earlier films are shuffled as numbers, whatever their keys are, and are put together by film before any is unfolded."""
    films = spark.createDataFrame([(f"m{i}", 2000 + i % 5, i % 2 == 0) for i in range(60)], "imdb_id STRING, release_year INT, nominated_oscar BOOLEAN")
    involved = spark.createDataFrame([(f"m{i}", i % 7, "director") for i in range(60)], "movie_id STRING, person_id BIGINT, role STRING")
    plan = success_counts(films, involved, {"d": "director"})._jdf.queryExecution().executedPlan().toString()
    assert "array_distinct(flatten(" in plan
    scanned = [line for line in plan.split("\n") if "FileScan parquet" in line and "item" in line]
    assert scanned and all("item:bigint" in line for line in scanned)

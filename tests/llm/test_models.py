"""Nearest vectors, line field, recurrent model and licences against brute force."""

import itertools
import math
import re
import zlib
from collections import Counter

import numpy as np
from pyspark.sql import functions as F

from marquee.llm import gru, licences, neighbours, quality, scoring
from marquee.llm.licences import Automaton
from marquee.llm.neighbours import perturbations

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def _nearest(vectors, asked, n):
    names = np.array(sorted(vectors))
    x = np.array([vectors[i] for i in names])
    out = {}
    for q in asked:
        scores = x @ np.array(vectors[q])
        order = sorted((-s, int(i)) for s, i in zip(scores, names) if i != q)
        out[q] = [(i, -s) for s, i in order[:n]]
    return out


def test_neighbours(spark, folder):
    rng = np.random.default_rng(3)
    x = np.round(rng.normal(size=(1200, 16)) + 3 * rng.normal(size=(12, 16))[rng.integers(0, 12, 1200)], 3)
    x[400:800] = x[5]  # a third of all rows are copies
    rows = [(i, v.tolist(), "x") for i, v in enumerate(x)]
    odd = [(2000, None, "x"), (2020, [0.0] * 16, "x"), (2040, [float("nan")] + [1.0] * 15, "x"), (2060, [None] + [1.0] * 15, "x"), (None, [1.0] * 16, "x"), (2080, [], "x"), (3, rows[3][1], "y")]
    spark.createDataFrame(rows + odd, "vec_id long, embedding array<double>, score string").write.parquet(folder + "/v")
    got = neighbours.search(spark.read.parquet(folder + "/v"), F.col("vec_id") % 20 == 0).collect()
    want = _nearest({i: v for i, v, _ in rows}, range(0, 1200, 20), 20)
    lists = {}
    for r in sorted(got, key=lambda r: (r["query_id"], r["rank"])):
        lists.setdefault(r["query_id"], []).append((r["vec_id"], r["score"]))
        assert math.isclose(r["score"], float(x[r["query_id"]] @ x[r["vec_id"]]), rel_tol=1e-12)
    assert set(lists) == set(want)
    assert all(len(v) == 20 and [-s for _, s in v] == sorted(-s for _, s in v) for v in lists.values())
    met = sum(s >= want[q][-1][1] - 1e-9 for q, v in lists.items() for _, s in v)
    assert met / (20 * len(want)) >= 0.9


def test_few_and_no_vectors(spark):
    df = spark.createDataFrame([(0, [1.0, 2.0]), (1, [2.0, 0.5]), (2, None)], "vec_id long, embedding array<double>")
    assert [tuple(r)[:4] for r in neighbours.search(df, F.col("vec_id") % 20 == 0).collect()] == [(0, 1, 1, 3.0)]
    assert not neighbours.search(df.where("false"), F.lit(True)).count()


def test_perturbations_come_by_estimated_success():
    fraction = np.array([0.1, 0.45, 0.8])
    got = perturbations(fraction, 27)
    cost = lambda s: sum((fraction[i] if d < 0 else 1 - fraction[i]) ** 2 for i, d in s)
    every = [[(i, d) for i, d in enumerate(c) if d] for c in itertools.product((-1, 0, 1), repeat=3)]
    assert np.allclose([cost(s) for s in got], sorted(cost(s) for s in every)) and not got[0]


def test_viterbi():
    rng = np.random.default_rng(0)
    for n in (1, 2, 5, 8):
        s, start, step = rng.normal(size=(n, 2)), rng.normal(size=2), rng.normal(size=(2, 2))
        value = lambda y: start[y[0]] + sum(s[i, v] for i, v in enumerate(y)) + sum(step[a, b] for a, b in zip(y, y[1:]))  # noqa: B023, E731
        assert tuple(quality.viterbi(s, start, step)) == max(itertools.product((0, 1), repeat=n), key=value)
    assert quality.viterbi(np.empty((0, 2)), np.zeros(2), np.zeros((2, 2))) == []


def _base(text):
    words, lines = WORD.findall(text or ""), [x for x in (text or "").split("\n") if WORD.search(x)]
    windows = [tuple(words[i : i + 3]) for i in range(len(words) - 2)]
    often = Counter(windows)
    again = {i + k for i, w in enumerate(windows) if often[w] > 1 for k in range(3)}
    failed = len(words) < 50 or 100 * len(again) > 50 * len(words)
    return len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text or "")), len(lines) - len(set(lines)), len(again), failed


_BASE = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed"]


def test_base_rules(docs, rows):
    out = quality.rules(docs, quality.Field()).collect()
    assert Counter((r["doc_id"], *(r[c] for c in _BASE)) for r in out) == Counter((i, *_base(t)) for i, t, _ in rows)
    assert all(r["kept"] == (not r["base_failed"]) for r in out)  # a field that knows nothing calls all lines content
    kept = quality.keep(docs, quality.Field())
    assert kept.columns == docs.columns and kept.count() == sum(r["kept"] for r in out)


def test_field_learns(spark, texts):
    """Fitted on some documents, it tells others of the same kinds."""
    prose = [t for t in texts[-12:] if t]
    menu = ["\n".join(f"HOME | LOGIN | {(i * k) % 97} >> $ {k}" for k in range(20)) for i in range(12)]
    rows = [(i, t) for i, t in enumerate(prose + menu)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    labels = spark.createDataFrame([(i, int(i < 12)) for i in range(24) if i % 2] + [(None, 1), (1, 1), (3, None), (77, 0)], "doc_id long, quality int")
    field = quality.train(docs, labels)
    share = {r["doc_id"]: r["content_share"] for r in quality.rules(docs, field).collect()}
    assert min(share[i] for i in range(0, 12, 2)) > 0.5 > max(share[i] for i in range(12, 24, 2))
    assert not quality.rules(docs.where("false"), quality.train(docs.where("false"), labels)).count()


def test_matching_statistics():
    rng = np.random.default_rng(1)
    sequences = [rng.integers(1, 4, 12).tolist() for _ in range(4)]
    parts = {tuple(s[a:b]) for s in sequences for a in range(len(s)) for b in range(a + 1, len(s) + 1)}
    text = rng.integers(1, 5, 200).tolist()
    longest = [max((n for n in range(k + 1) if not n or tuple(text[k - n : k]) in parts)) for k in range(len(text) + 1)]
    want = [(k, n) for k, n in enumerate(longest) if n >= 3 and (k == len(text) or longest[k + 1] != n + 1)]
    assert [(end, n) for end, n, _ in Automaton(sequences).matches(text, 3)] == want


def test_licence_phrases(docs, rows):
    phrases = {"gnu general public license": "gpl", "apache license": "apache", "cc by": "cc-by", "mit license": "mit"}
    lower = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    want = Counter()
    for doc, text, _ in rows:
        words = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", (text or "").translate(lower))
        hits = [(i, label) for p, label in phrases.items() for i in range(len(words)) if words[i : i + len(p.split())] == p.split()]
        want[(doc, len(words), len(hits), min(hits)[0] if hits else None, max(hits)[0] if hits else None, ",".join(sorted({x for _, x in hits})))] += 1
    out = licences.scan(docs).collect()
    assert Counter(tuple(r)[:6] for r in out) == want
    assert all(set(filter(None, r["base_labels"].split(","))) <= set(r["labels"].split(",")) and 0 <= r["score"] <= 1 for r in out)
    assert not licences.scan(docs.where("false")).count()


def test_licence_templates(spark):
    label, text = next((a, t) for a, t in licences.TEMPLATES if len(t.split()) > 30)
    words = text.split()
    changed = "before it " + " ".join(w if k != len(words) // 2 else "changed" for k, w in enumerate(words)) + " after it"
    out = licences.scan(spark.createDataFrame([(1, changed), (2, "nothing of this kind here")], "doc_id long, text string")).collect()
    assert label in out[0]["labels"].split(",") and out[0]["spans"] and out[1]["labels"] == ""


def test_gradients():
    rng = np.random.default_rng(0)
    model = gru.Gru(rng.integers(1, 100, gru.WORDS))
    for k, v in model.p.items():
        model.p[k] = v.astype(np.float64)
    x, y = rng.integers(0, 60, (5, 3)), rng.integers(0, 60, (5, 3))
    h = rng.normal(size=(3, gru.STATE))
    g, _ = model.gradients(x, y, h)

    def loss():
        states, _, _ = model.run(x, h)
        return model.output(states.reshape(-1, gru.STATE), y.reshape(-1), gradient=True)

    log = lambda: -float(np.mean(loss()[0]))
    for k in model.p:
        at = np.unravel_index(int(np.abs(g[k]).argmax()), g[k].shape)
        was, step = model.p[k][at], 1e-3
        model.p[k][at] = was + step
        up = log()
        model.p[k][at] = was - step
        down = log()
        model.p[k][at] = was
        assert abs((up - down) / (2 * step) - g[k][at]) < 0.02 * abs(g[k][at]) + 1e-4, k


def test_state_is_carried_through_a_document():
    rng = np.random.default_rng(2)
    model = gru.Gru(rng.integers(1, 100, gru.WORDS))
    documents = [np.append(rng.integers(1, 50, n), gru.END) for n in (1, 700, 3, 0, 40)]
    together = gru.score(model, documents)
    assert np.allclose(together, [gru.score(model, [d])[0] for d in documents], rtol=1e-4)


def test_scores(docs, rows):
    lower = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    tokens = [(i, [*WORD.findall((t or "").translate(lower)), None]) for i, t, _ in rows]
    held = lambda i: i is not None and zlib.crc32(str(i).encode()) % 7 == 2
    counts = Counter(w for i, words in tokens if not held(i) for w in words)
    total, distinct = sum(counts.values()), len(counts)
    want = Counter()
    for i, words in tokens:
        base = sum(math.log10((counts[w] + 1) / (total + 1 * (distinct + 1))) for w in words)
        want[(i, held(i), len(words), sum(counts[w] > 0 for w in words), total, round(base, 3))] += 1
    out = scoring.score_documents(docs).collect()
    assert Counter((*tuple(r)[:5], round(r["base_score"], 3)) for r in out) == want
    assert all(math.isfinite(r["score"]) and r["score"] <= 0 for r in out)
    assert not scoring.score_documents(docs.where("false")).count()


def test_ties_go_to_the_smaller_id(spark):
    """Small whole numbers: most lists end among many equal scores."""
    rng = np.random.default_rng(11)
    vectors = np.unique(rng.integers(-2, 3, (1500, 6)), axis=0).astype(float)
    vectors = vectors[np.abs(vectors).sum(1) > 0]
    ids = rng.permutation(len(vectors)) * 7
    df = spark.createDataFrame([(int(i), v.tolist()) for i, v in zip(ids, vectors)], "vec_id long, embedding array<double>")
    got = {}
    for r in neighbours.search(df, F.col("vec_id") % 5 == 0).collect():
        got.setdefault(r.query_id, []).append((r.rank, r.vec_id, r.score))
    scores = vectors @ vectors.T
    exact = 0
    for q in np.flatnonzero(ids % 5 == 0).tolist():
        order = [k for k in np.lexsort((ids, -scores[q])) if k != q][:20]
        exact += [(i + 1, int(ids[k]), scores[q][k]) for i, k in enumerate(order)] == sorted(got[int(ids[q])])
    assert exact >= 0.9 * (ids % 5 == 0).sum()


def test_leading_pairs_hold_all_ties():
    x, vectors = np.ones((3, 4)), np.vstack([np.full((50, 4), 0.25), np.full((5, 4), 0.1)])
    i, j, exact = map(np.concatenate, zip(*neighbours._leading(x, vectors, 2)))
    assert len(i) == 150 and j.max() == 49 and (exact == 1).all()


def test_long_vectors_do_not_overflow(spark):
    df = spark.createDataFrame([(0, [1e200, 0.0]), (20, [0.0, 1e200]), (1, [1e-3, 1e200])], "vec_id long, embedding array<double>")
    assert {(r.query_id, r["rank"]): r.vec_id for r in neighbours.search(df, F.col("vec_id") % 20 == 0).collect()}[20, 1] == 1

"""Lines, near duplicates and passages against brute force."""

import hashlib
import re
from collections import Counter, defaultdict

import numpy as np
import pytest

from marquee.llm import lines, minhash, substrings

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def _bag(text):
    words = WORD.findall(text or "")
    width = min(5, len(words))
    return Counter(tuple(words[i : i + width]) for i in range(len(words) - width + 1)) if words else Counter()


def _similar(a, b):
    shared = sum((a & b).values())
    return shared / max(1, sum(a.values()) + sum(b.values()) - shared)


def _classes(rows):
    """The class of each row by comparing all pairs."""
    bags, parent = [_bag(t) for _, t, _ in rows], list(range(len(rows)))

    def root(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for i in range(len(rows)):
        for j in range(i):
            if bags[i] and bags[j] and _similar(bags[i], bags[j]) >= 0.8:
                parent[root(i)] = root(j)
    members = defaultdict(list)
    for i, (doc, _, _) in enumerate(rows):
        members[root(i)].append((doc is None, doc))
    return [(doc, min(members[root(i)])[1]) for i, (doc, _, _) in enumerate(rows)], len(members)


def test_classes(docs, rows):
    out = minhash.classes(docs).collect()
    want, classes = _classes(rows)
    assert Counter((r["doc_id"], r["class_id"]) for r in out) == Counter(want)
    assert sum(r["kept"] for r in out) == classes


def test_deduplicate_keeps_columns(docs, rows):
    out = minhash.deduplicate(docs)
    assert out.columns == docs.columns and out.count() == _classes(rows)[1]


def test_signatures_agree_as_often_as_bags_are_similar():
    words = [str(i) for i in range(2000)]
    raw = [" ".join(words).encode(), " ".join(words[:1400] + ["x"] + words[1401:1700]).encode()]
    owner, element, weight = minhash.elements(raw)
    got = minhash.signatures(2, owner, element, weight, 1024)
    assert abs(float(np.mean(got[0] == got[1])) - _similar(_bag(raw[0].decode()), _bag(raw[1].decode()))) < 0.06


def test_large_bucket_of_near_copies(spark, folder):
    """A chain of texts in which neighbours are similar and the ends are not stays one class."""
    words = [f"w{i}" for i in range(400)]
    chain = [" ".join(words[8 * i : 8 * i + 200]) for i in range(20)]
    spark.createDataFrame([(i, t) for i, t in enumerate(chain * 3)], "doc_id long, text string").write.parquet(folder + "/t")
    out = minhash.classes(spark.read.parquet(folder + "/t")).collect()
    assert {r["class_id"] for r in out} == {0} and len(out) == 60


def _removed(rows):
    """(id, words, removed, digest): windows of 20 words seen before, in the order of ids."""
    seen, out = set(), []
    for doc, text, _ in sorted(rows, key=lambda r: (r[0] is None, r[0] or 0)):
        words = WORD.findall(text or "")
        gone = set()
        for i in range(len(words) - 19):
            window = tuple(words[i : i + 20])
            gone |= set(range(i, i + 20)) if window in seen else set()
            seen.add(window)
        left = " ".join(w for i, w in enumerate(words) if i not in gone)
        out.append((doc, len(words), len(gone), hashlib.sha256(left.encode()).hexdigest()))
    return out


def test_removed_words(docs, rows):
    out = [(r["doc_id"], r["n_words"], r["n_removed"], r["kept_sha256"]) for r in substrings.removed_words(docs).collect()]
    assert Counter(out) == Counter(_removed(rows))


def test_substrings_keep_rows_and_columns(docs, rows):
    out = substrings.deduplicate(docs)
    assert out.columns == docs.columns
    left = Counter((r["doc_id"], len(WORD.findall(r["text"] or ""))) for r in out.collect())
    assert left == Counter((doc, n - gone) for doc, n, gone, _ in _removed(rows))


def test_lines(spark, folder):
    """A line on ten sites is boilerplate, one on nine is not, and copies of one text count once."""
    data = [(i, f"own {i}\nmenu\n\nnine" if i < 9 else f"own {i}\nmenu", f"site{i}", i) for i in range(10)]
    data += [(100 + i, "copied line\ncopied", f"site{i}", 0) for i in range(30)] + [(200, None, "a", 0), (201, "", None, 0), (202, " \n ", "b", 0)]
    spark.createDataFrame(data, "doc_id long, text string, source string, row long").write.parquet(folder + "/t")
    docs = spark.read.parquet(folder + "/t")
    out = lines.remove(docs, sites=10)
    assert out.columns == docs.columns
    want = {(i, t if t is None or i == 0 or i >= 100 else t.replace("\nmenu", ""), s, n) for i, t, s, n in data}
    assert set(map(tuple, out.collect())) == want
    counts = lines.remove(docs, sites=10, counts=("n_lines", "n_removed")).select("doc_id", "n_lines", "n_removed").collect()
    assert {r["doc_id"]: (r["n_lines"], r["n_removed"]) for r in counts if r["doc_id"] in (0, 1, 9, 200, 201, 202)} == {0: (3, 0), 1: (3, 1), 9: (2, 1), 200: (0, 0), 201: (0, 0), 202: (0, 0)}


def test_every_site_of_a_line_counts(spark, folder):
    """A menu on twelve sites, each with a text of its own that is copied to one site as well, and columns that clash."""
    data = [(i, f"own {i}\nmenu", f"site{i}", 1, "x") for i in range(12)] + [(100 + i, f"own {i}\nmenu", "a", 2, "y") for i in range(12)]
    data += [(200 + i, f"mine {i % 9}\nnine texts", f"site{i}", 3, "z") for i in range(40)]
    spark.createDataFrame(data, "doc_id long, text string, source string, _lines long, gone string").write.parquet(folder + "/t")
    out = lines.remove(spark.read.parquet(folder + "/t"))
    assert out.columns == ["doc_id", "text", "source", "_lines", "gone"]
    want = {(i, t if i == 0 or i >= 200 else t.replace("\nmenu", ""), s, n, g) for i, t, s, n, g in data}
    assert set(map(tuple, out.collect())) == want


@pytest.mark.parametrize("operator", ["classes", "deduplicate", "removed_words", "cut", "lines"])
def test_executors_may_come_and_go(spark, docs, rows, folder, monkeypatch, operator):
    """The scan of the input is cut otherwise in each job, as it is when cores come and go between them."""
    spread = f"{folder}/spread"
    docs.repartition(24).write.parquet(spread)
    docs = spark.read.parquet(spread)
    run = {
        "classes": lambda: minhash.classes(docs).drop("row"),
        "deduplicate": lambda: minhash.deduplicate(docs).select("text"),
        "removed_words": lambda: substrings.removed_words(docs.where("doc_id <> 7")),
        "cut": lambda: substrings.deduplicate(docs.where("doc_id <> 7")).select("doc_id", "text"),
        "lines": lambda: lines.remove(docs).select("doc_id", "text"),
    }[operator]
    want = Counter(map(str, run().collect()))
    cores, plain = [3, 1, 17, 2, 29], minhash.materialise

    def changing(df):
        cores.append(cores.pop(0))  # the next number of cores
        spark.conf.set("spark.sql.leafNodeDefaultParallelism", cores[0])
        return plain(df)

    for module in (minhash, substrings, lines):
        monkeypatch.setattr(module, "materialise", changing)
    try:
        assert Counter(map(str, run().collect())) == want
    finally:
        spark.conf.unset("spark.sql.leafNodeDefaultParallelism")


def test_lines_of_odd_rows_stay(docs, rows):
    out = lines.remove(docs, sites=100)
    assert Counter((r["doc_id"], r["text"]) for r in out.collect()) == Counter((i, t) for i, t, _ in rows)


def test_empty_tables(empty):
    assert not minhash.classes(empty).count() + substrings.removed_words(empty).count() + lines.remove(empty).count()

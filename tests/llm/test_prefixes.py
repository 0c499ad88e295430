"""The prefix trie against sets of prefixes."""

import hashlib
import random
import re
import zlib
from collections import defaultdict

import pytest

from marquee.llm import prefixes

SCHEMA = "conv_id long, turn long, role string, text string, node string, depth int, heads array<int>"


def _nodes(rows):
    own = defaultdict(list)
    for conv, turn, role, text in rows:
        if conv is not None:
            own[conv].append((turn is not None, turn or 0, role or "", text or ""))
    for turns in own.values():
        turns.sort()
    own = {c: [t[2:] for t in turns] for c, turns in own.items()}
    built = {}
    for c, turns in own.items():
        h = zlib.crc32(str(c).encode()) % 4
        built[c] = tuple(own.get(c - c % 20, [])[:h] + turns[h:])
    members, ends = defaultdict(list), defaultdict(list)
    for c in sorted(built):
        ends[built[c]].append(c)
        for d in range(len(built[c]) + 1):
            members[built[c][:d]].append(c)
    children = defaultdict(list)
    for p in members:
        if p:
            children[p[:-1]].append(p)
    leaves, saved = {}, {}
    for p in sorted(members, key=len, reverse=True):
        words = len(re.findall(r"[^\x20\x09-\x0D]+", p[-1][1])) if p else 0
        leaves[p] = sum(leaves[c] for c in children[p]) or 1
        saved[p] = sum(saved[c] for c in children[p]) + (len(members[p]) - 1) * words
    out = []
    for p, convs in members.items():
        parent = members[p[:-1]][0] if p else None
        digest = hashlib.sha256(",".join(map(str, ends.get(p, []))).encode()).hexdigest()
        out.append((convs[0], len(p), parent, len(convs), len(children[p]), leaves[p], saved[p], digest))
    return sorted(map(str, out))


def _rows():
    rng = random.Random(3)
    texts = ["", " ", "hello there", "a b  c\nd", "x\x00y", "ä 漢字", "long " * 500, None]
    rows = []
    for c in [*range(0, 130), 200, 219, 1000]:
        if c in (20, 60):
            continue  # bases that are absent
        for t in range(rng.randint(1, 6)):
            rows.append((c, None if rng.random() < 0.1 else t, rng.choice(["user", "assistant", None]), rng.choice(texts)))
    for c in range(2000, 2100):  # one conversation many times, and its beginnings
        rows += [(c, t, "user", f"turn {t}") for t in range(9 if c % 3 else c % 9 + 1)]
    rows += [(3000, t, "user", "deep") for t in range(120)] + [(3001, t, "user", "deep") for t in range(90)]
    rows += [(3021, t, None, f"deep {t}") for t in range(60)]
    rows += [(5, 1, "user", "tie b"), (5, 1, "user", "tie a"), (5, 1, None, "tie c"), (5, 1, "user", "tie a"), (None, 1, "user", "nobody's")]
    rng.shuffle(rows)
    return rows


@pytest.mark.parametrize("holds, ahead", [(20_000, 4), (12, 1), (40, 4), (1, 2)])
def test_trie(spark, monkeypatch, holds, ahead):
    """From no burst at all to a burst at every shared node, through several rounds."""
    monkeypatch.setattr(prefixes, "HOLDS", holds)
    monkeypatch.setattr(prefixes, "AHEAD", ahead)
    monkeypatch.setattr(prefixes, "PIECE", 64)
    monkeypatch.setattr(prefixes, "BATCH", 7)
    rows = _rows()
    df = spark.createDataFrame([(*r, "n", 1, [2]) for r in rows], SCHEMA).repartition(5)
    got = prefixes.prefix_trie(df)
    assert got.columns == ["conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256"]
    assert {t for _, t in got.dtypes} == {"bigint", "string"}
    assert sorted(str(tuple(r)) for r in got.collect()) == _nodes(rows)


def test_turnless_and_empty(spark):
    schema = "conv_id long, turn long, role string, text string"
    assert prefixes.prefix_trie(spark.createDataFrame([], schema)).count() == 0
    for rows in ([(c, 1, "user", "x") for c in range(1, 8)], [(None, 1, "user", "x")], [(-7, 2, "u", "a"), (0, 1, "u", "b")]):
        want = _nodes(rows) if rows[0][0] is None or rows[0][0] > 0 else None
        got = sorted(str(tuple(r)) for r in prefixes.prefix_trie(spark.createDataFrame(rows, schema)).collect())
        assert want is None and got or got == want

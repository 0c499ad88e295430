"""SimHash near duplicates against all pairs."""

import random

import numpy as np
import pytest
import xxhash

from marquee.llm import simhash


def _print(text):
    """Bit by bit, as the definition says it."""
    words = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "").encode().split()
    shingles = [b" ".join(words[i : i + 3]) for i in range(max(1, len(words) - 2))] if words else []
    hashes = [xxhash.xxh64_intdigest(s, 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def _groups(prints, threshold=3):
    """For each index, the set of indices that links lead to."""
    label = list(range(len(prints)))
    for i, a in enumerate(prints):
        for j in range(i):
            if (a ^ prints[j]).bit_count() <= threshold and label[i] != label[j]:
                old = label[i]
                label = [label[j] if x == old else x for x in label]
    return label


def test_near_duplicates(docs, rows):
    prints = [_print(t) for _, t, _ in rows]
    label = _groups(prints)
    least = {}
    for (i, _, _), g in zip(rows, label):
        if i is not None:
            least[g] = min(i, least.get(g, i))
    want = sorted((str(i), f"{p:016x}", str(least.get(g))) for (i, _, _), p, g in zip(rows, prints, label))
    got = simhash.near_duplicates(docs).collect()
    assert sorted((str(r.doc_id), r.fingerprint, str(r.component_id)) for r in got) == want
    assert len({g for g in label}) < len(set(prints))  # some links join different fingerprints


def test_the_code_covers(spark):
    rng = np.random.default_rng(5)
    prints = rng.integers(0, 1 << 63, 400, dtype=np.uint64) * np.uint64(2) + rng.integers(0, 2, 400, dtype=np.uint64)
    _, homes, _ = simhash.reach(prints, 0)
    assert len(homes) == 400  # one home each: the code is perfect in both parts
    for threshold in (0, 1, 3):
        for p, home in zip(prints.tolist(), homes.tolist()):
            other = p
            for b in rng.choice(64, threshold, replace=False).tolist():
                other ^= 1 << b
            assert home in simhash.reach(np.array([other], np.uint64), threshold)[1]


@pytest.mark.parametrize("block", [4, 4096])
@pytest.mark.parametrize("threshold", [1, 3])
def test_links_connect_what_all_pairs_connect(spark, monkeypatch, block, threshold):
    """Chains, a dense cluster whose anchors are split, and strangers; links are few though the cluster has all pairs."""
    rng = random.Random(9)
    center = rng.getrandbits(64)
    prints = {center ^ 1 << a ^ 1 << b for a in range(0, 64, 6) for b in range(0, 64, 7)} | {center}
    chain = rng.getrandbits(64)
    for b in range(12):
        prints.add(chain)
        chain ^= 7 << 5 * b
    prints |= {rng.getrandbits(64) for _ in range(60)} | {0, 1, (1 << 64) - 1}
    prints = sorted(prints)
    monkeypatch.setattr(simhash, "BLOCK", block)
    homes = simhash.reach(np.array(prints, np.uint64), 0)[1].tolist()
    signed = np.array(prints, np.uint64).view(np.int64).tolist()
    df = spark.createDataFrame(list(zip(signed, homes)), "print long, home int").repartition(3)
    links = [(r.a % 2**64, r.b % 2**64) for r in simhash.links(df, threshold).collect()]
    assert all(0 < (a ^ b).bit_count() <= threshold for a, b in links)
    label = {p: p for p in prints}

    def root(p):
        while label[p] != p:
            p = label[p]
        return p

    for a, b in links:
        label[root(a)] = root(b)
    want, got = _groups(prints, threshold), [root(p) for p in prints]
    assert len(set(zip(want, got))) == len(set(want)) == len(set(got))


def test_empty(empty):
    assert simhash.near_duplicates(empty).count() == 0

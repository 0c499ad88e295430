"""Collocations against counting by hand."""

import random
import re
from collections import Counter, defaultdict

import pytest

from marquee.llm import phrases


def _mined(rows, longest, least, share, top):
    spoken, f = Counter(), Counter()
    for text, lang in rows:
        lang = "und" if lang is None else lang
        low = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
        for piece in re.split(r"[.,;:!?\x0A-\x0D]", low):
            words = re.findall(r"[^\x20\x09]+", piece)
            spoken[lang] += len(words)
            for k in range(1, longest + 1):
                f.update((lang, tuple(words[i : i + k])) for i in range(len(words) - k + 1))
    candidates = {p: n for p, n in f.items() if len(p[1]) > 1 and n >= least}
    taken = set()
    for (lang, p), n in candidates.items():
        for k in range(2, len(p)):
            for i in range(len(p) - k + 1):
                inner = (lang, p[i : i + k])
                if 100 * n >= share * f[inner]:
                    taken.add(inner)
    out = defaultdict(list)
    for (lang, p), a in candidates.items():
        if (lang, p) not in taken:
            cuts = [(1_000_000 * a * a // (f[lang, p[:k]] * f[lang, p[k:]]), k) for k in range(1, len(p))]
            score, k = min(cuts)
            out[lang].append((-score, -a, " ".join(p).encode(), f[lang, p[:k]], f[lang, p[k:]]))
    return {(lang, rank, p.decode(), -a, left, right, spoken[lang], -s) for lang, found in out.items() for rank, (s, a, p, left, right) in enumerate(sorted(found)[:top], 1)}


def _rows():
    rng = random.Random(4)
    words = ["new", "York", "CITY", "is", "a", "bär", "漢字", "x\x00y", "the", "of"]
    texts = [None, "", " \t.\n", "one", "New york city." * 40, "a a a a a a a a", "hot " * 3000]
    texts += ["".join(rng.choice(words) + rng.choice([" ", " ", "  ", "\t", " ", ". ", "\n", ";"]) for _ in range(rng.randint(1, 120))) for _ in range(60)]
    langs = ["en", "en", None, "und", "", "dé"]
    return [(t, rng.choice(langs)) for t in texts] + [("New York City is new York city", "en")] * 7


@pytest.mark.parametrize("longest, least, share, top, block", [(3, 10, 50, 2000, 1 << 20), (3, 3, 50, 7, 40), (4, 2, 80, 50, 300), (2, 1, 50, 30, 64)])
def test_mine(spark, monkeypatch, longest, least, share, top, block):
    """Also with blocks of a few words, so that most phrases lie across the cuts."""
    monkeypatch.setattr(phrases, "BLOCK", block)
    rows = _rows()
    df = spark.createDataFrame([(t, lang, 1, "n", 0.5) for t, lang in rows], "text string, lang string, block int, items string, n double").repartition(3)
    got = phrases.mine(df, longest=longest, least=least, share=share, top=top)
    assert {f.name: f.dataType.simpleString() for f in got.schema.fields if f.name not in ("lang", "phrase")} == dict.fromkeys(["rank", "a", "l", "r", "n", "score"], "bigint")
    assert {tuple(r) for r in got.collect()} == _mined(rows, longest, least, share, top)


def test_segments_keep_every_word_once():
    text = b"aa bb\tcc. dd ee  ff gg hh\nii " + b"j" * 50 + b" kk"
    for size in (1, 4, 9, 30, 1000):
        out = []
        for part, context in phrases.segments(text, size, 2):
            words = re.split(rb"[ \t.\n]+", part.strip(b" \t.\n"))
            assert context <= 2 and words[:context] == (out[-context:] if context else [])
            out += [w for w in words if w][context:]
        assert out == re.split(rb"[ \t.\n]+", text)


def test_equal_fingerprints_are_told_apart(monkeypatch):
    words = phrases.Words([b"one two one three two"], space=phrases._SPACE)
    monkeypatch.setattr(phrases, "mix", lambda h: h * 0)
    first, code, _ = phrases._distinct(words, phrases.np.zeros(5, int), phrases.np.ones(1, phrases.np.uint64))
    assert first.tolist() == [0, 1, 3] and code.tolist() == [0, 1, 0, 2, 1]


def test_empty(spark, empty):
    assert phrases.mine(empty, lang="source").count() == 0
    assert phrases.mine(spark.createDataFrame([(None, None)], "text string, lang string")).count() == 0

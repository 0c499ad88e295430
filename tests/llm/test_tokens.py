"""Encoding, counts and packing against the tokenizers library."""

import hashlib
import timeit
import zlib
from collections import Counter, defaultdict
from fractions import Fraction

import numpy as np
import pytest
from tokenizers import Tokenizer

from marquee.llm import bpe, packing, tokens
from marquee.llm.packing import Mixture


@pytest.fixture(scope="module")
def library():
    it = Tokenizer.from_file(bpe.vocabulary_path())
    it.no_truncation()
    it.no_padding()
    return it


def _ids(library, text):
    return library.encode(text or "", add_special_tokens=False).ids


def _sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


def test_round_trip(docs, rows, library):
    ids = [(i, _ids(library, t)) for i, t, _ in rows]
    want = Counter((i, len(x), _sha(" ".join(map(str, x))), _sha(library.decode(x, skip_special_tokens=False))) for i, x in ids)
    assert Counter(map(tuple, bpe.round_trip(docs).collect())) == want


def test_encode_and_decode(docs, rows, library):
    encoded = bpe.encode(docs)
    assert Counter((r[0], tuple(r[1])) for r in encoded.collect()) == Counter((i, tuple(_ids(library, t))) for i, t, _ in rows)
    want = Counter((i, library.decode(_ids(library, t), skip_special_tokens=False)) for i, t, _ in rows)
    assert Counter(map(tuple, bpe.decode(encoded).collect())) == want


def test_every_character(library):
    """All code points between letters, those that newer versions of Unicode call letters among them."""
    model = bpe.loaded(bpe.vocabulary_path())
    points = [c for c in range(0x110000) if not 0xD800 <= c < 0xE000 and (c < 0x30000 or c % 97 == 0 or c > 0xE0000 and c < 0xE0200)]
    texts = [f"ab{chr(c)}cd {chr(c)}" for c in points]
    wrong = []
    for k in range(0, len(texts), 20_000):
        for t, e in zip(texts[k : k + 20_000], library.encode_batch_fast(texts[k : k + 20_000], add_special_tokens=False)):
            if model.encode(t) != e.ids:
                wrong.append(t)
    assert not wrong


def test_accented_chunks_cost_like_plain_ones():
    """Whether a letter is newer than Python's tables is looked up, not searched for in a class of thousands."""
    model = bpe.loaded(bpe.vocabulary_path())

    def seconds(letter):
        chunks = [f"{letter}ab{i}" for i in range(2000)]
        return min(timeit.repeat(lambda: [model.pretokens(c) for c in chunks], number=1, repeat=5))

    assert seconds("\u00e9") < 15 * seconds("e")


def test_accented_chunks_are_counted_like_plain_ones():
    """The counter of op9 on chunks that it has not met."""

    def seconds(letter):
        count = tokens._counter(bpe.vocabulary_path()).fn  # without what it remembers
        chunks = [f"{letter}ab{i}".encode() for i in range(2000)]
        return min(timeit.repeat(lambda: [count(c) for c in chunks], number=1, repeat=5))

    assert seconds("\u00e9") < 15 * seconds("e")


def test_whole_tokens_encode_alone():
    whole = sorted(bpe.loaded(bpe.vocabulary_path()).whole_tokens())
    assert len(whole) > 1000
    model = bpe.loaded(bpe.vocabulary_path())
    for token in whole[:: len(whole) // 500]:
        assert len(model.merge(model.symbols(token))) == 1


def test_token_counts(docs, rows, library):
    want = Counter((i, len((t or "").encode()), n := len(_ids(library, t)), n > 2048) for i, t, _ in rows)
    assert Counter(map(tuple, tokens.token_counts(docs).collect())) == want


@pytest.mark.parametrize("weights", [None, {"hot": 3.0}])
def test_pack(docs, rows, library, weights):
    length = 256
    out = packing.pack(docs, length=length, weights=weights).collect()
    places = defaultdict(list)
    for p in out:
        ids = np.frombuffer(p["ids"], "<u4")
        assert len(ids) == p["length"] > 0 and zlib.crc32(p["ids"]) == p["ids_crc32"]
        places[p["sequence_id"]].append((p["offset"], p["length"]))
    for sequence, pieces in places.items():
        pieces.sort()
        assert [o for o, _ in pieces] == [sum(n for _, n in pieces[:k]) for k in range(len(pieces))]
        assert sequence == max(places) or sum(n for _, n in pieces) == length
    total = sum(len(_ids(library, t)) + 1 for _, t, _ in rows)
    assert sorted(places) == list(range(-(-total // length)))
    # documents with an id of their own are whole again when their pieces are put together
    once = {i: t for i, t, _ in rows if i is not None and i != 7}
    again = defaultdict(list)
    for p in out:
        if p["doc_id"] in once:
            again[p["doc_id"]].append((p["start"], p["ids"], p["doc_tokens"]))
    for i, t in once.items():
        whole = np.frombuffer(b"".join(x for _, x, _ in sorted(again[i])), "<u4").tolist()
        assert whole == [*_ids(library, t), 2] and {n for _, _, n in again[i]} == {len(whole)}
    assert sum(p["length"] for p in out) == total


def test_windows_hold_the_mixture():
    """Deficits are carried: by any place, every queue has had its share up to one token for each queue."""
    totals = [6000, 3000, 1000]
    mixture = Mixture(totals, [6.0, 3.0, 1.0])
    for window in range(1, 10):
        served = np.asarray(mixture.served(np.array([window * 1000])))
        assert np.abs(served.reshape(-1) - np.array([600, 300, 100]) * window).max() <= len(totals)


@pytest.mark.parametrize("weights", [None, {"s7": 40.0, "s299": 9.0, None: 3.0}])
def test_every_source_has_a_queue(spark, folder, library, weights):
    """With more sources than a task can hold shares of, windows hold what a sort of all tokens by their dues gives."""
    texts = [(i, " ".join(["alpha beta gamma"] * (1 + i % 5)), None if i % 300 == 3 else f"s{i % 300}") for i in range(450)]
    texts += [(1000 + i, "hot words " * 30, "hot") for i in range(20)]
    spark.createDataFrame(texts, "doc_id long, text string, source string").repartition(3).write.parquet(folder + "/t")
    out = packing.pack(spark.read.parquet(folder + "/t"), length=64, weights=weights).collect()
    totals = Counter()
    for _, text, source in texts:
        totals[source] += len(_ids(library, text)) + 1
    order = sorted(totals, key=lambda s: (-totals[s], s is not None, s or ""))
    rate = {s: totals[s] if weights is None else Fraction(weights.get(s, 1.0)) for s in order}
    stream = sorted((Fraction(2 * i + 1, 2) / rate[s], k, s) for k, s in enumerate(order) for i in range(totals[s]))
    want = Counter((at // 64, s) for at, (_, _, s) in enumerate(stream))
    got, places = Counter(), defaultdict(list)
    for p in out:
        got[(p["sequence_id"], p["source"])] += p["length"]
        places[p["sequence_id"]].append((p["offset"], p["length"]))
    assert got == want
    for pieces in places.values():
        pieces.sort()
        assert [o for o, _ in pieces] == [sum(n for _, n in pieces[:k]) for k in range(len(pieces))]


@pytest.mark.parametrize("weights", [None, {"hot": 3.0}])
def test_many_sources_are_packed_like_few(docs, monkeypatch, weights):
    few = packing.pack(docs, length=256, weights=weights).collect()
    monkeypatch.setattr(packing, "QUEUES", 1)
    monkeypatch.setattr(packing, "ORDERED", 1024)
    assert Counter(packing.pack(docs, length=256, weights=weights).collect()) == Counter(few)


def test_empty_tables(empty):
    assert not bpe.round_trip(empty).count() + tokens.token_counts(empty).count() + packing.pack(empty).count()

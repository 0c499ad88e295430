"""Near duplicates by weighted min-hashing with darts.

A text is the bag of its runs of five words; a run's weight is its count. For every element the plane of weight and rank is
cut into regions by weight; darts fall into a region as a Poisson process whose random numbers are hashes of the element,
the region and the dart's number, so every text throws the same darts at the same element. A text keeps the darts below its
own weights and below a rank at which about k log k of them are left, whatever its length; each belongs to one of k
coordinates, and the earliest of a coordinate is its signature there. Two signatures agree in a coordinate with the
probability of the weighted Jaccard similarity. Bands of coordinates make candidates, which are then compared exactly.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from marquee.llm.base import arrow, col, fresh, pieces, texts
from marquee.llm.components import components
from marquee.llm.words import Words, groups, mix, runs
from marquee.session import materialise

#: Words of an element, and the least similarity of near duplicates.
SHINGLE = 5
SIMILAR = 0.8
#: Bands and coordinates in each: a pair at the least similarity shares no band with a chance of 6 in 100,000.
BANDS, ROWS = 32, 6

#: Texts of a bucket that are compared with each other in one task, and columns of the matrix that does it.
BLOCK, FEATURES = 512, 4_096

_STEP = np.uint64(0x9E3779B97F4A7C15)


def elements(raw: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(text, element, weight) of the elements of some texts, by text, then element. A text of fewer words than an element
    has is one element; one without words has none."""
    owners, values = [], []
    for a, b in groups(raw):
        words = Words(raw[a:b])
        h, counts = words.hashes(), words.counts()
        runs5, at = runs(h, words.first, SHINGLE)
        own = words.owners()[at]
        owners.append(own + a)
        values.append(runs5)
        for i in np.flatnonzero((counts > 0) & (counts < SHINGLE)).tolist():
            short, _ = runs(h[words.first[i] : words.first[i + 1]], np.array([0, counts[i]]), int(counts[i]))
            owners.append(np.array([i + a]))
            values.append(short)
    owner, value = np.concatenate(owners or [np.empty(0, np.int64)]), np.concatenate(values or [np.empty(0, np.uint64)])
    order = np.lexsort((value, owner))
    owner, value = owner[order], value[order]
    new = np.ones(len(owner), bool)
    new[1:] = (owner[1:] != owner[:-1]) | (value[1:] != value[:-1])
    first = np.flatnonzero(new)
    return owner[first], value[first], np.diff(np.append(first, len(owner)))


def signatures(texts_n: int, owner: np.ndarray, element: np.ndarray, weight: np.ndarray, k: int, seed: int = 0) -> np.ndarray:
    """texts x k signatures; texts without elements have zeros. Weights may be any positive numbers."""
    weight = weight.astype(float)
    total = np.bincount(owner, weight, texts_n)
    darts = np.full(texts_n, k * np.log(k) + 2 * k)
    out = np.zeros((texts_n, k), np.uint32)
    todo = total > 0
    while todo.any():
        limit = np.where(todo, darts / np.maximum(total, 1e-300), 0)
        best = np.full(texts_n * k, np.iinfo(np.uint64).max, np.uint64)
        use = todo[owner]
        _throw(owner[use], element[use], weight[use], limit, k, seed, best)
        best = best.reshape(texts_n, k)
        full = todo & (best != np.iinfo(np.uint64).max).all(1)
        out[full] = best[full].astype(np.uint32)
        todo &= ~full
        darts[todo] *= 2  # a coordinate without a dart: look further up
    return out


def _throw(owner, element, weight, limit, k, seed, best) -> None:
    """For each text and coordinate, the least (share of the rank limit, dart) as one number."""
    level = 0
    while len(owner):
        low, width = (0.0, 1.0) if level == 0 else (2.0 ** (level - 1), 2.0 ** (level - 1))
        region = mix(element + np.uint64((int(_STEP) * (seed * 64 + level + 1)) & 0xFFFFFFFFFFFFFFFF))
        own, w, end = owner, weight, limit[owner]
        rank, count, block = np.zeros(len(own)), 0, 1
        while len(own):
            number = np.arange(count + 1, count + block + 1, dtype=np.uint64)
            h = mix(region[:, None] + number * _STEP)
            gaps = -np.log1p(-((h >> np.uint64(11)) / 2.0**53)) / width
            ranks = rank[:, None] + np.cumsum(gaps, 1)
            inside = ranks < end[:, None]
            more = mix(h[inside])
            which = np.nonzero(inside)[0]
            if level:
                below = low + width * ((mix(more) >> np.uint64(11)) / 2.0**53) < w[which]
                more, which, kept = more[below], which[below], ranks[inside][below]
            else:
                kept = ranks[inside]
                if (w < 1).any():
                    below = (mix(more) >> np.uint64(11)) / 2.0**53 < w[which]
                    more, which, kept = more[below], which[below], kept[below]
            coordinate = (((more >> np.uint64(32)) * np.uint64(k)) >> np.uint64(32)).astype(np.int64)
            packed = (kept / end[which] * 2.0**32).astype(np.uint64) << np.uint64(32) | more & np.uint64(0xFFFFFFFF)
            np.minimum.at(best, own[which] * k + coordinate, packed)
            count += block
            alive = inside[:, -1]
            own, w, end, region, rank = own[alive], w[alive], end[alive], region[alive], ranks[alive, -1]
            block = min(64, 2 * block)
        level += 1
        higher = weight > 2.0 ** (level - 1)
        owner, element, weight = owner[higher], element[higher], weight[higher]


def _bands(bands: int, rows: int):
    def run(batches):
        for whole in batches:
            for batch in pieces(whole, 2):
                raw = [t or b"" for t in texts(batch.column(2))]
                owner, element, weight = elements(raw)
                s = signatures(len(raw), owner, element, weight, bands * rows)
                some = np.bincount(owner, minlength=len(raw)) > 0
                keys = np.zeros((len(raw), bands), np.uint64)
                for r in range(rows):
                    keys = mix(keys + s[:, r::rows][:, :bands].astype(np.uint64) * _STEP)
                keys = mix(keys + np.arange(1, bands + 1, dtype=np.uint64) * _STEP).view(np.int64)
                digests = [hashlib.md5(t).digest() if t else None for t in raw]
                own = pa.ListArray.from_arrays(pa.array(np.append(0, np.cumsum(some * bands)), pa.int32()), pa.array(keys[some].reshape(-1)))
                yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array([d if x else None for d, x in zip(digests, some)], pa.binary()), own], ["row", "id", "digest", "bands"])

    return run


def bag(element: np.ndarray, weight: np.ndarray) -> np.ndarray:
    """A weighted bag as a set: an element of weight w is w different members, so that the weighted similarity of two bags
    is the plain one of their sets. Sorted."""
    first = np.cumsum(weight) - weight
    number = np.arange(int(weight.sum())) - np.repeat(first, weight)
    return np.sort(mix(np.repeat(element, weight) + number.astype(np.uint64) * _STEP))


def similarity(a: np.ndarray, b: np.ndarray) -> float:
    """Of two sets as `bag` makes them."""
    if not len(a) or not len(b):
        return 0.0
    at = np.minimum(np.searchsorted(b, a), len(b) - 1)
    shared = int((b[at] == a).sum())
    return shared / (len(a) + len(b) - shared)


def _bags(batches):
    for whole in batches:
        for batch in pieces(whole, 1):
            raw = [t or b"" for t in texts(batch.column(1))]
            owner, element, weight = elements(raw)
            cut = np.searchsorted(owner, np.arange(len(raw) + 1))
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array([bag(element[a:b], weight[a:b]).tobytes() for a, b in zip(cut, cut[1:])], pa.binary())], ["row", "bag"])


def _compare(least: float):
    def run(batches):
        for batch in batches:
            bags = zip(batch.column(2).to_pylist(), batch.column(3).to_pylist())
            yield batch.select([0, 1]).filter(pa.array([similarity(np.frombuffer(x, np.uint64), np.frombuffer(y, np.uint64)) >= least for x, y in bags], pa.bool_()))

    return run


def _similar(pairs: DataFrame, bags: DataFrame, least: float) -> DataFrame:
    side = lambda name: bags.select(F.col("row").alias(name), F.col("bag").alias(f"bag_{name}"))
    joined = pairs.join(side("a"), "a").join(side("b"), "b").select("a", "b", "bag_a", "bag_b")
    return arrow(joined, _compare(least), "a long, b long")


def shared_members(bags: list[np.ndarray]) -> np.ndarray:
    """How many members each two of some sets share."""
    n = len(bags)
    owner = np.repeat(np.arange(n), [len(b) for b in bags])
    _, member, times = np.unique(np.concatenate(bags), return_inverse=True, return_counts=True)
    twice = times[member] > 1
    owner, member = owner[twice], np.unique(member[twice], return_inverse=True)[1]
    out = np.zeros((n, n), np.float32)
    order = np.argsort(member, kind="stable")
    owner, member = owner[order], member[order]
    for begin in range(0, int(member[-1]) + 1 if len(member) else 0, FEATURES):
        a, b = np.searchsorted(member, [begin, begin + FEATURES])
        block = np.zeros((n, FEATURES), np.float32)
        block[owner[a:b], member[a:b] - begin] = 1
        out += block @ block.T
    return out


def _forest(least: float):
    """Links between the classes of a group, none that the links before it have made needless."""

    def run(table: pa.Table) -> pa.Table:
        rows, classes_ = table["row"].to_numpy(), table["component"].to_numpy()
        links: list[tuple[int, int]] = []
        if len(np.unique(classes_)) > 1:
            bags = [np.frombuffer(x, np.uint64) for x in table["bag"].to_pylist()]
            shared = shared_members(bags)
            size = np.array([len(b) for b in bags], float)
            close = shared >= least * (size[:, None] + size[None, :] - shared) - 1e-3
            parent = {c: c for c in classes_.tolist()}

            def root(c):
                while parent[c] != c:
                    parent[c] = c = parent[parent[c]]
                return c

            for i, j in zip(*np.nonzero(np.triu(close & (classes_[:, None] != classes_[None, :]), 1))):
                x, y = root(int(classes_[i])), root(int(classes_[j]))
                if x != y and similarity(bags[i], bags[j]) >= least:
                    parent[x] = y
                    links.append((int(rows[i]), int(rows[j])))
        return pa.table({"a": pa.array([x for x, _ in links], pa.int64()), "b": pa.array([y for _, y in links], pa.int64())})

    return run


def _numbered(docs: DataFrame, row: str) -> DataFrame:
    """`docs` with a number for each row, written once: numbers taken anew by each job would change with the executors."""
    return materialise(docs.select(F.monotonically_increasing_id().alias(row), "*"))


def classes(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", similar: float = SIMILAR) -> DataFrame:
    """(row, doc_id, class_id, kept) of every row of `docs`: its class of near duplicates and whether it stands for it.

    Two texts are linked if their weighted similarity over runs of five words is `similar` or more, and a class is what
    links connect; equal texts are one. `class_id` is the smallest doc_id in the class, and its row (one of them, if ids
    repeat) is kept. Null ids come last; a class without ids has a null class_id. A null, empty or blank text is no
    duplicate of any other. `row` numbers the rows of `docs`.

    Equal texts meet by digest, so only one of a group of copies goes on. In a bucket of a band every text is compared with
    the first, which makes no pairs among the others. Where some of them stay apart, all texts of the bucket are compared
    inside tasks, a block with a block, and only links that join two classes leave the task; so no class is missed that any
    link within a bucket makes, and no pairs are made as rows.
    """
    return _classes(_numbered(docs.select(col(doc_id).cast("long").alias("id"), col(text).alias("text")), "row"), similar)


def _classes(keyed: DataFrame, similar: float) -> DataFrame:
    """`keyed`: a stored table of row, id, text."""
    signed = materialise(arrow(keyed, _bands(BANDS, ROWS), "row long, id long, digest binary, bands array<long>"))
    rank = F.struct(F.col("id").isNull().alias("none"), F.col("id"), F.col("row"))
    heads = materialise(signed.where("digest is not null").groupBy("digest").agg(F.min(rank).alias("first"), F.min_by("bands", rank).alias("bands")))
    banded = heads.select(F.col("first.row").alias("row"), F.explode("bands").alias("key"))
    shared = banded.groupBy("key").agg(F.min("row").alias("lead"), F.count("*").alias("n")).where("n > 1").drop("n")
    buckets = materialise(banded.join(shared, "key"))
    pairs = buckets.where("row <> lead").select(F.col("lead").alias("a"), F.col("row").alias("b")).distinct()
    ends = buckets.select("row").distinct()
    bags = materialise(arrow(keyed.select("row", "text").join(ends, "row", "left_semi"), _bags, "row long, bag binary"))
    links = materialise(_similar(pairs, bags, similar))
    joined = materialise(components(links))

    # buckets that still hold several classes
    now = buckets.where("row <> lead").join(joined.withColumnRenamed("node", "row"), "row", "left").withColumn("component", F.coalesce("component", "row"))
    apart = now.groupBy("key").agg(F.min("component").alias("x"), F.max("component").alias("y"), F.ceil(F.count("*") / BLOCK).cast("int").alias("blocks")).where("x <> y").select("key", "blocks")
    rest = now.join(apart, "key").select("key", "row", "component", F.pmod(F.hash("row"), F.col("blocks")).alias("own"), F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)).alias("other"))
    rest = rest.join(bags, "row").select("key", F.least("own", "other").alias("i"), F.greatest("own", "other").alias("j"), "row", "component", "bag")
    more = rest.groupBy("key", "i", "j").applyInArrow(_forest(similar), "a long, b long")
    joined = materialise(components(links.unionByName(more)))

    # from rows over heads to classes
    head = heads.select("digest", F.col("first.row").alias("head"))
    placed = signed.select("row", "id", "digest").join(head, "digest", "left").withColumn("head", F.coalesce("head", "row"))
    placed = placed.join(joined.withColumnRenamed("node", "head"), "head", "left").select("row", "id", F.coalesce("component", "head").alias("class"))
    placed = materialise(placed)
    first = placed.groupBy("class").agg(F.min(rank).alias("first"))
    return placed.join(first, "class").select("row", F.col("id").alias("doc_id"), F.col("first.id").alias("class_id"), (F.col("row") == F.col("first.row")).alias("kept"))


def deduplicate(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", similar: float = SIMILAR) -> DataFrame:
    """The kept rows of `docs`, with all their columns; see `classes`."""
    (row,) = fresh(docs, "row")
    stored = _numbered(docs, row)
    keyed = stored.select(col(row).alias("row"), col(doc_id).cast("long").alias("id"), col(text).alias("text"))
    kept = _classes(keyed, similar).where("kept").select(F.col("row").alias(row))
    return stored.join(kept, row, "left_semi").select(*[col(c) for c in docs.columns])

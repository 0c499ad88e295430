"""Boosted trees and forests over binned rows, by the rules of Spark ML, in numpy tasks over blocks of rows.

Values are binned once, by thresholds as Spark ML takes them, and kept as blocks of a byte per value. Boosted trees are grown
by levels: a pass sums weights and residuals by node, feature and bin, two features at a time, and the driver sees sums only.
Trees of a forest are split in the same way while nodes are large; the rows of a smaller node go to one task, which grows what is
below it.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import StorageLevel
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.linalg import DenseVector
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from marquee.session import discard, materialise, remove, ship

#: Rows of a block, and rounds after which the margins are written, so that a lost executor is not computed from the start.
BLOCK = 1 << 15
WRITTEN = 40
#: Impurities below this are none.
EPSILON = 2.220446049250313e-16
#: Gains that differ by less, as a share of the node's squares, are equal.
ROUNDING = 1e-12


def _mixed(data: bytes, seed: int) -> int:
    """MurmurHash3 of eight bytes."""
    h, mask = seed, 0xFFFFFFFF
    for at in range(0, len(data), 4):
        k = int.from_bytes(data[at : at + 4], "little") * 0xCC9E2D51 & mask
        k = ((k << 15 | k >> 17) & mask) * 0x1B873593 & mask
        h ^= k
        h = ((h << 13 | h >> 19) & mask) * 5 + 0xE6546B64 & mask
    h ^= len(data)
    h = (h ^ h >> 16) * 0x85EBCA6B & mask
    h = (h ^ h >> 13) * 0xC2B2AE35 & mask
    return h ^ h >> 16


def _sample_seed(seed: int) -> int:
    """The first number of Spark's generator, by which Spark ML samples rows for thresholds."""
    data = seed.to_bytes(8, "big", signed=True)
    low = _mixed(data, 0x3C074A61)
    x, mask = _mixed(data, low) << 32 | low, (1 << 64) - 1
    x ^= x << 21 & mask
    x ^= x >> 35
    x ^= x << 4 & mask
    return (x & 0xFFFFFFFF) - (x << 32 >> 32 & 0x80000000) * 2


def _cuts_of(values: np.ndarray, weights: np.ndarray, wanted: float, splits: int) -> np.ndarray:
    """Thresholds of one feature: between all values if there are few, else near equal shares of the weight. `wanted` is the
    weight of the rows; what the values other than zero lack of it is zeros."""
    some = values != 0
    found, places = np.unique(values[some], return_inverse=True)
    held = np.bincount(places, weights[some], len(found))
    lacking = wanted - held.sum()
    if len(found) and lacking > EPSILON * some.sum() * 100:
        at = np.searchsorted(found, 0.0)
        found, held = np.insert(found, at, 0.0), np.insert(held, at, lacking)
    between = (found[:-1] + found[1:]) / 2
    if len(between) <= splits:
        return between
    stride, so_far, cuts = wanted / (splits + 1), held[0], []
    target = stride
    for i in range(1, len(found)):
        before, so_far = so_far, so_far + held[i]
        if abs(before - target) < abs(so_far - target):
            cuts.append(between[i - 1])
            target += stride
    return np.array(cuts)


def thresholds(rows: DataFrame, bins: int, seed: int) -> list[np.ndarray]:
    """Ascending thresholds of every feature of `rows` (features, label, weight), at most `bins` - 1: those Spark ML takes,
    from all rows up to 10,000 and from as many by chance of more."""
    spark = rows.sparkSession
    n, total = rows.agg(F.count(F.lit(1)), F.sum("weight")).first()
    if not n:
        raise ValueError("no rows to train on")
    bins = min(bins, n)
    share = min(1.0, max(bins * bins, 10_000) / n)
    if share < 1:
        taken = rows._jdf.javaRDD().sample(False, share, _sample_seed(seed))
        rows = type(rows)(spark._jsparkSession.createDataFrame(taken, rows._jdf.schema()), spark)
    some = rows.select(vector_to_array("features").alias("x"), "weight").toArrow()
    weights = some["weight"].to_numpy()
    values = some["x"].combine_chunks().flatten().to_numpy().reshape(len(weights), -1) if len(weights) else np.empty((0, 0))
    return [_cuts_of(values[:, f], weights, share * total, bins - 1) for f in range(values.shape[1])]


def _matrix(lists: pa.Array, features: int) -> np.ndarray:
    """(features, rows) of a column of lists."""
    return lists.flatten().to_numpy(zero_copy_only=False).reshape(len(lists), features).T


def _width(cuts: Sequence[np.ndarray]) -> int:
    """A power of two, so many bins at least."""
    return 1 << max(1, int(max(len(c) for c in cuts)).bit_length())


def _paired(bins: np.ndarray, width: int) -> np.ndarray:
    """(pairs of features, rows): the bins of two features as one number."""
    bins = bins.astype(np.uint16 if width <= 256 else np.uint32)
    if len(bins) % 2:
        bins = np.vstack([bins, np.zeros_like(bins[:1])])
    return bins[::2] * bins.dtype.type(width) + bins[1::2]


def _binned(x: np.ndarray, cuts: Sequence[np.ndarray]) -> np.ndarray:
    """(features, rows): bin i holds values up to its threshold i."""
    return np.vstack([np.searchsorted(c, v) for c, v in zip(cuts, x)]).astype(np.uint16)


def stored_blocks(rows: DataFrame, cuts: Sequence[np.ndarray]) -> DataFrame:
    """(n, pairs, signed, block) of blocks of rows, written once and dealt evenly: paired bins, the weight, negative for label 0,
    and a number.
    Small tables have fewer parts than there are cores, as a pass over a block costs less than a task."""
    ship(rows.sparkSession)
    width, features = _width(cuts), len(cuts)

    def run(batches):
        held, count = [], 0
        for batch in batches:
            x, label, weight = _matrix(batch.column(0), features), batch.column(1), batch.column(2)
            if label.null_count or not np.isin(label.to_numpy(zero_copy_only=False), (0, 1)).all():
                raise ValueError("labels must be 0 or 1")
            if weight.null_count or not np.isfinite(x).all():
                raise ValueError("weights must be there, and features finite")
            weight = weight.to_numpy(zero_copy_only=False)
            held.append((_paired(_binned(x, cuts), width), np.where(label.to_numpy(zero_copy_only=False) == 1, weight, -weight)))
            count += len(weight)
            if count >= BLOCK:
                yield packed(held)
                held, count = [], 0
        if count:
            yield packed(held)

    def packed(held):
        pairs, signed = (np.concatenate(x, axis=-1) for x in zip(*held))
        columns = [pa.array([len(signed)], pa.int64()), pa.array([pairs.tobytes()], pa.binary()), pa.array([signed.tobytes()], pa.binary())]
        return pa.RecordBatch.from_arrays(columns, ["n", "pairs", "signed"])

    plain = rows.select(vector_to_array("features").alias("x"), F.col("label").cast("double"), F.col("weight").cast("double"))
    blocks = plain.mapInArrow(run, "n long, pairs binary, signed binary")
    parts = min(rows.sparkSession.sparkContext.defaultParallelism, -(-rows.count() // BLOCK))
    return materialise(blocks.repartition(max(1, parts)).withColumn("block", F.monotonically_increasing_id()))


@dataclass(frozen=True)
class Tree:
    """A whole binary tree by levels: node i has children 2i + 1 and 2i + 2. `feature` is -1 where a node is not split; its left
    child then stands for it. A row goes right if its bin is above `cut`."""

    feature: np.ndarray
    cut: np.ndarray
    value: np.ndarray
    gain: np.ndarray

    @staticmethod
    def empty(depth: int) -> Tree:
        size = 2 ** (depth + 1) - 1
        return Tree(np.full(size, -1), np.zeros(size, int), np.zeros(size), np.zeros(size))

    def places(self, above, rows: int, depth: int) -> np.ndarray:
        """The node of each row on the level `depth`, from 0 there; above(f, t): rows whose bin of feature f is above t."""
        at = np.zeros(rows, np.uint8 if depth <= 8 else np.int64)
        for level in range(depth):
            right = np.zeros(rows, bool)
            for k in range(2**level):
                node = 2**level - 1 + k
                if self.feature[node] >= 0:
                    right |= above(self.feature[node], self.cut[node]) & (at == k)
            at = at * 2 + right
        return at


def _above(pairs: np.ndarray, width: int):
    def above(f, t):
        return pairs[f // 2] >= (t + 1) * width if f % 2 == 0 else (pairs[f // 2] & (width - 1)) > t

    return above


def _level_sums(blocks, tree: Tree, level: int, width: int, features: int):
    """One (weights, weighted residuals, their squares) of a partition: by node, feature and bin, the squares by node."""
    nodes = 2**level
    weights, sums, squares = np.zeros((nodes, features + 1, width)), np.zeros((nodes, features + 1, width)), np.zeros(nodes)
    for pairs, signed, _, residual in blocks:
        weight = np.abs(signed)
        weighted = weight * residual
        at = tree.places(_above(pairs, width), len(signed), level).astype(np.int64)
        squares += np.bincount(at, weighted * residual, nodes)
        at *= width * width
        for p in range(len(pairs)):
            key = at + pairs[p]
            for out, x in ((weights, weight), (sums, weighted)):
                both = np.bincount(key, x, nodes * width * width).reshape(nodes, width, width)
                out[:, 2 * p] += both.sum(axis=2)
                if 2 * p + 1 < features:
                    out[:, 2 * p + 1] += both.sum(axis=1)
    yield weights[:, :features], sums[:, :features], squares


def _split_level(tree: Tree, level: int, weights: np.ndarray, sums: np.ndarray, squares: np.ndarray) -> bool:
    """Splits the nodes of a level where the variance falls most, the first feature and threshold of equals; sets the values of
    their children."""
    bins, split = weights.shape[2], False
    left_w, left_s = np.cumsum(weights, 2)[:, :, :-1], np.cumsum(sums, 2)[:, :, :-1]
    right_w, right_s = (np.cumsum(x[:, :, ::-1], 2)[:, :, ::-1][:, :, 1:] for x in (weights, sums))
    for k in range(len(weights)):
        node, total, mass = 2**level - 1 + k, weights[k, 0].sum(), sums[k, 0].sum()
        if level == 0:
            tree.value[0] = mass / total
        tree.value[2 * node + 1] = tree.value[node]
        if not total > 0 or (squares[k] - mass * mass / total) / total < EPSILON:
            continue
        with np.errstate(divide="ignore", invalid="ignore"):
            gain = left_s[k] ** 2 / left_w[k] + right_s[k] ** 2 / right_w[k] - mass * mass / total
        gain = np.where((left_w[k] > 0) & (right_w[k] > 0), gain, -np.inf)
        equal = gain >= gain.max() - ROUNDING * squares[k]  # features in the same order split alike, but for the last digits
        f, t = divmod(int(np.argmax(equal)), bins - 1)
        if not gain[f, t] > 0:
            continue
        split = True
        tree.feature[node], tree.cut[node], tree.gain[node] = f, t, gain[f, t]
        tree.value[2 * node + 1], tree.value[2 * node + 2] = left_s[k, f, t] / left_w[k, f, t], right_s[k, f, t] / right_w[k, f, t]
    return split


@dataclass(frozen=True)
class BoostedTrees:
    """Trees that add up to half the log odds of label 1. `featureImportances`, `transform` and their columns are as in Spark ML."""

    cuts: list[np.ndarray]
    trees: list[Tree]
    rates: list[float]
    depth: int

    @property
    def featureImportances(self) -> DenseVector:
        total = np.zeros(len(self.cuts))
        for tree in self.trees:
            some = tree.feature >= 0
            np.add.at(total, tree.feature[some], tree.gain[some])
        return DenseVector(total / total.sum() if total.sum() else total)

    def transform(self, df: DataFrame) -> DataFrame:
        ship(df.sparkSession)
        cuts, depth, last = self.cuts, self.depth, 2**self.depth - 1
        grown = list(zip(self.trees, self.rates))

        @F.arrow_udf("double")
        def margin(lists: pa.Array) -> pa.Array:
            bins = _binned(_matrix(lists, len(cuts)), cuts)
            out = np.zeros(len(lists))
            for tree, rate in grown:
                out += rate * tree.value[last + tree.places(lambda f, t: bins[f] > t, len(out), depth).astype(np.int64)]
            return pa.array(out)

        scored = df.withColumn("_margin", margin(vector_to_array("features")))
        p0 = 1 / (1 + F.exp(2 * F.col("_margin")))
        return scored.withColumns({
            "rawPrediction": array_to_vector(F.array(-F.col("_margin"), F.col("_margin"))),
            "probability": array_to_vector(F.array(p0, 1 - p0)),
            "prediction": (F.col("_margin") > 0).cast("double"),
        }).drop("_margin")


def _instead(spark, old: str | None, new: str | None) -> str | None:
    if old:
        remove(spark, old)
    return new


def boost(rows: DataFrame, rounds: int, rate: float, depth: int, bins: int, seed: int) -> BoostedTrees:
    """Boosted trees for logistic loss on `rows` (features, label, weight), the ones Spark ML's classifier grows.

    Blocks lie in the executors with the margins and residuals of their rows; a round reads them once for each level, and the
    first of these passes adds the last tree to the margins. The first tree is grown on the labels themselves, as 1 and -1."""
    cuts = thresholds(rows, bins, seed)
    stored, width, features = stored_blocks(rows, cuts), _width(cuts), len(cuts)
    kind = np.uint16 if width <= 256 else np.uint32

    def decoded(r):
        signed = np.frombuffer(r.signed)
        return np.frombuffer(r.pairs, kind).reshape(-1, r.n), signed, np.zeros(r.n), np.copysign(1.0, signed)

    def added(tree, rate):
        def run(block):
            pairs, signed, margin, _ = block
            at = tree.places(_above(pairs, width), len(signed), depth).astype(np.int64)
            margin = margin + rate * tree.value[2**depth - 1 + at]
            label = np.copysign(1.0, signed)
            return pairs, signed, margin, 4 * label / (1 + np.exp(2 * label * margin))

        return run

    def sums(tree, level):
        return lambda blocks: _level_sums(blocks, tree, level, width, features)

    state, before, written, trees, rates = stored.rdd.map(decoded).persist(StorageLevel.MEMORY_AND_DISK), None, None, [], []
    for k in range(rounds):
        if k:
            before, state = state, state.map(added(trees[-1], rates[-1])).persist(StorageLevel.MEMORY_AND_DISK)
            if k % WRITTEN == 0:
                state.checkpoint()
        tree = Tree.empty(depth)
        for level in range(depth):
            parts = state.mapPartitions(sums(tree, level)).collect()
            if before is not None:
                before.unpersist()
                before = None
                if state.isCheckpointed():
                    written = _instead(rows.sparkSession, written, state.getCheckpointFile())
            if not _split_level(tree, level, *(np.sum(x, axis=0) for x in zip(*parts))):
                for lower in range(level + 1, depth):
                    for node in range(2**lower - 1, 2 ** (lower + 1) - 1):
                        tree.value[2 * node + 1] = tree.value[node]
                break
        trees.append(tree)
        rates.append(rate if k else 1.0)
    state.unpersist()
    _instead(rows.sparkSession, written, None)
    discard(stored)
    return BoostedTrees(cuts, trees, rates, depth)


#: Rows of a tree that one task grows on its own; nodes with more are split by sums over all blocks.
PART = 1 << 18

#: Nodes of a tree as arrays: the feature (-1: a leaf) and bin of the split, the left child (the right one follows it), the share
#: of label 1.
_NODE = [np.dtype(x) for x in ("int16", "uint16", "int32", "float64")]


def _pack(*nodes: np.ndarray) -> bytes:
    return b"".join(x.astype(t).tobytes() for x, t in zip(nodes, _NODE))


def _unpack(data: bytes) -> list[np.ndarray]:
    n, out, at = len(data) // sum(t.itemsize for t in _NODE), [], 0
    for t in _NODE:
        out.append(np.frombuffer(data, t, n, at))
        at += n * t.itemsize
    return out


def _descend(bins: np.ndarray, feature: np.ndarray, cut: np.ndarray, child: np.ndarray) -> np.ndarray:
    """The leaf of every row of `bins` (rows, features)."""
    at, flat = np.zeros(len(bins), np.int64), bins.ravel()
    go = np.flatnonzero(feature[at] >= 0)
    while len(go):
        here = at[go]
        at[go] = child[here] + (flat[go * bins.shape[1] + feature[here]] > cut[here])
        go = go[feature[at[go]] >= 0]
    return at


def _drawn(rng: np.random.Generator, nodes: int, features: int, some: int) -> np.ndarray:
    """(nodes, some): features of each node by chance, ascending."""
    return np.sort(np.argpartition(rng.random((nodes, features)), some - 1, axis=1)[:, :some], axis=1)


def _least(total: np.ndarray) -> np.ndarray:
    """Gains up to this come from rounding."""
    return 1e-9 / total


def _fall(l0, l1, a0, a1):
    """By how much a split of (a0, a1) into (l0, l1) and the rest lowers the Gini impurity."""
    left, whole, r0, r1 = l0 + l1, a0 + a1, a0 - l0, a1 - l1
    with np.errstate(divide="ignore", invalid="ignore"):
        return ((l0 * l0 + l1 * l1) / left + (r0 * r0 + r1 * r1) / (whole - left) - (a0 * a0 + a1 * a1) / whole) / whole


def _best_cuts(node, bins, w0, w1, a0, a1, width):
    """(gain, bin) of the best cut of every node by one feature, from its rows in order of their bins; all nodes have rows."""
    key = node * width + bins
    order = np.argsort(key)
    key = key[order]
    end = np.flatnonzero(np.append(key[1:] != key[:-1], True))
    key = key[end]
    at = key // width
    l0, l1 = (np.cumsum(w[order])[end] - (np.cumsum(a) - a)[at] for w, a in ((w0, a0), (w1, a1)))
    new = np.append(True, at[1:] != at[:-1])
    gain = np.where(np.append(~new[1:], False), _fall(l0, l1, a0[at], a1[at]), -np.inf)
    best = np.maximum.reduceat(gain, np.flatnonzero(new))
    hit = np.flatnonzero(gain >= best[at] - ROUNDING)
    hit = hit[np.append(True, at[hit][1:] != at[hit][:-1])]
    return best, key[hit] % width


def _pruned(feature, child, share):
    """Splits whose sides are leaves that say the same are leaves, from below, as in Spark ML."""
    feature = feature.copy()
    for i in np.flatnonzero(feature >= 0)[::-1]:
        a, b = child[i], child[i] + 1
        if feature[a] < 0 and feature[b] < 0 and (share[a] > 0.5) == (share[b] > 0.5):
            feature[i] = -1
    return feature


def _grow_part(bins: np.ndarray, w0: np.ndarray, w1: np.ndarray, depth: int, some: int, width: int, rng: np.random.Generator):
    """(feature, cut, child, share, gain) of the tree on a few rows (rows, features), with their weight of either label. All nodes
    of a level are split together."""
    features, flat, levels = bins.shape[1], bins.ravel(), []
    rows, node, nodes, made = np.arange(len(bins)), np.zeros(len(bins), np.int64), 1, 0
    for level in range(depth + 1):
        a0, a1 = np.bincount(node, w0[rows], nodes), np.bincount(node, w1[rows], nodes)
        feature, cut, child, gains = np.full(nodes, -1), np.zeros(nodes, int), np.full(nodes, -1), np.zeros(nodes)
        with np.errstate(invalid="ignore"):
            levels.append((feature, cut, child, a1 / (a0 + a1), gains))
        mixed = (a0 > 0) & (a1 > 0)
        if level == depth or not mixed.any():
            break
        stay = mixed[node]
        rows, node, a0, a1 = rows[stay], (np.cumsum(mixed) - 1)[node[stay]], a0[mixed], a1[mixed]
        drawn, at, x0, x1 = _drawn(rng, len(a0), features, some), rows * features, w0[rows], w1[rows]
        best, by, where = _least(a0 + a1), np.full(len(a0), -1), np.zeros(len(a0), int)
        for j in range(some):
            gain, bin_ = _best_cuts(node, flat[at + drawn[node, j]], x0, x1, a0, a1, width)
            better = gain > best + (by >= 0) * ROUNDING
            best, by, where = np.where(better, gain, best), np.where(better, drawn[:, j], by), np.where(better, bin_, where)
        split = by >= 0
        first = (np.cumsum(split) - 1) * 2
        made, nodes = made + nodes, 2 * int(split.sum())
        feature[mixed], cut[mixed], child[mixed] = by, where, np.where(split, made + first, -1)
        gains[mixed] = np.where(split, best * (a0 + a1), 0)
        if not nodes:
            break
        go = split[node]
        rows, node = rows[go], node[go]
        node = first[node] + (flat[rows * features + by[node]] > where[node])
    feature, cut, child, share, gain = (np.concatenate(x) for x in zip(*levels))
    feature = _pruned(feature, child, share)
    return feature, cut, child, share, gain


class _Top:
    """The upper nodes of one tree, on the driver: those with more than PART rows, and their children. A node that is open is not
    known to be a leaf, nor split here."""

    def __init__(self):
        self.feature, self.cut, self.child, self.share, self.gain, self.level, self.rows, self.open = [], [], [], [], [], [], [], []
        self.add(0, np.nan, np.inf, True)

    def add(self, level: int, share: float, rows: float, open_: bool) -> None:
        new = {"feature": -1, "cut": 0, "child": -1, "share": share, "gain": 0.0, "level": level, "rows": rows, "open": open_}
        for name, x in new.items():
            getattr(self, name).append(x)

    def arrays(self):
        return np.array(self.feature), np.array(self.cut), np.array(self.child)

    def large(self) -> list[int]:
        return [i for i, (n, o) in enumerate(zip(self.rows, self.open)) if o and n > PART]


def _unpaired(pairs: np.ndarray, width: int, features: int) -> np.ndarray:
    """(rows, features) of paired bins."""
    both = np.stack([pairs // width, pairs % width], axis=1).reshape(-1, pairs.shape[1])[:features]
    return np.ascontiguousarray(both.T.astype(np.uint8 if width <= 256 else np.uint16))


def _bag(seed: int, block: int, tree: int, rows: int, trees: int) -> np.ndarray:
    """How often each row of a block is drawn for a tree; a tree alone gets every row once."""
    return np.random.default_rng((seed, block, tree)).poisson(1.0, rows) if trees > 1 else np.ones(rows, int)


def _top_sums(blocks, seed, tops, front, drawn, width, trees):
    """By tree: sums of the weight of either label and the count of rows, by node of the front, drawn feature and bin."""
    sums = {t: np.zeros((3, len(front[t]), drawn[t].shape[1], width)) for t in front}
    for block, bins, signed in blocks:
        for t, out in sums.items():
            place = np.full(len(tops[t][0]), -1)
            place[front[t]] = np.arange(len(front[t]))
            node, bag = place[_descend(bins, *tops[t])], _bag(seed, block, t, len(signed), trees)
            rows = np.flatnonzero((node >= 0) & (bag > 0))
            node, weight = node[rows], bag[rows] * np.abs(signed[rows])
            ones = ~np.signbit(signed[rows])
            for j in range(out.shape[2]):
                key = node * width + bins[rows, drawn[t][node, j]]
                for i, w in enumerate((weight * ~ones, weight * ones, None)):
                    out[i, :, j] += np.bincount(key, w, len(front[t]) * width).reshape(-1, width)
    yield sums


def _split_top(top: _Top, node: int, sums: np.ndarray, drawn: np.ndarray, depth: int) -> None:
    """Splits a node by its (3, drawn features, bins) sums, or closes it."""
    a0, a1 = sums[:2, 0].sum(axis=1)
    top.share[node] = a1 / (a0 + a1) if a0 + a1 else np.nan
    left = np.cumsum(sums, axis=2)[:, :, :-1]
    gain = _fall(left[0], left[1], a0, a1)
    gain = np.where((left[2] > 0) & (left[2] < sums[2].sum(axis=1, keepdims=True)), gain, -np.inf)
    equal = gain >= gain.max() - ROUNDING
    j, t = divmod(int(np.argmax(equal)), gain.shape[1])
    top.open[node] = False
    if not (a0 > 0 and a1 > 0 and gain[j, t] > _least(a0 + a1)):
        return
    top.feature[node], top.cut[node], top.child[node], top.gain[node] = int(drawn[j]), t, len(top.feature), gain[j, t] * (a0 + a1)
    for side in (sums[:, j, : t + 1], sums[:, j, t + 1 :]):
        s0, s1, n = side.sum(axis=1)
        top.add(top.level[node] + 1, s1 / (s0 + s1), n, bool(s0 > 0 and s1 > 0 and top.level[node] + 1 < depth))


@dataclass(frozen=True)
class Forest:
    """Trees in a table: the upper nodes of each are here, what lies below one of them is a row of `parts` (tree, part, data,
    leaf, share, gains). `featureImportances`, `transform` and their columns are as in Spark ML."""

    cuts: list[np.ndarray]
    tops: list[tuple]
    parts: DataFrame
    gains: np.ndarray

    @property
    def featureImportances(self) -> DenseVector:
        shares = self.gains.copy()
        for r in self.parts.select("tree", "gains").toLocalIterator():
            shares[r.tree] += np.frombuffer(r.gains)
        whole = shares.sum(axis=1, keepdims=True)
        total = np.divide(shares, whole, out=np.zeros_like(shares), where=whole > 0).sum(axis=0)
        return DenseVector(total / total.sum() if total.sum() else total)

    def transform(self, df: DataFrame) -> DataFrame:
        """Rows are numbered and written once; each tree sends them, as blocks, to the parts they fall into, which are held one
        at a time while their blocks stream by. The shares of label 1 are averaged by row."""
        spark, cuts, tops = df.sparkSession, self.cuts, self.tops
        ship(spark)
        own = "_row"
        while any(c.startswith(own) for c in df.columns):
            own = "_" + own
        rows = materialise(df.withColumn(own, F.monotonically_increasing_id()))

        def dealt(batches):
            for batch in batches:
                bins = np.ascontiguousarray(_binned(_matrix(batch.column(1), len(cuts)), cuts).T)
                ids, out = batch.column(0).to_numpy(), []
                for t, top in enumerate(tops):
                    part = _descend(bins, *top)
                    order = np.argsort(part, kind="stable")
                    for some in np.split(order, np.flatnonzero(np.diff(part[order])) + 1) if len(order) else []:
                        out.append((t, int(part[some[0]]), 1, ids[some].tobytes(), bins[some].tobytes()))
                if out:
                    yield pa.RecordBatch.from_arrays([pa.array(list(c), k) for c, k in zip(zip(*out), kinds)], ["tree", "part", "kind", "ids", "data"])

        kinds = [pa.int32(), pa.int32(), pa.int32(), pa.binary(), pa.binary()]

        def scored(batches):
            held, of = None, None
            for batch in batches:
                for *key, kind, ids, data in zip(*(c.to_pylist() for c in batch.columns[:3]), *batch.columns[3:]):
                    if kind == 0:
                        held, of = _unpack(data.as_py()), key
                    if kind == 0 or key != of:  # of a tree without rows there is no part
                        continue
                    ids = np.frombuffer(ids.as_buffer(), np.int64)
                    share = held[3][_descend(np.frombuffer(data.as_buffer(), np.uint16).reshape(len(ids), -1), *held[:3])]
                    yield pa.RecordBatch.from_arrays([pa.array(ids), pa.array(share, mask=np.isnan(share))], ["id", "share"])

        schema = "tree int, part int, kind int, ids binary, data binary"
        blocks = rows.select(own, vector_to_array("features").alias("x")).mapInArrow(dealt, schema)
        parts = self.parts.select("tree", "part", F.lit(0).alias("kind"), F.lit(b"").alias("ids"), "data")
        tasks = 4 * spark.sparkContext.defaultParallelism
        met = parts.unionByName(blocks).repartition(tasks, "tree", "part").sortWithinPartitions("tree", "part", "kind")
        shares = met.mapInArrow(scored, "id long, share double").groupBy(F.col("id").alias(f"{own}_id")).agg(F.avg("share").alias(f"{own}_share"))
        p1 = F.coalesce(F.col(f"{own}_share"), F.lit(0.5))
        out = rows.join(shares, F.col(own) == F.col(f"{own}_id"), "left").withColumns({
            "rawPrediction": array_to_vector(F.array((1 - p1) * len(tops), p1 * len(tops))),
            "probability": array_to_vector(F.array(1 - p1, p1)),
            "prediction": (p1 > 0.5).cast("double"),
        })
        return out.drop(own, f"{own}_id", f"{own}_share")


def grow_forest(rows: DataFrame, trees: int, depth: int, bins: int, seed: int) -> Forest:
    """A forest on `rows` (features, label, weight) by the rules of Spark ML's classifier: rows drawn with replacement, the root of
    the number of features drawn for each node, Gini impurity, equal leaves joined. Spark ML holds all trees in the driver, and
    trees of labels that features do not tell grow to nearly a leaf a row; here, only nodes of more than PART rows are split by
    passes over all blocks, what is below them is grown by the task that gets their rows, and stays in a table."""
    spark, cuts = rows.sparkSession, thresholds(rows, bins, seed)
    width, features = _width(cuts), len(cuts)
    some = int(np.ceil(np.sqrt(features))) if trees > 1 else features
    kind, stored = np.uint16 if width <= 256 else np.uint32, stored_blocks(rows, cuts)

    def opened(r):
        return r.block, _unpaired(np.frombuffer(r.pairs, kind).reshape(-1, r.n), width, features), np.frombuffer(r.signed)

    tops, all_rows = [_Top() for _ in range(trees)], stored.agg(F.sum("n")).first()[0]
    front = {t: [0] for t in range(trees)} if all_rows > PART else {}
    while front:
        rng = {t: [np.random.default_rng((seed, t, i)) for i in front[t]] for t in front}
        drawn = {t: np.vstack([_drawn(r, 1, features, some) for r in rng[t]]) if trees > 1 else np.tile(np.arange(features), (len(rng[t]), 1)) for t in front}
        now = {t: tops[t].arrays() for t in front}
        found = stored.rdd.map(opened).mapPartitions(lambda b, f=front, d=drawn, n=now: _top_sums(b, seed, n, f, d, width, trees)).reduce(
            lambda a, b: {t: a[t] + b[t] for t in a}
        )
        for t, nodes in front.items():
            for k, node in enumerate(nodes):
                _split_top(tops[t], node, found[t][:, k], drawn[t][k], depth)
        front = {t: nodes for t in front if (nodes := tops[t].large())}
    shapes, closed = [t.arrays() for t in tops], [~np.array(t.open) for t in tops]
    levels = [t.level for t in tops]

    def dealt(batches):
        for batch in batches:
            for n, pairs, signed, number in zip(*batch.columns):
                number, signed = number.as_py(), np.frombuffer(signed.as_buffer())
                bins_, out = _unpaired(np.frombuffer(pairs.as_buffer(), kind).reshape(-1, n.as_py()), width, features), []
                for t in range(trees):
                    bag = _bag(seed, number, t, len(signed), trees)
                    part = _descend(bins_, *shapes[t])
                    mine = np.flatnonzero((bag > 0) & ~closed[t][part])
                    mine = mine[np.argsort(part[mine], kind="stable")]
                    for rows_ in np.split(mine, np.flatnonzero(np.diff(part[mine])) + 1) if len(mine) else []:
                        out.append((t, int(part[rows_[0]]), bins_[rows_].tobytes(), (signed[rows_] * bag[rows_]).tobytes()))
                if out:
                    kinds = (pa.int32(), pa.int32(), pa.binary(), pa.binary())
                    yield pa.RecordBatch.from_arrays([pa.array(list(c), k) for c, k in zip(zip(*out), kinds)], ["tree", "part", "bins", "signed"])

    def grown(key, table):
        t, part = (k.as_py() for k in key)
        signed = np.concatenate([np.frombuffer(x.as_buffer()) for x in table["signed"]])
        bins_ = np.concatenate([np.frombuffer(x.as_buffer(), np.uint8 if width <= 256 else np.uint16) for x in table["bins"]]).reshape(len(signed), -1)
        weight, ones = np.abs(signed), ~np.signbit(signed)
        rng = np.random.default_rng((seed, t, part, 1))
        feature, cut, child, share, gain = _grow_part(bins_, weight * ~ones, weight * ones, depth - levels[t][part], some, width, rng)
        return table_of([(t, part, _pack(feature, cut, child, share), bool(feature[0] < 0), float(share[0]), _by_feature(feature, gain, features).tobytes())])

    def table_of(found):
        kinds = (pa.int32(), pa.int32(), pa.binary(), pa.bool_(), pa.float64(), pa.binary())
        return pa.table([pa.array(list(c), k) for c, k in zip(zip(*found), kinds)], ["tree", "part", "data", "leaf", "share", "gains"])

    schema = "tree int, part int, data binary, leaf boolean, share double, gains binary"
    tasks = max(4 * spark.sparkContext.defaultParallelism, sum(len(t.feature) for t in tops) // 4)
    sent = stored.mapInArrow(dealt, "tree int, part int, bins binary, signed binary").repartition(tasks, "tree", "part")
    below = materialise(sent.groupBy("tree", "part").applyInArrow(grown, schema))
    discard(stored)
    leaves = {(r.tree, r.part): r.share for r in below.where("leaf").select("tree", "part", "share").toLocalIterator()}
    nothing, alone, final, gains = np.zeros(features).tobytes(), [], [], np.zeros((trees, features))
    for t, top in enumerate(tops):
        feature, cut, child = shapes[t]
        share = np.array([leaves.get((t, i), s) for i, s in enumerate(top.share)])
        deep = np.array([f < 0 and o and (t, i) not in leaves for i, (f, o) in enumerate(zip(top.feature, top.open))])
        feature = np.where(deep, features, feature)  # not a leaf, for now
        child = np.where(deep, np.arange(len(deep)), child)
        kept = np.array(feature)
        for i in range(len(feature) - 1, -1, -1):
            if not deep[i] and kept[i] >= 0 and kept[child[i]] < 0 and kept[child[i] + 1] < 0 and (share[child[i]] > 0.5) == (share[child[i] + 1] > 0.5):
                kept[i] = -1
        kept = np.where(deep, -1, kept)
        gains[t] = _by_feature(kept, np.array(top.gain), features)
        final.append((kept, cut, np.where(deep, -1, child)))
        ends = [i for i in range(len(kept)) if kept[i] < 0 and not deep[i] and (t, i) not in leaves]
        alone += [(t, i, _pack(*map(np.array, ([-1], [0], [-1], [share[i]]))), True, float(share[i]), nothing) for i in ends]
    if alone:
        below = below.unionByName(spark.createDataFrame(alone, schema))
    return Forest(cuts, final, below, gains)


def _by_feature(feature: np.ndarray, gain: np.ndarray, features: int) -> np.ndarray:
    some = feature >= 0
    return np.bincount(feature[some], gain[some], features)

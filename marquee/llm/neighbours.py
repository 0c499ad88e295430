"""Nearest vectors by inner product, with multi-probe hashing on p-stable projections.

Vectors are lengthened by one component to equal norms, so that the largest inner product is the least distance. A table's
bucket is the cell of a few random projections, cut into steps; a query visits its own cell and then perturbed ones in the
order of their estimated success, the sum of squared distances to the cells' edges. Candidates of all tables are merged and
ranked by exact inner products of the original vectors. How many cells are visited is set on a bounded sample of queries
whose exact neighbours are known, so that the wanted recall is reached.
"""

from __future__ import annotations

from dataclasses import dataclass
from heapq import heappop, heappush

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from marquee.llm.base import arrow, col
from marquee.session import materialise

#: Tables, step of a projection (in deviations of one), and vectors wanted in a bucket.
TABLES, STEP, BUCKET = 10, 2.0, 1_024
#: Queries that the number of probes is set on, vectors that the projections' number is set on, recall aimed at.
SAMPLE, SHAPE, AIM = 200, 2_000, 0.95
#: Candidates of a bucket in one task; a larger bucket is dealt to several.
HOT = 4_096


@dataclass
class Index:
    dim: int
    largest: float
    projections: np.ndarray  # tables x (dim + 1) x hashes
    offsets: np.ndarray  # tables x hashes
    mixers: np.ndarray  # hashes
    probes: int = 1

    def cells(self, vectors: np.ndarray, query: bool) -> np.ndarray:
        """Real-valued cells: tables x vectors x hashes."""
        scaled = vectors / self.largest
        last = np.zeros(len(scaled)) if query else np.sqrt(np.maximum(0, 1 - (scaled * scaled).sum(1)))
        longer = np.concatenate([scaled, last[:, None]], 1)
        return np.einsum("nd,tdk->tnk", longer, self.projections, optimize=True) / STEP + self.offsets[:, None, :]

    def keys(self, table: int, cells: np.ndarray) -> np.ndarray:
        """Bucket numbers of whole cells (... x hashes)."""
        h = (cells.astype(np.int64).view(np.uint64) * self.mixers).sum(-1) + np.uint64((table + 1) * 0x9E3779B97F4A7C15 & 0xFFFFFFFFFFFFFFFF)
        h ^= h >> np.uint64(29)
        h *= np.uint64(0xBF58476D1CE4E5B9)
        return (h ^ (h >> np.uint64(32))).view(np.int64)


def perturbations(fraction: np.ndarray, probes: int) -> list[list[tuple[int, int]]]:
    """The first `probes` sets of (hash, step) by estimated success; the first is empty. `fraction`: place in the cell."""
    steps = sorted([(f * f, i, -1) for i, f in enumerate(fraction.tolist())] + [((1 - f) ** 2, i, 1) for i, f in enumerate(fraction.tolist())])
    out: list[list[tuple[int, int]]] = [[]]
    queue = [(steps[0][0], (0,))]
    while queue and len(out) < probes:
        cost, chosen = heappop(queue)
        hashes = [steps[j][1] for j in chosen]
        if len(set(hashes)) == len(hashes):
            out.append([(steps[j][1], steps[j][2]) for j in chosen])
        last = chosen[-1]
        if last + 1 < len(steps):
            heappush(queue, (cost - steps[last][0] + steps[last + 1][0], (*chosen[:-1], last + 1)))
            heappush(queue, (cost + steps[last + 1][0], (*chosen, last + 1)))
    return out


def _probes(index: Index, vectors: np.ndarray, most: int):
    """(table, vector, keys in the order of visits)."""
    cells = index.cells(vectors, True)
    whole = np.floor(cells)
    for t in range(len(cells)):
        for i in range(len(vectors)):
            sets = perturbations(cells[t, i] - whole[t, i], most)
            visited = np.repeat(whole[t, i][None], len(sets), 0)
            for k, chosen in enumerate(sets):
                for j, step in chosen:
                    visited[k, j] += step
            yield t, i, index.keys(t, visited)


def _matrix(column: pa.Array, dim: int) -> np.ndarray:
    return np.frombuffer(b"".join(column.to_pylist()), "<f8").reshape(-1, dim)


def _packed(dim: int):
    """Vectors as bytes, shorter ones filled up with zeros."""

    def run(batches):
        for batch in batches:
            raw = [np.array(v, "<f8").tobytes().ljust(8 * dim, b"\0") for v in batch.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(raw, pa.binary()), batch.column(2)], ["class", "vector", "ids"])

    return run


def _best(queries, classes, scores, n: int):
    """The n best classes of each query, each class once: by score, then smaller class."""
    order = np.lexsort((-scores, classes, queries))
    q, c = queries[order], classes[order]
    once = order[np.append(True, (q[1:] != q[:-1]) | (c[1:] != c[:-1]))] if len(order) else order
    order = once[np.lexsort((classes[once], -scores[once], queries[once]))]
    q = queries[order]
    rank = np.arange(len(q)) - np.searchsorted(q, q, "left")
    order = order[rank < n]
    return queries[order], classes[order], scores[order]


_FOUND = "query long, class long, score double"


def _exact(sample, dim: int, n: int):
    """The best classes of a bounded sample of queries among all vectors of a task."""

    def run(batches):
        names, vectors = sample.value
        for batch in batches:
            own, x = batch.column(0).to_numpy(), _matrix(batch.column(1), dim)
            if len(x):
                scores = vectors @ x.T
                top = np.argsort(-scores, axis=1, kind="stable")[:, :n]
                yield pa.RecordBatch.from_arrays([pa.array(np.repeat(names, top.shape[1])), pa.array(own[top].reshape(-1)), pa.array(np.take_along_axis(scores, top, 1).reshape(-1))], ["query", "class", "score"])

    return run


def _hashed(index: Index, query: bool):
    def run(batches):
        for batch in batches:
            for begin in range(0, len(batch), 500):
                part = batch.slice(begin, 500)
                x = _matrix(part.column(1), index.dim)
                if query:
                    keys, rows = [], []
                    for _, i, own in _probes(index, x, index.probes):
                        keys.append(own)
                        rows.append(np.full(len(own), i))
                    keys, rows = (np.concatenate(v) if v else np.empty(0, np.int64) for v in (keys, rows))
                else:
                    cells = np.floor(index.cells(x, False))
                    keys = np.concatenate([index.keys(t, cells[t]) for t in range(len(cells))])
                    rows = np.tile(np.arange(len(x)), len(cells))
                take = pa.array(rows, pa.int64())
                yield pa.RecordBatch.from_arrays([pa.array(keys, pa.int64()), pa.array([query] * len(rows), pa.bool_()), part.column(0).take(take), part.column(1).take(take)], ["bucket", "asks", "class", "vector"])

    return run


def _leading(x: np.ndarray, vectors: np.ndarray, n: int):
    """(query, vector, exact score) of all pairs that may be among the n best of their query, in pieces. Whatever ties with
    the n-th, or is no further below it than the product's rounding error, is among them; ids decide later."""
    scores = x @ vectors.T
    m = min(n, scores.shape[1])
    last = np.partition(scores, scores.shape[1] - m, axis=1)[:, scores.shape[1] - m]
    error = 4 * x.shape[1] * np.finfo(float).eps * np.linalg.norm(x, axis=1) * np.linalg.norm(vectors, axis=1).max()
    i, j = np.nonzero(scores >= (last - error)[:, None])
    for k in range(0, len(i), 20_000):
        p, q = i[k : k + 20_000], j[k : k + 20_000]
        yield p, q, (x[p] * vectors[q]).sum(1)  # one order of summation, whatever the block


def _searched(dim: int, n: int):
    """Rows come by bucket and salt, vectors before the queries that visit them."""

    def run(batches):
        held: list[tuple] = []
        count, key, names, vectors = 0, None, [], []
        for batch in batches:
            buckets, salts, asks = (batch.column(k).to_numpy(zero_copy_only=False) for k in (0, 1, 2))
            own, x = batch.column(3).to_numpy(), _matrix(batch.column(4), dim)
            new = np.append(True, (buckets[1:] != buckets[:-1]) | (salts[1:] != salts[:-1]) | (asks[1:] != asks[:-1])) if len(own) else np.empty(0, bool)
            begins = np.flatnonzero(new)
            for a, b in zip(begins, np.append(begins[1:], len(own))):
                here = (buckets[a], salts[a])
                if here != key:
                    key, names, vectors = here, [], []
                if not asks[a]:
                    names.append(own[a:b])
                    vectors.append(x[a:b])
                    continue
                if not names:
                    continue
                if len(names) > 1:
                    names, vectors = [np.concatenate(names)], [np.concatenate(vectors)]
                for c in range(a, b, 256):
                    d = min(b, c + 256)
                    for i, j, exact in _leading(x[c:d], vectors[0], n):
                        held.append((own[c:d][i], names[0][j], exact))
                        count += exact.size
                        if count > 400_000:
                            held = [_best(*map(np.concatenate, zip(*held)), n)]
                            count = len(held[0][0])
                            if count > 200_000:
                                yield pa.RecordBatch.from_arrays([pa.array(v) for v in held[0]], ["query", "class", "score"])
                                held, count = [], 0
        if held:
            yield pa.RecordBatch.from_arrays([pa.array(v) for v in _best(*map(np.concatenate, zip(*held)), n)], ["query", "class", "score"])

    return run


def _shape(vectors: np.ndarray, n: int, largest: float, dim: int, seed: int) -> Index:
    """So many hashes that two vectors of the sample share a bucket about as often as BUCKET / n."""
    rng = np.random.default_rng(seed)
    most = 40
    index = Index(dim, largest, rng.normal(0, 1, (TABLES, dim + 1, most)), rng.uniform(0, 1, (TABLES, most)), rng.integers(0, 1 << 63, most, dtype=np.uint64) * np.uint64(2) + np.uint64(1))
    cells = np.floor(index.cells(vectors, False))[0]
    pairs = rng.integers(0, len(vectors), (20_000, 2))
    agree = (cells[pairs[:, 0]] == cells[pairs[:, 1]])[pairs[:, 0] != pairs[:, 1]]
    share = float(agree.mean()) if len(agree) else 0.5
    k = 1 if n <= BUCKET else int(np.clip(np.ceil(np.log(BUCKET / n) / np.log(min(max(share, 0.05), 0.95))), 1, most))
    return Index(dim, largest, index.projections[:, :, :k], index.offsets[:, :k], index.mixers[:k])


def _visits(index: Index, queries: np.ndarray, found: list[np.ndarray]) -> int:
    """The fewest probes of a table by which AIM of the known neighbours (vectors of each query) are met."""
    most, need = 64, sum(len(f) for f in found)
    if not need:
        return 1
    while True:
        first = np.full(need, np.inf)
        at = np.cumsum([0] + [len(f) for f in found])
        targets = [np.stack([index.keys(t, c) for t, c in enumerate(np.floor(index.cells(f, False)))]) if len(f) else np.empty((TABLES, 0), np.int64) for f in found]
        for t, i, keys in _probes(index, queries, most):
            if len(found[i]):
                hit = targets[i][t][None, :] == keys[:, None]
                when = np.where(hit.any(0), hit.argmax(0) + 1.0, np.inf)
                first[at[i] : at[i + 1]] = np.minimum(first[at[i] : at[i + 1]], when)
        wanted = np.sort(first)[int(np.ceil(AIM * need)) - 1]
        if np.isfinite(wanted):
            return int(wanted)
        most *= 4


def search(vectors: DataFrame, asked, vec_id: str = "vec_id", vector: str = "embedding", n: int = 20, seed: int = 7) -> DataFrame:
    """(query_id, rank, vec_id, score): the n nearest found of every row for which the column expression `asked` holds.

    Nearest: largest inner product of the original vectors in double precision, ties to the smaller vec_id; a query is not
    its own neighbour, nor are rows of its id. Null or zero vectors, and those with null or non-finite components, take no
    part, nor do null ids; a shorter vector counts as filled up with zeros. Of several rows with one id, the smallest vector
    counts. Equal vectors are one
    entry of the index, with the n + 1 smallest of their ids, which is all that a list of n can need; so a vector that a
    third of the rows share is one entry. No valid row: no rows.
    """
    spark = vectors.sparkSession
    rows = vectors.select(col(vec_id).cast("long").alias("id"), F.transform(col(vector), lambda x: x.cast("double")).alias("v"), asked.alias("asked"))
    fine = F.col("v").isNotNull() & (F.size("v") > 0) & F.forall("v", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf"))) & F.exists("v", lambda x: x != 0)
    rows = rows.where(F.col("id").isNotNull() & fine).groupBy("id").agg(F.min("v").alias("v"), F.bool_or("asked").alias("asked"))
    rows = materialise(rows)
    facts = rows.agg(F.count("*").alias("n"), F.max(F.size("v")).alias("dim"), F.max(F.array_max(F.transform("v", F.abs))).alias("most")).first()
    empty = spark.createDataFrame([], "query_id long, rank int, vec_id long, score double")
    if not facts["n"]:
        return empty
    dim, most = facts["dim"], facts["most"]  # lengths in units of the largest component: no square overflows
    length = F.sqrt(F.aggregate("v", F.lit(0.0), lambda a, x: a + (x / most) * (x / most)))
    largest = rows.agg(F.max(length).alias("longest")).first()["longest"] * most
    few = rows.withColumn("k", F.row_number().over(Window.partitionBy("v").orderBy("id"))).where(F.col("k") <= n + 1)
    packed = few.groupBy("v").agg(F.min("id").alias("class"), F.sort_array(F.collect_list("id")).alias("ids")).select("class", "v", "ids")
    classes = materialise(arrow(packed, _packed(dim), "class long, vector binary, ids array<long>"))
    queries = materialise(rows.where("asked").select("id", "v").join(packed.select("v", "class"), "v").select("id", "class"))
    asking = queries.select("class").distinct()
    query_classes = classes.join(asking, "class", "left_semi").select("class", "vector")
    total = classes.count()

    shape = classes.orderBy(F.hash("class"), "class").limit(SHAPE).select("vector").collect()
    index = _shape(np.stack([np.frombuffer(r["vector"], "<f8") for r in shape]), total, largest, dim, seed)
    sample = query_classes.orderBy(F.hash("class"), "class").limit(SAMPLE).collect()
    if not sample:
        return empty
    asked_vectors = np.stack([np.frombuffer(r["vector"], "<f8") for r in sample])
    names = np.array([r["class"] for r in sample], np.int64)
    shared = spark.sparkContext.broadcast((names, asked_vectors))
    best = Window.partitionBy("query").orderBy(F.desc("score"), "class")
    known = arrow(classes.select("class", "vector"), _exact(shared, dim, n + 1), _FOUND).withColumn("k", F.row_number().over(best)).where(F.col("k") <= n + 1)
    known = known.where("query <> class").join(classes.select("class", "vector"), "class").select("query", "vector").collect()  # SAMPLE * (n + 1) at most
    found = {int(q): [] for q in names}
    for r in known:
        found[r["query"]].append(np.frombuffer(r["vector"], "<f8"))
    index.probes = _visits(index, asked_vectors, [np.array(found[int(q)]).reshape(-1, dim) for q in names])

    schema = "bucket long, asks boolean, class long, vector binary"
    stored = arrow(classes.select("class", "vector"), _hashed(index, False), schema)
    visits = arrow(query_classes, _hashed(index, True), schema)
    hot = materialise(stored.groupBy("bucket").agg(F.count("*").alias("n")).where(F.col("n") > HOT).select("bucket", F.ceil(F.col("n") / HOT).cast("int").alias("salts")))
    dealt = stored.join(hot, "bucket", "left").withColumn("salt", F.pmod(F.hash("class"), F.coalesce("salts", F.lit(1))))
    copied = visits.join(hot, "bucket", "left").withColumn("salt", F.explode(F.sequence(F.lit(0), F.coalesce("salts", F.lit(1)) - 1)))
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    together = dealt.select("bucket", "salt", "asks", "class", "vector").unionByName(copied.select("bucket", "salt", "asks", "class", "vector"))
    together = together.repartition(parts, "bucket", "salt").sortWithinPartitions("bucket", "salt", "asks")
    pairs = arrow(together, _searched(dim, n + 1), _FOUND)
    own = query_classes.select(F.col("class").alias("query"), "class", "vector")
    own = arrow(own, _self(dim), _FOUND)
    pairs = pairs.unionByName(own).groupBy("query", "class").agg(F.max("score").alias("score"))
    top = pairs.withColumn("k", F.row_number().over(best)).where(F.col("k") <= n + 1)
    by_id = Window.partitionBy("query").orderBy(F.desc("score"), "vec_id")
    lists = top.join(classes.select("class", "ids"), "class").select("query", "score", F.explode("ids").alias("vec_id"))
    lists = lists.withColumn("k", F.row_number().over(by_id)).where(F.col("k") <= 2 * n + 2).drop("k")
    out = queries.withColumnRenamed("class", "query").withColumnRenamed("id", "query_id").join(lists, "query").where("query_id <> vec_id")
    out = out.groupBy("query_id", "vec_id").agg(F.max("score").alias("score"))
    rank = F.row_number().over(Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id"))
    return out.withColumn("rank", rank).where(F.col("rank") <= n).select("query_id", "rank", "vec_id", "score")


def _self(dim: int):
    def run(batches):
        for batch in batches:
            x = _matrix(batch.column(2), dim)
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array((x * x).sum(1), pa.float64())], ["query", "class", "score"])

    return run

"""Packing of token streams into sequences of one length, with the sources mixed in fixed proportions.

Every source is a queue of documents. A deficit round robin serves the queues: each token of credit goes to the queue whose
credit is due first, so that after any number of sequences each queue has had its share to within a token. What a queue is
short of, its deficit, is the difference between its credit and what it was served. Both depend on the count of tokens
served alone, so a task can begin at any sequence with the deficits that all earlier sequences, wherever they are made,
leave behind: deficits are carried across sequences and partitions without one task handing them to the next.
"""

from __future__ import annotations

import re
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from marquee.llm.base import arrow, named, pieces, texts
from marquee.llm.bpe import vocabulary_path
from marquee.session import materialise

#: Ids in a sequence.
LENGTH = 4096
#: Id that ends a document.
END = 2
#: Up to so many sources, every task works out the shares of all of them in each sequence; with more, it knows only where
#: sequences begin in the mixed stream. The result is the same.
QUEUES = 256
#: Tokens that a task puts in order at a time to find where sequences begin.
ORDERED = 1 << 20
#: Encoded chunks a worker remembers; when full, it starts again with none.
REMEMBERED = 400_000


@lru_cache(maxsize=2)
def _tokenizer(path: str):
    import os

    from tokenizers import Tokenizer

    os.environ["TOKENIZERS_PARALLELISM"] = "false"  # the cores are Spark's
    tokenizer = Tokenizer.from_file(path)
    tokenizer.no_truncation()
    tokenizer.no_padding()
    special = next(((s, i) for s, i in ((t.content, i) for i, t in tokenizer.get_added_tokens_decoder().items() if t.special)), None)
    return tokenizer, special


@lru_cache(maxsize=2)
def _known(path: str) -> dict[bytes, bytes]:
    return {}


def _learn(path: str, chunks: list[bytes], known: dict[bytes, bytes]) -> None:
    """Ids of chunks between white space, many to a call of the library: a special string between them marks their ends."""
    tokenizer, special = _tokenizer(path)
    plain, odd = [], []
    for c in chunks:
        (odd if special is None or b"<|" in c or b"|>" in c else plain).append(c)
    for c, e in zip(odd, tokenizer.encode_batch_fast([c.decode() for c in odd], add_special_tokens=False)):
        known[c] = np.array(e.ids, "<u4").tobytes()
    step = 200
    joined = [special[0].join([c.decode() for c in plain[i : i + step]]) for i in range(0, len(plain), step)]
    for k, e in enumerate(tokenizer.encode_batch_fast(joined, add_special_tokens=False)):
        ids = np.array(e.ids, "<u4")
        raw, begin = ids.tobytes(), 0
        own = plain[k * step : (k + 1) * step]
        for c, at in zip(own, [*np.flatnonzero(ids == special[1]).tolist(), len(ids)], strict=True):
            known[c] = raw[4 * begin : 4 * at]
            begin = at + 1


_STOPS = re.compile(rb"(?<=[a-z0-9])([.,])(?=[ \t\n\x0b\f\r]|$)")


def _chunks(text: bytes) -> list[bytes]:
    """Chunks that the library encodes one by one as it would together. It puts letters in lower case itself, and begins
    a new pre-token where a full stop or a comma follows a letter or digit, so those are taken off words: far fewer
    different chunks are left to encode. Special strings are matched before that, so a text with their mark is only split."""
    if b"<|" in text:
        return text.split()
    return _STOPS.sub(rb" \1", text.lower()).split()


def _tokens(path: str, end: int):
    def run(batches):
        from pyspark import TaskContext

        part, before, known = TaskContext.get().partitionId(), {}, _known(path)
        tail = np.array([end], "<u4").tobytes()
        for whole in batches:
            for batch in pieces(whole, 1):
                chunks = [_chunks(t or b"") for t in texts(batch.column(1))]
                new = {c for own in chunks for c in own if c not in known}
                if new:
                    if len(known) + len(new) > REMEMBERED:
                        known.clear()
                        new = {c for own in chunks for c in own}
                    _learn(path, list(new), known)
                counts, starts, ids = [], [], []
                for own, source in zip(chunks, batch.column(2).to_pylist()):
                    raw = b"".join(map(known.__getitem__, own)) + tail
                    n = len(raw) // 4
                    counts.append(n)
                    starts.append(before.get(source, 0))
                    before[source] = starts[-1] + n
                    a = np.frombuffer(raw, "<u4")
                    ids.append(a.astype("<u2").tobytes() if a.max() < 1 << 16 else raw)
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0), batch.column(2), pa.array([part] * len(chunks), pa.int32()), pa.array(counts, pa.int64()), pa.array(starts, pa.int64()), pa.array(ids, pa.binary())],
                    ["doc_id", "source", "part", "n", "before", "ids"],
                )

    return run


class Mixture:
    """How many tokens of each queue lie among the first so many of the mixed stream.

    Token i of queue q is due at (i + 1/2) / rate[q]; equal dues go in queue order. `totals`: tokens of each queue."""

    def __init__(self, totals: list[int], rates: list[float]):
        self.totals = np.array(totals, np.longdouble)
        self.rates = np.array(rates, np.longdouble)
        self.all = int(sum(totals))
        self.last = float(np.max(self.totals / self.rates)) + 1 if len(totals) else 1.0

    def _at(self, due: np.ndarray) -> np.ndarray:
        return np.minimum(self.totals, np.floor(due[:, None] * self.rates + 0.5))

    def before(self, queue: np.ndarray, i: np.ndarray) -> np.ndarray:
        """About how many tokens of all queues come before token i of a queue; exact to a few."""
        return self._at((i + np.longdouble(0.5)) / self.rates[queue]).sum(1).astype(np.int64)

    def served(self, n: np.ndarray) -> np.ndarray:
        """For each count n of tokens, those of each queue."""
        n = np.clip(n, 0, self.all).astype(np.longdouble)
        low, high = np.zeros(len(n), np.longdouble), np.full(len(n), self.last, np.longdouble)
        for _ in range(66):
            middle = (low + high) / 2
            enough = self._at(middle).sum(1) >= n
            high, low = np.where(enough, middle, high), np.where(enough, low, middle)
        low[n == 0] = 0
        below, above = self._at(low), self._at(high)
        gain = above - below
        room = np.clip((n - below.sum(1))[:, None] - (np.cumsum(gain, 1) - gain), 0, gain)
        return (below + room).astype(np.int64)


def _layout(totals: list[int], rates: list[float], length: int, content: bool):
    def run(batches):
        from zlib import crc32

        mixture = Mixture(totals, rates)
        for whole in batches:
            for batch in pieces(whole, 4):
                queue, place, n = (batch.column(k).to_numpy(zero_copy_only=False) for k in (1, 2, 3))
                low = np.maximum(mixture.before(queue, place) // length - 2, 0)
                high = mixture.before(queue, place + n - 1) // length + 4
                wanted = np.unique(np.concatenate([np.arange(x, y) for x, y in set(zip(low.tolist(), high.tolist()))]))
                edges = mixture.served(wanted * length)
                begin = np.searchsorted(wanted, low).tolist()
                offsets = np.zeros_like(edges[1:])
                offsets[:, 1:] = np.cumsum(np.diff(edges, axis=0), 1)[:, :-1]
                doc, start, size, crc, sequence, offset, ids = [], [], [], [], [], [], []
                for d, (q, p, m, raw) in enumerate(zip(queue.tolist(), place.tolist(), n.tolist(), batch.column(4).to_pylist())):
                    a = np.frombuffer(raw, "<u2" if len(raw) == 2 * m else "<u4").astype("<u4")
                    w, at = begin[d], p
                    while at < p + m:
                        stop = min(int(edges[w + 1, q]), p + m)
                        if stop > at:
                            cut = a[at - p : stop - p].tobytes()
                            doc.append(d)
                            start.append(at - p)
                            size.append(stop - at)
                            crc.append(crc32(cut))
                            sequence.append(int(wanted[w]))
                            offset.append(int(offsets[w, q]) + at - int(edges[w, q]))
                            if content:
                                ids.append(cut)
                            at = stop
                        w += 1
                take = pa.array(doc, pa.int64())
                out = [batch.column(0).take(take), *(pa.array(x, pa.int64()) for x in (start, size, crc)), batch.column(3).take(take), pa.array(sequence, pa.int64()), pa.array(offset, pa.int64()), batch.column(5).take(take)]
                names = ["doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset", "source"]
                yield pa.RecordBatch.from_arrays(out + [pa.array(ids, pa.binary())] * content, names + ["ids"] * content)

    return run


def _begins(mixture, length: int, step: int):
    """The first token of each sequence but sequence 0, as its queue and its index there; `step` sequences for each row."""

    def run(batches):
        totals, rates = mixture.value
        mixed = Mixture(totals, rates)
        for batch in batches:
            for k in batch.column(0).to_pylist():
                wanted = np.arange(k * step + 1, (k + 1) * step + 1) * length
                wanted = wanted[wanted < mixed.all]
                if not len(wanted):
                    continue
                # a token more on either side, so that rounding of the bounds does not matter
                low = np.maximum(mixed.served(wanted[:1])[0] - 1, 0)
                high = np.minimum(mixed.served(wanted[-1:] + 1)[0] + 1, np.asarray(totals))
                n = high - low
                queue = np.repeat(np.arange(len(n)), n)
                i = np.arange(len(queue)) - np.repeat(np.cumsum(n) - n, n) + low[queue]
                order = np.lexsort((queue, (i + np.longdouble(0.5)) / mixed.rates[queue]))[wanted - int(low.sum())]
                yield pa.RecordBatch.from_arrays([pa.array(wanted // length), pa.array(queue[order]), pa.array(i[order])], ["sequence", "queue", "i"])

    return run


def _sequences(dues: np.ndarray, queues: np.ndarray, due: np.ndarray, queue: int) -> np.ndarray:
    """Sequence of each token of a queue: how many of the first tokens (`dues`, `queues`) do not come after it."""
    low, high = np.searchsorted(dues, due, "left"), np.searchsorted(dues, due, "right")
    while (at := np.flatnonzero(low < high)).size:  # equal dues
        middle = (low[at] + high[at]) // 2
        passed = queues[middle] <= queue
        low[at], high[at] = np.where(passed, middle + 1, low[at]), np.where(passed, high[at], middle)
    return low


def _dealt(begins, content: bool):
    def run(batches):
        from zlib import crc32

        dues, queues = begins.value
        for whole in batches:
            for batch in pieces(whole, 4):
                doc, out, ids = [], [[] for _ in range(5)], []
                for d, (q, p, m, raw, rate) in enumerate(zip(*(batch.column(k).to_pylist() for k in (1, 2, 3, 4, 6)))):
                    a = np.frombuffer(raw, "<u2" if len(raw) == 2 * m else "<u4").astype("<u4")
                    sequence = _sequences(dues, queues, (np.arange(p, p + m) + np.longdouble(0.5)) / np.longdouble(rate), q)
                    edges = [0, *(np.flatnonzero(np.diff(sequence)) + 1).tolist(), m]
                    for x, y in zip(edges, edges[1:]):
                        cut = a[x:y].tobytes()
                        doc.append(d)
                        for o, v in zip(out, (x, y - x, crc32(cut), int(sequence[x]), p + x)):
                            o.append(v)
                        if content:
                            ids.append(cut)
                take = pa.array(doc, pa.int64())
                start, size, crc, sequence, place = (pa.array(x, pa.int64()) for x in out)
                arrays = [batch.column(0).take(take), start, size, crc, batch.column(3).take(take), sequence, batch.column(5).take(take), batch.column(1).take(take), place]
                names = ["doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "source", "queue", "place"]
                yield pa.RecordBatch.from_arrays(arrays + [pa.array(ids, pa.binary())] * content, names + ["ids"] * content)

    return run


def _numbered(by_source: DataFrame, weights: dict[str, float] | None) -> DataFrame:
    """(s, n, at, rate) of every source, numbered from the one with the most tokens; none of it passes through the driver
    but the rows of each partition."""
    spark = by_source.sparkSession
    rated = by_source.withColumn("rate", F.col("n").cast("double"))
    if weights is not None:
        given = spark.createDataFrame([(s, float(w)) for s, w in weights.items()], "w string, weight double")
        rated = by_source.join(given, F.col("source").eqNullSafe(F.col("w")), "left").withColumn("rate", F.coalesce("weight", F.lit(1.0)))
    ordered = rated.orderBy(F.desc("n"), F.asc_nulls_first("source")).select(F.col("source").alias("s"), "n", "rate", F.monotonically_increasing_id().alias("id"))
    ordered = materialise(ordered.select("*", F.shiftright("id", 33).alias("slot")))
    sizes = sorted(tuple(r) for r in ordered.groupBy("slot").count().collect())
    bases = [(slot, sum(n for _, n in sizes[:k])) for k, (slot, _) in enumerate(sizes)]
    bases = spark.createDataFrame(bases, "slot long, base long")
    return ordered.join(F.broadcast(bases), "slot").select("s", "n", (F.col("base") + F.col("id") - F.shiftleft("slot", 33)).alias("at"), "rate")


def pack(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", source: str = "source", path: str | None = None, length: int = LENGTH, end: int = END, weights: dict[str, float] | None = None, content: bool = True) -> DataFrame:
    """Pieces of documents, each with its sequence and its place there; `content` adds the ids (unsigned 32 bit, little-endian).

    A document's ids are the library's, then `end`; a null or empty text is `end` alone. All sequences are full but the
    last. `weights` are rates of sources (1 where none is given); by default a source's rate is its number of tokens, so
    all queues end together. When a queue is empty the others share its place in proportion. A null source is a source.
    Repeated rows and null ids are packed like any others; other columns are not read. No rows: no pieces.

    One pass writes ids to the shared folder; the counts by source and input part, which are few, give each document its
    place in its queue; a second pass cuts. A source with a third of all rows is spread over as many tasks as its rows were
    read by. Within a queue, documents keep the order in which the rows are read. Every source has a queue of its own. With
    more than QUEUES of them, tasks hold two numbers for each source to find the first token of every sequence, then those
    tokens; a place in a sequence comes from a shuffle of the pieces by sequence.
    """
    spark = docs.sparkSession
    rows = named(docs, doc_id=doc_id, text=text, source=source).select(F.col("doc_id").cast("long").alias("doc_id"), "text", F.col("source").cast("string").alias("source"))
    stored = materialise(arrow(rows, _tokens(path or vocabulary_path(), end), "doc_id long, source string, part int, n long, before long, ids binary"))
    counted = materialise(stored.groupBy("source", "part").agg(F.sum("n").alias("n")))
    by_source = counted.groupBy("source").agg(F.sum("n").alias("n"))
    first = by_source.orderBy(F.desc("n"), F.asc_nulls_first("source")).limit(QUEUES + 1).collect()  # QUEUES + 1 rows at most
    few = len(first) <= QUEUES
    if few:
        rates = [float(r["n"]) if weights is None else float(weights.get(r["source"], 1.0)) for r in first]
        queues = F.broadcast(spark.createDataFrame([(r["source"], i, x) for i, (r, x) in enumerate(zip(first, rates))], "s string, at long, rate double"))
    else:
        queues = materialise(_numbered(by_source, weights))
    begun = Window.partitionBy("source").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = counted.withColumn("base", F.coalesce(F.sum("n").over(begun), F.lit(0))).drop("n").join(queues, F.col("source").eqNullSafe(F.col("s")))
    offsets = offsets.select("s", F.col("part").alias("p"), "at", "base", "rate")
    placed = stored.join(offsets, F.col("source").eqNullSafe(F.col("s")) & (F.col("part") == F.col("p")))
    placed = placed.select("doc_id", "at", (F.col("base") + F.col("before")).alias("place"), "n", "ids", "source", "rate")
    schema = "doc_id long, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long, source string" + ", ids binary" * content
    if few:
        return arrow(placed.drop("rate"), _layout([r["n"] for r in first], rates, length, content), schema)
    table = queues.select("at", "n", "rate").orderBy("at").toArrow()  # a row for each source
    totals, rates = table["n"].to_numpy(), table["rate"].to_numpy()
    step = max(1, ORDERED // length)
    ranges = spark.range(int(totals.sum()) // (length * step) + 1)
    found = arrow(ranges, _begins(spark.sparkContext.broadcast((totals, rates)), length, step), "sequence long, queue long, i long").toArrow().sort_by("sequence")
    queue = found["queue"].to_numpy()
    begins = spark.sparkContext.broadcast(((found["i"].to_numpy() + np.longdouble(0.5)) / rates.astype(np.longdouble)[queue], queue))
    pieced = arrow(placed, _dealt(begins, content), schema.replace("offset long, source string", "source string, queue long, place long"))
    inside = Window.partitionBy("sequence_id").orderBy("queue", "place").rowsBetween(Window.unboundedPreceding, -1)
    pieced = pieced.withColumn("offset", F.coalesce(F.sum("length").over(inside), F.lit(0)))
    return pieced.select(*[f.split()[0] for f in schema.split(", ")])

"""Repeated passages, by a parse of every document against the corpus before it (relative Lempel-Ziv).

The reference is the corpus in the order of its ids. Its index is cut into blocks by fingerprint, and each window of words
is looked up in the block that would hold it, so a document is parsed against every block without visiting them all. A
factor is a run of words copied from one earlier place; the parse takes factors greedily from left to right, each as long as
its windows' first places stay consecutive. Windows that cross from one factor into the next are looked up as well, so what
is found does not depend on where the parse cuts.

Only windows that can have a twin are indexed: a window's anchor is the least fingerprint among its eight-word runs, equal
windows have equal anchors, and one in seven runs or so is an anchor. Anchors are counted first; a window is looked up only
if its anchor stands in two texts, or twice in its own.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from marquee.llm.base import arrow, col, pieces, texts
from marquee.llm.words import Words, groups, runs
from marquee.session import discard, materialise

#: Words of a window, and of the runs that anchors are chosen from.
WINDOW = 20
ANCHOR = 8
#: Windows that a task of the index sorts at a time; a group of equal anchors is never cut.
CHUNK = 1_000_000

_LAST = (1 << 63) - 1


def _windows(words: Words, window: int, anchor: int):
    """Of all windows of a group of texts: fingerprint, anchor, index of the first word."""
    hashes = words.hashes()
    h, at = runs(hashes, words.first, window, seed=5)
    if not len(at):
        return h, h, at
    g, g_at = runs(hashes, np.array([0, len(hashes)]), anchor, seed=6)  # across texts; windows below stay inside theirs
    wide, least = window - anchor + 1, g
    size = 1
    while 2 * size <= wide:
        least = np.minimum(least[:-size], least[size:])
        size *= 2
    if size < wide:
        least = np.minimum(least[: len(least) - (wide - size)], least[wide - size :])
    return h, least[at], at


def _anchors(window: int, anchor: int):
    def run(batches):
        for whole in batches:
            for batch in pieces(whole, 2):
                raw = [t or b"" for t in texts(batch.column(2))]
                counts, own, lists, sizes = [], [], [], [0]
                for a, b in groups(raw):
                    words = Words(raw[a:b])
                    h, g, at = _windows(words, window, anchor)
                    cut = np.searchsorted(at, words.first)
                    for i in range(b - a):
                        x, y = cut[i], cut[i + 1]
                        values = np.unique(g[x:y])
                        lists.append(values.view(np.int64))
                        sizes.append(sizes[-1] + len(values))
                        own.append(len(np.unique(h[x:y])) < y - x)
                    counts.extend(words.counts().tolist())
                anchors = pa.ListArray.from_arrays(pa.array(sizes, pa.int32()), pa.array(np.concatenate(lists) if lists else np.empty(0, np.int64)))
                digests = [hashlib.md5(t).digest() for t in raw]
                yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(digests, pa.binary()), pa.array(counts, pa.int64()), pa.array(own, pa.bool_()), anchors], ["row", "id", "digest", "n", "own", "anchors"])

    return run


def _first_of(keys: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """Sorted order by `keys` (the last two name what is equal) and for each place in it the place of the first equal one."""
    order = np.lexsort(keys)
    a, b = keys[-1][order], keys[-2][order]
    new = np.ones(len(order), bool)
    new[1:] = (a[1:] != a[:-1]) | (b[1:] != b[:-1])
    first = np.maximum.accumulate(np.where(new, np.arange(len(order)), 0))
    return order, first


def _stretches(*equal: np.ndarray, steps: tuple[np.ndarray, ...] = ()) -> tuple[np.ndarray, np.ndarray]:
    """Begins and ends of the stretches in which the arrays `equal` stay equal and the arrays `steps` grow by one."""
    n = len((equal or steps)[0])
    new = np.ones(n, bool)
    same = np.ones(max(n - 1, 0), bool)
    for x in equal:
        same &= x[1:] == x[:-1]
    for x in steps:
        same &= x[1:] == x[:-1] + 1
    new[1:] = ~same
    begin = np.flatnonzero(new)
    return begin, np.append(begin[1:], n)


_FOUND = "block long, id long, row long, start long, hashes array<long>, words long, source_id long, source_row long, source_start long"


def _found(block, ids, rows, starts, sizes, hashes, words, source_id, source_row, source_start):
    lists = pa.ListArray.from_arrays(pa.array(np.append(0, np.cumsum(sizes)), pa.int32()), pa.array(hashes.view(np.int64), pa.int64()))
    arrays = [pa.array(x.astype(np.int64), pa.int64()) for x in (block.view(np.int64), ids, rows, starts)] + [lists]
    arrays += [pa.array(x.astype(np.int64), pa.int64()) for x in (words, source_id, source_row, source_start)]
    return pa.RecordBatch.from_arrays(arrays, [f.split()[0] for f in _FOUND.split(", ")])


def _factors(h, g, ids, rows, at, window):
    """Greedy factors among windows in document order, and which windows have no earlier one here."""
    order, first = _first_of([at, rows, ids, g, h])
    source = np.empty(len(order), np.int64)
    source[order] = order[first]
    copied = source != np.arange(len(order))
    where = np.flatnonzero(copied)
    begin, end = _stretches(rows[where], rows[source[where]], steps=(at[where], at[source[where]])) if len(where) else (where, where)
    heads = where[begin] if len(where) else where
    return ~copied, heads, (end - begin) + window - 1, source[heads]


def _lookups(column: int, row: int, rank: int, repeated: int, window: int, anchor: int):
    """Windows that may have a twin: factors whose source is in the same piece, and the others in stretches of one anchor."""

    def run(batches):
        none = np.empty(0, np.int64)
        for whole in batches:
            for batch in pieces(whole, column):
                raw = [t or b"" for t in texts(batch.column(column))]
                ids, rows = (batch.column(k).to_numpy(zero_copy_only=False) for k in (rank, row))
                twins = batch.column(repeated)
                parts: list[list[np.ndarray]] = [[] for _ in range(5)]
                for a, b in groups(raw):
                    words = Words(raw[a:b])
                    h, g, at = _windows(words, window, anchor)
                    cut = np.searchsorted(at, words.first)
                    for i in range(b - a):
                        x, y = cut[i], cut[i + 1]
                        if x == y:
                            continue
                        known = np.array(twins[a + i].as_py() or [], np.int64).view(np.uint64)
                        use = np.isin(g[x:y], known)
                        _, which, n = np.unique(h[x:y], return_inverse=True, return_counts=True)
                        use = np.flatnonzero(use | (n[which] > 1)) + x
                        for p, v in zip(parts, (h[use], g[use], np.full(len(use), ids[a + i]), np.full(len(use), rows[a + i]), at[use] - words.first[i])):
                            p.append(v)
                if not parts[0]:
                    continue
                h, g, doc, own, at = (np.concatenate(p) for p in parts)
                if not len(h):
                    continue
                fresh_, heads, length, source = _factors(h, g, doc, own, at, window)
                yield _found(own[heads].astype(np.uint64), doc[heads], own[heads], at[heads], np.zeros(len(heads), np.int64), np.empty(0, np.uint64), length, doc[source], own[source], at[source])
                k = np.flatnonzero(fresh_)
                begin, end = _stretches(own[k], g[k], steps=(at[k],)) if len(k) else (none, none)
                first = k[begin] if len(k) else none
                zero = np.zeros(len(first), np.int64)
                yield _found(g[first], doc[first], own[first], at[first], end - begin, h[k], zero, zero, zero, zero)

    return run


def _parse(window: int):
    """Factors from the records of some blocks, which come sorted by block."""

    def parsed(records: list[pa.Table]):
        table = pa.concat_tables(records).combine_chunks()
        whole = table.filter(pa.compute.greater(table["words"], 0))
        if len(whole):
            yield from whole.select(["row", "start", "words", "source_id", "source_row", "source_start"]).to_batches()
        rest = table.filter(pa.compute.equal(table["words"], 0))
        if not len(rest):
            return
        block, ids, rows, starts = (rest[c].to_numpy() for c in ("block", "id", "row", "start"))
        sizes = pa.compute.list_value_length(rest["hashes"]).to_numpy()
        h = pa.compute.list_flatten(rest["hashes"]).to_numpy()
        spread = lambda x: np.repeat(x, sizes)
        at = np.arange(len(h)) - spread(np.cumsum(sizes) - sizes) + spread(starts)
        g, ids, rows = spread(block), spread(ids), spread(rows)
        _, heads, length, source = _factors(h, g, ids, rows, at, window)
        yield pa.RecordBatch.from_arrays([pa.array(x.astype(np.int64)) for x in (rows[heads], at[heads], length, ids[source], rows[source], at[source])], ["row", "start", "words", "source_id", "source_row", "source_start"])

    def run(batches):
        import pyarrow.compute  # noqa: F401

        held, n = [], 0
        for batch in batches:
            table = pa.Table.from_batches([batch])
            blocks = table["block"].to_numpy()
            n += int(pa.compute.sum(pa.compute.list_value_length(table["hashes"])).as_py() or 0)
            if n >= CHUNK and len(blocks):
                last = int(np.searchsorted(blocks, blocks[-1], "left"))  # the last block may go on in the next batch
                if last or (held and held[-1]["block"][-1].as_py() != blocks[0]):
                    yield from parsed(held + [table.slice(0, last)] if last else held)
                    table = table.slice(last)
                    held, n = [], int(pa.compute.sum(pa.compute.list_value_length(table["hashes"])).as_py() or 0)
            held.append(table)
        if held:
            yield from parsed(held)

    return run


def factors(keyed: DataFrame, window: int = WINDOW, anchor: int = ANCHOR) -> DataFrame:
    """(row, start, words, source_id, source_row, source_start): runs of `words` words that stand earlier too.

    `keyed`: row, id, text, then any columns. Equal texts are one factor of the first of them, if long enough to have one."""
    return _factors_and_scratch(keyed, window, anchor)[0]


def _factors_and_scratch(keyed: DataFrame, window: int, anchor: int = ANCHOR) -> tuple[DataFrame, list[DataFrame]]:
    """`factors`, and the tables that only they read."""
    rank = F.struct(F.col("id"), F.col("row"))
    seen = materialise(arrow(keyed.select("row", "id", "text"), _anchors(window, anchor), "row long, id long, digest binary, n long, own boolean, anchors array<long>"))
    heads = materialise(seen.where(F.col("n") >= window).groupBy("digest").agg(F.min(rank).alias("first")))
    copies = seen.where(F.col("n") >= window).join(heads, "digest").where("row <> first.row")
    copies = copies.select("row", F.lit(0).cast("long").alias("start"), F.col("n").alias("words"), F.col("first.id").alias("source_id"), F.col("first.row").alias("source_row"), F.lit(0).cast("long").alias("source_start"))
    texts_once = seen.join(heads.select(F.col("first.row").alias("row")), "row", "left_semi")
    each = texts_once.select("row", F.explode("anchors").alias("anchor"))
    twice = each.groupBy("anchor").agg(F.count("*").alias("n")).where("n > 1").select("anchor")
    shared = each.join(twice, "anchor", "left_semi").groupBy("row").agg(F.collect_list("anchor").alias("_twins"))
    alone = texts_once.where("own").select("row")
    todo = materialise(alone.join(shared, "row", "full_outer").select("row", "_twins"))
    rows = keyed.join(todo, "row")
    at = {c: i for i, c in enumerate(rows.columns)}
    found = arrow(rows, _lookups(at["text"], at["row"], at["id"], at["_twins"], window, anchor), _FOUND)
    parts = int(keyed.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    indexed = found.repartition(parts, "block").sortWithinPartitions("block")
    parsed = arrow(indexed, _parse(window), "row long, start long, words long, source_id long, source_row long, source_start long")
    return parsed.unionByName(copies), [seen, heads, todo]


def _keep(text: int, spans: int, keep: list[int], digest: bool):
    def run(batches):
        for batch in batches:
            out, sizes, gone, digests = [], [], [], []
            for raw, own in zip(texts(batch.column(text)), batch.column(spans).to_pylist()):
                if not own:
                    if digest:
                        words = (raw or b"").split()
                        sizes.append(len(words))
                        gone.append(0)
                        digests.append(hashlib.sha256(b" ".join(words)).hexdigest())
                    out.append(raw)
                    continue
                words = Words([raw])
                n = len(words.starts)
                cover = np.zeros(n + 1, np.int64)
                for span in own:
                    cover[span["start"]] += 1
                    cover[min(n, span["start"] + span["words"])] -= 1
                kept = np.cumsum(cover[:-1]) == 0
                begin, end = _stretches(kept) if n else (np.empty(0, np.int64),) * 2
                ends = np.append(words.starts, len(raw))
                out.append(b"".join([raw[words.starts[a] : ends[b]] for a, b in zip(begin, end) if kept[a]]))
                if digest:
                    sizes.append(n)
                    gone.append(int(n - kept.sum()))
                    digests.append(hashlib.sha256(b" ".join([w for w, k in zip(raw.split(), kept) if k])).hexdigest())
            columns = [pa.array(out, pa.binary()).cast(pa.string()) if i == text else batch.column(i) for i in keep]
            names = [batch.schema.names[i] for i in keep]
            if digest:
                columns += [pa.array(sizes, pa.int64()), pa.array(gone, pa.int64()), pa.array(digests, pa.string())]
                names += ["n_words", "n_removed", "kept_sha256"]
            yield pa.RecordBatch.from_arrays(columns, names)

    return run


def _applied(docs: DataFrame, doc_id: str, text: str, window: int, digest: bool) -> DataFrame:
    others = [c for c in docs.columns if c not in (text,)] if not digest else []
    names = [f"c{i}" for i in range(len(others))]  # no name clashes while they are carried along
    keyed = docs.select(F.monotonically_increasing_id().alias("row"), F.coalesce(col(doc_id).cast("long"), F.lit(_LAST)).alias("id"), col(text).alias("text"), col(doc_id).cast("long").alias("doc_id"), *[col(c).alias(n) for c, n in zip(others, names)])
    keyed = materialise(keyed)  # numbers taken anew by each job would change with the executors
    found, scratch = _factors_and_scratch(keyed, window)
    spans = materialise(found.groupBy("row").agg(F.collect_list(F.struct("start", "words")).alias("spans")))
    for used in scratch:
        discard(used)
    joined = keyed.join(spans, "row", "left")
    at = {c: i for i, c in enumerate(joined.columns)}
    keep = [at["doc_id"]] if digest else [at["text"], *(at[n] for n in names)]
    kinds = {f.name: f.dataType for f in joined.schema.fields}
    schema = T.StructType([T.StructField(joined.columns[i], kinds[joined.columns[i]]) for i in keep])
    if digest:
        schema = schema.add("n_words", "long").add("n_removed", "long").add("kept_sha256", "string")
        return arrow(joined, _keep(at["text"], at["spans"], keep, True), schema)
    out = arrow(joined, _keep(at["text"], at["spans"], keep, False), schema)
    back = dict(zip(others, names))
    return out.select(*[F.col("text" if c == text else back[c]).alias(c) for c in docs.columns])


def removed_words(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", window: int = WINDOW) -> DataFrame:
    """(doc_id, n_words, n_removed, kept_sha256) of every row: what is left when each window of words that also starts
    earlier is taken out. Earlier is a smaller id, or an earlier start; null ids come last, and rows of one id follow each
    other in the order they are read. Windows are judged on the input. A null or short text loses nothing."""
    return _applied(docs, doc_id, text, window, True)


def deduplicate(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", window: int = WINDOW) -> DataFrame:
    """`docs` with repeated windows cut from the texts, all columns and rows kept; see `removed_words`. A text that loses
    nothing is left as it is, of others the kept words with the white space after each remain."""
    return _applied(docs, doc_id, text, window, False)

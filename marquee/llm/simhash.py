"""Near duplicates by SimHash fingerprints, found by anchor points of a covering code.

A fingerprint has a bit for each bit that is set in more than half of the hashes of a text's shingles. The anchors are the
words of a covering code of 64 bits: two perfect Golay codes of 23 bits with covering radius 3 on the first 46, and on the
last 18 the code with a single word, whose covering radius is 18. Every fingerprint has one home, the anchor that decoding
gives, and is replicated to every anchor within covering radius plus threshold. The radius is held part by part, which only
leaves out anchors that are nobody's home at that distance: if two fingerprints differ in i bits of the first part and j of
the second, the home of one lies within 3 + i and 3 + j of the other. So whatever links, meets at the home of either, and
only homes are compared with replicas there.
"""

from __future__ import annotations

from functools import lru_cache
from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from marquee.llm.base import arrow, col, pieces, texts
from marquee.llm.components import components
from marquee.operators.sizing import broadcast_if_small
from marquee.session import materialise

#: Words of a shingle, seed of its hash, and the most bits in which linked fingerprints differ.
SHINGLE, SEED, THRESHOLD = 3, 42, 3
#: Bits and information bits of a Golay code, its covering radius, and its generator polynomial (fixed value).
BITS, WORD, RADIUS, GENERATOR = 23, 12, 3, 0xC75
#: Fingerprints with one home that are compared with its replicas in one place; a busier anchor is split into several.
BLOCK = 4_096
#: Bits of a place below the anchor, and below the block of homes.
_ANCHOR, _HOMES = 39, 20
#: Shingles hashed at a time.
CHUNK = 100_000

_PART = np.uint64((1 << BITS) - 1)


def fingerprint(text: bytes) -> int:
    """Of the words of a text, with A to Z in lower case; 0 if it has none."""
    words = text.lower().split()
    if not words:
        return 0
    from xxhash import xxh64_intdigest

    joined = b" ".join(words)
    size = min(SHINGLE, len(words))
    ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1) - 1
    starts = np.concatenate([[0], ends[:-1] + 1])
    n = len(words) - size + 1
    starts, ends = starts[:n].tolist(), ends[size - 1 :].tolist()
    counts = np.zeros(64, np.int64)
    for k in range(0, n, CHUNK):
        hashes = np.array([xxh64_intdigest(joined[a:b], SEED) for a, b in zip(starts[k : k + CHUNK], ends[k : k + CHUNK])], "<u8")
        counts += np.unpackbits(hashes.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(0, dtype=np.int64)
    return int(np.packbits(2 * counts > n, bitorder="little").view("<u8")[0])


@lru_cache(maxsize=4)
def _errors(threshold: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(syndrome of the high bits, of the low bits, first, error): the patterns of up to RADIUS + threshold bits, grouped by
    syndrome and by what they exceed RADIUS; entry `first[s, e]` is where those of syndrome s and excess e begin."""
    bit = [1]
    for _ in range(BITS - 1):
        x = bit[-1] << 1
        bit.append(x ^ GENERATOR if x >> (BITS - WORD) else x)
    table = np.zeros(1 << BITS - WORD, np.int64), np.zeros(1 << WORD, np.int64)
    for own, shift in zip(table, (0, BITS - WORD)):
        for i in range(len(own).bit_length() - 1):
            own[1 << i : 2 << i] = own[: 1 << i] ^ bit[shift + i]
    patterns, excess = [0], [0]
    for weight in range(1, RADIUS + threshold + 1):
        some = [sum(1 << i for i in c) for c in combinations(range(BITS), weight)]
        patterns += some
        excess += [max(0, weight - RADIUS)] * len(some)
    error, excess = np.array(patterns, np.uint64), np.array(excess)
    group = _syndromes(error, *table) * (threshold + 1) + excess
    order = np.argsort(group, kind="stable")
    first = np.searchsorted(group[order], np.arange((threshold + 1) * (1 << BITS - WORD) + 1))
    return table[1], table[0], first, error[order]


def _syndromes(part: np.ndarray, low: np.ndarray, high: np.ndarray) -> np.ndarray:
    return low[(part & np.uint64((1 << BITS - WORD) - 1)).astype(np.int64)] ^ high[(part >> np.uint64(BITS - WORD)).astype(np.int64)]


def reach(prints: np.ndarray, threshold: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(index, anchor, home): for each fingerprint all anchors that it is replicated to, and whether one is its home."""
    high, low, first, error = _errors(threshold)
    sides = []
    for part in (prints & _PART, (prints >> np.uint64(BITS)) & _PART):
        sides.append((part, _syndromes(part, low, high) * (threshold + 1)))
    own, anchors, homes = [], [], []
    for i in range(threshold + 1):
        for j in range(threshold + 1 - i):
            (x, s), (y, z) = sides
            n, m = first[s + i + 1] - first[s + i], first[z + j + 1] - first[z + j]
            who = np.repeat(np.arange(len(prints)), n * m)
            k = np.arange(len(who)) - np.repeat(np.cumsum(n * m) - n * m, n * m)
            a = x[who] ^ error[first[s + i][who] + k // np.maximum(m, 1)[who]]
            b = y[who] ^ error[first[z + j][who] + k % np.maximum(m, 1)[who]]
            own.append(who)
            anchors.append((((a >> np.uint64(BITS - WORD)) << np.uint64(WORD)) | (b >> np.uint64(BITS - WORD))).astype(np.int32))
            homes.append(np.full(len(who), i + j == 0))
    return np.concatenate(own), np.concatenate(anchors), np.concatenate(homes)


def _prints(batches):
    for whole in batches:
        for batch in pieces(whole, 1):
            prints = np.array([fingerprint(t or b"") for t in texts(batch.column(1))], np.uint64)
            _, home, _ = reach(prints, 0)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(prints.view(np.int64)), pa.array(home)], ["doc_id", "print", "home"])


def _replicas(threshold: int):
    """(at, print): a row for each anchor in reach. `at` is the anchor, then the block of homes and the block of replicas it
    is dealt to, 0 at first, then a bit that tells replicas from homes, so that homes come first."""

    def run(batches):
        for whole in batches:
            for k in range(0, whole.num_rows, 2_000):
                prints = whole.column(0).slice(k, 2_000).to_numpy(zero_copy_only=False).view(np.uint64)
                own, anchor, home = reach(prints, threshold)
                own, anchor = np.append(own, own[home]), np.append(anchor, anchor[home]).astype(np.int64) << _ANCHOR
                anchor[: len(home)] |= 1  # a home is among its own replicas
                yield pa.RecordBatch.from_arrays([pa.array(anchor), pa.array(prints[own].view(np.int64))], ["at", "print"])

    return run


def forest(homes: np.ndarray, replicas: np.ndarray, threshold: int) -> list[tuple[int, int]]:
    """Links between homes and replicas that connect all that is within the threshold, none that earlier ones make needless."""
    every, inverse = np.unique(np.concatenate([homes, replicas]), return_inverse=True)
    label, links = np.arange(len(every)), []
    mine, theirs = inverse[: len(homes)], np.unique(inverse[len(homes) :])
    others = every[theirs]
    for h, at in zip(homes, mine.tolist()):
        near = theirs[np.bitwise_count(others ^ h) <= threshold]
        found, one = np.unique(label[near], return_index=True)
        new = found != label[at]
        if new.any():
            links += [(int(h), int(every[x])) for x in near[one[new]]]
            label[np.isin(label, found[new])] = label[at]
    return links


def _compare(threshold: int):
    """Links at each place, whose rows come sorted. Homes of one place are held, replicas go by."""

    def run(batches):
        place, held = -1, np.empty(0, np.uint64)
        for batch in batches:
            at, prints = (batch.column(k).to_numpy(zero_copy_only=False) for k in (0, 1))
            if not len(at):
                continue
            prints, home, at = prints.view(np.uint64), at & 1 == 0, at >> 1
            edges = np.flatnonzero(np.append(True, at[1:] != at[:-1]))
            ends = np.append(edges[1:], len(at))
            busy = np.logical_or.reduceat(home, edges)
            busy[0] |= at[0] == place and len(held) > 0
            links: list[tuple[int, int]] = []
            for k in np.flatnonzero(busy).tolist():
                a, b = edges[k], ends[k]
                mine = prints[a:b][home[a:b]]
                if at[a] == place:
                    mine = np.append(held, mine)
                theirs = prints[a:b][~home[a:b]]
                if len(theirs):
                    links += forest(mine, theirs, threshold)
                if b == len(at):
                    held = mine
            if not busy[-1]:
                held = held[:0]
            place = at[-1]
            u = np.array(links, np.uint64).reshape(-1, 2).view(np.int64)
            yield pa.RecordBatch.from_arrays([pa.array(u[:, 0]), pa.array(u[:, 1])], ["a", "b"])

    return run


def links(prints: DataFrame, threshold: int = THRESHOLD) -> DataFrame:
    """(a, b): links that connect all fingerprints at `threshold` or fewer differing bits. `prints`: distinct print, home.

    Every fingerprint gives some 300 rows of two numbers, whatever the others are. Where more than BLOCK fingerprints have
    one home, they are dealt into blocks by hash, replicas there as well, and every block of homes meets every block of
    replicas in a place of its own. What leaves a place is a forest, never all its pairs."""
    rows = arrow(prints.select("print"), _replicas(threshold), "at long, print long")
    busy = prints.groupBy(F.col("home").cast("long").alias("anchor")).agg(F.count("*").alias("n")).where(F.col("n") > BLOCK)
    busy = materialise(busy.select("anchor", F.ceil(F.col("n") / BLOCK).cast("int").alias("blocks")))
    if not busy.isEmpty():
        split = rows.join(broadcast_if_small(busy), F.shiftright("at", _ANCHOR) == F.col("anchor"), "left")
        own = F.pmod(F.hash("print"), F.col("blocks")).cast("long")
        every = F.sequence(F.lit(0), F.col("blocks") - 1)
        as_home = F.transform(every, lambda j: F.col("at") + F.shiftleft(own, _HOMES) + F.shiftleft(j.cast("long"), 1))
        as_replica = F.transform(every, lambda i: F.col("at") + F.shiftleft(i.cast("long"), _HOMES) + F.shiftleft(own, 1))
        places = F.when(F.col("blocks").isNull(), F.array("at")).when(F.col("at").bitwiseAND(1) == 0, as_home).otherwise(as_replica)
        rows = split.select(F.explode(places).alias("at"), "print")
    return arrow(rows.repartition(F.shiftright("at", 1)).sortWithinPartitions("at"), _compare(threshold), "a long, b long")


def near_duplicates(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", threshold: int = THRESHOLD) -> DataFrame:
    """(doc_id, fingerprint, component_id) of every row of `docs`.

    `fingerprint`: 16 hexadecimal digits. Two rows are linked if their fingerprints differ in `threshold` bits or fewer;
    `component_id` is the smallest doc_id that links lead to. A null, empty or blank text has fingerprint 0, which is linked
    like any other; a text with fewer words than a shingle is one shingle. Repeated rows and ids give a row each. Null ids
    keep their rows and are nobody's smallest id; a component without ids has a null component_id. Other columns are not
    read. No rows: no rows.

    Only distinct fingerprints are searched, so copies meet without a comparison, however many they are."""
    rows = docs.select(col(doc_id).cast("long").alias("doc_id"), col(text).alias("text"))
    signed = materialise(arrow(rows, _prints, "doc_id long, print long, home int"))
    prints = materialise(signed.groupBy("print", "home").agg(F.min("doc_id").alias("least")))
    joined = materialise(components(materialise(links(prints, threshold))))
    named = prints.join(joined, F.col("print") == F.col("node"), "left").select("print", "least", F.coalesce("component", "print").alias("component"))
    least = named.groupBy("component").agg(F.min("least").alias("component_id"))
    placed = materialise(named.join(least, "component").select("print", "component_id"))
    hexed = F.lower(F.lpad(F.hex("print"), 16, "0"))
    return signed.join(placed, "print").select("doc_id", hexed.alias("fingerprint"), "component_id")

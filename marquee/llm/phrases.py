"""Collocations by set-oriented mining (SETM): relations of occurrences, extended by one word at a time.

The relation of length k has one entry for each place at which a frequent phrase of k words stands, sorted by piece and
position. It is stored in blocks: the places of a stretch of the corpus in order, and for each whether it is the position
next to the entry before it in the same piece. The relation of the next length is its merge-join with itself on piece and
adjacent position; the groups of the result are counted, and a semi-join with the frequent ones leaves the next relation.

A block sends each of its groups once, with a count, and gets the numbers of its frequent ones back; so the most common
word costs one small row for each block, and no set of phrases is ever broadcast or held whole by a task.
"""

from __future__ import annotations

from hashlib import blake2b

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from marquee.llm.base import arrow, col, pieces, texts
from marquee.llm.words import Words, mix
from marquee.session import discard, materialise

#: Words of the longest phrase; least count of a candidate; share of a phrase's places, in hundredths, at which a longer one
#: takes its place; rows for each language.
LONGEST, LEAST, SHARE, TOP = 3, 10, 50, 2_000
#: Bytes of text in a block. A text goes on in the next block with the words before the cut as context.
BLOCK = 1 << 20

#: What ends a piece, and what ends a word within one.
_ENDS, _GAPS = b".,;:!?\n\x0b\x0c\r", b" \t"

_END = np.zeros(256, bool)
_END[list(_ENDS)] = True
_SPACE = _END.copy()
_SPACE[list(_GAPS)] = True

_ITEMS = "block long, items binary, follows binary, context binary"


def _last(text: bytes, marks: bytes, begin: int, end: int) -> int:
    return max(text.rfind(bytes([c]), begin, end) for c in marks)


def segments(text: bytes, size: int, before: int):
    """(bytes, words of context): a text cut between words, each cut but the first with up to `before` words of the piece
    that goes on as context."""
    head, context, begin = b"", 0, 0
    while True:
        end = len(text)
        if end - begin > size:
            cut = _last(text, _ENDS + _GAPS, begin, begin + size)
            if cut < 0:
                cut = min((k for c in _ENDS + _GAPS if (k := text.find(bytes([c]), begin + size)) >= 0), default=len(text) - 1)
            end = cut + 1
        part = head + text[begin:end]
        yield part, context
        if end == len(text):
            return
        tail = part[_last(part, _ENDS, 0, len(part)) + 1 :].replace(b"\t", b" ")
        own = [w for w in tail.split(b" ") if w][-before:] if before else []
        head, context, begin = b"".join(w + b" " for w in own), len(own), end


def _distinct(words: Words, lang: np.ndarray, seeds: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(first, code, key): places of the first occurrence of each (language, word), which of them stands at each place, and
    a fingerprint of each, the same in all blocks, by which alone nothing is taken as equal. `seeds`: a number for each
    language."""
    keys = mix(words.hashes(1) + seeds[lang])
    _, first, code = np.unique(keys, return_index=True, return_inverse=True)
    check = words.hashes(3)
    if (check == check[first][code]).all() and (lang == lang[first][code]).all():
        return first, code, keys[first]
    seen: dict = {}  # two words with one fingerprint: compare the words themselves
    code = np.array([seen.setdefault((k, words.word(i)), len(seen)) for i, k in enumerate(lang.tolist())])
    first = np.unique(code, return_index=True)[1]
    return first, code, keys[first]


def _cut(size: int, longest: int):
    """The words of each stretch of some `size` bytes: its vocabulary with counts, and its places in order."""

    def block(number: int, parts: list[tuple[str, bytes, int]]) -> pa.RecordBatch:
        names = sorted({p[0] for p in parts})
        at = {n: k for k, n in enumerate(names)}
        words = Words([p[1] for p in parts], lower=True, space=_SPACE)
        lang = np.repeat(np.array([at[p[0]] for p in parts]), words.counts())
        seeds = np.array([int.from_bytes(blake2b(n.encode(), digest_size=8).digest()) for n in names], np.uint64)
        first, code, key = _distinct(words, lang, seeds)
        context = np.zeros(len(code), bool)
        for i in np.flatnonzero([p[2] for p in parts]).tolist():
            context[words.first[i] : words.first[i] + parts[i][2]] = True
        counts = np.bincount(code, ~context, len(first)).astype(np.int64)
        ends = np.cumsum(_END[words.buffer], dtype=np.int32)[words.starts]
        follows = np.append(False, ends[1:] == ends[:-1])[: len(code)]
        own = lang[first]
        totals = np.bincount(own, counts, len(names)).astype(np.int64)
        found = pa.StructArray.from_arrays(
            [pa.array(names, pa.string()).take(pa.array(own)), pa.array([words.word(i) for i in first.tolist()], pa.binary()).cast(pa.string()), pa.array(key.view(np.int64)), pa.array(counts)], ["lang", "word", "key", "n"]
        )
        spoken = pa.StructArray.from_arrays([pa.array(names, pa.string()), pa.array(totals)], ["lang", "n"])
        lists = [pa.ListArray.from_arrays(pa.array([0, len(x)], pa.int32()), x) for x in (found, spoken)]
        return pa.RecordBatch.from_arrays([pa.array([number], pa.int64()), *_packed(code, follows, context), *lists], ["block", "items", "follows", "context", "words", "totals"])

    def run(batches):
        from pyspark import TaskContext

        number, held, total = TaskContext.get().partitionId() << 33, [], 0
        for batch in (piece for whole in batches for piece in pieces(whole)):
            for text, lang in zip(texts(batch.column(0)), batch.column(1).to_pylist()):
                for part, context in segments(text or b"", size, longest - 1):
                    held.append((lang, part, context))
                    total += len(part) + 1
                    if total >= size:
                        yield block(number, held)
                        number, held, total = number + 1, [], 0
        if held:
            yield block(number, held)

    return run


def _packed(items: np.ndarray, follows: np.ndarray, context: np.ndarray) -> list[pa.Array]:
    kind = "<u2" if len(items) == 0 or items.max() < 1 << 16 else "<u4"
    return [pa.array([x], pa.binary()) for x in (np.dtype(kind).str[-1].encode() + items.astype(kind).tobytes(), np.packbits(follows).tobytes(), np.packbits(context).tobytes())]


def _unpacked(items: bytes, follows: bytes, context: bytes) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    items = np.frombuffer(items, f"<u{items[:1].decode()}", offset=1).astype(np.int64)
    bits = lambda x: np.unpackbits(np.frombuffer(x, np.uint8), count=len(items)).astype(bool)
    return items, bits(follows), bits(context)


def extended(items: np.ndarray, follows: np.ndarray, context: np.ndarray):
    """Merge-join of a relation with itself on adjacent positions: the pair at each place as one number, whether it is next
    to the pair before it, and whether it lies in the context. The sort order makes the partner of an entry the next one."""
    left = np.flatnonzero(follows[1:])
    pairs = items[left] << 32 | items[left + 1]
    return pairs, np.append(False, np.diff(left) == 1)[: len(left)], context[left + 1]


def _groups(batches):
    """(key, block, place in the block's list of groups, count) of the groups of the next length."""
    for batch in batches:
        for number, *packed in zip(*(batch.column(k).to_pylist() for k in range(4))):
            pairs, _, context = extended(*_unpacked(*packed))
            keys, code = np.unique(pairs, return_inverse=True)
            n = np.bincount(code, ~context, len(keys)).astype(np.int64)
            yield pa.RecordBatch.from_arrays([pa.array(keys), pa.array(np.full(len(keys), number)), pa.array(np.arange(len(keys), dtype=np.int32)), pa.array(n)], ["key", "block", "at", "n"])


def _kept(extend: bool):
    """Semi-join of a block's relation with its frequent groups, whose numbers become the items."""

    def run(batches):
        for batch in batches:
            for i, (number, *packed) in enumerate(zip(*(batch.column(k).to_pylist() for k in range(4)))):
                items, follows, context = _unpacked(*packed)
                if extend:
                    pairs, follows, context = extended(items, follows, context)
                    items = np.unique(pairs, return_inverse=True)[1]
                found = batch.column(4)[i].values
                at, ids = (found.field(k).to_numpy() for k in (0, 1))
                number_of = np.full(int(max(items.max(initial=-1), at.max(initial=-1))) + 1, -1, np.int64)
                number_of[at] = ids
                new = number_of[items]
                use = np.flatnonzero(new >= 0)
                follows = follows[use] & np.append(False, np.diff(use) == 1)[: len(use)]
                yield pa.RecordBatch.from_arrays([pa.array([number], pa.int64()), *_packed(new[use], follows, context[use])], [f.split()[0] for f in _ITEMS.split(", ")])

    return run


def _frequent(groups: DataFrame, keys: list[str], least: int) -> tuple[DataFrame, DataFrame]:
    """From (keys, block, at, n): the frequent groups (id, keys, f), numbered densely from 0, and for each block the list of
    its frequent groups (block, found).

    A group of several keys is named by its place in the first block that has it, so that long keys are written once."""
    own = Window.partitionBy(*keys)
    place = F.struct("block", "at") if len(keys) > 1 else F.col("block")
    name = F.col("name") if len(keys) > 1 else F.col(keys[0])
    counted = groups.select(*keys, "block", "at", F.sum("n").over(own).alias("f"), F.min(place).over(own).alias("name"))
    leads = F.col("name") == place
    rows = counted.where(F.col("f") >= least).select("block", "at", name.alias("name"), leads.alias("leads"), *[F.when(leads, F.col(c)).alias(c) for c in [*keys, "f"]])
    rows = materialise(rows)
    leads = F.col("leads")
    raw = materialise(rows.where(leads).select("name", *keys, "f", F.monotonically_increasing_id().alias("id")))
    slot = F.shiftright("id", 33)
    sizes = sorted(map(tuple, raw.groupBy(slot.alias("slot")).count().collect()))  # a row for each partition
    if sum(n for _, n in sizes) >= 1 << 31:
        raise OverflowError("two frequent groups of over 2^31 do not fit one key")
    bases = raw.sparkSession.createDataFrame([(s, sum(n for _, n in sizes[:k])) for k, (s, _) in enumerate(sizes)], "slot long, base long")
    dense = F.col("base") + F.col("id") - F.shiftleft("slot", 33)
    found = raw.join(F.broadcast(bases), slot == F.col("slot")).select("name", *keys, "f", dense.alias("id"))
    lists = rows.select("block", "at", "name").join(found.select("name", "id"), "name")
    lists = lists.groupBy("block").agg(F.collect_list(F.struct(F.col("at"), F.col("id").cast("int"))).alias("found"))
    lists = materialise(lists)
    discard(rows)
    return found, lists


def _relation(stored: DataFrame, lists: DataFrame, extend: bool) -> DataFrame:
    names = [f.split()[0] for f in _ITEMS.split(", ")]
    return materialise(arrow(stored.select(*names).join(lists, "block").select(*names, "found"), _kept(extend), _ITEMS))


def _scored(longer: DataFrame, shorter: DataFrame) -> DataFrame:
    """Phrases (id, key, f) with the counts of their beginnings and endings, from those of one word less."""
    left = shorter.select(F.col("id").alias("left"), "lang", "phrase", F.concat("firsts", F.array("n")).alias("firsts"))
    right = shorter.select(F.col("id").alias("right"), "last", F.concat("lasts", F.array("n")).alias("lasts"))
    parts = longer.select("id", F.shiftright("key", 32).alias("left"), F.col("key").bitwiseAND((1 << 32) - 1).alias("right"), F.col("f").alias("n"))
    joined = parts.join(left, "left").join(right, "right")
    return joined.select("id", "lang", F.concat_ws(" ", "phrase", "last").alias("phrase"), "last", "firsts", "lasts", "n", "left", "right")


def _weakest_cut() -> Column:
    """(score, k, l, r) of the cut with the lowest score, the smallest k among equal ones. Exact up to 38 digits, beyond
    which Spark stops with an error."""
    return F.expr(
        "array_min(transform(sequence(1, size(firsts)), k -> struct("
        "  (1000000 * cast(n AS decimal(19, 0)) * cast(n AS decimal(19, 0)))"
        "    div (cast(firsts[k - 1] AS decimal(19, 0)) * cast(lasts[size(firsts) - k] AS decimal(19, 0))) AS score,"
        "  k AS k, firsts[k - 1] AS l, lasts[size(firsts) - k] AS r)))"
    )


def mine(docs: DataFrame, text: str = "text", lang: str = "lang", longest: int = LONGEST, least: int = LEAST, share: int = SHARE, top: int = TOP) -> DataFrame:
    """(lang, rank, phrase, a, l, r, n, score): for each language the `top` phrases of 2 to `longest` words.

    A to Z count as lower case. `a` is the phrase's number of places, at least `least`; `score` is a million times
    a^2 / (l r), rounded down, at the cut into `l` first and `r` last places that makes it lowest; `n` is the language's number of
    words. A phrase goes if a longer one, itself a candidate, takes it in at `share` hundredths or more of its places. Order:
    score, then a, both descending, then the phrase by its bytes.

    A null language is `und`; a null, empty or blank text has no words. Repeated rows count each time. Other columns are not
    read, whatever their names. No rows: no phrases. A language without phrases has no rows."""
    rows = docs.select(col(text).alias("text"), F.coalesce(col(lang).cast("string"), F.lit("und")).alias("lang"))
    pair = "array<struct<lang: string, {}n: long>>"
    stored = materialise(arrow(rows, _cut(BLOCK, longest), f"{_ITEMS}, words {pair.format('word: string, key: long, ')}, totals {pair.format('')}"))
    spoken = materialise(stored.select(F.inline("totals")).groupBy("lang").agg(F.sum("n").alias("words")))
    words = stored.select("block", F.posexplode("words").alias("at", "w")).select("w.key", "w.lang", "w.word", "block", "at", "w.n")
    found, lists = _frequent(words, ["key", "lang", "word"], least)
    none = F.array().cast("array<long>")
    grams = [found.select("id", "lang", F.col("word").alias("phrase"), F.col("word").alias("last"), none.alias("firsts"), none.alias("lasts"), F.col("f").alias("n"))]
    relation = _relation(stored, lists, False)
    discard(stored)
    discard(lists)
    for length in range(2, longest + 1):
        groups = arrow(relation, _groups, "key long, block long, at int, n long")
        found, lists = _frequent(groups, ["key"], least)
        grams.append(materialise(_scored(found, grams[-1])))
        if length < longest:
            before, relation = relation, _relation(relation, lists, True)
            discard(before)
        discard(lists)
    out = None
    for k, own in enumerate(grams[1:], 2):
        kept = own
        if k < longest:
            within = grams[k].select(F.explode(F.array("left", "right")).alias("id"), "n").groupBy("id").agg(F.max("n").alias("longer"))
            kept = own.join(within, "id", "left").where(F.col("longer").isNull() | (100 * F.col("longer") < share * F.col("n")))
        kept = kept.select("lang", "phrase", F.col("n").alias("a"), _weakest_cut().alias("cut"))
        out = kept if out is None else out.unionByName(kept)
    order = Window.partitionBy("lang").orderBy(F.desc("cut.score"), F.desc("a"), "phrase")
    best = out.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= top)
    return best.join(spoken, "lang").select("lang", F.col("rank").cast("long").alias("rank"), "phrase", "a", "cut.l", "cut.r", F.col("words").alias("n"), F.col("cut.score").cast("long").alias("score"))

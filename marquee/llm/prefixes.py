"""The trie of all prefixes of conversations, built as a burst trie.

A container holds the suffixes of the conversations that begin with the same turns; the trie above it is made of heads. At
first the root is the only head and the first turns name the containers. A container with more turns than it may hold bursts:
it becomes a head, and its suffixes go to containers named by their next turn. A round looks several turns ahead, each round
twice as many as the one before, so the number of rounds follows the logarithm of the longest conversation. Containers that
need not burst are sorted and swept, each in one task: neighbours in order share the nodes of their common prefix. Heads are
few, and their sums are those of the containers and heads below them.

A turn is named by a digest of itself and all turns before it, 16 bytes, so equal names are equal nodes, and a conversation
is the string of its turns' names.
"""

from __future__ import annotations

import hashlib

import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from marquee.llm.base import arrow, col
from marquee.operators.sizing import broadcast_if_small
from marquee.session import materialise

#: Turns that a container holds without bursting; one that holds a single suffix never bursts.
HOLDS = 20_000
#: Turns that the first round looks ahead.
AHEAD = 4
#: Bytes of the names.
NAME = 16
#: Rebuilt: conversations take their first turns from the first of each PERIOD ids, up to SHARED - 1 of them.
PERIOD, SHARED = 20, 4
#: Bytes of joined ids that a task hands on as one piece, and nodes in a batch.
PIECE, BATCH = 1 << 16, 50_000

_ROOT = b"\0" * NAME
_WORD = r"[^\x20\x09-\x0D]+"


def _turns(rows: DataFrame) -> DataFrame:
    """(conv_id, turns): the turns of each conversation in order, as (name of the turn alone, words).

    Order: turn, null first, then role and text. Texts are only compared, and only moved, where turns are equal."""
    digest = F.unhex(F.sha2(F.concat(F.length("role").cast("string"), F.lit(":"), "role", "text"), 256))
    keyed = rows.select("conv_id", "turn", F.substring(digest, 1, NAME).alias("name"), F.regexp_count("text", F.lit(_WORD)).alias("words"))
    keyed = materialise(keyed)
    equal = keyed.groupBy("conv_id", "turn").agg(F.min("name").alias("x"), F.max("name").alias("y")).where("x <> y").select("conv_id", "turn")
    equal = materialise(equal)
    place = F.lit(0)
    if not equal.isEmpty():
        tied = rows.withColumn("name", F.substring(digest, 1, NAME)).alias("r").join(equal.alias("e"), (F.col("r.conv_id") == F.col("e.conv_id")) & F.col("r.turn").eqNullSafe(F.col("e.turn")), "left_semi")
        order = Window.partitionBy("conv_id", "turn").orderBy("role", "text")
        ranked = tied.select("conv_id", "turn", "name", F.rank().over(order).alias("place")).distinct()
        same = (F.col("k.conv_id") == F.col("p.conv_id")) & F.col("k.turn").eqNullSafe(F.col("p.turn")) & (F.col("k.name") == F.col("p.name"))
        keyed = keyed.alias("k").join(ranked.alias("p"), same, "left").select("k.*", "p.place")
        place = F.coalesce("place", F.lit(0))
    entry = F.struct("turn", place.alias("place"), "name", F.col("words").cast("long").alias("words"))
    return keyed.groupBy("conv_id").agg(F.sort_array(F.collect_list(entry)).alias("turns")).select("conv_id", F.transform("turns", lambda t: F.struct(t["name"].alias("name"), t["words"].alias("words"))).alias("turns"))


def rebuilt(turns: DataFrame) -> DataFrame:
    """(conv_id, turns): the first h turns of conversation c - c % PERIOD, then its own after the first h, with h the CRC-32 of
    the decimal id modulo SHARED."""
    c = F.col("conv_id")
    heads = turns.where(c % PERIOD == 0).select(c.alias("base"), F.slice("turns", 1, SHARED - 1).alias("given"))
    h = F.pmod(F.crc32(c.cast("string").cast("binary")), F.lit(SHARED)).cast("int")
    own = F.slice("turns", h + 1, F.size("turns") + 1)
    given = F.slice(F.coalesce("given", F.array().cast(turns.schema["turns"].dataType)), F.lit(1), h)
    return turns.join(heads, c - c % PERIOD == F.col("base"), "left").select("conv_id", F.concat(given, own).alias("turns"))


def _names(batches):
    """(conv_id, end, path, words): the names of all prefixes of a conversation in one string, and the last of them."""
    for batch in batches:
        paths, ends, words = [], [], []
        for own in batch.column(1).to_pylist():
            before, path = _ROOT, []
            for t in own:
                before = hashlib.blake2b(before + t["name"], digest_size=NAME).digest()
                path.append(before)
            paths.append(b"".join(path))
            ends.append(before)
            words.append([t["words"] for t in own])
        yield pa.RecordBatch.from_arrays([batch.column(0), *(pa.array(x, pa.binary()) for x in (ends, paths)), pa.array(words, pa.list_(pa.int64()))], ["conv_id", "end", "path", "words"])


def _joined(batches):
    """Sorted (end, conv_id) to pieces (end, first, text) of the ids in decimal, with a comma before each."""
    held: list = [None, None, []]

    def piece():
        text = ",".join(map(str, held[2]))
        return pa.RecordBatch.from_arrays([pa.array([held[0]], pa.binary()), pa.array([held[1]], pa.int64()), pa.array(["," + text])], ["end", "first", "text"])

    for batch in batches:
        for end, conv in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
            if held[2] and (end != held[0] or len(held[2]) * 8 >= PIECE):
                yield piece()
                held = [None, None, []]
            if not held[2]:
                held = [end, conv, []]
            held[2].append(conv)
    if held[2]:
        yield piece()


def _digests(batches):
    """Sorted pieces (end, first, text) to (end, sha256 of the whole); only the state of one hash is held."""
    end, state = None, None
    for batch in batches:
        ends, digests = [], []
        for own, text in zip(batch.column(0).to_pylist(), batch.column(2).to_pylist()):
            if own == end:
                state.update(text.encode())
                continue
            if end is not None:
                ends.append(end)
                digests.append(state.hexdigest())
            end, state = own, hashlib.sha256(text[1:].encode())
        yield pa.RecordBatch.from_arrays([pa.array(ends, pa.binary()), pa.array(digests, pa.string())], ["end", "ends_sha256"])
    if end is not None:
        yield pa.RecordBatch.from_arrays([pa.array([end], pa.binary()), pa.array([state.hexdigest()])], ["end", "ends_sha256"])


def _end_digests(named: DataFrame) -> DataFrame:
    """(end, ends_sha256): the digest of the ids of the conversations that end at a node. The ids are sorted and joined into
    pieces by range, so that those of a common conversation are spread; one task for each node then reads its pieces."""
    dealt = named.select("end", "conv_id").repartitionByRange("end", "conv_id").sortWithinPartitions("end", "conv_id")
    pieces = arrow(dealt, _joined, "end binary, first long, text string")
    return arrow(pieces.repartition("end").sortWithinPartitions("end", "first"), _digests, "end binary, ends_sha256 string")


def _burst(suffixes: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Settled suffixes (their container: head, depth, path, words, heads) and those that end at a head.

    A suffix: end, n, least (conversations and smallest id), ends_sha256, path and words from `depth` on, heads (the names of
    the heads above, and of each its words)."""
    ahead, settled, ended = AHEAD, [], []
    name = lambda k: F.substring(F.col("path"), (k - 1) * NAME + 1, F.lit(NAME))
    left = F.length("path") / NAME
    while True:
        each = suffixes.select("end", left.cast("int").alias("left"), F.explode(F.expr(f"sequence(1, least({ahead}, length(path) div {NAME}))")).alias("k"), "path")
        each = each.where("left > 0").select("end", "k", name(F.col("k")).alias("node"), (F.col("left") - F.col("k") + 1).cast("long").alias("turns"))
        big = each.groupBy("node").agg(F.count("*").alias("members"), F.sum("turns").alias("turns")).where((F.col("members") > 1) & (F.col("turns") > HOLDS)).select("node")
        big = materialise(big)
        if big.isEmpty():
            settled.append(suffixes.where("length(path) > 0"))
            ended.append(suffixes.where("length(path) = 0"))
            break
        deep = each.join(broadcast_if_small(big), "node").groupBy("end").agg(F.max("k").cast("int").alias("b"))
        moved = suffixes.join(deep, "end", "left").withColumn("b", F.coalesce("b", F.lit(0)))
        new = F.when(F.col("b") > 0, F.transform(F.sequence(F.lit(1), F.col("b")), lambda k: F.struct(name(k).alias("name"), F.element_at("words", k.cast("int")).alias("words")))).otherwise(F.array().cast(suffixes.schema["heads"].dataType))
        cut = F.expr(f"substring(path, b * {NAME} + 1, length(path))")
        rest = F.expr("slice(words, b + 1, size(words) + 1)")
        moved = moved.withColumn("heads", F.concat("heads", new)).withColumn("words", rest).withColumn("path", cut)
        moved = materialise(moved.withColumn("open", F.col("b") == ahead).drop("b"))
        settled.append(moved.where("not open and length(path) > 0"))
        ended.append(moved.where("length(path) = 0"))
        suffixes, ahead = moved.where("open and length(path) > 0").drop("open"), 2 * ahead
    union = lambda parts: _union([p.select("end", "n", "least", "ends_sha256", "path", "words", "heads") for p in parts])
    return union(settled), union(ended)


def _union(parts: list[DataFrame]) -> DataFrame:
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


_NODE = "node binary, conv_id long, depth long, parent_conv_id long, n_convs long, n_children long, n_leaves long, saved_tokens long, ends_sha256 string, head binary"


def _sweep(batches):
    """Nodes of the containers from their suffixes, sorted by path. The first node of a container has the name of the head
    above it, and no parent's id yet."""
    empty = hashlib.sha256(b"").hexdigest()
    out: list[tuple] = []
    open_: list = []  # names, depth and head of the container that is being read
    nodes: list[list] = []  # of the container: name, level, parent, words, n, least, leaves, saved, children, ends
    line: list[int] = []  # the nodes on the path of the last suffix

    def closed():
        for i in range(len(nodes) - 1, -1, -1):
            x = nodes[i]
            x[7] += (x[4] - 1) * x[3]
            x[6] = x[6] or 1
            if x[2] >= 0:
                p = nodes[x[2]]
                p[4] += x[4]
                p[5] = min(p[5], x[5])
                p[6] += x[6]
                p[7] += x[7]
                p[8] += 1
        for x in nodes:
            top = x[2] < 0
            out.append((x[0], x[5], open_[1] + x[1], None if top else nodes[x[2]][5], x[4], x[8], x[6], x[7], x[9], open_[2] if top else None))

    def flushed():
        kinds = (pa.binary(), *[pa.int64()] * 7, pa.string(), pa.binary())
        names = [f.split()[0] for f in _NODE.split(", ")]
        while out:
            some = out[:BATCH]
            del out[:BATCH]
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*some), kinds)], names)

    before = b""
    for batch in batches:
        for n, least, digest, path, words, head, depth in zip(*(batch.column(k).to_pylist() for k in range(7))):
            common = 0
            if open_ and path[:NAME] == open_[0]:
                while common < len(line) and path[common * NAME : (common + 1) * NAME] == before[common * NAME : (common + 1) * NAME]:
                    common += 1
            else:
                if nodes:
                    closed()
                if len(out) >= BATCH:
                    yield from flushed()
                open_, nodes, line = [path[:NAME], depth, head], [], []
            del line[common:]
            for k in range(common, len(path) // NAME):
                line.append(len(nodes))
                nodes.append([path[k * NAME : (k + 1) * NAME], k + 1, line[k - 1] if k else -1, words[k], 0, least, 0, 0, 0, empty])
            last = nodes[line[-1]]
            last[4] += n
            last[5] = min(last[5], least)
            last[9] = digest
            before = path
    if nodes:
        closed()
    yield from flushed()


def trie(conversations: DataFrame) -> DataFrame:
    """A row for each node of the trie of the conversations (conv_id, turns): conv_id (its smallest member), depth,
    parent_conv_id, n_convs, n_children, n_leaves, saved_tokens, ends_sha256, and its name `node`.

    `turns`: an array of (name, words), names being equal where turns are. A conversation is one row of its task, 24 bytes a
    turn. Equal conversations are one suffix with a count, however many they are."""
    named = materialise(arrow(conversations, _names, "conv_id long, end binary, path binary, words array<long>"))
    ends = _end_digests(named)
    once = named.groupBy("end").agg(F.count("*").alias("n"), F.min("conv_id").alias("least"))
    texts = named.join(once.drop("end"), F.col("conv_id") == F.col("least")).select("end", "n", "least", "path", "words")
    root = F.array(F.struct(F.lit(bytearray(_ROOT)).alias("name"), F.lit(0).cast("long").alias("words")))
    suffixes = materialise(texts.join(ends, "end").select("end", "n", "least", "ends_sha256", "path", "words", root.alias("heads")))
    settled, ended = _burst(suffixes)

    head, depth = F.element_at("heads", -1)["name"], F.size("heads").cast("long") - 1
    dealt = settled.select("n", "least", "ends_sha256", "path", "words", head.alias("head"), depth.alias("depth"))
    dealt = dealt.repartition(F.substring("path", 1, NAME)).sortWithinPartitions("path")
    swept = materialise(arrow(dealt, _sweep, _NODE))

    # heads: the sums of their members and of the containers below them
    members = settled.unionByName(ended).select("n", "least", F.posexplode("heads").alias("depth", "h"), F.size("heads").alias("all"), F.slice("heads", 1, F.size("heads")).alias("above"))
    members = members.select("n", "least", "depth", "h", F.when(F.col("depth") > 0, F.get("above", F.col("depth") - 1)["name"]).alias("parent"), F.slice(F.transform("above", lambda a: a["name"]), F.lit(1), F.col("depth") + 1).alias("line"))
    heads = members.groupBy(F.col("h.name").alias("node")).agg(
        F.sum("n").alias("n_convs"), F.min("least").alias("conv_id"), F.any_value("h.words").alias("words"), F.any_value("depth").cast("long").alias("depth"), F.any_value("parent").alias("parent"), F.any_value("line").alias("line")
    )
    heads = materialise(heads)
    tops = swept.where("head is not null").join(broadcast_if_small(heads.select(F.col("node").alias("head"), "line")), "head")
    below = tops.select(F.explode("line").alias("node"), F.col("n_leaves"), F.col("saved_tokens"))
    spared = heads.select(F.explode("line").alias("node"), F.lit(0).cast("long").alias("n_leaves"), ((F.col("n_convs") - 1) * F.col("words")).alias("saved_tokens"))
    sums = below.unionByName(spared).groupBy("node").agg(F.sum("n_leaves").alias("n_leaves"), F.sum("saved_tokens").alias("saved_tokens"))
    children = tops.select(F.col("head").alias("node")).unionByName(heads.where("parent is not null").select(F.col("parent").alias("node"))).groupBy("node").agg(F.count("*").alias("n_children"))
    finished = ended.select(F.col("end").alias("node"), "ends_sha256")
    whole = heads.join(children, "node", "left").join(sums, "node").join(finished, "node", "left")
    above = heads.select(F.col("node").alias("over"), F.col("conv_id").alias("parents"))
    nothing = F.sha2(F.lit(""), 256)
    columns = ["node", "conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256"]
    whole = whole.join(above, F.col("parent") == F.col("over"), "left").select(
        "node", "conv_id", "depth", F.col("parents").alias("parent_conv_id"), "n_convs",
        F.coalesce("n_children", F.lit(0)).alias("n_children"), F.greatest("n_leaves", F.lit(1)).alias("n_leaves"), "saved_tokens", F.coalesce("ends_sha256", nothing).alias("ends_sha256"),
    )
    inner = swept.join(broadcast_if_small(above), F.col("head") == F.col("over"), "left").withColumn("parent_conv_id", F.coalesce("parent_conv_id", "parents"))
    return whole.select(*columns).unionByName(inner.select(*columns))


def prefix_trie(table: DataFrame, conv_id: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text") -> DataFrame:
    """The nodes of the trie of the rebuilt conversations, see `rebuilt` and `trie`; conv_id to ends_sha256.

    Turns are ordered by `turn`, null first, equal ones by role, then text. A null role or text is empty; repeated rows are
    repeated turns. Rows with a null conv_id belong to no conversation and are left out. A conversation without turns is a
    member of the root. Other columns are not read. No conversations: no rows."""
    rows = table.select(
        col(conv_id).cast("long").alias("conv_id"), col(turn).alias("turn"), F.coalesce(col(role), F.lit("")).alias("role"), F.coalesce(col(text), F.lit("")).alias("text")
    ).where("conv_id is not null")
    return trie(rebuilt(_turns(rows))).drop("node")

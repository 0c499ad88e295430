"""Byte-pair encoding and decoding with a public vocabulary.

Merges of a pre-token come from a priority queue of (rank, place) over a doubly linked list of symbols; an entry whose
symbols have changed since it was queued is skipped. Decoding joins the vocabulary strings of the ids. The vocabulary file
states the pattern of pre-tokens, the mark at a word's end, the special strings and the merges.
"""

from __future__ import annotations

import json
import os
import unicodedata
from functools import lru_cache
from heapq import heapify, heappop, heappush

import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from marquee.llm.base import arrow, named, texts

VOCABULARY = "word_bpe_49k.json"

#: Encoded chunks a worker remembers; when full, it starts again with none.
REMEMBERED = 500_000


def vocabulary_path(name: str = VOCABULARY) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def printable_bytes() -> dict[int, str]:
    """A visible character for each byte: printable Latin-1 stands for itself, the others follow from U+0100 in order."""
    own = [b for b in range(256) if 33 <= b <= 126 or 161 <= b <= 172 or b >= 174]
    rest = [b for b in range(256) if b not in set(own)]
    return {b: chr(b) for b in own} | {b: chr(256 + i) for i, b in enumerate(rest)}


@lru_cache(maxsize=1)
def late_characters() -> tuple[frozenset[str], dict[int, str], dict[int, str]]:
    """Letters and numbers that Python's own Unicode tables do not have yet, the lower case of each, and a
    stand-in, neither letter nor number, for those that the tokenizers library does not have either. Its tables lie between
    those of Python and of the regex module, so its own steps are asked, once for each process."""
    from tokenizers import Regex, normalizers, pre_tokenizers

    unassigned = "".join(chr(c) for c in range(0x110000) if not 0xD800 <= c < 0xE000 and unicodedata.category(chr(c)) == "Cn")
    late = regex.findall(r"[\p{L}\p{N}]", unassigned)
    if not late:
        return frozenset(), {}, {}
    lines = "\n".join(late)
    lower = normalizers.Lowercase().normalize_str(lines).split("\n")
    known = {t for t, _ in pre_tokenizers.Split(Regex(r"[^\p{L}\p{N}]"), "removed").pre_tokenize_str(lines)}
    return frozenset(late), {ord(c): x for c, x in zip(late, lower) if x != c}, {ord(c): "\ue000" for c in late if c not in known}


class Bpe:
    def __init__(self, path: str):
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        model, steps = spec["model"], spec["pre_tokenizer"]["pretokenizers"]
        self.end = model["end_of_word_suffix"] or ""
        self.ids: dict[str, int] = dict(model["vocab"])
        self.pairs: dict[int, tuple[int, int]] = {}
        for rank, m in enumerate(model["merges"]):
            left, right = m if isinstance(m, list) else m.split(" ")
            self.pairs[self.ids[left] << 32 | self.ids[right]] = rank, self.ids[left + right]
        self.pattern = regex.compile(next(s["pattern"]["Regex"] for s in steps if s["type"] == "Split"))
        self.late, self.late_lower, self.instead = late_characters()
        self.visible = printable_bytes()
        self.special = {t["content"]: t["id"] for t in spec["added_tokens"]}
        self.specials = regex.compile("(" + "|".join(map(regex.escape, sorted(self.special, key=len, reverse=True))) + ")") if self.special else None
        self.opening = "".join(os.path.commonprefix(list(self.special)))
        self.strings = {i: s for s, i in (self.ids | self.special).items()}
        self.byte_ids = [self.ids.get(self.visible[b], -1) for b in range(256)]
        self.last_ids = [self.ids.get(self.visible[b] + self.end, -1) for b in range(256)]

    def normal(self, text: str) -> str:
        """Composed form and lower case, character by character: no rule looks at the neighbours."""
        if text.isascii():
            return text.lower()
        text = "".join(map(str.lower, unicodedata.normalize("NFC", text)))
        return text if self.late.isdisjoint(text) else text.translate(self.late_lower)

    def pretokens(self, text: str) -> list[str | int]:
        """Pre-tokens in order; a special string inside the text is its id."""
        if not self.specials or self.opening not in text:
            return self._found(self.normal(text))
        out: list[str | int] = []
        for i, part in enumerate(self.specials.split(text)):
            if i % 2:
                out.append(self.special[part])
            elif part:
                out.extend(self._found(self.normal(part)))
        return out

    def _found(self, text: str) -> list[str]:
        if text.isascii() or self.late.isdisjoint(text):
            return self.pattern.findall(text)
        return [text[m.start() : m.end()] for m in self.pattern.finditer(text.translate(self.instead))]

    def symbols(self, pretoken: str) -> list[int]:
        """One symbol for each byte, the last with the mark of a word's end."""
        raw = pretoken.encode()
        out = [self.byte_ids[b] for b in raw]
        out[-1] = self.last_ids[raw[-1]]
        return out

    def merge(self, symbol: list[int]) -> list[int]:
        """Ids of one pre-token: the pair of lowest rank first, the leftmost among equals. `symbol` is used up.

        A queue entry is rank * n + place. Merging two symbols frees the right one's place, so an entry is stale when the
        pair that now stands at its place has another rank or is gone."""
        n, find = len(symbol), self.pairs.get
        if n == 1:
            return symbol
        after, before = list(range(1, n + 1)), list(range(-1, n - 1))
        queue = [p[0] * n + i for i, p in enumerate([find(a << 32 | b) for a, b in zip(symbol, symbol[1:])]) if p]
        heapify(queue)
        while queue:
            rank, i = divmod(heappop(queue), n)
            j = after[i]
            if j >= n or symbol[i] < 0 or (p := find(symbol[i] << 32 | symbol[j])) is None or p[0] != rank:
                continue  # stale
            new = symbol[i] = p[1]
            symbol[j] = -1
            k = after[i] = after[j]
            if k < n:
                before[k] = i
                if (p := find(new << 32 | symbol[k])) is not None:
                    heappush(queue, p[0] * n + i)
            if (h := before[i]) >= 0 and (p := find(symbol[h] << 32 | new)) is not None:
                heappush(queue, p[0] * n + h)
        return [x for x in symbol if x >= 0]

    def encode(self, text: str) -> list[int]:
        out: list[int] = []
        for t in self.pretokens(text):
            if isinstance(t, int):
                out.append(t)
            else:
                out.extend(self.merge(self.symbols(t)))
        return out

    def decode(self, ids: list[int]) -> str:
        return " ".join(self.strings[i] for i in ids)

    def whole_tokens(self) -> set[str]:
        """Pre-tokens proved to be one token: the merges of the symbols of a vocabulary string give back its own id."""
        byte = {c: b for b, c in self.visible.items()}
        out = set()
        for s, i in self.ids.items():
            if not self.end or not s.endswith(self.end) or s == self.end:
                continue
            try:
                word = bytes(byte[c] for c in s[: -len(self.end)]).decode()
            except (KeyError, UnicodeDecodeError):
                continue
            if self.pattern.fullmatch(word) and self.merge(self.symbols(word)) == [i]:
                out.add(word)
        return out


class Remembered(dict):
    """Function values by key, at most so many at a time."""

    def __init__(self, fn, most: int = REMEMBERED):
        super().__init__()
        self.fn, self.most = fn, most

    def __missing__(self, key):
        value = self.fn(key)
        if len(self) >= self.most:
            self.clear()
        self[key] = value
        return value


@lru_cache(maxsize=4)
def loaded(path: str) -> Bpe:
    return Bpe(path)


@lru_cache(maxsize=4)
def _both_ways(path: str) -> Remembered:
    """For a chunk between ASCII white space: its ids and its decoded text, each joined by spaces. White space ends a
    pre-token and no step looks past it, so the chunks of a text can be encoded one by one."""
    bpe = loaded(path)
    def strings(ids: list[int]) -> tuple[str, str]:
        return " ".join(map(str, ids)), bpe.decode(ids)

    by_pretoken = Remembered(lambda t: strings([t] if isinstance(t, int) else bpe.merge(bpe.symbols(t))))

    def both(chunk: bytes) -> tuple[str, str]:
        found = bpe.pretokens(chunk.decode())
        if len(found) == 1:
            return by_pretoken[found[0]]
        parts = [by_pretoken[t] for t in found]
        return " ".join([p[0] for p in parts]), " ".join([p[1] for p in parts])

    return Remembered(both)


def _round_trip(path: str):
    def run(batches):
        from hashlib import sha256

        known = _both_ways(path)
        for batch in batches:
            counts, encoded, decoded = [], [], []
            for text in texts(batch.column(1)):
                both = [x for x in map(known.__getitem__, (text or b"").split()) if x[0]]
                ids = " ".join([x[0] for x in both])
                counts.append(ids.count(" ") + 1 if ids else 0)
                encoded.append(sha256(ids.encode()).hexdigest())
                decoded.append(sha256(" ".join([x[1] for x in both]).encode()).hexdigest())
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(counts, pa.int64()), pa.array(encoded, pa.string()), pa.array(decoded, pa.string())], ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"])

    return run


def round_trip(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", path: str | None = None) -> DataFrame:
    """Encode and decode every text; digests of the ids and of the decoded text, one row per row of `docs`.

    A null text counts as empty: no ids, and both digests are those of the empty string. Repeated rows and null ids are
    kept, other columns are not read. A chunk without pre-tokens adds nothing. Texts of any length; a worker holds one
    Arrow batch and a bounded memory of chunks. One map over the rows, no shuffle.
    """
    rows = named(docs, doc_id=doc_id, text=text).withColumn("doc_id", F.col("doc_id").cast("long"))
    return arrow(rows, _round_trip(path or vocabulary_path()), "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string")


def _encode(path: str):
    def run(batches):
        bpe = loaded(path)
        known = Remembered(lambda chunk: bpe.encode(chunk.decode()))
        for batch in batches:
            ids = [[i for c in (t or b"").split() for i in known[c]] for t in texts(batch.column(1))]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(ids, pa.list_(pa.int32()))], ["doc_id", "ids"])

    return run


def encode(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", path: str | None = None) -> DataFrame:
    """(doc_id, ids) of every row; a null text has no ids."""
    rows = named(docs, doc_id=doc_id, text=text).withColumn("doc_id", F.col("doc_id").cast("long"))
    return arrow(rows, _encode(path or vocabulary_path()), "doc_id long, ids array<int>")


def _decode(path: str):
    def run(batches):
        bpe = loaded(path)
        for batch in batches:
            out = [bpe.decode(ids or []) for ids in batch.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(out, pa.string())], ["doc_id", "text"])

    return run


def decode(encoded: DataFrame, path: str | None = None) -> DataFrame:
    """(doc_id, text) from (doc_id, ids): vocabulary strings joined by spaces, empty for null or no ids."""
    return arrow(encoded.select("doc_id", "ids"), _decode(path or vocabulary_path()), "doc_id long, text string")

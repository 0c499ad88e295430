"""Line labels by a linear-chain conditional random field; the share of content decides whether a document is kept.

A line is described by shares of its characters and words. The field has two states, content and boilerplate, a weight for
each state and feature, and weights for the first state and each step. It is trained here on a bounded sample of documents
whose quality is labelled; lines have no labels of their own, so lines of a bad document take the better fitting state in
later rounds. Decoding is exact (Viterbi).
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from marquee.llm.base import arrow, named, texts
from marquee.llm.words import Words, base, groups, mix, runs

#: Labelled documents of either quality that the field is fitted to, at most, and the most lines of one of them.
SAMPLE = 1_500
SAMPLE_LINES = 300
#: Words in content lines, as a share of all words, from which a document is kept.
SHARE = 0.5
#: Base rules: least number of words, and the most words in repeated three-word windows in percent.
LEAST_WORDS = 50
REPEATED = 50
STEPS, ROUNDS, RATE, PENALTY = 150, 3, 0.15, 1e-4

CONTENT, BOILERPLATE = 0, 1
FEATURES = 13

_SYMBOLS = np.isin(np.arange(256), list(b"#*$%&|<>"))
_UPPER = (np.arange(256) >= 65) & (np.arange(256) <= 90)
_LOWER = ((np.arange(256) >= 97) & (np.arange(256) <= 122)) | (np.arange(256) >= 128)
_DIGIT = (np.arange(256) >= 48) & (np.arange(256) <= 57)
_LOUD = np.arange(256) == 33
_MARKS = (np.arange(256) > 32) & (np.arange(256) < 128) & ~_UPPER & ~_LOWER & ~_DIGIT
_STARTS = (np.arange(256) & 0xC0) != 0x80
_SPACES = np.isin(np.arange(256), [9, 10, 11, 12, 13, 32])
_CLOSES = np.isin(np.arange(256), list(b".!?"))


class Lines:
    """Lines and words of a group of texts: counts for the base rules, and the features of each line that has a word.

    `line_first`: for each text, the index of its first line with a word; one more than texts. `line_words`: words of each."""

    def __init__(self, group: list[bytes]):
        words = Words(group)
        buffer, owner = words.buffer, words.owners()
        total = len(words.starts)
        breaks = np.flatnonzero(buffer == 10)  # the separator after a text ends its last line
        begins = np.concatenate([[0], breaks[:-1] + 1]) if len(breaks) else breaks

        def between(table: np.ndarray, low: np.ndarray, high: np.ndarray) -> np.ndarray:
            sums = np.zeros(len(buffer) + 1, np.int64)
            np.cumsum(table[buffer], out=sums[1:])
            return sums[high] - sums[low]

        ends = words.offsets[1:] - 1
        self.n_words = words.counts()
        self.word_chars = between(_STARTS & ~_SPACES, words.offsets[:-1], ends)
        self.n_symbols = between(_SYMBOLS, words.offsets[:-1], ends)

        # three-word windows that occur twice in a text
        covered = np.zeros(total + 1, np.int64)
        h, at = runs(words.hashes(), words.first, 3)
        if len(at):
            h = mix(h ^ (owner[at].astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)))
            order = np.argsort(h, kind="stable")
            same = h[order][1:] == h[order][:-1]
            twice = np.zeros(len(h), bool)
            twice[order[1:]] |= same
            twice[order[:-1]] |= same
            covered[at[twice]] += 1
            covered[at[twice] + 3] -= 1
        repeated = np.cumsum(covered[:-1]) > 0
        self.n_repeat_words = np.add.reduceat(np.append(repeated, False).astype(np.int64), words.first[:-1]) * (self.n_words > 0) if len(group) else self.n_words

        # lines with a word
        line = np.searchsorted(begins, words.starts, "right") - 1
        new = np.ones(total, bool)
        new[1:] = line[1:] != line[:-1]
        first = np.flatnonzero(new)
        self.line_words = np.diff(np.append(first, total))
        lines = line[first]
        low, high = begins[lines], breaks[lines]
        self.line_first = np.searchsorted(first, words.first)
        line_owner = owner[first] if total else np.empty(0, np.int64)
        b = base(3)
        same_line = mix(b.spans(b.sums(b.values[buffer]), low, high) ^ (line_owner.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15))) if total else np.empty(0, np.uint64)
        _, earliest, which = np.unique(same_line, return_index=True, return_inverse=True)
        again = earliest[which] != np.arange(len(lines))
        self.n_dup_lines = np.bincount(line_owner[again], minlength=len(group)).astype(np.int64) if total else np.zeros(len(group), np.int64)

        chars = np.maximum(between(~_SPACES, low, high), 1)
        upper, lower = between(_UPPER, low, high), between(_LOWER, low, high)
        n = self.line_words
        lone = (words.ends - words.starts == 1) & ~(_UPPER | _LOWER | _DIGIT)[buffer[words.starts]]
        per_line = lambda flag: np.add.reduceat(flag.astype(np.int64), first) if total else np.empty(0, np.int64)
        last_word = first + n - 1
        self.features = np.stack(
            [
                np.ones(len(lines)),
                np.minimum(1, 4 * between(_SYMBOLS, low, high) / chars),
                upper / np.maximum(upper + lower, 1),
                between(_DIGIT, low, high) / chars,
                np.minimum(1, 4 * between(_LOUD, low, high) / chars),
                per_line(lone) / np.maximum(n, 1),
                np.log1p(n) / 4,
                (n <= 2).astype(float),
                again.astype(float),
                per_line(repeated) / np.maximum(n, 1),
                _CLOSES[buffer[words.ends[last_word] - 1]].astype(float) if total else np.empty(0),
                np.minimum(2, chars / np.maximum(n, 1) / 10),
                np.minimum(1, 3 * between(_MARKS, low, high) / chars),
            ],
            1,
        )


def viterbi(scores: np.ndarray, start: np.ndarray, step: np.ndarray) -> list[int]:
    """The best states of one sequence; `scores`: places x 2. A tie goes to content."""
    if not len(scores):
        return []
    (s00, s01), (s10, s11) = step.tolist()
    rows = scores.tolist()
    a, b = rows[0][0] + start[0], rows[0][1] + start[1]
    back = []
    for x, y in rows[1:]:
        a0, b0, a1, b1 = a + s00, b + s10, a + s01, b + s11
        back.append((0 if a0 >= b0 else 1, 0 if a1 >= b1 else 1))
        a, b = x + max(a0, b0), y + max(a1, b1)
    state = 0 if a >= b else 1
    out = [state]
    for pair in reversed(back):
        state = pair[state]
        out.append(state)
    return out[::-1]


class Field:
    """Weights of the two states: `emit` (features x 2), `start` (2), `step` (from x to)."""

    def __init__(self, emit=None, start=None, step=None):
        self.emit = np.zeros((FEATURES, 2)) if emit is None else np.asarray(emit, float)
        self.start = np.zeros(2) if start is None else np.asarray(start, float)
        self.step = np.zeros((2, 2)) if step is None else np.asarray(step, float)

    def states(self, features: np.ndarray) -> list[int]:
        return viterbi(features @ self.emit, self.start, self.step)

    def gradient(self, x: np.ndarray, y: np.ndarray, there: np.ndarray):
        """Of the mean log-likelihood. x: documents x lines x features, y: states, there: which lines exist."""
        docs, places, _ = x.shape
        scores = x @ self.emit
        log = lambda v, axis: (m := v.max(axis, keepdims=True)).squeeze(axis) + np.log(np.exp(v - m).sum(axis))
        forward, backward = np.zeros((docs, places, 2)), np.zeros((docs, places, 2))
        forward[:, 0] = scores[:, 0] + self.start
        for t in range(1, places):
            f = log(forward[:, t - 1, :, None] + self.step, 1) + scores[:, t]
            forward[:, t] = np.where(there[:, t, None], f, forward[:, t - 1])
        for t in range(places - 2, -1, -1):
            b = log(self.step + (scores[:, t + 1] + backward[:, t + 1])[:, None, :], 2)
            backward[:, t] = np.where(there[:, t + 1, None], b, 0)
        z = log(forward[:, -1], 1)
        p = np.exp(forward + backward - z[:, None, None]) * there[:, :, None]
        truth = np.eye(2)[y] * there[:, :, None]
        emit = np.einsum("dtf,dts->fs", x, truth - p)
        start = (truth[:, 0] - p[:, 0]).sum(0)
        step = np.zeros((2, 2))
        if places > 1:
            pair = forward[:, :-1, :, None] + self.step + (scores[:, 1:] + backward[:, 1:])[:, :, None, :] - z[:, None, None, None]
            step = np.einsum("dti,dtj->ij", truth[:, :-1], truth[:, 1:]) - (np.exp(np.minimum(pair, 0)) * there[:, 1:, None, None]).sum((0, 1))
        return emit, start, step

    def fit(self, documents: list[tuple[np.ndarray, bool]]) -> Field:
        """`documents`: features of the lines and whether the document is good. Lines of good ones are content; those of
        bad ones are boilerplate at first and take the states that the field gives them in later rounds, but never all
        content."""
        documents = [d for d in documents if len(d[0])]
        if not any(good for _, good in documents) or all(good for _, good in documents):
            return self
        labels = [np.full(len(x), CONTENT if good else BOILERPLATE) for x, good in documents]
        order = sorted(range(len(documents)), key=lambda i: len(documents[i][0]))
        blocks = [order[i : i + 256] for i in range(0, len(order), 256)]
        lines = sum(len(x) for x, _ in documents)
        for turn in range(ROUNDS):
            packed = []
            for block in blocks:
                most = max(len(documents[i][0]) for i in block)
                x, y, there = np.zeros((len(block), most, FEATURES)), np.zeros((len(block), most), int), np.zeros((len(block), most), bool)
                for k, i in enumerate(block):
                    n = len(labels[i])
                    x[k, :n], y[k, :n], there[k, :n] = documents[i][0], labels[i], True
                packed.append((x, y, there))
            first = [np.zeros_like(w) for w in (self.emit, self.start, self.step)]
            second = [np.zeros_like(w) for w in first]
            for k in range(1, STEPS // ROUNDS + 1):
                parts = [self.gradient(*p) for p in packed]
                for j, w in enumerate((self.emit, self.start, self.step)):
                    g = sum(p[j] for p in parts) / lines - PENALTY * w
                    first[j] = 0.9 * first[j] + 0.1 * g
                    second[j] = 0.99 * second[j] + 0.01 * g * g
                    w += RATE * (first[j] / (1 - 0.9**k)) / (np.sqrt(second[j] / (1 - 0.99**k)) + 1e-8)
            if turn + 1 < ROUNDS:
                for i, (x, good) in enumerate(documents):
                    if not good:
                        states = np.array(viterbi(x @ self.emit, np.zeros(2), self.step / 2))
                        labels[i] = states if states.any() else np.full(len(x), BOILERPLATE)
        return self


def _line_features(batches):
    for batch in batches:
        raw = [t or b"" for t in texts(batch.column(1))]
        good, out = batch.column(0).to_pylist(), []
        for a, b in groups(raw):
            lines = Lines(raw[a:b])
            for i in range(b - a):
                f = lines.features[lines.line_first[i] : lines.line_first[i + 1]]
                out.append((good[a + i], f.astype("<f4").tobytes() if 0 < len(f) <= SAMPLE_LINES else None))
        yield pa.RecordBatch.from_arrays([pa.array([x[0] for x in out], pa.int32()), pa.array([x[1] for x in out], pa.binary())], ["quality", "features"])


def train(docs: DataFrame, labels: DataFrame, doc_id: str = "doc_id", text: str = "text", sample: int = SAMPLE) -> Field:
    """A field fitted to at most `sample` labelled documents of either quality, chosen by a hash of the id.

    `labels`: (doc_id, quality); rows with a null id or a quality other than 0 and 1 are left out, and of a repeated id the
    lowest quality counts. Without documents of both qualities the field knows nothing and calls every line content.
    """
    known = labels.where(F.col("doc_id").isNotNull() & F.col("quality").isin(0, 1)).groupBy("doc_id").agg(F.min("quality").cast("int").alias("quality"))
    there = named(docs, doc_id=doc_id).where(F.col("doc_id").isNotNull()).distinct()
    known = known.join(there, "doc_id", "left_semi")
    order = [F.xxhash64("doc_id"), F.col("doc_id")]
    chosen = known.where("quality = 0").orderBy(*order).limit(sample).unionByName(known.where("quality = 1").orderBy(*order).limit(sample))
    rows = named(docs, doc_id=doc_id, text=text).join(F.broadcast(chosen), "doc_id").select("quality", "text")  # 2 * sample rows at most
    got = arrow(rows, _line_features, "quality int, features binary").where("features is not null").orderBy(F.xxhash64("features"), "features").limit(2 * sample).collect()
    return Field().fit([(np.frombuffer(r["features"], "<f4").reshape(-1, FEATURES).astype(float), r["quality"] == 1) for r in got])


RESULT = "n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long, base_failed boolean, kept boolean, content_share double"


def _judge(raw: list[bytes], field: Field):
    """The columns of RESULT for some texts."""
    columns: list[list] = [[] for _ in range(8)]
    for a, b in groups(raw):
        lines = Lines(raw[a:b])
        scores = lines.features @ field.emit
        for i in range(b - a):
            low, high = lines.line_first[i], lines.line_first[i + 1]
            n, again = int(lines.n_words[i]), int(lines.n_repeat_words[i])
            states = np.array(viterbi(scores[low:high], field.start, field.step), int)
            content = int(lines.line_words[low:high][states == CONTENT].sum()) if n else 0
            share = content / n if n else 0.0
            failed = n < LEAST_WORDS or 100 * again > REPEATED * n
            for c, v in zip(columns, (n, int(lines.word_chars[i]), int(lines.n_symbols[i]), int(lines.n_dup_lines[i]), again, failed, not failed and share >= SHARE, share)):
                c.append(v)
    kinds = [pa.int64()] * 5 + [pa.bool_()] * 2 + [pa.float64()]
    return [pa.array(c, k) for c, k in zip(columns, kinds)]


def _rules(field: Field):
    def run(batches):
        for batch in batches:
            out = _judge([t or b"" for t in texts(batch.column(1))], field)
            yield pa.RecordBatch.from_arrays([batch.column(0), *out], ["doc_id", *(c.split()[0] for c in RESULT.split(", "))])

    return run


def rules(docs: DataFrame, field: Field, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """Base counts, content share and verdict of every text; one row per row of `docs`.

    A null text has no words, so it fails the base rules, as an empty one does. Repeated rows and null ids are kept; other
    columns are not read. One map over the rows.
    """
    rows = named(docs, doc_id=doc_id, text=text).withColumn("doc_id", F.col("doc_id").cast("long"))
    return arrow(rows, _rules(field), "doc_id long, " + RESULT)


def _keep(field: Field, column: int):
    def run(batches):
        for batch in batches:
            yield batch.filter(_judge([t or b"" for t in texts(batch.column(column))], field)[6])

    return run


def keep(docs: DataFrame, field: Field, text: str = "text") -> DataFrame:
    """The rows of `docs` that are kept, with all their columns."""
    return arrow(docs, _keep(field, docs.columns.index(text)), docs.schema)

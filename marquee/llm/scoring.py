"""Log-likelihood of whole documents under a recurrent model and under plain frequencies, learned from the corpus.

Every training document counts and trains: words are counted by a shuffle, and in each round every task improves the
shared weights on its own share of the documents, after which the weights are averaged by an aggregation. What tasks and
driver hold of the vocabulary is bounded: the model's words, and the most frequent words with their counts; all other words
meet their counts in a join.
"""

from __future__ import annotations

import zlib
from collections import Counter
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from marquee.llm import gru
from marquee.llm.base import arrow, named, texts
from marquee.session import materialise

#: Documents of this remainder are held out.
PARTS, HELD_OUT = 7, 2
#: Most frequent words whose counts every task holds, none longer than so many bytes.
HEAD, HEAD_BYTES = 200_000, 64
#: Averages of the weights; each document trains in one of them.
ROUNDS = 4
#: Words counted by a task before it hands counts on, and tokens scored together.
COUNTED = 400_000
TOGETHER = 2_000_000


def _held(doc_id) -> bool:
    return doc_id is not None and zlib.crc32(str(doc_id).encode()) % PARTS == HELD_OUT


def _count(batches):
    counts: Counter = Counter()

    def rows():
        words = list(counts)
        return pa.RecordBatch.from_arrays([pa.array(words, pa.binary()).cast(pa.string()), pa.array([counts[w] for w in words], pa.int64())], ["word", "n"])

    ends = 0
    for batch in batches:
        for doc_id, text in zip(batch.column(0).to_pylist(), texts(batch.column(1))):
            if not _held(doc_id):
                counts.update((text or b"").lower().split())
                ends += 1
                if len(counts) > COUNTED:
                    yield rows()
                    counts.clear()
    yield rows()
    yield pa.RecordBatch.from_arrays([pa.array([None], pa.string()), pa.array([ends], pa.int64())], ["word", "n"])


@dataclass
class Vocabulary:
    """Counts of the training tokens: their number and that of different ones, ends included; the same of rare words."""

    tokens: int
    distinct: int
    ends: int
    rare_tokens: int
    rare_distinct: int
    model: list[bytes]
    model_counts: np.ndarray


def _encode(head, vocabulary: Vocabulary):
    def run(batches):
        table = head.value
        place = {w: i + 2 for i, w in enumerate(vocabulary.model)}
        # word -> (id in the model, log10(count + 1)); a rare word has the id RARE
        known = {w: (place.get(w, gru.RARE), v) for w, v in zip(table[0], np.log10(table[1] + 1.0).tolist())}
        end = np.log10(vocabulary.ends + 1.0) if vocabulary.ends else 0.0
        for batch in batches:
            out: list[list] = [[] for _ in range(8)]
            for doc_id, text in zip(batch.column(1).to_pylist(), texts(batch.column(2))):
                words = (text or b"").lower().split()
                found = [known.get(w) for w in words]
                tail = [w for w, f in zip(words, found) if f is None]
                ids = np.fromiter([gru.RARE if f is None else f[0] for f in found] + [gru.END], "<u2", len(words) + 1)
                logs = np.fromiter([0.0 if f is None else f[1] for f in found], float, len(words))
                rare = ids[:-1] == gru.RARE
                row = (_held(doc_id), len(words) + 1, int(rare.sum()), float(logs.sum()) + end, float(logs[rare].sum()), len(words) - len(tail) + (vocabulary.ends > 0), ids.tobytes(), tail)
                for o, v in zip(out, row):
                    o.append(v)
            kinds = [pa.bool_(), pa.int64(), pa.int64(), pa.float64(), pa.float64(), pa.int64(), pa.binary(), pa.list_(pa.binary())]
            arrays = [pa.array(o, k) for o, k in zip(out, kinds)]
            arrays[-1] = arrays[-1].cast(pa.list_(pa.string()))
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), *arrays], ["row", "doc_id", "held_out", "n_tokens", "n_rare", "all_logs", "rare_logs", "n_known", "ids", "tail"])

    return run


def _train(weights, counts: np.ndarray):
    def run(batches):
        model = gru.Gru(counts).load(weights.value)
        trainer = gru.Trainer(model)
        for batch in batches:
            own = [np.frombuffer(x, "<u2") for x in batch.column(0).to_pylist()]
            if own:
                trainer.feed(np.concatenate(own).astype(np.int64))
        trainer.feed(np.empty(0, np.int64), final=True)
        if trainer.tokens:
            vector = model.vector().astype(float) * trainer.tokens
            yield pa.RecordBatch.from_arrays([pa.array(np.arange(len(vector) + 1), pa.int32()), pa.array(np.append(vector, trainer.tokens))], ["k", "v"])

    return run


def _score(weights, counts: np.ndarray):
    def run(batches):
        model = gru.Gru(counts).load(weights.value)
        for batch in batches:
            sizes = batch.column(2).to_numpy(zero_copy_only=False)
            raw, out, begin, total = batch.column(1), [], 0, 0
            for i, n in enumerate([*sizes.tolist(), None]):
                if n is None or (i > begin and total + n > TOGETHER):
                    out.append(gru.score(model, [np.frombuffer(x, "<u2").astype(np.int64) for x in raw.slice(begin, i - begin).to_pylist()]))
                    begin, total = i, 0
                total += n or 0
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(np.concatenate(out) / np.log(10))], ["row", "model"])

    return run


def counted(docs: DataFrame) -> DataFrame:
    """(word, n) of the training documents; the word null stands for the ends."""
    return arrow(docs.select("doc_id", "text"), _count, "word string, n long").groupBy("word").agg(F.sum("n").alias("n"))


def score_documents(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", rounds: int = ROUNDS) -> DataFrame:
    """(doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score) of every row of `docs`.

    Letters A to Z count as small ones; tokens are the words and one end. A null text is empty: one token. A null id is not
    held out. `base_score` is by frequencies with one added, `score` by the recurrent model; a word outside the model's is
    predicted as rare, then by its frequency among rare words. Rows with the same id are scored each; if nothing trains,
    all counts are 0 and the model is its start. `docs` must come from storage, so that a row read again has the same number.
    """
    spark = docs.sparkSession
    rows = named(docs, doc_id=doc_id, text=text).select(F.monotonically_increasing_id().alias("row"), F.col("doc_id").cast("long").alias("doc_id"), "text")
    counts = materialise(counted(rows))
    words = counts.where("word is not null")
    total = counts.agg(F.coalesce(F.sum("n"), F.lit(0)).alias("tokens"), F.coalesce(F.sum(F.when(F.col("word").isNull(), F.col("n"))), F.lit(0)).alias("ends"), F.count("word").alias("words")).first()
    table = words.where(F.octet_length("word") <= HEAD_BYTES).orderBy(F.desc("n"), "word").limit(HEAD).toArrow()  # HEAD short words at most
    head = [w.encode() for w in table["word"].to_pylist()], table["n"].to_numpy().astype(np.int64)
    own = head[0][: gru.WORDS - 2]
    inside = int(head[1][: len(own)].sum())
    counts_model = np.zeros(gru.WORDS)
    counts_model[gru.END], counts_model[gru.RARE] = total["ends"], total["tokens"] - total["ends"] - inside
    counts_model[2 : 2 + len(own)] = head[1][: len(own)]
    vocabulary = Vocabulary(total["tokens"], total["words"] + (total["ends"] > 0), total["ends"], total["tokens"] - total["ends"] - inside, total["words"] - len(own), own, counts_model)
    shared = spark.sparkContext.broadcast(head)
    schema = "row long, doc_id long, held_out boolean, n_tokens long, n_rare long, all_logs double, rare_logs double, n_known long, ids binary, tail array<string>"
    encoded = materialise(arrow(rows, _encode(shared, vocabulary), schema))
    weights = gru.Gru(counts_model).vector()
    for turn in range(rounds):
        now = spark.sparkContext.broadcast(weights)
        own_docs = encoded.where(~F.col("held_out") & (F.pmod(F.xxhash64("row"), F.lit(rounds)) == turn)).select("ids")
        mean = arrow(own_docs, _train(now, counts_model), "k int, v double").groupBy("k").agg(F.sum("v").alias("v")).toArrow()  # the model's size
        if mean.num_rows:
            v = np.zeros(len(weights) + 1)
            v[mean["k"].to_numpy()] = mean["v"].to_numpy()
            weights = (v[:-1] / v[-1]).astype(np.float32)
    now = spark.sparkContext.broadcast(weights)
    scored = arrow(encoded.select("row", "ids", "n_tokens"), _score(now, counts_model), "row long, model double")
    tail = encoded.select("row", F.explode("tail").alias("word")).join(words, "word", "left")
    tail = tail.groupBy("row").agg(F.sum(F.log10(F.coalesce("n", F.lit(0)) + F.lit(1.0))).alias("logs"), F.count("n").alias("known"))
    joined = encoded.drop("ids", "tail").join(tail, "row", "left").join(scored, "row").fillna({"logs": 0.0, "known": 0})
    base = F.col("all_logs") + F.col("logs") - F.col("n_tokens") * F.lit(float(np.log10(vocabulary.tokens + vocabulary.distinct + 1)))
    rare = F.col("rare_logs") + F.col("logs") - F.col("n_rare") * F.lit(float(np.log10(vocabulary.rare_tokens + vocabulary.rare_distinct + 1)))
    return joined.select("doc_id", "held_out", "n_tokens", (F.col("n_known") + F.col("known")).alias("n_known"), F.lit(vocabulary.tokens).cast("long").alias("train_tokens"), base.alias("base_score"), (F.col("model") + rare).alias("score"))

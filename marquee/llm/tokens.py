"""Token counts without encoding: strings proved to be one token are counted directly, only the rest are merged."""

from __future__ import annotations

from functools import lru_cache

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from marquee.llm.base import arrow, named, texts
from marquee.llm.bpe import Remembered, loaded, vocabulary_path


@lru_cache(maxsize=4)
def _whole(path: str) -> frozenset[str]:
    """Proved once per process, from the vocabulary alone; its size is bounded by the vocabulary's."""
    return frozenset(loaded(path).whole_tokens())


@lru_cache(maxsize=4)
def _counter(path: str) -> Remembered:
    bpe, whole = loaded(path), _whole(path)
    merged = Remembered(lambda t: len(bpe.merge(bpe.symbols(t))))

    def count(chunk: bytes) -> int:
        n = 0
        for t in bpe.pretokens(chunk.decode()):
            n += 1 if isinstance(t, int) or t in whole else merged[t]
        return n

    return Remembered(count)


def _count(path: str, limit: int):
    def run(batches):
        known = _counter(path)
        for batch in batches:
            sizes, counts = [], []
            for text in texts(batch.column(1)):
                text = text or b""
                sizes.append(len(text))
                counts.append(sum(map(known.__getitem__, text.split())))
            n = pa.array(counts, pa.int64())
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(sizes, pa.int64()), n, pa.array([x > limit for x in counts], pa.bool_())], ["doc_id", "n_bytes", "n_tokens", "over_limit"])

    return run


def token_counts(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", path: str | None = None, limit: int = 2048) -> DataFrame:
    """Bytes and tokens of every text, and whether the tokens exceed `limit`; one row per row of `docs`.

    A null text counts as empty: 0 bytes, 0 tokens. Repeated rows and null ids are kept, other columns are not read.
    Texts of any length. One map over the rows, no shuffle; a worker's memory of chunks is bounded.
    """
    rows = named(docs, doc_id=doc_id, text=text).withColumn("doc_id", F.col("doc_id").cast("long"))
    return arrow(rows, _count(path or vocabulary_path(), limit), "doc_id long, n_bytes long, n_tokens long, over_limit boolean")

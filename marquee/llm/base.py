"""What the operators share: Arrow tasks, row keys, texts as bytes."""

from __future__ import annotations

import contextlib
import ctypes
import gc
import os
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

_ROOT = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

#: Texts handled together in a task, in bytes; a longer text is handled alone.
PIECE = 2 << 20


def ship(spark: SparkSession) -> None:
    """Python workers on machines that hold the repository find it without an installed package."""
    have = spark.sparkContext.environment.get("PYTHONPATH", "")
    if _ROOT not in have.split(os.pathsep):
        spark.sparkContext.environment["PYTHONPATH"] = os.pathsep.join(x for x in (_ROOT, have) if x)


def lean(fn: Callable) -> Callable:
    """A task function in a worker that lives on: its tables hold no cycles to search for, and what it frees goes back to
    the system when it ends."""

    def run(batches):
        was = gc.isenabled()
        gc.disable()
        try:
            yield from fn(batches)
        finally:
            if was:
                gc.enable()
            gc.collect()
            pa.default_memory_pool().release_unused()
            with contextlib.suppress(OSError, AttributeError):  # not every C library has it
                ctypes.CDLL(None).malloc_trim(0)

    return run


def arrow(df: DataFrame, fn: Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]], schema: str) -> DataFrame:
    """`fn` over the record batches of each partition."""
    ship(df.sparkSession)
    return df.mapInArrow(lean(fn), schema)


def fresh(df: DataFrame, *names: str) -> list[str]:
    """Names that no column of `df` has, whatever its case."""
    taken, out = {c.lower() for c in df.columns}, []
    for name in names:
        while name.lower() in taken:
            name = "_" + name
        taken.add(name.lower())
        out.append(name)
    return out


def texts(column: pa.Array) -> list[bytes | None]:
    return column.cast(pa.binary()).to_pylist()


def pieces(batch: pa.RecordBatch, column: int = 0, size: int = PIECE) -> Iterator[pa.RecordBatch]:
    """A batch cut where its texts in `column` exceed `size` bytes together."""
    import pyarrow.compute as pc

    lengths = pc.fill_null(pc.binary_length(batch.column(column)), 0).to_pylist()
    begin = total = 0
    for i, n in enumerate(lengths):
        if i > begin and total + n > size:
            yield batch.slice(begin, i - begin)
            begin, total = i, 0
        total += n
    if begin < len(lengths):
        yield batch.slice(begin)


def named(df: DataFrame, **columns: str) -> DataFrame:
    """Only the columns an operator reads, under the names it uses: `doc_id="id"` reads column id as doc_id."""
    return df.select(*[col(old).alias(new) for new, old in columns.items()])


def col(name: str) -> Column:
    return F.col("`" + name.replace("`", "``") + "`")


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/documents.parquet")

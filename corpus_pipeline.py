"""A corpus in stages: each takes (spark, docs, sf_dir) and returns a frame that is written and read again for the next.

All stages but the last return the columns of `documents`; where a text changes, `n_chars` follows it.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from marquee.llm import lines, minhash, packing, quality, substrings
from marquee.llm.base import documents
from marquee.session import materialise


def _counted(docs: DataFrame) -> DataFrame:
    return docs.withColumn("n_chars", F.length("text").cast("long")) if "n_chars" in docs.columns else docs


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the base rules or the line field reject go; the field is fitted on the labelled documents."""
    return quality.keep(docs, quality.train(docs, spark.read.parquet(f"{sf_dir}/labels.parquet")))


def line_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Lines on many sites go, but for their first place; every document stays."""
    return _counted(lines.remove(docs))


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each class of near duplicates one document stays."""
    return minhash.deduplicate(docs)


def substring_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Passages that stand earlier too go; every document stays."""
    return _counted(substrings.deduplicate(docs))


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of documents with their sequences and places, the sources mixed in proportion."""
    return packing.pack(docs, content=False)


STAGES = [("quality_rules", quality_rules), ("line_dedup", line_dedup), ("near_dedup", near_dedup), ("substring_dedup", substring_dedup), ("packing", packed)]

#: The first stage decides by a trained field, which SQL cannot express; the stages are tested against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir)
    for _, stage in STAGES[:-1]:
        docs = materialise(stage(spark, docs, sf_dir))
    return STAGES[-1][1](spark, docs, sf_dir)

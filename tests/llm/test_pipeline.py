"""The corpus pipeline as a whole, on odd rows."""

from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

import corpus_pipeline
from marquee.llm import bpe, minhash, quality
from marquee.session import materialise


@pytest.fixture(scope="module")
def folder(spark, docs, tmp_path_factory):
    path = str(tmp_path_factory.mktemp("corpus"))
    docs.repartition(5).write.parquet(f"{path}/documents.parquet")
    labels = docs.where("doc_id is not null").select("doc_id").distinct().select("doc_id", (F.col("doc_id") % 3 > 0).cast("int").alias("quality"), F.lit(0).alias("toxic"))
    labels.write.parquet(f"{path}/labels.parquet")
    return path


@pytest.fixture(scope="module")
def stages(spark, folder):
    out = [spark.read.parquet(f"{folder}/documents.parquet")]
    for _, stage in corpus_pipeline.STAGES:
        out.append(materialise(stage(spark, out[-1], folder)))
    return out


def _rows(df):
    return Counter(str(r) for r in df.collect())


def test_stages_are_the_agreed_ones(stages):
    assert [name for name, _ in corpus_pipeline.STAGES] == ["quality_rules", "line_dedup", "near_dedup", "substring_dedup", "packing"]
    for before, after in zip(stages, stages[1:-1]):
        assert after.dtypes == before.dtypes


def test_quality_drops_what_the_rules_reject(spark, folder, stages):
    labels = spark.read.parquet(f"{folder}/labels.parquet")
    verdict = quality.rules(stages[0], quality.train(stages[0], labels))
    kept = Counter(r.doc_id for r in verdict.where("kept").collect())
    assert Counter(r.doc_id for r in stages[1].collect()) == kept and sum(kept.values()) < stages[0].count()


def test_texts_change_and_rows_stay_where_they_should(stages):
    for k in (2, 4):  # lines, passages
        assert Counter(r.doc_id for r in stages[k].collect()) == Counter(r.doc_id for r in stages[k - 1].collect())
        assert all(r.n_chars == (None if r.text is None else len(r.text)) for r in stages[k].collect())
    classes = minhash.classes(stages[2])
    assert stages[3].count() == classes.where("kept").count()
    assert not _rows(stages[3]) - _rows(stages[2])


def test_packing_holds_the_texts_of_the_stage_before(stages):
    library = Tokenizer.from_file(bpe.vocabulary_path())
    library.no_truncation()
    want, got = defaultdict(int), defaultdict(int)
    for r in stages[4].collect():
        want[r.doc_id] += len(library.encode(r.text or "", add_special_tokens=False).ids) + 1
    for r in stages[5].collect():
        got[r.doc_id] += r.length
    assert got == want
    sizes = Counter()
    for r in stages[5].collect():
        sizes[r.sequence_id] += r.length
    assert np.all([n == 4096 for s, n in sizes.items() if s != max(sizes)])


def test_run_is_the_stages_one_after_the_other(spark, folder, stages):
    assert _rows(corpus_pipeline.run(spark, folder)) == _rows(stages[-1])


def test_nothing_to_do(spark, docs, tmp_path):
    docs.where("false").write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame([], "doc_id long, quality int, toxic int").write.parquet(f"{tmp_path}/labels.parquet")
    assert corpus_pipeline.run(spark, str(tmp_path)).count() == 0

"""What the Python workers of the corpus operators hold at once."""

import tracemalloc

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from transferlens.llm import common, language, stages

ODD = ["", None, "a", "ab", "Der Hund, 12", "é" * 40, "one two three " * 9, "z"]


@pytest.fixture
def matrix():
    return np.log(np.random.default_rng(1).random((language.BUCKETS, 3)) + 0.1)


def peak(call):
    tracemalloc.start()
    try:
        call()
        return tracemalloc.get_traced_memory()[1] / 2**20
    finally:
        tracemalloc.stop()


@pytest.mark.parametrize("most", [1, 3, 4, 64])
def test_texts_in_parts_have_the_same_ngrams(monkeypatch, matrix, most):
    batch = pa.RecordBatch.from_arrays([pa.array(ODD), pa.array(["x", "y"] * 4)], ["text", "lang"])
    scores, counts = language.log_scores(batch.column("text"), matrix), [*language.count_grams([batch])]
    monkeypatch.setattr(language, "PART", most)
    assert np.allclose(language.log_scores(batch.column("text"), matrix), scores, rtol=1e-12, atol=1e-9)
    assert [*language.count_grams([batch])] == counts


@pytest.mark.parametrize("texts", [["long text, " * 600_000], ["short text"] * 600_000])
def test_scores_hold_a_bounded_part_of_the_texts(matrix, texts):
    # Before, 6 MB of text took more than 100 MB, and a long text some 60 times its size.
    column = pa.array(texts)
    assert peak(lambda: language.log_scores(column, matrix)) < 60


def test_counts_hold_a_bounded_part_of_a_long_text():
    batch = pa.RecordBatch.from_arrays([pa.array(["long text, " * 600_000]), pa.array(["x"])], ["text", "lang"])
    assert peak(lambda: [*language.count_grams([batch])]) < 60


def test_workers_give_back_what_arrow_keeps(monkeypatch):
    calls = []

    class Pool:
        def release_unused(self):
            calls.append(1)

    monkeypatch.setattr(common.pa, "default_memory_pool", Pool)
    assert [*common.lean(lambda batches: (2 * x for x in batches))(iter([1, 2]))] == [2, 4]
    assert len(calls) == 3


def test_language_stage_sends_the_text_once(spark, monkeypatch):
    rows = [(1, "Der Hund und die Katze", "de", "a"), (2, None, "de", "b"), (3, "the dog and the cat", "en", None), (3, "12", None, "a")]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, lang string, row string").select("lang", "doc_id", "text", "row")
    seen, predict = [], language.predict
    monkeypatch.setattr(stages.languages, "predict", lambda held, *rest: seen.append(held) or predict(held, *rest))
    kept = stages.language(spark, docs, "")
    assert "text" not in seen[0].schema["row"].dataType.names
    assert kept.schema == docs.schema
    assert sorted(map(tuple, kept.collect())) == sorted(map(tuple, docs.filter(F.col("text").rlike(r"\p{L}")).collect()))

"""Words and their counts on their way between blocks and buckets."""

import numpy as np
import pyarrow as pa
import pytest
from deedflow.llm import lm_score
from pyspark.sql import functions as F

from .test_ppm import base_scores, check_scores


def test_words_and_large_counts_come_back():
    words = pa.array(["", *(f"w{i}" for i in range(5000)), "été", "\x1c"])
    counts = np.arange(len(words)) << 33
    rows = list(lm_score.dealt_words(words, counts))
    assert len(rows) > 1000
    got = {}
    for r in rows:
        got |= dict(zip(lm_score.unpacked_words([r["data"]], [r["size"]]).to_pylist(), lm_score.unpacked_long(r["more"], r["n"]).tolist()))
    assert got == dict(zip(words.to_pylist(), counts.tolist()))


def test_a_vocabulary_settles_as_it_grows(monkeypatch):
    monkeypatch.setattr(lm_score, "ANSWERS", 3)
    vocabulary = lm_score.Vocabulary()
    for some in (["a", "b"], ["b", "c", "d"], ["a"], ["e", "f", "g", "b"]):
        for r in lm_score.dealt_words(pa.array(some), np.ones(len(some), np.int64)):
            vocabulary.learn(r["n"], r["size"], r["data"], r["more"])
    vocabulary.settle()
    assert vocabulary.answer(pa.array(["b", "z", "a", "g"], pa.large_string())).tolist() == [3, 0, 2, 1]
    assert vocabulary.fresh() == 7 and vocabulary.fresh() == 0


@pytest.mark.parametrize("most", [1, 40])
def test_many_small_blocks(spark, monkeypatch, most):
    monkeypatch.setattr(lm_score.blocks, "__defaults__", (most,))
    rows = [(i, " ".join(["the", "cat", f"x{i % 5}", "the"][: i % 5])) for i in range(60)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    got = lm_score.score(docs, F.pmod(F.crc32(F.col("doc_id").cast("string").cast("binary")), F.lit(7)) != 2).collect()
    assert len(base_scores(rows)) == 60
    check_scores(got, rows)

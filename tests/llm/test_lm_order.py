import numpy as np
import pytest
from deedflow.llm import lm_score, trie
from pyspark.sql import functions as F

from .test_ppm import ASK, TRAIN, brute


def test_order_stays_when_windows_are_many(spark, monkeypatch):
    monkeypatch.setattr(lm_score, "WINDOWS", 10)  # was the most that a model could have
    if lm_score.model_of.__defaults__:
        monkeypatch.setattr(lm_score.model_of, "__defaults__", (10,))
    rows = [(i, t.decode(), i < len(TRAIN)) for i, t in enumerate([*TRAIN, *ASK])]
    docs = spark.createDataFrame(rows, "doc_id long, text string, train boolean").repartition(3)
    got = {r["doc_id"]: r["score"] for r in lm_score.score(docs, F.col("train")).collect()}
    assert [got[i] for i, _, _ in rows] == pytest.approx([brute(TRAIN, t.encode(), lm_score.ORDER, "D") for _, t, _ in rows], rel=1e-5)


def test_a_bucket_knows_all_of_its_windows():
    keys, counts = trie.grams(trie.joined(TRAIN, 5)[0], 5)
    low = trie.summed([keys & np.uint64(0xFFFF)], [counts])
    asked = np.unique(np.concatenate([keys, trie.grams(trie.joined(ASK, 5)[0], 5)[0]]))
    whole = dict(zip(asked.tolist(), trie.Trie(keys, counts, 5).of_windows(asked).tolist()))
    learned = {r["bucket"]: (lm_score.unpacked_keys(r["data"], r["n"]), lm_score.unpacked(r["more"], r["n"])) for r in lm_score.dealt(keys, counts)}
    seen = 0
    for r in lm_score.dealt(asked, None):
        model = trie.Trie(*learned.get(r["bucket"], (keys[:0], counts[:0])), 5, low)
        some = lm_score.unpacked_keys(r["data"], r["n"])
        assert model.of_windows(some).tolist() == [whole[k] for k in some.tolist()]
        seen += len(some)
    assert seen == len(asked)

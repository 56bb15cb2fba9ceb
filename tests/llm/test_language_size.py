"""The same code lengths for any number of languages, a bounded sample, and what no language explains."""

import numpy as np
import pytest
from deedflow.llm import language_id, ppm
from pyspark.sql import functions as F

from .test_ppm import ASK, TRAIN


def test_sparse_tries_equal_the_table():
    parts = [ppm.grams(ppm.joined(t)[0]) for t in (TRAIN, TRAIN[:1], TRAIN[1:])]
    table, tries = ppm.model_of(parts), ppm.model_of(parts, most=0)
    assert isinstance(table, ppm.Model) and isinstance(tries, ppm.Tries)
    assert ppm.frozen(tries.state()).scores(ASK) == pytest.approx(ppm.frozen(table.state()).scores(ASK), rel=1e-5)


def test_many_languages_keep_the_order(spark, monkeypatch):
    rng = np.random.default_rng(2)
    names = [f"l{i:02d}" for i in range(30)]
    letters = [chr(0x400 + 8 * i) + "".join(chr(c) for c in rng.choice(range(0x400 + 8 * i, 0x408 + 8 * i), 6)) for i in range(30)]
    rows = [(i, " ".join("".join(rng.choice(list(letters[i % 30]), 5)) for _ in range(30)), names[i % 30]) for i in range(240)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    monkeypatch.setattr(ppm.model_of, "__defaults__", (1000,))
    found, model = language_id.learn(docs, F.col("doc_id") < 180)
    assert found == names and isinstance(model, ppm.Tries) and model.order == ppm.ORDER
    held = language_id.judge(docs.where("doc_id >= 180"), found, model, bits="bits").collect()
    assert np.mean([r["lang_pred"] == r["lang"] for r in held]) > 0.95 and all(r["bits"] < language_id.UNEXPLAINED for r in held)


def test_the_sample_is_bounded(spark, monkeypatch):
    rows = [(i % 7 or None, f"some words {i % 50}", "en" if i % 3 else "fr") for i in range(4000)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    monkeypatch.setattr(ppm, "model_of", lambda parts: parts)
    names, parts = language_id.learn(docs, F.lit(True), sample=5)
    # each text has one end
    assert names == ["en", "fr"] and [int(n[(k & 255) == ppm.EOS].sum()) for k, n in parts] == [5, 5]
    again = language_id.learn(docs.repartition(5), F.lit(True), sample=5)[1]
    assert all(np.array_equal(x, y) for a, b in zip(parts, again) for x, y in zip(a, b))
    assert [int(n[(k & 255) == ppm.EOS].sum()) for k, n in language_id.learn(docs, F.lit(True))[1]] == [350, 350]


def test_what_no_language_explains(spark):
    docs = spark.createDataFrame([(1, "the cat sat on the mat", "en"), (2, "жук и кот", None), (3, "the mat", None), (4, "77", "en")], "doc_id long, text string, lang string")
    bits = lambda some: {r["doc_id"]: r["bits"] for r in language_id.judge(docs, *language_id.learn(some, F.lit(True)), bits="bits").collect()}
    found = bits(docs)
    assert found[1] < 8 and found[3] < 8 and found[2] >= language_id.UNEXPLAINED and found[4] is None
    more = docs.union(spark.createDataFrame([(5, "кот и жук", "ru")], docs.schema))
    assert bits(more)[2] < language_id.UNEXPLAINED

"""Searches with huge values, equal vectors and repeated rows, and the share of vectors that is verified."""

import numpy as np
import pytest
from deedflow.llm import collision_ann
from pyspark.sql import functions as F

from .test_vectors_quality_html import brute_nearest


@pytest.mark.parametrize("kind, huge", [("float", 3e38), ("double", 1e300)])
def test_huge_components(spark, kind, huge):
    rng = np.random.default_rng(4)
    rows = [(i, [float(np.float32(x)) for x in v]) for i, v in enumerate(rng.standard_normal((200, 4)))] + [(200, [huge, 0.0, 1.0, -huge]), (201, [1e-30, 0.0, 0.0, 0.0])]
    df = spark.createDataFrame(rows, f"vec_id long, embedding array<{kind}>")
    got = collision_ann.nearest(df, F.col("vec_id").isin(3, 200), k=3).orderBy("query_id", "rank").collect()
    assert [r["query_id"] for r in got] == [3] * 3 + [200] * 3
    assert [r["vec_id"] for r in got[:3]] == [i for i, _ in brute_nearest(rows[:200] + rows[201:], [3], 3)[3]]


def test_all_alike(spark):
    rows = [(i, [2.0, 2.0]) for i in range(50)] + [(7, [2.0, 2.0])] * 20
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    got = collision_ann.nearest(df, F.col("vec_id") == 7, k=4, chunk=8).orderBy("rank").collect()
    assert [(r["vec_id"], r["score"]) for r in got] == [(0, 0.0), (1, 0.0), (2, 0.0), (3, 0.0)]


def test_recall_and_share_on_vectors_without_structure():
    rng = np.random.default_rng(5)
    vectors = rng.standard_normal((8192, 64)).astype(np.float32)
    vectors /= np.linalg.norm(vectors, axis=1, keepdims=True)
    chunk = collision_ann.Chunk(np.arange(8192), vectors)
    found, verified = [], []
    for q in range(0, 8192, 200):
        distance = np.linalg.norm(vectors.astype(float) - vectors[q].astype(float), axis=1)
        some = chunk.candidates(vectors[q], 10)
        found.append(np.isin(np.argsort(distance)[1:11], some).mean())
        verified.append(len(some) / 8192)
    assert np.mean(found) >= 0.95 and np.mean(verified) < 0.1

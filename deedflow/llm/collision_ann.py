"""Approximate nearest neighbours by collision-counting hashing.

Index: the vectors are dealt into chunks of about ``CHUNK``; for each of ``PROJECTIONS`` single random
projections (orthogonal to each other in groups of the dimension) a chunk keeps its projected values sorted,
with the permutation.  A query opens a window around its own projected value in every array and widens all of
them by virtual rehashing (each radius reuses what the last has counted) until more than
``ROOM * k + SHARE * n`` vectors of the chunk collide with it in ``THRESHOLD`` of the projections, or the windows hold
everything.  All vectors over the threshold are verified by their exact distance, however many they are, and
the chunks' best are merged.  Every vector is indexed; the projections are fixed by a seed, so nothing is fitted.

Chunks and blocks of queries are bounded rows of packed arrays; the queries (a stated set) meet all chunks in
blocks, so a task holds one chunk and one block.  A vector that occurs very often is spread over chunks.  The work
is the number of queries times that of vectors, as each array is counted through: where both grow it grows with their product.

Vectors that are null, zero, or hold null or non-finite components take no part.  Only vectors of one length
are compared.  Defined results: ties go to the smaller id; fewer candidates than ``k`` are all returned; the
query's own id is never its neighbour; rows alike in id and vector are one in the index and as many in the result; very large components are scaled before they are
projected; other columns are not returned, whatever their names; an empty table or no query gives an empty result.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .runtime import durable, ship

CHUNK = 8192
BLOCK = 512
PROJECTIONS = 64
THRESHOLD = 0.85
SHARE = 0.03
GROWTH = 1.04
#: A chunk's search goes on until this many candidates for each neighbour collide, and ``SHARE`` of the chunk.
ROOM = 20
SEED = 17


def directions(dim: int, count: int = PROJECTIONS, seed: int = SEED) -> np.ndarray:
    """``count`` unit directions as columns, orthogonal within groups of ``dim``."""
    rng = np.random.default_rng(seed)
    groups = [np.linalg.qr(rng.standard_normal((dim, dim)))[0] for _ in range(math.ceil(count / dim))]
    return np.concatenate(groups, axis=1)[:, :count]


class Chunk:
    """The sorted projections of some vectors, scaled by their largest component."""

    def __init__(self, ids: np.ndarray, vectors: np.ndarray, times: np.ndarray | None = None) -> None:
        """``times``: how often a vector occurs with its id."""
        self.ids, self.vectors = ids, vectors.astype(np.float64)
        self.times = np.ones(len(ids), np.int64) if times is None else times
        self.scale = float(np.abs(self.vectors).max())
        self.axes = directions(vectors.shape[1])
        projected = ((self.vectors / self.scale) @ self.axes).T
        self.order = np.argsort(projected, axis=1, kind="stable")
        self.sorted = np.take_along_axis(projected, self.order, axis=1)
        quarter = len(ids) // 4
        self.first = float(np.median(self.sorted[:, -1 - quarter] - self.sorted[:, quarter]))

    def candidates(self, query: np.ndarray, k: int) -> np.ndarray:
        """Positions of all vectors over the collision threshold at the radius where the search ends."""
        n, m = len(self.ids), len(self.sorted)
        at = (query.astype(np.float64) / self.scale) @ self.axes
        need, enough = math.ceil(THRESHOLD * m), min(n, 1 + ROOM * k + math.ceil(SHARE * n))
        low, high, radius, counts = None, None, self.first, None
        while True:
            to_low = [int(np.searchsorted(s, a - radius)) for s, a in zip(self.sorted, at)]
            to_high = [int(np.searchsorted(s, a + radius, side="right")) for s, a in zip(self.sorted, at)]
            if counts is None:  # windows are wide, so what lies outside is counted
                outside = [o[:x] for o, x in zip(self.order, to_low)] + [o[y:] for o, y in zip(self.order, to_high)]
                counts = m - np.bincount(np.concatenate(outside), minlength=n)
            else:
                fresh = [o[x:y] for o, x, y in zip(self.order, to_low, low)] + [o[x:y] for o, x, y in zip(self.order, high, to_high)]
                counts += np.bincount(np.concatenate(fresh), minlength=n)
            low, high = to_low, to_high
            found = np.nonzero(counts >= need)[0]
            if len(found) >= enough:
                return found
            # the nearest vector outside of a window, so that each step takes in one at least
            gaps = [a - s[x - 1] for s, a, x in zip(self.sorted, at, low) if x] + [s[y] - a for s, a, y in zip(self.sorted, at, high) if y < n]
            radius = max(radius * GROWTH, min(gaps) * (1 + 1e-9))

    def nearest(self, own: int, query: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
        """Ids and exact distances of the best ``k`` verified candidates."""
        found = self.candidates(query, k)
        found = found[self.ids[found] != own]
        with np.errstate(over="ignore"):
            exact = np.sqrt(((self.vectors[found] - query.astype(np.float64)) ** 2).sum(axis=1))
        best = np.lexsort((self.ids[found], exact))[:k]
        best = np.repeat(best, np.minimum(self.times[found][best], k))[:k]
        return self.ids[found][best], exact[best]


def _search(k: int):
    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        last, chunk = None, None
        for frame in frames:
            for dim, number, ids, vectors, times, own, queries in frame.itertuples(index=False):
                if (dim, number) != last:
                    last, chunk = (dim, number), Chunk(np.asarray(ids, np.int64), np.stack(vectors), np.asarray(times, np.int64))
                out = []
                for one, query in zip(own, queries):
                    found, score = chunk.nearest(int(one), np.asarray(query), k)
                    out.append(pd.DataFrame({"query_id": int(one), "vec_id": found, "score": score}))
                if out:
                    yield pd.concat(out)

    return run


def nearest(df: DataFrame, is_query: Column, k: int = 10, vec_id: str = "vec_id", embedding: str = "embedding", chunk: int = CHUNK, block: int = BLOCK) -> DataFrame:
    """(query_id, rank, vec_id, score): the ``k`` nearest found for each row that ``is_query`` tells."""
    bad = F.exists("v", lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    usable = df.select(F.col(vec_id).cast("long").alias("id"), F.col(embedding).alias("v"), F.coalesce(is_query, F.lit(False)).alias("asks"))
    usable = usable.where(F.col("id").isNotNull() & F.col("v").isNotNull() & ~bad & F.exists("v", lambda x: x != 0))
    usable = usable.withColumn("dim", F.size("v")).groupBy("id", "v").agg(F.first("dim").alias("dim"), F.first("asks").alias("asks"), F.least(F.count("*"), F.lit(k)).alias("times"))
    usable = durable(usable)
    rows, asked = usable.agg(F.count("*"), F.count_if(F.col("asks"))).first()
    chunks, blocks = max(1, math.ceil(rows / chunk)), max(1, math.ceil(asked / block))
    dealt = lambda n, salt: F.pmod(F.xxhash64("id", "v", F.lit(salt)), F.lit(n)).cast("int")
    # a chunk holds about ``chunk`` rows, as the hash deals them out evenly
    index = usable.withColumn("chunk", dealt(chunks, 1)).groupBy("dim", "chunk").agg(F.collect_list("id").alias("ids"), F.collect_list("v").alias("vectors"), F.collect_list("times").alias("times"))
    index = durable(index)
    queries = usable.where("asks").select("id", "v", "dim")
    queries = queries.withColumn("block", dealt(blocks, 2)).groupBy("dim", "block").agg(F.collect_list("id").alias("own"), F.collect_list("v").alias("queries"))
    asked_of = queries.withColumn("chunk", F.explode(F.sequence(F.lit(0), F.lit(chunks - 1))))
    pairs = index.join(asked_of, ["dim", "chunk"]).select("dim", "chunk", "ids", "vectors", "times", "own", "queries")
    found = pairs.mapInPandas(_search(k), "query_id long, vec_id long, score double")
    best = Window.partitionBy("query_id").orderBy("score", "vec_id")
    return found.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")


ship(__name__)

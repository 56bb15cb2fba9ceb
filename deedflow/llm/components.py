"""Connected components of an edge table by alternating large-star and small-star steps.

All state is distributed; only a count and a checksum of the edges come to the driver.  Every step is
written to the shared checkpoint folder, so a lost executor costs no more than the step it was in.  ``labelled``
spares a small table these steps: it is labelled on the driver, and larger ones go to ``connected``.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .runtime import durable

MOST_STEPS = 60
#: Up to so many edges ``labelled`` works on the driver, with 16 bytes an edge.
FEW = 200_000


def _star(pairs: DataFrame, keep: str) -> DataFrame:
    """Hang the neighbours ``v`` of each ``u`` on the least of ``u`` and its neighbours.

    The least neighbour is aggregated before it is joined back, so that a node of very high degree can be
    split like any skewed join key.
    """
    least = pairs.groupBy("u").agg(F.min("v").alias("m")).select(F.col("u").alias("x"), F.least("u", "m").alias("m"))
    return pairs.join(least, F.col("u") == F.col("x")).where(keep)


def _large(edges: DataFrame) -> DataFrame:
    both = edges.select("u", "v").union(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    return _star(both, "v > u and v != m").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()


def _small(edges: DataFrame) -> DataFrame:
    down = edges.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).where("u != v")
    starred = _star(down, "true")
    members = starred.select(F.col("v").alias("u"), F.col("m").alias("v")).union(starred.select("u", F.col("m").alias("v")))
    return members.where("u != v").distinct()


def connected(edges: DataFrame) -> DataFrame:
    """Edges (``u``, ``v``) of longs to (``node``, ``root``): the least node reachable, for all nodes but roots themselves."""
    current = durable(_small(edges))
    seen = None
    for _ in range(MOST_STEPS):
        current = durable(_small(_large(current)))
        row = current.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if seen == tuple(row):
            return current.select(F.col("u").alias("node"), F.col("v").alias("root"))
        seen = tuple(row)
    raise RuntimeError("components did not settle")


def least_reached(u: np.ndarray, v: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The nodes of the edges and the least node that each reaches."""
    nodes, at = np.unique(np.concatenate([u, v]), return_inverse=True)
    label, one, two = np.arange(len(nodes)), at[: len(u)], at[len(u) :]
    while True:
        a, b = label[one], label[two]
        apart = a != b
        if not apart.any():
            return nodes, nodes[label]
        one, two, a, b = one[apart], two[apart], a[apart], b[apart]
        np.minimum.at(label, np.maximum(a, b), np.minimum(a, b))
        while not np.array_equal(label, label[label]):
            label = label[label]


def labelled(edges: DataFrame, few: int = FEW) -> DataFrame:
    """What ``connected`` returns, in one pass on the driver for up to ``few`` edges; ``edges`` are read twice."""
    if edges.count() > few:
        return connected(edges)
    found = edges.select("u", "v").toArrow()
    nodes, roots = least_reached(*(found.column(c).to_numpy().astype(np.int64) for c in ("u", "v")))
    below = nodes != roots
    table = pa.table({"node": pa.array(nodes[below], pa.int64()), "root": pa.array(roots[below], pa.int64())})
    return F.broadcast(edges.sparkSession.createDataFrame(table, "node long, root long"))

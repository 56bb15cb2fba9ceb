"""Tiles by population count: what is skipped, and that nothing is lost by it."""

import numpy as np
import pytest
from deedflow.llm import components, queries, simhash
from pyspark.sql import functions as F

from .test_near_dedup import brute_components


def spread(n=900, seed=1):
    """Fingerprints of all population counts that agree in their lowest bits, so they share a block."""
    rng = np.random.default_rng(seed)
    found = set()
    while len(found) < n:
        bits = rng.choice(np.arange(16, 64), rng.integers(0, 48), replace=False)
        p = sum(1 << int(b) for b in bits)
        found |= {p, p ^ (1 << int(rng.integers(16, 64)))}
    return sorted(found)


def signed(prints):
    return np.array(prints, np.uint64).view(np.int64).tolist()


def test_tile_pairs_are_skipped(spark):
    df = spark.createDataFrame([(p,) for p in signed(spread())], "fp long")
    blocks = df.select("fp", F.bit_count("fp").alias("ones"), F.lit(0).cast("long").alias("block"))
    tiles = simhash.tiles_of(blocks, 40).cache()
    assert tiles.agg(F.sum(F.size("fps"))).first()[0] == df.count() and max(len(r["fps"]) for r in tiles.collect()) < 120
    n, kept = tiles.count(), simhash.tile_pairs(tiles, 3)
    assert 0 < kept.count() < n * (n - 1) // 4
    at = {r["tile"]: (r["low"], r["high"]) for r in tiles.collect()}
    pairs = {(r["tile"], r["tile2"]) for r in kept.collect()}
    for a in at:
        for b in at:
            if a < b and (a, b) not in pairs:
                assert at[b][0] - at[a][1] > 3 or at[a][0] - at[b][1] > 3


@pytest.mark.parametrize("tile", [40, 4096])
def test_links_of_one_block(spark, tile):
    prints = spread(300, 2)
    edges = simhash.links(spark.createDataFrame([(p,) for p in signed(prints)], "fp long"), tile=tile)
    found = {r["node"]: r["root"] for r in components.connected(edges).collect()}
    want = brute_components(dict(zip(signed(prints), prints)))
    group = lambda mapping: {frozenset(k for k, v in mapping.items() if v == r) for r in set(mapping.values())}
    assert group({p: found.get(p, p) for p in want}) == group(want)


def test_strips_are_skipped_in_small_blocks_too():
    prints = np.array(spread(), np.uint64)
    prints = prints[np.argsort(np.bitwise_count(prints), kind="stable")]
    compared = sum((j - i) * (y - x) for i, j, x, y in simhash.strips(prints, prints, 3))
    assert compared < 0.5 * len(prints) ** 2


def test_the_query_goes_through_tiles(spark, sf, monkeypatch):
    seen = []
    real = simhash.tiles_of
    monkeypatch.setattr(simhash, "tiles_of", lambda blocks, tile: seen.append(real(blocks, tile)) or seen[-1])
    want = sorted(map(tuple, queries.op4_simhash_near_dedup(spark, sf).collect()))
    monkeypatch.setattr(simhash.links, "__defaults__", (simhash.RADIUS, 1, None))
    monkeypatch.setattr(simhash.near_duplicates, "__defaults__", (*simhash.near_duplicates.__defaults__[:4], 1, None))
    assert sorted(map(tuple, queries.op4_simhash_near_dedup(spark, sf).collect())) == want
    blocks, tiles = (seen[1].agg(F.count_distinct("block"), F.count("*")).first())
    assert tiles > blocks > 0 and simhash.tile_pairs(seen[1], 3).count() < simhash.tile_pairs(seen[1], 64).count()

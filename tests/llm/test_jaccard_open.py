"""What is left to compare after the homes: every pair once more, but no text once for each block it shares."""

import random

import numpy as np
import pytest
from deedflow.llm import components, jaccard

from .test_jaccard_tiles import brute_groups


@pytest.mark.parametrize("mass", [1 << 30, 2000])
def test_open_rows_cover_every_pair(mass):
    rng = np.random.default_rng(4)
    for n in (2, 3, 10, 60):
        for roots, mets in ((2, 2), (n, n), (n, 3), (3, n), (1, n), (n, 1)):
            key, size = rng.permutation(1000)[:n], rng.integers(1, 900, n)
            root, met = rng.integers(0, roots, n), rng.integers(0, mets, n) + 5000
            met_too, rows = set(), 0
            for visit, tile, some, side in jaccard.open_rows(key, size, root, met, mass):
                side = np.broadcast_to(side, len(some))
                rows += len(some)
                if visit:
                    met_too |= {(int(i), j) for i in some for j in range(n) if met[j] == tile}
                else:
                    met_too |= {(int(i), int(j)) for i, a in zip(some, side) for j, b in zip(some, side) if a != b or a < 0}
            for i in range(n):
                for j in range(n):
                    assert root[i] == root[j] or met[i] == met[j] or (i, j) in met_too or (j, i) in met_too
            assert mass < 1 << 30 or rows <= n


def test_near_copies_that_do_not_link_meet_once(spark, monkeypatch):
    rng, texts = random.Random(11), []
    base = [f"w{i}" for i in range(120)]
    for n in range(200):
        words = list(base)
        for at in rng.sample(range(120), 1 + n % 2):
            words[at] = f"x{rng.randrange(10**9)}"
        texts.append(" ".join(words))
    asked, compared = [], jaccard._compared
    monkeypatch.setattr(jaccard, "_compared", lambda members, *rest: asked.append(members.count()) or compared(members, *rest))
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(3)
    found = {}
    for r in jaccard.near_duplicates(docs, mass=20_000).collect():  # the texts fill three tiles
        found.setdefault(r["root"], set()).add(r["doc_id"])
    assert {frozenset(g) for g in found.values()} == brute_groups(texts)
    assert asked[1] <= 3 * len(texts)


def test_few_edges_on_the_driver(spark):
    rng = np.random.default_rng(9)
    pairs = [(int(a), int(b)) for a, b in rng.integers(-150, 150, (180, 2)) if a != b]
    for some in (pairs, pairs[:1], []):
        edges = spark.createDataFrame(some, "u long, v long")
        assert sorted(map(tuple, components.labelled(edges).collect())) == sorted(map(tuple, components.labelled(edges, few=-1).collect()))

import re

import numpy as np
import pytest
import xxhash
from deedflow.llm import components, queries, simhash
from pyspark.sql import functions as F


def brute_print(text, width=3):
    words = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    if not words:
        return 0
    shingles = [" ".join(words[i : i + width]) for i in range(len(words) - width + 1)] or [" ".join(words)]
    hashes = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def brute_components(prints, radius=3):
    """prints: {id: fingerprint} to {id: least id reachable}."""
    ids = sorted(prints)
    root = {i: i for i in ids}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for n, i in enumerate(ids):
        for j in ids[n + 1 :]:
            if bin(prints[i] ^ prints[j]).count("1") <= radius:
                a, b = find(i), find(j)
                root[max(a, b)] = min(a, b)
    return {i: find(i) for i in ids}


@pytest.mark.parametrize("text", [None, "", " \n", "One", "one two", "A b C d", "x y z " * 700, "É É É é", "a\x1cb \x85 c d"])
def test_fingerprint(text):
    assert simhash.fingerprint(text) == brute_print(text)


def test_query(spark, sf):
    docs = spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text").collect()
    prints = {d: brute_print(t) for d, t in docs}
    got = {r["doc_id"]: r for r in queries.op4_simhash_near_dedup(spark, sf).collect()}
    want = brute_components(prints)
    assert {d: int(r["fingerprint"], 16) for d, r in got.items()} == prints
    assert {d: r["component_id"] for d, r in got.items()} == want


def test_more_bands_for_more_fingerprints():
    assert [simhash.bands_for(n, 3) for n in (0, 10**6, 10**9, 10**11)] == [4, 4, 5, 6]


@pytest.mark.parametrize("tile, bands", [(2, None), (7, 5), (4096, None), (9, 6)])
def test_links_of_clustered_fingerprints(spark, tile, bands):
    rng = np.random.default_rng(tile)
    centres = rng.integers(0, 1 << 63, 6)
    prints = {int(c) ^ sum(1 << int(b) for b in rng.integers(0, 64, rng.integers(0, 4))) for c in centres for _ in range(25)}
    signed = {i: p for i, p in enumerate(sorted(prints))}
    df = spark.createDataFrame([(int(np.uint64(p).astype(np.int64)),) for p in signed.values()], "fp long")
    edges = simhash.links(df, tile=tile, bands=bands)
    found = {r["node"]: r["root"] for r in components.connected(edges).collect()}
    as_signed = lambda p: int(np.uint64(p).astype(np.int64))
    want = brute_components(signed)
    group = lambda mapping: {frozenset(k for k, v in mapping.items() if v == r) for r in set(mapping.values())}
    mine = {as_signed(p): found.get(as_signed(p), as_signed(p)) for p in signed.values()}
    theirs = {as_signed(signed[i]): as_signed(signed[r]) for i, r in want.items()}
    assert group(mine) == group(theirs)


def test_forest_spans_and_is_small():
    a = np.array([0, 1, 3, 7, 7 << 40], np.uint64)
    u, v = simhash.forest(a, a, 1)
    assert len(u) == 3 and set(u.tolist()) | set(v.tolist()) == {0, 1, 3, 7}


def test_odd_rows(odd, none):
    got = simhash.near_duplicates(odd.withColumn("fp", F.lit("clash")).select("doc_id", "text"))
    rows = [(r["doc_id"], r["component_id"]) for r in got.collect()]
    assert len(rows) == 10
    found = dict(rows)
    # null, empty and blank texts are alike; a null id takes the name of its group
    assert found[2] == found[3] == found[7] == 2 and found[None] == found[5] == 5 and found[1] == 1
    assert simhash.near_duplicates(none).count() == 0


def test_components_of_a_long_path(spark):
    n = 300
    edges = spark.range(n - 1).select((F.col("id") * 7919 % n).alias("u"), ((F.col("id") + 1) * 7919 % n).alias("v"))
    found = components.connected(edges).collect()
    assert len(found) == n - 1 and {r["root"] for r in found} == {0}

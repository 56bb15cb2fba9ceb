"""Sharding, templates and trees against plain Python."""

import random
import zlib
from collections import Counter, defaultdict
from pathlib import Path

import numpy as np
import pytest
import xxhash
from deedflow.llm import feistel, quality_gbt, queries, templates

from .test_native import feistel_at


def spark_hash(values, seed=42):
    """xxhash64 of longs and texts, nulls left out, as a signed long."""
    for v in values:
        if v is not None:
            data = v.encode() if isinstance(v, str) else v[0].to_bytes(v[1], "little", signed=True)
            seed = xxhash.xxh64(data, seed & (1 << 64) - 1).intdigest()
    return seed - (1 << 64) if seed >> 63 else seed


def test_the_query_gives_shard_and_slot(spark, sf):
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    wide = {n: 8 if t == "bigint" else 4 for n, t in docs.dtypes}
    long = lambda r, n: None if r[n] is None else (r[n], wide[n])
    rows = []
    for r in docs.collect():
        content = spark_hash([r["text"], r["lang"], r["source"], long(r, "n_chars")])
        order = spark_hash([long(r, "doc_id"), (content, 8)])
        rows.append((order % feistel.BUCKETS, order, r["doc_id"], content))
    n = len(rows)
    want = {}
    for number, (_, _, doc, _) in enumerate(sorted(rows)):
        at = feistel_at(number, n)
        want[doc] = (at % 40, at // 40)
    got = queries.op3_feistel_sharding(spark, sf).collect()
    assert {r["doc_id"]: (r["shard"], r["slot"]) for r in got} == want
    assert {r["law"] for r in got} == {"rows"} and all(r["grown_shard"] is None for r in got)
    sizes = Counter(r["shard"] for r in got)
    assert len(sizes) == 40 and max(sizes.values()) - min(sizes.values()) <= 1


def brute_templates(text, item):
    """(covered windows, longest alignment) of an item of words and numbers without names and units."""
    a, b = text.split(), item.split()
    found = defaultdict(list)
    for i in range(len(b) - 7):
        for j in range(len(a) - 7):
            pairs = list(zip(b[i : i + 8], a[j : j + 8]))
            if sum(x.isdigit() for x, _ in pairs) <= 3 and all(x.isdigit() and y.isdigit() or x == y for x, y in pairs):
                found[j - i].append((i, [(x, y) for x, y in pairs if x.isdigit()]))
    covered, longest = set(), 0
    for some in found.values():
        equal = {i for i, pairs in some if all(x == y for x, y in pairs)}
        names = defaultdict(set)
        for i, pairs in some:
            if i not in equal:
                for x, y in pairs:
                    names[x].add(y)
        at = equal if any(len(v) > 1 for v in names.values()) else {i for i, _ in some}
        covered |= at
        longest = max(longest, len(at))
    return len(covered), longest


def test_templates(spark):
    rng = random.Random(8)
    words = [f"w{chr(97 + i)}{chr(97 + j)}" for i in range(12) for j in range(10)]

    def sentence(n):
        line = rng.choices(words, k=n)
        for at in range(rng.randrange(4, 8), n, 7):
            line[at] = str(rng.randrange(2, 6))
        return line

    items = [sentence(rng.randrange(12, 30)) for _ in range(12)]
    texts = []
    for _ in range(150):
        line = list(rng.choice(items))
        for at, w in enumerate(line):
            if w.isdigit() and rng.random() < 0.5:
                line[at] = str(rng.randrange(2, 6))
            elif rng.random() < 0.04:
                line[at] = "other"
        texts.append(" ".join(sentence(10) + line[rng.randrange(8) :] + sentence(10)))
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    bench = spark.createDataFrame([(i, " ".join(t)) for i, t in enumerate(items)], "item_id long, text string")
    got = {(r["doc_id"], r["item_id"]): (r["n_covered"], r["longest"]) for r in templates.contaminated(docs, bench).collect()}
    want = {}
    for d, t in enumerate(texts):
        for i, item in enumerate(items):
            covered, longest = brute_templates(t, " ".join(item))
            if covered and (covered >= templates.COVER * (len(item) - 7) or longest >= templates.RUN):
                want[d, i] = (covered, longest)
    assert len(want) > 60 and got == want


def test_the_first_split_is_the_best(monkeypatch):
    rng = np.random.default_rng(6)
    x = np.round(rng.standard_normal((400, 3)), 1)
    y = ((x[:, 1] > 0.3) ^ (rng.random(400) < 0.1)).astype(float)
    forest = quality_gbt.grow(x, y)
    b, g, h = forest.binned(x), y.mean() - y, np.full(400, y.mean() * (1 - y.mean()))
    part = lambda m: g[m].sum() ** 2 / (h[m].sum() + quality_gbt.L2)
    gains = {}
    for j in range(3):
        for k in range(b[:, j].max() + 1):
            left = b[:, j] <= k
            if min(left.sum(), (~left).sum()) >= quality_gbt.LEAST:
                gains[j, k] = part(left) + part(~left)
    j, k = int(forest.feature[0, 0]), int(forest.threshold[0, 0])
    assert j == 1 and gains[j, k] == pytest.approx(max(gains.values()))
    left = b[:, j] <= k
    for node, rows in ((1, left), (2, ~left)):
        assert forest.value[0, node] == pytest.approx(-quality_gbt.RATE * g[rows].sum() / (h[rows].sum() + quality_gbt.L2))


def test_quality_beats_a_constant(spark):
    sf = "/root/testdata/sf0.01"
    if not Path(sf).exists():
        pytest.skip("the driver's tables are not here")
    quality = {r["doc_id"]: r["quality"] for r in spark.read.parquet(f"{sf}/labels.parquet").collect()}
    held = [(r["score"], quality[r["doc_id"]], r["predicted"]) for r in queries.op7_quality_gbt(spark, sf).collect() if zlib.crc32(str(r["doc_id"]).encode()) % 5 == 0 and r["doc_id"] in quality]
    good, bad = [s for s, q, _ in held if q], [s for s, q, _ in held if not q]
    assert good and bad
    auc = np.mean([(g > b) + 0.5 * (g == b) for g in good for b in bad])
    right = np.mean([p == q for _, q, p in held])
    assert auc > 0.95 and right > max(len(good), len(bad)) / len(held) + 0.5 * min(len(good), len(bad)) / len(held)


def test_repeated_ids_are_learned_from_once(spark):
    from pyspark.sql import functions as F

    docs = spark.createDataFrame([(i % 40, f"text {i} " + "x" * (i % 40)) for i in range(4000)], "doc_id long, text string")
    labels = spark.createDataFrame([(i, int(i > 20)) for i in range(40)], "doc_id long, quality int")
    seen = []
    real = quality_gbt.grow
    try:
        quality_gbt.grow = lambda x, y: seen.append(len(y)) or real(x, y)
        quality_gbt.fit(docs, labels, F.lit(True), "quality")
    finally:
        quality_gbt.grow = real
    assert seen == [40]

import math
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
from deedflow.llm import language_id, lm_score, ppm, queries, trie
from pyspark.sql import functions as F

TRAIN = [b"hello world the cat", "the dog sat on été".encode(), b"aaaa bbb aab", b""]
ASK = [b"the cat sat", b"zzz?", b"", b"hello", "été".encode(), b"aab the", b"aabb" * 300]


def brute(train, text, order, method):
    """Code length with escapes and exclusion, symbol by symbol."""
    seen = defaultdict(Counter)
    marks = [ppm.BOS] * order
    for t in train:
        b = [*marks, *t, ppm.EOS]
        for i in range(order, len(b)):
            for k in range(order + 1):
                seen[tuple(b[i - k : i])][b[i]] += 1
    b, total = [*marks, *text, ppm.EOS], 0.0
    for i in range(order, len(b)):
        gone, cost = set(), None
        for k in range(order, -1, -1):
            left = {s: n for s, n in seen[tuple(b[i - k : i])].items() if s not in gone}
            n, d = sum(left.values()), len(left)
            if not d:
                continue
            if b[i] in left:
                cost = left[b[i]] / (n + d) if method == "C" else (2 * left[b[i]] - 1) / (2 * n)
                total += math.log10(cost)
                break
            total += math.log10(d / (n + d) if method == "C" else d / (2 * n))
            gone |= set(left)
        if cost is None:
            total += math.log10(1 / (ppm.ALPHABET - len(seen[()])))
    return total


@pytest.mark.parametrize("order", [0, 1, 2, 3])
def test_tables_equal_brute_force(order):
    model = ppm.Model([ppm.grams(ppm.joined(TRAIN)[0]), ppm.grams(ppm.joined(TRAIN[:1])[0])], order=order)
    for column, train in enumerate((TRAIN, TRAIN[:1])):
        assert model.scores(ASK)[:, column] == pytest.approx([brute(train, t, order, "C") for t in ASK], rel=1e-5)


@pytest.mark.parametrize("order", [0, 1, 3, 5, 6])
def test_trie_equals_brute_force(order):
    model = trie.Trie.of(trie.Trie(*trie.grams(trie.joined(TRAIN, order)[0], order, piece=5), order).state())
    assert model.scores(ASK) == pytest.approx([brute(TRAIN, t, order, "D") for t in ASK], rel=1e-5)


def test_lookup():
    keys = np.unique(np.random.default_rng(1).integers(0, 1 << 48, 5000).astype(np.uint64))
    look = trie.Lookup(keys)
    at = look.find(keys)
    assert (look.keys[at] == keys).all() and (look.find(keys + np.uint64(1 << 50)) == -1).all()
    assert len(trie.Lookup(keys[:0]).find(keys)) == len(keys)


def test_untrained_trie():
    model = trie.Trie(np.zeros(0, np.uint64), np.zeros(0, np.int64), 2)
    assert model.scores([b"ab", b""]) == pytest.approx([-3 * math.log10(257), -math.log10(257)])


def base_scores(rows):
    cut = lambda t: re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), t or "")) + [""]
    held = lambda d: zlib.crc32(str("" if d is None else d).encode()) % 7 == 2
    counts = Counter(w for d, t in rows if not held(d) for w in cut(t))
    n, v = sum(counts.values()), len(counts)
    one = lambda t: (len(cut(t)), sum(counts[w] > 0 for w in cut(t)), n, sum(math.log10((counts[w] + 1) / (n + v + 1)) for w in cut(t)))
    return [(d, held(d), *one(t)) for d, t in rows]


def check_scores(got, rows):
    text = lambda r: (str(r[0]), r[2], r[3], round(r[5], 6))
    mine = sorted(((r["doc_id"], r["held_out"], r["n_tokens"], r["n_known"], r["train_tokens"], r["base_score"]) for r in got), key=text)
    for a, b in zip(mine, sorted(base_scores(rows), key=text), strict=True):
        assert a[:5] == b[:5] and a[5] == pytest.approx(b[5], rel=1e-9)
    held = lambda d: zlib.crc32(str("" if d is None else d).encode()) % 7 == 2
    train = [(t or "").encode().lower() for d, t in rows if not held(d)]
    model = trie.Trie(*trie.grams(trie.joined(train, lm_score.ORDER)[0], lm_score.ORDER), lm_score.ORDER)
    want = sorted(zip((str(d) for d, _ in rows), model.scores([(t or "").encode().lower() for _, t in rows]).tolist()))
    assert [x for _, x in want] == pytest.approx([x for _, x in sorted((str(r["doc_id"]), r["score"]) for r in got)], rel=1e-6)


def test_lm_query(spark, sf):
    rows = [tuple(r) for r in spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text").collect()]
    check_scores(queries.op5_ppm_lm_score(spark, sf).collect(), rows)


def test_lm_odd_rows(odd, none):
    from deedflow.llm.runtime import crc32_mod

    rows = [tuple(r) for r in odd.select("doc_id", "text").collect()]
    check_scores(lm_score.score(odd.withColumn("hash", F.lit("clash")), crc32_mod("doc_id", 7) != 2).collect(), rows)
    assert lm_score.score(none, F.lit(True)).count() == 0
    untrained = lm_score.score(odd, F.lit(False)).collect()
    assert len(untrained) == len(rows) and {r["train_tokens"] for r in untrained} == {0} and all(r["n_known"] == 0 for r in untrained)


def test_smaller_tries_when_windows_are_many(spark):
    text = [b"abracadabra alakazam", b"the rain in spain"]
    keys, counts = trie.grams(trie.joined(text, lm_score.ORDER)[0], lm_score.ORDER)
    df = spark.createDataFrame([(int(k), int(n)) for k, n in zip(keys, counts)], "gram long, n long")
    model = lm_score.model_of(df, most=24)
    assert model.order < lm_score.ORDER
    assert model.scores([b"rain abra"]) == pytest.approx([brute(text, b"rain abra", model.order, "D")], rel=1e-5)


def test_packing():
    codes = np.array([0, 1, 65535, 65536, 1 << 20, 7], np.int32)
    assert lm_score.unpacked(lm_score.packed(codes), len(codes)).tolist() == codes.tolist() and len(lm_score.unpacked(b"", 0)) == 0


def test_language_query(spark, sf):
    lang = {r["doc_id"]: r["lang"] for r in spark.read.parquet(f"{sf}/documents.parquet").collect()}
    got = queries.op10_ppm_language_id(spark, sf).collect()
    held = [r for r in got if r["held_out"]]
    assert len(got) == len(lang) and all(r["held_out"] == (zlib.crc32(str(r["doc_id"]).encode()) % 4 == 2) and 0 <= r["score"] <= 1 for r in got)
    assert sum(r["lang_pred"] == lang[r["doc_id"]] for r in held) >= 0.97 * len(held)


def test_language_odd_rows(odd, none):
    names, model = language_id.learn(odd, F.lit(True))
    assert names == ["en", "fr"]
    got = language_id.judge(odd.withColumn("score", F.lit("clash")), names, model).collect()
    by = {(r["doc_id"], r["text"]): (r["lang_pred"], r["score"]) for r in got}
    assert len(got) == 10 and sum(r["lang_pred"] == "und" for r in got) == 4 and all(s == 0 for p, s in by.values() if p == "und")
    assert {r["lang_pred"] for r in got if r["doc_id"] == 1} == {"en"} and {r["lang_pred"] for r in got if r["doc_id"] in (5, None)} == {"fr"}
    assert language_id.learn(none, F.lit(True)) == ([], None)
    assert {r["lang_pred"] for r in language_id.judge(odd, [], None).collect()} == {"und"}
    assert language_id.judge(none, names, model).count() == 0

"""URL rules, sharding and mixing: DataFrame functions only."""

import zlib
from collections import Counter

import pytest
import xxhash
from deedflow.llm import feistel, mixing, queries, url_rules
from pyspark.sql import functions as F

RULES = [url_rules.UrlRule.parse(*r) for r in queries.URL_RULES]


def split(url):
    if url is None or "://" not in url:
        return "", ""
    rest = url.split("://", 1)[1]
    end = min((rest.index(c) for c in "/?#" if c in rest), default=len(rest))
    host, rest = rest[:end], rest[end:]
    stop = min((rest.index(c) for c in "?#" if c in rest), default=len(rest))
    return "".join(c.lower() if "A" <= c <= "Z" else c for c in host), rest[:stop]


def decide(url, rules, default="allow"):
    host, path = split(url)
    fit = [r for r in rules if (host == r.host or host.endswith("." + r.host)) and path.startswith(r.path)]
    best = max(fit, key=lambda r: (len(r.text), len(r.host), r.action == "block", r.text), default=None)
    return host, path, best.text if best else None, best.action if best else default


URLS = [
    None, "", "nothing", "http://", "https://X.Example.ORG/en/148", "http://example.org/en/1?x", "http://notexample.org/en/1", "http://a.example.org/es/1", "http://example.org/es", "https://a.com/fr/1#x",
    "https://a.com/de/", "https://a.com/De/", "https://com/de/1", "https://org", "https://org/", "http://a.org?x=/es/", "a://b://c.org/x", "http://ex\nample.org/es/1", "https://münchen.org/ü", "http://e.org/es/\\Q1",
]


@pytest.mark.parametrize("inline", [512, 0])
def test_urls(spark, inline):
    more = [*RULES, url_rules.UrlRule("block", "münchen.org", "/ü"), url_rules.UrlRule("block", "example.org", "/es/"), url_rules.UrlRule("block", "e.org", "/es/\\Q")]
    df = spark.createDataFrame([(i, u, "taken") for i, u in enumerate(URLS + URLS)], "page_id int, url string, host string")
    got = url_rules.judge_urls(df, more, inline_rules=inline)
    assert sorted(map(tuple, got.select("page_id", "host", "path", "rule", "verdict").collect())) == sorted((i, *decide(u, more)) for i, u in enumerate(URLS + URLS))
    assert url_rules.judge_urls(df.where("false"), more, inline_rules=inline).count() == 0


def test_rules_are_filed_under_their_rarest_whole_token():
    index = url_rules.index_rules(RULES)
    assert {t: sorted(r.text for r in rs) for t, rs in index.items()} == {"org": ["org/"], "es": ["example.org/es/"], "en": ["example.org/en/1"], "fr": ["com/fr/"], "de": ["com/de/"]}
    assert url_rules.index_rules(RULES, {"es": 9, "example": 1, "org": 99})["example"][0].text == "example.org/es/"
    # a prefix may end inside a token, and a wildcard stands for part of one
    assert url_rules.UrlRule("block", "x.com", "/ab*cd/e").tokens() == {"x", "com"}


def test_wildcards_and_defaults(spark):
    df = spark.createDataFrame([("http://x.com/ab12cd/e9",), ("http://x.com/ab/e",)], "url string")
    got = url_rules.judge_urls(df, [url_rules.UrlRule("allow", "x.com", "/ab*cd/e")], default="block").orderBy("url").collect()
    assert [r["verdict"] for r in got] == ["block", "allow"]
    assert url_rules.judge_urls(df, []).where("verdict = 'allow'").count() == 2


def feistel_at(x, n, seed=7):
    """Brute-force permutation in Python."""
    bits = (n - 1).bit_length() if n > 1 else 0
    low, high = bits // 2, bits - bits // 2
    h = lambda v, k: int.from_bytes(xxhash.xxh64(k.to_bytes(8, "little", signed=True), xxhash.xxh64(v.to_bytes(8, "little"), 42).intdigest()).digest(), "big")
    while True:
        a, b = x >> low, x & ((1 << low) - 1)
        for k in range(feistel.ROUNDS):
            if k % 2:
                b ^= h(a, seed + k) & ((1 << low) - 1)
            else:
                a ^= h(b, seed + k) & ((1 << high) - 1)
        x = a << low | b
        if x < n:
            return x


@pytest.mark.parametrize("n", [1, 2, 3, 5, 100, 1000, 1025])
def test_permutation(spark, n):
    df = spark.range(n).withColumn("n", F.lit(n).cast("long")).withColumn("bits", F.expr("if(n <= 1, 0, length(bin(n - 1)))"))
    got = [r[0] for r in df.select(feistel.permuted("id", "n", "bits", 7)).collect()]
    assert sorted(got) == list(range(n)) and got == [feistel_at(i, n) for i in range(n)]


def test_sharding(odd, none):
    keyed = odd.withColumn("shard", F.lit("clash"))
    got = feistel.shard_rows(keyed, 3, ["doc_id", "text"]).collect()
    sizes = Counter(r["shard"] for r in got)
    assert len(got) == 10 and max(sizes.values()) - min(sizes.values()) <= 1
    assert all(sorted(r["slot"] for r in got if r["shard"] == s) == list(range(n)) for s, n in sizes.items())
    again = feistel.shard_rows(keyed.repartition(4), 3, ["doc_id", "text"]).collect()
    key = lambda r: (str(r["doc_id"]), str(r["text"]), r["shard"], r["slot"])
    assert sorted(map(key, got)) == sorted(map(key, again))
    assert feistel.shard_rows(none, 3, ["doc_id"]).count() == 0
    with pytest.raises(ValueError):
        feistel.shard_rows(odd, 0, ["doc_id"])


def test_sharding_query(spark, sf):
    docs = {r["doc_id"]: r["text"] for r in spark.read.parquet(f"{sf}/documents.parquet").collect()}
    got = queries.op3_feistel_sharding(spark, sf).collect()
    assert len(got) == len(docs)
    for r in got:
        data = (docs[r["doc_id"]] or "").encode()
        assert (r["size"], r["text_crc32"]) == (len(data) + 16, zlib.crc32(data))


def fill(sizes, weights, cap=3.0):
    """Targets by repeated resharing."""
    left, open_, out = float(sum(sizes)), set(range(len(sizes))), {}
    while open_:
        level = left / sum(weights[i] for i in open_)
        over = {i for i in open_ if level * weights[i] > cap * sizes[i]}
        for i in over or open_:
            out[i] = cap * sizes[i] if over else level * weights[i]
        left -= sum(out[i] for i in over)
        open_ -= over or open_
    return [out[i] for i in range(len(sizes))]


def test_targets(spark):
    for sizes in ([10, 10, 10], [1, 1000, 5, 0, 70], [7], [3, 1, 1, 500]):
        weights = [(5, 2, 1)[i % 3] for i in range(len(sizes))]
        df = spark.createDataFrame([(chr(97 + i), s) for i, s in enumerate(sizes)], "s string, source_size long")
        got = {r["s"]: r["target"] for r in mixing.source_targets(df, "s", 3.0, (5, 2, 1)).collect()}
        assert [got[chr(97 + i)] for i in range(len(sizes))] == pytest.approx(fill(sizes, weights))


def test_mixing(spark, odd, none):
    got = mixing.mix_sources(odd.withColumn("target", F.lit("clash"))).collect()
    assert len(got) == 10 and all(r["taken"] == r["times"] * r["size"] and 0 <= r["times"] <= 3 for r in got)
    by_source = Counter()
    for r in got:
        by_source[r["source"]] += r["size"]
    assert {r["source"]: r["source_size"] for r in got} == by_source
    assert mixing.mix_sources(none).count() == 0
    with pytest.raises(ValueError):
        mixing.mix_sources(odd, cap=0.5)


def test_mixing_reaches_targets(spark):
    docs = spark.range(6000).select(
        F.col("id").alias("doc_id"), F.concat(F.lit("s"), F.when(F.col("id") % 3 == 0, 0).otherwise(F.col("id") % 7)).alias("source"), F.repeat(F.lit("ab "), (F.col("id") % 50 + 1).cast("int")).alias("text")
    )
    got = mixing.mix_sources(docs).groupBy("source", "target", "source_size").agg(F.sum("taken").alias("taken"), F.max("times").alias("most")).collect()
    assert all(abs(r["taken"] - r["target"]) <= 50 and r["most"] <= 3 for r in got)
    first = sorted(map(tuple, mixing.mix_sources(docs).select("doc_id", "taken").collect()))
    assert first == sorted(map(tuple, mixing.mix_sources(docs.repartition(7)).select("doc_id", "taken").collect()))


def test_weights_favour_clean_documents(spark):
    docs = spark.range(4000).select(F.col("id").alias("doc_id"), F.lit("s").alias("source"), F.when(F.col("id") % 2 == 0, "one two three").otherwise("a# b# c#").alias("text"))
    docs = docs.union(spark.createDataFrame([(9000, "t", "x " * 6000)], "doc_id long, source string, text string"))
    got = mixing.mix_sources(docs, cycle=(1, 5)).where("source = 's'").groupBy(F.col("doc_id") % 2).agg(F.sum("times")).collect()
    taken = {r[0]: r[1] for r in got}
    assert taken[0] > 1.3 * taken[1] > 0


@pytest.mark.parametrize("name", sorted(queries.SQL))
def test_statement(spark, sf, name):
    import duckdb

    con = duckdb.connect()
    for t in ("documents", "pages"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{sf}/{t}.parquet'")
    want = con.execute(queries.SQL[name])
    names = sorted(c[0] for c in want.description)
    order = [c[0] for c in want.description]
    got = queries.QUERIES[name](spark, sf)
    assert sorted(got.columns) == names
    assert sorted((tuple(r[c] for c in names) for r in got.collect()), key=repr) == sorted((tuple(dict(zip(order, r))[c] for c in names) for r in want.fetchall()), key=repr)

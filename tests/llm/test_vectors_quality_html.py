import math
import zlib

import numpy as np
import pytest
from deedflow.llm import collision_ann, html_main, quality_gbt, queries
from pyspark.sql import functions as F


def brute_nearest(vectors, asks, k):
    ids = np.array([i for i, _ in vectors])
    grid = np.array([v for _, v in vectors], float)
    out = {}
    for a in asks:
        d = np.sqrt(((grid - grid[np.nonzero(ids == a)[0][0]]) ** 2).sum(axis=1))
        order = [i for i in np.lexsort((ids, d)) if ids[i] != a][:k]
        out[int(a)] = [(int(ids[i]), float(d[i])) for i in order]
    return out


def test_nearest_query(spark, sf):
    vectors = [(r["vec_id"], r["embedding"]) for r in spark.read.parquet(f"{sf}/embeddings.parquet").collect()]
    want = brute_nearest(vectors, [i for i, _ in vectors if i % 100 == 0], 10)
    got: dict = {}
    for r in queries.op6_collision_ann(spark, sf).orderBy("query_id", "rank").collect():
        got.setdefault(r["query_id"], []).append((r["vec_id"], r["score"]))
    assert set(got) == set(want) and all(len(v) == 10 for v in got.values())
    assert sum(len({i for i, _ in got[q]} & {i for i, _ in want[q]}) for q in want) >= 0.9 * 10 * len(want)
    true = {q: dict((i, s) for i, s in brute_nearest(vectors, [q], len(vectors))[q]) for q in want}
    assert all(s == pytest.approx(true[q][i], rel=1e-12) for q in got for i, s in got[q])


def test_nearest_odd_rows(spark):
    rows = [(0, [1.0, 0.0]), (1, [1.0, 0.0]), (2, [1.0, 0.0]), (3, None), (4, [0.0, 0.0]), (5, [math.nan, 1.0]), (6, [math.inf, 1.0]), (7, [1.0, None]), (8, [0.0, 3.0]), (9, [1.0, 2.0, 3.0]), (None, [1.0, 1.0]), (0, [1.0, 0.0])]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>").withColumn("score", F.lit("clash"))
    got = [tuple(r) for r in collision_ann.nearest(df, F.col("vec_id") % 4 == 0).orderBy("query_id", "rank").collect()]
    assert got == [(0, 1, 1, 0.0), (0, 2, 2, 0.0), (0, 3, 8, pytest.approx(math.sqrt(10))), (8, 1, 0, pytest.approx(math.sqrt(10))), (8, 2, 0, pytest.approx(math.sqrt(10))), (8, 3, 1, pytest.approx(math.sqrt(10))), (8, 4, 2, pytest.approx(math.sqrt(10)))]
    assert collision_ann.nearest(df.where("false"), F.lit(True)).count() == 0
    assert collision_ann.nearest(df, F.lit(False)).count() == 0


def test_nearest_over_several_chunks_and_blocks(spark):
    rng = np.random.default_rng(3)
    vectors = [(i, [float(np.float32(x)) for x in v]) for i, v in enumerate(rng.standard_normal((300, 8)))] + [(300 + i, [0.5] * 8) for i in range(40)]
    df = spark.createDataFrame(vectors, "vec_id long, embedding array<float>")
    got: dict = {}
    for r in collision_ann.nearest(df, F.col("vec_id") % 20 == 0, k=5, chunk=64, block=4).orderBy("query_id", "rank").collect():
        got.setdefault(r["query_id"], []).append(r["vec_id"])
    want = {q: [i for i, _ in v] for q, v in brute_nearest(vectors, [i for i in range(340) if i % 20 == 0], 5).items()}
    assert set(got) == set(want) and sum(len(set(got[q]) & set(want[q])) for q in want) >= 0.9 * 5 * len(want)
    assert got[300] == want[300]


def test_quality_query(spark, sf):
    quality = {r["doc_id"]: r["quality"] for r in spark.read.parquet(f"{sf}/labels.parquet").collect()}
    got = queries.op7_quality_gbt(spark, sf).collect()
    assert len(got) == spark.read.parquet(f"{sf}/documents.parquet").count()
    assert all(r["held_out"] == (zlib.crc32(str(r["doc_id"]).encode()) % 5 == 0) and r["predicted"] == int(r["score"] >= 0.3) and 0 <= r["score"] <= 1 for r in got)
    held = [r for r in got if r["held_out"] and r["doc_id"] in quality]
    assert sum(r["predicted"] == quality[r["doc_id"]] for r in held) >= 0.8 * len(held)


def test_trees_learn_and_traverse():
    rng = np.random.default_rng(0)
    x = rng.standard_normal((3000, 4))
    y = ((x[:, 0] > 0) ^ (x[:, 1] > 0.5)).astype(float)
    forest = quality_gbt.grow(x[:2000], y[:2000])
    scores = forest.scores(x)

    def walk(row):
        total, b = forest.base, [int(np.searchsorted(e, v)) for e, v in zip(forest.edges, row)]
        for t in range(len(forest.feature)):
            node = 0
            for _ in range(quality_gbt.DEPTH):
                node = 2 * node + 1 + int(b[forest.feature[t, node]] > forest.threshold[t, node])
            total += forest.value[t, node]
        return 1 / (1 + math.exp(-total))

    assert scores[:50] == pytest.approx([walk(r) for r in x[:50]])
    assert ((scores[2000:] > 0.5) == y[2000:]).mean() > 0.95


def test_quality_odd_rows(spark, odd, none):
    labels = spark.createDataFrame([(1, 1, 0), (1, 1, 0), (5, 0, 0), (None, 1, 0), (6, None, 0), (99, 0, 0)], "doc_id long, quality int, toxic int")
    forest = quality_gbt.fit(odd, labels, F.lit(True), "quality")
    got = quality_gbt.judge(odd.withColumn("score", F.lit("clash")).select("doc_id", "text", "score"), forest).collect()
    assert len(got) == 10 and all(0 <= r["score"] <= 1 for r in got)
    for some in (labels.where("false"), labels.where("quality = 1")):
        flat = quality_gbt.fit(odd, some, F.lit(True), "quality")
        assert len({r["score"] for r in quality_gbt.judge(odd.select("doc_id", "text"), flat).collect()}) == 1
    assert quality_gbt.judge(none.select("doc_id", "text"), forest).count() == 0


NAV = "<nav><ul><li><a href='/a'>Menu, one, two</a></li></ul></nav>"
PAGES = [
    (None, ""), ("", ""), ("plain &amp; simple", "plain & simple"), ("<p>x", "x"), ("a < b", "a < b"),
    (f"<html><body>{NAV}<article><h1>Title</h1><p>One,  two\n three.<p>Four<br>five</article><footer>&copy; me</footer></body></html>", "Title\nOne, two three.\nFour five"),
    ("<div class='post with-sidebar'><article><p>Kept, really.</p></article></div><div class=sidebar><p>Not, this, one</p></div>", "Kept, really."),
    ("<article><p>Main, text, here.</p></article><section id=comments><article class=comment><p>Nice, long, comment, with, commas</p></article></section>", "Main, text, here."),
    ("<script>if (a < b) { p('</p>') }</script><style>p{}</style><p>ok</p><!-- <p>no</p> -->", "ok"),
    ("<div id=content><p>A paragraph with text, commas, and more of it.</p><ul><li>item<li>other</ul><table><tr><td>1<td>2</table><form><input><p>q</p></form></div><aside>x</aside>", "A paragraph with text, commas, and more of it.\nitem\nother\n1\n2"),
    ("<article><p>&lt;b&gt; &#233;&#x41; &nbsp;x&middot;y &unknown; &amp</p></article>", "<b> éA x·y &unknown; &"),
    ("<div>" * 3000 + "deep" + "</div>" * 3000, "deep"), ("<p title='a>b'>x</p><img src=y><br/>", "x"),
    ("<article><p>" + "long text, " * 50000 + "</p></article>", ("long text, " * 50000).strip()),
]


@pytest.mark.parametrize("page, text", PAGES)
def test_main_text(page, text):
    assert html_main.main_text(page) == text


def test_links_lower_the_score():
    links = "".join(f"<p><a href=/{i}>link text number {i}, and, more</a></p>" for i in range(9))
    page = f"<div id=x>{links}</div><div id=y>" + "<p>Running text, which has commas, is the article.</p>" * 3 + "</div>"
    assert html_main.main_text(page).split("\n") == ["Running text, which has commas, is the article."] * 3


def test_html_query(spark, sf):
    import html
    import re

    def plain(page):
        inner = re.search("<article>(.*)</article>", page, re.S)[1]
        blocks = [re.sub(r"\s+", " ", html.unescape(re.sub("<[^>]*>", "", b))).strip() for b in re.split("</?p>|</?h1>", inner)]
        return "\n".join(b for b in blocks if b)

    pages = {r["page_id"]: r for r in spark.read.parquet(f"{sf}/pages.parquet").collect()}
    got = queries.op8_html_main_text(spark, sf).collect()
    assert len(got) == len(pages)
    for r in got:
        assert r["text"] == plain(pages[r["page_id"]]["html"]) and r["n_chars"] == len(r["text"]) and r["url"] == pages[r["page_id"]]["url"]


def test_html_table(spark):
    df = spark.createDataFrame([(1, None, "clash"), (1, "<p>x</p>", "clash")], "page_id long, html string, text string")
    assert sorted(map(tuple, html_main.extract_main(df).collect())) == [(1, "", 0), (1, "x", 1)]
    assert html_main.extract_main(df.where("false")).count() == 0

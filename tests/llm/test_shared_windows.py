"""Items that share most of their text."""

from deedflow.llm import templates
from pyspark.sql import functions as F

SHARED = "read the following question with care and answer it in one short sentence of plain words only please"


def tail(i):
    return " ".join(f"t{i}{chr(97 + k)}{chr(97 + i % 26)}" for k in range(14))


def test_a_common_preamble_is_not_matched_for_every_item(spark):
    items = spark.createDataFrame([(i, f"{SHARED} {tail(i)}") for i in range(40)], "item_id long, text string")
    texts = [SHARED.replace("please", f"x{i}") + f" other words number{i} here and there" for i in range(50)] + [f"{tail(3)} and more", f"before {SHARED} {tail(7)}"]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    bench = templates.benchmark_windows(items, "item_id", "text").cache()
    totals = bench.groupBy("item_id").agg(F.count_distinct("pos").alias("n_windows"))
    rare = templates._rare(bench, totals, 99, 0.5)
    assert rare.groupBy("hash").agg(F.count("*").alias("n")).agg(F.max("n")).first()[0] == 1
    found = {(r["doc_id"], r["item_id"]) for r in templates.contaminated(docs, items, run=99).collect()}
    # half of an item's windows lie in its own part
    assert {d for d, _ in found} == {51} and (51, 7) in found
    # a run of windows is enough by default, wherever it lies
    assert {(51, i) for i in range(40)} <= {(r["doc_id"], r["item_id"]) for r in templates.contaminated(docs, items).collect()}

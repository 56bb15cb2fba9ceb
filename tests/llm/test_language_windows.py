"""How many sums of windows the counting makes."""

from collections import Counter

import pytest
from deedflow.llm import language_id, trie
from pyspark.sql import functions as F


def brute(rows):
    found = Counter()
    for lang, text in rows:
        line = bytes([trie.BOS]) * 3 + text.encode().lower() + bytes([trie.EOS])
        found.update((lang, int.from_bytes(line[i : i + 4], "big")) for i in range(len(line) - 3))
    return found


@pytest.mark.parametrize("partitions", [2, 60])
def test_sums_do_not_grow_with_the_partitions(spark, partitions):
    rows = [(lang, f"the {lang} {n % 7} and the others of it") for lang in ("a", "b") for n in range(150)]
    picked = spark.createDataFrame(rows, "lang string, text string").withColumn("order", F.xxhash64(F.monotonically_increasing_id(), "text"))
    names = ("spark.sql.shuffle.partitions", "spark.sql.adaptive.coalescePartitions.enabled")
    before = [spark.conf.get(name) for name in names]
    try:
        for name, value in zip(names, (str(partitions), "false")):
            spark.conf.set(name, value)
        summed = language_id.windows(picked.repartition(partitions)).collect()
    finally:
        for name, value in zip(names, before):
            spark.conf.set(name, value)
    want = brute(rows)
    assert sum((Counter({(r["lang"], r["gram"]): r["n"]}) for r in summed), Counter()) == want
    assert len(summed) <= language_id.PARTS * len(want)
    assert max(Counter((r["lang"], r["gram"]) for r in summed).values()) <= language_id.PARTS

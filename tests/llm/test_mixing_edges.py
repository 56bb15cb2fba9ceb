"""Cuts that are found by narrowing ranges, for any weights and for identities that come again."""

from deedflow.llm import mixing
from pyspark.sql import functions as F


def totals(df):
    return {r["source"]: (r["target"], r["taken"]) for r in df.groupBy("source", "target").agg(F.sum("taken").alias("taken")).collect()}


def test_null_identities_reach_the_target(spark):
    docs = spark.range(12000).select(
        F.when(F.col("id") >= 10000, F.col("id")).alias("doc_id"), F.when(F.col("id") < 10000, "a").otherwise("b").alias("source"), F.concat(F.lit("word "), F.col("id").cast("string")).alias("text")
    )
    for target, taken in totals(mixing.mix_sources(docs, edge=64)).values():
        assert abs(taken - target) <= 2


def test_narrowing_changes_nothing(spark):
    docs = spark.range(5000).select(
        F.when(F.col("id") % 4 > 0, F.col("id") % 900).alias("doc_id"), F.concat(F.lit("s"), F.col("id") % 3).alias("source"), F.repeat(F.lit("ab "), (F.col("id") % 31).cast("int")).alias("text"),
        F.exp((F.col("id") % 13).cast("double") - 9).alias("w"), F.col("id").alias("n"),
    )
    want = sorted(map(tuple, mixing.mix_sources(docs, weight=F.col("w")).select("n", "times").collect()))
    assert {t for _, t in want} == {0, 1, 2, 3} or len({t for _, t in want}) > 1
    for edge in (1, 50):
        assert sorted(map(tuple, mixing.mix_sources(docs.repartition(3), weight=F.col("w"), edge=edge).select("n", "times").collect())) == want


def test_known_sizes_spare_the_texts(spark):
    docs = spark.range(500).select(F.col("id").alias("doc_id"), F.lit("s").alias("source"), F.repeat(F.lit("ab "), (F.col("id") % 31).cast("int")).alias("text"))
    docs = docs.union(spark.createDataFrame([(9000, "t", "x " * 3000)], docs.schema))
    narrow = docs.select("doc_id", "source", mixing.word_count(F.col("text")).alias("n"), mixing.clean_weight(F.col("text"), mixing.word_count(F.col("text"))).alias("w"))
    pick = lambda df: sorted(map(tuple, df.select("doc_id", "size", "target", "taken").collect()))
    assert pick(mixing.mix_sources(docs)) == pick(mixing.mix_sources(narrow, size=F.col("n"), weight=F.col("w"), content=F.lit(0)))

import numpy as np
import pytest
from deedflow.operators import evaluate, model
from deedflow.operators.quantiles import exact_quantiles
from pyspark.sql import functions as F

LEVELS = {"low": 0.1, "median": 0.5, "high": 0.9}


@pytest.mark.parametrize("edge", [1, 7, 1000])
def test_ranges_find_the_same_quantiles(spark, edge):
    rng = np.random.default_rng(1)
    rows = [(k, float(v)) for k, n in (("a", 301), ("b", 2), ("c", 1), (None, 50)) for v in rng.lognormal(0, 8, n)] + [("a", 5.0)] * 90 + [("d", None)] + [("b", None)]
    df = spark.createDataFrame(rows, "k string, v double")
    for keys in (["k"], []):
        want = {r[0] if keys else 0: tuple(r)[-3:] for r in exact_quantiles(df, keys, "v", LEVELS).collect()}
        got = {r[0] if keys else 0: tuple(r)[-3:] for r in exact_quantiles(df, keys, "v", LEVELS, in_memory=0, edge=edge).collect()}
        assert got.keys() == want.keys()
        for k, v in want.items():
            assert got[k] == (pytest.approx(v) if v[0] is not None else v)


def test_fit_and_metrics_by_ranges(spark):
    rng = np.random.default_rng(2)
    rows = [(f"a{i % 5}", ["House", "Terraced House", ""][i % 3], float(x)) for i, x in enumerate(rng.lognormal(12, 1, 700))]
    df = spark.createDataFrame(rows, "canonical_area string, property_type string, price double").withColumn("log_price", F.log("price"))
    keyed = df.select(F.col("canonical_area").alias("area"), F.col("property_type").alias("kind"), F.col("log_price").alias("target"))
    pick = lambda g: {(r["level"], r["area"], r["kind"]): (pytest.approx(r["median"]), r["support"]) for r in g.collect()}
    assert pick(model._groups(keyed, 700, in_memory=10)) == pick(model._groups(keyed, 700))
    predicted = model.GroupedMedians.fit(df).predict_many(df, [3, 200])
    assert predicted.count() == 1400
    want = {r["min_group_support"]: r for r in evaluate.metrics(predicted, by=["min_group_support"]).collect()}
    got = {r["min_group_support"]: r for r in evaluate.metrics(predicted, by=["min_group_support"], rows=1400, in_memory=10).collect()}
    assert all(tuple(got[s]) == pytest.approx(tuple(want[s])) for s in (3, 200))
    one = model.GroupedMedians.fit(df).predict(df, 200).agg(F.sum("support_count")).first()[0]
    assert one == predicted.where("min_group_support = 200").agg(F.sum("support_count")).first()[0]

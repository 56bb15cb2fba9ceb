import datetime
import math

import pytest
from deedflow.errors import ModelError, SourceSchemaError
from deedflow.operators import evaluate, model
from deedflow.sources import tables
from pyspark.sql import functions as F


def rows(spark, *some):
    return spark.createDataFrame([(a, k, float(p), math.log(p)) for a, k, p in some], "canonical_area string, property_type string, price double, log_price double")


def test_backoff(spark):
    df = rows(spark, ("Ranelagh", "Terraced House", 1e6), ("Ranelagh", "Terraced House", 1.2e6), (" Ranelagh ", "Terraced House", 1.4e6), ("Dalkey", "House", 2e6))
    fitted = model.GroupedMedians.fit(df)
    ask = rows(spark, ("Ranelagh", "Terraced House", 1), ("Ranelagh", "House", 1), ("Nowhere", "Terraced House", 1), ("Nowhere", "Castle", 1))
    got = [(r["backoff_level"], r["support_count"], round(r["predicted_price"])) for r in fitted.predict(ask, 3).collect()]
    assert got[:3] == [("area_property_type", 3, 1200000), ("area", 3, 1200000), ("property_type", 3, 1200000)]
    assert got[3][:2] == ("global", 4)


def test_model_round_trip(spark, tmp_path):
    fitted = model.GroupedMedians.fit(rows(spark, ("A", "House", 10), ("B", "", 20)))
    fitted.save(str(tmp_path / "m"))
    again = model.GroupedMedians.load(spark, str(tmp_path / "m"))
    assert sorted(map(tuple, fitted.groups.fillna("").collect())) == sorted(map(tuple, again.groups.fillna("").collect()))


def test_empty_fit(spark):
    with pytest.raises(ModelError):
        model.GroupedMedians.fit(rows(spark).limit(0)) if False else model.GroupedMedians.fit(rows(spark, ("A", "House", 1)).where("false"))


def dated(spark, *days):
    return spark.createDataFrame([(d,) for d in days], "day date")


def test_split(spark):
    day = datetime.date
    train, held, cutoff = model.temporal_split(dated(spark, day(2024, 3, 31), day(2023, 3, 28), day(2023, 3, 27), day(2024, 3, 31)), "day", 12)
    assert cutoff == day(2023, 3, 28) and train.count() == 1 and held.count() == 3
    for days, months in (((day(2024, 1, 1), day(2024, 1, 2)), 0), ((day(2024, 1, 1),), 12), ((day(2024, 1, 1), day(2024, 1, 2)), 12)):
        with pytest.raises(ModelError):
            model.temporal_split(dated(spark, *days), "day", months)


def test_confidence_and_metrics(spark):
    df = spark.createDataFrame([(20, "area_property_type"), (8, "area_property_type"), (4, "area_property_type"), (100, "area"), (100, "global")], "n int, level string")
    got = [r[0] for r in df.select(model.confidence(F.col("n"), F.col("level"))).collect()]
    assert got == ["normal_confidence", "low_confidence", "not_enough_comparable_support", "low_confidence", "not_enough_comparable_support"]
    pairs = spark.createDataFrame([(100.0, 110.0, 1.0, 1.5), (200.0, 180.0, 2.0, 2.25)], "price double, predicted_price double, log_price double, predicted_log_price double")
    found = evaluate.checked_metrics(pairs)
    assert found["mae"] == pytest.approx(15.0) and found["mdape"] == pytest.approx(0.1) and found["log_mae"] == pytest.approx(0.375)
    with pytest.raises(ModelError):
        evaluate.checked_metrics(pairs.where("false"))


def test_payload(spark):
    df = spark.createDataFrame([(110.0, 100.0, 20, "area_property_type"), (5.0, 0.0, 1, "global")], "asking_price double, predicted_price double, support_count int, backoff_level string")
    got = model.report_payload(df).collect()
    assert (got[0]["asking_minus_predicted"], got[0]["asking_minus_predicted_pct"]) == (10.0, 0.1) and got[1]["asking_minus_predicted_pct"] is None


def test_training_csv_end_to_end(spark, tmp_path):
    path = tmp_path / "t.csv"
    body = [f"{d:02d}/0{m}/2023,\"{100 + d},000\",Ranelagh,House,no" for m in (1, 2, 9) for d in range(1, 9)] + ["2023-09-30,nan,Ranelagh,House,no", "2023/09/29,5,Ranelagh,House,yes", "01/01/2023,5,Dalkey,Castle,"]
    path.write_text("﻿transaction_date,sale_price_eur,canonical_area,property_type,exclude_from_training\n" + "\n".join(body) + "\n", encoding="utf-8")
    df = tables.load_training_csv(spark, str(path))
    found = evaluate.validate(df, holdout_months=3)
    # Q-01: rows of one day do not clash; Q-05: a price that is no number is left out
    assert (found.train_rows, found.validation_rows, found.backoff_levels) == (16, 8, {"area_property_type": 8})
    assert '"mae"' in tables.as_json(found.as_dict())
    with pytest.raises(SourceSchemaError):
        tables.validate_training(df.drop("property_type"))
    with pytest.raises(SourceSchemaError):
        tables.validate_training(df.where("false"))
    with pytest.raises(SourceSchemaError):
        tables.load_training_csv(spark, str(tmp_path / "t.txt"))

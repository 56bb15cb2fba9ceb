"""Error metrics of predictions, each one aggregation."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import asdict, dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..errors import ModelError
from ..functions import parsing as P
from .model import SUPPORT, GroupedMedians, filter_training_rows, temporal_split
from .quantiles import IN_MEMORY, exact_quantiles


def mae(actual: Column, predicted: Column) -> Column:
    return F.avg(F.abs(actual - predicted))


def mdape(actual: Column, predicted: Column) -> Column:
    """Median absolute percentage error of rows with an actual above zero."""
    return F.median(F.when(actual > 0, F.abs(actual - predicted) / actual))


def log_mae(log_actual: Column, log_predicted: Column) -> Column:
    return F.avg(F.abs(log_actual - log_predicted))


def residual_interval(log_predicted: Column, quantile: Column) -> dict[str, Column]:
    """Bounds of the price from a quantile of absolute log residuals."""
    return {"lower": F.exp(log_predicted - quantile), "upper": F.exp(log_predicted + quantile)}


def metrics(
    df: DataFrame, actual: str = "price", predicted: str = "predicted_price", log_actual: str = "log_price", log_predicted: str = "predicted_log_price",
    by: Sequence[str] = (), rows: int | None = None, in_memory: int = IN_MEMORY,
) -> DataFrame:
    """Rows and errors, of each group if there are keys; ``rows`` of more than ``in_memory`` get their median by ranges."""
    a, p = F.col(actual), F.col(predicted)
    found = [F.count("*").alias("rows"), mae(a, p).alias("mae"), mdape(a, p).alias("mdape"), log_mae(F.col(log_actual), F.col(log_predicted)).alias("log_mae")]
    if rows is None or rows <= in_memory:
        return df.groupBy(*by).agg(*found)
    errors = df.select(*by, F.when(a > 0, F.abs(a - p) / a).alias("error"))
    medians = exact_quantiles(errors, by, "error", {"mdape": 0.5}, rows=rows, in_memory=in_memory)
    summed = df.groupBy(*by).agg(*(c for i, c in enumerate(found) if i != 2))
    joined = summed.join(medians, list(by)) if by else summed.crossJoin(medians)  # one row each
    return joined.select(*by, "rows", "mae", "mdape", "log_mae")


def checked_metrics(df: DataFrame, **names: str) -> dict[str, float]:
    """The metrics as numbers; no rows or no actual above zero is an error."""
    row = metrics(df, rows=df.count(), **names).first()
    if not row["rows"] or row["mdape"] is None:
        raise ModelError("there is nothing to measure")
    return row.asDict()


def backoff_counts(predictions: DataFrame) -> DataFrame:
    return predictions.groupBy("backoff_level").agg(F.count("*").alias("rows"))


def segment_metrics(df: DataFrame, by: Sequence[str], actual: str = "price", predicted: str = "predicted_price") -> DataFrame:
    """Rows and errors of each segment."""
    a, p = F.col(actual), F.col(predicted)
    return df.groupBy(*by).agg(F.count("*").alias("rows"), mae(a, p).alias("mae"), mdape(a, p).alias("mdape"))


def residual_quantiles(df: DataFrame, level: float = 0.8, log_actual: str = "log_price", log_predicted: str = "predicted_log_price") -> DataFrame:
    """One row: the exact quantiles of log residuals that hold the central ``level``."""
    residual = F.col(log_actual) - F.col(log_predicted)
    return exact_quantiles(df.select(residual.alias("residual")), [], "residual", {"low": (1 - level) / 2, "high": (1 + level) / 2})


def with_interval(df: DataFrame, low: float, high: float, log_predicted: str = "predicted_log_price") -> DataFrame:
    return df.withColumns({"lower_price": F.exp(F.col(log_predicted) + F.lit(low)), "upper_price": F.exp(F.col(log_predicted) + F.lit(high))})


def interval_coverage(df: DataFrame, by: Sequence[str] = (), actual: str = "price") -> DataFrame:
    """Share of actual prices inside their interval, and the median width."""
    inside = F.col(actual).between(F.col("lower_price"), F.col("upper_price")).cast("double")
    return df.groupBy(*by).agg(F.count("*").alias("rows"), F.avg(inside).alias("coverage"), F.median(F.col("upper_price") - F.col("lower_price")).alias("median_width"))


def rolling_metrics(df: DataFrame, day: str, holdout_months: int, years: Sequence[int] = (3, 5, 10), support: int = SUPPORT) -> DataFrame:
    """Metrics of the same holdout with training windows of several lengths before it."""
    train, held, cutoff = temporal_split(df, day, holdout_months)
    found = []
    for span in years:
        window = train.where(F.col(day) >= F.lit(cutoff.replace(year=cutoff.year - span)))
        found.append(metrics(GroupedMedians.fit(window).predict(held, support)).withColumn("years", F.lit(span)))
    return reduce(DataFrame.unionByName, found)


@dataclass(frozen=True)
class Validation:
    cutoff: str
    train_rows: int
    validation_rows: int
    mae: float
    mdape: float
    log_mae: float
    backoff_levels: dict[str, int]

    def as_dict(self) -> dict:
        return asdict(self)


def validate(df: DataFrame, holdout_months: int = 12, support: int = SUPPORT, day: str = "transaction_date", **names: str) -> Validation:
    """Filter, split by time, fit, predict and measure."""
    rows = filter_training_rows(df, **names).withColumn(day, P.any_date(F.col(day).cast("string")))
    train, held, cutoff = temporal_split(rows, day, holdout_months)
    predicted = GroupedMedians.fit(train).predict(held, support)
    found = checked_metrics(predicted)
    levels = {r[0]: r[1] for r in backoff_counts(predicted).collect()}  # four rows at most
    return Validation(str(cutoff), train.count(), found["rows"], found["mae"], found["mdape"], found["log_mae"], levels)

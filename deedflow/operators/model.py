"""Grouped-median price model with four levels of backoff.

Fitting is one aggregation with grouping sets; predicting joins three small tables of medians.  Predictions
never fail: the global median answers where no group has enough support.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from functools import cached_property

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..errors import ModelError, require
from ..functions import parsing as P
from ..functions import text as T
from .quantiles import IN_MEMORY, exact_quantiles

LEVELS = ("area_property_type", "area", "property_type", "global")
SUPPORT = 3
#: Groups up to this number are sent to every executor; more are joined by a shuffle.
BROADCAST_GROUPS = 500_000
# Support below which a prediction is not comparable, or of low confidence.
NOT_ENOUGH, LOW = 5, 15


def filter_training_rows(df: DataFrame, include_unknown: bool = True, price: str = "sale_price_eur", kind: str = "property_type", exclude: str = "exclude_from_training") -> DataFrame:
    """Rows to learn from, with ``price`` as a number and ``log_price``: not excluded, of a supported type, of a finite price above zero."""
    kinds = [*P.PROPERTY_TYPES, P.UNKNOWN_TYPE] if include_unknown else list(P.PROPERTY_TYPES)
    require(df, [price, kind], "training filter")
    out = df.withColumns({"price": P.number(F.col(price)), kind: P.clean_property_type(F.col(kind))})
    keep = T.is_true(F.col("price") > 0) & F.col(kind).isin(*kinds)
    if exclude in df.columns:
        keep = keep & ~P.parse_bool(F.col(exclude))
    return out.where(keep).withColumn("log_price", F.log("price"))


def temporal_split(df: DataFrame, day: str, holdout_months: int) -> tuple[DataFrame, DataFrame, object]:
    """Rows before and from the day ``holdout_months`` before the latest one, and that day (of at most 28)."""
    if holdout_months <= 0:
        raise ModelError("the holdout must be one month or more")
    latest, rows = df.agg(F.max(day), F.count(day)).first()
    if rows < 2:
        raise ModelError("a split needs two dated rows or more")
    months = latest.year * 12 + latest.month - 1 - holdout_months
    cutoff = latest.replace(year=months // 12, month=months % 12 + 1, day=min(latest.day, 28))
    train, validation = df.where(F.col(day) < F.lit(cutoff)), df.where(F.col(day) >= F.lit(cutoff))
    before = df.agg(F.count_if(F.col(day) < F.lit(cutoff))).first()[0]
    if not 0 < before < rows:
        raise ModelError(f"one side of the split at {cutoff} is empty")
    return train, validation, cutoff


def _groups(keyed: DataFrame, rows: int, in_memory: int = IN_MEMORY) -> DataFrame:
    """(level, area, kind, median, support) of ``area``, ``kind``, ``target``."""
    if rows <= in_memory:
        sets = keyed.groupingSets([["area", "kind"], ["area"], ["kind"], []], "area", "kind")
        # grouping bits 00, 01, 10, 11 are the levels in order
        level = F.element_at(F.array(*map(F.lit, LEVELS)), (F.grouping("area") * 2 + F.grouping("kind") + 1).cast("int"))
        return sets.agg(level.alias("level"), F.median("target").alias("median"), F.count("*").alias("support"))
    none = F.lit(None).cast("string")
    sides = (("area", "kind"), ("area", none), (none, "kind"), (none, none))
    each = F.array(*(F.struct(F.lit(n).alias("level"), (F.col(a) if isinstance(a, str) else a).alias("area"), (F.col(k) if isinstance(k, str) else k).alias("kind")) for n, (a, k) in zip(LEVELS, sides)))
    levelled = keyed.select("target", F.inline(each))
    keys = ["level", "area", "kind"]
    medians = exact_quantiles(levelled, keys, "target", {"median": 0.5}, rows=rows, in_memory=in_memory)
    support = keyed.groupingSets([["area", "kind"], ["area"], ["kind"], []], "area", "kind").agg(F.count("*").alias("support")).select(F.col("area").alias("a"), F.col("kind").alias("k"), "support")
    return medians.join(support, F.col("area").eqNullSafe(F.col("a")) & F.col("kind").eqNullSafe(F.col("k"))).select(*keys, "median", "support")


@dataclass
class GroupedMedians:
    """A fitted model: one table of (level, area, kind, median, support)."""

    groups: DataFrame
    area: str = "canonical_area"
    kind: str = "property_type"

    @classmethod
    def fit(cls, rows: DataFrame, area: str = "canonical_area", kind: str = "property_type", target: str = "log_price") -> GroupedMedians:
        require(rows, [area, kind, target], "model fit")
        keyed = rows.select(T.trim_ws(F.coalesce(F.col(area), F.lit(""))).alias("area"), P.clean_property_type(F.col(kind)).alias("kind"), F.col(target).alias("target"))
        count = keyed.count()
        if not count:
            raise ModelError("there are no rows to fit")
        return cls(_groups(keyed, count).persist(), area, kind)

    @cached_property
    def many(self) -> bool:
        return self.groups.count() > BROADCAST_GROUPS

    @cached_property
    def overall(self) -> tuple:
        """Level, median and support of all rows: one row, fetched once."""
        return tuple(self.groups.where(F.col("level") == "global").select("level", "median", "support").first())

    def predict(self, rows: DataFrame, support: int = SUPPORT) -> DataFrame:
        """``rows`` with ``predicted_price``, ``predicted_log_price``, ``support_count`` and ``backoff_level``."""
        best = F.col("__best")
        return self._joined(rows, {"__best": support}).withColumns(self._fields(best)).drop("__best")

    def predict_many(self, rows: DataFrame, supports: Sequence[int], name: str = "min_group_support") -> DataFrame:
        """``predict`` for several supports in one pass, a row for each and a column that tells which."""
        joined = self._joined(rows, {f"__best{i}": s for i, s in enumerate(supports)})
        each = F.explode(F.array(*(F.struct(F.lit(s).alias(name), F.col(f"__best{i}").alias("best")) for i, s in enumerate(supports))))
        out = joined.withColumn("__each", each).drop(*(f"__best{i}" for i in range(len(supports))))
        return out.withColumns({name: F.col("__each")[name], **self._fields(F.col("__each")["best"])}).drop("__each")

    @staticmethod
    def _fields(best: Column) -> dict[str, Column]:
        return {"predicted_log_price": best["median"], "predicted_price": F.exp(best["median"]), "support_count": best["support"], "backoff_level": best["level"]}

    def _joined(self, rows: DataFrame, supports: dict[str, int]) -> DataFrame:
        """``rows`` with the group that answers for each support."""
        hint = (lambda t: t) if self.many else F.broadcast
        group = F.struct("level", "median", "support")
        level = lambda name, g, **keys: self.groups.where(F.col("level") == name).select(*(F.col(k).alias(v) for k, v in keys.items()), group.alias(g))
        out = rows.withColumns({"__area": T.trim_ws(F.coalesce(F.col(self.area), F.lit(""))), "__kind": P.clean_property_type(F.col(self.kind))})
        overall = self.overall
        last = F.struct(F.lit(overall[0]).alias("level"), F.lit(overall[1]).alias("median"), F.lit(overall[2]).cast("long").alias("support"))
        out = (
            out.join(hint(level("area_property_type", "g1", area="a1", kind="k1")), (F.col("__area") == F.col("a1")) & (F.col("__kind") == F.col("k1")), "left")
            .join(hint(level("area", "g2", area="a2")), F.col("__area") == F.col("a2"), "left")
            .join(hint(level("property_type", "g3", kind="k3")), F.col("__kind") == F.col("k3"), "left")
        )
        found = {n: F.coalesce(*(F.when(F.col(g)["support"] >= s, F.col(g)) for g in ("g1", "g2", "g3")), last) for n, s in supports.items()}
        return out.withColumns(found).drop("__area", "__kind", "a1", "k1", "g1", "a2", "g2", "k3", "g3")

    def release(self) -> None:
        """Give the cached groups back; they are worked out again if they are asked for."""
        self.groups.unpersist()

    def save(self, path: str) -> None:
        self.groups.coalesce(1).write.mode("overwrite").parquet(path)

    @classmethod
    def load(cls, spark: SparkSession, path: str, area: str = "canonical_area", kind: str = "property_type") -> GroupedMedians:
        return cls(spark.read.parquet(path), area, kind)


def confidence(support: Column, level: Column) -> Column:
    return F.when((level == "global") | (support < NOT_ENOUGH), "not_enough_comparable_support").when((support < LOW) | (level != "area_property_type"), "low_confidence").otherwise("normal_confidence")


def feature_snapshot(area: Column, kind: Column, floor_area: Column) -> dict[str, Column]:
    """The features that training and inference share."""
    trimmed, cleaned = T.trim_ws(F.coalesce(area, F.lit(""))), P.clean_property_type(kind)
    return {"canonical_area": trimmed, "property_type": cleaned, "group_key": F.concat_ws("|", trimmed, cleaned), "size_band": P.size_band(floor_area)}


def report_payload(predictions: DataFrame, asking: str = "asking_price", predicted: str = "predicted_price") -> DataFrame:
    """Asking price against prediction, absolute and as a share of the prediction (null unless that is above zero)."""
    gap = F.col(asking) - F.col(predicted)
    return predictions.withColumns({"asking_minus_predicted": gap, "asking_minus_predicted_pct": F.when(F.col(predicted) > 0, gap / F.col(predicted)), "confidence_state": confidence(F.col("support_count"), F.col("backoff_level"))})

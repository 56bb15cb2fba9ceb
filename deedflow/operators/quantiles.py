"""Exact quantiles of groups of any size.

Spark's exact percentile keeps every distinct value of a group in one task.  Beyond ``IN_MEMORY`` rows the ranks are
found by ranges instead: the values of each group are counted in ``SLICES`` ranges, the range that holds a wanted rank is counted
again, until it has ``EDGE`` rows at most or one value, and only those are ordered.  Both ways give the same numbers: the two
values next to the rank, linearly interpolated.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

IN_MEMORY = 20_000_000
EDGE = 1 << 14
SLICES = 1024
#: A range halves at least once in so many rounds for any two doubles that differ.
MOST_ROUNDS = 200


def exact_quantiles(df: DataFrame, keys: Sequence[str], value: str, levels: dict[str, float], rows: int | None = None, in_memory: int = IN_MEMORY, edge: int = EDGE) -> DataFrame:
    """The keys with a column for each quantile of the non-null values; ``rows`` is the number of rows, if it is known.

    Without keys there is one row, of nulls if there are no values.
    """
    if (df.count() if rows is None else rows) <= in_memory:
        return df.groupBy(*keys).agg(*(F.percentile(value, q).alias(name) for name, q in levels.items()))
    names = [f"g{i}" for i in range(len(keys))]
    values = df.where(F.col(value).isNotNull()).select(*(F.col(k).alias(n) for k, n in zip(keys, names)), F.col(value).cast("double").alias("v"))
    found = _at_ranks(values, names, list(levels.values()), edge)
    wanted = [F.max(F.when(F.col("level") == float(q), F.col("at"))).alias(name) for name, q in levels.items()]
    every = df.select(*keys).distinct() if keys else None
    out = found.groupBy(*names).agg(*wanted)
    if every is None:
        return out
    same = [F.col(k).eqNullSafe(F.col(n)) for k, n in zip(keys, names)]
    return every.join(out, same, "left").select(*keys, *levels)


def _at_ranks(values: DataFrame, names: list[str], levels: list[float], edge: int) -> DataFrame:
    """(names, level, at): the interpolated value at each level of each group."""
    spread = [F.min("v").alias("low"), F.max("v").alias("high"), F.count("*").alias("n")]
    sizes = values.groupBy(*names).agg(*spread)
    rank = (F.col("n") - 1) * F.col("level")
    both = sizes.withColumn("level", F.explode(F.array(*(F.lit(float(q)) for q in levels)))).withColumn("exact", rank)
    # the two ranks between which a level falls; ``rank`` counts from the range's first value
    asked = both.withColumn("rank", F.explode(F.array_distinct(F.array(F.floor("exact"), F.ceil("exact"))))).withColumn("whole", F.col("rank"))
    ranges = asked.select(*names, "level", "exact", "whole", "rank", "low", "high", "n").checkpoint() if _checkpoints(values) else asked
    for _ in range(MOST_ROUNDS):
        if ranges.where((F.col("n") > edge) & (F.col("low") < F.col("high"))).isEmpty():
            break
        rows = _inside(values, ranges, names)
        slice_ = F.when(F.col("low") < F.col("high"), F.least(F.floor((F.col("v") - F.col("low")) / (F.col("high") - F.col("low")) * SLICES), F.lit(SLICES - 1))).otherwise(0)
        query = [*names, "level", "exact", "whole", "rank"]
        slices = rows.groupBy(*query, slice_.alias("slice")).agg(*spread)
        before = Window.partitionBy(*names, "level", "whole").orderBy("slice").rowsBetween(Window.unboundedPreceding, -1)
        # SLICES rows for a rank at most
        placed = slices.withColumn("before", F.coalesce(F.sum("n").over(before), F.lit(0)))
        hit = placed.where((F.col("before") <= F.col("rank")) & (F.col("rank") < F.col("before") + F.col("n")))
        ranges = hit.select(*names, "level", "exact", "whole", (F.col("rank") - F.col("before")).alias("rank"), "low", "high", "n")
        ranges = ranges.checkpoint() if _checkpoints(values) else ranges
    rows = _inside(values, ranges, names).groupBy(*names, "level", "exact", "whole", "rank", "v").agg(F.count("*").alias("n"))
    before = Window.partitionBy(*names, "level", "whole").orderBy("v").rowsBetween(Window.unboundedPreceding, -1)
    placed = rows.withColumn("before", F.coalesce(F.sum("n").over(before), F.lit(0)))
    hit = placed.where((F.col("before") <= F.col("rank")) & (F.col("rank") < F.col("before") + F.col("n")))
    share = F.col("exact") - F.floor("exact")
    weight = F.when(F.col("whole") == F.floor("exact"), 1 - share).otherwise(share)
    return hit.groupBy(*names, "level").agg(F.sum(F.col("v") * weight).alias("at"))


def _checkpoints(df: DataFrame) -> bool:
    """Whether the session has a folder for checkpoints, which shorten the plan of many rounds."""
    return df.sparkSession.sparkContext.getCheckpointDir() is not None


def _inside(values: DataFrame, ranges: DataFrame, names: list[str]) -> DataFrame:
    """The values that lie in a range, with its columns."""
    right = ranges.select(*(F.col(n).alias(f"r_{n}") for n in names), "level", "exact", "whole", "rank", "low", "high")
    same = F.col("v").between(F.col("low"), F.col("high"))
    for n in names:
        same = same & F.col(n).eqNullSafe(F.col(f"r_{n}"))
    # without keys there are two ranges for each level
    return values.join(right if names else F.broadcast(right), same).drop(*(f"r_{n}" for n in names))

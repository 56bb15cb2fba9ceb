"""Audit and profile aggregations.  Each takes one pass over its input; every limit has a total order."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import text as T
from .cleaning import REASONS
from .geography import locked

NULL_LABEL = "<null>"


def _items(array: Column) -> Column:
    """A row for each item, a null for none; callers drop the nulls.

    The inner form of explode makes the optimizer test the array's size in a filter of its own, which works out
    a costly array twice.
    """
    return F.explode_outer(array)


def value_counts(df: DataFrame, column: str, top: int | None = None, by_value: bool = False, null_label: str = NULL_LABEL) -> DataFrame:
    """(value, count), the commonest first, ties by value; or by value."""
    counts = df.groupBy(F.coalesce(F.col(column).cast("string"), F.lit(null_label)).alias("value")).agg(F.count("*").alias("count"))
    ordered = counts.orderBy("value") if by_value else counts.orderBy(F.desc("count"), "value")
    return ordered.limit(top) if top is not None else ordered


def group_counts(df: DataFrame, keys: Sequence[str], order: Sequence[str] = ()) -> DataFrame:
    """Rows of each key, nulls being a key, the largest first."""
    return df.groupBy(*keys).agg(F.count("*").alias("count")).orderBy(F.desc("count"), *(F.asc_nulls_last(k) for k in (order or keys)))


def group_rows_and_ids(df: DataFrame, keys: Sequence[str], ids: str) -> DataFrame:
    return df.groupBy(*keys).agg(F.count("*").alias("rows"), F.count_distinct(ids).alias("groups"))


def duplicate_key_metrics(df: DataFrame, key: str) -> DataFrame:
    """Of keys that occur more than once: how many, their rows, and rows beyond the first of each."""
    repeated = df.groupBy(key).agg(F.count("*").alias("n")).where("n > 1")
    total = lambda c: F.coalesce(F.sum(c), F.lit(0)).cast("long")
    return repeated.agg(F.count("*").alias("duplicate_groups"), total(F.col("n")).alias("rows_in_groups"), total(F.col("n") - 1).alias("rows_beyond_first"))


def repeated_key_rows(df: DataFrame, key: str) -> DataFrame:
    """How many rows repeat a key that was seen before."""
    return df.agg((F.count("*") - F.count_distinct(key)).alias("repeated"))


def token_counts(df: DataFrame, column: str, empty_label: str | None = None) -> DataFrame:
    """(token, count) of pipe-joined texts; rows without a token count under ``empty_label`` if there is one."""
    tokens = T.unpipe(F.col(column))
    if empty_label is not None:
        tokens = F.when(F.size(tokens) == 0, F.array(F.lit(empty_label))).otherwise(tokens)
    return df.select(_items(tokens).alias("token")).where(F.col("token").isNotNull()).groupBy("token").agg(F.count("*").alias("count"))


def reason_summary(df: DataFrame, reasons: str = "exclusion_reasons", primary: str = "exclusion_reason", is_locked: Column | None = None) -> DataFrame:
    """Of each reason: rows for which it comes first, all rows, locked rows, and rows with other reasons too; reasons without rows as well."""
    lock = locked() if is_locked is None else is_locked
    listed = df.select(T.unpipe(F.col(reasons)).alias("all"), F.col(primary).alias("first"), lock.alias("locked"))
    each = listed.select(_items(F.col("all")).alias("reason"), "first", "locked", (F.size("all") > 1).alias("shared")).where(F.col("reason").isNotNull())
    counted = each.groupBy("reason").agg(
        F.count_if(F.col("reason") == F.col("first")).alias("primary_rows"),
        F.count("*").alias("all_rows"),
        F.count_if(F.col("locked")).alias("locked_rows"),
        F.count_if(F.col("shared")).alias("overlap_rows"),
    )
    return with_all(df, counted, "reason", [r for r, _ in REASONS])


def with_all(df: DataFrame, counted: DataFrame, key: str, values: Sequence[str]) -> DataFrame:
    """Counts for all of the listed values, zero where there is no row."""
    # the list is part of the configuration
    table = F.broadcast(df.sparkSession.createDataFrame([(v,) for v in values], f"{key} string"))
    return counted.join(table, key, "right").select(key, *(F.coalesce(F.col(c), F.lit(0)).alias(c) for c in counted.columns if c != key))


def long_profile(df: DataFrame, columns: Sequence[str], token_columns: Sequence[str] = (), scope: Column | None = None) -> DataFrame:
    """(scope, metric, value, count, percent) for all rows and for those in ``scope``, all columns in one pass."""
    inside = locked() if scope is None else T.is_true(scope)
    plain = [F.struct(F.lit(c).alias("metric"), F.coalesce(F.col(c).cast("string"), F.lit("<NULL>")).alias("value")) for c in columns]
    cell = lambda name: lambda token: F.struct(F.lit(name).alias("metric"), token.alias("value"))
    split = [F.transform(T.unpipe(F.col(c)), cell(c)) for c in token_columns]
    cells = F.concat(F.array(*plain), *split) if split else F.array(*plain)
    rows = df.select(inside.alias("inside"), cells.alias("cells"))
    # from here on there is one row for each value and side
    in_scopes = F.explode(F.when(F.col("inside"), F.array(F.lit("all"), F.lit("locked"))).otherwise(F.array(F.lit("all"))))
    counted = (
        rows.select("inside", F.inline_outer("cells"))
        .where(F.col("metric").isNotNull())
        .groupBy("inside", "metric", "value")
        .agg(F.count("*").alias("n"))
        .select(in_scopes.alias("scope"), "metric", "value", "n")
        .groupBy("scope", "metric", "value")
        .agg(F.sum("n").alias("count"))
    )
    totals = df.groupBy(inside.alias("inside")).agg(F.count("*").alias("n")).select(in_scopes.alias("scope"), "n").groupBy("scope").agg(F.sum("n").alias("total"))
    return counted.join(F.broadcast(totals), "scope").select("scope", "metric", "value", "count", (F.col("count") * 100.0 / F.col("total")).alias("percent"))


# The stages of the funnel, each with the number of leading reasons that it rules out.
FUNNEL = (
    ("input", 0), ("valid_target_date", 2), ("market_status", 4), ("resolved_geography", 7),
    ("property_scope", 8), ("multi_property", 9), ("duplicates", 10), ("vat_and_required_fields", 12),
)


def stage_funnel(df: DataFrame, reasons: str = "exclusion_reasons", stages: Sequence[tuple[str, int]] = FUNNEL) -> DataFrame:
    """(step, stage, eligible_rows, excluded_rows): a record leaves at the first stage that rules out one of its reasons."""
    order = [r for r, _ in REASONS]
    listed = T.unpipe(F.col(reasons))
    out = [F.count("*").alias("n")]
    for step, (_, many) in enumerate(stages):
        ruled_out = F.arrays_overlap(listed, F.array(*map(F.lit, order[:many]))) if many else F.lit(False)
        out.append(F.count_if(T.is_true(ruled_out)).alias(f"s{step}"))
    wide = df.agg(*out)
    cells = [
        F.struct(F.lit(step).alias("step"), F.lit(name).alias("stage"), (F.col("n") - F.col(f"s{step}")).alias("eligible_rows"), F.col(f"s{step}").alias("excluded_rows"))
        for step, (name, _) in enumerate(stages)
    ]
    return wide.select(F.inline(F.array(*cells)))


def reason_histogram(df: DataFrame, reasons: str = "exclusion_reasons") -> DataFrame:
    return df.groupBy(F.size(T.unpipe(F.col(reasons))).alias("reasons")).agg(F.count("*").alias("count"))


def reason_combinations(df: DataFrame, reasons: str = "exclusion_reasons", top: int = 20) -> DataFrame:
    several = df.where(F.size(T.unpipe(F.col(reasons))) > 1)
    return several.groupBy(F.col(reasons).alias("combination")).agg(F.count("*").alias("count")).orderBy(F.desc("count"), "combination").limit(top)


def area_coverage(df: DataFrame, areas: Sequence[str], area: str = "canonical_area", day: str = "transaction_date", alias: str = "geography_match_alias", method: str = "geography_match_method") -> DataFrame:
    """Of every listed area, those without rows too: rows, first and last day, distinct aliases, and rows by method."""
    grouped = df.where(F.col(area).isNotNull()).groupBy(F.col(area).alias("area"), F.coalesce(F.col(method), F.lit("none")).alias("m"))
    by_method = grouped.agg(F.count("*").alias("n"), F.min(day).alias("first"), F.max(day).alias("last"), F.collect_set(alias).alias("aliases"))
    mix = F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("m", "n"))), lambda x: F.concat(x["m"], F.lit("="), x["n"].cast("string"))), "|")
    grouped = by_method.groupBy("area").agg(
        F.sum("n").alias("rows"), F.min("first").alias("first_date"), F.max("last").alias("last_date"), F.size(F.array_distinct(F.flatten(F.collect_list("aliases")))).cast("long").alias("aliases"), mix.alias("methods")
    )
    table = F.broadcast(df.sparkSession.createDataFrame([(a,) for a in areas], "area string"))
    joined = grouped.join(table, "area", "right")
    return joined.select("area", F.coalesce("rows", F.lit(0)).alias("rows"), "first_date", "last_date", F.coalesce("aliases", F.lit(0)).cast("long").alias("aliases"), F.coalesce("methods", F.lit("")).alias("methods"))


def percent_of_total(counts: DataFrame, count: str = "count") -> DataFrame:
    """``percent`` of the sum; meant for counts, which are few rows."""
    return counts.withColumn("percent", F.col(count) * 100.0 / F.sum(count).over(Window.partitionBy()))


def rule_evidence(df: DataFrame, families: Mapping[str, Sequence[str]], is_locked: Column | None = None) -> DataFrame:
    """(rule_id, total_rows, locked_rows) of all rules of several pipe-joined columns, rules without a hit too."""
    lock = locked() if is_locked is None else is_locked
    hits = F.concat(*(F.array_distinct(T.unpipe(F.col(c))) for c in families))
    each = df.select(lock.alias("locked"), _items(hits).alias("rule_id")).where(F.col("rule_id").isNotNull())
    counted = each.groupBy("rule_id").agg(F.count("*").alias("total_rows"), F.count_if(F.col("locked")).alias("locked_rows"))
    return with_all(df, counted, "rule_id", [r for rules in families.values() for r in rules])


def null_profile(df: DataFrame) -> DataFrame:
    """(column, type, nulls) of every column in one pass."""
    wide = df.agg(*(F.count_if(F.col(c).isNull()).alias(f"n{i}") for i, c in enumerate(df.columns)))
    cells = [F.struct(F.lit(c).alias("column"), F.lit(t).alias("type"), F.col(f"n{i}").alias("nulls")) for i, (c, t) in enumerate(df.dtypes)]
    return wide.select(F.inline(F.array(*cells)))


def scalar_counts(df: DataFrame, **conditions: Column) -> DataFrame:
    return df.agg(*(F.count_if(T.is_true(c)).alias(name) for name, c in conditions.items()))


def aligned_counts(df: DataFrame, column: str, is_locked: Column | None = None) -> DataFrame:
    """(value, all_rows, locked_rows), values that only one side has with zero on the other."""
    lock = locked() if is_locked is None else T.is_true(is_locked)
    return df.groupBy(F.coalesce(F.col(column).cast("string"), F.lit("<NULL>")).alias("value")).agg(F.count("*").alias("all_rows"), F.count_if(lock).alias("locked_rows"))


def stable_sample(df: DataFrame, rows: int, order: Sequence[str] = ("record_id",)) -> DataFrame:
    return df.orderBy(*(F.asc_nulls_last(c) for c in order)).limit(rows)


def costliest(df: DataFrame, rows: int, price: str = "sale_price_eur_adjusted", key: str = "record_id") -> DataFrame:
    """The highest prices, ties by key."""
    return df.orderBy(F.col(price).desc_nulls_last(), F.col(key).asc_nulls_last()).limit(rows)


def containing(df: DataFrame, column: str, terms: Sequence[str]) -> DataFrame:
    """Rows whose text contains one of the terms, in any case."""
    hit = F.lit(False)
    for term in terms:
        hit = hit | F.contains(F.lower(F.col(column)), F.lit(term.lower()))
    return df.where(T.is_true(hit))

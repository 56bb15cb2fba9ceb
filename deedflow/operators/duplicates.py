"""Four tiers of duplicate-like records, flagged and never dropped.

Sizes and variety are counted over all rows of a key, also those that an earlier tier has claimed.  Group
statistics are aggregated first and joined back, so that a key that very many rows share is pre-aggregated on
the map side and its rows can be split by an adaptive skew join; a window would put them into one task.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..errors import require
from ..functions.hashing import group_id

DUPLICATE_FIELDS = (
    "duplicate_group_id", "duplicate_group_size", "duplicate_status", "duplicate_rule_ids", "duplicate_action", "duplicate_representative_record_id",
)


@dataclass(frozen=True)
class DuplicateKeys:
    """The columns that tell records and tiers apart."""

    record_id: str = "record_id"
    row_number: str = "source_row_number"
    fingerprint: str = "raw_record_fingerprint"
    address: str = "address_normalized"
    publication: Sequence[str] = (
        "address_normalized", "transaction_date", "sale_price_eur_raw", "sale_price_eur_adjusted", "is_full_market_price", "vat_exclusive_flag", "property_description_raw",
    )
    weak: Sequence[str] = ("address_normalized", "transaction_date", "sale_price_eur_adjusted")
    same_day: Sequence[str] = ("transaction_date", "sale_price_eur_adjusted", "is_full_market_price", "vat_exclusive_flag")
    #: What may differ among records of one weak key.
    variants: Sequence[str] = ("sale_price_eur_adjusted", "is_full_market_price", "vat_exclusive_flag", "property_description_raw")

    def all(self) -> set[str]:
        return {self.record_id, self.row_number, self.fingerprint, self.address, *self.publication, *self.weak, *self.same_day, *self.variants}


def _varies(name: str) -> Column:
    """More than one distinct non-null value, in constant memory."""
    return F.coalesce(F.min(name) != F.max(name), F.lit(False))


def with_group(df: DataFrame, keys: Sequence[str], prefix: str, **aggregates: Column) -> DataFrame:
    """Join aggregates of each key's rows back; nulls are equal to each other.

    Only keys of several rows (that vary, if that is asked) are joined; how is left to the sizes that the adaptive plan measures.
    """
    groups = df.groupBy(*keys).agg(F.count("*").alias(f"{prefix}_size"), *(a.alias(f"{prefix}_{n}") for n, a in aggregates.items()))
    groups = groups.where(F.col(f"{prefix}_size") > 1)
    if "varied" in aggregates:
        groups = groups.where(F.col(f"{prefix}_varied"))
    right = groups.select(*(F.col(k).alias(f"{prefix}_key{i}") for i, k in enumerate(keys)), f"{prefix}_size", *(f"{prefix}_{n}" for n in aggregates))
    condition = None
    for i, k in enumerate(keys):
        same = F.col(k).eqNullSafe(F.col(f"{prefix}_key{i}"))
        condition = same if condition is None else condition & same
    return df.join(right, condition, "left").drop(*(f"{prefix}_key{i}" for i in range(len(keys))))


def assess_duplicates(df: DataFrame, keys: DuplicateKeys | None = None) -> DataFrame:
    """``df`` with the duplicate fields.

    Records with many other columns are moved once: the tiers are worked out on the columns that they need and joined back by
    record, of which repeated ones are alike.
    """
    keys = keys or DuplicateKeys()
    require(df, keys.all(), "duplicate assessment")
    if len(df.columns) <= len(keys.all()) + 2:
        return _assessed(df, keys)
    record = [keys.record_id, keys.row_number, keys.fingerprint]
    names = [f"__record{i}" for i in range(len(record))]
    found = _assessed(df.select(*sorted(keys.all())), keys).dropDuplicates(record)
    found = found.select(*(F.col(c).alias(n) for c, n in zip(record, names)), *DUPLICATE_FIELDS)
    same = reduce(and_, (F.col(c).eqNullSafe(F.col(n)) for c, n in zip(record, names)))
    return df.join(found, same).drop(*names)


def _assessed(df: DataFrame, keys: DuplicateKeys) -> DataFrame:
    order = F.struct(F.col(keys.row_number), F.col(keys.record_id))
    out = with_group(df, [keys.fingerprint], "__fp", first=F.min_by(keys.record_id, order))
    out = with_group(out, keys.publication, "__pub", varied=_varies(keys.fingerprint))
    differs = F.lit(False)
    for name in keys.variants:
        differs = differs | _varies(name)
    out = with_group(out, keys.weak, "__weak", varied=differs)
    out = with_group(out, keys.same_day, "__day", varied=_varies(keys.address))
    hit = lambda prefix: F.coalesce(F.col(f"{prefix}_varied"), F.lit(False))
    exact, plausible, unresolved, distinct = F.col("__fp_size").isNotNull(), hit("__pub"), hit("__weak"), hit("__day")
    named = lambda namespace, some: group_id(namespace, {k: F.col(k) for k in some})
    tier = lambda a, b, c, d: F.when(exact, a).when(plausible, b).when(unresolved, c).when(distinct, d)
    kept = F.col(keys.record_id) == F.col("__fp_first")
    return out.withColumns(
        {
            "duplicate_group_id": tier(
                named("exact", [keys.fingerprint]), named("publication", keys.publication), named("unresolved", keys.weak), named("same_day_distinct", keys.same_day)
            ),
            "duplicate_group_size": F.coalesce(tier(*(F.col(f"{p}_size") for p in ("__fp", "__pub", "__weak", "__day"))), F.lit(1)).cast("long"),
            "duplicate_status": F.coalesce(
                tier(*map(F.lit, ("exact_source_duplicate", "plausible_duplicate_publication", "unresolved_duplicate_like", "same_day_distinct_transaction"))), F.lit("not_duplicate_like")
            ),
            "duplicate_rule_ids": F.coalesce(tier(*map(F.lit, ("DUP001", "DUP002", "DUP003", "DUP004"))), F.lit("")),
            "duplicate_action": F.coalesce(
                tier(F.when(F.coalesce(kept, F.lit(False)), "retain_representative").otherwise("auto_exclude"), F.lit("review_only"), F.lit("review_only"), F.lit("none")), F.lit("none")
            ),
            "duplicate_representative_record_id": F.when(exact, F.col("__fp_first")),
        }
    ).drop("__fp_size", "__fp_first", *(f"{p}_{n}" for p in ("__pub", "__weak", "__day") for n in ("size", "varied")))

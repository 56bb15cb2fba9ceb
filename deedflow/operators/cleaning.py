"""Exclusion reasons and quality flags of each record; nothing is dropped."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..errors import require
from ..functions import text as T

CLEANING_FIELDS = ("quality_flags", "exclude_from_training", "exclusion_reason", "exclusion_reasons", "exclusion_rule_ids", "cleaning_assessment_status")
# Reasons in order of precedence, with their rule ids.
REASONS = (
    ("invalid_target", "CLEAN001"),
    ("invalid_date", "CLEAN002"),
    ("non_full_market_transaction", "CLEAN003"),
    ("unresolved_market_price_status", "CLEAN004"),
    ("out_of_scope_geography", "CLEAN005"),
    ("unmatched_geography_unresolved", "CLEAN006"),
    ("ambiguous_geography_unresolved", "CLEAN007"),
    ("excluded_property_type", "CLEAN008"),
    ("multi_property_transaction", "CLEAN009"),
    ("duplicate_unresolved", "CLEAN010"),
    ("unresolved_vat_treatment", "CLEAN011"),
    ("insufficient_required_fields", "CLEAN012"),
)
EVIDENCE = (
    "record_id", "raw_address", "transaction_date", "date_parse_status", "is_future_transaction", "sale_price_eur_adjusted", "price_parse_status",
    "is_full_market_price", "full_market_price_mapping_status", "geo_scope", "geography_match_status", "property_scope_status", "multi_property_action",
    "duplicate_action", "duplicate_status", "vat_mapping_status", "sale_price_adjustment_method",
)
TEXT_FLAGS = ("address_quality_flags", "geography_quality_flags", "property_type_quality_flag")


def _one_of(name: str, *values: str) -> Column:
    return T.is_true(F.col(name).isin(*values))


def reason_conditions() -> dict[str, Column]:
    """The condition of each reason, never null."""
    price = F.col("sale_price_eur_adjusted")
    holds = T.is_true
    conditions = {
        "invalid_target": price.isNull() | ~_one_of("price_parse_status", "parsed") | holds(price <= 0),
        "invalid_date": F.col("transaction_date").isNull() | ~_one_of("date_parse_status", "parsed") | holds(F.col("is_future_transaction")),
        "non_full_market_transaction": holds(~F.col("is_full_market_price")),
        "unresolved_market_price_status": F.col("is_full_market_price").isNull() | ~_one_of("full_market_price_mapping_status", "mapped_full_market", "mapped_not_full_market"),
        "out_of_scope_geography": _one_of("geo_scope", "out_of_scope"),
        "unmatched_geography_unresolved": _one_of("geo_scope", "unknown") & _one_of("geography_match_status", "unmatched", "invalid_address"),
        "ambiguous_geography_unresolved": _one_of("geography_match_status", "ambiguous"),
        "excluded_property_type": _one_of("property_scope_status", "clearly_non_house"),
        "multi_property_transaction": _one_of("multi_property_action", "auto_exclude"),
        "duplicate_unresolved": _one_of("duplicate_action", "auto_exclude"),
        "unresolved_vat_treatment": ~_one_of("vat_mapping_status", "mapped_vat_exclusive", "mapped_vat_inclusive") | _one_of("sale_price_adjustment_method", "unresolved_vat_flag"),
        "insufficient_required_fields": F.col("record_id").isNull() | (T.trim_ws(F.coalesce(F.col("raw_address").cast("string"), F.lit(""))) == ""),
    }
    return {reason: conditions[reason] for reason, _ in REASONS}


def assess_cleaning(df: DataFrame) -> DataFrame:
    require(df, EVIDENCE, "cleaning assessment")
    staged = df.withColumn("__reasons", T.which([(c, r) for r, c in reason_conditions().items()]))
    has = lambda reason: F.array_contains("__reasons", reason)
    flags = T.which(
        [
            (has("invalid_target"), "invalid_target"),
            (has("invalid_date"), "invalid_date"),
            (has("non_full_market_transaction"), "possible_non_market_sale"),
            (has("out_of_scope_geography"), "out_of_scope_area"),
            (_one_of("geography_match_status", "unmatched", "invalid_address"), "unmatched_area"),
            (has("ambiguous_geography_unresolved"), "ambiguous_area"),
            (has("excluded_property_type"), "excluded_property_type"),
            (~has("excluded_property_type"), "unknown_property_type"),
            (has("multi_property_transaction"), "multi_property_auto_exclude"),
            (_one_of("multi_property_action", "review_only"), "possible_multi_property_sale"),
            (~_one_of("duplicate_status", "not_duplicate_like"), "duplicate_like"),
            (_one_of("duplicate_action", "review_only"), "duplicate_review_required"),
            (has("unresolved_vat_treatment"), "unresolved_vat_treatment"),
        ]
    )
    written = [T.unpipe(F.col(c)) for c in TEXT_FLAGS if c in df.columns]
    excluded = F.size("__reasons") > 0
    review = _one_of("multi_property_action", "review_only") | _one_of("duplicate_action", "review_only") | _one_of("property_scope_status", "review_required")
    rules = F.create_map(*(F.lit(x) for pair in REASONS for x in pair))
    return staged.withColumns(
        {
            "quality_flags": T.pipe(F.array_distinct(F.concat(flags, *written))),
            "exclude_from_training": excluded,
            "exclusion_reason": F.get("__reasons", F.lit(0)),
            "exclusion_reasons": T.pipe(F.col("__reasons")),
            "exclusion_rule_ids": T.pipe(F.transform("__reasons", lambda r: rules[r])),
            "cleaning_assessment_status": F.when(excluded, "excluded").when(review, "eligible_with_review").otherwise("eligible"),
        }
    ).drop("__reasons")

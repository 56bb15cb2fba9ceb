"""The stages put together: register, geography, cleaning, audits, model."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..config import areas
from ..operators import cleaning, duplicates, geography, profile, rules
from ..sources import configs, schemas, tables
from ..sources.register import RAW_PREFIX, RegisterConfig, load_register

GEOGRAPHY_ADDED = (*geography.ADDRESS_FIELDS, *geography.GEOGRAPHY_FIELDS)
CLEANING_ADDED = (*rules.MULTI_PROPERTY_FIELDS, *rules.SCOPE_FIELDS, *duplicates.DUPLICATE_FIELDS, *cleaning.CLEANING_FIELDS)


def enrich_geography(df: DataFrame, aliases: Sequence[configs.Alias] | None = None, overrides: Sequence[configs.Override] = ()) -> DataFrame:
    columns = tables.append_only(df.columns, GEOGRAPHY_ADDED)
    mapped = geography.map_areas(geography.normalise_addresses(df), configs.read_aliases() if aliases is None else aliases, overrides)
    return mapped.select(*(F.col(f"`{c}`") for c in columns))


def assess(df: DataFrame, rule_set: Sequence[configs.Rule]) -> DataFrame:
    columns = tables.append_only(df.columns, CLEANING_ADDED)
    flagged = rules.assess_scope(rules.assess_multi_property(df, rule_set))
    assessed = cleaning.assess_cleaning(duplicates.assess_duplicates(flagged))
    return assessed.select(*(F.col(f"`{c}`") for c in columns))


def build(spark: SparkSession, config: RegisterConfig, out: str, aliases_path: str | None = None, overrides_path: str | None = None, rules_path: str | None = None) -> DataFrame:
    """All three stages as Parquet under ``out``, each checked after it was written; the last one is returned."""
    aliases = configs.read_aliases(aliases_path)
    overrides = configs.read_overrides(overrides_path, aliases) if overrides_path else []
    rule_set = configs.read_rules(spark, rules_path or configs.RULES_FILE)
    source = load_register(spark, config)
    steps = (
        ("standardised", lambda _: source, ("record_id", "source_row_number", "date_parse_status")),
        ("geography", lambda df: enrich_geography(df, aliases, overrides), ("geography_match_status", "geo_scope")),
        ("assessed", lambda df: assess(df, rule_set), ("exclude_from_training", "duplicate_status")),
    )
    before: DataFrame | None = None
    columns = [*schemas.CORE, *(c for c in source.columns if c.startswith(RAW_PREFIX))]
    added = {"standardised": (), "geography": GEOGRAPHY_ADDED, "assessed": CLEANING_ADDED}
    for name, make, not_null in steps:
        columns = [*columns, *added[name]]
        made = schemas.check(make(before), columns, name)
        path = f"{out}/{name}/snapshot_date={config.snapshot}"
        tables.write_stage(made, path, columns, mode="overwrite")
        before = schemas.check(tables.validate_stage(spark, path, made, not_null, inherited=before), columns, f"{name} as written")
    return before


def geography_audits(df: DataFrame) -> dict[str, DataFrame]:
    """Extracts and summaries of the geography stage."""
    status = F.col("geography_match_status")
    base = ["record_id", "source_row_number", "raw_address", "county_raw", "address_normalized", *geography.GEOGRAPHY_FIELDS]
    summary = profile.value_counts(df, "address_normalization_status", by_value=True).select(F.lit("status").alias("kind"), "value", "count")
    flags = profile.token_counts(df, "address_quality_flags", "no_flags").select(F.lit("flag").alias("kind"), F.col("token").alias("value"), "count")
    return {
        "unmatched": df.where(status.isin("unmatched", "invalid_address")).select(base),
        "ambiguous": df.where(status == "ambiguous").select(base),
        "overrides": df.where(status == "manual_override").select(base),
        "out_of_scope": df.where(F.col("geo_scope") == "out_of_scope").orderBy("source_row_number").limit(500).select(base),
        "aliases": profile.group_counts(
            df.where(status == "matched"), ["canonical_area", "geography_match_alias", "geography_match_method", "geography_match_priority", "geo_scope"]
        ),
        "addresses": summary.unionByName(flags),
        "coverage": profile.area_coverage(df, list(areas.SCOPE_BY_AREA)),
    }


def cleaning_audits(df: DataFrame, rule_set: Sequence[configs.Rule]) -> dict[str, DataFrame]:
    """Extracts and summaries of the cleaning stage."""
    base = [c for c in df.columns if not c.startswith("source_raw__")]
    tier = F.col("duplicate_status")
    near = df.where(tier.isin("exact_source_duplicate", "plausible_duplicate_publication", "unresolved_duplicate_like"))
    families = {
        "multi_property_rule_ids": [r.rule_id for r in rule_set],
        "property_scope_rule_ids": [*(r for r, _, _ in rules.SCOPE_WORDS), rules.NUMBERED_WORD[0], rules.REVIEW_WORDS[0]],
        "duplicate_rule_ids": ["DUP001", "DUP002", "DUP003", "DUP004"],
        "exclusion_rule_ids": [r for _, r in cleaning.REASONS],
    }
    return {
        "multi_property": df.where(F.col("is_possible_multi_property_sale")).select(base),
        "duplicates": near.unionByName(profile.stable_sample(df.where(tier == "same_day_distinct_transaction"), 500)).select(base),
        "scope_review": df.where(F.col("property_scope_status") != "unresolved_house_or_apartment").select(base),
        "excluded": df.where(F.col("exclude_from_training")).orderBy("exclusion_reason", "record_id").select(base),
        "unresolved_vat": df.where(profile.T.pipe_has(F.col("exclusion_reasons"), "unresolved_vat_treatment")).select(base),
        "rule_evidence": profile.rule_evidence(df, families),
        "duplicate_summary": profile.group_rows_and_ids(df, ["duplicate_status", "duplicate_action"], "duplicate_group_id"),
        "reasons": profile.reason_summary(df),
        "profile": profile.long_profile(
            df, ["cleaning_assessment_status", "exclusion_reason", "geo_scope", "duplicate_status", "property_scope_status", "multi_property_action"], ["quality_flags", "exclusion_reasons"]
        ),
        "funnel": profile.stage_funnel(df),
        "combinations": profile.reason_combinations(df),
    }

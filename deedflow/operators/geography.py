"""Address normalisation and area matching, as one projection without a shuffle."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..config import areas
from ..errors import require
from ..functions import text as T
from ..sources.configs import Alias, Override

ADDRESS_FIELDS = ("address_normalized", "address_match_text", "address_normalization_status", "address_quality_flags")
GEOGRAPHY_FIELDS = (
    "canonical_area", "geo_scope", "geography_match_status", "geography_match_method", "geography_match_alias", "geography_match_priority",
    "geography_candidate_areas", "geography_quality_flags", "matched_aliases", "match_methods", "match_priorities",
)
# Words that say no more than the region, and sizes of what counts as too short or as a locality alone.
BROAD_WORDS = ("DUBLIN", "COUNTY", "CO", "IRELAND")
LEAST_TOKENS, LOCALITY_TOKENS = 2, 3
RESOLVES_FROM, RESOLVES_OVER = 10, 80


def address_columns(raw: Column, tidy: Column, match: Column) -> dict[str, Column]:
    """The four address fields of a raw address, its tidied and its folded form."""
    blank = raw.isNull() | (T.trim_ws(raw) == "")
    mute = ~tidy.rlike("[A-Z0-9]")
    missing = blank | mute
    short = F.size(T.tokens(tidy)) < LEAST_TOKENS
    folded = T.tokens(match)
    numbered = F.exists(folded, lambda t: t.rlike("^[0-9]+$"))
    broad_only = F.size(F.array_except(folded, F.array(*map(F.lit, BROAD_WORDS)))) == 0
    locality = (F.size(folded) > 0) & (F.size(folded) <= LOCALITY_TOKENS) & ~numbered & ~broad_only
    flags = T.which([(blank, "missing_raw_address"), (~blank & mute, "punctuation_only_address"), (~missing & short, "too_short_address"), (~missing & locality, "broad_locality_only")])
    return {
        "address_normalized": F.when(~missing, tidy),
        "address_match_text": F.when(~missing, match),
        "address_normalization_status": F.when(missing, "missing").when(short, "too_short").otherwise("normalized"),
        "address_quality_flags": T.pipe(flags),
    }


def normalise_addresses(df: DataFrame, raw: str = "raw_address") -> DataFrame:
    require(df, [raw], "address normalisation")
    # both forms are worked out once, in projections of their own
    staged = df.withColumn("__tidy", T.normalise(F.col(raw))).withColumn("__match", T.fold(F.col("__tidy")))
    return staged.withColumns(address_columns(F.col(raw), F.col("__tidy"), F.col("__match"))).drop("__tidy", "__match")


def candidates(text: Column, aliases: Sequence[Alias]) -> Column:
    """For each area that is named, its best alias by (priority, alias), as structs that sort by (priority, area)."""
    by_area: dict[str, list[Alias]] = {}
    for alias in sorted(aliases, key=lambda a: (a.priority, a.alias)):
        by_area.setdefault(alias.area, []).append(alias)
    found = []
    for area, some in by_area.items():
        options = []
        for a in some:
            exact = a.match_type == "exact_address"
            hit = T.has_component(text, a.text) if exact else T.has_phrase(text, a.text)
            method = "exact_normalized_alias" if exact else a.match_type
            fields = {"priority": F.lit(a.priority).cast("long"), "area": F.lit(area), "scope": F.lit(a.scope), "method": F.lit(method), "alias": F.lit(a.alias), "text": F.lit(a.text)}
            options.append(F.when(hit, F.struct(*(v.alias(k) for k, v in fields.items()))))
        found.append(F.coalesce(*options))
    return F.array_sort(F.array_compact(F.array(*found)))


def district_only(text: Column) -> Column:
    """Whether the text is the capital, its county or one of its postal districts and nothing else."""
    words = F.split(text, r"(?U)\s+")
    first, second = F.get(words, F.lit(0)), F.get(words, F.lit(1))
    named = (first == areas.CAPITAL) & (second.isNull() | second.rlike(areas.DISTRICT))
    county = (first == "COUNTY") & (second == areas.CAPITAL)
    return T.is_true((F.size(words) <= 2) & (named | county))


def map_areas(df: DataFrame, aliases: Sequence[Alias], overrides: Sequence[Override] = (), record_id: str = "record_id", county: str = "county_raw") -> DataFrame:
    """Append the geography fields.  Overrides win over everything; then come context, blocked names, single and resolved candidates."""
    require(df, [record_id, county, "address_match_text", "address_normalization_status"], "area matching")
    text, place = F.col("address_match_text"), T.fold(T.normalise(F.coalesce(F.col(county).cast("string"), F.lit(""))))
    # the candidates are computed once, in a projection of their own
    staged = df.withColumns({"__named": F.coalesce(candidates(text, aliases), F.array().cast("array<struct<priority:bigint,area:string,scope:string,method:string,alias:string,text:string>>")), "__county": place})
    named, place = F.col("__named"), F.col("__county")
    elsewhere = (place != "") & (place != "DUBLIN")
    context = (place == "DUBLIN") | T.is_true(T.has_phrase(text, areas.CAPITAL))
    blocked_area, phrases = areas.BLOCKED
    authority = F.exists(F.array(*map(F.lit, phrases)), lambda p: F.contains(F.col("address_match_text"), p))
    allowed = F.filter(named, lambda m: ~((m["area"] == blocked_area) & authority))
    staged = staged.withColumns({"__allowed": allowed, "__context": context})
    allowed, context = F.col("__allowed"), F.col("__context")
    invalid = F.col("address_normalization_status").isin("missing", "too_short") | (F.coalesce(text, F.lit("")) == "")
    first, second = F.get(allowed, F.lit(0)), F.get(allowed, F.lit(1))
    several = F.size(allowed) > 1
    resolves = several & (first["priority"] <= RESOLVES_FROM) & (second["priority"] >= RESOLVES_OVER) & F.contains(first["text"], second["text"]) & (first["text"] != second["text"])
    usable = ~invalid & context
    matched = usable & (F.size(allowed) > 0) & (~several | resolves)
    ambiguous = usable & several & ~resolves
    flags = T.which(
        [
            (invalid, "invalid_or_missing_address"),
            (~invalid & (district_only(text) | text.isin(*areas.BROAD_REFERENCES)), "broad_dublin_reference_only"),
            (~invalid & (F.size(named) > 0) & elsewhere, "conflicting_county_context"),
            (~invalid & F.exists(named, lambda m: m["area"].isin(*areas.NON_UNIQUE_AREAS)), "non_unique_locality_name"),
            (~invalid & ~context & (F.size(named) > 0), "canonical_alias_outside_expected_dublin_context"),
            (matched & several, "multiple_candidates_priority_resolved"),
            (ambiguous, "multiple_candidate_areas"),
        ]
    )
    shown = F.when(matched | ambiguous, allowed)
    listed = lambda field: F.coalesce(T.sorted_pipe(F.transform(shown, lambda m: m[field].cast("string"))), F.lit(""))
    fields = {
        "canonical_area": F.when(matched, first["area"]),
        "geo_scope": F.when(matched, first["scope"]).when(~invalid & ~context & elsewhere, "out_of_scope").otherwise("unknown"),
        "geography_match_status": F.when(invalid, "invalid_address").when(matched, "matched").when(ambiguous, "ambiguous").otherwise("unmatched"),
        "geography_match_method": F.when(matched, first["method"]).otherwise("none"),
        "geography_match_alias": F.when(matched, first["alias"]),
        "geography_match_priority": F.when(matched, first["priority"]),
        "geography_candidate_areas": listed("area"),
        "geography_quality_flags": T.sorted_pipe(flags),
        "matched_aliases": listed("alias"),
        "match_methods": listed("method"),
        "match_priorities": listed("priority"),
    }
    out = staged.withColumns(fields).drop("__named", "__county", "__allowed", "__context")
    return apply_overrides(out, overrides, record_id)


def apply_overrides(df: DataFrame, overrides: Sequence[Override], record_id: str = "record_id") -> DataFrame:
    """Replace the geography fields of the records that a reviewer has decided."""
    if not overrides:
        return df
    rows = [(o.record_id, o.area, o.scope) for o in overrides]
    # as many rows as were reviewed by hand
    table = F.broadcast(df.sparkSession.createDataFrame(rows, "__id string, __area string, __scope string"))
    joined = df.join(table, F.col(record_id).cast("string") == F.col("__id"), "left")
    fixed = {
        "canonical_area": F.col("__area"), "geo_scope": F.col("__scope"), "geography_match_status": F.lit("manual_override"), "geography_match_method": F.lit("manual_override"),
        "geography_match_alias": F.lit("manual_override"), "geography_match_priority": F.lit(0).cast("long"), "geography_candidate_areas": F.col("__area"),
        "geography_quality_flags": F.lit("manual_override_applied"), "matched_aliases": F.lit("manual_override"), "match_methods": F.lit("manual_override"), "match_priorities": F.lit("0"),
    }
    return joined.withColumns({k: F.when(F.col("__id").isNotNull(), v).otherwise(F.col(k)) for k, v in fixed.items()}).drop("__id", "__area", "__scope")


def locked(scope: str = "geo_scope", status: str = "geography_match_status") -> Column:
    """Rows of a reviewed area that were matched; rows decided by hand are not counted."""
    return T.is_true(F.col(scope).isin("inference", "training_only") & (F.col(status) == "matched"))

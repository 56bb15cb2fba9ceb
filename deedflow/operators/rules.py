"""Configured multi-property rules and the property scope, each one projection."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from operator import or_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..errors import require
from ..functions import text as T
from ..sources.configs import ACTIONS, SEVERITIES, Rule

MULTI_PROPERTY_FIELDS = (
    "is_possible_multi_property_sale", "multi_property_rule_ids", "multi_property_reason", "multi_property_max_severity", "multi_property_action", "single_dwelling_confidence",
)
SCOPE_FIELDS = ("property_scope_status", "property_scope_rule_ids", "property_scope_reason")
CONFIDENCE = {"none": "high", "review_only": "medium", "auto_exclude": "low"}
# Words that tell a dwelling is no house, and words that leave it open.
SCOPE_WORDS = (("PROP001", ("APARTMENT", "APARTMENTS"), "explicit apartment wording"), ("PROP002", ("FLAT", "FLATS"), "explicit flat wording"))
NUMBERED_WORD = ("PROP003", "APT", "APT abbreviation with an identifier")
REVIEW_WORDS = ("PROP101", ("UNIT", "UNITS"), "ambiguous UNIT wording")


def rule_hit(text: Column, rule: Rule) -> Column:
    pattern = f"(?i){rule.pattern}"
    if rule.matcher == "regex":
        return text.rlike(pattern)
    group = 1 if "(" in rule.pattern.replace(r"\(", "").replace("(?", "") else 0
    return F.size(F.array_distinct(F.regexp_extract_all(text, F.lit(pattern), F.lit(group)))) >= 2


def _greatest(hits: list[tuple[Column, Rule]], attribute: str, ranks: Sequence[str]) -> Column:
    """The highest-ranked value of the attribute among the rules that hit."""
    levels = [F.when(T.is_true(hit), ranks.index(getattr(rule, attribute))).otherwise(0) for hit, rule in hits]
    most = F.greatest(*levels, F.lit(0)) if levels else F.lit(0)
    return F.element_at(F.array(*map(F.lit, ranks)), most + 1)


def assess_multi_property(df: DataFrame, rules: Sequence[Rule], address: str = "address_normalized") -> DataFrame:
    require(df, [address], "multi-property rules")
    text = F.coalesce(F.col(address), F.lit(""))
    # which rules hit is worked out once
    staged = df.withColumn("__hits", T.which([(rule_hit(text, r), r.rule_id) for r in rules]) if rules else F.array().cast("array<string>"))
    hits = [(F.array_contains("__hits", r.rule_id), r) for r in rules]
    action = _greatest(hits, "action", ACTIONS)
    return staged.withColumns(
        {
            "is_possible_multi_property_sale": F.size("__hits") > 0,
            "multi_property_rule_ids": T.pipe(F.col("__hits")),
            "multi_property_reason": T.pipe(T.which([(hit, r.description) for hit, r in hits])) if rules else F.lit(""),
            "multi_property_max_severity": _greatest(hits, "severity", SEVERITIES),
            "multi_property_action": action,
            "single_dwelling_confidence": F.element_at(F.array(*(F.lit(CONFIDENCE[a]) for a in ACTIONS)), F.array_position(F.array(*map(F.lit, ACTIONS)), action).cast("int")),
        }
    ).drop("__hits")


def assess_scope(df: DataFrame, address: str = "address_normalized") -> DataFrame:
    require(df, [address], "property scope")
    text = F.coalesce(F.col(address), F.lit(""))
    words = F.regexp_extract_all(F.upper(text), F.lit(r"(?U)\w+"), 0)
    says = lambda some: F.arrays_overlap(words, F.array(*map(F.lit, some)))
    found = [(says(some), rule_id, reason) for rule_id, some, reason in SCOPE_WORDS]
    rule_id, short, reason = NUMBERED_WORD
    # the word, a space or dot, and what begins like an identifier
    found.append((F.upper(text).rlike(rf"(?U)\b{short}[.\s]+[A-Z0-9]"), rule_id, reason))
    clear = reduce(or_, (hit for hit, _, _ in found))
    rule_id, some, reason = REVIEW_WORDS
    review = says(some) & ~clear
    found.append((review, rule_id, reason))
    return df.withColumns(
        {
            "property_scope_status": F.when(clear, "clearly_non_house").when(review, "review_required").otherwise("unresolved_house_or_apartment"),
            "property_scope_rule_ids": T.pipe(T.which([(hit, rule_id) for hit, rule_id, _ in found])),
            "property_scope_reason": T.pipe(T.which([(hit, reason) for hit, _, reason in found])),
        }
    )

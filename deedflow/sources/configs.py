"""Readers of the small reviewed tables: aliases, overrides and rules.  They are checked on the driver and become literals of the plan."""

from __future__ import annotations

import csv
import re
from dataclasses import dataclass
from pathlib import Path

from pyspark.sql import SparkSession
from pyspark.sql import functions as F

from ..config import areas
from ..errors import GeographyConfigError, RuleConfigError
from ..functions.text import match_text

MATCH_TYPES = ("exact_address", "controlled_phrase", "token_phrase")
MATCHERS = ("regex", "multiple_named_blocks")
SEVERITIES = ("none", "low", "medium", "high")
ACTIONS = ("none", "review_only", "auto_exclude")
ALIAS_COLUMNS = ("canonical_area", "alias", "scope", "match_type", "match_priority", "notes")
OVERRIDE_COLUMNS = ("record_id", "canonical_area", "geo_scope", "override_reason", "reviewed_by", "review_date", "notes")
RULE_COLUMNS = ("rule_id", "description", "matcher", "pattern", "severity", "action", "rationale", "false_positive_risk")
RULES_FILE = Path(__file__).parent.parent / "config" / "multi_property_rules.csv"


@dataclass(frozen=True)
class Alias:
    area: str
    alias: str
    scope: str
    match_type: str
    priority: int

    @property
    def text(self) -> str:
        return match_text(self.alias)


@dataclass(frozen=True)
class Override:
    record_id: str
    area: str
    scope: str


@dataclass(frozen=True)
class Rule:
    rule_id: str
    description: str
    matcher: str
    pattern: str
    severity: str
    action: str


def _rows(path: str | Path) -> list[dict[str, str]]:
    with Path(path).open(encoding="utf-8-sig", newline="") as handle:
        return list(csv.DictReader(handle))


def _lacking(rows: list[dict[str, str]], columns: tuple[str, ...]) -> list[str]:
    return sorted(set(columns) - set(rows[0]))


def read_aliases(path: str | Path | None = None, scopes: dict[str, str] | None = None) -> list[Alias]:
    """Aliases by (priority, area, text).  ``scopes`` names the areas there have to be (the reviewed ones by default)."""
    scopes = areas.SCOPE_BY_AREA if scopes is None else scopes
    rows = areas.alias_rows() if path is None else _rows(path)
    if not rows:
        raise GeographyConfigError("the alias table is empty")
    if lacking := _lacking(rows, ALIAS_COLUMNS):
        raise GeographyConfigError(f"the alias table lacks {', '.join(lacking)}")
    found = []
    for number, row in enumerate(rows, start=2):
        area, alias, scope, kind = (row[c].strip() for c in ("canonical_area", "alias", "scope", "match_type"))
        if area not in scopes:
            raise GeographyConfigError(f"row {number}: unknown area {area}")
        if scope != scopes[area]:
            raise GeographyConfigError(f"row {number}: {area} has scope {scopes[area]}, not {scope}")
        if kind not in MATCH_TYPES:
            raise GeographyConfigError(f"row {number}: unknown match type {kind}")
        if not alias:
            raise GeographyConfigError(f"row {number}: no alias")
        if not re.fullmatch(r"\s*[+-]?\d+\s*", row["match_priority"]):
            raise GeographyConfigError(f"row {number}: the priority is no whole number: {row['match_priority']}")
        found.append(Alias(area, alias, scope, kind, int(row["match_priority"])))
    if absent := sorted(set(scopes) - {a.area for a in found}):
        raise GeographyConfigError(f"areas without an alias: {', '.join(absent)}")
    return sorted(found, key=lambda a: (a.priority, a.area, a.text))


def read_overrides(path: str | Path, aliases: list[Alias]) -> list[Override]:
    """Reviewed overrides; a missing file or one without rows means none."""
    rows = _rows(path) if Path(path).exists() else []
    if not rows:
        return []
    if lacking := _lacking(rows, OVERRIDE_COLUMNS):
        raise GeographyConfigError(f"the override table lacks {', '.join(lacking)}")
    scopes = {a.area: a.scope for a in aliases}
    found: dict[str, Override] = {}
    for number, row in enumerate(rows, start=2):
        key, area, scope = (row[c].strip() for c in ("record_id", "canonical_area", "geo_scope"))
        if not key:
            continue
        if area not in scopes:
            raise GeographyConfigError(f"row {number}: unknown area {area}")
        if scope != scopes[area]:
            raise GeographyConfigError(f"row {number}: {area} has scope {scopes[area]}, not {scope}")
        new = Override(key, area, scope)
        if found.setdefault(key, new) != new:
            raise GeographyConfigError(f"row {number}: conflicting overrides for {key}")
    return list(found.values())


def read_rules(spark: SparkSession, path: str | Path = RULES_FILE) -> list[Rule]:
    """Rules by their id; patterns must compile where they will run, in the JVM."""
    rows = _rows(path)
    if not rows:
        raise RuleConfigError("the rule table is empty")
    if lacking := _lacking(rows, RULE_COLUMNS):
        raise RuleConfigError(f"the rule table lacks {', '.join(lacking)}")
    found: dict[str, Rule] = {}
    for number, row in enumerate(rows, start=2):
        rule = Rule(*(row[c].strip() for c in ("rule_id", "description", "matcher", "pattern", "severity", "action")))
        if not rule.rule_id or rule.rule_id in found:
            raise RuleConfigError(f"row {number}: the id is empty or repeated: {rule.rule_id!r}")
        if rule.matcher not in MATCHERS or rule.severity not in SEVERITIES[1:] or rule.action not in ACTIONS[1:]:
            raise RuleConfigError(f"row {number}: unknown matcher, severity or action")
        found[rule.rule_id] = rule
    for rule in found.values():
        try:
            spark.range(1).where(F.lit("x").rlike(f"(?i){rule.pattern}")).count()
        except Exception as error:
            raise RuleConfigError(f"{rule.rule_id}: the pattern does not compile") from error
    return [found[k] for k in sorted(found)]

"""Typed parsing of source text.  Bad text gives null and a status, never an error."""

from __future__ import annotations

from collections.abc import Mapping
from decimal import Decimal

from pyspark.sql import Column
from pyspark.sql import functions as F

from .text import is_true, trim_ws

# The register's descriptions and what they mean (kind, whether newly built).
DESCRIPTIONS: Mapping[str, tuple[str, bool]] = {
    "Second-Hand Dwelling house /Apartment": ("second_hand_dwelling", False),
    "New Dwelling house /Apartment": ("new_dwelling", True),
    "Teach/Árasán Cónaithe Atháimhe": ("second_hand_dwelling", False),
    "Teach/Árasán Cónaithe Nua": ("new_dwelling", True),
    "Teach/?ras?n C?naithe Nua": ("new_dwelling", True),
}
HOUSE_VAT_RATE = Decimal("0.135")
# Property types a model is trained on.
PROPERTY_TYPES = ("House", "Detached House", "Semi-Detached House", "Terraced House", "End of Terrace House")
UNKNOWN_TYPE = "unknown"
MONEY = "decimal(18,2)"


def _is_blank(c: Column) -> Column:
    return c.isNull() | (trim_ws(c) == "")


def day_first_date(c: Column) -> Column:
    return F.try_to_date(c, "d/M/yyyy")


def date_status(c: Column) -> Column:
    return F.when(day_first_date(c).isNotNull(), "parsed").when(_is_blank(c), "missing").otherwise("invalid")


def is_future(day: Column, snapshot: Column) -> Column:
    return day > snapshot


def any_date(c: Column) -> Column:
    """ISO, day-first or year-first with slashes; null for anything else."""
    t = trim_ws(c)
    return F.coalesce(F.try_to_date(t, "yyyy-MM-dd"), F.try_to_date(t, "d/M/yyyy"), F.try_to_date(t, "yyyy/M/d"))


def price(c: Column) -> Column:
    """Euro text to cents, rounded half up; null where it is no finite number."""
    return F.regexp_replace(trim_ws(c), "[€,]", "").try_cast(MONEY)


def price_status(c: Column) -> Column:
    value = price(c)
    return F.when(_is_blank(c), "missing").when(value.isNull(), "invalid").when(value <= 0, "non_positive").otherwise("parsed")


def _answer(c: Column) -> Column:
    return F.lower(trim_ws(c))


def full_market(c: Column) -> Column:
    """The source asks whether a price is *not* the full market price."""
    return F.when(_answer(c) == "no", True).when(_answer(c) == "yes", False)


def full_market_status(c: Column) -> Column:
    return F.when(_is_blank(c), "missing").when(_answer(c) == "no", "mapped_full_market").when(_answer(c) == "yes", "mapped_not_full_market").otherwise("unrecognised")


def vat_exclusive(c: Column) -> Column:
    return F.when(_answer(c) == "yes", True).when(_answer(c) == "no", False)


def vat_status(c: Column) -> Column:
    return F.when(_is_blank(c), "missing").when(_answer(c) == "yes", "mapped_vat_exclusive").when(_answer(c) == "no", "mapped_vat_inclusive").otherwise("unrecognised")


def vat_adjusted(raw: Column, status: Column, exclusive: Column, rate: Decimal = HOUSE_VAT_RATE) -> dict[str, Column]:
    """The rate applied, the adjusted price and the method."""
    usable = is_true(status == "parsed")
    factor = F.lit(rate).cast("decimal(5,3)")
    return {
        "vat_rate_applied": F.when(usable & is_true(exclusive), factor).when(usable & is_true(~exclusive), F.lit(Decimal(0)).cast("decimal(5,3)")),
        "sale_price_eur_adjusted": F.when(usable & is_true(exclusive), (raw * (F.lit(Decimal(1)) + factor)).cast(MONEY)).when(usable & is_true(~exclusive), raw),
        "sale_price_adjustment_method": F.when(~usable, "invalid_raw_price")
        .when(exclusive.isNull(), "unresolved_vat_flag")
        .when(exclusive, "provisional_house_vat_13_5_percent")
        .otherwise("none"),
    }


def description(c: Column, mapping: Mapping[str, tuple[str, bool]] = DESCRIPTIONS) -> dict[str, Column]:
    """Exact look-up: the kind, whether newly built, and how it was mapped."""
    kind, new = F.lit(None).cast("string"), F.lit(None).cast("boolean")
    for text, (k, n) in mapping.items():
        kind, new = F.when(c == text, k).otherwise(kind), F.when(c == text, n).otherwise(new)
    method = F.when(kind.isNotNull(), "exact_source_value_mapping").when(_is_blank(c), "missing").otherwise("unrecognised")
    return {"property_description_normalized": F.coalesce(kind, F.lit("unknown")), "property_description_mapping_method": method, "is_new_build": new}


def parse_bool(c: Column) -> Column:
    """1, true, yes and y in any case are true, everything else and null is false."""
    return is_true(F.lower(trim_ws(c.cast("string"))).isin("1", "true", "yes", "y"))


def clean_property_type(c: Column) -> Column:
    return F.coalesce(F.nullif(trim_ws(c), F.lit("")), F.lit(UNKNOWN_TYPE))


def number(c: Column) -> Column:
    """Text with thousands commas to a finite double, else null."""
    value = F.replace(trim_ws(c.cast("string")), F.lit(","), F.lit("")).try_cast("double")
    return F.when(~F.isnan(value) & (F.abs(value) != float("inf")), value)


def size_band(area: Column) -> Column:
    return F.when(area.isNull(), "unknown").when(area < 90, "small").when(area < 140, "medium").when(area < 200, "large").otherwise("very_large")

"""Declared columns and types of the stages' tables."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame

from ..errors import PhysicalSchemaError

# The standardised columns in order, and the types of all columns that are not text.
CORE = (
    "source_name source_snapshot_date source_file_sha256 source_row_number record_id raw_record_fingerprint transaction_date_raw transaction_date "
    "transaction_year date_parse_status is_future_transaction raw_address county_raw eircode_raw sale_price_eur_raw_text sale_price_eur_raw "
    "price_parse_status not_full_market_price_raw is_full_market_price full_market_price_mapping_status vat_exclusive_raw vat_exclusive_flag "
    "vat_mapping_status vat_rate_applied sale_price_eur_adjusted sale_price_adjustment_method property_description_raw "
    "property_description_normalized property_description_mapping_method is_new_build property_type property_type_source "
    "property_type_quality_flag property_size_description_raw property_size_bucket_source floor_area_sqm"
).split()
TYPES = {
    "date": "source_snapshot_date transaction_date",
    "bigint": "source_row_number transaction_year geography_match_priority duplicate_group_size",
    "boolean": "is_future_transaction is_full_market_price vat_exclusive_flag is_new_build is_possible_multi_property_sale exclude_from_training",
    "decimal(18,2)": "sale_price_eur_raw sale_price_eur_adjusted",
    "decimal(5,3)": "vat_rate_applied",
    "double": "floor_area_sqm",
}
_TYPE_OF = {name: kind for kind, names in TYPES.items() for name in names.split()}


def declared(columns: Sequence[str]) -> list[tuple[str, str]]:
    """The columns with their types; what is not named is text."""
    return [(c, _TYPE_OF.get(c, "string")) for c in columns]


def check(df: DataFrame, columns: Sequence[str], stage: str) -> DataFrame:
    """``df``, whose columns and types must be the declared ones in order."""
    want, got = declared(columns), df.dtypes
    if want != got:
        wrong = [f"{g or 'nothing'} in place of {w or 'nothing'}" for w, g in zip([*want, *[None] * len(got)], [*got, *[None] * len(want)]) if w != g]
        raise PhysicalSchemaError(f"{stage}: {'; '.join(wrong[:5])}")
    return df

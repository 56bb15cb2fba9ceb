"""Content identifiers: SHA-256 of compact JSON arrays."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

NULL = "<NULL>"


def stable_hash(*parts: Column) -> Column:
    return F.sha2(F.to_json(F.array(*(p.cast("string") for p in parts))), 256)


def record_id(source: Column, file_hash: Column, row_number: Column) -> Column:
    """Hash of [source, file hash, row number], the number unquoted."""
    text = F.concat(F.to_json(F.array(source, file_hash)), F.lit(""))
    return F.sha2(F.concat(F.regexp_replace(text, r"\]$", ","), row_number.cast("string"), F.lit("]")), 256)


def fingerprint(columns: dict[str, Column]) -> Column:
    """Hash of all [name, value] pairs in the order of the names, so that column order does not matter; null counts as empty."""
    pairs = [F.array(F.lit(name), F.coalesce(value.cast("string"), F.lit(""))) for name, value in sorted(columns.items())]
    return F.sha2(F.to_json(F.array(*pairs)), 256)


def group_id(namespace: str, keys: dict[str, Column]) -> Column:
    """Hash of the namespace and the key's texts; nulls have a text of their own."""
    return stable_hash(F.lit(namespace), *(F.coalesce(k.cast("string"), F.lit(NULL)) for k in keys.values()))

"""Errors raised on the driver before any work starts, or when a written table fails its checks."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import DataFrame


class DeedflowError(ValueError):
    pass


class SourceSchemaError(DeedflowError):
    """The header of a source file is not acceptable."""


class SourceDecodeError(DeedflowError):
    """A source file holds bytes that its encoding does not define."""


class PhysicalSchemaError(DeedflowError):
    """A stage's table does not have the documented columns, types or rows."""


class GeographyConfigError(DeedflowError):
    """The alias or override table is not acceptable."""


class RuleConfigError(DeedflowError):
    """The rule table is not acceptable."""


class MissingEvidenceError(DeedflowError):
    """An operator's input lacks columns that it needs."""


class ModelError(DeedflowError):
    """A model has nothing to learn from or is used before it is fitted."""


def require(df: DataFrame, columns: Iterable[str], what: str) -> None:
    missing = sorted(set(columns) - set(df.columns))
    if missing:
        raise MissingEvidenceError(f"{what}: missing columns {', '.join(missing)}")

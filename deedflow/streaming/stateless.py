"""The stateless stages on a stream: the same projections, without row numbers and group windows."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame

from ..operators import geography, rules
from ..sources import configs


def enrich_stream(stream: DataFrame, aliases: Sequence[configs.Alias], rule_set: Sequence[configs.Rule]) -> DataFrame:
    """Address, geography, multi-property and scope fields of streamed records; overrides are a static broadcast table elsewhere."""
    mapped = geography.map_areas(geography.normalise_addresses(stream), aliases)
    return rules.assess_scope(rules.assess_multi_property(mapped, rule_set))

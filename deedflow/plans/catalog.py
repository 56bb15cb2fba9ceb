"""The registered queries and their DuckDB statements."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Callable
from datetime import date
from decimal import Decimal
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..config import areas
from ..functions import hashing, parsing, text, unicode
from ..operators import cleaning, duplicates, evaluate, geography, model, profile, rules
from ..sources import configs, register, tables
from . import oracles as O
from . import reports, stages
from .derive import DATES, EVIDENCE, MARKED_TEXTS, PLACES, PRICES, RECORDS, REGISTER, SALES, TRAINING, derived, spark_text

Query = Callable[[SparkSession, str], DataFrame]
SUPPORTS = (3, 100, 450, 3000)
HOLDOUT = 12
_QUERIES: dict[str, Query] = {}


def query(f: Query) -> Query:
    _QUERIES[f.__name__] = f
    return f


def _fitted(spark: SparkSession, sf: str) -> tuple[model.GroupedMedians, DataFrame]:
    rows = derived(spark, sf, SALES).withColumn("log_price", F.log("price"))
    train, held, _ = model.temporal_split(rows, "transaction_date", HOLDOUT)
    return model.GroupedMedians.fit(train), held


# --- the model ---------------------------------------------------------------------------------------------


@query
def baseline_metrics(spark: SparkSession, sf: str) -> DataFrame:
    fitted, held = _fitted(spark, sf)
    found = evaluate.metrics(fitted.predict_many(held, SUPPORTS), by=["min_group_support"], rows=len(SUPPORTS) * fitted.overall[2])
    return found.select("min_group_support", "rows", F.round("mae", 2).alias("mae"), F.round("mdape", 6).alias("mdape"), F.round("log_mae", 6).alias("log_mae"))


@query
def baseline_backoff_counts(spark: SparkSession, sf: str) -> DataFrame:
    fitted, held = _fitted(spark, sf)
    return fitted.predict_many(held, SUPPORTS).groupBy("backoff_level", "min_group_support").agg(F.count("*").alias("rows"))


@query
def baseline_predictions(spark: SparkSession, sf: str) -> DataFrame:
    fitted, held = _fitted(spark, sf)
    return fitted.predict(held, 100).select("o_orderkey", F.round("predicted_price", 2).alias("predicted_price"), "support_count", "backoff_level")


@query
def grouped_medians(spark: SparkSession, sf: str) -> DataFrame:
    rows = derived(spark, sf, SALES).withColumn("log_price", F.log("price"))
    groups = model.GroupedMedians.fit(rows).groups
    return groups.select("level", "area", "kind", F.round("median", 9).alias("median"), "support")


@query
def report_payload(spark: SparkSession, sf: str) -> DataFrame:
    fitted, held = _fitted(spark, sf)
    asked = fitted.predict(held, 450).withColumn("asking_price", F.col("price") * 1.1)
    bounds = evaluate.residual_interval(F.col("predicted_log_price"), F.lit(0.25))
    out = model.report_payload(asked).withColumns(bounds)
    return out.select(
        "o_orderkey", F.round("asking_minus_predicted", 4).alias("gap"), F.round("asking_minus_predicted_pct", 6).alias("gap_share"), "confidence_state",
        F.round("lower", 2).alias("lower"), F.round("upper", 2).alias("upper"),
    )


@query
def single_prediction(spark: SparkSession, sf: str) -> DataFrame:
    """One property's prediction, as a report shows it."""
    fitted, _ = _fitted(spark, sf)
    one = reports.predict_one(spark, fitted, "FRANCE", "BUILDING", asking=150000.0, support=3)
    keys = {"predicted_price": 2, "asking_minus_predicted": 2, "asking_minus_predicted_pct": 6}
    row = (one["backoff_level"], one["support_count"], one["confidence_state"], *(round(one[k], n) for k, n in keys.items()))
    return spark.createDataFrame([row], "backoff_level string, support_count long, confidence_state string, predicted_price double, asking_minus_predicted double, asking_minus_predicted_pct double")


@query
def confidence_states(spark: SparkSession, sf: str) -> DataFrame:
    fitted, held = _fitted(spark, sf)
    small = fitted.predict(held, 1)
    return small.groupBy(model.confidence(F.col("support_count") % 20, F.col("backoff_level")).alias("confidence_state")).agg(F.count("*").alias("rows"))


@query
def training_filter(spark: SparkSession, sf: str) -> DataFrame:
    rows = model.filter_training_rows(derived(spark, sf, TRAINING))
    return rows.select("o_orderkey", "property_type", "price", F.round("log_price", 9).alias("log_price"))


@query
def training_filter_known_types(spark: SparkSession, sf: str) -> DataFrame:
    return model.filter_training_rows(derived(spark, sf, TRAINING), include_unknown=False).select("o_orderkey", "property_type", "price")


@query
def feature_snapshot(spark: SparkSession, sf: str) -> DataFrame:
    parts = derived(spark, sf, "SELECT p_partkey, p_brand, p_type, CASE WHEN p_size % 7 = 0 THEN NULL ELSE p_size * 5.0 END AS floor_area FROM {part}")
    return parts.select("p_partkey", *(c.alias(n) for n, c in model.feature_snapshot(F.concat(F.lit(" "), "p_brand"), F.col("p_type"), F.col("floor_area").cast("double")).items()))


@query
def segment_metrics(spark: SparkSession, sf: str) -> DataFrame:
    fitted, held = _fitted(spark, sf)
    found = evaluate.segment_metrics(fitted.predict(held, 100), ["canonical_area", "property_type"])
    return found.withColumns({"mae": F.round("mae", 3), "mdape": F.round("mdape", 6)})


@query
def calibrated_interval(spark: SparkSession, sf: str) -> DataFrame:
    fitted, held = _fitted(spark, sf)
    predicted = fitted.predict(held, 100)
    low, high = evaluate.residual_quantiles(predicted).first()
    found = evaluate.interval_coverage(evaluate.with_interval(predicted, low, high))
    return found.select("rows", F.round("coverage", 3).alias("coverage"), F.round("median_width", 1).alias("median_width"), F.round(F.lit(low), 6).alias("low"), F.round(F.lit(high), 6).alias("high"))


@query
def rolling_windows(spark: SparkSession, sf: str) -> DataFrame:
    rows = derived(spark, sf, SALES).withColumn("log_price", F.log("price"))
    found = evaluate.rolling_metrics(rows, "transaction_date", HOLDOUT)
    return found.select("years", "rows", F.round("mae", 2).alias("mae"), F.round("mdape", 6).alias("mdape"), F.round("log_mae", 6).alias("log_mae"))


# --- parsing -----------------------------------------------------------------------------------------------


@query
def date_parse_status(spark: SparkSession, sf: str) -> DataFrame:
    day = parsing.day_first_date(F.col("date_text"))
    return derived(spark, sf, DATES).select(
        "o_orderkey", day.alias("transaction_date"), F.year(day).cast("long").alias("transaction_year"), parsing.date_status(F.col("date_text")).alias("date_parse_status"),
        parsing.is_future(day, F.lit(date(1998, 1, 1))).alias("is_future_transaction"),
    )


@query
def any_format_date(spark: SparkSession, sf: str) -> DataFrame:
    return derived(spark, sf, DATES).select("o_orderkey", parsing.any_date(F.col("date_text")).alias("day"))


@query
def price_parse_vat(spark: SparkSession, sf: str) -> DataFrame:
    raw, status = parsing.price(F.col("price_text")), parsing.price_status(F.col("price_text"))
    adjusted = parsing.vat_adjusted(raw, status, parsing.vat_exclusive(F.col("vat_text")), Decimal("0.135"))
    return derived(spark, sf, PRICES).select("o_orderkey", raw.alias("sale_price_eur_raw"), status.alias("price_parse_status"), *(c.alias(n) for n, c in adjusted.items()))


@query
def flag_maps(spark: SparkSession, sf: str) -> DataFrame:
    market, vat = F.col("market_text"), F.col("vat_text")
    return derived(spark, sf, PRICES).select(
        "o_orderkey", parsing.full_market(market).alias("is_full_market_price"), parsing.full_market_status(market).alias("market_status"),
        parsing.vat_exclusive(vat).alias("vat_exclusive_flag"), parsing.vat_status(vat).alias("vat_status"),
    )


@query
def description_map(spark: SparkSession, sf: str) -> DataFrame:
    described = text.blank_to_null(F.col("description_text"))
    return derived(spark, sf, PRICES).select("o_orderkey", described.alias("description"), *(c.alias(n) for n, c in parsing.description(described).items()))


def _raw_register(spark: SparkSession, sf: str) -> DataFrame:
    return derived(spark, sf, REGISTER).toDF(*register.REQUIRED)


@query
def standardised_register(spark: SparkSession, sf: str) -> DataFrame:
    config = register.RegisterConfig("orders", date(2000, 1, 1))
    whole = register.standardise(_raw_register(spark, sf), config, "0" * 64)
    own = ("source_row_number", "record_id")  # they depend on the scan's order and have a query and tests of their own
    return whole.drop(*own, *(c for c in whole.columns if c.startswith(register.RAW_PREFIX)))


@query
def raw_copies(spark: SparkSession, sf: str) -> DataFrame:
    """The verbatim copies under their short names."""
    whole = register.standardise(_raw_register(spark, sf), register.RegisterConfig("orders", date(2000, 1, 1)), "0" * 64)
    return whole.select(*(c for c in whole.columns if c.startswith(register.RAW_PREFIX)))


def _fresh_path(spark: SparkSession, name: str) -> str:
    """In the shared folder, or in a local one where the session has none."""
    folder = spark.conf.get("spark.checkpoint.dir", None) or f"file://{tempfile.mkdtemp(prefix='tables-')}"
    return f"{folder}/{name}-{uuid.uuid4().hex}"


@query
def register_csv(spark: SparkSession, sf: str) -> DataFrame:
    """The register written as a Windows-1252 file and read back strictly, header checks included."""
    path = _fresh_path(spark, "register")
    raw = _raw_register(spark, sf)
    # Spark writes no Windows-1252, but the bytes are those of its letters in ISO-8859-1
    raw = raw.select(*(register.encoded(F.col(f"`{c}`")).alias(register.encoded_text(c)) for c in raw.columns))
    raw.write.options(header=True, encoding="ISO-8859-1", quoteAll=True, escape='"', ignoreLeadingWhiteSpace=False, ignoreTrailingWhiteSpace=False).csv(path)
    read = register.read_register(spark, register.RegisterConfig(path, date(2000, 1, 1)))
    return read.toDF(*(register.slug(c) for c in read.columns))


@query
def row_numbers(spark: SparkSession, sf: str) -> DataFrame:
    numbered = register.number_rows(derived(spark, sf, "SELECT o_orderkey FROM {orders}"))
    return numbered.agg(F.min("source_row_number").alias("least"), F.max("source_row_number").alias("most"), F.count_distinct("source_row_number").alias("numbers"))


@query
def numbered_rows(spark: SparkSession, sf: str) -> DataFrame:
    """Each row with its number in the order of the file."""
    return register.number_rows(derived(spark, sf, "SELECT o_orderkey FROM {orders}"))


# --- text and geography ------------------------------------------------------------------------------------


def _places(spark: SparkSession, sf: str) -> DataFrame:
    return derived(spark, sf, spark_text(PLACES))


@query
def normalise_text(spark: SparkSession, sf: str) -> DataFrame:
    return _places(spark, sf).select("p_partkey", text.normalise(F.col("raw_address")).alias("tidy"), text.fold(text.normalise(F.col("raw_address"))).alias("folded"))


@query
def address_fields(spark: SparkSession, sf: str) -> DataFrame:
    return geography.normalise_addresses(_places(spark, sf)).select("p_partkey", *geography.ADDRESS_FIELDS)


def _mapped(spark: SparkSession, sf: str) -> DataFrame:
    return geography.map_areas(geography.normalise_addresses(_places(spark, sf)), configs.read_aliases())


@query
def area_match(spark: SparkSession, sf: str) -> DataFrame:
    return _mapped(spark, sf).select("p_partkey", *geography.GEOGRAPHY_FIELDS)


@query
def area_coverage(spark: SparkSession, sf: str) -> DataFrame:
    dated = _mapped(spark, sf).withColumn("transaction_date", F.date_add(F.lit(date(2020, 1, 1)), (F.col("p_partkey") % 1000).cast("int")))
    return profile.area_coverage(dated, list(areas.SCOPE_BY_AREA))


@query
def composed_text(spark: SparkSession, sf: str) -> DataFrame:
    """Latin letters with combining marks, composed."""
    return derived(spark, sf, MARKED_TEXTS).select("n_nationkey", unicode.composed_latin(F.col("raw")).alias("composed"))


@query
def component_match(spark: SparkSession, sf: str) -> DataFrame:
    """Addresses of which one comma-separated part is an area's name."""
    places = geography.normalise_addresses(_places(spark, sf))
    return places.where(text.has_component(F.col("address_match_text"), "RANELAGH")).select("p_partkey")


def _geography_stage(spark: SparkSession, sf: str) -> DataFrame:
    """The geography stage as a written table, which the audits read."""
    dated = _mapped(spark, sf).withColumns({"transaction_date": F.lit(date(2020, 1, 1)), "source_row_number": F.col("p_partkey").cast("long")})
    path = _fresh_path(spark, "geography")
    tables.write_stage(dated, path, dated.columns)
    return spark.read.parquet(path)


@query
def geography_extracts(spark: SparkSession, sf: str) -> DataFrame:
    """The audits' extracts of the geography stage."""
    audits = stages.geography_audits(_geography_stage(spark, sf))
    some = [audits[name].select(F.lit(name).alias("audit"), "record_id", "geography_match_status") for name in ("unmatched", "ambiguous", "overrides", "out_of_scope")]
    return reduce(DataFrame.unionByName, some)


@query
def address_statuses(spark: SparkSession, sf: str) -> DataFrame:
    """The audit of address statuses, by value, and flags."""
    return stages.geography_audits(_geography_stage(spark, sf))["addresses"]


@query
def manual_override(spark: SparkSession, sf: str) -> DataFrame:
    decided = [configs.Override(str(k), "Ranelagh", "inference") for k in (8, 17, 40, 99)]
    mapped = geography.apply_overrides(_mapped(spark, sf), decided)
    return mapped.select("p_partkey", "canonical_area", "geo_scope", "geography_match_status", "matched_aliases")


@query
def alias_summary(spark: SparkSession, sf: str) -> DataFrame:
    matched = _mapped(spark, sf).where("geography_match_status = 'matched'")
    return profile.group_counts(matched, ["canonical_area", "geography_match_alias", "geography_match_method", "geography_match_priority", "geo_scope"])


@query
def multi_property_rules(spark: SparkSession, sf: str) -> DataFrame:
    tidy = _places(spark, sf).withColumn("address_normalized", text.normalise(F.col("raw_address")))
    return rules.assess_multi_property(tidy, configs.read_rules(spark)).select("p_partkey", *rules.MULTI_PROPERTY_FIELDS)


@query
def property_scope(spark: SparkSession, sf: str) -> DataFrame:
    tidy = _places(spark, sf).withColumn("address_normalized", text.normalise(F.col("raw_address")))
    return rules.assess_scope(tidy).select("p_partkey", *rules.SCOPE_FIELDS)


@query
def literal_contains(spark: SparkSession, sf: str) -> DataFrame:
    return profile.containing(_places(spark, sf), "raw_address", ["BLOCK", "ranelagh"]).select("p_partkey")


# --- identifiers and duplicates ----------------------------------------------------------------------------


@query
def content_hashes(spark: SparkSession, sf: str) -> DataFrame:
    orders = derived(spark, sf, "SELECT o_orderkey, o_orderstatus, o_orderpriority, CASE WHEN o_orderkey % 3 = 0 THEN NULL ELSE o_orderstatus END AS gap FROM {orders}")
    return orders.select(
        "o_orderkey",
        hashing.record_id(F.lit("ppr"), F.lit("abc"), F.col("o_orderkey")).alias("record_id"),
        hashing.fingerprint({"b": F.col("o_orderpriority"), "a": F.col("gap")}).alias("fingerprint"),
        hashing.group_id("exact", {"s": F.col("gap"), "p": F.col("o_orderpriority")}).alias("group_id"),
    )


@query
def duplicate_tiers(spark: SparkSession, sf: str) -> DataFrame:
    return duplicates.assess_duplicates(derived(spark, sf, RECORDS)).select("record_id", *duplicates.DUPLICATE_FIELDS)


@query
def duplicate_summary(spark: SparkSession, sf: str) -> DataFrame:
    return profile.group_rows_and_ids(duplicates.assess_duplicates(derived(spark, sf, RECORDS)), ["duplicate_status", "duplicate_action"], "duplicate_group_id")


@query
def duplicate_metrics(spark: SparkSession, sf: str) -> DataFrame:
    return profile.duplicate_key_metrics(derived(spark, sf, RECORDS), "raw_record_fingerprint")


@query
def repeated_keys(spark: SparkSession, sf: str) -> DataFrame:
    return profile.repeated_key_rows(derived(spark, sf, "SELECT l_orderkey FROM {lineitem}"), "l_orderkey")


# --- cleaning and audits -----------------------------------------------------------------------------------


def _assessed(spark: SparkSession, sf: str) -> DataFrame:
    return cleaning.assess_cleaning(derived(spark, sf, EVIDENCE))


@query
def exclusion_reasons(spark: SparkSession, sf: str) -> DataFrame:
    return _assessed(spark, sf).select("o_orderkey", "exclude_from_training", "exclusion_reason", "exclusion_reasons", "exclusion_rule_ids", "cleaning_assessment_status")


@query
def quality_flags(spark: SparkSession, sf: str) -> DataFrame:
    return _assessed(spark, sf).select("o_orderkey", "quality_flags")


@query
def value_counts(spark: SparkSession, sf: str) -> DataFrame:
    return profile.value_counts(_assessed(spark, sf), "exclusion_reason")


@query
def value_counts_top(spark: SparkSession, sf: str) -> DataFrame:
    return profile.value_counts(derived(spark, sf, "SELECT o_custkey FROM {orders}"), "o_custkey", top=25)


@query
def token_counts(spark: SparkSession, sf: str) -> DataFrame:
    return profile.token_counts(_assessed(spark, sf), "address_quality_flags", "no_flags")


@query
def rows_of_a_reason(spark: SparkSession, sf: str) -> DataFrame:
    """Rows whose pipe-joined reasons hold one as a whole item."""
    return _assessed(spark, sf).where(text.pipe_has(F.col("exclusion_reasons"), "invalid_date")).select("o_orderkey")


@query
def value_counts_by_value(spark: SparkSession, sf: str) -> DataFrame:
    return profile.value_counts(_assessed(spark, sf), "duplicate_status", by_value=True)


@query
def first_rows(spark: SparkSession, sf: str) -> DataFrame:
    """The first rows in the source's order."""
    return reports.first_rows(derived(spark, sf, RECORDS), 20).select("record_id", "source_row_number")


@query
def samples_by_reason(spark: SparkSession, sf: str) -> DataFrame:
    return reports.samples_by_reason(_assessed(spark, sf).where("record_id is not null"), rows=3)


@query
def reason_summary(spark: SparkSession, sf: str) -> DataFrame:
    return profile.reason_summary(_assessed(spark, sf))


@query
def long_profile(spark: SparkSession, sf: str) -> DataFrame:
    out = profile.long_profile(_assessed(spark, sf), ["geo_scope", "exclusion_reason", "duplicate_status", "is_full_market_price"], ["quality_flags"])
    return out.withColumn("percent", F.round("percent", 6))


@query
def stage_funnel(spark: SparkSession, sf: str) -> DataFrame:
    return profile.stage_funnel(_assessed(spark, sf))


@query
def reason_histogram(spark: SparkSession, sf: str) -> DataFrame:
    return profile.percent_of_total(profile.reason_histogram(_assessed(spark, sf))).withColumn("percent", F.round("percent", 6))


@query
def reason_combinations(spark: SparkSession, sf: str) -> DataFrame:
    return profile.reason_combinations(_assessed(spark, sf))


@query
def rule_evidence(spark: SparkSession, sf: str) -> DataFrame:
    return profile.rule_evidence(_assessed(spark, sf), {"exclusion_rule_ids": [r for _, r in cleaning.REASONS] + ["CLEAN999"]})


@query
def aligned_counts(spark: SparkSession, sf: str) -> DataFrame:
    return profile.aligned_counts(_assessed(spark, sf), "duplicate_action")


@query
def null_profile(spark: SparkSession, sf: str) -> DataFrame:
    return profile.null_profile(derived(spark, sf, EVIDENCE).select("record_id", "transaction_date", "is_full_market_price", "geo_scope", "geography_quality_flags")).drop("type")


@query
def scalar_counts(spark: SparkSession, sf: str) -> DataFrame:
    c = F.col
    return profile.scalar_counts(
        derived(spark, sf, EVIDENCE), matched=c("geography_match_status") == "matched", not_parsed=c("price_parse_status") != "parsed",
        in_set=c("geo_scope").isin("inference", "unknown"), is_true=c("is_full_market_price"), not_in_set=~text.is_true(c("full_market_price_mapping_status").isin("mapped_full_market")),
    )


@query
def stable_sample(spark: SparkSession, sf: str) -> DataFrame:
    return profile.stable_sample(derived(spark, sf, "SELECT c_custkey, c_name, c_mktsegment FROM {customer}"), 40, ["c_mktsegment", "c_custkey"])


@query
def costliest(spark: SparkSession, sf: str) -> DataFrame:
    return profile.costliest(derived(spark, sf, EVIDENCE), 30).select("record_id", "sale_price_eur_adjusted")


@query
def ordered_union(spark: SparkSession, sf: str) -> DataFrame:
    """Two extracts put together, the second one a bounded sample."""
    records = derived(spark, sf, EVIDENCE).where("record_id is not null")
    near = records.where("duplicate_action = 'review_only'").select("record_id", "duplicate_status")
    rest = profile.stable_sample(records.where("duplicate_status = 'same_day_distinct_transaction'"), 20).select("record_id", "duplicate_status")
    return near.unionByName(rest)


@query
def included_and_excluded(spark: SparkSession, sf: str) -> DataFrame:
    """Both sides of the split by semi and anti join, which together are all records."""
    all_rows = derived(spark, sf, EVIDENCE).select("o_orderkey")
    out = _assessed(spark, sf).where("exclude_from_training").select("o_orderkey")
    side = lambda how, name: all_rows.join(out, "o_orderkey", how).select("o_orderkey", F.lit(name).alias("side"))
    return side("left_semi", "excluded").unionByName(side("left_anti", "included"))


def queries() -> dict[str, Query]:
    return dict(_QUERIES)


def oracle_sql() -> dict[str, str]:
    return O.statements(SUPPORTS, HOLDOUT)

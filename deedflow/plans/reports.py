"""Markdown reports and exports of the audits, which are small aggregates and samples."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..operators import evaluate, profile
from ..operators.model import SUPPORT, GroupedMedians, confidence
from ..operators.quantiles import exact_quantiles
from ..sources import register, tables

# The audits' sort orders.
SUMMARIES = ("aliases", "addresses", "coverage", "rule_evidence", "duplicate_summary", "reasons", "profile", "funnel", "combinations")
ORDERS = {"rule_evidence": ["rule_id"], "profile": ["scope", "metric", "value"], "coverage": ["area"], "funnel": ["step"], "reasons": ["reason"]}


def column_map(columns: Sequence[str]) -> str:
    """Source columns and the names of their verbatim copies, as JSON."""
    return tables.as_json({c: register.slug(c) for c in columns})


def first_rows(df: DataFrame, rows: int = 20, order: str = "source_row_number") -> DataFrame:
    return df.orderBy(order).limit(rows)


def source_profile(df: DataFrame) -> dict[str, DataFrame]:
    """Profile of the standardised stage: dates, prices, flags, blanks and repeated records."""
    price = F.col("sale_price_eur_raw").cast("double")
    return {
        "nulls": profile.null_profile(df),
        "duplicates": profile.duplicate_key_metrics(df, "raw_record_fingerprint"),
        "repeated_ids": profile.repeated_key_rows(df, "record_id"),
        "counties": profile.percent_of_total(profile.value_counts(df, "county_raw")),
        "dates": profile.value_counts(df, "date_parse_status", by_value=True),
        "prices": df.agg(F.min(price).alias("min"), F.avg(price).alias("mean"), F.max(price).alias("max"), F.count(price).alias("prices")),
        "price_quantiles": exact_quantiles(df.select(price.alias("price")), [], "price", {f"p{int(100 * p)}": p for p in (0.01, 0.25, 0.5, 0.75, 0.99)}),
        "first_rows": first_rows(df).select("source_row_number", "transaction_date_raw", "raw_address", "county_raw", "sale_price_eur_raw_text"),
    }


def markdown(title: str, audits: Mapping[str, DataFrame], rows: int = 50) -> str:
    """One section with a table for each audit."""
    parts = [f"# {title}"]
    for name, df in audits.items():
        ordered = df.orderBy(*ORDERS[name]) if name in ORDERS else df
        parts.append(f"## {name}\n\n{tables.markdown_table(ordered, rows)}")
    return "\n\n".join(parts) + "\n"


def export(audits: Mapping[str, DataFrame], path: str) -> None:
    """Each audit as CSV in a folder of its own."""
    for name, df in audits.items():
        tables.write_csv(df, f"{path}/{name}", ORDERS.get(name, ()))


def samples_by_reason(df: DataFrame, reasons: str = "exclusion_reason", rows: int = 5) -> DataFrame:
    """The first records of each reason by id."""
    first = Window.partitionBy(reasons).orderBy("record_id", "raw_address")
    # the filter on the rank keeps only so many rows of each partition before they are shuffled
    some = df.where(F.col(reasons).isNotNull()).select(reasons, "record_id", "raw_address").withColumn("nth", F.row_number().over(first))
    return some.where(F.col("nth") <= rows).drop("nth")


def write_all(spark: SparkSession, out: str, stage: DataFrame, audits: Mapping[str, DataFrame], sample_rows: int = 5) -> None:
    """The audits as CSV, the map of source columns as JSON, and two Markdown reports, under ``out``."""
    export(audits, f"{out}/audits")
    raw = [c for c in stage.columns if c.startswith(register.RAW_PREFIX)]
    names = {register.slug(c): c for c in register.REQUIRED}
    tables.write_text(spark, f"{out}/column_map.json", tables.as_json({names.get(c, c.removeprefix(register.RAW_PREFIX)): c for c in raw}))
    samples = {"samples": samples_by_reason(stage, rows=sample_rows).orderBy("exclusion_reason", "record_id")}
    tables.write_text(spark, f"{out}/source_profile.md", markdown("Source profile", source_profile(stage)))
    small = {k: v for k, v in audits.items() if k in SUMMARIES}
    tables.write_text(spark, f"{out}/audits.md", markdown("Audits", small | samples) + f"\n## columns\n\n{tables.schema_markdown(stage)}\n")


def predict_one(spark: SparkSession, model: GroupedMedians, area: str, kind: str, asking: float | None = None, support: int = SUPPORT) -> dict:
    """A single property's prediction with its confidence, bounds left open, and the asking price's gap."""
    row = spark.createDataFrame([(area, kind, asking)], f"{model.area} string, {model.kind} string, asking_price double")
    out = model.predict(row, support).withColumn("confidence_state", confidence(F.col("support_count"), F.col("backoff_level"))).first().asDict()
    gap = None if asking is None else asking - out["predicted_price"]
    return out | {"lower": None, "upper": None, "asking_minus_predicted": gap, "asking_minus_predicted_pct": gap / out["predicted_price"] if gap is not None and out["predicted_price"] > 0 else None}


def validation_json(df: DataFrame, holdout_months: int = 12, support: int = SUPPORT) -> str:
    return tables.as_json(evaluate.validate(df, holdout_months, support).as_dict())

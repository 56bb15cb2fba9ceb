"""Command line: ``python -m deedflow build|validate|train``."""

from __future__ import annotations

import argparse
from datetime import date

from pyspark.sql import SparkSession
from pyspark.sql import functions as F

from .functions import parsing
from .operators import model
from .plans import reports, stages
from .sources import configs, tables
from .sources.register import RegisterConfig, file_sha256


def parser() -> argparse.ArgumentParser:
    top = argparse.ArgumentParser(prog="deedflow")
    commands = top.add_subparsers(dest="command", required=True)
    build = commands.add_parser("build", help="run all record stages and audits")
    build.add_argument("--source", required=True)
    build.add_argument("--snapshot", required=True, type=date.fromisoformat)
    build.add_argument("--out", required=True)
    build.add_argument("--aliases")
    build.add_argument("--overrides")
    build.add_argument("--rules")
    build.add_argument("--expected-content")
    build.add_argument("--expected-sha256", help="of the source file")
    build.add_argument("--sample-rows", type=int, default=5, help="of each reason in the report")
    for name in ("validate", "train"):
        some = commands.add_parser(name)
        some.add_argument("--dataset", required=True)
        some.add_argument("--holdout-months", type=int, default=12)
        some.add_argument("--min-group-support", type=int, default=model.SUPPORT)
        some.add_argument("--artifacts-dir", default="artifacts")
    return top


def main(argv: list[str] | None = None) -> None:
    args = parser().parse_args(argv)
    spark = SparkSession.builder.appName("deedflow").getOrCreate()
    if args.command == "build":
        if args.expected_sha256 and (found := file_sha256(spark, args.source)) != args.expected_sha256.lower():
            raise SystemExit(f"the source file's SHA-256 is {found}")
        out = stages.build(spark, RegisterConfig(args.source, args.snapshot), args.out, args.aliases, args.overrides, args.rules)
        tables.check_content(out, args.expected_content)
        audits = stages.geography_audits(out) | stages.cleaning_audits(out, configs.read_rules(spark, args.rules or configs.RULES_FILE))
        reports.write_all(spark, args.out, out, audits, args.sample_rows)
        return
    rows = tables.load_training_csv(spark, args.dataset)
    if args.command == "validate":
        print(reports.validation_json(rows, args.holdout_months, args.min_group_support))
        return
    kept = model.filter_training_rows(rows).withColumn("transaction_date", parsing.any_date(F.col("transaction_date").cast("string")))
    train, _, _ = model.temporal_split(kept, "transaction_date", args.holdout_months)
    model.GroupedMedians.fit(train).save(f"{args.artifacts_dir}/grouped_medians")


if __name__ == "__main__":
    main()

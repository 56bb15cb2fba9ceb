import hashlib

import pytest
from deedflow import __main__ as cli
from deedflow.errors import PhysicalSchemaError
from deedflow.operators import duplicates
from deedflow.plans import stages
from deedflow.sources import register, schemas
from pyspark.sql import functions as F

from .test_register import BASE, HEADER, ROWS, write


def test_declared_schemas(spark, tmp_path):
    out = stages.build(spark, write(tmp_path / "r.csv", ROWS), str(tmp_path / "out"))
    assert out.dtypes == schemas.declared(out.columns) and dict(out.dtypes)["sale_price_eur_raw"] == "decimal(18,2)"
    for wrong in (out.drop("county_raw"), out.withColumn("county_raw", F.lit(1)), out.select(*out.columns[::-1]), out.withColumn("x", F.lit(""))):
        with pytest.raises(PhysicalSchemaError):
            schemas.check(wrong, out.columns, "assessed")


def test_command_line_writes_reports(spark, tmp_path):
    write(tmp_path / "r.csv", [*ROWS, BASE])
    sha = hashlib.sha256((tmp_path / "r.csv").read_bytes()).hexdigest()
    assert register.file_sha256(spark, str(tmp_path / "r.csv"), block=7) == sha
    call = ["build", "--source", str(tmp_path / "r.csv"), "--snapshot", "2026-06-21", "--out", str(tmp_path / "out")]
    with pytest.raises(SystemExit):
        cli.main([*call, "--expected-sha256", "0" * 64])
    cli.main([*call, "--expected-sha256", sha.upper(), "--sample-rows", "2"])
    audits = (tmp_path / "out" / "audits.md").read_text()
    assert "## funnel" in audits and "## samples" in audits and "| duplicate_group_size | bigint |" in audits
    assert "## counties" in (tmp_path / "out" / "source_profile.md").read_text()
    assert '"Price (€)": "source_raw__price"' in (tmp_path / "out" / "column_map.json").read_text()


def test_row_numbers_over_many_partitions(spark):
    df = spark.range(1000, numPartitions=7).select(F.col("id").alias("x"))
    numbered = register.number_rows(df.where("x % 3 > 0")).orderBy("source_row_number").collect()
    assert [r["source_row_number"] for r in numbered] == list(range(1, len(numbered) + 1)) and [r["x"] for r in numbered] == [x for x in range(1000) if x % 3]


def test_wide_records_get_the_same_tiers(spark):
    rows = [(str(i), i, f"f{i % 5}", f"a{i % 3}" if i % 4 else None, "d", 1.0, 1.0, i % 2 == 0, None, "t") for i in range(30)]
    names = "record_id source_row_number raw_record_fingerprint address_normalized transaction_date sale_price_eur_raw sale_price_eur_adjusted is_full_market_price vat_exclusive_flag property_description_raw"
    kinds = "string long string string string double double boolean boolean string"
    df = spark.createDataFrame(rows, ", ".join(f"{n} {k}" for n, k in zip(names.split(), kinds.split())))
    wide = df.withColumns({f"more{i}": F.lit(i) for i in range(8)})
    pick = lambda out: sorted(map(tuple, out.select("record_id", *duplicates.DUPLICATE_FIELDS).collect()))
    assert pick(duplicates.assess_duplicates(df)) == pick(duplicates.assess_duplicates(wide))
    assert len(HEADER) == 9

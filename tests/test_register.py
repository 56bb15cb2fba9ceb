import datetime
import hashlib
import json
from decimal import Decimal

import pytest
from deedflow.errors import PhysicalSchemaError, SourceDecodeError, SourceSchemaError
from deedflow.plans import stages
from deedflow.sources import configs, register, tables

HEADER = list(register.REQUIRED)
BASE = ["01/01/2024", "1 Main Street, Ranelagh", "Dublin", "", "€100,000.00", "No", "No", "Second-Hand Dwelling house /Apartment", ""]
SNAPSHOT = datetime.date(2026, 6, 21)


def write(path, rows, header=None):
    quote = lambda v: '"' + v.replace('"', '""') + '"'
    lines = [",".join(map(quote, r)) for r in [header or HEADER, *rows]]
    path.write_bytes(("\r\n".join(lines) + "\r\n").encode("cp1252"))
    return register.RegisterConfig(str(path), SNAPSHOT)


def with_(**change):
    names = dict(zip(("date", "address", "county", "eircode", "price", "market", "vat", "description", "size"), range(9)))
    row = list(BASE)
    for k, v in change.items():
        row[names[k]] = v
    return row


ROWS = [
    with_(date="31/12/2024", vat="Yes", price="€1.00"),
    with_(date="2024-02-01", price="not money", market="Maybe", vat="Maybe", description="Villa"),
    with_(date="22/06/2026", price="€0.00", market="Yes"),
    with_(date="", price="", market="", vat="", description="", county=""),
    with_(price="€-1.00", description="Teach/Árasán Cónaithe Nua", size="greater than 38 sq metres", eircode=" "),
    with_(address='Line one\nwith "quotes", – dash', price="€0.10", vat="Yes", eircode="D06 XY00"),
]


def test_standardised_rows(spark, tmp_path):
    config = write(tmp_path / "r.csv", ROWS)
    df = register.load_register(spark, config)
    rows = df.orderBy("source_row_number").collect()
    assert len(df.columns) == 36 + 9 and [r["source_row_number"] for r in rows] == [1, 2, 3, 4, 5, 6]
    assert [r["date_parse_status"] for r in rows] == ["parsed", "invalid", "parsed", "missing", "parsed", "parsed"]
    assert [r["is_future_transaction"] for r in rows] == [False, None, True, None, False, False]
    assert [r["price_parse_status"] for r in rows] == ["parsed", "invalid", "non_positive", "missing", "non_positive", "parsed"]
    # Q-15: a true half cent is rounded up; Q-02 and Q-03: what can't be read is a status
    assert [r["sale_price_eur_adjusted"] for r in rows] == [Decimal("1.14"), None, None, None, None, Decimal("0.11")]
    assert [r["sale_price_adjustment_method"] for r in rows] == ["provisional_house_vat_13_5_percent", "invalid_raw_price", "invalid_raw_price", "invalid_raw_price", "invalid_raw_price", "provisional_house_vat_13_5_percent"]
    assert [r["full_market_price_mapping_status"] for r in rows] == ["mapped_full_market", "unrecognised", "mapped_not_full_market", "missing", "mapped_full_market", "mapped_full_market"]
    assert [r["property_description_mapping_method"] for r in rows] == ["exact_source_value_mapping", "unrecognised", "exact_source_value_mapping", "missing", "exact_source_value_mapping", "exact_source_value_mapping"]
    assert rows[4]["is_new_build"] is True and rows[4]["floor_area_sqm"] is None and rows[4]["eircode_raw"] is None and rows[4]["source_raw__eircode"] == " "
    assert rows[5]["raw_address"] == 'Line one\nwith "quotes", – dash'
    sha = hashlib.sha256((tmp_path / "r.csv").read_bytes()).hexdigest()
    payload = json.dumps(["ppr", sha, 1], ensure_ascii=False, separators=(",", ":"))
    assert rows[0]["source_file_sha256"] == sha and rows[0]["record_id"] == hashlib.sha256(payload.encode()).hexdigest()


def test_column_order_does_not_change_fingerprints(spark, tmp_path):
    one = register.load_register(spark, write(tmp_path / "a.csv", ROWS))
    turned = [HEADER[i] for i in range(8, -1, -1)]
    two = register.load_register(spark, write(tmp_path / "b.csv", [r[::-1] for r in ROWS], turned))
    prints = lambda df: [r[0] for r in df.orderBy("source_row_number").select("raw_record_fingerprint").collect()]
    assert prints(one) == prints(two)
    pairs = json.dumps(sorted([n, v] for n, v in zip(HEADER, ROWS[0])), ensure_ascii=False, separators=(",", ":"))
    assert prints(one)[0] == hashlib.sha256(pairs.encode()).hexdigest()


@pytest.mark.parametrize("header", [HEADER[1:], [*HEADER, HEADER[0]], [*HEADER, "Extra Column", "Extra-Column"]])
def test_bad_headers(header):
    with pytest.raises(SourceSchemaError):
        register.validate_header(header)


def test_extra_columns_are_kept(spark, tmp_path):
    df = register.load_register(spark, write(tmp_path / "x.csv", [[*BASE, "kept"]], [*HEADER, "Extra Column"]))
    assert df.first()["source_raw__extra_column"] == "kept"
    assert register.validate_header([*HEADER, "Extra Column"]) == ["Extra Column"]


def test_bad_bytes_and_empty_file(spark, tmp_path):
    config = write(tmp_path / "b.csv", ROWS)
    (tmp_path / "b.csv").write_bytes((tmp_path / "b.csv").read_bytes().replace(b"Villa", b"Vi\x81la"))
    with pytest.raises(SourceDecodeError):
        register.read_register(spark, config)
    (tmp_path / "e.csv").write_bytes(b"")
    with pytest.raises(SourceSchemaError):
        register.read_header(spark, str(tmp_path / "e.csv"))


def test_all_stages(spark, tmp_path):
    config = write(tmp_path / "r.csv", [*ROWS, BASE, BASE])
    out = stages.build(spark, config, str(tmp_path / "out"))
    assert len(out.columns) == 81 and out.count() == 8
    rows = {r["source_row_number"]: r for r in out.collect()}
    assert rows[7]["duplicate_action"] == "retain_representative" and rows[8]["exclusion_reasons"] == "duplicate_unresolved"
    assert rows[7]["cleaning_assessment_status"] == "eligible" and rows[7]["canonical_area"] == "Ranelagh"
    for name, audit in (stages.geography_audits(out) | stages.cleaning_audits(out, configs.read_rules(spark))).items():
        audit.collect()
        if name == "rule_evidence":
            tables.write_csv(audit, str(tmp_path / "audit"), ["rule_id"])
            assert "| rule_id |" in tables.markdown_table(audit.orderBy("rule_id"))
    with pytest.raises(PhysicalSchemaError):
        stages.enrich_geography(out)


def test_checks_of_written_tables(spark, tmp_path):
    df = spark.createDataFrame([(1, "a"), (2, None)], "source_row_number long, v string")
    tables.write_stage(df, str(tmp_path / "t"), df.columns)
    assert tables.validate_stage(spark, str(tmp_path / "t"), df, ["source_row_number"], inherited=df).count() == 2
    for wrong in (lambda: tables.validate_stage(spark, str(tmp_path / "t"), df, ["v"]), lambda: tables.validate_stage(spark, str(tmp_path / "t"), df.limit(1)), lambda: tables.validate_stage(spark, str(tmp_path / "t"), df.drop("v"))):
        with pytest.raises(PhysicalSchemaError):
            wrong()
    found = tables.check_content(df, None)
    assert tables.check_content(df.orderBy("v"), found) == found
    with pytest.raises(PhysicalSchemaError):
        tables.check_content(df.limit(1), found)


def test_reports_and_command_line(spark, tmp_path):
    import json

    from deedflow import __main__ as cli
    from deedflow.operators.model import GroupedMedians
    from deedflow.plans import reports

    write(tmp_path / "r.csv", [*ROWS, BASE])
    cli.main(["build", "--source", str(tmp_path / "r.csv"), "--snapshot", "2026-06-21", "--out", str(tmp_path / "out")])
    out = spark.read.parquet(str(tmp_path / "out" / "assessed"))
    page = reports.markdown("Profile", reports.source_profile(out))
    assert "## counties" in page and "| Dublin |" in page
    assert reports.samples_by_reason(out).count() >= 1
    assert json.loads(reports.column_map(HEADER))["Price (€)"] == "source_raw__price"
    body = "transaction_date,sale_price_eur,canonical_area,property_type\n" + "".join(f"0{m}/0{m}/2023,{m}00,A,House\n" for m in range(1, 9))
    (tmp_path / "t.csv").write_text(body, encoding="utf-8")
    cli.main(["train", "--dataset", str(tmp_path / "t.csv"), "--holdout-months", "3", "--artifacts-dir", str(tmp_path / "art")])
    cli.main(["validate", "--dataset", str(tmp_path / "t.csv"), "--holdout-months", "3"])
    one = reports.predict_one(spark, GroupedMedians.load(spark, str(tmp_path / "art" / "grouped_medians")), "A", "House", asking=330.0)
    assert one["backoff_level"] == "area_property_type" and one["asking_minus_predicted"] == pytest.approx(330 - one["predicted_price"])

import datetime
from decimal import Decimal

import pytest
from deedflow.errors import MissingEvidenceError, RuleConfigError
from deedflow.operators import cleaning, duplicates, profile, rules
from deedflow.sources import configs
from pyspark.sql import functions as F

MULTI = [
    ("APARTMENTS 1-12, TEST COURT", "MP001", "auto_exclude"),
    ("APARTMENTS 1 - 12, TEST COURT", "MP001", "auto_exclude"),
    ("APT 1 2 3, TEST COURT", "MP002", "auto_exclude"),
    ("30 APTS AND ONE COMMERCIAL UNIT, TEST COURT", "MP003", "auto_exclude"),
    ("BLOCK 8A AND BLOCK 8B, TEST COURT", "MP004", "auto_exclude"),
    ("8 PEMBROKE ROAD & 8 BAGGOT LANE, BALLSBRIDGE", "MP005", "auto_exclude"),
    ("1-6 INCLUSIVE, THE MEADOWS", "MP006", "auto_exclude"),
    ("ENTIRE BLOCK, TEST COURT", "MP007", "auto_exclude"),
    ("APT 7 ARRANMORE, 13-17 PEMBROKE ROAD", "MP1", "review_only"),
    ("APARTMENT 3-10, TEST COURT", "MP1", "review_only"),
    ("7 OLDWOOD PHASE 11, ROSCOMMON", "MP1", "review_only"),
    ("12-14 O'CONNELL-STREET", "MP1", "review_only"),
    ("NO 4 TEST DEVELOPMENT", "MP1", "review_only"),
    ("6 SCRAHAN PLACE; KILLARNEY", "", "none"),
    ("12 MAIN STREET, DUBLIN", "", "none"),
    ("BLOCK 8A AND BLOCK 8A, TEST COURT", "", "none"),
    ("1 ORDINARY ROAD", "", "none"),
    (None, "", "none"),
]


def test_multi_property(spark):
    df = spark.createDataFrame([(i, a) for i, (a, _, _) in enumerate(MULTI)], "i int, address_normalized string")
    found = rules.assess_multi_property(df, configs.read_rules(spark)).orderBy("i").collect()
    for row, (address, rule, action) in zip(found, MULTI):
        assert row["multi_property_action"] == action, address
        assert (rule in row["multi_property_rule_ids"]) and (row["multi_property_rule_ids"] == "") == (action == "none"), address
        assert row["single_dwelling_confidence"] == {"none": "high", "review_only": "medium", "auto_exclude": "low"}[action]


def test_several_rules(spark):
    df = spark.createDataFrame([("30 APARTMENTS 1-30 INCLUSIVE, BLOCK A AND BLOCK B",)], "address_normalized string")
    row = rules.assess_multi_property(df, configs.read_rules(spark)).first()
    ids = row["multi_property_rule_ids"].split("|")
    assert len(ids) >= 3 and ids == sorted(ids) and (row["multi_property_max_severity"], row["multi_property_action"]) == ("high", "auto_exclude")


@pytest.mark.parametrize("matcher, pattern, action", [("unknown", "x", "auto_exclude"), ("regex", "[", "auto_exclude"), ("regex", "x", "delete")])
def test_bad_rules(spark, tmp_path, matcher, pattern, action):
    path = tmp_path / "rules.csv"
    path.write_text(",".join(configs.RULE_COLUMNS) + f"\nR1,d,{matcher},{pattern},high,{action},r,f\n", encoding="utf-8")
    with pytest.raises(RuleConfigError):
        configs.read_rules(spark, path)


def test_scope(spark):
    cases = [
        ("APARTMENT 2 TEST COURT", "clearly_non_house", "PROP001"), ("FLAT 3 TEST HOUSE", "clearly_non_house", "PROP002"), ("APT. 4 TEST COURT", "clearly_non_house", "PROP003"),
        ("UNIT 4 TEST COURT", "review_required", "PROP101"), ("4 TEST ROAD", "unresolved_house_or_apartment", ""), ("CAPTAIN'S HOUSE", "unresolved_house_or_apartment", ""),
        ("UNIT 1 APARTMENT 2", "clearly_non_house", "PROP001"), ("APT COURT", "clearly_non_house", "PROP003"),
    ]
    df = spark.createDataFrame([(i, a) for i, (a, _, _) in enumerate(cases)], "i int, address_normalized string")
    assert [(r["property_scope_status"], r["property_scope_rule_ids"]) for r in rules.assess_scope(df).orderBy("i").collect()] == [c[1:] for c in cases]


RECORD = (
    "record_id string, source_row_number long, raw_record_fingerprint string, raw_address string, address_normalized string, transaction_date date, sale_price_eur_raw decimal(18,2), "
    "sale_price_eur_adjusted decimal(18,2), is_full_market_price boolean, vat_exclusive_flag boolean, property_description_raw string"
)


def record(key, number, fingerprint, address, day, price, full=True):
    when = None if day is None else datetime.date(2024, 1, day)
    return key, number, fingerprint, address, address, when, Decimal(price), Decimal(price), full, False, "second"


RECORDS = [
    record("e2", 20, "f1", "1 A", 1, 100), record("e1", 10, "f1", "1 A", 1, 100),
    record("p1", 1, "f2", "2 B", 2, 200), record("p2", 2, "f3", "2 B", 2, 200),
    record("w1", 3, "f4", "3 C", 3, 300), record("w2", 4, "f5", "3 C", 3, 300, False),
    record("d1", 5, "f6", "4 D", 4, 400), record("d2", 6, "f7", "5 E", 4, 400),
    record("s1", 7, "f8", "6 F", 5, 500),
    # null keys are equal to each other, and an exact pair shares its publication key with a third record
    record("n1", 8, None, None, None, 600), record("n2", 9, None, None, None, 600),
    record("x1", 11, "g1", "7 G", 7, 700), record("x2", 12, "g1", "7 G", 7, 700), record("x3", 13, "g2", "7 G", 7, 700),
]


def test_duplicate_tiers(spark):
    df = spark.createDataFrame(RECORDS, RECORD)
    found = {r["record_id"]: r for r in duplicates.assess_duplicates(df).collect()}
    assert len(found) == len(RECORDS)
    pick = lambda k: (found[k]["duplicate_status"], found[k]["duplicate_action"], found[k]["duplicate_group_size"])
    assert pick("e1") == ("exact_source_duplicate", "retain_representative", 2) and pick("e2") == ("exact_source_duplicate", "auto_exclude", 2)
    assert found["e2"]["duplicate_representative_record_id"] == "e1"
    assert pick("p1") == pick("p2") == ("plausible_duplicate_publication", "review_only", 2)
    assert pick("w1") == pick("w2") == ("unresolved_duplicate_like", "review_only", 2)
    assert pick("d1") == pick("d2") == ("same_day_distinct_transaction", "none", 2)
    assert pick("s1") == ("not_duplicate_like", "none", 1) and found["s1"]["duplicate_group_id"] is None
    assert pick("n1") == ("exact_source_duplicate", "retain_representative", 2)
    # Q-11: the group of the third record counts rows of an earlier tier
    assert pick("x3") == ("plausible_duplicate_publication", "review_only", 3)
    assert found["p1"]["duplicate_group_id"] == found["p2"]["duplicate_group_id"] != found["w1"]["duplicate_group_id"]


def test_duplicates_do_not_depend_on_order(spark):
    one = duplicates.assess_duplicates(spark.createDataFrame(RECORDS, RECORD)).orderBy("record_id").collect()
    two = duplicates.assess_duplicates(spark.createDataFrame(RECORDS[::-1], RECORD).repartition(3)).orderBy("record_id").collect()
    assert one == two


def test_missing_evidence(spark):
    df = spark.createDataFrame(RECORDS, RECORD)
    for call in (lambda: duplicates.assess_duplicates(df.drop("vat_exclusive_flag")), lambda: cleaning.assess_cleaning(df), lambda: rules.assess_scope(df, "nowhere")):
        with pytest.raises(MissingEvidenceError):
            call()


EVIDENCE = {
    "record_id": "r", "raw_address": "1 Main Street", "transaction_date": datetime.date(2024, 1, 1), "date_parse_status": "parsed", "is_future_transaction": False,
    "sale_price_eur_adjusted": Decimal(100), "price_parse_status": "parsed", "is_full_market_price": True, "full_market_price_mapping_status": "mapped_full_market",
    "geo_scope": "inference", "geography_match_status": "matched", "property_scope_status": "unresolved_house_or_apartment", "multi_property_action": "none", "duplicate_action": "none",
    "duplicate_status": "not_duplicate_like", "vat_mapping_status": "mapped_vat_inclusive", "sale_price_adjustment_method": "none", "address_quality_flags": "",
    "geography_quality_flags": "", "property_type_quality_flag": "ppr_house_apartment_ambiguous",
}
SCHEMA = ", ".join(f"{k} {'date' if k == 'transaction_date' else 'decimal(18,2)' if 'eur' in k else 'boolean' if k.startswith('is_') else 'string'}" for k in EVIDENCE)
CHANGES = [
    ({}, None), ({"sale_price_eur_adjusted": None}, "invalid_target"), ({"price_parse_status": "invalid"}, "invalid_target"), ({"sale_price_eur_adjusted": Decimal(0)}, "invalid_target"),
    ({"transaction_date": None}, "invalid_date"), ({"is_future_transaction": True}, "invalid_date"), ({"is_future_transaction": None}, None),
    ({"is_full_market_price": False}, "non_full_market_transaction"), ({"is_full_market_price": None}, "unresolved_market_price_status"),
    ({"full_market_price_mapping_status": None}, "unresolved_market_price_status"), ({"geo_scope": "out_of_scope"}, "out_of_scope_geography"),
    ({"geo_scope": "unknown", "geography_match_status": "unmatched"}, "unmatched_geography_unresolved"), ({"geo_scope": "unknown", "geography_match_status": "ambiguous"}, "ambiguous_geography_unresolved"),
    ({"property_scope_status": "clearly_non_house"}, "excluded_property_type"), ({"multi_property_action": "auto_exclude"}, "multi_property_transaction"),
    ({"duplicate_action": "auto_exclude"}, "duplicate_unresolved"), ({"vat_mapping_status": None}, "unresolved_vat_treatment"), ({"sale_price_adjustment_method": "unresolved_vat_flag"}, "unresolved_vat_treatment"),
    ({"record_id": None}, "insufficient_required_fields"), ({"raw_address": " "}, "insufficient_required_fields"),
    ({"multi_property_action": "review_only"}, None), ({"geo_scope": "out_of_scope", "duplicate_action": "auto_exclude", "is_full_market_price": False}, "non_full_market_transaction"),
]


def assessed(spark):
    rows = [tuple((EVIDENCE | change).values()) + (i,) for i, (change, _) in enumerate(CHANGES)]
    return cleaning.assess_cleaning(spark.createDataFrame(rows, SCHEMA + ", i int"))


def test_cleaning(spark):
    found = assessed(spark).orderBy("i").collect()
    for row, (change, reason) in zip(found, CHANGES):
        assert row["exclusion_reason"] == reason, change
        assert row["exclude_from_training"] == (reason is not None) == (row["exclusion_reasons"] != "")
    assert found[0]["cleaning_assessment_status"] == "eligible" and found[0]["quality_flags"] == "unknown_property_type|ppr_house_apartment_ambiguous"
    assert found[20]["cleaning_assessment_status"] == "eligible_with_review"
    assert found[21]["exclusion_reasons"] == "non_full_market_transaction|out_of_scope_geography|duplicate_unresolved" and found[21]["exclusion_rule_ids"] == "CLEAN003|CLEAN005|CLEAN010"


def test_audits_agree(spark):
    df = assessed(spark).cache()
    excluded = df.where("exclude_from_training").count()
    funnel = {r["stage"]: r for r in profile.stage_funnel(df).collect()}
    assert funnel["input"]["eligible_rows"] == len(CHANGES) and funnel["vat_and_required_fields"]["excluded_rows"] == excluded
    reasons = {r["reason"]: r for r in profile.reason_summary(df).collect()}
    assert len(reasons) == 12 and sum(r["primary_rows"] for r in reasons.values()) == excluded
    counts = {r["value"]: r["count"] for r in profile.value_counts(df, "exclusion_reason").collect()}
    assert counts["<null>"] == len(CHANGES) - excluded
    evidence = {r["rule_id"]: r["total_rows"] for r in profile.rule_evidence(df, {"exclusion_rule_ids": ["CLEAN001", "NEVER"]}).where(F.col("rule_id") != "x").collect()}
    assert evidence == {"CLEAN001": 3, "NEVER": 0}
    df.unpersist()

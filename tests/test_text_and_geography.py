import csv

import pytest
from deedflow.config import areas
from deedflow.errors import GeographyConfigError
from deedflow.functions import text as T
from deedflow.operators import geography
from deedflow.sources import configs
from pyspark.sql import functions as F

ADDRESSES = [
    ("  12   main rd ,  ranelagh..  ", "12 MAIN ROAD, RANELAGH", "12 MAIN ROAD, RANELAGH", "normalized", ""),
    ("7 Harold’s Cross – Dublin", "7 HAROLD'S CROSS - DUBLIN", "7 HAROLD'S CROSS - DUBLIN", "normalized", ""),
    ("10 Dún Laoghaire", "10 DÚN LAOGHAIRE", "10 DUN LAOGHAIRE", "normalized", ""),
    ("  1 St. John's Rd, Dún Laoghaire  ", "1 STREET JOHN'S ROAD, DÚN LAOGHAIRE", "1 STREET JOHN'S ROAD, DUN LAOGHAIRE", "normalized", ""),
    ("Ranelagh", "RANELAGH", "RANELAGH", "too_short", "too_short_address|broad_locality_only"),
    (" ... ,,, ", None, None, "missing", "punctuation_only_address"),
    ("  ", None, None, "missing", "missing_raw_address"),
    (None, None, None, "missing", "missing_raw_address"),
    ("Main Street, Ranelagh", "MAIN STREET, RANELAGH", "MAIN STREET, RANELAGH", "normalized", "broad_locality_only"),
    ("County Dublin", "COUNTY DUBLIN", "COUNTY DUBLIN", "normalized", ""),
]


def test_addresses(spark):
    df = spark.createDataFrame([(i, a[0]) for i, a in enumerate(ADDRESSES)], "i int, raw_address string")
    rows = geography.normalise_addresses(df).orderBy("i").collect()
    assert [tuple(r)[1:] for r in rows] == ADDRESSES


def test_normalising_is_idempotent_and_equals_its_twin(spark):
    texts = [a[0] for a in ADDRESSES if a[0]] + ["APT.5 ,, x  -  y", "Co. Dublin", "a b", "12–14 o’connell—street"]
    df = spark.createDataFrame([(t,) for t in texts], "t string").select("t", T.normalise(F.col("t")).alias("n"))
    for r in df.withColumn("again", T.normalise(F.col("n"))).withColumn("folded", T.fold(F.col("n"))).collect():
        assert r["n"] == r["again"] == T.normalise_text(r["t"])
        assert r["folded"] == T.match_text(r["t"])


def test_text_that_is_not_composed(spark):
    from deedflow.functions import unicode

    df = spark.createDataFrame([("Du\u0301n rd",), (None,), ("Ж\u0301 ﬁ",)], "t string")
    got = df.select(T.normalise(F.col("t"), compose=True).alias("n"), unicode.folded(F.col("t")).alias("f")).collect()
    assert [tuple(r) for r in got] == [("DÚN ROAD", "Dun rd"), (None, None), ("Ж\u0301 FI", "Ж fi")]


def mapped(spark, rows, overrides=()):
    df = spark.createDataFrame([(f"r{i}", a, c) for i, (a, c) in enumerate(rows)], "record_id string, raw_address string, county_raw string")
    out = geography.map_areas(geography.normalise_addresses(df), configs.read_aliases(), overrides)
    return [r.asDict() for r in out.orderBy(F.expr("cast(substr(record_id, 2) as int)")).collect()]


def test_areas(spark):
    found = mapped(
        spark,
        [
            ("1 Main Street, Ranelagh, Dublin 6", "Dublin"),
            ("2 Village Road, Harold's Cross, Dublin 6W", "Dublin"),
            ("3 Coast Road, Monkstown, Co Dublin", ""),
            ("4 Dún Laoghaire", "Dublin"),
            ("4 Dun Laoghaire", "Dublin"),
            ("1 Unknown Road, Dublin", "Dublin"),
            ("1 Church Street, Galway", "Galway"),
            ("5 Ranelagh, Rathmines, Dublin 6", "Dublin"),
            ("6 Mount Merrion, County Dublin", None),
            ("1 Blackrocket Road", "Dublin"),
            ("Dublin 4", "Dublin"),
            ("1 Dún Laoghaire-Rathdown", "Dublin"),
            ("8 Blackrock", "Cork"),
            ("Dublin Road, Blackrock", "Louth"),
            ("Mount Merrion, Blackrock, Merrion", "Dublin"),
            ("", "Dublin"),
        ],
    )
    pick = lambda i, *names: tuple(found[i][n] for n in names)
    decision = ("canonical_area", "geo_scope", "geography_match_status")
    assert pick(0, *decision) == ("Ranelagh", "inference", "matched")
    assert pick(1, *decision) == ("Harolds Cross", "training_only", "matched")
    assert pick(2, *decision) == ("Monkstown", "inference", "matched")
    assert pick(3, *decision) == pick(4, *decision) == ("Dún Laoghaire", "training_only", "matched")
    assert pick(5, *decision) == (None, "unknown", "unmatched")
    assert pick(6, *decision) == (None, "out_of_scope", "unmatched")
    assert pick(7, *decision, "geography_candidate_areas") == (None, "unknown", "ambiguous", "Ranelagh|Rathmines")
    assert pick(8, "canonical_area", "geography_match_priority", "match_priorities") == ("Mount Merrion", 10, "10|80")
    assert "multiple_candidates_priority_resolved" in found[8]["geography_quality_flags"]
    assert pick(9, *decision) == (None, "unknown", "unmatched")
    assert found[10]["geography_quality_flags"] == "broad_dublin_reference_only"
    assert found[11]["canonical_area"] is None
    assert pick(12, *decision) == (None, "out_of_scope", "unmatched")
    assert found[12]["geography_quality_flags"] == "canonical_alias_outside_expected_dublin_context|conflicting_county_context|non_unique_locality_name"
    # Q-07: a road named after the capital is context
    assert pick(13, *decision) == ("Blackrock", "inference", "matched") and "conflicting_county_context" in found[13]["geography_quality_flags"]
    # Q-09: only the first two candidates can resolve
    assert found[14]["geography_match_status"] == "ambiguous"
    assert pick(15, *decision) == (None, "unknown", "invalid_address")


def test_override_wins_over_everything(spark):
    found = mapped(spark, [("  ", "Galway"), ("1 Church Street, Galway", "Galway")], [configs.Override("r0", "Ranelagh", "inference")])
    assert (found[0]["canonical_area"], found[0]["geography_match_status"], found[0]["geography_match_priority"]) == ("Ranelagh", "manual_override", 0)
    assert found[1]["geography_match_status"] == "unmatched"


def test_reviewed_areas():
    aliases = configs.read_aliases()
    assert len(aliases) == 58 and len(areas.SCOPE_BY_AREA) == 52
    assert [a.area for a in aliases[:2]] == ["Mount Merrion", "Mount Merrion"] and aliases[-1].area == "Merrion"


def table(tmp_path, columns, rows):
    path = tmp_path / "t.csv"
    with path.open("w", newline="", encoding="utf-8") as handle:
        writer = csv.writer(handle)
        writer.writerow(columns)
        writer.writerows(rows)
    return path


@pytest.mark.parametrize("change", [{"canonical_area": "Atlantis"}, {"scope": "elsewhere"}, {"match_type": "guess"}, {"alias": " "}, {"match_priority": "x"}])
def test_bad_alias_tables(tmp_path, change):
    rows = areas.alias_rows()
    rows[0] = rows[0] | change
    with pytest.raises(GeographyConfigError):
        configs.read_aliases(table(tmp_path, configs.ALIAS_COLUMNS, [list(r.values()) for r in rows]))


def test_alias_table_must_cover_all_areas(tmp_path):
    with pytest.raises(GeographyConfigError):
        configs.read_aliases(table(tmp_path, configs.ALIAS_COLUMNS, [list(r.values()) for r in areas.alias_rows()[1:]]))


@pytest.mark.parametrize(
    "rows",
    [[("r1", "Atlantis", "inference")], [("r1", "Ranelagh", "training_only")], [("r1", "Ranelagh", "inference"), ("r1", "Rathgar", "inference")]],
)
def test_bad_overrides(tmp_path, rows):
    with pytest.raises(GeographyConfigError):
        configs.read_overrides(table(tmp_path, configs.OVERRIDE_COLUMNS, [(*r, "", "", "", "") for r in rows]), configs.read_aliases())


def test_overrides_may_repeat_and_be_absent(tmp_path):
    aliases = configs.read_aliases()
    path = table(tmp_path, configs.OVERRIDE_COLUMNS, [("r1", "Ranelagh", "inference", "", "", "", "")] * 2 + [("", "x", "y", "", "", "", "")])
    assert configs.read_overrides(path, aliases) == [configs.Override("r1", "Ranelagh", "inference")]
    assert configs.read_overrides(tmp_path / "none.csv", aliases) == []


def test_stream_equals_batch(spark, tmp_path):
    from deedflow.streaming.stateless import enrich_stream

    df = spark.createDataFrame([("r1", "1 Ranelagh, Dublin 6", "Dublin"), ("r2", "Apartments 1-12, Dalkey", "Dublin")], "record_id string, raw_address string, county_raw string")
    df.write.parquet(str(tmp_path / "in"))
    aliases, rules = configs.read_aliases(), configs.read_rules(spark)
    stream = enrich_stream(spark.readStream.schema(df.schema).parquet(str(tmp_path / "in")), aliases, rules)
    running = stream.writeStream.format("memory").queryName("enriched").option("checkpointLocation", str(tmp_path / "c")).start()
    running.processAllAvailable()
    running.stop()
    assert sorted(map(tuple, spark.table("enriched").collect())) == sorted(map(tuple, enrich_stream(df, aliases, rules).collect()))


def test_tidying_by_parts_and_words(spark):
    from deedflow.functions.unicode import composed_latin

    cases = {
        "a,,,b": "A, B", ", a , , b ,": "A, B", "st.-x rd.": "STREET. - X ROAD", "o'co. x": "O'COUNTY X", "abcde. x": "ABCDE. X", "Úst. x": "ÚST. X", "a.b. c..d": "A.B C.D", "x--y": "X - - Y",
        "dún   laoghaire": "DÚN LAOGHAIRE", "": "",
    }
    df = spark.createDataFrame(list(cases.items()), "t string, want string")
    for r in df.withColumn("got", T.normalise(composed_latin(F.col("t")))).collect():
        assert r["got"] == r["want"] == T.normalise_text(r["t"])


def test_references_to_a_district_alone(spark):
    yes = ["DUBLIN", "COUNTY DUBLIN", "DUBLIN 4", "DUBLIN 6W", "DUBLIN 16"]
    no = ["DUBLIN 123", "DUBLIN 4 X", "MAIN STREET DUBLIN", "COUNTY", "DUBLIN W", ""]
    df = spark.createDataFrame([(t,) for t in yes + no], "t string")
    assert [r["t"] for r in df.where(geography.district_only(F.col("t"))).collect()] == yes

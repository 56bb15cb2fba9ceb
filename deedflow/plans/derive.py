"""Inputs derived from the driver's tables, in SQL that both Spark and DuckDB read."""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, SparkSession

TABLES = "region nation customer supplier part orders lineitem events".split()


def derived(spark: SparkSession, sf_dir: str, sql: str) -> DataFrame:
    """``sql`` over the Parquet tables that it names in braces."""
    names = sorted({n for n in TABLES if "{" + n + "}" in sql})
    return spark.sql(sql, **{n: spark.read.parquet(f"{sf_dir}/{n}.parquet") for n in names})


def plain(sql: str) -> str:
    """The same statement for DuckDB, whose tables are views of these names."""
    return re.sub(r"\{(\w+)\}", r"\1", sql)


SALES = """
SELECT o_orderkey, CAST(o_orderdate AS DATE) AS transaction_date, o_totalprice AS price, n_name AS canonical_area, c_mktsegment AS property_type
FROM {orders} JOIN {customer} ON o_custkey = c_custkey JOIN {nation} ON c_nationkey = n_nationkey
WHERE o_totalprice > 0
"""

TRAINING = """
SELECT o_orderkey,
       CASE WHEN o_orderkey % 7 = 0 THEN '' WHEN o_orderkey % 11 = 0 THEN 'abc' WHEN o_orderkey % 13 = 0 THEN '-5' WHEN o_orderkey % 17 = 0 THEN 'nan'
            ELSE concat(' 1,', CAST(o_orderkey % 900 + 100 AS STRING), '.5') END AS sale_price_eur,
       CASE o_orderkey % 5 WHEN 0 THEN 'Terraced House' WHEN 1 THEN ' House ' WHEN 2 THEN 'Castle' WHEN 3 THEN '' ELSE 'Detached House' END AS property_type,
       CASE o_orderstatus WHEN 'P' THEN ' Yes' WHEN 'F' THEN 'no' END AS exclude_from_training
FROM {orders}
"""

DATES = """
SELECT o_orderkey,
       CASE o_orderkey % 6
         WHEN 1 THEN '  ' WHEN 2 THEN CAST(d AS STRING) WHEN 3 THEN '31/02/2001'
         WHEN 4 THEN concat(CAST(day(d) AS STRING), '/', CAST(month(d) AS STRING), '/', CAST(year(d) AS STRING))
         ELSE concat(lpad(CAST(day(d) AS STRING), 2, '0'), '/', lpad(CAST(month(d) AS STRING), 2, '0'), '/', CAST(year(d) AS STRING)) END AS date_text
FROM (SELECT o_orderkey, CAST(o_orderdate AS DATE) AS d FROM {orders}) AS dated
"""

PRICES = """
SELECT o_orderkey,
       CASE o_orderkey % 9
         WHEN 1 THEN '' WHEN 2 THEN 'not money' WHEN 3 THEN '€0.00' WHEN 4 THEN '€-1.00' WHEN 5 THEN '1e3'
         WHEN 6 THEN concat('€', CAST(o_orderkey % 90 + 1 AS STRING), ',000.10')
         ELSE concat(' €', CAST(o_orderkey % 977 AS STRING), '.', lpad(CAST(o_orderkey % 1000 AS STRING), 3, '0')) END AS price_text,
       CASE o_orderkey % 4 WHEN 0 THEN ' YES ' WHEN 1 THEN 'No' WHEN 2 THEN 'Maybe' ELSE ' ' END AS vat_text,
       CASE o_orderkey % 5 WHEN 0 THEN 'no' WHEN 1 THEN 'Yes' WHEN 2 THEN '?' WHEN 3 THEN '' END AS market_text,
       CASE o_orderkey % 7 WHEN 0 THEN 'Second-Hand Dwelling house /Apartment' WHEN 1 THEN 'New Dwelling house /Apartment' WHEN 2 THEN 'Teach/Árasán Cónaithe Nua'
                           WHEN 3 THEN 'Villa' WHEN 4 THEN ' ' WHEN 5 THEN 'new dwelling house /apartment' END AS description_text
FROM {orders}
"""

#: Raw register rows; the columns get the register's names in ``catalog``.
REGISTER = """
SELECT CASE o_orderkey % 4 WHEN 1 THEN ' ' WHEN 2 THEN CAST(d AS STRING) ELSE concat(CAST(day(d) AS STRING), '/', CAST(month(d) AS STRING), '/', CAST(year(d) AS STRING)) END AS c1,
       concat(CAST(o_custkey AS STRING), ' Main Street, Ranelagh') AS c2, CASE o_orderkey % 3 WHEN 0 THEN 'Dublin' WHEN 1 THEN 'Cork' ELSE '' END AS c3,
       CASE WHEN o_orderkey % 5 = 0 THEN 'D06 XY00' ELSE '' END AS c4, CASE o_orderkey % 6 WHEN 0 THEN '' WHEN 1 THEN 'n/a' ELSE concat('€', CAST(o_orderkey AS STRING), ',500.25') END AS c5,
       CASE o_orderkey % 5 WHEN 0 THEN 'Yes' WHEN 1 THEN '' ELSE 'No' END AS c6, CASE o_orderkey % 7 WHEN 0 THEN 'Yes' WHEN 1 THEN '?' ELSE 'No' END AS c7,
       CASE o_orderkey % 3 WHEN 0 THEN 'New Dwelling house /Apartment' WHEN 1 THEN '' ELSE 'Villa' END AS c8, CASE WHEN o_orderkey % 8 = 0 THEN 'greater than 38 sq metres' ELSE '' END AS c9
FROM (SELECT o_orderkey, o_custkey, CAST(o_orderdate AS DATE) AS d FROM {orders}) AS dated
"""

#: (address, county) of the address queries; each part gets one of them.
ADDRESSES = (
    ("1 Main Street, Ranelagh, Dublin 6", "Dublin"),
    ("  12   main rd ,  ranelagh..  ", "Dublin"),
    ("2 Village Road, Harold’s Cross, Dublin 6W", "Dublin"),
    ("3 Coast Road, Monkstown, Co Dublin", ""),
    ("10 Dún Laoghaire – Dublin", "Dublin"),
    ("4 Marine Rd., Dun-Laoghaire", "Dublin"),
    ("1 Unknown Road, Dublin", "Dublin"),
    ("1 Church Street, Galway", "Galway"),
    ("5 Ranelagh, Rathmines, Dublin 6", "Dublin"),
    ("6 Mount Merrion, County Dublin", ""),
    ("1 Blackrocket Road", "Dublin"),
    ("Dublin 4", "Dublin"),
    ("7 Hill, Dún Laoghaire-Rathdown", "Dublin"),
    ("8 Blackrock", "Cork"),
    ("9 Ranelagh", "Galway"),
    ("Dublin Road, Blackrock", "Louth"),
    (" ... ,,, ", "Dublin"),
    ("Ranelagh", "Dublin"),
    ("  ", "Dublin"),
    ("Mount Merrion, Blackrock, Merrion", "Dublin"),
    ("Apt. 5 St. John's Ave, Sandyford", "Dublin"),
    ("Flat 2, 7 Windy-Arbour", "DUBLIN"),
    ("Apartments 1-12, Test Court", "Dublin"),
    ("Block 8A and Block 8B, Test Court", "Dublin"),
    ("30 Apts and one commercial unit, Test Court", "Dublin"),
    ("Apt 7 Arranmore, 13-17 Pembroke Road", "Dublin"),
    ("Unit 4 Test Court", "Dublin"),
    ("30 Apartments 1-30 Inclusive, Block A and Block B", "Dublin"),
    ("4 Test Road, Captain's House", "Dublin"),
    ("Entire block, Test Court", "Dublin"),
)
_quote = lambda text: "'" + text.replace("'", "''") + "'"


def values(rows: list[tuple], alias: str) -> str:
    """An inline table that both engines read."""
    cell = lambda v: "NULL" if v is None else _quote(v) if isinstance(v, str) else str(v)
    return "(VALUES " + ", ".join("(" + ", ".join(map(cell, r)) + ")" for r in rows) + f") AS {alias}"


def spark_text(sql: str) -> str:
    """Spark escapes quotes in literals by a backslash."""
    return re.sub(r"(?<=\w)''(?=\w)", r"\\'", sql)


PLACES = (
    "SELECT CAST(p_partkey AS STRING) AS record_id, p_partkey, raw_address, county_raw FROM {part} JOIN "
    + values([(i, a, c) for i, (a, c) in enumerate(ADDRESSES)], "places(i, raw_address, county_raw)")
    + f" ON p_partkey % {len(ADDRESSES)} = i"
)

#: Letters with combining marks, as some sources write them; each nation gets one of these words.
MARKED = ("Du\u0301n", "e\u0323\u0302", "A\u030a", "\u00e9\u0323", "n\u0303o", "plain", "Z\u030c\u0301", "\u0301 alone")
MARKED_TEXTS = "SELECT n_nationkey, concat(word, ' ', n_name, ' ', word) AS raw FROM {nation} JOIN " + values(list(enumerate(MARKED)), "words(i, word)") + f" ON n_nationkey % {len(MARKED)} = i"

#: Evidence of every kind, dealt out over the orders.
EVIDENCE = """
SELECT CASE WHEN o_orderkey % 97 = 0 THEN NULL ELSE CAST(o_orderkey AS STRING) END AS record_id,
       CASE WHEN o_orderkey % 89 = 0 THEN '  ' ELSE o_orderpriority END AS raw_address,
       CASE WHEN o_orderkey % 31 = 0 THEN NULL ELSE CAST(o_orderdate AS DATE) END AS transaction_date,
       CASE WHEN o_orderkey % 31 = 0 THEN 'invalid' ELSE 'parsed' END AS date_parse_status,
       CASE WHEN o_orderkey % 31 = 0 THEN NULL ELSE o_orderkey % 41 = 0 END AS is_future_transaction,
       CASE WHEN o_orderkey % 23 = 0 THEN NULL WHEN o_orderkey % 29 = 0 THEN CAST(0 AS DECIMAL(18,2)) ELSE CAST(o_orderkey AS DECIMAL(18,2)) END AS sale_price_eur_adjusted,
       CASE WHEN o_orderkey % 23 = 0 THEN 'missing' ELSE 'parsed' END AS price_parse_status,
       CASE o_orderstatus WHEN 'F' THEN true WHEN 'O' THEN o_orderkey % 3 > 0 END AS is_full_market_price,
       CASE WHEN o_orderkey % 37 = 0 THEN NULL WHEN o_orderkey % 43 = 0 THEN 'unrecognised' ELSE 'mapped_full_market' END AS full_market_price_mapping_status,
       CASE o_custkey % 5 WHEN 0 THEN 'out_of_scope' WHEN 1 THEN 'unknown' WHEN 2 THEN 'training_only' ELSE 'inference' END AS geo_scope,
       CASE WHEN o_custkey % 5 = 0 THEN 'unmatched' WHEN o_custkey % 5 > 1 THEN 'matched' WHEN o_custkey % 2 = 0 THEN 'ambiguous' WHEN o_custkey % 3 = 0 THEN 'invalid_address' ELSE 'unmatched' END AS geography_match_status,
       CASE o_orderkey % 8 WHEN 0 THEN 'clearly_non_house' WHEN 1 THEN 'review_required' ELSE 'unresolved_house_or_apartment' END AS property_scope_status,
       CASE o_orderkey % 19 WHEN 0 THEN 'auto_exclude' WHEN 1 THEN 'review_only' ELSE 'none' END AS multi_property_action,
       CASE o_orderkey % 17 WHEN 0 THEN 'auto_exclude' WHEN 1 THEN 'review_only' WHEN 2 THEN 'retain_representative' ELSE 'none' END AS duplicate_action,
       CASE o_orderkey % 17 WHEN 0 THEN 'exact_source_duplicate' WHEN 1 THEN 'plausible_duplicate_publication' WHEN 2 THEN 'exact_source_duplicate' WHEN 3 THEN 'same_day_distinct_transaction' ELSE 'not_duplicate_like' END AS duplicate_status,
       CASE WHEN o_orderkey % 47 = 0 THEN NULL ELSE 'mapped_vat_inclusive' END AS vat_mapping_status,
       CASE WHEN o_orderkey % 53 = 0 THEN 'unresolved_vat_flag' ELSE 'none' END AS sale_price_adjustment_method,
       CASE WHEN o_orderkey % 10 = 0 THEN 'too_short_address|broad_locality_only' ELSE '' END AS address_quality_flags,
       CASE WHEN o_orderkey % 14 = 0 THEN 'conflicting_county_context|too_short_address' END AS geography_quality_flags,
       o_orderkey, o_custkey
FROM {orders}
"""

#: Records with keys coarse enough for every tier of duplicates.
RECORDS = """
SELECT CAST(l_orderkey * 10 + l_linenumber AS STRING) AS record_id, l_orderkey * 10 + l_linenumber AS source_row_number,
       concat(CAST(l_partkey % 400 AS STRING), '-', CAST(l_suppkey % 5 AS STRING), '-', CAST(CAST(l_quantity AS INT) % 10 AS STRING), '-', l_returnflag) AS raw_record_fingerprint,
       CASE WHEN l_partkey % 50 = 0 THEN NULL ELSE concat('ADDRESS ', CAST(l_partkey % 400 AS STRING)) END AS address_normalized,
       make_date(CAST(year(l_shipdate) AS INT), CAST(month(l_shipdate) AS INT), 1) AS transaction_date,
       CAST(l_partkey % 9 AS DECIMAL(18,2)) AS sale_price_eur_raw,
       CAST(l_partkey % 9 AS DECIMAL(18,2)) AS sale_price_eur_adjusted,
       CASE WHEN l_returnflag = 'N' THEN true WHEN l_returnflag = 'A' THEN false END AS is_full_market_price,
       l_linestatus = 'O' AS vat_exclusive_flag,
       CASE WHEN l_linenumber > 3 THEN 'Second-Hand' ELSE 'New' END AS property_description_raw
FROM {lineitem}
"""

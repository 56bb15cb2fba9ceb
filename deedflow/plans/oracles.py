"""DuckDB statements that give the results of the registered queries in another way."""

from __future__ import annotations

from ..config import areas
from ..functions import parsing, text
from ..operators import cleaning, geography, profile, rules
from ..sources import configs, register
from .derive import DATES, EVIDENCE, MARKED_TEXTS, PLACES, PRICES, RECORDS, REGISTER, SALES, TRAINING, plain, values

KINDS = ", ".join(f"'{k}'" for k in parsing.PROPERTY_TYPES)


def _model(supports: tuple[int, ...], holdout: int, years: int | None = None) -> str:
    since = f"AND transaction_date >= c - INTERVAL {years} YEAR" if years else ""
    return f"""
WITH sales AS ({plain(SALES)}),
latest AS (SELECT max(transaction_date) AS d FROM sales),
cut AS (
  SELECT make_date(year(d - INTERVAL {holdout} MONTH)::INT, month(d - INTERVAL {holdout} MONTH)::INT, least(day(d), 28)::INT) AS c FROM (SELECT d FROM latest) AS l),
train AS (SELECT canonical_area AS a, property_type AS k, ln(price) AS lp FROM sales, cut WHERE transaction_date < c {since}),
held AS (SELECT sales.* FROM sales, cut WHERE transaction_date >= c),
pair AS (SELECT a, k, median(lp) AS m, count(*) AS n FROM train GROUP BY a, k),
area AS (SELECT a, median(lp) AS m, count(*) AS n FROM train GROUP BY a),
kind AS (SELECT k, median(lp) AS m, count(*) AS n FROM train GROUP BY k),
everything AS (SELECT median(lp) AS m, count(*) AS n FROM train),
supports(s) AS (VALUES {", ".join(f"({s})" for s in supports)}),
predicted AS (
  SELECT held.*, s,
         CASE WHEN pair.n >= s THEN pair.m WHEN area.n >= s THEN area.m WHEN kind.n >= s THEN kind.m ELSE everything.m END AS m,
         CASE WHEN pair.n >= s THEN pair.n WHEN area.n >= s THEN area.n WHEN kind.n >= s THEN kind.n ELSE everything.n END AS n,
         CASE WHEN pair.n >= s THEN 'area_property_type' WHEN area.n >= s THEN 'area' WHEN kind.n >= s THEN 'property_type' ELSE 'global' END AS backoff_level
  FROM held CROSS JOIN supports CROSS JOIN everything
       LEFT JOIN pair ON pair.a = canonical_area AND pair.k = property_type LEFT JOIN area ON area.a = canonical_area LEFT JOIN kind ON kind.k = property_type)
"""


CONFIDENCE = "CASE WHEN {level} = 'global' OR {n} < 5 THEN 'not_enough_comparable_support' WHEN {n} < 15 OR {level} <> 'area_property_type' THEN 'low_confidence' ELSE 'normal_confidence' END"
TRIM = r"regexp_replace({c}, '^\s+|\s+$', '', 'g')"


def _trim(c: str) -> str:
    return TRIM.replace("{c}", c)


DATE_SQL = f"""
SELECT o_orderkey, d AS transaction_date, year(d) AS transaction_year,
       CASE WHEN d IS NOT NULL THEN 'parsed' WHEN trim(date_text) = '' THEN 'missing' ELSE 'invalid' END AS date_parse_status,
       d > DATE '1998-01-01' AS is_future_transaction
FROM (SELECT *, try_strptime(date_text, '%d/%m/%Y')::DATE AS d FROM ({plain(DATES)}) AS texts) AS parsed
"""

_VAT = f"""
WITH texts AS ({plain(PRICES)}),
parsed AS (SELECT *, TRY_CAST(replace(replace(trim(price_text), '€', ''), ',', '') AS DECIMAL(18,2)) AS p, lower(trim(vat_text)) AS v, lower(trim(market_text)) AS m FROM texts),
judged AS (SELECT *, CASE WHEN trim(price_text) = '' THEN 'missing' WHEN p IS NULL THEN 'invalid' WHEN p <= 0 THEN 'non_positive' ELSE 'parsed' END AS status FROM parsed)
"""
PRICE_SQL = (
    _VAT
    + """
SELECT o_orderkey, p AS sale_price_eur_raw, status AS price_parse_status,
       CASE WHEN status = 'parsed' AND v = 'yes' THEN CAST(0.135 AS DECIMAL(5,3)) WHEN status = 'parsed' AND v = 'no' THEN CAST(0 AS DECIMAL(5,3)) END AS vat_rate_applied,
       CASE WHEN status = 'parsed' AND v = 'yes' THEN CAST(((CAST(p * 100 AS BIGINT) * 1135 + 500) // 1000) AS DECIMAL(18,0)) / CAST(100 AS DECIMAL(18,0))
            WHEN status = 'parsed' AND v = 'no' THEN p END::DECIMAL(18,2) AS sale_price_eur_adjusted,
       CASE WHEN status <> 'parsed' THEN 'invalid_raw_price' WHEN v = 'yes' THEN 'provisional_house_vat_13_5_percent' WHEN v = 'no' THEN 'none' ELSE 'unresolved_vat_flag' END AS sale_price_adjustment_method
FROM judged
"""
)
FLAG_SQL = (
    _VAT
    + """
SELECT o_orderkey, CASE m WHEN 'no' THEN true WHEN 'yes' THEN false END AS is_full_market_price,
       CASE WHEN coalesce(m, '') = '' THEN 'missing' WHEN m = 'no' THEN 'mapped_full_market' WHEN m = 'yes' THEN 'mapped_not_full_market' ELSE 'unrecognised' END AS market_status,
       CASE v WHEN 'yes' THEN true WHEN 'no' THEN false END AS vat_exclusive_flag,
       CASE WHEN coalesce(v, '') = '' THEN 'missing' WHEN v = 'yes' THEN 'mapped_vat_exclusive' WHEN v = 'no' THEN 'mapped_vat_inclusive' ELSE 'unrecognised' END AS vat_status
FROM judged
"""
)
DESCRIPTION_SQL = f"""
WITH texts AS (SELECT o_orderkey, CASE WHEN trim(description_text) <> '' THEN description_text END AS description FROM ({plain(PRICES)}) AS p),
known AS (SELECT * FROM {values([(k, a, int(b)) for k, (a, b) in parsing.DESCRIPTIONS.items()], "k(t, kind, fresh)")})
SELECT o_orderkey, description, coalesce(kind, 'unknown') AS property_description_normalized,
       CASE WHEN kind IS NOT NULL THEN 'exact_source_value_mapping' WHEN description IS NULL THEN 'missing' ELSE 'unrecognised' END AS property_description_mapping_method,
       fresh = 1 AS is_new_build
FROM texts LEFT JOIN known ON description = t
"""


def _register() -> str:
    pairs = sorted((name, f"c{i}") for i, name in enumerate(register.REQUIRED, 1))
    # the values hold no character that JSON escapes
    payload = " || ',' || ".join(f"""'["{name}","' || {c} || '"]'""" for name, c in pairs)
    return f"""
WITH raw AS ({plain(REGISTER)}),
n AS (SELECT *, CASE WHEN trim(c4) <> '' THEN c4 END AS eircode, CASE WHEN trim(c6) <> '' THEN c6 END AS market, CASE WHEN trim(c7) <> '' THEN c7 END AS vat, CASE WHEN trim(c8) <> '' THEN c8 END AS kind,
             CASE WHEN trim(c9) <> '' THEN c9 END AS size, try_strptime(c1, '%d/%m/%Y')::DATE AS d, TRY_CAST(replace(replace(c5, '€', ''), ',', '') AS DECIMAL(18,2)) AS p FROM raw)
SELECT 'ppr' AS source_name, DATE '2000-01-01' AS source_snapshot_date, repeat('0', 64) AS source_file_sha256, sha256('[' || {payload} || ']') AS raw_record_fingerprint,
       c1 AS transaction_date_raw, d AS transaction_date, year(d) AS transaction_year, CASE WHEN d IS NOT NULL THEN 'parsed' WHEN trim(c1) = '' THEN 'missing' ELSE 'invalid' END AS date_parse_status,
       d > DATE '2000-01-01' AS is_future_transaction, c2 AS raw_address, c3 AS county_raw, eircode AS eircode_raw, c5 AS sale_price_eur_raw_text, p AS sale_price_eur_raw,
       CASE WHEN c5 = '' THEN 'missing' WHEN p IS NULL THEN 'invalid' ELSE 'parsed' END AS price_parse_status,
       market AS not_full_market_price_raw, CASE market WHEN 'No' THEN true WHEN 'Yes' THEN false END AS is_full_market_price,
       CASE WHEN market IS NULL THEN 'missing' WHEN market = 'No' THEN 'mapped_full_market' ELSE 'mapped_not_full_market' END AS full_market_price_mapping_status,
       vat AS vat_exclusive_raw, CASE vat WHEN 'Yes' THEN true WHEN 'No' THEN false END AS vat_exclusive_flag,
       CASE vat WHEN 'Yes' THEN 'mapped_vat_exclusive' WHEN 'No' THEN 'mapped_vat_inclusive' ELSE 'unrecognised' END AS vat_mapping_status,
       CASE WHEN p IS NULL OR vat = '?' THEN NULL WHEN vat = 'Yes' THEN CAST(0.135 AS DECIMAL(5,3)) ELSE CAST(0 AS DECIMAL(5,3)) END AS vat_rate_applied,
       CASE WHEN p IS NULL OR vat = '?' THEN NULL WHEN vat = 'Yes' THEN CAST((CAST(p * 100 AS BIGINT) * 1135 + 500) // 1000 AS DECIMAL(18,0)) / CAST(100 AS DECIMAL(18,0)) ELSE p END::DECIMAL(18,2) AS sale_price_eur_adjusted,
       CASE WHEN p IS NULL THEN 'invalid_raw_price' WHEN vat = '?' THEN 'unresolved_vat_flag' WHEN vat = 'Yes' THEN 'provisional_house_vat_13_5_percent' ELSE 'none' END AS sale_price_adjustment_method,
       kind AS property_description_raw, CASE WHEN kind LIKE 'New%' THEN 'new_dwelling' ELSE 'unknown' END AS property_description_normalized,
       CASE WHEN kind IS NULL THEN 'missing' WHEN kind LIKE 'New%' THEN 'exact_source_value_mapping' ELSE 'unrecognised' END AS property_description_mapping_method,
       CASE WHEN kind LIKE 'New%' THEN true END AS is_new_build, 'unknown' AS property_type, 'unknown' AS property_type_source, 'ppr_house_apartment_ambiguous' AS property_type_quality_flag,
       size AS property_size_description_raw, size AS property_size_bucket_source, NULL::DOUBLE AS floor_area_sqm
FROM n
"""


def _tidy() -> str:
    upper = f"upper(translate(raw_address, '{text.APOSTROPHES}{text.DASHES}', '{"''" * len(text.APOSTROPHES)}{'-' * len(text.DASHES)}'))"
    split = lambda c: rf"list_filter(regexp_split_to_array({c}, '\s+'), lambda w: w <> '')"
    word = r"replace(regexp_replace(regexp_replace(w, '\.+', '.', 'g'), '((?:^|[^\w\pL])[A-Z]{1,4})\.$', '\1'), '-', ' - ')"
    part = f"array_to_string({split(f"array_to_string(list_transform({split('p')}, lambda w: {word}), ' ')")}, ' ')"
    joined = f"trim(array_to_string(list_filter(list_transform(string_split({upper}, ','), lambda p: {part}), lambda p: p <> ''), ', '), ' ,.')"
    run = " ".join(f"WHEN '{a}' THEN '{b}'" for a, b in text.ABBREVIATIONS)
    return rf"array_to_string(list_transform(regexp_extract_all({joined}, '[\w\pL]+|[^\w\pL]+'), lambda r: CASE r {run} ELSE r END), '')"


ADDRESS_CTE = f"""
places AS ({plain(PLACES)}),
tidied AS (SELECT *, {_tidy()} AS tidy FROM places),
measured AS (
  SELECT *, strip_accents(tidy) AS folded, trim(raw_address) = '' AS blank, NOT regexp_matches(tidy, '[A-Z0-9]') AS mute,
         len(regexp_extract_all(tidy, '[A-Z0-9]+')) AS many, regexp_extract_all(strip_accents(tidy), '[A-Z0-9]+') AS words FROM tidied),
addressed AS (
  SELECT *, CASE WHEN NOT (blank OR mute) THEN tidy END AS address_normalized, CASE WHEN NOT (blank OR mute) THEN folded END AS address_match_text,
         CASE WHEN blank OR mute THEN 'missing' WHEN many < 2 THEN 'too_short' ELSE 'normalized' END AS address_normalization_status,
         array_to_string(list_filter([
           CASE WHEN blank THEN 'missing_raw_address' END, CASE WHEN NOT blank AND mute THEN 'punctuation_only_address' END,
           CASE WHEN NOT (blank OR mute) AND many < 2 THEN 'too_short_address' END,
           CASE WHEN NOT (blank OR mute) AND len(words) BETWEEN 1 AND 3 AND len(list_filter(words, lambda w: regexp_full_match(w, '[0-9]+'))) = 0
                     AND len(list_filter(words, lambda w: w NOT IN ({", ".join(f"'{w}'" for w in geography.BROAD_WORDS)}))) > 0 THEN 'broad_locality_only' END],
           lambda f: f IS NOT NULL), '|') AS address_quality_flags
  FROM measured)
"""


def _areas() -> str:
    aliases = values([(a.area, a.alias, a.scope, a.match_type, a.priority, a.text) for a in configs.read_aliases()], "al(area, alias, scope, method, priority, txt)")
    blocked_area, blocked = areas.BLOCKED
    authority = " OR ".join(f"contains(address_match_text, '{p}')" for p in blocked)
    broad = ", ".join(f"'{b}'" for b in areas.BROAD_REFERENCES)
    unusual = ", ".join(f"'{a}'" for a in areas.NON_UNIQUE_AREAS)
    listed = lambda f: f"coalesce((SELECT string_agg(x, '|' ORDER BY x) FROM (SELECT DISTINCT unnest(list_transform(shown, lambda m: m.{f}::VARCHAR)) AS x) AS d), '')"
    return f"""
WITH {ADDRESS_CTE},
aliases AS (SELECT * FROM {aliases}),
hits AS (
  SELECT p_partkey, area, scope, method, alias, priority, txt,
         row_number() OVER (PARTITION BY p_partkey, area ORDER BY priority, alias) AS nth
  FROM addressed JOIN aliases ON regexp_matches(address_match_text, '(^|[^A-Z0-9])' || replace(regexp_escape(txt), '\\ ', '\\s+') || '([^A-Z0-9]|$)')),
named AS (
  SELECT p_partkey, list({{'priority': priority, 'area': area, 'scope': scope, 'method': method, 'alias': alias, 'txt': txt}} ORDER BY priority, area) AS named FROM hits WHERE nth = 1 GROUP BY p_partkey),
judged AS (
  SELECT a.*, coalesce(named, []) AS named,
         list_filter(coalesce(named, []), lambda m: NOT (m.area = '{blocked_area}' AND ({authority}))) AS allowed,
         upper(trim(county_raw)) AS county,
         upper(trim(county_raw)) = 'DUBLIN' OR coalesce(regexp_matches(address_match_text, '(^|[^A-Z0-9])DUBLIN([^A-Z0-9]|$)'), false) AS context,
         address_normalization_status <> 'normalized' AS invalid
  FROM addressed a LEFT JOIN named n ON a.p_partkey = n.p_partkey),
resolved AS (
  SELECT *, len(allowed) > 1 AS several,
         coalesce(len(allowed) > 1 AND allowed[1].priority <= 10 AND allowed[2].priority >= 80 AND contains(allowed[1].txt, allowed[2].txt) AND allowed[1].txt <> allowed[2].txt, false) AS resolves
  FROM judged),
decided AS (
  SELECT *, NOT invalid AND context AND len(allowed) > 0 AND (NOT several OR resolves) AS matched, NOT invalid AND context AND several AND NOT resolves AS ambiguous FROM resolved),
shown AS (SELECT *, CASE WHEN matched OR ambiguous THEN allowed ELSE [] END AS shown FROM decided),
mapped AS (
  SELECT p_partkey, CASE WHEN matched THEN allowed[1].area END AS canonical_area,
         CASE WHEN matched THEN allowed[1].scope WHEN NOT invalid AND NOT context AND county NOT IN ('', 'DUBLIN') THEN 'out_of_scope' ELSE 'unknown' END AS geo_scope,
         CASE WHEN invalid THEN 'invalid_address' WHEN matched THEN 'matched' WHEN ambiguous THEN 'ambiguous' ELSE 'unmatched' END AS geography_match_status,
         CASE WHEN matched THEN allowed[1].method ELSE 'none' END AS geography_match_method,
         CASE WHEN matched THEN allowed[1].alias END AS geography_match_alias,
         CASE WHEN matched THEN allowed[1].priority END::BIGINT AS geography_match_priority,
         {listed("area")} AS geography_candidate_areas,
         array_to_string(list_sort(list_filter([
           CASE WHEN invalid THEN 'invalid_or_missing_address' END,
           CASE WHEN NOT invalid AND (address_match_text IN ('{areas.CAPITAL}', 'COUNTY {areas.CAPITAL}') OR regexp_matches(address_match_text, '^{areas.CAPITAL} [0-9][0-9]?[A-Z]?$') OR address_match_text IN ({broad})) THEN 'broad_dublin_reference_only' END,
           CASE WHEN NOT invalid AND len(named) > 0 AND county NOT IN ('', 'DUBLIN') THEN 'conflicting_county_context' END,
           CASE WHEN NOT invalid AND len(list_filter(named, lambda m: m.area IN ({unusual}))) > 0 THEN 'non_unique_locality_name' END,
           CASE WHEN NOT invalid AND NOT context AND len(named) > 0 THEN 'canonical_alias_outside_expected_dublin_context' END,
           CASE WHEN matched AND several THEN 'multiple_candidates_priority_resolved' END, CASE WHEN ambiguous THEN 'multiple_candidate_areas' END], lambda f: f IS NOT NULL)), '|') AS geography_quality_flags,
         {listed("alias")} AS matched_aliases, {listed("method")} AS match_methods, {listed("priority")} AS match_priorities
  FROM shown)
"""


def _coverage() -> str:
    return f"""{_areas()},
listed AS (SELECT * FROM {values([(a,) for a in areas.SCOPE_BY_AREA], "l(area)")}),
dated AS (SELECT *, DATE '2020-01-01' + (p_partkey % 1000)::INT AS d FROM mapped WHERE canonical_area IS NOT NULL),
methods AS (SELECT canonical_area, string_agg(geography_match_method || '=' || n, '|' ORDER BY geography_match_method) AS methods FROM (SELECT canonical_area, geography_match_method, count(*) AS n FROM dated GROUP BY ALL) AS c GROUP BY 1),
grouped AS (SELECT canonical_area, count(*) AS n, min(d) AS f, max(d) AS l, count(DISTINCT geography_match_alias) AS a FROM dated GROUP BY 1)
SELECT area, coalesce(n, 0) AS rows, f AS first_date, l AS last_date, coalesce(a, 0) AS aliases, coalesce(methods, '') AS methods
FROM listed LEFT JOIN grouped g ON g.canonical_area = area LEFT JOIN methods m ON m.canonical_area = area
"""


def _rules() -> str:
    """The rule table as read from its file, with ranks; patterns of this file suit RE2 too."""
    import csv

    with configs.RULES_FILE.open(encoding="utf-8", newline="") as handle:
        rows = [(r["rule_id"], r["description"], r["matcher"], r["pattern"], configs.SEVERITIES.index(r["severity"]), configs.ACTIONS.index(r["action"])) for r in csv.DictReader(handle)]
    named = lambda names, c: "CASE " + c + " " + " ".join(f"WHEN {i} THEN '{n}'" for i, n in enumerate(names)) + " END"
    return f"""
WITH places AS ({plain(PLACES)}), tidied AS (SELECT *, {_tidy()} AS tidy FROM places),
rules AS (SELECT * FROM {values(rows, "r(id, description, matcher, pattern, severity, action)")}),
hits AS (
  SELECT p_partkey, id, description, severity, action FROM tidied JOIN rules
  ON CASE matcher WHEN 'regex' THEN regexp_matches(tidy, '(?i)' || pattern) ELSE len(list_distinct(regexp_extract_all(tidy, '(?i)' || pattern, 1))) >= 2 END),
summed AS (
  SELECT t.p_partkey, count(id) AS n, coalesce(string_agg(id, '|' ORDER BY id), '') AS ids, coalesce(string_agg(description, '|' ORDER BY id), '') AS reasons, coalesce(max(severity), 0) AS s, coalesce(max(action), 0) AS a
  FROM tidied t LEFT JOIN hits h ON t.p_partkey = h.p_partkey GROUP BY 1)
SELECT p_partkey, n > 0 AS is_possible_multi_property_sale, ids AS multi_property_rule_ids, reasons AS multi_property_reason, {named(configs.SEVERITIES, "s")} AS multi_property_max_severity,
       {named(configs.ACTIONS, "a")} AS multi_property_action, {named(tuple(rules.CONFIDENCE[a] for a in configs.ACTIONS), "a")} AS single_dwelling_confidence
FROM summed
"""


SCOPE_SQL = f"""
WITH places AS ({plain(PLACES)}), tidied AS (SELECT *, {_tidy()} AS tidy FROM places),
found AS (
  SELECT *, regexp_matches(' ' || tidy || ' ', '\\W(APARTMENT|APARTMENTS)\\W') AS r0, regexp_matches(' ' || tidy || ' ', '\\W(FLAT|FLATS)\\W') AS r1,
         regexp_matches(' ' || tidy, '\\WAPT[. ]+[A-Z0-9]') AS r2, regexp_matches(' ' || tidy || ' ', '\\W(UNIT|UNITS)\\W') AS u FROM tidied),
judged AS (SELECT *, r0 OR r1 OR r2 AS clear, u AND NOT (r0 OR r1 OR r2) AS review FROM found)
SELECT p_partkey, CASE WHEN clear THEN 'clearly_non_house' WHEN review THEN 'review_required' ELSE 'unresolved_house_or_apartment' END AS property_scope_status,
       concat_ws('|', CASE WHEN r0 THEN 'PROP001' END, CASE WHEN r1 THEN 'PROP002' END, CASE WHEN r2 THEN 'PROP003' END, CASE WHEN review THEN 'PROP101' END) AS property_scope_rule_ids,
       concat_ws('|', CASE WHEN r0 THEN 'explicit apartment wording' END, CASE WHEN r1 THEN 'explicit flat wording' END,
                 CASE WHEN r2 THEN 'APT abbreviation with an identifier' END, CASE WHEN review THEN 'ambiguous UNIT wording' END) AS property_scope_reason
FROM judged
"""

HASH_SQL = """
WITH o AS (SELECT o_orderkey, o_orderpriority AS p, CASE WHEN o_orderkey % 3 = 0 THEN NULL ELSE o_orderstatus END AS g FROM orders)
SELECT o_orderkey, sha256('["ppr","abc",' || o_orderkey || ']') AS record_id,
       sha256('[["a","' || coalesce(g, '') || '"],["b","' || p || '"]]') AS fingerprint,
       sha256('["exact","' || coalesce(g, '<NULL>') || '","' || p || '"]') AS group_id
FROM o
"""

_DUPLICATES = f"""
WITH r AS ({plain(RECORDS)}),
k AS (
  SELECT *, coalesce(address_normalized, '<NULL>') AS ka, transaction_date::VARCHAR AS kd, sale_price_eur_raw::VARCHAR AS kr, sale_price_eur_adjusted::VARCHAR AS kp,
         coalesce(is_full_market_price::VARCHAR, '<NULL>') AS km, vat_exclusive_flag::VARCHAR AS kv, property_description_raw AS kt FROM r),
w AS (
  SELECT *, count(*) OVER fp AS nf, first_value(record_id) OVER (PARTITION BY raw_record_fingerprint ORDER BY source_row_number, record_id) AS rep,
         count(*) OVER pub AS np, count(DISTINCT raw_record_fingerprint) OVER pub AS vp, count(*) OVER weak AS nw,
         greatest(count(DISTINCT is_full_market_price) OVER weak, count(DISTINCT vat_exclusive_flag) OVER weak, count(DISTINCT property_description_raw) OVER weak) AS vw,
         count(*) OVER sd AS ns, count(DISTINCT address_normalized) OVER sd AS vs
  FROM k
  WINDOW fp AS (PARTITION BY raw_record_fingerprint), pub AS (PARTITION BY ka, kd, kr, kp, km, kv, kt), weak AS (PARTITION BY ka, kd, kp), sd AS (PARTITION BY kd, kp, km, kv)),
t AS (SELECT *, CASE WHEN nf > 1 THEN 1 WHEN np > 1 AND vp > 1 THEN 2 WHEN nw > 1 AND vw > 1 THEN 3 WHEN ns > 1 AND vs > 1 THEN 4 ELSE 0 END AS tier FROM w),
d AS (
SELECT record_id,
       CASE tier WHEN 1 THEN sha256('["exact","' || raw_record_fingerprint || '"]')
                 WHEN 2 THEN sha256('["publication","' || concat_ws('","', ka, kd, kr, kp, km, kv, kt) || '"]')
                 WHEN 3 THEN sha256('["unresolved","' || concat_ws('","', ka, kd, kp) || '"]') WHEN 4 THEN sha256('["same_day_distinct","' || concat_ws('","', kd, kp, km, kv) || '"]') END AS duplicate_group_id,
       CASE tier WHEN 1 THEN nf WHEN 2 THEN np WHEN 3 THEN nw WHEN 4 THEN ns ELSE 1 END AS duplicate_group_size,
       CASE tier WHEN 1 THEN 'exact_source_duplicate' WHEN 2 THEN 'plausible_duplicate_publication' WHEN 3 THEN 'unresolved_duplicate_like' WHEN 4 THEN 'same_day_distinct_transaction' ELSE 'not_duplicate_like' END AS duplicate_status,
       CASE tier WHEN 0 THEN '' ELSE 'DUP00' || tier END AS duplicate_rule_ids,
       CASE WHEN tier = 1 AND rep = record_id THEN 'retain_representative' WHEN tier = 1 THEN 'auto_exclude' WHEN tier IN (2, 3) THEN 'review_only' ELSE 'none' END AS duplicate_action,
       CASE WHEN tier = 1 THEN rep END AS duplicate_representative_record_id
FROM t)
"""

_CONDITIONS = {
    "invalid_target": "sale_price_eur_adjusted IS NULL OR price_parse_status IS DISTINCT FROM 'parsed' OR sale_price_eur_adjusted <= 0",
    "invalid_date": "transaction_date IS NULL OR date_parse_status IS DISTINCT FROM 'parsed' OR coalesce(is_future_transaction, false)",
    "non_full_market_transaction": "is_full_market_price = false",
    "unresolved_market_price_status": "is_full_market_price IS NULL OR coalesce(full_market_price_mapping_status, '') NOT IN ('mapped_full_market', 'mapped_not_full_market')",
    "out_of_scope_geography": "geo_scope = 'out_of_scope'",
    "unmatched_geography_unresolved": "geo_scope = 'unknown' AND geography_match_status IN ('unmatched', 'invalid_address')",
    "ambiguous_geography_unresolved": "geography_match_status = 'ambiguous'",
    "excluded_property_type": "property_scope_status = 'clearly_non_house'",
    "multi_property_transaction": "multi_property_action = 'auto_exclude'",
    "duplicate_unresolved": "duplicate_action = 'auto_exclude'",
    "unresolved_vat_treatment": "coalesce(vat_mapping_status, '') NOT IN ('mapped_vat_exclusive', 'mapped_vat_inclusive') OR sale_price_adjustment_method = 'unresolved_vat_flag'",
    "insufficient_required_fields": "record_id IS NULL OR trim(coalesce(raw_address, '')) = ''",
}
_FLAGS = (
    ("invalid_target", "invalid_target"), ("invalid_date", "invalid_date"), ("non_full_market_transaction", "possible_non_market_sale"), ("out_of_scope_geography", "out_of_scope_area"),
)


def _assessed() -> str:
    pick = lambda cases: "list_filter([" + ", ".join(f"CASE WHEN {c} THEN '{n}' END" for c, n in cases) + "], lambda x: x IS NOT NULL)"
    has = lambda r: f"list_contains(rs, '{r}')"
    ids = dict(cleaning.REASONS)
    flags = [(has(r), f) for r, f in _FLAGS] + [
        ("geography_match_status IN ('unmatched', 'invalid_address')", "unmatched_area"), ("geography_match_status = 'ambiguous'", "ambiguous_area"),
        ("property_scope_status = 'clearly_non_house'", "excluded_property_type"), ("property_scope_status <> 'clearly_non_house'", "unknown_property_type"),
        ("multi_property_action = 'auto_exclude'", "multi_property_auto_exclude"), ("multi_property_action = 'review_only'", "possible_multi_property_sale"),
        ("duplicate_status <> 'not_duplicate_like'", "duplicate_like"), ("duplicate_action = 'review_only'", "duplicate_review_required"), (has("unresolved_vat_treatment"), "unresolved_vat_treatment"),
    ]
    extra = " || ".join(f"list_filter(string_split(coalesce({c}, ''), '|'), lambda x: x <> '')" for c in ("address_quality_flags", "geography_quality_flags"))
    return f"""
WITH e AS ({plain(EVIDENCE)}),
r AS (SELECT *, {pick([(_CONDITIONS[n], n) for n, _ in cleaning.REASONS])} AS rs FROM e),
f AS (SELECT *, {pick(flags)} || {extra} AS fs FROM r),
a AS (
  SELECT *, len(rs) > 0 AS exclude_from_training, rs[1] AS exclusion_reason, array_to_string(rs, '|') AS exclusion_reasons,
         array_to_string(list_transform(rs, lambda x: MAP {{{", ".join(f"'{k}': '{v}'" for k, v in ids.items())}}}[x]), '|') AS exclusion_rule_ids,
         array_to_string(list_filter(fs, lambda x, i: list_position(fs, x) = i), '|') AS quality_flags,
         CASE WHEN len(rs) > 0 THEN 'excluded' WHEN multi_property_action = 'review_only' OR duplicate_action = 'review_only' OR property_scope_status = 'review_required' THEN 'eligible_with_review' ELSE 'eligible' END AS cleaning_assessment_status,
         geo_scope IN ('inference', 'training_only') AND geography_match_status = 'matched' AS locked
  FROM f)
"""


def _profile() -> str:
    one = lambda c: f"SELECT '{c}' AS metric, coalesce({c}::VARCHAR, '<NULL>') AS value, locked FROM a"
    tokens = "SELECT 'quality_flags' AS metric, unnest(string_split(quality_flags, '|')) AS value, locked FROM a WHERE quality_flags <> ''"
    cells = " UNION ALL ".join([*map(one, ("geo_scope", "exclusion_reason", "duplicate_status", "is_full_market_price")), tokens])
    return f"""{_assessed()}, cells AS ({cells}),
scoped AS (SELECT 'all' AS scope, metric, value FROM cells UNION ALL SELECT 'locked', metric, value FROM cells WHERE locked),
totals AS (SELECT 'all' AS scope, count(*) AS total FROM a UNION ALL SELECT 'locked', count(*) FROM a WHERE locked)
SELECT scope, metric, value, count(*) AS count, round(count(*) * 100.0 / any_value(total)::DOUBLE, 6) AS percent FROM scoped JOIN totals USING (scope) GROUP BY 1, 2, 3
"""


def _funnel() -> str:
    order = [r for r, _ in cleaning.REASONS]
    gone = lambda many: " OR ".join(f"list_contains(rs, '{r}')" for r in order[:many]) or "false"
    return _assessed() + " UNION ALL ".join(
        f"SELECT {i} AS step, '{name}' AS stage, count(*) FILTER (WHERE NOT ({gone(many)})) AS eligible_rows, count(*) FILTER (WHERE {gone(many)}) AS excluded_rows FROM a"
        for i, (name, many) in enumerate(profile.FUNNEL)
    )


def _copies() -> str:
    names = "date_of_sale_dd_mm_yyyy address county eircode price not_full_market_price vat_exclusive description_of_property property_size_description".split()
    return f"SELECT {', '.join(f'c{i} AS source_raw__{n}' for i, n in enumerate(names, 1))} FROM ({plain(REGISTER)}) AS r"


def statements(supports: tuple[int, ...], holdout: int) -> dict[str, str]:
    model = _model(supports, holdout)
    lit = lambda names: values([(n,) for n in names], "l(x)")
    reasons = [r for r, _ in cleaning.REASONS]
    training = f"""SELECT o_orderkey, kind AS property_type, p AS price{{log}} FROM (
      SELECT *, CASE WHEN trim(property_type) = '' THEN 'unknown' ELSE trim(property_type) END AS kind, TRY_CAST(replace(trim(sale_price_eur), ',', '') AS DOUBLE) AS p FROM ({plain(TRAINING)}) AS t) AS c
      WHERE p > 0 AND isfinite(p) AND kind IN ({KINDS}{{more}}) AND coalesce(lower(trim(exclude_from_training)), '') NOT IN ('1', 'true', 'yes', 'y')"""
    return {
        "baseline_metrics": model + "SELECT s AS min_group_support, count(*) AS rows, round(avg(abs(price - exp(m))), 2) AS mae, round(median(abs(price - exp(m)) / price), 6) AS mdape, round(avg(abs(ln(price) - m)), 6) AS log_mae FROM predicted GROUP BY s",
        "baseline_backoff_counts": model + "SELECT s AS min_group_support, backoff_level, count(*) AS rows FROM predicted GROUP BY ALL",
        "baseline_predictions": model + "SELECT o_orderkey, round(exp(m), 2) AS predicted_price, n AS support_count, backoff_level FROM predicted WHERE s = 100",
        "grouped_medians": f"""WITH s AS (SELECT canonical_area AS area, property_type AS kind, ln(price) AS lp FROM ({plain(SALES)}) AS x)
            SELECT CASE grouping(area, kind) WHEN 0 THEN 'area_property_type' WHEN 1 THEN 'area' WHEN 2 THEN 'property_type' ELSE 'global' END AS level, area, kind, round(median(lp), 9) AS median, count(*) AS support
            FROM s GROUP BY GROUPING SETS ((area, kind), (area), (kind), ())""",
        "report_payload": _model((450,), holdout) + f"""SELECT o_orderkey, round(price * 1.1::DOUBLE - exp(m), 4) AS gap, round((price * 1.1::DOUBLE - exp(m)) / exp(m), 6) AS gap_share, {CONFIDENCE.format(level="backoff_level", n="n")} AS confidence_state,
            round(exp(m - 0.25), 2) AS lower, round(exp(m + 0.25), 2) AS upper FROM predicted""",
        "single_prediction": model + f"""SELECT l AS backoff_level, n AS support_count, {CONFIDENCE.format(level="l", n="n")} AS confidence_state, round(exp(m), 2) AS predicted_price,
            round(150000 - exp(m), 2) AS asking_minus_predicted, round((150000 - exp(m)) / exp(m), 6) AS asking_minus_predicted_pct
            FROM (SELECT 1 AS o, 'area_property_type' AS l, m, n FROM pair WHERE a = 'FRANCE' AND k = 'BUILDING' UNION ALL SELECT 2, 'area', m, n FROM area WHERE a = 'FRANCE'
                  UNION ALL SELECT 3, 'property_type', m, n FROM kind WHERE k = 'BUILDING' UNION ALL SELECT 4, 'global', m, n FROM everything) AS g
            WHERE n >= 3 OR o = 4 ORDER BY o LIMIT 1""",
        "confidence_states": _model((1,), holdout) + f"SELECT {CONFIDENCE.format(level='backoff_level', n='n % 20')} AS confidence_state, count(*) AS rows FROM predicted GROUP BY 1",
        "segment_metrics": _model((100,), holdout) + "SELECT canonical_area, property_type, count(*) AS rows, round(avg(abs(price - exp(m))), 3) AS mae, round(median(abs(price - exp(m)) / price), 6) AS mdape FROM predicted GROUP BY 1, 2",
        "calibrated_interval": _model((100,), holdout) + """, q AS (SELECT quantile_cont(ln(price) - m, 0.1) AS low, quantile_cont(ln(price) - m, 0.9) AS high FROM predicted)
            SELECT count(*) AS rows, round(avg((price BETWEEN exp(m + low) AND exp(m + high))::INT), 3) AS coverage, round(median(exp(m + high) - exp(m + low)), 1) AS median_width, any_value(round(low, 6)) AS low, any_value(round(high, 6)) AS high FROM predicted, q""",
        "rolling_windows": " UNION ALL ".join(
            f"SELECT {y} AS years, count(*) AS rows, round(avg(abs(price - exp(m))), 2) AS mae, round(median(abs(price - exp(m)) / price), 6) AS mdape, round(avg(abs(ln(price) - m)), 6) AS log_mae FROM ({_model((3,), holdout, y)} SELECT * FROM predicted) AS p{y}" for y in (3, 5, 10)
        ),
        "training_filter": training.format(log=", round(ln(p), 9) AS log_price", more=", 'unknown'"),
        "training_filter_known_types": training.format(log="", more=""),
        "feature_snapshot": """SELECT p_partkey, p_brand AS canonical_area, p_type AS property_type, p_brand || '|' || p_type AS group_key,
            CASE WHEN p_size % 7 = 0 THEN 'unknown' WHEN p_size * 5 < 90 THEN 'small' WHEN p_size * 5 < 140 THEN 'medium' WHEN p_size * 5 < 200 THEN 'large' ELSE 'very_large' END AS size_band FROM part""",
        "date_parse_status": DATE_SQL,
        "any_format_date": f"SELECT o_orderkey, coalesce(try_strptime(trim(date_text), '%Y-%m-%d'), try_strptime(trim(date_text), '%d/%m/%Y'))::DATE AS day FROM ({plain(DATES)}) AS t",
        "price_parse_vat": PRICE_SQL,
        "flag_maps": FLAG_SQL,
        "description_map": DESCRIPTION_SQL,
        "standardised_register": _register(),
        "raw_copies": _copies(),
        "register_csv": _copies(),
        "row_numbers": "SELECT 1::BIGINT AS least, count(*) AS most, count(*) AS numbers FROM orders",
        "normalise_text": f"WITH places AS ({plain(PLACES)}) SELECT p_partkey, {_tidy()} AS tidy, strip_accents({_tidy()}) AS folded FROM places",
        "address_fields": f"WITH {ADDRESS_CTE} SELECT p_partkey, {', '.join(geography.ADDRESS_FIELDS)} FROM addressed",
        "area_match": _areas() + "SELECT * FROM mapped",
        "area_coverage": _coverage(),
        "numbered_rows": "SELECT o_orderkey, row_number() OVER () AS source_row_number FROM orders",
        "composed_text": f"SELECT n_nationkey, nfc_normalize(raw) AS composed FROM ({plain(MARKED_TEXTS)}) AS m",
        "component_match": f"WITH {ADDRESS_CTE} SELECT p_partkey FROM addressed WHERE len(list_filter(string_split(address_match_text, ','), lambda p: trim(p) = 'RANELAGH')) > 0",
        "geography_extracts": _areas() + """, s AS (SELECT p_partkey, p_partkey::VARCHAR AS record_id, geography_match_status, geo_scope FROM mapped)
            SELECT 'unmatched' AS audit, record_id, geography_match_status FROM s WHERE geography_match_status IN ('unmatched', 'invalid_address')
            UNION ALL SELECT 'ambiguous', record_id, geography_match_status FROM s WHERE geography_match_status = 'ambiguous'
            UNION ALL SELECT * FROM (SELECT 'out_of_scope', record_id, geography_match_status FROM s WHERE geo_scope = 'out_of_scope' ORDER BY p_partkey LIMIT 500) AS o""",
        "address_statuses": f"""WITH {ADDRESS_CTE}
            SELECT 'status' AS kind, address_normalization_status AS value, count(*) AS count FROM addressed GROUP BY ALL
            UNION ALL SELECT 'flag', f, count(*) FROM (SELECT unnest(CASE WHEN address_quality_flags = '' THEN ['no_flags'] ELSE string_split(address_quality_flags, '|') END) AS f FROM addressed) AS u GROUP BY ALL""",
        "manual_override": _areas() + """SELECT p_partkey, CASE WHEN hand THEN 'Ranelagh' ELSE canonical_area END AS canonical_area, CASE WHEN hand THEN 'inference' ELSE geo_scope END AS geo_scope,
            CASE WHEN hand THEN 'manual_override' ELSE geography_match_status END AS geography_match_status, CASE WHEN hand THEN 'manual_override' ELSE matched_aliases END AS matched_aliases
            FROM (SELECT *, p_partkey IN (8, 17, 40, 99) AS hand FROM mapped) AS m""",
        "alias_summary": _areas() + "SELECT canonical_area, geography_match_alias, geography_match_method, geography_match_priority, geo_scope, count(*) AS count FROM mapped WHERE geography_match_status = 'matched' GROUP BY ALL",
        "multi_property_rules": _rules(),
        "property_scope": SCOPE_SQL,
        "literal_contains": f"SELECT p_partkey FROM ({plain(PLACES)}) AS p WHERE lower(raw_address) LIKE '%block%' OR lower(raw_address) LIKE '%ranelagh%'",
        "content_hashes": HASH_SQL,
        "duplicate_tiers": _DUPLICATES + "SELECT * FROM d",
        "duplicate_summary": _DUPLICATES + "SELECT duplicate_status, duplicate_action, count(*) AS rows, count(DISTINCT duplicate_group_id) AS groups FROM d GROUP BY 1, 2",
        "duplicate_metrics": f"SELECT count(*) AS duplicate_groups, coalesce(sum(n), 0)::BIGINT AS rows_in_groups, coalesce(sum(n - 1), 0)::BIGINT AS rows_beyond_first FROM (SELECT count(*) AS n FROM ({plain(RECORDS)}) AS r GROUP BY raw_record_fingerprint HAVING count(*) > 1) AS g",
        "repeated_keys": "SELECT count(*) - count(DISTINCT l_orderkey) AS repeated FROM lineitem",
        "exclusion_reasons": _assessed() + "SELECT o_orderkey, exclude_from_training, exclusion_reason, exclusion_reasons, exclusion_rule_ids, cleaning_assessment_status FROM a",
        "quality_flags": _assessed() + "SELECT o_orderkey, quality_flags FROM a",
        "value_counts": _assessed() + "SELECT coalesce(exclusion_reason, '<null>') AS value, count(*) AS count FROM a GROUP BY 1",
        "value_counts_top": "SELECT o_custkey::VARCHAR AS value, count(*) AS count FROM orders GROUP BY 1 ORDER BY 2 DESC, 1 LIMIT 25",
        "token_counts": _assessed() + "SELECT token, count(*) AS count FROM (SELECT unnest(CASE WHEN address_quality_flags = '' THEN ['no_flags'] ELSE string_split(address_quality_flags, '|') END) AS token FROM a) AS t GROUP BY 1",
        "rows_of_a_reason": _assessed() + "SELECT o_orderkey FROM a WHERE list_contains(rs, 'invalid_date')",
        "value_counts_by_value": f"SELECT duplicate_status AS value, count(*) AS count FROM ({plain(EVIDENCE)}) AS e GROUP BY 1 ORDER BY 1",
        "first_rows": f"SELECT record_id, source_row_number FROM ({plain(RECORDS)}) AS r ORDER BY source_row_number LIMIT 20",
        "samples_by_reason": _assessed() + "SELECT exclusion_reason, record_id, raw_address FROM (SELECT *, row_number() OVER (PARTITION BY exclusion_reason ORDER BY record_id, raw_address) AS nth FROM a WHERE record_id IS NOT NULL AND exclusion_reason IS NOT NULL) AS s WHERE nth <= 3",
        "reason_summary": _assessed() + f"""SELECT x AS reason, count(*) FILTER (WHERE exclusion_reason = x) AS primary_rows, count(*) FILTER (WHERE list_contains(rs, x)) AS all_rows,
            count(*) FILTER (WHERE list_contains(rs, x) AND locked) AS locked_rows, count(*) FILTER (WHERE list_contains(rs, x) AND len(rs) > 1) AS overlap_rows FROM {lit(reasons)} CROSS JOIN a GROUP BY x""",
        "long_profile": _profile(),
        "stage_funnel": _funnel(),
        "reason_histogram": _assessed() + "SELECT reasons, count, round(count * 100.0 / (sum(count) OVER ())::DOUBLE, 6) AS percent FROM (SELECT len(rs)::INT AS reasons, count(*) AS count FROM a GROUP BY 1) AS h",
        "reason_combinations": _assessed() + "SELECT exclusion_reasons AS combination, count(*) AS count FROM a WHERE len(rs) > 1 GROUP BY 1 ORDER BY 2 DESC, 1 LIMIT 20",
        "rule_evidence": _assessed() + f"SELECT x AS rule_id, count(*) FILTER (WHERE list_contains(string_split(exclusion_rule_ids, '|'), x)) AS total_rows, count(*) FILTER (WHERE locked AND list_contains(string_split(exclusion_rule_ids, '|'), x)) AS locked_rows FROM {lit([r for _, r in cleaning.REASONS] + ['CLEAN999'])} CROSS JOIN a GROUP BY x",
        "aligned_counts": _assessed() + "SELECT duplicate_action AS value, count(*) AS all_rows, count(*) FILTER (WHERE locked) AS locked_rows FROM a GROUP BY 1",
        "null_profile": f"WITH e AS ({plain(EVIDENCE)}) " + " UNION ALL ".join(f"SELECT '{c}' AS column, count(*) FILTER (WHERE {c} IS NULL) AS nulls FROM e" for c in ("record_id", "transaction_date", "is_full_market_price", "geo_scope", "geography_quality_flags")),
        "scalar_counts": f"""SELECT count(*) FILTER (WHERE geography_match_status = 'matched') AS matched, count(*) FILTER (WHERE price_parse_status <> 'parsed') AS not_parsed,
            count(*) FILTER (WHERE geo_scope IN ('inference', 'unknown')) AS in_set, count(*) FILTER (WHERE is_full_market_price) AS is_true,
            count(*) FILTER (WHERE full_market_price_mapping_status IS DISTINCT FROM 'mapped_full_market') AS not_in_set FROM ({plain(EVIDENCE)}) AS e""",
        "stable_sample": "SELECT c_custkey, c_name, c_mktsegment FROM customer ORDER BY c_mktsegment NULLS LAST, c_custkey LIMIT 40",
        "costliest": f"SELECT record_id, sale_price_eur_adjusted FROM ({plain(EVIDENCE)}) AS e ORDER BY sale_price_eur_adjusted DESC NULLS LAST, record_id NULLS LAST LIMIT 30",
        "ordered_union": f"""WITH e AS (SELECT * FROM ({plain(EVIDENCE)}) AS x WHERE record_id IS NOT NULL)
            SELECT record_id, duplicate_status FROM e WHERE duplicate_action = 'review_only'
            UNION ALL SELECT * FROM (SELECT record_id, duplicate_status FROM e WHERE duplicate_status = 'same_day_distinct_transaction' ORDER BY record_id LIMIT 20) AS s""",
        "included_and_excluded": _assessed() + "SELECT o_orderkey, CASE WHEN exclude_from_training THEN 'excluded' ELSE 'included' END AS side FROM a",
    }

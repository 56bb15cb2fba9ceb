"""The queries of this subpackage and, where SQL can express them, their DuckDB statements."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import collision_ann, feistel, html_main, language_id, lm_score, mixing, quality_gbt, simhash, templates, url_rules
from .runtime import crc32_mod, table, written

#: The rules of op2, as (action, host and path).
URL_RULES = (("allow", "org/"), ("block", "example.org/es/"), ("block", "example.org/en/1"), ("allow", "com/fr/"), ("block", "com/de/"))


def op1_template_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return templates.contaminated(docs, table(spark, sf_dir, "benchmark")).drop("text_hash")


def op2_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    rules = [url_rules.UrlRule.parse(*r) for r in URL_RULES]
    return url_rules.judge_urls(table(spark, sf_dir, "pages").select("page_id", "url"), rules).select("page_id", "host", "path", "rule", "verdict")


OP2_SQL = r"""
WITH parts AS (
  SELECT page_id,
         translate(regexp_extract(coalesce(url, ''), '^.*?://([^/?#]*)', 1, 's'), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
         regexp_extract(coalesce(url, ''), '^.*?://[^/?#]*([^?#]*)', 1, 's') AS path
  FROM pages),
rules(action, rhost, rpath) AS (
  VALUES ('allow', 'org', '/'), ('block', 'example.org', '/es/'), ('block', 'example.org', '/en/1'), ('allow', 'com', '/fr/'), ('block', 'com', '/de/')),
judged AS (
  SELECT page_id, host, path,
         (SELECT max({'size': length(rhost || rpath), 'host_size': length(rhost), 'block': (action = 'block')::INT, 'rule': rhost || rpath, 'action': action})
          FROM rules WHERE (host = rhost OR ends_with(host, '.' || rhost)) AND starts_with(path, rpath)) AS best
  FROM parts)
SELECT page_id, host, path, best.rule AS rule, coalesce(best.action, 'allow') AS verdict FROM judged
"""


def op3_feistel_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select(
        "doc_id",
        (F.coalesce(F.octet_length("text"), F.lit(0)) + 16).cast("long").alias("size"),
        F.crc32(F.coalesce(F.col("text"), F.lit("")).cast("binary")).alias("text_crc32"),
        F.xxhash64("text", "lang", "source", "n_chars").alias("content"),
    )
    sharded = feistel.shard_rows(docs, 40, ["doc_id", "content"])
    return sharded.select("doc_id", "size", "text_crc32", F.lit("rows").alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard"))


def op4_simhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = simhash.near_duplicates(table(spark, sf_dir, "documents").select("doc_id", "text"))
    return found.select("doc_id", F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"), "component_id")


def op5_ppm_lm_score(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lm_score.score(table(spark, sf_dir, "documents").select("doc_id", "text"), crc32_mod("doc_id", 7) != 2)


def op6_collision_ann(spark: SparkSession, sf_dir: str) -> DataFrame:
    return collision_ann.nearest(table(spark, sf_dir, "embeddings"), F.pmod(F.col("vec_id"), F.lit(100)) == 0)


def op7_quality_gbt(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    forest = quality_gbt.fit(docs, table(spark, sf_dir, "labels"), crc32_mod("doc_id", 5) != 0, "quality")
    judged = quality_gbt.judge(docs.withColumn("held_out", crc32_mod("doc_id", 5) == 0), forest)
    return judged.select("doc_id", "held_out", "score", (F.col("score") >= 0.3).cast("int").alias("predicted"))


def op8_html_main_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return html_main.extract_main(table(spark, sf_dir, "pages").select("page_id", "url", "html"))


def op9_source_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    words = mixing.word_count(F.col("text"))
    docs = table(spark, sf_dir, "documents").select("doc_id", "source", words.alias("words"), mixing.clean_weight(F.col("text"), words).alias("weight"), F.xxhash64("text").alias("content"))
    # the texts are read for the narrow rows once
    mixed = mixing.mix_sources(written(docs), size=F.col("words"), weight=F.col("weight"), content=F.col("content"))
    return mixed.select("doc_id", "size", "source_size", "target", "taken")


def op10_ppm_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "lang")
    names, model = language_id.learn(docs, crc32_mod("doc_id", 4) != 2)
    held = docs.select("doc_id", "text", (crc32_mod("doc_id", 4) == 2).alias("held_out"))
    return language_id.judge(held, names, model, keep=["doc_id", "held_out"])


OP9_SQL = r"""
WITH counted AS (
  SELECT doc_id, source, len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')) AS size,
         len(regexp_extract_all(coalesce(text, ''), '[#$%&*|!<>{}0-9]')) AS junk, coalesce(doc_id::VARCHAR, '') AS name
  FROM documents),
keyed AS (
  SELECT doc_id, source, size, md5(name) AS tie,
         -ln((('0x' || substr(md5('11:' || name), 1, 13))::BIGINT::DOUBLE + 0.5) / 4503599627370496.0)
           / (0.25 + 0.75 / (1.0 + junk::DOUBLE / greatest(size, 1)::DOUBLE)) AS key
  FROM counted),
sizes AS (SELECT source, sum(size)::BIGINT AS source_size FROM keyed GROUP BY source),
weighed AS (
  SELECT source, source_size, 3.0::DOUBLE * source_size AS most,
         ([5, 2, 1])[1 + ((row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3)::INT]::DOUBLE AS w
  FROM sizes),
levelled AS (
  SELECT *, (sum(source_size) OVER ()::DOUBLE
             - coalesce(sum(most) OVER (ORDER BY most / w, source NULLS LAST ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0.0))
            / sum(w) OVER (ORDER BY most / w, source NULLS LAST ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS level
  FROM weighed),
final AS (SELECT min_by(level, most / w) AS level FROM levelled WHERE level * w <= most),
plan AS (
  SELECT source, source_size, least(most, coalesce(final.level * w, most)) AS target FROM levelled LEFT JOIN final ON true),
epochs AS (
  SELECT *, CASE WHEN source_size > 0 THEN floor(target / source_size)::BIGINT ELSE 0 END AS epochs FROM plan),
ranked AS (
  SELECT k.doc_id, k.size, e.source_size, e.target, e.epochs, e.target - e.epochs * e.source_size AS rest,
         coalesce(sum(k.size) OVER (PARTITION BY k.source ORDER BY k.key, k.tie ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS prior
  FROM keyed k JOIN epochs e ON k.source IS NOT DISTINCT FROM e.source)
SELECT doc_id, size::BIGINT AS size, source_size, target,
       ((epochs + CASE WHEN prior + size / 2.0 <= rest THEN 1 ELSE 0 END) * size)::BIGINT AS taken
FROM ranked
"""


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_template_decontamination": op1_template_decontamination,
    "op2_url_filter": op2_url_filter,
    "op3_feistel_sharding": op3_feistel_sharding,
    "op4_simhash_near_dedup": op4_simhash_near_dedup,
    "op5_ppm_lm_score": op5_ppm_lm_score,
    "op6_collision_ann": op6_collision_ann,
    "op7_quality_gbt": op7_quality_gbt,
    "op8_html_main_text": op8_html_main_text,
    "op9_source_mixing": op9_source_mixing,
    "op10_ppm_language_id": op10_ppm_language_id,
}

SQL = {"op2_url_filter": OP2_SQL, "op9_source_mixing": OP9_SQL}

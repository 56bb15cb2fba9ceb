"""URL filtering by pattern rules that are indexed by their rarest literal token.

A rule names a host and a path prefix and fits the host, all its subdomains and every path that starts
with the prefix; ``*`` in the prefix stands for any characters.  Every rule is filed under one literal
token that any URL it fits must contain: the token shared with the fewest other rules.  A URL's own
tokens fetch its candidate rules and only those run their regular expression.  The longest fitting rule
decides, then the longer host, then ``block`` before ``allow``.

Two plans give the same verdicts.  Up to ``INLINE_RULES`` rules the index is one constant inside the
projection, so nothing is shuffled.  Larger rule sets are a table keyed by token that is joined with the
tokens of the distinct URLs; Spark picks the join by size and splits hot tokens.

Defined results: a null URL or one without ``://`` has empty host and path and gets the default verdict;
very long URLs are judged whole; rules that tie in path and host go by verdict; repeated rows are judged alike; no rules at all leave every URL to the default; an empty table stays
empty; other columns are kept, and a column that has the name of a result column is replaced.
"""

from __future__ import annotations

import json
import re
from collections import Counter
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .runtime import fresh

INLINE_RULES = 512
TOKEN = re.compile(r"[A-Za-z0-9]+")
ENTRY = "struct<rule:string,host:string,action:string,pattern:string,size:int,host_size:int>"


@dataclass(frozen=True)
class UrlRule:
    action: str
    host: str
    path: str = "/"

    @classmethod
    def parse(cls, action: str, text: str) -> UrlRule:
        """``text`` is a host, then the path prefix from its first ``/`` on."""
        host, slash, rest = text.partition("/")
        if action not in ("allow", "block") or not host:
            raise ValueError(f"not a rule: {action} {text}")
        return cls(action, host.translate(LOWER), slash + rest)

    @property
    def text(self) -> str:
        return self.host + self.path

    @property
    def pattern(self) -> str:
        """Java regular expression over host and path put together."""
        literal = r"\Q{}\E".format
        path = ".*".join(literal(part) if part else "" for part in self.path.split("*"))
        return rf"(?s)^(?:[^/?#]*\.)?{literal(self.host)}(?=[/]|$){path}"

    def tokens(self) -> set[str]:
        """Tokens that a fitting URL contains whole: none that touches a wildcard or ends the prefix."""
        found = set()
        text = self.text
        for m in TOKEN.finditer(text):
            whole_end = m.end() <= len(self.host) or (m.end() < len(text) and text[m.end()] != "*")
            whole_start = m.start() == 0 or text[m.start() - 1] != "*"
            if whole_end and whole_start:
                found.add(m[0])
        return found


LOWER = str.maketrans({chr(c): chr(c + 32) for c in range(65, 91)})


def index_rules(rules: list[UrlRule], frequencies: dict[str, int] | None = None) -> dict[str, list[UrlRule]]:
    """The rules by the rarest token of each; ``""`` holds rules that have no whole token.

    ``frequencies`` (token: number of URLs) comes first when given, then the number of rules.
    """
    shared = Counter(t for r in rules for t in r.tokens())
    seen = frequencies or {}
    index: dict[str, list[UrlRule]] = {}
    for rule in dict.fromkeys(rules):
        rarest = min(rule.tokens(), key=lambda t: (seen.get(t, 0), shared[t], -len(t), t), default="")
        index.setdefault(rarest, []).append(rule)
    return index


def host_of(url: Column) -> Column:
    host = F.regexp_extract(F.coalesce(url, F.lit("")), r"(?s)^.*?://([^/?#]*)", 1)
    return F.translate(host, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def path_of(url: Column) -> Column:
    return F.regexp_extract(F.coalesce(url, F.lit("")), r"(?s)^.*?://[^/?#]*([^?#]*)", 1)


def _entries(index: dict[str, list[UrlRule]]) -> dict[str, list[dict]]:
    return {
        token: [
            {"rule": r.text, "host": r.host, "action": r.action, "pattern": r.pattern, "size": len(r.text), "host_size": len(r.host)}
            for r in rules
        ]
        for token, rules in index.items()
    }


def _rank(entry: Column) -> Column:
    """Orders fitting rules: the greatest decides."""
    return F.struct(
        entry["size"].alias("size"),
        entry["host_size"].alias("host_size"),
        (entry["action"] == "block").cast("int").alias("block"),
        entry["rule"].alias("rule"),
        entry["action"].alias("action"),
    )


def judge_urls(
    df: DataFrame,
    rules: list[UrlRule],
    url: str = "url",
    default: str = "allow",
    frequencies: dict[str, int] | None = None,
    inline_rules: int = INLINE_RULES,
) -> DataFrame:
    """``df`` with ``host``, ``path``, ``rule`` (null: none fits) and ``verdict``."""
    entries = _entries(index_rules(rules, frequencies))
    at, tokens, best = fresh(df, "url_target", "url_tokens", "url_best")
    parts = df.withColumns({"host": host_of(F.col(url)), "path": path_of(F.col(url))})
    parts = parts.withColumn(at, F.concat("host", "path"))
    if len(rules) <= inline_rules:
        judged = _inline(parts, entries, at, tokens, best)
    else:
        judged = _joined(parts, entries, at, best)
    return judged.withColumns({"rule": F.col(best)["rule"], "verdict": F.coalesce(F.col(best)["action"], F.lit(default))}).drop(at, tokens, best)


def _inline(parts: DataFrame, entries: dict, at: str, tokens: str, best: str) -> DataFrame:
    index = F.from_json(F.lit(json.dumps(entries)), f"map<string,array<{ENTRY}>>")
    found = F.array_distinct(F.concat(F.regexp_extract_all(F.col(at), F.lit("([A-Za-z0-9]+)"), 1), F.array(F.lit(""))))
    known = F.array_intersect(found, F.array(*map(F.lit, entries)).cast("array<string>"))
    candidates = F.flatten(F.transform(known, lambda t: F.try_element_at(index, t)))
    fitting = F.filter(candidates, lambda e: F.rlike(F.col(at), e["pattern"]))
    return parts.withColumn(tokens, F.transform(fitting, _rank)).withColumn(best, F.array_max(tokens))


def _joined(parts: DataFrame, entries: dict, at: str, best: str) -> DataFrame:
    spark = parts.sparkSession
    rows = [(token, *e.values()) for token, found in entries.items() for e in found]
    table = spark.createDataFrame(rows, "token string, rule string, host string, action string, pattern string, size int, host_size int")
    table = table.select("token", F.struct("rule", "host", "action", "pattern", "size", "host_size").alias("entry"))
    targets = parts.select(F.col(at).alias("target")).distinct()
    tokens = F.array_distinct(F.concat(F.regexp_extract_all("target", F.lit("([A-Za-z0-9]+)"), 1), F.array(F.lit(""))))
    hits = (
        targets.select("target", F.explode(tokens).alias("token"))
        .join(table, "token")
        .where("target rlike entry.pattern")
        .groupBy("target")
        .agg(F.max(_rank(F.col("entry"))).alias(best))
    )
    hits = hits.withColumnRenamed("target", f"{at}_key")
    return parts.join(hits, F.col(at) == F.col(f"{at}_key"), "left").drop(f"{at}_key")

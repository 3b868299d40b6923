"""URL filter: rules for hosts and paths, and a weighted vocabulary counted by an Aho-Corasick automaton.

A url whose host and path fit a rule takes the verdict of the longest fitting rule. All others are read once by the
automaton, which finds every term of the vocabulary. A find counts when no letter or digit touches it on either side.
One strict term blocks; soft terms block when ``SOFT_LIMIT`` different ones are found. The vocabulary is a parameter
and is sent to every task; its size doesn't depend on the input.

Null urls and urls without ``://`` have an empty host and an empty path; no rule fits them, and null urls are allowed.
"""

from __future__ import annotations

import ahocorasick
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import IntegerType, StructField, StructType

from weftline.llm.registry import query, table
from weftline.llm.words import add_columns

# The rules of the query as (verdict, host, path).
RULES = [("allow", "org", "/"), ("block", "example.org", "/es/"), ("block", "example.org", "/en/1"), ("allow", "com", "/fr/"), ("block", "com", "/de/")]

STRICT = ["casino", "escort", "hentai", "malware", "phishing", "porn", "porno", "viagra", "warez", "xxx"]
SOFT = ["adult", "bet", "bonus", "cam", "cheap", "crack", "dating", "download", "free", "keygen", "loan", "nude", "poker", "ref", "sex", "torrent", "track", "win"]
SOFT_LIMIT = 2

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def split_url(url: Column) -> tuple[Column, Column]:
    """Host after the first ``://`` in lower case, and path."""
    rest = F.when(F.instr(url, "://") > 0, F.substring(url, F.instr(url, "://") + 3, F.length(url))).otherwise("")
    rest = F.coalesce(rest, F.lit(""))
    return F.translate(F.regexp_extract(rest, r"^([^/?#]*)", 1), UPPER, LOWER), F.regexp_extract(rest, r"^[^/?#]*([^?#]*)", 1)


def fits(host: Column, path: Column, rule_host: str, rule_path: str) -> Column:
    return ((host == rule_host) | host.endswith("." + rule_host)) & path.startswith(rule_path)


def matching_rule(host: Column, path: Column, rules: list[tuple[str, str, str]]) -> tuple[Column, Column]:
    """(rule, verdict) of the longest rule that fits, or nulls."""
    ordered = sorted(rules, key=lambda r: (-len(r[1] + r[2]), r[1] + r[2]))
    rule, verdict = F.lit(None).cast("string"), F.lit(None).cast("string")
    for decision, rule_host, rule_path in reversed(ordered):
        here = fits(host, path, rule_host, rule_path)
        rule = F.when(here, rule_host + rule_path).otherwise(rule)
        verdict = F.when(here, decision).otherwise(verdict)
    return rule, verdict


def automaton(strict: list[str], soft: list[str]) -> ahocorasick.Automaton:
    found = ahocorasick.Automaton()
    for term in {*strict, *soft}:
        found.add_word(term, (term, term in strict))
    found.make_automaton()
    return found


def term_hits(url: str, machine: ahocorasick.Automaton) -> tuple[int, int]:
    """How many different strict and soft terms stand in ``url`` between boundaries."""
    text = url.translate(str.maketrans(UPPER, LOWER))
    strict, soft = set(), set()
    for end, (term, hard) in machine.iter(text):
        before, after = end - len(term), end + 1
        if (before < 0 or not _touches(text[before])) and (after == len(text) or not _touches(text[after])):
            (strict if hard else soft).add(term)
    return len(strict), len(soft)


def _touches(character: str) -> bool:
    return "a" <= character <= "z" or "0" <= character <= "9"


def count_terms(df: DataFrame, url: str, strict: list[str] = STRICT, soft: list[str] = SOFT) -> DataFrame:
    """``df`` with ``strict_hits`` and ``soft_hits``: different terms found in ``url`` (null: none)."""
    added = StructType([StructField("strict_hits", IntegerType()), StructField("soft_hits", IntegerType())])
    held: list[ahocorasick.Automaton] = []

    def compute(urls: pa.Array, _: pa.RecordBatch) -> dict[str, object]:
        if not held:
            held.append(automaton(strict, soft))
        hits = [term_hits(u, held[0]) if u else (0, 0) for u in urls.to_pylist()]
        return {"strict_hits": pa.array([a for a, _ in hits], pa.int32()), "soft_hits": pa.array([b for _, b in hits], pa.int32())}

    return add_columns(df, url, added, compute)


def judge(df: DataFrame, url: str = "url", rules: list[tuple[str, str, str]] = RULES, strict: list[str] = STRICT, soft: list[str] = SOFT, soft_limit: int = SOFT_LIMIT) -> DataFrame:
    """``df`` with host, path, rule, strict_hits, soft_hits and verdict; columns of these names are replaced."""
    counted = count_terms(df, url, strict, soft)
    host, path = split_url(F.col(url))
    rule, verdict = matching_rule(F.col("host"), F.col("path"), rules)
    vocabulary = F.when((F.col("strict_hits") > 0) | (F.col("soft_hits") >= soft_limit), "block").otherwise("allow")
    return counted.withColumns({"host": host, "path": path}).withColumns({"rule": rule, "verdict": F.coalesce(verdict, vocabulary)})


def _sql() -> str:
    """The same judgement in SQL: one pattern per term instead of the automaton."""
    def fit(host: str, path: str) -> str:
        return f"(host = '{host}' OR ends_with(host, '.{host}')) AND starts_with(path, '{path}')"

    ordered = sorted(RULES, key=lambda r: (-len(r[1] + r[2]), r[1] + r[2]))
    rule = " ".join(f"WHEN {fit(h, p)} THEN '{h}{p}'" for _, h, p in ordered)
    verdict = " ".join(f"WHEN {fit(h, p)} THEN '{v}'" for v, h, p in ordered)
    def hits(terms: list[str]) -> str:
        return " + ".join(f"regexp_matches(low, '(^|[^a-z0-9]){t}([^a-z0-9]|$)')::INT" for t in terms)

    return f"""
WITH cut AS (
  SELECT page_id, translate(coalesce(url, ''), '{UPPER}', '{LOWER}') AS low,
         CASE WHEN strpos(url, '://') > 0 THEN substr(url, strpos(url, '://') + 3) ELSE '' END AS rest
  FROM pages),
parts AS (
  SELECT page_id, low, translate(regexp_extract(rest, '^([^/?#]*)', 1), '{UPPER}', '{LOWER}') AS host,
         regexp_extract(rest, '^[^/?#]*([^?#]*)', 1) AS path
  FROM cut),
found AS (SELECT *, ({hits(STRICT)}) AS strict_hits, ({hits(SOFT)}) AS soft_hits FROM parts)
SELECT page_id, host, path, CASE {rule} END AS rule, strict_hits, soft_hits,
       CASE {verdict} WHEN strict_hits > 0 OR soft_hits >= {SOFT_LIMIT} THEN 'block' ELSE 'allow' END AS verdict
FROM found"""


@query("op8_url_filter", _sql())
def op8_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = table(spark, sf_dir, "pages").select("page_id", "url")
    return judge(pages).select("page_id", "host", "path", "rule", "strict_hits", "soft_hits", "verdict")

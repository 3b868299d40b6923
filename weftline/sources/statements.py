"""Lineage from logged statement and plan texts with column expressions."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def top_statements(log: DataFrame, n: int = 10) -> DataFrame:
    """Slowest logged inserts."""
    return log.filter(F.upper("statement").contains("INSERT INTO")).orderBy(F.desc("total_exec_time"), "job_name", "out_a").limit(n)


def recent_statements(log: DataFrame, since, kind: str) -> DataFrame:
    return log.filter((F.col("start_time") > since) & F.lower("statement").startswith(kind))


def statement_tables(log: DataFrame) -> DataFrame:
    """(key columns, role, table_name) of every statement, names in upper case.

    One target, the first name after INSERT INTO or CREATE TABLE; every name after FROM or
    JOIN is a source, repeats and names of common table expressions included.
    """
    text = log.withColumn("sql_text", F.upper("statement"))
    named = text.selectExpr(
        "*", r"ltrim('(', rtrim('(', regexp_extract(sql_text, '(?:INSERT\\s+INTO|CREATE\\s+TABLE)\\s+(\\S+)', 1))) AS target",
        r"filter(transform(regexp_extract_all(sql_text, '(?:FROM|JOIN)\\s+(\\S+)', 1), t -> trim('()', t)), t -> t NOT IN ('SELECT', 'WHERE', '')) AS sources")
    rows = "concat(if(target = '', array(), array(named_struct('role', 'target', 'table_name', target))), transform(sources, s -> named_struct('role', 'source', 'table_name', s)))"
    return named.selectExpr(*log.columns, f"inline({rows})")


# Patterns over one statement in lower case, without comments, literals and identifier quotes.
_NOISE = r"'(?:[^']|'')*'|--[^\n]*|/\*[\s\S]*?\*/"
_NAME = r"([\w.]++)"
_TARGETS = [
    rf"insert\s+(?:into|overwrite)\s+(?:table\s+)?{_NAME}",
    rf"create\s+(?:or\s+replace\s+)?(?:(?:global|local|temp|temporary|external|transient|materialized)\s+)*(?:table|view)\s+(?:if\s+not\s+exists\s+)?{_NAME}",
    rf"merge\s+into\s+{_NAME}", rf"delete\s+from\s+{_NAME}", rf"update\s+{_NAME}\s+set\b"]
_LOCALS = rf"{_NAME}\s*(?:\([^()]*\))?\s+as\s+(?:not\s+)?(?:materialized\s+)?\("
# Words before "from" that isn't followed by a table.
_NOT_READS = r"\b(?:extract|trim|substring|overlay|position)\s*\([^()]*\)|\bis\s+(?:not\s+)?distinct\s+from\b|\bdelete\s+from\b"
_READS = r"\b(?:from|join|using)\s+((?:[\w.]+(?:\s+(?:as\s+)?\w+)?\s*,\s*)*[\w.]++)(?!\s*\()"
_NOT_TABLES = ["select", "lateral", "unnest", "values", "table", "only", "where"]


def script_tables(log: DataFrame) -> DataFrame:
    """Distinct (key columns, role, table_name), reading through common table expressions.

    Comments, quoted text and identifier quotes go first, then scripts are cut at semicolons. Tables and views that
    are created, replaced, inserted into, overwritten, merged into, updated or deleted from are targets; every other
    table after FROM, JOIN or USING, in comma lists too, that the statement doesn't define is a source.
    """
    bare = F.regexp_replace(F.regexp_replace(F.lower("statement"), _NOISE, " "), '["`]', "")
    piece = F.explode(F.split(bare, ";")).alias("piece")
    targets = F.flatten(F.array(*[F.regexp_extract_all("piece", F.lit(p), F.lit(1)) for p in _TARGETS]))
    lists = F.regexp_extract_all(F.regexp_replace("piece", _NOT_READS, " "), F.lit(_READS), F.lit(1))
    reads = F.flatten(F.transform(lists, lambda x: F.transform(F.split(x, r"\s*,\s*"), lambda y: F.regexp_extract(y, r"^([\w.]+)", 1))))
    known = F.array_union(F.regexp_extract_all("piece", F.lit(_LOCALS), F.lit(1)), F.array(*[F.lit(w) for w in _NOT_TABLES]))
    row = lambda role: lambda name: F.struct(F.lit(role).alias("role"), name.alias("table_name"))
    named = log.select("*", piece).select(*log.columns, F.inline(F.concat(
        F.transform(targets, row("target")), F.transform(F.array_except(reads, known), row("source")))))
    return named.distinct()


def plan_sources(plans: DataFrame, column: str = "plan_text") -> DataFrame:
    """(key columns, kind, source, columns) of every file scan and database relation in a plan text."""
    keys = [c for c in plans.columns if c != column]
    found = plans.selectExpr(
        *keys,
        rf"regexp_extract_all({column}, 'FileScan\\s+\\w+\\s+\\[(.*?)\\]\\s+.*?Location:\\s+(.*?),', 1) AS scanned",
        rf"regexp_extract_all({column}, 'FileScan\\s+\\w+\\s+\\[(.*?)\\]\\s+.*?Location:\\s+(.*?),', 2) AS places",
        rf"regexp_extract_all({column}, 'JDBCRelation\\((.*?)\\)', 1) AS relations")
    return found.selectExpr(
        *keys,
        "inline(concat(zip_with(scanned, places, (c, p) -> named_struct('kind', 'file', 'source', trim(p), 'columns', c)), "
        "transform(relations, r -> named_struct('kind', 'jdbc', 'source', r, 'columns', ''))))")

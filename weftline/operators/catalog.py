"""Catalog lookups, searches and name handling."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

QUALIFIED_NAME = r"^([^:]+)://([^.]+)\.([^/.]+)/(.+)$"


def page(nodes: DataFrame, namespace: str | None = None, limit: int = 20, offset: int = 0) -> DataFrame:
    """``limit`` rows in id order after the first ``offset``."""
    if limit < 1 or offset < 0:
        raise ValueError("limit must be positive and offset not negative")
    kept = nodes if namespace is None else nodes.filter(F.col("namespace") == namespace)
    return kept.orderBy("id").offset(offset).limit(limit)


def lookup(nodes: DataFrame, node_id: str | Column) -> DataFrame:
    return nodes.filter(F.col("id") == node_id)


def contains_text(columns: list[str], text: str) -> Column:
    hit = F.lit(False)
    for name in columns:
        hit = hit | F.coalesce(F.contains(F.lower(name), F.lit(text.lower())), F.lit(False))
    return hit


def search(nodes: DataFrame, text: str, columns: list[str]) -> DataFrame:
    """Case-insensitive substring of any of ``columns``."""
    return nodes.filter(contains_text(columns, text))


def search_page(nodes: DataFrame, text: str, columns: list[str], kind: str | None = None, limit: int = 10) -> DataFrame:
    """First ``limit`` matches, datasets before jobs, each with the number of all matches."""
    found = search(nodes, text, columns)
    if kind is not None:
        found = found.filter(F.col("type") == kind)
    total = found.agg(F.count("*"))
    return found.orderBy("type", "id").limit(limit).withColumn("total", total.scalar())


def search_with_tags(catalog: DataFrame, text: str) -> DataFrame:
    tagged = F.exists("tags", lambda tag: F.contains(F.lower(tag), F.lit(text.lower())))
    return catalog.filter(contains_text(["name", "description"], text) | tagged)


def qualify(org: Column, domain: Column, environment: Column, dataset: Column) -> Column:
    return F.format_string("%s://%s.%s/%s", org, domain, environment, dataset)


def parse_qualified(names: DataFrame, column: str) -> DataFrame:
    """Parts of well-formed qualified names; other names are dropped."""
    parts = [F.regexp_extract(column, QUALIFIED_NAME, i + 1).alias(part) for i, part in enumerate(("org", "domain", "environment", "dataset"))]
    return names.filter(F.col(column).rlike(QUALIFIED_NAME)).select("*", *parts)


def resolve_urns(refs: DataFrame, registry: DataFrame) -> DataFrame:
    """(urn, name): the registered name, else the urn itself."""
    return refs.join(registry.select("urn", F.col("name").alias("known")), "urn", "left").select("urn", F.coalesce("known", "urn").alias("name"))


def urns_of(registry: DataFrame, names: DataFrame) -> DataFrame:
    return registry.join(names, "name", "left_semi").select("name", "urn")


def base_name(column: str) -> Column:
    """Name without its reader suffix: ``orders@pandas`` and ``orders@spark`` are one dataset."""
    return F.split_part(F.col(column), F.lit("@"), F.lit(1))


def prefixed(column: str, namespace: Column, boundary: Column) -> Column:
    """Inner datasets of a reused pipeline get its namespace; declared inputs and outputs keep their name."""
    return F.when(boundary, F.col(column)).otherwise(F.concat(namespace, F.lit("."), F.col(column)))


def namespaces(nodes: DataFrame) -> DataFrame:
    return nodes.groupBy("namespace").agg(
        F.min("created_at").alias("created_at"), F.count_if(F.col("type") == "dataset").alias("datasets"), F.count_if(F.col("type") == "job").alias("jobs"))


def edge_usage(log: DataFrame) -> DataFrame:
    """Per edge: columns read, access pattern, rows and bytes.

    ``log`` has src, dst, columns (array), rows_read and bytes_read. The columns are
    reduced to distinct names before they are gathered, so the array is bounded by the width of the table.
    """
    totals = log.groupBy("src", "dst").agg(F.sum("rows_read").alias("rows_read"), F.sum("bytes_read").alias("bytes_read"), F.count("*").alias("reads"))
    names = log.select("src", "dst", F.explode("columns").alias("c")).distinct().groupBy("src", "dst").agg(F.array_join(F.sort_array(F.collect_set("c")), ",").alias("columns_used"))
    return totals.join(names, ["src", "dst"]).withColumn("access_pattern", F.when(F.col("reads") > 1, "repeated").otherwise("single"))


def hygiene(catalog: DataFrame, edges: DataFrame) -> DataFrame:
    """(issue, id): no owner, no edge, same name in another case, stale text, odd naming.

    ``catalog`` has id, name, owner, described_at and updated_at.
    """
    def issue(label: str, rows: DataFrame) -> DataFrame:
        return rows.select(F.lit(label).alias("issue"), "id")

    linked = edges.selectExpr("explode(array(src, dst)) AS id").distinct()
    repeated = catalog.groupBy(F.lower("name").alias("key")).agg(F.count("*").alias("n")).filter("n > 1")
    return (
        issue("missing_owner", catalog.filter("owner IS NULL OR owner = ''"))
        .unionByName(issue("orphaned", catalog.join(linked, "id", "left_anti")))
        .unionByName(issue("duplicate", catalog.withColumn("key", F.lower("name")).join(repeated, "key", "left_semi")))
        .unionByName(issue("stale_description", catalog.filter("described_at < updated_at")))
        .unionByName(issue("inconsistent_naming", catalog.filter(~F.col("name").rlike("^[a-z0-9_]+$")))))

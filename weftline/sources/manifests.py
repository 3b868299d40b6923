"""Pipeline, project and orchestrator declarations as node and edge rows."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from weftline.schemas import MANIFEST, SNAPSHOT_LOG


def parse_manifests(docs: DataFrame, column: str = "manifest") -> DataFrame:
    return docs.select(F.inline(F.array(F.from_json(column, MANIFEST))))


def model_graph(manifests: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Sources and models as nodes, and dependency -> model edges."""
    sources = manifests.selectExpr("explode(sources) AS (id, body)").selectExpr("id", "body.name AS name", "'source' AS type")
    entries = manifests.selectExpr("explode(nodes) AS (id, body)").filter("body.resource_type = 'model'")
    nodes = sources.unionByName(entries.selectExpr("id", "body.name AS name", "'model' AS type")).distinct()
    edges = entries.selectExpr("explode(body.depends_on.nodes) AS src", "id AS dst").distinct()
    return nodes, edges


def resource_graph(manifests: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Every resource and exposure as a node; parent edges whose two ends both exist."""
    sources = manifests.selectExpr("explode(sources) AS (id, body)").selectExpr("id", "body.name AS name", "'source' AS type")
    entries = manifests.selectExpr("explode(nodes) AS (id, body)").selectExpr("id", "body.name AS name", "body.resource_type AS type")
    exposures = manifests.selectExpr("explode(exposures) AS (id, body)").selectExpr("id", "body.name AS name", "'exposure' AS type")
    nodes = sources.unionByName(entries).unionByName(exposures).distinct()
    parents = manifests.selectExpr("explode(parent_map) AS (dst, parents)").selectExpr("explode(parents) AS src", "dst").distinct()
    known = nodes.select("id")
    edges = parents.join(known.withColumnRenamed("id", "src"), "src", "left_semi").join(known.withColumnRenamed("id", "dst"), "dst", "left_semi")
    return nodes, edges.select("src", "dst")


def with_catalog(nodes: DataFrame, catalog: DataFrame) -> DataFrame:
    """Add catalog statistics to the nodes that exist; entries without a node are left out."""
    return nodes.join(catalog, "id", "left")


def declared_graph(tasks: DataFrame) -> DataFrame:
    """(src, dst, type) from task declarations (name, inputs[], outputs[])."""
    return tasks.selectExpr(
        "inline(concat(transform(inputs, d -> named_struct('src', d, 'dst', name, 'type', 'input')), "
        "transform(outputs, d -> named_struct('src', name, 'dst', d, 'type', 'output'))))").distinct()


def declared_nodes(catalog: DataFrame, tasks: DataFrame) -> DataFrame:
    """Catalog entries and every task port as dataset nodes; tasks as task nodes."""
    ports = tasks.selectExpr("explode(concat(inputs, outputs)) AS id")
    datasets = catalog.selectExpr("name AS id").unionByName(ports).selectExpr("id", "'dataset' AS type")
    return datasets.unionByName(tasks.selectExpr("name AS id", "'task' AS type")).distinct()


def dag_task_edges(dags: DataFrame) -> DataFrame:
    """task -> task edges of a dependencies map (upstream task -> downstream tasks)."""
    return dags.selectExpr("dag_id", "explode(dependencies) AS (src, targets)").selectExpr("dag_id", "src", "explode(targets) AS dst")


def payload_edges(payload: DataFrame) -> DataFrame:
    """Edges of a server payload whose nodes list their incoming and outgoing edges."""
    return payload.selectExpr("inline(concat(coalesce(in_edges, array()), coalesce(out_edges, array())))").selectExpr(
        "origin AS src", "destination AS dst").distinct()


def snapshot_changes(docs: DataFrame, column: str = "metadata") -> DataFrame:
    """Who changed a table when, from the snapshot list of its metadata document."""
    parsed = docs.select(F.inline(F.array(F.from_json(column, SNAPSHOT_LOG))))
    return parsed.selectExpr("table AS dataset", "inline(snapshots)").selectExpr(
        "dataset", "`snapshot-id` AS snapshot_id", "`timestamp-ms` AS timestamp_ms", "operation",
        "CAST(summary['added-records'] AS BIGINT) AS added_records")

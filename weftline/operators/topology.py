"""Graph questions answered with a fixed number of joins."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from weftline.operators.traversal import reach


def roots(nodes: DataFrame, edges: DataFrame, kind: str | None = "dataset") -> DataFrame:
    """Nodes nothing writes to."""
    kept = nodes if kind is None else nodes.filter(F.col("type") == kind)
    return kept.join(edges.select(F.col("dst").alias("id")), "id", "left_anti")


def leaves(nodes: DataFrame, edges: DataFrame, kind: str | None = "dataset") -> DataFrame:
    """Nodes nothing reads from."""
    kept = nodes if kind is None else nodes.filter(F.col("type") == kind)
    return kept.join(edges.select(F.col("src").alias("id")), "id", "left_anti")


def unused_datasets(nodes: DataFrame, edges: DataFrame, exposures: DataFrame) -> DataFrame:
    """Datasets without readers that no declared exposure (id) shows."""
    return leaves(nodes, edges).join(exposures.select("id"), "id", "left_anti")


def type_violations(nodes: DataFrame, edges: DataFrame) -> DataFrame:
    """Edges between two nodes of one type."""
    kinds = nodes.select("id", "type")
    left = kinds.select(F.col("id").alias("src"), F.col("type").alias("src_type"))
    right = kinds.select(F.col("id").alias("dst"), F.col("type").alias("dst_type"))
    return edges.select("src", "dst").distinct().join(left, "src").join(right, "dst").filter("src_type = dst_type").select(
        "src", "dst", F.col("src_type").alias("type"))


def graph_stats(nodes: DataFrame, edges: DataFrame) -> DataFrame:
    """(stat, value): node, edge and per-type counts."""
    kinds = nodes.groupBy(F.concat(F.lit("nodes:"), F.col("type")).alias("stat")).agg(F.count("*").alias("value"))
    total = nodes.agg(F.count("*").alias("value")).select(F.lit("total_nodes").alias("stat"), "value")
    links = edges.select("src", "dst").distinct().agg(F.count("*").alias("value")).select(F.lit("total_edges").alias("stat"), "value")
    return total.unionByName(links).unionByName(kinds)


def enrich_nodes(nodes: DataFrame, edges: DataFrame, closure: DataFrame, catalog: DataFrame) -> DataFrame:
    """Direct and total counts both ways and catalog values, with defaults where there is no entry.

    ``catalog`` has id, owner, classification and contains_pii.
    """
    pairs = edges.select("src", "dst").distinct()
    direct_down = pairs.groupBy(F.col("src").alias("id")).agg(F.count("*").alias("direct_downstream"))
    direct_up = pairs.groupBy(F.col("dst").alias("id")).agg(F.count("*").alias("direct_upstream"))
    total_down = closure.groupBy(F.col("ancestor").alias("id")).agg(F.count("*").alias("total_downstream"))
    total_up = closure.groupBy(F.col("descendant").alias("id")).agg(F.count("*").alias("total_upstream"))
    out = nodes
    for part in (direct_up, direct_down, total_up, total_down, catalog):
        out = out.join(part, "id", "left")
    return out.fillna(0, ["direct_upstream", "direct_downstream", "total_upstream", "total_downstream"]).fillna(
        {"owner": "none", "classification": "UNKNOWN", "contains_pii": False})


def broken_by_removal(edges: DataFrame, roots: DataFrame, removed: DataFrame) -> DataFrame:
    """(root, node) pairs that were reachable and are not once the ``removed`` (id) nodes go."""
    gone = removed.select("id")
    kept = edges.join(gone.withColumnRenamed("id", "src"), "src", "left_anti").join(
        gone.withColumnRenamed("id", "dst"), "dst", "left_anti")
    before = reach(edges, roots).select("root", "node").join(gone.withColumnRenamed("id", "node"), "node", "left_anti")
    return before.join(reach(kept, roots).select("root", "node"), ["root", "node"], "left_anti").select("root", "node")


def task_slice(reached: DataFrame, nodes: DataFrame, edges: DataFrame) -> DataFrame:
    """The jobs of a traversal with their declared inputs and outputs, one row per port."""
    jobs = reached.join(nodes.filter("type = 'job'").select(F.col("id").alias("node")), "node", "left_semi").select("root", F.col("node").alias("task"))
    inputs = edges.select(F.col("dst").alias("task"), F.col("src").alias("dataset"), F.lit("input").alias("role"))
    outputs = edges.select(F.col("src").alias("task"), F.col("dst").alias("dataset"), F.lit("output").alias("role"))
    return jobs.join(inputs.unionByName(outputs).distinct(), "task").select("root", "task", "role", "dataset")


def roll_up(edges: DataFrame, groups: DataFrame) -> DataFrame:
    """(src_group, dst_group, n_edges) after replacing each node by its group (id, grp)."""
    left = groups.select(F.col("id").alias("src"), F.col("grp").alias("src_group"))
    right = groups.select(F.col("id").alias("dst"), F.col("grp").alias("dst_group"))
    return edges.select("src", "dst").distinct().join(left, "src").join(right, "dst").groupBy("src_group", "dst_group").agg(
        F.count("*").alias("n_edges"))

"""Registered column- and row-level lineage queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from weftline.operators import columns, paths, traversal
from weftline.plans.registry import query
from weftline.session import cut_lineage

_UP = """SELECT dst AS root, dst AS node, 0 AS depth FROM column_edges WHERE dst NOT IN (SELECT src FROM column_edges)
    UNION SELECT w.root, e.src, w.depth + 1 FROM col_up w JOIN column_edges e ON e.dst = w.node"""
_DOWN = """SELECT src AS root, src AS node, 0 AS depth FROM column_edges WHERE src NOT IN (SELECT dst FROM column_edges)
    UNION SELECT w.root, e.dst, w.depth + 1 FROM col_down w JOIN column_edges e ON e.src = w.node"""


def graph(t):
    return cut_lineage(t.column_edges())


def final_columns(edges):
    return edges.select(F.col("dst").alias("root")).distinct().join(edges.select(F.col("src").alias("root")), "root", "left_anti")


def first_columns(edges):
    return edges.select(F.col("src").alias("root")).distinct().join(edges.select(F.col("dst").alias("root")), "root", "left_anti")


@query("c01_trace_column", """SELECT DISTINCT root, src, dst, transformation, depth FROM (SELECT root, node, min(depth) AS depth FROM col_up GROUP BY ALL) JOIN column_edges ON dst = node""", col_up=_UP)
def c01(t):
    edges = graph(t)
    return columns.trace_columns(edges, final_columns(edges))


@query("c02_column_impact", """SELECT DISTINCT root, src, dst, transformation, depth FROM (SELECT root, node, min(depth) AS depth FROM col_down GROUP BY ALL) JOIN column_edges ON src = node""", col_down=_DOWN)
def c02(t):
    edges = graph(t)
    return columns.column_impact(edges, first_columns(edges))


@query("c03_impact_summary", "SELECT root, count(*) AS n_columns, count(DISTINCT split_part(node, '.', 1)) AS n_datasets, max(depth) AS max_depth FROM col_closure GROUP BY root")
def c03(t):
    edges = graph(t)
    return columns.impact_summary(traversal.reach(edges, traversal.roots_of(edges, "src")))


_COLUMN_PATHS = """SELECT src AS root, dst AS node, [src, dst] AS path FROM (SELECT DISTINCT src, dst FROM column_edges) WHERE src NOT IN (SELECT dst FROM column_edges)
    UNION ALL SELECT w.root, e.dst, list_append(w.path, e.dst) FROM column_path w JOIN (SELECT DISTINCT src, dst FROM column_edges) e ON e.src = w.node"""


@query("c04_origin_paths", "SELECT root, node AS target, array_to_string(path, ' > ') AS path FROM column_path WHERE node NOT IN (SELECT src FROM column_edges)", column_path=_COLUMN_PATHS)
def c04(t):
    edges = graph(t)
    finals = final_columns(edges).withColumnRenamed("root", "target")
    pairs = traversal.reach(edges, first_columns(edges)).select("root", F.col("node").alias("target")).join(finals, "target", "left_semi")
    return paths.simple_paths(edges, cut_lineage(pairs)).select("root", "target", F.concat_ws(" > ", "path").alias("path"))


@query("c05_column_provenance", "SELECT DISTINCT root, node AS origin FROM col_up WHERE node NOT IN (SELECT dst FROM column_edges)", col_up=_UP)
def c05(t):
    edges = graph(t)
    return columns.provenance(edges, final_columns(edges))


@query("c06_pii_propagation", "SELECT root, node, depth FROM col_closure WHERE root IN (SELECT src FROM column_edges WHERE is_pii)")
def c06(t):
    return columns.pii_propagation(graph(t))


@query("c06_pii_propagation_with_source", "SELECT root, node, depth FROM col_closure WHERE root IN (SELECT src FROM column_edges WHERE is_pii) UNION SELECT src, src, 0 FROM column_edges WHERE is_pii")
def c06_source(t):
    return columns.pii_propagation(graph(t), include_source=True)


@query("c07_table_roll_up", "SELECT src_ds AS src, dst_ds AS dst, count(*) AS n_columns FROM column_edges GROUP BY ALL")
def c07(t):
    return columns.table_edges(t.column_edges())


@query("c08_row_provenance", """SELECT DISTINCT 'customer:' || o_custkey AS out_row, 'part:' || l_partkey AS source_row FROM lineitem JOIN orders ON o_orderkey = l_orderkey""")
def c08(t):
    edges = t.entity_edges()
    items = edges.filter("startswith(src, 'part:')").selectExpr("src AS source_row", "dst AS via")
    orders = edges.filter("startswith(src, 'order:')").selectExpr("src AS via", "dst AS out_row")
    return items.join(orders, "via").select("out_row", "source_row").distinct()


@query("c08_row_provenance_counts", """SELECT 'customer:' || o_custkey AS out_row, count(DISTINCT l_partkey) AS n_sources FROM lineitem JOIN orders ON o_orderkey = l_orderkey GROUP BY 1""")
def c08_counts(t):
    return c08(t).groupBy("out_row").agg(F.count("*").alias("n_sources"))


@query("c09_schema_lineage", """SELECT job_name, dst, count(DISTINCT src) AS n_sources, count(DISTINCT src_ds) AS n_tables, min(src) AS first_source, max(src) AS last_source,
    count(DISTINCT transformation) AS n_transformations FROM column_edges GROUP BY job_name, dst""")
def c09(t):
    return columns.schema_lineage(t.column_edges())

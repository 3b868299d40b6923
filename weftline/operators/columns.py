"""Column-level lineage over (src_ds, src_col, dst_ds, dst_col, transformation) edges."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from weftline.operators.traversal import reach, roots_of


def trace_columns(column_edges: DataFrame, roots: DataFrame) -> DataFrame:
    """Mappings met when walking up from each root column, with the distance of their target."""
    reached = reach(column_edges, roots, "upstream", include_root=True).select("root", F.col("node").alias("dst"), "depth")
    return reached.join(column_edges, "dst").select("root", "src", "dst", "transformation", "depth").distinct()


def column_impact(column_edges: DataFrame, roots: DataFrame) -> DataFrame:
    """Mappings met when walking down, once per (target, source) even where paths meet."""
    reached = reach(column_edges, roots, "downstream", include_root=True).select("root", F.col("node").alias("src"), "depth")
    return reached.join(column_edges, "src").select("root", "src", "dst", "transformation", "depth").dropDuplicates(["root", "dst", "src", "transformation"])


def impact_summary(reached: DataFrame) -> DataFrame:
    """Per root column: downstream columns and datasets."""
    return reached.groupBy("root").agg(
        F.count("*").alias("n_columns"), F.countDistinct(F.split_part("node", F.lit("."), F.lit(1))).alias("n_datasets"), F.max("depth").alias("max_depth"))


def provenance(column_edges: DataFrame, roots: DataFrame) -> DataFrame:
    """(root, origin): ancestors without a mapping of their own; a source column is its own origin."""
    reached = reach(column_edges, roots, "upstream", include_root=True).select("root", F.col("node").alias("origin"))
    return reached.join(column_edges.select(F.col("dst").alias("origin")), "origin", "left_anti").select("root", "origin")


def pii_propagation(column_edges: DataFrame, include_source: bool = False) -> DataFrame:
    """(root, node, depth) for columns derived from personal-data columns. Sources nothing is
    derived from have no row unless ``include_source``."""
    marked = roots_of(column_edges.filter("is_pii"), "src")
    return reach(column_edges, marked, "downstream", include_root=include_source)


def table_edges(column_edges: DataFrame) -> DataFrame:
    return column_edges.groupBy(F.col("src_ds").alias("src"), F.col("dst_ds").alias("dst")).agg(F.count("*").alias("n_columns"))


def schema_lineage(column_edges: DataFrame) -> DataFrame:
    """Per target column of a job: number of sources and of tables, least and greatest source."""
    return column_edges.groupBy("job_name", "dst").agg(
        F.countDistinct("src").alias("n_sources"), F.countDistinct("src_ds").alias("n_tables"),
        F.min("src").alias("first_source"), F.max("src").alias("last_source"), F.countDistinct("transformation").alias("n_transformations"))


def classify(source: Column, target: Column, expression: Column) -> Column:
    """Kind of a derivation from the names of its ends and the expression text."""
    text = F.lower(F.coalesce(expression, F.lit("")))
    return (
        F.when(text.rlike("^ *where "), "FILTER").when(text.rlike("^ *on "), "JOIN_KEY")
        .when(text.rlike(r"\b(sum|count|avg|min|max)\("), "AGGREGATION").when(text.rlike(r"\bcase when\b"), "CONDITIONAL")
        .when(text.rlike(r"\bcast\("), "CAST").when(text != "", "EXPRESSION")
        .when(source == target, "IDENTITY").otherwise("RENAME"))


def directness(kind: Column) -> Column:
    return F.when(kind.isin("FILTER", "JOIN_KEY", "SORT"), "INDIRECT").otherwise("DIRECT")

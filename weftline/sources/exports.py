"""Graph exports as rows of text or JSON."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


def safe_id(column: str) -> Column:
    return F.regexp_replace(column, "[/. -]", "_")


def write_curated(df: DataFrame, path: str, date_column: str) -> None:
    """Overwrite a table partitioned by day; rows of a day are gathered before the write,
    split into several files where a day is large."""
    dated = df.withColumn("event_date", F.to_date(date_column))
    dated.hint("rebalance", "event_date").write.mode("overwrite").partitionBy("event_date").parquet(path)


def graph_json(nodes: DataFrame, edges: DataFrame) -> DataFrame:
    """(kind, body): one JSON object per node and per edge."""
    left = nodes.select(F.lit("node").alias("kind"), F.to_json(F.struct("id", "type")).alias("body"))
    right = edges.select(F.lit("link").alias("kind"), F.to_json(F.struct(F.col("src").alias("source"), F.col("dst").alias("target"))).alias("body"))
    return left.unionByName(right.distinct())


def read_graph_json(spark: SparkSession, path: str) -> tuple[DataFrame, DataFrame]:
    """Nodes and edges of an export written one JSON object per line."""
    rows = spark.read.schema("id STRING, type STRING, source STRING, target STRING").json(path)
    return rows.filter("id IS NOT NULL").select("id", "type"), rows.filter("source IS NOT NULL").selectExpr("source AS src", "target AS dst")


def flat_attributes(nodes: DataFrame, nested: str) -> DataFrame:
    """Replace a nested column by its JSON text, for tools that take plain attributes only."""
    return nodes.withColumn(f"{nested}_json", F.to_json(nested)).drop(nested)


def diagram_lines(nodes: DataFrame, edges: DataFrame, round_types: tuple[str, ...] = ("dataset", "topic")) -> DataFrame:
    """(ord, line) of a left-to-right diagram: header, one line per node, one per edge."""
    header = nodes.sparkSession.range(1).select(F.lit(0).alias("ord"), F.lit("graph LR").alias("line"))
    boxed = F.when(F.col("type").isin(*round_types), F.format_string('    %s[("%s")]', safe_id("id"), F.col("id"))).otherwise(
        F.format_string('    %s["%s"]', safe_id("id"), F.col("id")))
    shapes = nodes.select(F.lit(1).alias("ord"), boxed.alias("line"))
    arrows = edges.select("src", "dst").distinct().select(F.lit(2).alias("ord"), F.format_string("    %s --> %s", safe_id("src"), safe_id("dst")).alias("line"))
    return header.unionByName(shapes).unionByName(arrows)


def subgraph_lines(reached: DataFrame, nodes: DataFrame, edges: DataFrame) -> DataFrame:
    """(root, ord, line) for the nodes of a traversal that kept its roots, and the edges inside it."""
    inside = reached.select("root", "node")
    left, right = inside.withColumnRenamed("node", "src"), inside.withColumnRenamed("node", "dst")
    kinds = nodes.select(F.col("id").alias("node"), "type")
    boxed = F.when(F.col("type") == "dataset", F.format_string('    %s[("%s")]', safe_id("node"), F.col("node"))).otherwise(
        F.format_string('    %s["%s"]', safe_id("node"), F.col("node")))
    shapes = inside.join(kinds, "node").select("root", F.lit(1).alias("ord"), boxed.alias("line"))
    arrows = left.join(edges.select("src", "dst").distinct(), "src").join(right, ["root", "dst"], "left_semi").select(
        "root", F.lit(2).alias("ord"), F.format_string("    %s --> %s", safe_id("src"), safe_id("dst")).alias("line"))
    header = reached.select("root").distinct().select("root", F.lit(0).alias("ord"), F.lit("graph LR").alias("line"))
    return header.unionByName(shapes).unionByName(arrows)

"""Column statistics and schemas of tables and text files."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


def inspect_table(df: DataFrame) -> DataFrame:
    """One row per column: type, nullability, least and greatest value, null and value counts."""
    measures = []
    for i, field in enumerate(df.schema.fields):
        c = F.col(f"`{field.name}`")
        measures.append(F.struct(
            F.lit(field.name).alias("column_name"), F.lit(field.dataType.simpleString()).alias("column_type"),
            F.lit(field.nullable).alias("nullable"), F.min(c).cast("string").alias("min_value"), F.max(c).cast("string").alias("max_value"),
            F.count_if(c.isNull()).alias("null_count"), F.count("*").alias("num_values")).alias(f"m{i}"))
    return df.agg(*measures).select(F.inline(F.array(*[f"m{i}" for i in range(len(measures))])))


def inspect_csv(spark: SparkSession, path: str) -> DataFrame:
    """One row per file: name, size, modification time, its own header columns and row count.

    Rows are counted as the CSV reader sees them, so line feeds inside quotes don't count. The header is the first line of a file's first block.
    """
    def about(df: DataFrame, *more: Column) -> DataFrame:
        names = ("file_path", "file_name", "file_size", "file_modification_time")
        return df.select(*[F.col(f"_metadata.{n}").alias(n) for n in names], *more)

    rows = about(spark.read.option("header", True).csv(path)).groupBy("file_path").agg(F.count("*").alias("row_count"))
    lines = about(spark.read.text(path), "value", F.col("_metadata.file_block_start").alias("block"), F.monotonically_increasing_id().alias("line")).filter("block = 0")
    files = lines.groupBy("file_path", "file_name", "file_size", "file_modification_time").agg(F.min_by("value", "line").alias("columns"))
    return files.join(rows, "file_path", "left").select(
        "file_name", "file_size", F.col("file_modification_time").alias("modified_at"), "columns", F.lit("string").alias("column_type"), F.coalesce("row_count", F.lit(0)).alias("row_count"))


def json_key_types(docs: DataFrame, column: str) -> DataFrame:
    """(key, value_type, n) over the top-level keys of JSON documents."""
    parsed = docs.select(F.parse_json(F.col(column)).alias("doc"))
    keyed = docs.sparkSession.sql(
        "SELECT key, schema_of_variant(value) AS variant_type FROM {parsed}, LATERAL variant_explode(doc)", parsed=parsed)
    kind = (
        F.when(F.col("variant_type") == "BIGINT", "int").when(F.col("variant_type") == "STRING", "str")
        .when(F.col("variant_type") == "BOOLEAN", "bool").when(F.col("variant_type") == "VOID", "NoneType")
        .when(F.col("variant_type").startswith("ARRAY"), "list").when(F.col("variant_type").startswith("OBJECT"), "dict").otherwise("float"))
    return keyed.groupBy("key", kind.alias("value_type")).agg(F.count("*").alias("n"))


def foreign_keys(constraints: DataFrame, usage: DataFrame, references: DataFrame) -> DataFrame:
    """Structural lineage: constraints(constraint_name, constraint_type), usage(constraint_name,
    dataset, column_name), references(constraint_name, target_dataset, target_column)."""
    return constraints.filter("constraint_type = 'FOREIGN KEY'").join(usage, "constraint_name").join(references, "constraint_name").select(
        "constraint_name", F.col("dataset").alias("src_dataset"), F.col("column_name").alias("src_column"), "target_dataset", "target_column")


def table_history(versions: DataFrame, version: int | Column, keys: list[str], order: str) -> DataFrame:
    """A table as of a version: the last row per key written at or before it, unless deleted.

    ``versions`` has a ``version``, a ``deleted`` flag and the key columns; ``order`` puts the rows of one version in order.
    """
    values = [c for c in versions.columns if c not in keys]
    latest = versions.filter(F.col("version") <= version).groupBy(*keys).agg(F.max_by(F.struct(*values), F.struct("version", order)).alias("row"))
    return latest.select(*keys, "row.*").filter("NOT deleted").drop("deleted")

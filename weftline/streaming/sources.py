"""Streams of events from files or a broker topic."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

EVENT_SCHEMA = "event_id BIGINT, ts TIMESTAMP_NTZ, user_id BIGINT, event_type STRING, value DOUBLE, props STRING"


def file_stream(spark: SparkSession, path: str, schema: str = EVENT_SCHEMA, fmt: str = "parquet", files_per_batch: int | None = None) -> DataFrame:
    """New files of a folder; ``ts`` becomes a timestamp with zone, which watermarks need."""
    reader = spark.readStream.schema(schema).format(fmt)
    if files_per_batch:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)
    stream = reader.load(path)
    return stream.withColumn("ts", F.col("ts").cast("timestamp")) if "ts" in stream.columns else stream


def table_stream(spark: SparkSession, folder: str, name: str, schema: str = EVENT_SCHEMA, files_per_batch: int | None = None) -> DataFrame:
    """A Parquet table as a stream, whether it is one file or a folder of files. A plain file
    is no legal stream path, a pattern that matches it is."""
    return file_stream(spark, f"{folder}/{name}.parque[t]", schema, files_per_batch=files_per_batch)


def write_arrivals(df: DataFrame, part: str, parts: int, files: int, path: str) -> None:
    """``df`` as files that arrive in the order of the column ``part`` (0 to ``parts`` - 1), ``files`` of them for each part.

    One part is written after the other, so a file stream with that many files a batch reads a part in each batch.
    """
    for number in range(parts):
        own = df.filter(F.col(part) == number).drop(part)
        own.repartition(files).write.mode("append").parquet(path)


def topic_stream(spark: SparkSession, servers: str, topic: str, schema: str) -> DataFrame:
    """JSON values of a Kafka topic as columns (needs the Kafka connector on the class path)."""
    raw = spark.readStream.format("kafka").option("kafka.bootstrap.servers", servers).option("subscribe", topic).load()
    return parse_values(raw.select(F.col("value").cast("string").alias("value")), schema)


def parse_values(raw: DataFrame, schema: str) -> DataFrame:
    return raw.select(F.inline(F.array(F.from_json("value", schema))))

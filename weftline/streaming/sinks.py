"""Sinks that survive a repeated batch: every batch owns one partition folder and overwrites it."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery


def write_batch(df: DataFrame, batch_id: int, path: str) -> None:
    df.write.mode("overwrite").parquet(f"{path}/batch_id={batch_id}")


#: State that timers and large keyed states need.
ROCKSDB = {"spark.sql.streaming.stateStore.providerClass": "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"}


def start(
    stream: DataFrame, path: str, checkpoint: str, mode: str = "append", transform: Callable[[DataFrame], DataFrame] | None = None,
    write: Callable[[DataFrame, int, str], None] = write_batch, settings: dict[str, str] | None = None,
) -> StreamingQuery:
    """Write every micro-batch, optionally reshaped by ``transform``, and stop when the input is used up.

    Each batch also logs the batches before it (see ``batch_log``), so a long run forgets none. ``write`` must leave the same files when a
    batch comes again. ``settings`` hold for this query alone. Started again with the same ``checkpoint``, it goes on where it ended.
    """
    running: list[StreamingQuery] = []

    def each(batch: DataFrame, batch_id: int) -> None:
        write(transform(batch) if transform else batch, batch_id, path)
        for query in running:
            log_batches(query)

    conf, wanted = stream.sparkSession.conf, settings or {}
    before = {k: conf.get(k, None) for k in wanted}
    try:
        for k, v in wanted.items():
            conf.set(k, v)
        # The query keeps the settings of this moment.
        query = stream.writeStream.outputMode(mode).foreachBatch(each).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
    finally:
        for k, v in before.items():
            conf.unset(k) if v is None else conf.set(k, v)
    query.log_path, query.log_session, query.logged = f"{path}-batches", stream.sparkSession, -1
    running.append(query)
    return query


def split_late(late_by: str) -> Callable[[DataFrame, int, str], None]:
    """A ``write`` for ``start`` that keeps rows behind the watermark apart instead of dropping them.

    The watermark of a batch is the largest ``ts`` of all batches before it less ``late_by``. Rows get it as ``watermark`` and
    lie in ``late=true`` or ``late=false``. The clock of every batch is stored beside the rows, so a repeated batch has the watermark it had.
    """
    def write(batch: DataFrame, batch_id: int, path: str) -> None:
        spark = batch.sparkSession
        before = [F.lit(None).cast("timestamp")]
        if batch_id:
            clocks = spark.read.schema("ts TIMESTAMP, batch_id BIGINT").option("basePath", f"{path}-clock").parquet(f"{path}-clock")
            before = [F.lit(clocks.filter(F.col("batch_id") < batch_id).agg((F.max("ts") - F.expr(f"INTERVAL {late_by}")).alias("w")).first().w).cast("timestamp")]
        marked = batch.withColumn("watermark", before[0]).withColumn("late", F.coalesce(F.col("ts") < F.col("watermark"), F.lit(False)))
        marked.write.mode("overwrite").partitionBy("late").parquet(f"{path}/batch_id={batch_id}")
        clock = spark.read.schema("ts TIMESTAMP").parquet(f"{path}/batch_id={batch_id}").agg(F.max("ts").alias("ts"))
        write_batch(clock, batch_id, f"{path}-clock")

    return write


def append_files(stream: DataFrame, path: str, checkpoint: str) -> StreamingQuery:
    return stream.writeStream.format("parquet").outputMode("append").option("path", path).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


def to_topic(stream: DataFrame, key: str, servers: str, topic: str, checkpoint: str) -> StreamingQuery:
    """Key and JSON value to a Kafka topic (needs the Kafka connector on the class path)."""
    rows = stream.select(F.col(key).cast("string").alias("key"), F.to_json(F.struct("*")).alias("value"))
    return rows.writeStream.format("kafka").outputMode("update").option("kafka.bootstrap.servers", servers).option("topic", topic).option("checkpointLocation", checkpoint).start()


def read_batches(spark: SparkSession, path: str, schema) -> DataFrame:
    """All batches with their ``batch_id``."""
    return spark.read.schema(schema).option("basePath", path).parquet(path)


def latest_rows(batches: DataFrame, keys: list[str]) -> DataFrame:
    """The row of the newest batch for each key: the current state of an update stream."""
    values = [c for c in batches.columns if c not in keys and c != "batch_id"]
    newest = batches.groupBy(*keys).agg(F.max_by(F.struct(*values), "batch_id").alias("row"))
    return newest.select(*keys, "row.*")


def finish(query: StreamingQuery) -> StreamingQuery:
    query.awaitTermination()
    if query.exception() is not None:
        raise query.exception()
    return query


BATCH_LOG = "batch_id BIGINT, source STRING, start_offset STRING, end_offset STRING, n_rows BIGINT, late_rows BIGINT"


def log_batches(query: StreamingQuery) -> None:
    """Write the finished batches that aren't logged yet, one folder each. Spark remembers a hundred of them."""
    for progress in query.recentProgress:
        number = progress["batchId"]
        if number <= query.logged:
            continue
        late = sum(s["numRowsDroppedByWatermark"] for s in progress["stateOperators"])
        rows = [(number, s["description"], str(s["startOffset"]), str(s["endOffset"]), int(s["numInputRows"]), int(late)) for s in progress["sources"]]
        query.log_session.createDataFrame(rows, BATCH_LOG).coalesce(1).write.mode("overwrite").parquet(f"{query.log_path}/batch={number}")
        query.logged = number


def batch_log(query: StreamingQuery) -> DataFrame:
    """One row per finished micro-batch and source: offsets, rows in, rows dropped as late. ``query`` comes from ``start``."""
    log_batches(query)
    spark = query.log_session
    if query.logged < 0:
        return spark.createDataFrame([], BATCH_LOG)
    return spark.read.schema(BATCH_LOG).option("basePath", query.log_path).parquet(f"{query.log_path}/batch=*").drop("batch")

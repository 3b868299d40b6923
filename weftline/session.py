"""Session settings and lineage cutting for iterative jobs."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
}


def build_session(app: str = "weftline", master: str | None = None, **conf: str) -> SparkSession:
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    for key, value in {**SETTINGS, **conf}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def checkpoint_root(spark: SparkSession) -> str:
    """Folder shared by driver and executors where intermediate tables live.

    The cluster names it in ``spark.checkpoint.dir``. Only a local session without
    that setting gets a temporary folder; a cluster session without it is refused,
    since files in a machine-local folder are lost with the machine.
    """
    context = spark.sparkContext
    current = context.getCheckpointDir()
    if current:
        return current
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if configured is None:
        if not context.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder every executor can reach")
        configured = tempfile.mkdtemp(prefix="weftline-checkpoint-")
    context.setCheckpointDir(configured)
    return context.getCheckpointDir()


def scratch_path(spark: SparkSession, label: str) -> str:
    return f"{checkpoint_root(spark)}/{label}-{uuid.uuid4().hex}"


def cut_lineage(df: DataFrame) -> DataFrame:
    """Write ``df`` as a table in the shared checkpoint folder and return a frame reading it.

    Later plans start at that table, so a lost executor costs a re-read instead of the whole
    history, and its file sizes tell the optimizer whether a side is small enough to broadcast.
    """
    spark = df.sparkSession
    path = scratch_path(spark, "cut")
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)

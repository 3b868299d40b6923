"""Queries of this package and their oracle SQL, over the tables as they are."""

from __future__ import annotations

from collections.abc import Callable
from importlib import import_module

from pyspark.sql import DataFrame, SparkSession

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}
MODULES: list[str] = ["kneser_ney", "quality", "sharding", "repair_ids", "bpe", "language", "jaccard_join", "url_filter", "topk", "decontaminate", "toxicity", "merkle", "prefix_trie"]


def query(name: str, sql: str | None = None):
    def wrap(fn: Callable[[SparkSession, str], DataFrame]):
        QUERIES[name] = fn
        if sql is not None:
            ORACLES[name] = sql
        return fn

    return wrap


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def load_all() -> None:
    for name in MODULES:
        import_module(f"weftline.llm.{name}")

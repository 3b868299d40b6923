"""Registered queries: one callable over (session, table folder) and its oracle SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from weftline.fixtures import Tables
from weftline.plans.oracle_tables import with_tables

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(name: str, sql: str | None = None, **extra_ctes: str):
    """Register ``fn(tables)`` under ``name``; ``sql`` is the oracle body."""

    def wrap(fn: Callable[[Tables], DataFrame]):
        if name in QUERIES:
            raise ValueError(f"query {name} is registered twice")
        QUERIES[name] = lambda spark, sf_dir: fn(Tables(spark, sf_dir))
        if sql is not None:
            ORACLES[name] = with_tables(sql, **extra_ctes)
        return fn

    return wrap

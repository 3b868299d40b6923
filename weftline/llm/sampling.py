"""Bounded samples of rows for fitting models, drawn by hash so that every run draws the same ones."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

_RANGE = 1 << 63


def hash_bound(share: float) -> int:
    """Hashes of 63 bits up to this bound make ``share`` of all."""
    return min(int(share * _RANGE), _RANGE - 1)


def crc_of_id(doc_id: Column) -> Column:
    return F.crc32(F.coalesce(doc_id.cast("string"), F.lit("")).cast("binary"))


def draw(df: DataFrame, size: int, *keys: str) -> DataFrame:
    """About ``size`` rows of ``df`` (a fifth more on average, all if there are fewer), with the hash they were drawn by as ``_draw``.

    Take the first ``size`` by ``_draw`` after the costly columns have been computed, so that only drawn rows have them.
    """
    rows = df.count()
    drawn = df.withColumn("_draw", F.shiftrightunsigned(F.xxhash64(F.lit("draw"), *keys), 1))
    return drawn.filter(F.col("_draw") <= hash_bound((1.2 * size + 20) / max(rows, 1)))

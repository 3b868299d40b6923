"""Gapless ranks of rows inside groups of any size, without a window over a group.

Rows are dealt into sorted ranges over (group, order); a rank is the number of the group's rows in earlier ranges plus
the place inside its own range. Ranges are cut by size, so a group that holds most rows spans many of them. Rows
that are equal in all columns are counted first and stay one row with ``copies``; the caller deals them out.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from weftline.session import cut_lineage

ROWS_A_RANGE = 500_000


def ranges_for(df: DataFrame, rows_a_range: int = ROWS_A_RANGE) -> int:
    """Ranges to deal ``df``, a stored table, into: as many as the session shuffles into, more where they would be large."""
    return max(int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")), -(-df.count() // rows_a_range))


def counted(df: DataFrame) -> DataFrame:
    """Stored: each different row of ``df`` once, with ``copies``."""
    return cut_lineage(df.groupBy(*df.columns).agg(F.count("*").alias("copies")))


def ranked(df: DataFrame, group: list[str], order: list[str], rows_a_range: int = ROWS_A_RANGE) -> DataFrame:
    """``df`` (counted, nulls first) with ``rank`` (from 0, of the first copy) and ``rows`` (of the group), one row for each row of ``df``.

    Both are in copies. ``group`` and ``order`` together must tell the rows apart.
    """
    sorted_rows = cut_lineage(
        df.repartitionByRange(ranges_for(df, rows_a_range), *group, *order).withColumn("_range", F.spark_partition_id()))
    # One row for each range and each group in it: a range holds a run of groups, so there are no more than ranges + groups.
    sums = cut_lineage(sorted_rows.groupBy("_range", *group).agg(F.sum("copies").alias("_sum")))
    over = Window.partitionBy(*group)
    before = over.orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    starts = sums.select("_range", *group, F.coalesce(F.sum("_sum").over(before), F.lit(0)).alias("_start"), F.sum("_sum").over(over).alias("rows"))
    inside = Window.partitionBy("_range", *group).orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    placed = sorted_rows.withColumn("_inner", F.coalesce(F.sum("copies").over(inside), F.lit(0))).alias("p")
    same = F.col("p._range") == F.col("s._range")
    for name in group:
        same &= F.col(f"p.{name}").eqNullSafe(F.col(f"s.{name}"))
    return placed.join(starts.alias("s"), same).select(
        *[F.col(f"p.{c}") for c in df.columns], (F.col("s._start") + F.col("p._inner")).alias("rank"), F.col("s.rows").alias("rows"))

"""Versioned edges, point-in-time graphs and differences."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def close_versions(opened: DataFrame, removed_when: Column | None = None, removed_at: DataFrame | None = None) -> DataFrame:
    """Add valid_to to (src, dst, valid_from) rows.

    A later version of an edge closes the one before at its own valid_from. The last version
    stays open unless ``removed_when`` holds; then the single value in ``removed_at`` closes it.
    """
    following = F.lead("valid_from").over(Window.partitionBy("src", "dst").orderBy("valid_from"))
    if removed_when is not None:
        following = F.coalesce(following, F.when(removed_when, removed_at.scalar()))
    return opened.withColumn("valid_to", following)


def active_at(versions: DataFrame, at: Column) -> DataFrame:
    """Edges valid at an instant; both ends of the interval count as valid."""
    return versions.filter((F.col("valid_from") <= at) & (F.col("valid_to").isNull() | (at <= F.col("valid_to"))))


#: The span of the instants is cut into 2 ** BIN_LEVELS bins, and those are joined by twos up to one.
BIN_LEVELS = 20


def tree_cover(intervals: DataFrame, levels: int) -> DataFrame:
    """``intervals`` with a row for each (level, bin) that covers the bins from ``first`` to ``last``; two on a level at most."""
    # On level k the cover reaches from ceil(first / 2^k) to floor((last + 1) / 2^k); odd borders are bins of that level.
    low, high = "(first + shiftleft(1L, k) - 1) div shiftleft(1L, k)", "(last + 1) div shiftleft(1L, k)"
    borders = f"""array(named_struct('bin', {low}, 'take', ({low}) % 2 = 1 AND {low} < {high}), named_struct('bin', {high} - 1, 'take', ({high}) % 2 = 1 AND {low} < {high}))"""
    cover = f"flatten(transform(sequence(0, {levels + 1}), k -> transform(filter({borders}, b -> b.take), b -> named_struct('level', k, 'bin', b.bin))))"
    return intervals.select("*", F.expr(f"inline({cover})"))


def active_at_each(versions: DataFrame, times: DataFrame, levels: int = BIN_LEVELS) -> DataFrame:
    """(at, src, dst) for every instant of ``times`` (at) inside an edge's validity; both ends count, an open end never ends.

    Intervals and instants meet on the bins of a binary tree over the span of the instants. An interval is the
    fewest bins that cover it, two on a level at most, so a long one costs a row or two more for each doubling of its length; an instant has
    one bin on each level. Only the outermost bins hold instants beside the interval, which the comparison drops.
    """
    def micros(column: str) -> Column:
        return F.unix_micros(F.col(column).cast("timestamp"))

    span = times.agg(F.min(micros("at")).alias("low"), F.max(micros("at")).alias("high")).first()
    if span.low is None:
        return times.select("at", F.lit("").alias("src"), F.lit("").alias("dst")).limit(0)
    width = max(1, -(-(span.high - span.low + 1) >> levels))
    low, high = F.lit(span.low), F.lit(span.high)

    def bin_of(at: Column) -> Column:
        return F.floor((at - low) / F.lit(width)).cast("long")

    starts, ends = F.greatest(micros("valid_from"), low), F.least(F.coalesce(micros("valid_to"), high), high)
    held = versions.withColumn("starts", starts).withColumn("ends", ends).filter("starts <= ends")
    covered = tree_cover(held.select("src", "dst", "valid_from", "valid_to", bin_of(F.col("starts")).alias("first"), bin_of(F.col("ends")).alias("last")), levels)
    marks = times.select("at").distinct().withColumn("_bin", bin_of(micros("at"))).select(
        "at", F.explode(F.sequence(F.lit(0), F.lit(levels + 1))).alias("level"), "_bin").select("at", "level", F.expr("_bin div shiftleft(1L, level)").alias("bin"))
    return covered.join(marks, ["level", "bin"]).filter("valid_from <= at AND (valid_to IS NULL OR at <= valid_to)").select("at", "src", "dst").distinct()


def graph_diff(before: DataFrame, after: DataFrame) -> DataFrame:
    """(src, dst, status) with status added, removed or unchanged over distinct edges."""
    sides = before.select("src", "dst", F.lit(1).alias("side")).unionByName(after.select("src", "dst", F.lit(2).alias("side")))
    merged = sides.groupBy("src", "dst").agg(F.min("side").alias("low"), F.max("side").alias("high"))
    return merged.select(
        "src", "dst",
        F.when(F.col("low") == 2, "added").when(F.col("high") == 1, "removed").otherwise("unchanged").alias("status"))


def replay_until(edge_log: DataFrame, at: Column) -> DataFrame:
    """Event-sourced graph: distinct edges of every event up to an instant."""
    return edge_log.filter(F.col("ts") <= at).select("src", "dst", "type").distinct()


def schema_drift(before: DataFrame, after: DataFrame) -> DataFrame:
    """Column changes between two snapshots (dataset, column_name, column_type, ordinal).

    A removed and an added column with the same type and position are one rename.
    """
    old = before.select("dataset", "column_name", F.col("column_type").alias("old_type"), F.col("ordinal").alias("old_pos"))
    new = after.select("dataset", "column_name", F.col("column_type").alias("new_type"), F.col("ordinal").alias("new_pos"))
    status = (
        F.when(F.col("old_pos").isNull(), "added").when(F.col("new_pos").isNull(), "removed")
        .when(F.col("old_type") != F.col("new_type"), "type_changed").otherwise("same"))
    changed = old.join(new, ["dataset", "column_name"], "full").withColumn("status", status).filter("status <> 'same'")
    lost = changed.filter("status = 'removed'").select("dataset", F.col("column_name").alias("old_name"), F.col("old_type").alias("t"), F.col("old_pos").alias("p"))
    gained = changed.filter("status = 'added'").select("dataset", F.col("column_name").alias("new_name"), F.col("new_type").alias("t"), F.col("new_pos").alias("p"))
    renamed = lost.join(gained, ["dataset", "t", "p"]).select("dataset", "old_name", "new_name")
    rest = changed.join(renamed.select("dataset", F.col("old_name").alias("column_name"), F.lit("removed").alias("status")), ["dataset", "column_name", "status"], "left_anti").join(
        renamed.select("dataset", F.col("new_name").alias("column_name"), F.lit("added").alias("status")), ["dataset", "column_name", "status"], "left_anti")
    return rest.select("dataset", F.col("column_name"), F.lit("").alias("new_name"), "status").unionByName(
        renamed.select("dataset", F.col("old_name").alias("column_name"), "new_name", F.lit("renamed").alias("status")))

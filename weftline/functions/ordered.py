"""Order-dependent statistics that stay balanced when one key holds a large share of the rows.

A window over a hot key would sort all of its rows in one task. Here rows are grouped by
(key, bucket) first; only the per-bucket sums are put in order per key, and the bucket
result is added to what is computed inside each bucket.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

HISTOGRAM_BINS = 1024


def top_rows(df: DataFrame, keys: list[str], order: list[Column], n: int) -> DataFrame:
    """The first ``n`` rows of each key with their ``rank``. Spark keeps only ``n`` rows per key
    and input partition before the shuffle, so hot keys arrive already cut down."""
    ranked = df.withColumn("rank", F.row_number().over(Window.partitionBy(*keys).orderBy(*order)))
    return ranked.filter(F.col("rank") <= n)


def positions(df: DataFrame, keys: list[str], order: list[str], bucket: Column) -> DataFrame:
    """Add ``position``, the 1-based place of each row in its key. ``bucket`` must not decrease along ``order``."""
    rows = df.withColumn("_bucket", bucket)
    sizes = rows.groupBy(*keys, "_bucket").agg(F.count("*").alias("_size"))
    earlier = Window.partitionBy(*keys).orderBy("_bucket").rowsBetween(Window.unboundedPreceding, -1)
    starts = sizes.select(*keys, "_bucket", F.coalesce(F.sum("_size").over(earlier), F.lit(0)).alias("_start"))
    inside = F.row_number().over(Window.partitionBy(*keys, "_bucket").orderBy(*order))
    return rows.withColumn("_inside", inside).join(starts, [*keys, "_bucket"]).withColumn(
        "position", F.col("_start") + F.col("_inside")).drop("_bucket", "_start", "_inside")


def running_moments(df: DataFrame, keys: list[str], value: str, order: list[str], bucket: Column) -> DataFrame:
    """Add prior_n, prior_mean and prior_stdev (sample) over the earlier rows of each key.

    Bucket moments are merged with the pairwise update of mean and squared deviation around
    a centre near the mean, so large values do not cancel.
    """
    rows = df.withColumn("_bucket", bucket)
    v = F.col(value)
    per = rows.groupBy(*keys, "_bucket").agg(F.count(v).alias("_n"), F.avg(v).alias("_m"), (F.var_pop(v) * F.count(v)).alias("_s"))
    whole = Window.partitionBy(*keys)
    earlier = whole.orderBy("_bucket").rowsBetween(Window.unboundedPreceding, -1)
    per = per.withColumn("_c", F.avg("_m").over(whole)).withColumn("_d", F.col("_m") - F.col("_c"))
    per = per.select(
        *keys, "_bucket", "_c", F.coalesce(F.sum("_n").over(earlier), F.lit(0)).alias("_pn"),
        F.coalesce(F.sum(F.col("_n") * F.col("_d")).over(earlier), F.lit(0.0)).alias("_pd"),
        F.coalesce(F.sum(F.col("_s") + F.col("_n") * F.col("_d") * F.col("_d")).over(earlier), F.lit(0.0)).alias("_pq"))
    prefix = per.select(
        *keys, "_bucket", "_pn", (F.col("_c") + F.coalesce(F.try_divide("_pd", "_pn"), F.lit(0.0))).alias("_pm"),
        (F.col("_pq") - F.coalesce(F.try_divide(F.col("_pd") * F.col("_pd"), F.col("_pn")), F.lit(0.0))).alias("_ps"))
    before = Window.partitionBy(*keys, "_bucket").orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    rows = rows.select(
        "*", F.count(v).over(before).alias("_wn"), F.coalesce(F.avg(v).over(before), F.lit(0.0)).alias("_wm"),
        F.coalesce(F.var_pop(v).over(before), F.lit(0.0)).alias("_wv"))
    merged = rows.join(prefix, [*keys, "_bucket"]).withColumn("prior_n", F.col("_pn") + F.col("_wn"))
    mean = F.try_divide(F.col("_pn") * F.col("_pm") + F.col("_wn") * F.col("_wm"), F.col("prior_n"))
    gap = F.col("_wm") - F.col("_pm")
    spread = F.col("_ps") + F.col("_wv") * F.col("_wn") + F.coalesce(F.try_divide(gap * gap * F.col("_pn") * F.col("_wn"), F.col("prior_n")), F.lit(0.0))
    stdev = F.sqrt(F.try_divide(F.greatest(spread, F.lit(0.0)), F.col("prior_n") - 1))
    return merged.withColumn("prior_mean", mean).withColumn("prior_stdev", F.when(F.col("prior_n") > 1, stdev)).withColumn(
        "prior_stdev", F.when(F.col("prior_stdev") < F.abs("prior_mean") * 1e-9, 0.0).otherwise(F.col("prior_stdev"))
    ).drop("_bucket", "_pn", "_pm", "_ps", "_wn", "_wm", "_wv")


def previous_value(df: DataFrame, keys: list[str], value: str, order: str, bucket: Column, name: str) -> DataFrame:
    """Add ``name``, the value of the row before in each key. The first row of a bucket takes the
    last value of the bucket before it. ``bucket`` must not decrease along ``order``."""
    rows = df.withColumn("_bucket", bucket)
    ends = rows.groupBy(*keys, "_bucket").agg(F.max_by(value, order).alias("_last"))
    ends = ends.select(*keys, "_bucket", F.lag("_last").over(Window.partitionBy(*keys).orderBy("_bucket")).alias("_carried"))
    inside = Window.partitionBy(*keys, "_bucket").orderBy(order)
    rows = rows.withColumn("_place", F.row_number().over(inside)).withColumn("_near", F.lag(value).over(inside))
    picked = F.when(F.col("_place") == 1, F.col("_carried")).otherwise(F.col("_near"))
    return rows.join(ends, [*keys, "_bucket"]).withColumn(name, picked).drop("_bucket", "_place", "_near", "_carried")


def _in_bins(rows: DataFrame, group: list[str]) -> DataFrame:
    """Add the histogram bin of every value between the least and greatest value of its group."""
    ends = rows.groupBy(*group).agg(F.min("_v").alias("_lo"), F.max("_v").alias("_hi"))
    share = F.try_divide(F.col("_v") - F.col("_lo"), F.col("_hi") - F.col("_lo"))
    bin_no = F.coalesce(F.least(F.floor(share * HISTOGRAM_BINS), F.lit(HISTOGRAM_BINS - 1)), F.lit(0))
    return rows.join(ends, group).withColumn("_bin", bin_no).drop("_lo", "_hi")


def _with_start(sizes: DataFrame, group: list[str]) -> DataFrame:
    earlier = Window.partitionBy(*group).orderBy("_bin").rowsBetween(Window.unboundedPreceding, -1)
    return sizes.withColumn("_start", F.coalesce(F.sum("_size").over(earlier), F.lit(0)))


def values_at_ranks(df: DataFrame, keys: list[str], value: str, ranks: dict[str, Column]) -> DataFrame:
    """(keys, n, <name>...): the value at each 0-based rank of the sorted values of a key.

    ``ranks`` gives a rank as an expression of ``n``. Equal values are counted once first. A
    histogram per key finds the bin that holds a rank, a second histogram inside that bin
    narrows it again, which copes with far outliers, and only what is left is sorted.
    """
    counts = df.filter(F.col(value).isNotNull()).groupBy(*keys, F.col(value).alias("_v")).agg(F.count("*").alias("_c"))
    binned = _in_bins(counts, keys)
    sizes = _with_start(binned.groupBy(*keys, "_bin").agg(F.sum("_c").alias("_size")), keys)
    sizes = sizes.withColumn("n", F.sum("_size").over(Window.partitionBy(*keys)))
    wanted = F.explode(F.create_map(*[part for name, rank in ranks.items() for part in (F.lit(name), rank.cast("long"))])).alias("_name", "_rank")
    holds = "_start <= _rank AND _rank < _start + _size"
    first = sizes.select(*keys, "_bin", "_size", "_start", "n", wanted).filter(holds)
    group = [*keys, "_name"]
    live = binned.join(first, [*keys, "_bin"]).select(*group, "n", "_v", "_c", (F.col("_rank") - F.col("_start")).alias("_rank"))
    again = _in_bins(live, group)
    inner = _with_start(again.groupBy(*group, "_bin", "_rank").agg(F.sum("_c").alias("_size")), group).filter(holds)
    left = again.drop("_rank").join(inner.select(*group, "_bin", (F.col("_rank") - F.col("_start")).alias("_rank")), [*group, "_bin"])
    upto = Window.partitionBy(*group).orderBy("_v").rowsBetween(Window.unboundedPreceding, 0)
    found = left.withColumn("_end", F.sum("_c").over(upto)).filter("_rank < _end AND _rank >= _end - _c")
    return found.groupBy(*keys, "n").agg(*[F.max(F.when(F.col("_name") == name, F.col("_v"))).alias(name) for name in ranks])


def quantiles(df: DataFrame, keys: list[str], value: str, fractions: dict[str, float]) -> DataFrame:
    """(keys, n, <name>...): exact quantiles with linear interpolation between neighbours."""
    n = F.col("n")
    ranks = {}
    for name, q in fractions.items():
        ranks[f"{name}_lo"] = F.floor((n - 1) * F.lit(float(q)))
        ranks[f"{name}_hi"] = F.ceil((n - 1) * F.lit(float(q)))
    ends = values_at_ranks(df, keys, value, ranks)
    out = []
    for name, q in fractions.items():
        place = (n - 1) * F.lit(float(q))
        low, high = F.col(f"{name}_lo"), F.col(f"{name}_hi")
        out.append((low + (high - low) * (place - F.floor(place))).alias(name))
    return ends.select(*keys, "n", *out)

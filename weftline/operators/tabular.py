"""Small table operators used by the worked pipelines."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from weftline.functions.ordered import top_rows


def clean_orders(raw: DataFrame, key: str, order: list[Column]) -> DataFrame:
    """Rows with a key, the first one per key."""
    return top_rows(raw.dropna(subset=[key]), [key], order, 1).drop("rank")


def first_events(events: DataFrame, keys: list[str], order: list[Column]) -> DataFrame:
    """Duplicate run events removed; the earliest of each key stays."""
    return top_rows(events, keys, order, 1).drop("rank")


def trailing_days(daily: DataFrame, keys: list[str], day: str, value: str, days: int) -> DataFrame:
    """Add the mean of ``value`` over the ``days`` days before each day, over rows already summed per day."""
    number = F.datediff(F.col(day), F.lit("1970-01-01").cast("date"))
    before = Window.partitionBy(*keys).orderBy(number).rangeBetween(-days, -1)
    return daily.withColumn("trailing_mean", F.avg(value).over(before)).withColumn(
        "deviation", F.try_divide(F.col(value) - F.col("trailing_mean"), F.col("trailing_mean")))


def customer_windows(orders: DataFrame, customer: str, at: str, amount: str, as_of: Column) -> DataFrame:
    """Per customer and day: mean amount over 30 days, orders over 90 days, days since the
    visit before, and months of tenure at ``as_of``.

    Orders are summed per customer and day first, so a window never holds more than one row
    per day of history.
    """
    daily = orders.groupBy(F.col(customer).alias("customer"), F.to_date(at).alias("day")).agg(F.sum(amount).alias("total"), F.count(amount).alias("n"))
    daily = daily.withColumn("day_no", F.datediff("day", F.lit("1970-01-01").cast("date")))
    ordered = Window.partitionBy("customer").orderBy("day_no")
    month, quarter = ordered.rangeBetween(-30, 0), ordered.rangeBetween(-90, 0)
    return daily.select(
        "customer", "day", (F.round(F.sum("total").over(month), 2) / F.sum("n").over(month)).alias("avg_amount_30d"),
        F.sum("n").over(quarter).alias("orders_90d"), F.datediff("day", F.lag("day").over(ordered)).alias("days_since_last"),
        F.round(F.months_between(as_of, F.min("day").over(Window.partitionBy("customer"))), 6).alias("tenure_months"))

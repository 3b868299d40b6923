"""Table profiles, check suites and measured service levels."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import NumericType

from weftline.functions.ordered import quantiles, values_at_ranks


def quality_suite(df: DataFrame, name: str) -> DataFrame:
    """One row per check: completeness per column, uniqueness of id columns, volume.

    Every row repeats the number of failed checks and the overall result.
    """
    columns = df.columns
    ids = [c for c in columns if c == "id" or c.endswith("_id")]
    one = df.agg(
        F.count("*").alias("_n"), *[F.count_if(F.col(c).isNull()).alias(f"_null_{c}") for c in columns],
        *[F.countDistinct(c).alias(f"_distinct_{c}") for c in ids])
    n = F.col("_n")

    def check(kind, column, observed, measure, passed):
        return F.struct(F.lit(kind).alias("check"), F.lit(column).alias("column_name"), observed.cast("long").alias("observed"),
                        measure.alias("rate"), passed.alias("passed"))

    checks = []
    for c in columns:
        rate = F.coalesce(F.try_divide(F.col(f"_null_{c}"), n), F.lit(0.0))
        checks.append(check("completeness", c, F.col(f"_null_{c}"), F.round(rate, 4), rate < 0.05))
    for c in ids:
        extra = n - F.col(f"_distinct_{c}")
        checks.append(check("uniqueness", c, extra, F.lit(0.0), extra == 0))
    checks.append(check("volume", "", n, F.lit(0.0), n.between(100, 10_000_000)))
    rows = one.select(F.array(*checks).alias("checks"))
    failed = F.size(F.filter("checks", lambda c: ~c["passed"]))
    return rows.select(F.lit(name).alias("dataset"), failed.alias("failed_checks"), (failed == 0).alias("all_passed"), F.inline("checks"))


def expectation_suite(df: DataFrame, rules: list[tuple]) -> DataFrame:
    """(rule, observed, success) from one pass over the table.

    Rules: ('not_null', col), ('unique', col), ('between', col, lo, hi), ('row_count', lo, hi), ('max_between', col, lo, hi).
    """
    measures, results = {"_n": F.count("*")}, []
    for rule in rules:
        kind, args = rule[0], rule[1:]
        if kind == "not_null":
            key = f"nn_{args[0]}"
            measures[key] = F.count_if(F.col(args[0]).isNull())
            results.append((f"not_null:{args[0]}", F.col(key), F.col(key) == 0))
        elif kind == "unique":
            key = f"un_{args[0]}"
            measures[key] = F.count(args[0]) - F.countDistinct(args[0])
            results.append((f"unique:{args[0]}", F.col(key), F.col(key) == 0))
        elif kind == "between":
            key = f"bt_{args[0]}"
            measures[key] = F.count_if(~F.col(args[0]).between(args[1], args[2]))
            results.append((f"between:{args[0]}", F.col(key), F.col(key) == 0))
        elif kind == "row_count":
            results.append(("row_count", F.col("_n"), F.col("_n").between(args[0], args[1])))
        elif kind == "max_between":
            key = f"mx_{args[0]}"
            measures[key] = F.max(args[0])
            results.append((f"max_between:{args[0]}", F.coalesce(F.col(key).between(args[1], args[2]), F.lit(False)).cast("long"), F.col(key).between(args[1], args[2])))
        else:
            raise ValueError(f"unknown rule {kind}")
    one = df.agg(*[m.alias(k) for k, m in measures.items()])
    rows = [F.struct(F.lit(label).alias("rule"), seen.cast("long").alias("observed"), F.coalesce(ok, F.lit(False)).alias("success")) for label, seen, ok in results]
    return one.select(F.inline(F.array(*rows)))


def column_metrics(df: DataFrame) -> DataFrame:
    """Null and distinct counts, range and quartiles of every numeric column."""
    numeric = [f.name for f in df.schema.fields if isinstance(f.dataType, NumericType)]
    pairs = ", ".join(f"'{c}', CAST(`{c}` AS DOUBLE)" for c in numeric)
    long = df.selectExpr(f"stack({len(numeric)}, {pairs}) AS (column_name, v)")
    basics = long.groupBy("column_name").agg(
        F.count_if(F.col("v").isNull()).alias("null_count"), F.countDistinct("v").alias("distinct_count"), F.min("v").alias("min_value"), F.max("v").alias("max_value"))
    quarters = quantiles(long, ["column_name"], "v", {"q25": 0.25, "q50": 0.5, "q75": 0.75}).drop("n")
    return basics.join(quarters, "column_name", "left")


def hop_row_counts(hops: DataFrame, counts: DataFrame) -> DataFrame:
    """Output to input row ratio of every (input, output) hop; a loss of more than half is an alert."""
    left = counts.select(F.col("dataset").alias("input"), F.col("n_rows").alias("rows_in"))
    right = counts.select(F.col("dataset").alias("output"), F.col("n_rows").alias("rows_out"))
    return hops.select("input", "output").distinct().join(left, "input").join(right, "output").withColumn(
        "ratio", F.round(F.try_divide("rows_out", "rows_in"), 6)).withColumn("alert", F.coalesce(F.col("ratio") < 0.5, F.lit(True)))


def service_levels(history: DataFrame, completion_target: float = 0.99, latency_target: float = 300.0) -> DataFrame:
    """Completion rate and p99 latency per (pipeline, stage) from (metric, metric_value) rows.

    ``met`` compares both as "at least the target"; ``met_directional`` turns latency round.
    """
    done = history.filter("metric = 'completed'").groupBy("pipeline", "stage").agg(F.avg("metric_value").alias("actual"))
    slow = values_at_ranks(history.filter("metric = 'duration_sec'"), ["pipeline", "stage"], "metric_value",
                           {"actual": F.floor(F.col("n") * F.lit(0.99))}).select("pipeline", "stage", "actual")
    rates = done.select("pipeline", "stage", F.lit("completion_rate").alias("sli"), F.lit(completion_target).alias("target"), "actual", (F.col("actual") >= completion_target).alias("met_directional"))
    tails = slow.select("pipeline", "stage", F.lit("p99_latency").alias("sli"), F.lit(latency_target).alias("target"), "actual", (F.col("actual") <= latency_target).alias("met_directional"))
    return rates.unionByName(tails).withColumn("met", F.col("actual") >= F.col("target"))

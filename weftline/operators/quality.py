"""Health, anomalies, freshness, trust and propagation of quality along lineage."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from weftline.functions.ordered import running_moments, top_rows
from weftline.operators.components import require_acyclic
from weftline.operators.traversal import HOPS_PER_ROUND, reach, roots_of, stored_flow
from weftline.session import cut_lineage


def dataset_health(checks: DataFrame, datasets: DataFrame) -> DataFrame:
    """(dataset, health) from the five latest checks; datasets without checks are UNKNOWN."""
    recent = top_rows(checks, ["dataset"], [F.desc("checked_at"), F.desc("event_id")], 5)
    judged = recent.groupBy("dataset").agg(
        F.bool_and("passed").alias("all_ok"), F.bool_or((F.col("rank") <= 2) & ~F.col("passed")).alias("late_failure"))
    label = F.when(F.col("all_ok").isNull(), "UNKNOWN").when(F.col("all_ok"), "HEALTHY").when(F.col("late_failure"), "DEGRADED").otherwise("WARNING")
    return datasets.select("dataset").join(judged, "dataset", "left").select("dataset", label.alias("health"))


def z_scores(df: DataFrame, keys: list[str], value: str, order: list[str], bucket: Column, threshold: float = 3.0,
             min_history: int = 5, zero_spread_is_anomaly: bool = False) -> DataFrame:
    """Add z and is_anomaly against the earlier rows of the same key.

    Without spread in the history nothing is an anomaly, or any other value is if
    ``zero_spread_is_anomaly``.
    """
    scored = running_moments(df, keys, value, order, bucket)
    away = F.abs(F.col(value) - F.col("prior_mean"))
    z = F.when(F.col("prior_stdev") > 0, away / F.col("prior_stdev"))
    # A mean of equal values may be off by rounding, which is no difference.
    flat = (away > F.abs("prior_mean") * 1e-9) if zero_spread_is_anomaly else F.lit(False)
    flag = F.when(F.col("prior_n") < min_history, False).when(F.col("prior_stdev") > 0, away / F.col("prior_stdev") > threshold).otherwise(flat)
    return scored.withColumn("z", z).withColumn("is_anomaly", flag)


def overall_health(fresh: Column, volume_ok: Column, schema_changed: Column) -> Column:
    """healthy, or the joined list of problems; unknown freshness counts as stale."""
    problems = F.concat_ws(
        ", ", F.when(~F.coalesce(fresh, F.lit(False)), F.lit("stale")), F.when(~volume_ok, F.lit("volume_anomaly")), F.when(schema_changed, F.lit("schema_changed")))
    return F.when(problems == "", "healthy").otherwise(F.concat(F.lit("unhealthy: "), problems))


def age_hours(as_of: Column, at: Column) -> Column:
    return F.timestamp_diff("MICROSECOND", at, as_of) / F.lit(3600e6)


def sla_violations(metrics: DataFrame, slas: DataFrame) -> DataFrame:
    """(dataset, message): stale, too few rows, or a column with too many nulls.

    ``metrics`` has dataset, freshness_hours, row_count and null_rates (map); ``slas`` has
    dataset, freshness_max_hours, min_row_count and max_null_rate. No SLA, no rows.
    """
    both = metrics.join(slas, "dataset")
    stale = F.when(F.col("freshness_hours") > F.col("freshness_max_hours"), F.format_string("Freshness SLA violated: %.1fh > %.1fh", "freshness_hours", "freshness_max_hours"))
    small = F.when(F.col("row_count") < F.col("min_row_count"), F.format_string("Row count below minimum: %d < %d", "row_count", "min_row_count"))
    nulls = F.transform(
        F.filter(F.map_entries("null_rates"), lambda e: e["value"] > F.col("max_null_rate")),
        lambda e: F.format_string(
            "Null rate for '%s': %.2f%% > %.2f%%", e["key"], F.bround(e["value"] * 100, 2), F.bround(F.col("max_null_rate") * 100, 2)))
    return both.select("dataset", F.explode(F.filter(F.concat(F.array(stale, small), nulls), lambda m: m.isNotNull())).alias("message"))


def sla_met(metric: Column, value: Column, threshold: Column) -> Column:
    return (F.when(metric == "freshness", value <= threshold).when(metric == "volume", F.abs(value) <= threshold)
            .when(metric == "quality", value >= threshold).otherwise(F.lit(True)))


def failure_reach(edges: DataFrame, nodes: DataFrame, failed: DataFrame, datasets_only: bool = True) -> DataFrame:
    """(root, node) below each failed node; jobs are left out unless asked for."""
    reached = reach(edges, roots_of(failed))
    kept = nodes.filter("type = 'dataset'") if datasets_only else nodes
    return reached.join(kept.select(F.col("id").alias("node")), "node", "left_semi").select("root", "node", "depth")


def propagate_status(edges: DataFrame, status: DataFrame) -> DataFrame:
    """(id, status, propagated): everything below a FAIL turns DEGRADED unless it failed itself."""
    failed = status.filter("status = 'FAIL'").select(F.lit("failed").alias("root"), F.col("id").alias("node"))
    below = reach(edges, failed).select(F.col("node").alias("id"), F.lit(True).alias("hit"))
    turned = F.when((F.col("status") != "FAIL") & F.col("hit"), "DEGRADED").otherwise(F.col("status"))
    return status.join(below, "id", "left").select("id", "status", turned.alias("propagated"))


def trust_scores(edges: DataFrame, reports: DataFrame, hops_per_round: int = HOPS_PER_ROUND) -> DataFrame:
    """(id, trust): 0.6 own result + 0.4 mean result of upstream nodes weighted 1/(depth+1).

    Every path counts, so a node met on two paths weighs twice. The sum over all paths of one length into a node is the
    sum of its parents' sums over paths one shorter, so a round carries two numbers for each node and no ancestors.
    ``reports`` is (id, passed). Nodes of the graph without a report score 0.5; a cycle raises before the first step.
    """
    pairs = stored_flow(edges, "upstream")
    judged = cut_lineage(reports.select("id", F.when(F.col("passed"), 1.0).otherwise(0.0).alias("own")))
    require_acyclic(pairs)
    walk = judged.select(F.col("id").alias("node"), F.col("own").alias("good"), F.lit(1.0).alias("paths"))
    sums, depth = None, 0
    while True:
        found = None
        for _ in range(hops_per_round):
            depth += 1
            walk = walk.join(pairs, walk["node"] == pairs["dst"]).groupBy(F.col("src").alias("node")).agg(F.sum("good").alias("good"), F.sum("paths").alias("paths"))
            at = walk.withColumn("depth", F.lit(depth))
            found = at if found is None else found.unionByName(at)
        found = cut_lineage(found)
        weighted = found.select(F.col("node").alias("id"), (F.col("good") / (F.col("depth") + 1)).alias("good"), (F.col("paths") / (F.col("depth") + 1)).alias("weight"))
        part = weighted.groupBy("id").agg(F.sum("good").alias("good"), F.sum("weight").alias("weight"))
        sums = part if sums is None else sums.unionByName(part)
        walk = found.filter(F.col("depth") == depth).drop("depth")
        if walk.isEmpty():
            break
    totals = sums.groupBy("id").agg(F.sum("good").alias("good"), F.sum("weight").alias("weight"))
    ids = edges.selectExpr("explode(array(src, dst)) AS id").distinct().join(judged, "id", "full").join(totals, "id", "left")
    blended = 0.6 * F.col("own") + 0.4 * F.col("good") / F.col("weight")
    return ids.select("id", F.when(F.col("own").isNull(), 0.5).when(F.col("weight").isNull(), F.col("own")).otherwise(blended).alias("trust"))


def investigate(edges: DataFrame, nodes: DataFrame, health: DataFrame, anomalies: DataFrame) -> DataFrame:
    """Per anomalous dataset: unhealthy upstream datasets (suspects) and datasets below it."""
    roots = cut_lineage(roots_of(anomalies))
    sick = health.filter("health NOT IN ('HEALTHY', 'UNKNOWN')").select(F.col("dataset").alias("node"))
    suspects = reach(edges, roots, "upstream").join(sick, "node", "left_semi").groupBy("root").agg(
        F.count("*").alias("n_suspects"), F.min(F.struct("depth", "node"))["node"].alias("nearest_suspect"))
    tables = nodes.filter("type = 'dataset'").select(F.col("id").alias("node"))
    below = reach(edges, roots).join(tables, "node", "left_semi").groupBy("root").agg(F.count("*").alias("n_downstream"))
    return roots.join(suspects, "root", "left").join(below, "root", "left").fillna({"n_suspects": 0, "nearest_suspect": "", "n_downstream": 0})


def storage_tier(as_of: Column, day: Column) -> Column:
    age = F.datediff(as_of, day)
    return F.when(age <= 7, "hot").when(age <= 90, "warm").when(age <= 2555, "cold").otherwise("expired")


def archive_moves(days: DataFrame, as_of: Column) -> DataFrame:
    """(day, move) for partitions that reach the end of a tier on the day ``as_of``."""
    age = F.datediff(as_of, F.col("day"))
    return days.select("day", F.when(age == 7, "hot->warm").when(age == 90, "warm->cold").alias("move")).filter("move IS NOT NULL")

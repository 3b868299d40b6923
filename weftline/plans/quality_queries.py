"""Registered profiling, quality, observability and service-level queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from weftline.functions.ordered import positions, previous_value, top_rows
from weftline.operators import profiling, quality
from weftline.plans.registry import query
from weftline.session import cut_lineage

def by_hour():
    """Buckets of a metric's history: a few thousand rows even where one pipeline has most of a day's."""
    return F.date_trunc("hour", "recorded_at")


_SUITE_COLUMNS = ["event_id", "ts", "user_id", "event_type", "value", "props"]
_SUITE = " UNION ALL ".join(
    [f"""SELECT 'completeness' AS "check", '{c}' AS column_name, count(*) FILTER ({c} IS NULL) AS observed, round(count(*) FILTER ({c} IS NULL) / count(*), 4) AS rate, count(*) FILTER ({c} IS NULL) / count(*) < 0.05 AS passed FROM events""" for c in _SUITE_COLUMNS]
    + [f"""SELECT 'uniqueness', '{c}', count(*) - count(DISTINCT {c}), 0.0, count(*) = count(DISTINCT {c}) FROM events""" for c in ("event_id", "user_id")]
    + ["SELECT 'volume', '', count(*), 0.0, count(*) BETWEEN 100 AND 10000000 FROM events"])


@query("a09_quality_check_suite", 'SELECT \'events\' AS dataset, "check", column_name, observed, rate::DOUBLE AS rate, passed, (SELECT CAST(count(*) AS INTEGER) FROM suite WHERE NOT passed) AS failed_checks, (SELECT bool_and(passed) FROM suite) AS all_passed FROM suite', suite=_SUITE)
def a09(t):
    return profiling.quality_suite(t.read("events"), "events")


@query("a10_expectation_suite", """SELECT 'not_null:o_orderkey' AS rule, count(*) FILTER (o_orderkey IS NULL) AS observed, count(*) FILTER (o_orderkey IS NULL) = 0 AS success FROM orders
    UNION ALL SELECT 'unique:o_orderkey', count(o_orderkey) - count(DISTINCT o_orderkey), count(o_orderkey) = count(DISTINCT o_orderkey) FROM orders
    UNION ALL SELECT 'between:o_totalprice', count(*) FILTER (o_totalprice NOT BETWEEN 0 AND 400000), count(*) FILTER (o_totalprice NOT BETWEEN 0 AND 400000) = 0 FROM orders
    UNION ALL SELECT 'row_count', count(*), count(*) BETWEEN 1000 AND 10000000 FROM orders
    UNION ALL SELECT 'max_between:o_totalprice', CASE WHEN max(o_totalprice) BETWEEN 0 AND 1000000 THEN 1 ELSE 0 END, max(o_totalprice) BETWEEN 0 AND 1000000 FROM orders""")
def a10(t):
    return profiling.expectation_suite(t.read("orders"), [
        ("not_null", "o_orderkey"), ("unique", "o_orderkey"), ("between", "o_totalprice", 0, 400000), ("row_count", 1000, 10_000_000), ("max_between", "o_totalprice", 0, 1_000_000)])


@query("a11_column_metrics", " UNION ALL ".join(
    f"""SELECT '{c}' AS column_name, count(*) FILTER ({c} IS NULL) AS null_count, count(DISTINCT {c}) AS distinct_count, min({c})::DOUBLE AS min_value, max({c})::DOUBLE AS max_value,
    round(quantile_cont({c}::DOUBLE, 0.25), 6) AS q25, round(quantile_cont({c}::DOUBLE, 0.5), 6) AS q50, round(quantile_cont({c}::DOUBLE, 0.75), 6) AS q75 FROM lineitem"""
    for c in ("l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_quantity", "l_extendedprice", "l_discount", "l_tax")))
def a11(t):
    out = profiling.column_metrics(t.read("lineitem"))
    return out.select("column_name", "null_count", "distinct_count", "min_value", "max_value", *[F.round(q, 6).alias(q) for q in ("q25", "q50", "q75")])


@query("a12_distribution", """SELECT state AS grp, round(count(*) FILTER (k % 7 = 0) / count(*), 6) AS null_rate, min(value) AS min_value, max(value) AS max_value FROM ol GROUP BY state""")
def a12(t):
    nulled = t.runs().withColumn("v", F.expr("if(k % 7 = 0, NULL, value)"))
    return nulled.groupBy(F.col("state").alias("grp")).agg(
        F.round(F.count_if(F.col("v").isNull()) / F.count("*"), 6).alias("null_rate"), F.min("value").alias("min_value"), F.max("value").alias("max_value"))


@query("a15_service_levels", """SELECT pipeline, stage, 'completion_rate' AS sli, 0.99::DOUBLE AS target, round(avg(metric_value), 9) AS actual, avg(metric_value) >= 0.99 AS met_directional, avg(metric_value) >= 0.99 AS met FROM metric_history WHERE metric = 'completed' GROUP BY ALL
    UNION ALL SELECT pipeline, stage, 'p99_latency', 300.0, v, v <= 300, v >= 300 FROM (SELECT pipeline, stage, list_sort(list(metric_value))[CAST(floor(count(*) * CAST(0.99 AS DOUBLE)) AS BIGINT) + 1] AS v FROM metric_history WHERE metric = 'duration_sec' GROUP BY ALL)""")
def a15(t):
    return profiling.service_levels(t.metric_history()).withColumn("actual", F.round("actual", 9))


@query("w01_dataset_health", """SELECT id AS dataset, CASE WHEN n IS NULL THEN 'UNKNOWN' WHEN ok THEN 'HEALTHY' WHEN late THEN 'DEGRADED' ELSE 'WARNING' END AS health FROM nodes LEFT JOIN (
    SELECT dataset AS id, count(*) AS n, bool_and(passed) AS ok, bool_or(rn <= 2 AND NOT passed) AS late FROM (SELECT *, row_number() OVER (PARTITION BY dataset ORDER BY checked_at DESC, event_id DESC) AS rn FROM quality_checks) WHERE rn <= 5 GROUP BY 1) USING (id) WHERE type = 'dataset'""")
def w01(t):
    return quality.dataset_health(t.quality_checks(), t.nodes().filter("type = 'dataset'").select(F.col("id").alias("dataset")))


_Z = """SELECT event_id, pipeline, metric, metric_value, prior_n, CASE WHEN prior_n < 5 THEN false WHEN sd > 0 THEN abs(metric_value - mean) / sd > {z} ELSE {flat} END AS is_anomaly, round(CASE WHEN sd > 0 THEN abs(metric_value - mean) / sd ELSE -1 END, 5) AS z FROM (
    SELECT *, count(*) OVER w AS prior_n, avg(metric_value) OVER w AS mean, stddev_samp(metric_value) OVER w AS sd FROM metric_history WINDOW w AS (PARTITION BY pipeline, metric ORDER BY recorded_at, event_id ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING))"""


@query("w02_z_score_anomaly", _Z.format(z=3.0, flat="false"))
def w02(t):
    scored = quality.z_scores(t.metric_history(), ["pipeline", "metric"], "metric_value", ["recorded_at", "event_id"], by_hour())
    return scored.select("event_id", "pipeline", "metric", "metric_value", "prior_n", F.coalesce("is_anomaly", F.lit(False)).alias("is_anomaly"), F.round(F.coalesce("z", F.lit(-1.0)), 5).alias("z"))


@query("w02_z_score_flat_history", "SELECT event_id, pipeline, metric, is_anomaly FROM (" + _Z.format(z=2.5, flat="metric_value <> mean") + ")")
def w02_flat(t):
    scored = quality.z_scores(t.metric_history(), ["pipeline", "metric"], "metric_value", ["recorded_at", "event_id"], by_hour(), threshold=2.5, zero_spread_is_anomaly=True)
    return scored.select("event_id", "pipeline", "metric", F.coalesce("is_anomaly", F.lit(False)).alias("is_anomaly"))


@query("w03_anomaly_report", "SELECT pipeline, metric, metric_value, round(mean, 5) AS mean, round(sd, 5) AS stdev FROM (SELECT *, row_number() OVER (PARTITION BY pipeline, metric, strftime(recorded_at, '%Y-%m-%d') ORDER BY recorded_at DESC, event_id DESC) AS rn, "
       "count(*) OVER w AS prior_n, avg(metric_value) OVER w AS mean, stddev_samp(metric_value) OVER w AS sd FROM metric_history WINDOW w AS (PARTITION BY pipeline, metric ORDER BY recorded_at, event_id ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)) WHERE rn = 1 AND prior_n >= 5 AND sd > 0 AND abs(metric_value - mean) / sd > 1.5")
def w03(t):
    scored = quality.z_scores(t.metric_history(), ["pipeline", "metric"], "metric_value", ["recorded_at", "event_id"], by_hour(), threshold=1.5).withColumn("day", F.to_date("recorded_at"))
    latest = top_rows(scored, ["pipeline", "metric", "day"], [F.desc("recorded_at"), F.desc("event_id")], 1)
    return latest.filter("is_anomaly").select("pipeline", "metric", "metric_value", F.round("prior_mean", 5).alias("mean"), F.round("prior_stdev", 5).alias("stdev"))


@query("w04_metric_history", "SELECT pipeline, metric, event_id, metric_value, row_number() OVER (PARTITION BY pipeline, metric ORDER BY recorded_at, event_id) AS position FROM metric_history")
def w04(t):
    return positions(t.metric_history(), ["pipeline", "metric"], ["recorded_at", "event_id"], by_hour()).select("pipeline", "metric", "event_id", "metric_value", "position")


@query("w05_run_states", """SELECT run_id, arg_max(state, ts) AS state, coalesce(strftime(min(ts) FILTER (state = 'START'), '%Y-%m-%d %H:%M:%S'), '') AS started_at,
    coalesce(strftime(max(ts) FILTER (state IN ('COMPLETE', 'FAIL', 'ABORT')), '%Y-%m-%d %H:%M:%S'), '') AS ended_at,
    coalesce((epoch_us(max(ts) FILTER (state IN ('COMPLETE', 'FAIL', 'ABORT'))) - epoch_us(min(ts) FILTER (state = 'START'))) // 1000, -1) AS duration_ms FROM ol GROUP BY run_id""")
def w05(t):
    from weftline.sources.run_events import run_states

    states = run_states(t.runs())
    text = lambda c: F.coalesce(F.date_format(c, "yyyy-MM-dd HH:mm:ss"), F.lit("")).alias(c)
    return states.select("run_id", "state", text("started_at"), text("ended_at"), F.coalesce("duration_ms", F.lit(-1)).alias("duration_ms"))


@query("w05_latest_job_state", "SELECT job_name, arg_max(state, ts) AS latest_run_state, max(ts) AS latest_run_at FROM ol GROUP BY job_name")
def w05_job(t):
    return t.runs().groupBy("job_name").agg(F.max_by("state", F.struct("ts", "event_id")).alias("latest_run_state"), F.max("ts").alias("latest_run_at"))


@query("w10_metric_drift", """SELECT dataset, run_no, m, round(m - lag(m) OVER (PARTITION BY dataset ORDER BY run_no), 6) AS change FROM (SELECT out_a AS dataset, run_no, round(avg(value), 6) AS m FROM ol GROUP BY ALL) QUALIFY change IS NOT NULL""")
def w10(t):
    versions = t.runs().groupBy(F.col("out_a").alias("dataset"), "run_no").agg(F.round(F.avg("value"), 6).alias("m"))
    drift = previous_value(versions, ["dataset"], "m", "run_no", F.expr("run_no div 500"), "before")
    return drift.withColumn("change", F.round(F.col("m") - F.col("before"), 6)).filter("change IS NOT NULL").drop("before")


@query("w11_top_n_slowest_stages", "SELECT stage, round(sum(metric_value), 2) AS total FROM metric_history WHERE metric = 'duration_sec' GROUP BY stage ORDER BY total DESC, stage LIMIT 10")
def w11(t):
    slow = t.metric_history().filter("metric = 'duration_sec'").groupBy("stage").agg(F.round(F.sum("metric_value"), 2).alias("total"))
    return slow.orderBy(F.desc("total"), "stage").limit(10)


_FAILED = "SELECT dataset AS id FROM quality_checks GROUP BY 1 HAVING count(*) FILTER (NOT passed) * 4 >= count(*)"


def failing_datasets(t):
    return t.quality_checks().groupBy(F.col("dataset").alias("id")).agg(F.count_if(~F.col("passed")).alias("bad"), F.count("*").alias("n")).filter("bad * 4 >= n").select("id")


@query("q01_failure_propagation", "SELECT ancestor AS root, descendant AS node, depth FROM closure WHERE ancestor IN (SELECT id FROM failed_sets) AND descendant LIKE 'ds_%'", failed_sets=_FAILED)
def q01(t):
    edges, nodes = t.graph
    return quality.failure_reach(edges, nodes, cut_lineage(failing_datasets(t)))


@query("q01_failure_propagation_all_nodes", "SELECT ancestor AS root, descendant AS node, depth FROM closure WHERE ancestor IN (SELECT id FROM failed_sets)", failed_sets=_FAILED)
def q01_all(t):
    edges, nodes = t.graph
    return quality.failure_reach(edges, nodes, cut_lineage(failing_datasets(t)), datasets_only=False)


@query("q02_status_propagation", """SELECT id, status, CASE WHEN status <> 'FAIL' AND id IN (SELECT descendant FROM closure WHERE ancestor IN (SELECT id FROM failed_sets)) THEN 'DEGRADED' ELSE status END AS propagated FROM (
    SELECT n.id, CASE WHEN f.id IS NOT NULL THEN 'FAIL' WHEN c.id IS NOT NULL THEN 'PASS' ELSE 'UNKNOWN' END AS status FROM nodes n LEFT JOIN failed_sets f USING (id) LEFT JOIN (SELECT DISTINCT dataset AS id FROM quality_checks) c USING (id))""", failed_sets=_FAILED)
def q02(t):
    edges, nodes = t.graph
    failed = failing_datasets(t).withColumn("failed", F.lit(True))
    known = t.quality_checks().select(F.col("dataset").alias("id"), F.lit(True).alias("known")).distinct()
    status = F.when(F.col("failed"), "FAIL").when(F.col("known"), "PASS").otherwise("UNKNOWN")
    return quality.propagate_status(edges, cut_lineage(nodes.select("id").join(failed, "id", "left").join(known, "id", "left").select("id", status.alias("status"))))


_REPORTS = "SELECT dataset AS id, arg_max(passed, checked_at) AS passed FROM quality_checks GROUP BY dataset"
_TRUST_WALK = "SELECT dst AS id, src AS node, 1 AS depth FROM (SELECT DISTINCT src, dst FROM edges) UNION ALL SELECT w.id, e.src, w.depth + 1 FROM trust_walk w JOIN (SELECT DISTINCT src, dst FROM edges) e ON e.dst = w.node"
_TRUST = """SELECT n.id, round(CASE WHEN r.id IS NULL THEN 0.5::DOUBLE WHEN u.weight IS NULL THEN r.own ELSE 0.6::DOUBLE * r.own + 0.4::DOUBLE * u.good / u.weight END, 6) AS trust FROM nodes n
    LEFT JOIN (SELECT id, CASE WHEN passed THEN 1.0::DOUBLE ELSE 0.0::DOUBLE END AS own FROM reports) r USING (id)
    LEFT JOIN (SELECT w.id, sum(CASE WHEN p.passed THEN 1.0::DOUBLE / (w.depth + 1) ELSE 0 END) AS good, sum(1.0::DOUBLE / (w.depth + 1)) AS weight FROM trust_walk w JOIN reports p ON p.id = w.node GROUP BY w.id) u USING (id)"""


def latest_reports(t):
    return t.quality_checks().groupBy(F.col("dataset").alias("id")).agg(F.max_by("passed", F.struct("checked_at", "event_id")).alias("passed"))


@query("q03_trust_score", _TRUST, reports=_REPORTS, trust_walk=_TRUST_WALK)
def q03(t):
    return quality.trust_scores(t.graph[0], latest_reports(t)).select("id", F.round("trust", 6).alias("trust"))


@query("q04_overall_health", """SELECT out_a AS dataset, CASE WHEN p = '' THEN 'healthy' ELSE 'unhealthy: ' || p END AS health FROM (SELECT out_a, concat_ws(', ', CASE WHEN max(ts) < (SELECT max(ts) - INTERVAL 24 HOUR FROM events) THEN 'stale' END,
    CASE WHEN count(*) NOT BETWEEN 10 AND 60 THEN 'volume_anomaly' END, CASE WHEN count(DISTINCT k) > 20 THEN 'schema_changed' END) AS p FROM ol GROUP BY out_a)""")
def q04(t):
    end = t.read("events").agg(F.max("ts"))
    seen = t.runs().groupBy(F.col("out_a").alias("dataset")).agg(F.max("ts").alias("last"), F.count("*").alias("n"), F.countDistinct("k").alias("kinds"))
    fresh = F.timestamp_diff("SECOND", F.col("last"), end.scalar()) <= 24 * 3600
    return seen.select("dataset", quality.overall_health(fresh, F.col("n").between(10, 60), F.col("kinds") > 20).alias("health"))


@query("q05_freshness", "SELECT out_a AS dataset, round(date_diff('microsecond', max(ts), (SELECT max(ts) FROM events)) / 3600e6, 6) AS age_hours, date_diff('microsecond', max(ts), (SELECT max(ts) FROM events)) / 3600e6 <= 48 AS is_fresh FROM ol GROUP BY out_a")
def q05(t):
    end = t.read("events").agg(F.max("ts"))
    age = quality.age_hours(end.scalar(), F.col("last"))
    return t.runs().groupBy(F.col("out_a").alias("dataset")).agg(F.max("ts").alias("last")).select("dataset", F.round(age, 6).alias("age_hours"), (age <= 48).alias("is_fresh"))


@query("q06_sla_violations", """SELECT dataset, unnest(list_filter([CASE WHEN h > 24 THEN format('Freshness SLA violated: {:.1f}h > 24.0h', h) END, CASE WHEN n < 15 THEN 'Row count below minimum: ' || n || ' < 15' END,
    CASE WHEN 1.0 * bad / n > 0.2 THEN 'Null rate for ''value'': ' || format('{:.2f}', 100.0::DOUBLE * bad / n) || '% > 20.00%' END], lambda x: x IS NOT NULL)) AS message FROM (
    SELECT out_a AS dataset, floor(date_diff('microsecond', max(ts), (SELECT max(ts) FROM events)) / 3600e6) AS h, count(*) AS n, count(*) FILTER (state = 'FAIL') AS bad, max(layer) AS layer FROM ol GROUP BY out_a) WHERE layer < 3""")
def q06(t):
    end = t.read("events").agg(F.max("ts"))
    seen = t.runs().groupBy(F.col("out_a").alias("dataset"), "layer").agg(F.max("ts").alias("last"), F.count("*").alias("row_count"), F.count_if(F.col("state") == "FAIL").alias("bad"))
    metrics = seen.select("dataset", F.floor(quality.age_hours(end.scalar(), F.col("last"))).cast("double").alias("freshness_hours"), "row_count",
                          F.create_map(F.lit("value"), F.col("bad") / F.col("row_count")).alias("null_rates"))
    slas = seen.filter("layer < 3").select("dataset", F.lit(24.0).alias("freshness_max_hours"), F.lit(15).alias("min_row_count"), F.lit(0.2).alias("max_null_rate"))
    return quality.sla_violations(metrics, slas)


@query("q07_sla_by_kind", """SELECT event_id, metric, CASE metric WHEN 'freshness' THEN value <= 50 WHEN 'volume' THEN abs(value - 40) <= 50 WHEN 'quality' THEN value >= 50 ELSE true END AS met FROM (
    SELECT event_id, ['freshness', 'volume', 'quality', 'other'][event_id % 4 + 1] AS metric, value FROM events)""")
def q07(t):
    rows = t.read("events").selectExpr("event_id", "value", "element_at(array('freshness', 'volume', 'quality', 'other'), CAST(event_id % 4 AS INT) + 1) AS metric")
    observed = F.when(F.col("metric") == "volume", F.col("value") - 40).otherwise(F.col("value"))
    return rows.select("event_id", "metric", quality.sla_met(F.col("metric"), observed, F.lit(50.0)).alias("met"))


_HEALTH = """SELECT dataset, CASE WHEN bool_and(passed) THEN 'HEALTHY' WHEN bool_or(rn <= 2 AND NOT passed) THEN 'DEGRADED' ELSE 'WARNING' END AS health FROM (
    SELECT *, row_number() OVER (PARTITION BY dataset ORDER BY checked_at DESC, event_id DESC) AS rn FROM quality_checks) WHERE rn <= 5 GROUP BY 1"""


@query("q08_root_cause", """SELECT root, coalesce(n_suspects, 0) AS n_suspects, coalesce(nearest_suspect, '') AS nearest_suspect, coalesce(n_downstream, 0) AS n_downstream FROM (SELECT id AS root FROM failed_sets) LEFT JOIN (
    SELECT descendant AS root, count(*) AS n_suspects, arg_min(ancestor, (depth, ancestor)) AS nearest_suspect FROM closure JOIN healths ON dataset = ancestor WHERE health <> 'HEALTHY' GROUP BY 1) USING (root)
    LEFT JOIN (SELECT ancestor AS root, count(*) AS n_downstream FROM closure WHERE descendant LIKE 'ds_%' GROUP BY 1) USING (root)""", failed_sets=_FAILED, healths=_HEALTH)
def q08(t):
    edges, nodes = t.graph
    health = cut_lineage(quality.dataset_health(t.quality_checks(), nodes.filter("type = 'dataset'").select(F.col("id").alias("dataset"))))
    return quality.investigate(edges, nodes, health, failing_datasets(t))


@query("q09_quality_annotated_lineage", f"SELECT n.id, n.type, coalesce(health, CASE WHEN type = 'dataset' THEN 'UNKNOWN' ELSE '' END) AS health, trust, coalesce(bad, 0) AS failing_checks FROM nodes n JOIN ({_TRUST}) tr USING (id) LEFT JOIN healths h ON h.dataset = n.id "
       "LEFT JOIN (SELECT dataset AS id, count(*) FILTER (NOT passed) AS bad FROM quality_checks GROUP BY 1) b USING (id)", reports=_REPORTS, trust_walk=_TRUST_WALK, healths=_HEALTH)
def q09(t):
    edges, nodes = t.graph
    checks = t.quality_checks()
    trust = quality.trust_scores(edges, latest_reports(t)).select("id", F.round("trust", 6).alias("trust"))
    health = quality.dataset_health(checks, nodes.filter("type = 'dataset'").select(F.col("id").alias("dataset"))).withColumnRenamed("dataset", "id")
    failing = checks.groupBy(F.col("dataset").alias("id")).agg(F.count_if(~F.col("passed")).alias("failing_checks"))
    return nodes.select("id", "type").join(trust, "id").join(health, "id", "left").join(failing, "id", "left").fillna({"health": "", "failing_checks": 0})


@query("q10_assertions_facet", "SELECT out_ns || '/' || out_a AS dataset, count(*) AS n_assertions, round(avg(CASE WHEN event_type <> 'error' THEN 1.0 ELSE 0.0 END), 6) AS pass_rate FROM docs GROUP BY 1")
def q10(t):
    from weftline.plans.source_queries import parsed_events
    from weftline.sources.run_events import entity_id

    outputs = parsed_events(t).selectExpr("inline(outputs)").selectExpr(f"{entity_id('namespace', 'name')} AS dataset", "inline(facets.dataQualityAssertions.assertions)")
    return outputs.groupBy("dataset").agg(F.count("*").alias("n_assertions"), F.round(F.avg(F.col("success").cast("double")), 6).alias("pass_rate"))


@query("q20_storage_tier", """SELECT tier, count(*) AS n FROM (SELECT CASE WHEN a <= 7 THEN 'hot' WHEN a <= 90 THEN 'warm' WHEN a <= 2555 THEN 'cold' ELSE 'expired' END AS tier FROM (
    SELECT date_diff('day', CAST(o_orderdate AS DATE), DATE '2001-08-01') AS a FROM orders)) GROUP BY tier""")
def q20(t):
    return t.read("orders").groupBy(quality.storage_tier(F.lit("2001-08-01").cast("date"), F.to_date("o_orderdate")).alias("tier")).agg(F.count("*").alias("n"))


@query("q21_archive_plan", """SELECT strftime(day, '%Y-%m-%d') AS day, CASE WHEN a = 7 THEN 'hot->warm' ELSE 'warm->cold' END AS move FROM (SELECT DISTINCT CAST(o_orderdate AS DATE) AS day,
    date_diff('day', CAST(o_orderdate AS DATE), (SELECT max(CAST(o_orderdate AS DATE)) FROM orders)) AS a FROM orders) WHERE a IN (7, 90)""")
def q21(t):
    last = t.read("orders").agg(F.max(F.to_date("o_orderdate")))
    days = t.read("orders").select(F.to_date("o_orderdate").alias("day")).distinct()
    return quality.archive_moves(days, last.scalar()).withColumn("day", F.date_format("day", "yyyy-MM-dd"))

"""Registered joins, aggregates, windows and set operations of the worked table examples."""

from __future__ import annotations

from pyspark.sql import functions as F

from weftline.functions.ordered import top_rows
from weftline.operators import catalog, tabular, temporal
from weftline.plans.registry import query
from weftline.session import cut_lineage, scratch_path


def sales(t):
    return t.read("lineitem").join(t.read("orders"), F.col("l_orderkey") == F.col("o_orderkey")).join(t.read("customer"), F.col("o_custkey") == F.col("c_custkey"))


@query("j01_inner_join", "SELECT l_orderkey, l_partkey, c_name, p_name, l_quantity FROM lineitem JOIN orders ON l_orderkey = o_orderkey JOIN customer ON o_custkey = c_custkey JOIN part ON p_partkey = l_partkey")
def j01(t):
    return sales(t).join(t.read("part"), F.col("l_partkey") == F.col("p_partkey")).select("l_orderkey", "l_partkey", "c_name", "p_name", "l_quantity")


@query("j02_left_join_enrichment", "SELECT o_orderkey, o_totalprice, c_name, c_mktsegment FROM orders LEFT JOIN customer ON o_custkey = c_custkey AND c_acctbal > 0")
def j02(t):
    kept = t.read("customer").filter("c_acctbal > 0")
    return t.read("orders").join(kept, F.col("o_custkey") == F.col("c_custkey"), "left").select("o_orderkey", "o_totalprice", "c_name", "c_mktsegment")


@query("j03_semi_join", "SELECT c_custkey, c_name FROM customer WHERE c_custkey IN (SELECT o_custkey FROM orders GROUP BY o_custkey HAVING sum(o_totalprice) > 10000)")
def j03(t):
    big = t.read("orders").groupBy("o_custkey").agg(F.sum("o_totalprice").alias("total")).filter("total > 10000")
    return t.read("customer").join(big, F.col("c_custkey") == F.col("o_custkey"), "left_semi").select("c_custkey", "c_name")


@query("j04_anti_join", "SELECT p_partkey, p_name FROM part WHERE p_partkey NOT IN (SELECT l_partkey FROM lineitem WHERE l_quantity > 45)")
def j04(t):
    used = t.read("lineitem").filter("l_quantity > 45")
    return t.read("part").join(used, F.col("p_partkey") == F.col("l_partkey"), "left_anti").select("p_partkey", "p_name")


@query("j05_filtered_cte_join", """WITH active AS (SELECT c_custkey, c_name FROM customer WHERE c_acctbal > 0), recent AS (SELECT * FROM orders WHERE o_orderdate >= TIMESTAMP '1996-01-01')
    SELECT c_name, o_orderkey, o_totalprice FROM active JOIN recent ON c_custkey = o_custkey""")
def j05(t):
    active = t.read("customer").filter("c_acctbal > 0").select("c_custkey", "c_name")
    recent = t.read("orders").filter("o_orderdate >= TIMESTAMP_NTZ '1996-01-01'")
    return active.join(recent, F.col("c_custkey") == F.col("o_custkey")).select("c_name", "o_orderkey", "o_totalprice")


@query("j07_cross_dataset_consistency", "SELECT 'orders_without_items' AS rule, count(*) AS missing FROM orders WHERE o_orderkey NOT IN (SELECT l_orderkey FROM lineitem) UNION ALL SELECT 'customers_without_orders', count(*) FROM customer WHERE c_custkey NOT IN (SELECT o_custkey FROM orders)")
def j07(t):
    lone = t.read("orders").join(t.read("lineitem"), F.col("o_orderkey") == F.col("l_orderkey"), "left_anti").agg(F.count("*").alias("missing"))
    idle = t.read("customer").join(t.read("orders"), F.col("c_custkey") == F.col("o_custkey"), "left_anti").agg(F.count("*").alias("missing"))
    return lone.select(F.lit("orders_without_items").alias("rule"), "missing").unionByName(idle.select(F.lit("customers_without_orders").alias("rule"), "missing"))


@query("j08_validity_interval_join", """SELECT DISTINCT strftime(noon, '%Y-%m-%d') AS day, src, dst FROM (SELECT DISTINCT date_trunc('day', ts) + INTERVAL 12 HOUR AS noon FROM events) JOIN versioned_edges
    ON valid_from <= noon AND (valid_to IS NULL OR noon <= valid_to)""")
def j08(t):
    times = t.read("events").select((F.date_trunc("day", "ts") + F.expr("INTERVAL 12 HOUR")).alias("at")).distinct()
    return temporal.active_at_each(t.versioned_edges(), times).select(F.date_format("at", "yyyy-MM-dd").alias("day"), "src", "dst")


@query("j09_fan_in_fan_out", """SELECT 'by_segment' AS sink, c_mktsegment AS k, count(*) AS n FROM lineitem JOIN orders ON l_orderkey = o_orderkey JOIN customer ON o_custkey = c_custkey GROUP BY 2
    UNION ALL SELECT 'by_status', o_orderstatus, count(*) FROM lineitem JOIN orders ON l_orderkey = o_orderkey GROUP BY 2""")
def j09(t):
    # One stage table feeds two sinks, so the three-way join runs once.
    stage = cut_lineage(sales(t).select("c_mktsegment", "o_orderstatus"))
    paths = {name: scratch_path(t.spark, name) for name in ("by_segment", "by_status")}
    stage.groupBy(F.col("c_mktsegment").alias("k")).agg(F.count("*").alias("n")).write.parquet(paths["by_segment"])
    stage.groupBy(F.col("o_orderstatus").alias("k")).agg(F.count("*").alias("n")).write.parquet(paths["by_status"])
    both = [t.spark.read.parquet(p).select(F.lit(name).alias("sink"), "k", "n") for name, p in paths.items()]
    return both[0].unionByName(both[1])


@query("a01_order_summary", "SELECT o_custkey, count(*) AS n_orders, round(sum(o_totalprice), 2) AS total FROM orders GROUP BY o_custkey")
def a01(t):
    return t.read("orders").groupBy("o_custkey").agg(F.count("*").alias("n_orders"), F.round(F.sum("o_totalprice"), 2).alias("total"))


@query("a02_customer_metrics", """SELECT o_custkey, count(*) AS n_items, round(sum(l_extendedprice * (1 - l_discount)), 4) AS revenue, round(sum(l_extendedprice * (1 - l_discount)), 4) / count(*) AS avg_item,
    count(DISTINCT l_partkey) AS n_parts, max(o_orderdate) AS last_order FROM lineitem JOIN orders ON l_orderkey = o_orderkey WHERE o_orderstatus <> 'P' GROUP BY o_custkey""")
def a02(t):
    joined = t.read("lineitem").join(t.read("orders").filter("o_orderstatus <> 'P'"), F.col("l_orderkey") == F.col("o_orderkey")).withColumn("revenue", F.col("l_extendedprice") * (1 - F.col("l_discount")))
    return joined.groupBy("o_custkey").agg(
        F.count("*").alias("n_items"), F.round(F.sum("revenue"), 4).alias("revenue"), (F.round(F.sum("revenue"), 4) / F.count("*")).alias("avg_item"),
        F.countDistinct("l_partkey").alias("n_parts"), F.max("o_orderdate").alias("last_order"))


@query("a03_dim_customers", """SELECT c_custkey, lower(trim(c_name)) AS name, count(DISTINCT o_orderkey) AS n_orders, round(sum(o_totalprice), 2) AS total, max(o_orderdate) AS last_order
    FROM customer LEFT JOIN orders ON o_custkey = c_custkey WHERE c_name IS NOT NULL GROUP BY ALL""")
def a03(t):
    staged = t.read("customer").filter("c_name IS NOT NULL").select("c_custkey", F.lower(F.trim("c_name")).alias("name"))
    left = staged.join(t.read("orders"), F.col("c_custkey") == F.col("o_custkey"), "left")
    return left.groupBy("c_custkey", "name").agg(F.countDistinct("o_orderkey").alias("n_orders"), F.round(F.sum("o_totalprice"), 2).alias("total"), F.max("o_orderdate").alias("last_order"))


@query("a04_lifetime_value", """SELECT c_custkey, c_name || ' ' || c_mktsegment AS label, round(coalesce(sum(o_totalprice), 0), 2) AS lifetime_value, count(o_orderkey) AS n_orders
    FROM customer LEFT JOIN orders ON o_custkey = c_custkey AND o_orderstatus = 'F' GROUP BY ALL""")
def a04(t):
    done = t.read("orders").filter("o_orderstatus = 'F'")
    return t.read("customer").join(done, F.col("c_custkey") == F.col("o_custkey"), "left").groupBy("c_custkey", F.concat_ws(" ", "c_name", "c_mktsegment").alias("label")).agg(
        F.round(F.coalesce(F.sum("o_totalprice"), F.lit(0.0)), 2).alias("lifetime_value"), F.count("o_orderkey").alias("n_orders"))


@query("a05_customer_tier", "SELECT o_custkey, CASE WHEN sum(o_totalprice) > 1500000 THEN 'platinum' WHEN sum(o_totalprice) > 1000000 THEN 'gold' ELSE 'standard' END AS tier FROM orders GROUP BY o_custkey")
def a05(t):
    total = F.sum("o_totalprice")
    return t.read("orders").groupBy("o_custkey").agg(F.when(total > 1500000, "platinum").when(total > 1000000, "gold").otherwise("standard").alias("tier"))


@query("a06_monthly_revenue", "SELECT strftime(date_trunc('month', o_orderdate), '%Y-%m') AS month, round(sum(o_totalprice), 2) AS revenue, count(DISTINCT o_custkey) AS customers FROM orders GROUP BY 1")
def a06(t):
    return t.read("orders").groupBy(F.date_format(F.date_trunc("month", "o_orderdate"), "yyyy-MM").alias("month")).agg(F.round(F.sum("o_totalprice"), 2).alias("revenue"), F.countDistinct("o_custkey").alias("customers"))


@query("a07_daily_revenue", "SELECT strftime(o_orderdate, '%Y-%m-%d') AS day, round(sum(o_totalprice), 2) AS revenue FROM orders WHERE o_orderstatus <> 'P' GROUP BY 1")
def a07(t):
    return t.read("orders").filter("o_orderstatus <> 'P'").groupBy(F.date_format("o_orderdate", "yyyy-MM-dd").alias("day")).agg(F.round(F.sum("o_totalprice"), 2).alias("revenue"))


@query("a08_having_filter", "SELECT p_type, round(sum(l_extendedprice), 2) AS total FROM lineitem JOIN part ON l_partkey = p_partkey GROUP BY p_type HAVING sum(l_quantity) > 100")
def a08(t):
    return t.read("lineitem").join(t.read("part"), F.col("l_partkey") == F.col("p_partkey")).groupBy("p_type").agg(
        F.round(F.sum("l_extendedprice"), 2).alias("total"), F.sum("l_quantity").alias("quantity")).filter("quantity > 100").drop("quantity")


@query("a13_hop_row_counts", """SELECT DISTINCT t.input, t.output, i.n AS rows_in, o.n AS rows_out, round(o.n / i.n, 6) AS ratio, o.n / i.n < 0.5 AS alert FROM triples t
    JOIN (SELECT in_a AS d, count(*) AS n FROM ol GROUP BY 1) i ON i.d = t.input JOIN (SELECT out_a AS d, count(*) AS n FROM ol GROUP BY 1) o ON o.d = t.output""")
def a13(t):
    runs = t.runs()
    read = runs.groupBy(F.col("in_a").alias("dataset")).agg(F.count("*").alias("rows_in"))
    written = runs.groupBy(F.col("out_a").alias("dataset")).agg(F.count("*").alias("rows_out"))
    hops = t.triples().select("input", "output")
    joined = hops.distinct().join(read.withColumnRenamed("dataset", "input"), "input").join(written.withColumnRenamed("dataset", "output"), "output")
    ratio = F.try_divide("rows_out", "rows_in")
    return joined.select("input", "output", "rows_in", "rows_out", F.round(ratio, 6).alias("ratio"), (ratio < 0.5).alias("alert"))


@query("a14_volume_deviation", """SELECT out_a AS dataset, strftime(day, '%Y-%m-%d') AS day, n, coalesce(round(m, 6), -1) AS trailing_mean, coalesce(abs((n - m) / m) <= 0.1, true) AS within_sla FROM (
    SELECT *, avg(n) OVER (PARTITION BY out_a ORDER BY day RANGE BETWEEN INTERVAL 7 DAY PRECEDING AND INTERVAL 1 DAY PRECEDING) AS m
    FROM (SELECT out_a, date_trunc('day', ts) AS day, count(*) AS n FROM ol GROUP BY ALL))""")
def a14(t):
    daily = t.runs().groupBy(F.col("out_a").alias("dataset"), F.to_date("ts").alias("day")).agg(F.count("*").alias("n"))
    scored = tabular.trailing_days(daily, ["dataset"], "day", "n", 7)
    return scored.select("dataset", F.date_format("day", "yyyy-MM-dd").alias("day"), "n", F.coalesce(F.round("trailing_mean", 6), F.lit(-1.0)).alias("trailing_mean"),
                         F.coalesce(F.abs("deviation") <= 0.1, F.lit(True)).alias("within_sla"))


@query("a20_ingestion_metrics", """SELECT count(*) AS received, count(DISTINCT (run_id, state)) AS processed, count(*) FILTER (k = 3) AS failed, count(*) - count(DISTINCT (run_id, state)) AS duplicates,
    count(DISTINCT event_id // 250) AS batches, round(sum(value) / greatest(count(DISTINCT (run_id, state)), 1), 6) AS avg_latency_ms,
    round(100.0 * count(DISTINCT (run_id, state)) / greatest(count(DISTINCT (run_id, state)) + count(*) FILTER (k = 3), 1), 6)::DOUBLE AS success_rate FROM ol""")
def a20(t):
    one = t.runs().agg(
        F.count("*").alias("received"), F.countDistinct("run_id", "state").alias("processed"), F.count_if(F.col("k") == 3).alias("failed"),
        F.countDistinct(F.expr("event_id div 250")).alias("batches"), F.sum("value").alias("latency"))
    return one.select(
        "received", "processed", "failed", (F.col("received") - F.col("processed")).alias("duplicates"), "batches",
        F.round(F.col("latency") / F.greatest("processed", F.lit(1)), 6).alias("avg_latency_ms"),
        F.round(F.lit(100.0) * F.col("processed") / F.greatest(F.col("processed") + F.col("failed"), F.lit(1)), 6).alias("success_rate"))


@query("a23_dataset_versions", """SELECT dataset, run_id, n_columns, position FROM (SELECT *, CAST(row_number() OVER (PARTITION BY dataset ORDER BY created_at DESC) AS INTEGER) AS position FROM (
    SELECT out_a AS dataset, run_id, max(ts) AS created_at, count(DISTINCT k) AS n_columns FROM ol GROUP BY out_a, run_id)) WHERE position <= 5""")
def a23(t):
    versions = t.runs().groupBy(F.col("out_a").alias("dataset"), "run_id").agg(F.max("ts").alias("created_at"), F.countDistinct("k").alias("n_columns"))
    return top_rows(versions, ["dataset"], [F.desc("created_at")], 5).select("dataset", "run_id", "n_columns", F.col("rank").alias("position"))


_ENTRIES = """SELECT id, CASE WHEN id LIKE '%7' THEN upper(id) ELSE replace(id, 'ds_', 'd') END AS name, CASE WHEN namespace = 'wh_0' THEN '' ELSE 'team' END AS owner, first_seen, last_seen FROM (
    SELECT in_a AS id, 'wh_' || layer AS namespace, min(ts) AS first_seen, max(ts) AS last_seen FROM ol GROUP BY ALL)"""


@query("a25_metadata_hygiene", """SELECT 'missing_owner' AS issue, id FROM entries WHERE owner = '' UNION ALL SELECT 'orphaned', id FROM entries WHERE id NOT IN (SELECT src FROM edges WHERE type = 'PRODUCED_BY' UNION SELECT dst FROM edges WHERE type = 'PRODUCED_BY')
    UNION ALL SELECT 'duplicate', id FROM entries WHERE lower(name) IN (SELECT lower(name) FROM entries GROUP BY 1 HAVING count(*) > 1)
    UNION ALL SELECT 'stale_description', id FROM entries WHERE first_seen < last_seen UNION ALL SELECT 'inconsistent_naming', id FROM entries WHERE NOT regexp_full_match(name, '[a-z0-9_]+')""", entries=_ENTRIES)
def a25(t):
    entries = t.runs().groupBy(F.col("in_a").alias("id"), "in_ns").agg(F.min("ts").alias("described_at"), F.max("ts").alias("updated_at")).selectExpr(
        "id", "CASE WHEN endswith(id, '7') THEN upper(id) ELSE replace(id, 'ds_', 'd') END AS name", "if(in_ns = 'wh_0', '', 'team') AS owner", "described_at", "updated_at")
    return catalog.hygiene(entries, t.edges().filter("type = 'PRODUCED_BY'"))


@query("u01_union_all_streams", "SELECT event_id, event_type, 'web' AS channel FROM events WHERE event_type IN ('view', 'click') UNION ALL SELECT event_id, event_type, 'mobile' FROM events WHERE event_type = 'signup' UNION ALL SELECT event_id, event_type, 'api' FROM events WHERE event_type NOT IN ('view', 'click', 'signup')")
def u01(t):
    events = t.read("events").select("event_id", "event_type")
    web = events.filter("event_type IN ('view', 'click')").withColumn("channel", F.lit("web"))
    mobile = events.filter("event_type = 'signup'").withColumn("channel", F.lit("mobile"))
    return web.unionByName(mobile).unionByName(events.filter("event_type NOT IN ('view', 'click', 'signup')").withColumn("channel", F.lit("api")))


_MID = "(SELECT max(ts) - INTERVAL 10 DAY FROM events)"


@query("u02_lineage_diff", f"""SELECT src, dst, CASE WHEN min(side) = 2 THEN 'added' WHEN max(side) = 1 THEN 'removed' ELSE 'unchanged' END AS status FROM (
    SELECT DISTINCT src, dst, 1 AS side FROM versioned_edges WHERE valid_from <= {_MID} AND (valid_to IS NULL OR {_MID} <= valid_to)
    UNION ALL SELECT DISTINCT src, dst, 2 FROM versioned_edges WHERE valid_from <= (SELECT max(ts) + INTERVAL 1 SECOND FROM events) AND (valid_to IS NULL OR (SELECT max(ts) + INTERVAL 1 SECOND FROM events) <= valid_to)) GROUP BY src, dst""")
def u02(t):
    versions = cut_lineage(t.versioned_edges())
    end = t.read("events").agg(F.max("ts") + F.expr("INTERVAL 1 SECOND"))
    middle = t.read("events").agg(F.max("ts") - F.expr("INTERVAL 10 DAY"))
    return temporal.graph_diff(temporal.active_at(versions, middle.scalar()), temporal.active_at(versions, end.scalar()))


@query("u04_schema_drift", """SELECT dataset, column_name, '' AS new_name, 'removed' AS status FROM dataset_columns WHERE ordinal = 5 AND ds_no % 2 = 0
    UNION ALL SELECT dataset, 'added_col', '', 'added' FROM dataset_columns WHERE ordinal = 5 AND ds_no % 2 = 0
    UNION ALL SELECT dataset, column_name, column_name || '_v2', 'renamed' FROM dataset_columns WHERE ordinal = 1
    UNION ALL SELECT dataset, column_name, '', 'type_changed' FROM dataset_columns WHERE ordinal = 2""")
def u04(t):
    base = t.dataset_columns()
    before = base.selectExpr("dataset", "column_name", "'STRING' AS column_type", "ordinal")
    after = base.filter("NOT (ordinal = 5 AND ds_no % 2 = 0)").selectExpr(
        "dataset", "if(ordinal = 1, column_name || '_v2', column_name) AS column_name", "if(ordinal = 2, 'BIGINT', 'STRING') AS column_type", "ordinal")
    extra = base.filter("ordinal = 5 AND ds_no % 2 = 0").selectExpr("dataset", "'added_col' AS column_name", "'DATE' AS column_type", "9 AS ordinal")
    return temporal.schema_drift(before, after.unionByName(extra))


@query("u05_event_dedup", "SELECT run_id, state, event_id, ts FROM (SELECT *, row_number() OVER (PARTITION BY run_id, state ORDER BY ts, event_id) AS rn FROM ol) WHERE rn = 1")
def u05(t):
    return tabular.first_events(t.runs().select("run_id", "state", "event_id", "ts"), ["run_id", "state"], [F.col("ts"), F.col("event_id")])


@query("u05_event_dedup_job_run", "SELECT job_name, run_id, event_id FROM (SELECT *, row_number() OVER (PARTITION BY job_name, run_id ORDER BY ts, event_id) AS rn FROM ol) WHERE rn = 1")
def u05_run(t):
    return tabular.first_events(t.runs().select("job_name", "run_id", "event_id", "ts"), ["job_name", "run_id"], [F.col("ts"), F.col("event_id")]).drop("ts")


@query("u06_clean_orders", "SELECT l_orderkey, l_linenumber FROM (SELECT *, row_number() OVER (PARTITION BY l_orderkey ORDER BY l_linenumber) AS rn FROM lineitem WHERE l_orderkey IS NOT NULL) WHERE rn = 1")
def u06(t):
    return tabular.clean_orders(t.read("lineitem").select("l_orderkey", "l_linenumber"), "l_orderkey", [F.col("l_linenumber")])


@query("w06_recent_writers", "SELECT run_id, job_name, out_a, ts FROM ol WHERE state = 'COMPLETE' ORDER BY ts DESC, event_id LIMIT 20")
def w06(t):
    return t.runs().filter("state = 'COMPLETE'").orderBy(F.desc("ts"), "event_id").limit(20).select("run_id", "job_name", "out_a", "ts")


@query("w06_recent_writers_per_dataset", "SELECT out_a, run_id, position FROM (SELECT out_a, run_id, CAST(row_number() OVER (PARTITION BY out_a ORDER BY ts DESC, event_id) AS INTEGER) AS position FROM ol WHERE state = 'COMPLETE') WHERE position <= 20")
def w06_all(t):
    return top_rows(t.runs().filter("state = 'COMPLETE'").select("out_a", "run_id", "ts", "event_id"), ["out_a"], [F.desc("ts"), F.col("event_id")], 20).select("out_a", "run_id", F.col("rank").alias("position"))


@query("w07_versioned_edges", "SELECT src, dst, valid_from, coalesce(strftime(valid_to, '%Y-%m-%d %H:%M:%S'), 'open') AS valid_to FROM versioned_edges")
def w07(t):
    return t.versioned_edges().withColumn("valid_to", F.coalesce(F.date_format("valid_to", "yyyy-MM-dd HH:mm:ss"), F.lit("open")))


@query("w08_feature_windows", """SELECT customer, strftime(day, '%Y-%m-%d') AS day, round(sum(total) OVER m, 2) / sum(n) OVER m AS avg_amount_30d, CAST(sum(n) OVER q AS BIGINT) AS orders_90d,
    coalesce(day - lag(day) OVER (PARTITION BY customer ORDER BY day), -1) AS days_since_last,
    round((1999 - year(first_day)) * 12 + 1 - month(first_day) + (1 - day(first_day)) / 31.0::DOUBLE, 6) AS tenure_months FROM (SELECT *, min(day) OVER (PARTITION BY customer) AS first_day FROM (SELECT o_custkey AS customer, CAST(o_orderdate AS DATE) AS day, sum(o_totalprice) AS total, count(*) AS n FROM orders GROUP BY ALL))
    WINDOW m AS (PARTITION BY customer ORDER BY day RANGE BETWEEN INTERVAL 30 DAY PRECEDING AND CURRENT ROW), q AS (PARTITION BY customer ORDER BY day RANGE BETWEEN INTERVAL 90 DAY PRECEDING AND CURRENT ROW)""")
def w08(t):
    out = tabular.customer_windows(t.read("orders"), "o_custkey", "o_orderdate", "o_totalprice", F.lit("1999-01-01").cast("date"))
    return out.select("customer", F.date_format("day", "yyyy-MM-dd").alias("day"), "avg_amount_30d", "orders_90d", F.coalesce(F.col("days_since_last").cast("long"), F.lit(-1)).alias("days_since_last"), "tenure_months")


@query("t13_graph_at", f"SELECT DISTINCT src, dst FROM versioned_edges WHERE valid_from <= {_MID} AND (valid_to IS NULL OR {_MID} <= valid_to)")
def t13(t):
    middle = t.read("events").agg(F.max("ts") - F.expr("INTERVAL 10 DAY"))
    return temporal.active_at(t.versioned_edges(), middle.scalar()).select("src", "dst").distinct()


@query("t13_event_replay", f"SELECT DISTINCT src, dst, type FROM elog WHERE ts <= {_MID}")
def t13_replay(t):
    middle = t.read("events").agg(F.max("ts") - F.expr("INTERVAL 10 DAY"))
    return temporal.replay_until(t.edge_log(), middle.scalar())

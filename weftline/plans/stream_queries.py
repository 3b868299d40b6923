"""Registered streaming queries; each drains the event stream and reads back what it wrote."""

from __future__ import annotations

from pyspark.sql import functions as F

from weftline.fixtures import STATE_OF, sql_case
from weftline.plans.registry import query
from weftline.session import scratch_path
from weftline.streaming import lineage, sinks, sources

_HOUR = "SELECT strftime(date_trunc('hour', ts), '%Y-%m-%d %H:%M') AS window_start, count(*) AS n, round(sum(value), 4) AS total FROM events GROUP BY 1"


def events(t):
    return sources.table_stream(t.spark, t.sf_dir, "events")


def derive_runs(t, stream):
    """The run-event columns of ``Tables.runs`` over any frame of events."""
    jobs, datasets = 60 * t.scale, 24 * t.scale
    return stream.selectExpr("event_id", "ts", "user_id", "value", "event_type", f"(event_id div 4) % {jobs} AS job_no", "event_id div 4 AS run_no").selectExpr("*", "job_no % 5 AS layer").selectExpr(
        "event_id", "ts", "value", "'run_' || run_no AS run_id", "'job_' || layer || '_' || job_no AS job_name", sql_case("event_type", STATE_OF) + " AS state",
        f"'ds_' || layer || '_' || ((job_no * 7 + run_no % 3) % {datasets}) AS in_a", f"'ds_' || layer || '_' || ((job_no * 11 + 5) % {datasets}) AS in_b",
        f"'ds_' || (layer + 1) || '_' || ((job_no * 13 + run_no % 2) % {datasets}) AS out_a")


PARTS = 6
# The days of the events in five parts by time; a seventh arrives one part late, a ninth arrives again with the next part.
_PART = "least((day(ts) - 1) div 6, 4)"
_LATE, _AGAIN = "event_id % 7 = 3", "event_id % 9 = 4"


def arrivals(t, late: bool = False, again: bool = False):
    """The events as a stream of several batches, in the order of their days but for late and repeated ones."""
    events = t.read("events").withColumn("part", F.expr(f"CAST({_PART} + {f'if({_LATE}, 1, 0)' if late else '0'} AS INT)"))
    if again:
        events = events.unionByName(events.filter(_AGAIN).withColumn("part", F.col("part") + 1))
    path, files = scratch_path(t.spark, "arrivals"), max(1, t.scale // 100)
    sources.write_arrivals(events, "part", PARTS, files, path)
    return sources.file_stream(t.spark, path, files_per_batch=files)


def drained(t, stream, mode="append", transform=None, label="stream", **options):
    """Run the stream to its end and return (batches, finished query)."""
    path, checkpoint = scratch_path(t.spark, label), scratch_path(t.spark, f"{label}-state")
    done = sinks.finish(sinks.start(stream, path, checkpoint, mode, transform, **options))
    return t.spark.read.option("basePath", path).parquet(f"{path}/batch_id=*"), done


@query("s16_event_stream_source", "SELECT event_id, event_type, value FROM events")
def s16(t):
    raw = events(t).select(F.to_json(F.struct("event_id", "event_type", "value")).alias("value"))
    batches, _ = drained(t, sources.parse_values(raw, "event_id BIGINT, event_type STRING, value DOUBLE"))
    return batches.drop("batch_id")


@query("s17_stream_file_sink", "SELECT event_type, count(*) AS n FROM events GROUP BY event_type")
def s17(t):
    path = scratch_path(t.spark, "files")
    sinks.finish(sinks.append_files(events(t).select("event_id", "event_type"), path, scratch_path(t.spark, "files-state")))
    return t.spark.read.parquet(path).groupBy("event_type").agg(F.count("*").alias("n"))


@query("t01_windowed_aggregate", _HOUR)
def t01(t):
    batches, _ = drained(t, lineage.windowed_totals(events(t)), "update")
    current = sinks.latest_rows(batches, ["window_start"])
    return current.select(F.date_format("window_start", "yyyy-MM-dd HH:mm").alias("window_start"), "n", F.round("total", 4).alias("total"))


@query("t02_parse_filter_stream", "SELECT event_id, user_id, value FROM events WHERE event_type = 'purchase'")
def t02(t):
    raw = events(t).select(F.to_json(F.struct("event_id", "user_id", "event_type", "value")).alias("value"))
    parsed = sources.parse_values(raw, "event_id BIGINT, user_id BIGINT, event_type STRING, value DOUBLE").filter("event_type = 'purchase'")
    return drained(t, parsed)[0].select("event_id", "user_id", "value")


@query("t03_window_lineage_events", """SELECT window_start, '{"eventType":"RUNNING","eventTime":"' || w || '","job":{"namespace":"stream","name":"hourly"},"run":{"runId":"hourly-' || w || '","facets":{"window":{"rowsIn":' || n || ',"rowsOut":1}}},"inputs":[{"namespace":"stream","name":"events"}],"outputs":[{"namespace":"stream","name":"hourly_totals"}]}' AS event
    FROM (SELECT strftime(date_trunc('hour', ts), '%Y-%m-%d %H:%M') AS window_start, strftime(date_trunc('hour', ts), '%Y-%m-%dT%H:%M:%S.%f') AS w, count(*) AS n FROM events GROUP BY ALL)""")
def t03(t):
    batches, _ = drained(t, lineage.windowed_totals(events(t)), "update", lambda b: lineage.window_events(b, "hourly", "events", "hourly_totals"))
    return sinks.latest_rows(batches, ["window_start"]).select(F.date_format("window_start", "yyyy-MM-dd HH:mm").alias("window_start"), "event")


@query("t04_micro_batch_lineage", "SELECT count(*) AS rows_in, count(*) AS rows_out FROM events")
def t04(t):
    batches, done = drained(t, events(t))
    written = batches.agg(F.count("*").alias("rows_out"))
    return sinks.batch_log(done).agg(F.sum("n_rows").alias("rows_in")).select("rows_in", written.scalar().alias("rows_out"))


@query("t05_stream_dedup", "SELECT run_id, state, count(DISTINCT run_id || state) AS n FROM ol GROUP BY run_id, state")
def t05(t):
    once = lineage.drop_repeats(derive_runs(t, events(t)).select("run_id", "state", "ts"), ["run_id", "state"], "1 day")
    return drained(t, once)[0].groupBy("run_id", "state").agg(F.count("*").alias("n"))


@query("t06_stream_graph_ingest", """SELECT src, dst, type, count(*) AS n_events FROM (SELECT DISTINCT run_id, state, in_a, in_b, job_name, out_a FROM ol) o,
    LATERAL (SELECT in_a AS src, job_name AS dst, 'CONSUMED_BY' AS type UNION ALL SELECT in_b, job_name, 'CONSUMED_BY' UNION ALL SELECT job_name, out_a, 'PRODUCED_BY') GROUP BY src, dst, type""")
def t06(t):
    """An event counts once for each run and state, also when it comes again in a later batch."""
    once = lineage.drop_repeats(derive_runs(t, arrivals(t, again=True)), ["run_id", "state"], "14 days")
    batches, _ = drained(t, once, transform=lineage.batch_edges)
    return lineage.merged_edges(batches).select("src", "dst", "type", "n_events")


_CLOSING = """SELECT run_id, arg_max(state, (ts, event_id)) AS state, coalesce(strftime(min(ts) FILTER (state = 'START'), '%Y-%m-%d %H:%M:%S'), '') AS started_at,
    coalesce(strftime(max(ts) FILTER (state IN ('COMPLETE', 'FAIL', 'ABORT')), '%Y-%m-%d %H:%M:%S'), '') AS ended_at, count(*) AS n_events, max(ts) AS last_at FROM ol GROUP BY run_id"""


@query("t07_run_lifecycle", """SELECT run_id, state, started_at, ended_at, n_events, CASE WHEN ended_at <> '' AND last_at + INTERVAL 12 HOUR <= w THEN 'ended'
    WHEN ended_at = '' AND last_at + INTERVAL 24 HOUR <= w THEN 'timed out' ELSE 'open' END AS closed
    FROM closing, (SELECT date_trunc('millisecond', max(ts)) - INTERVAL 1 HOUR AS w FROM events)""", closing=_CLOSING)
def t07(t):
    batches, _ = drained(t, lineage.run_lifecycle(derive_runs(t, arrivals(t))), "update", settings=sinks.ROCKSDB)
    text = lambda c: F.coalesce(F.date_format(c, "yyyy-MM-dd HH:mm:ss"), F.lit("")).alias(c)
    return sinks.latest_rows(batches, ["run_id"]).select("run_id", "state", text("started_at"), text("ended_at"), "n_events", F.coalesce("closed", F.lit("open")).alias("closed"))


@query("t08_consumer_offsets", """SELECT consumer, topic, '{' || string_agg('"' || p || '":' || o, ',' ORDER BY p) || '}' AS partition_offsets, sum(o)::BIGINT AS total_lag, sum(o)::BIGINT AS total_offset FROM (
    SELECT job_name AS consumer, in_a AS topic, event_id % 4 AS p, max(event_id) AS o FROM ol GROUP BY ALL) GROUP BY consumer, topic""")
def t08(t):
    return lineage.consumer_facet(t.runs().selectExpr("job_name AS consumer", "in_a AS topic", "event_id % 4 AS partition", "event_id AS offset"))


@query("t09_change_lineage_events", """SELECT event_id, '{"eventType":"RUNNING","eventTime":"' || strftime(ts, '%Y-%m-%dT%H:%M:%S.%f') || '","job":{"namespace":"cdc://shop","name":"debezium.public.users","facets":{"jobType":{"processingType":"STREAMING","integration":"DEBEZIUM","jobType":"CDC_CONNECTOR"}}},"inputs":[{"namespace":"postgres://shop","name":"public.users","facets":{"lifecycleStateChange":{"lifecycleStateChange":"' || operation || '"}}}],"outputs":[{"namespace":"kafka://cluster","name":"cdc.public.users"}]}' AS event FROM change_stream""")
def t09(t):
    return drained(t, lineage.change_events(changes(events(t)), "shop", "public.users", "cdc.public.users"))[0].drop("batch_id")


def changes(stream):
    return stream.selectExpr("event_id", "user_id AS key", "ts", "value", "CASE event_type WHEN 'signup' THEN 'INSERT' WHEN 'error' THEN 'DELETE' ELSE 'UPDATE' END AS operation")


@query("t10_change_upsert_sink", "SELECT key, event_id, value FROM (SELECT *, row_number() OVER (PARTITION BY key ORDER BY ts DESC, event_id DESC) AS rn FROM change_stream) WHERE rn = 1 AND operation <> 'DELETE'")
def t10(t):
    batches, _ = drained(t, changes(events(t)), transform=lineage.latest_changes)
    return lineage.current_table(batches).select("key", "event_id", "value")


_TOPO = """SELECT DISTINCT in_a AS src, 'group_' || job_name AS dst, 'consumed_by' AS relation FROM ol UNION SELECT in_b, 'group_' || job_name, 'consumed_by' FROM ol
    UNION SELECT 'group_' || job_name, out_a, CASE WHEN layer = 4 THEN 'writes_to' ELSE 'produces' END FROM ol"""


def processors(t):
    return t.runs().selectExpr("'group_' || job_name AS group_id", "array(in_a, in_b) AS inputs", "if(layer = 4, array(), array(out_a)) AS outputs", "if(layer = 4, array(out_a), array()) AS sinks").distinct()


@query("t11_topic_topology", _TOPO)
def t11(t):
    return lineage.topic_topology(processors(t))[1]


@query("t11_topic_nodes", "SELECT 'group_' || job_name AS id, 'processor' AS type FROM ol UNION SELECT in_a, 'topic' FROM ol UNION SELECT in_b, 'topic' FROM ol UNION SELECT out_a, CASE WHEN layer = 4 THEN 'sink' ELSE 'topic' END FROM ol")
def t11_nodes(t):
    return lineage.topic_topology(processors(t))[0]


_ARRIVED = """SELECT *, least((day(ts) - 1) // 6, 4) + CASE WHEN event_id % 7 = 3 THEN 1 ELSE 0 END AS part FROM events"""
_CLOCK = """SELECT part AS batch_id, max(max(ts)) OVER (ORDER BY part ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) - INTERVAL 10 MINUTE AS watermark FROM arrived GROUP BY part"""


def split(t):
    """The events that arrive in order and late, kept apart by the watermark of their batch."""
    return drained(t, arrivals(t, late=True), write=sinks.split_late("10 minutes"))[0].withColumn("late", F.col("late").cast("boolean"))


@query("t12_late_data", """SELECT batch_id, coalesce(strftime(any_value(watermark), '%Y-%m-%d %H:%M:%S'), '') AS watermark, count(*) AS rows_in,
    count(*) FILTER (coalesce(ts >= watermark, true)) AS kept, count(*) FILTER (ts < watermark) AS late_rows FROM arrived JOIN clock ON batch_id = part GROUP BY batch_id""", arrived=_ARRIVED, clock=_CLOCK)
def t12(t):
    """Of each batch the rows on time and those behind the watermark."""
    rows = split(t).groupBy("batch_id").agg(
        F.coalesce(F.date_format(F.max("watermark"), "yyyy-MM-dd HH:mm:ss"), F.lit("")).alias("watermark"), F.count("*").alias("rows_in"), F.count_if(~F.col("late")).alias("kept"), F.count_if(F.col("late")).alias("late_rows"))
    return rows.withColumn("batch_id", F.col("batch_id").cast("long"))


@query("t12_late_rows", """SELECT event_id, strftime(ts, '%Y-%m-%d %H:%M:%S') AS ts, strftime(watermark, '%Y-%m-%d %H:%M:%S') AS watermark FROM arrived JOIN clock ON batch_id = part WHERE ts < watermark""", arrived=_ARRIVED, clock=_CLOCK)
def t12_rows(t):
    """The side table of late rows."""
    return split(t).filter("late").select("event_id", F.date_format("ts", "yyyy-MM-dd HH:mm:ss").alias("ts"), F.date_format("watermark", "yyyy-MM-dd HH:mm:ss").alias("watermark"))


@query("t12_windows_on_time", """SELECT strftime(date_trunc('hour', ts), '%Y-%m-%d %H:%M') AS window_start, count(*) AS n, count(*) FILTER (late) AS late_rows FROM (
    SELECT ts, coalesce(ts < watermark, false) AS late FROM arrived JOIN clock ON batch_id = part) GROUP BY 1""", arrived=_ARRIVED, clock=_CLOCK)
def t12_windows(t):
    """The batch twin keeps every row of an hour and says how many of them a stream would have lost."""
    return split(t).groupBy(F.date_format(F.date_trunc("hour", "ts"), "yyyy-MM-dd HH:mm").alias("window_start")).agg(F.count("*").alias("n"), F.count_if(F.col("late")).alias("late_rows"))

"""Run events, statements, exports and streams."""

import json

import pytest
from pyspark.sql import functions as F

from tests.conftest import rows
from weftline.operators import temporal
from weftline.sources import exports, inspect, manifests, run_events, statements
from weftline.streaming import lineage, sinks, sources


@pytest.fixture()
def event_file(tmp_path):
    def event(state, at, job="load", ins=("raw",), outs=("mart",), fields=None):
        out = [{"namespace": "wh", "name": o, **({"facets": {"schema": {"fields": fields}}} if fields else {})} for o in outs]
        return {"eventType": state, "eventTime": at, "run": {"runId": "r1"}, "job": {"name": job}, "inputs": [{"namespace": "wh", "name": i} for i in ins], "outputs": out}

    lines = [
        json.dumps(event("START", "2024-01-01T00:00:00", fields=[{"name": "id", "type": "BIGINT"}, {"name": "email"}])),
        json.dumps(event("COMPLETE", "2024-01-01T01:00:00")), json.dumps(event("FAIL", "2024-01-01T00:30:00", ins=("raw", "dim"))), '{"eventType": "START", "run": {']
    path = tmp_path / "events.json"
    path.write_text("\n".join(lines))
    return str(path)


def test_events_become_nodes_and_edges(spark, event_file):
    events = run_events.read_run_events(spark, event_file).cache()
    assert tuple(run_events.ingest_counts(events).first()) == (3, 1)
    good = run_events.well_formed(events)
    nodes = {r["id"]: r for r in run_events.event_nodes(good).collect()}
    assert set(nodes) == {"default/load", "wh/raw", "wh/dim", "wh/mart"}
    assert nodes["default/load"]["last_state"] == "COMPLETE"
    assert nodes["wh/mart"]["known_fields"] == 2
    edges = {(r["src"], r["dst"]): (r["type"], r["n_events"]) for r in run_events.event_edges(good).collect()}
    assert edges["wh/raw", "default/load"] == ("CONSUMED_BY", 3)
    assert edges["default/load", "wh/mart"] == ("PRODUCED_BY", 3)
    assert rows(run_events.schema_columns(good)) == [("wh/mart", "email", ""), ("wh/mart", "id", "BIGINT")]


STATEMENTS = {
    "join": ("insert into mart.orders select * from raw_orders o join customers c on o.c = c.id", {"mart.orders"}, {"raw_orders", "customers"}),
    "cte": ("create table t2 as with recent as (select * from base_orders) select * from recent join dims using (id)", {"t2"}, {"base_orders", "dims"}),
    "sub": ("insert into big select * from customers where id in (select id from orders)", {"big"}, {"customers", "orders"}),
    "union": ("insert into ev select * from web union all select * from app", {"ev"}, {"web", "app"}),
    "view": ("create view v as select * from fct", {"v"}, {"fct"}),
    "exists": ("create table if not exists mart.t as select * from x", {"mart.t"}, {"x"}),
    "replace": ("create or replace view v2 as select * from x", {"v2"}, {"x"}),
    "overwrite": ("insert overwrite t2 select * from raw.y, raw.z", {"t2"}, {"raw.y", "raw.z"}),
    "merge": ("merge into tgt using raw.s on tgt.id = s.id", {"tgt"}, {"raw.s"}),
    "columns": ("insert into t3 with c(a,b) as (select 1 from base) select extract(year from ts) from c", {"t3"}, {"base"}),
    "quoted": ("insert into t4 select ';from q' from x -- from y;\n where a = 1", {"t4"}, {"x"}),
    "script": ("insert into a select * from b; insert into c select * from a", {"a", "c"}, {"a", "b"}),
}


def test_statement_logs_read_through_local_names(spark):
    log = spark.createDataFrame([(k, v[0]) for k, v in STATEMENTS.items()], "name string, statement string")
    found = statements.script_tables(log).collect()
    for name, (_, targets, reads) in STATEMENTS.items():
        assert {r["table_name"] for r in found if r["name"] == name and r["role"] == "target"} == targets
        assert {r["table_name"] for r in found if r["name"] == name and r["role"] == "source"} == reads
    plain = statements.statement_tables(log.filter("name = 'cte'")).collect()
    assert sorted(r["table_name"] for r in plain if r["role"] == "source") == ["BASE_ORDERS", "DIMS", "RECENT"]


def test_plan_texts_give_their_sources(spark):
    text = "Join\n+- FileScan parquet [id#1,amount#2] Batched: true, Location: s3://lake/orders, ReadSchema\n+- Scan JDBCRelation(public.users) [numPartitions=1]"
    plans = spark.createDataFrame([("j", text)], "job string, plan_text string")
    assert rows(statements.plan_sources(plans)) == [("j", "file", "s3://lake/orders", "id#1,amount#2"), ("j", "jdbc", "public.users", "")]


def test_graph_json_round_trip_and_diagram(spark, edges_of, tmp_path):
    nodes = spark.createDataFrame([("wh/a.b", "dataset"), ("job-1", "job")], "id string, type string")
    edges = edges_of([("wh/a.b", "job-1")])
    path = str(tmp_path / "graph")
    exports.graph_json(nodes, edges).select("body").write.text(path)
    back_nodes, back_edges = exports.read_graph_json(spark, path)
    assert rows(back_nodes) == rows(nodes) and rows(back_edges) == rows(edges)
    lines = [r["line"] for r in exports.diagram_lines(nodes, edges).orderBy("ord").collect()]
    assert lines[0] == "graph LR" and '    wh_a_b[("wh/a.b")]' in lines and "    wh_a_b --> job_1" in lines


def test_mixed_json_types_are_kept_apart(spark):
    docs = spark.createDataFrame([('{"a": 1, "b": "x"}',), ('{"a": "1", "c": {"d": 1}, "e": [1], "f": true}',)], "doc string")
    assert rows(inspect.json_key_types(docs, "doc")) == [
        ("a", "int", 1), ("a", "str", 1), ("b", "str", 1), ("c", "dict", 1), ("e", "list", 1), ("f", "bool", 1)]


def test_versions_diff_is_symmetric(spark, edges_of):
    opened = spark.createDataFrame([("a", "b", 1), ("a", "b", 5), ("b", "c", 2)], "src string, dst string, valid_from int")
    versions = temporal.close_versions(opened)
    assert rows(versions) == [("a", "b", 1, 5), ("a", "b", 5, None), ("b", "c", 2, None)] or sorted(map(str, rows(versions)))
    assert temporal.active_at(versions, F.lit(5)).count() == 3
    one, two = edges_of([("a", "b"), ("b", "c")]), edges_of([("b", "c"), ("c", "d")])
    forward = {(r["src"], r["status"]) for r in temporal.graph_diff(one, two).collect()}
    back = {(r["src"], r["status"]) for r in temporal.graph_diff(two, one).collect()}
    assert forward == {("a", "removed"), ("b", "unchanged"), ("c", "added")}
    assert {s for s, t in forward if t == "added"} == {s for s, t in back if t == "removed"}


@pytest.fixture(scope="module")
def event_files(spark, tmp_path_factory):
    """The smallest event table cut into files in time order, so that a stream sees several batches."""
    path = str(tmp_path_factory.mktemp("events"))
    events = spark.read.parquet("/root/testdata/sf0.001/events.parquet").withColumn("part", F.expr("event_id div 250"))
    for part in range(4):
        events.filter(F.col("part") == part).drop("part").coalesce(1).write.mode("append").parquet(path)
    return path


def drain(spark, stream, tmp_path, mode="append", transform=None):
    path = str(tmp_path / "out")
    query = sinks.finish(sinks.start(stream, path, str(tmp_path / "state"), mode, transform))
    return spark.read.option("basePath", path).parquet(f"{path}/batch_id=*"), query


def test_windows_over_batches_equal_the_batch_result(spark, event_files, tmp_path):
    stream = sources.file_stream(spark, event_files, files_per_batch=1)
    batches, query = drain(spark, lineage.windowed_totals(stream), tmp_path, "update")
    got = rows(sinks.latest_rows(batches, ["window_start"]).select("window_start", "n"))
    want = rows(spark.read.parquet(event_files).groupBy(F.window(F.col("ts").cast("timestamp"), "1 hour")).count().select("window.start", "count"))
    assert got == want
    log = sinks.batch_log(query).filter("n_rows > 0")
    assert log.count() == 4 and log.agg(F.sum("n_rows")).first()[0] == 1000


def test_late_rows_are_dropped_and_counted(spark, tmp_path):
    path = str(tmp_path / "in")
    base = "2024-01-01 0{}:00:00"
    for hours in ([1, 2], [5], [6], [1]):
        spark.createDataFrame([(base.format(h), 1.0) for h in hours], "t string, value double").selectExpr("CAST(t AS TIMESTAMP_NTZ) AS ts", "value").coalesce(1).write.mode("append").parquet(path)
    stream = sources.file_stream(spark, path, "ts TIMESTAMP_NTZ, value DOUBLE", files_per_batch=1)
    batches, query = drain(spark, lineage.windowed_totals(stream), tmp_path, "update")
    assert sinks.latest_rows(batches, ["window_start"]).agg(F.sum("n")).first()[0] == 4
    assert sinks.batch_log(query).agg(F.sum("late_rows")).first()[0] == 1


def test_change_log_survives_a_repeated_batch(spark, tmp_path):
    path = str(tmp_path / "log")
    schema = "key int, ts timestamp, event_id int, operation string, value double"

    def change(key, second, operation, value):
        return (key, second, operation, value)

    batches = [[change(1, 1, "INSERT", 1.0), change(2, 2, "INSERT", 2.0), change(1, 3, "UPDATE", 3.0)], [change(2, 4, "DELETE", 2.0), change(3, 5, "INSERT", 5.0)]]
    frames = [spark.createDataFrame(b, "key int, event_id int, operation string, value double").selectExpr("key", "timestamp_seconds(event_id) AS ts", "event_id", "operation", "value") for b in batches]
    for batch_id in (0, 1, 1):
        sinks.write_batch(lineage.latest_changes(frames[batch_id]), batch_id, path)
    log = sinks.read_batches(spark, path, schema + ", batch_id int")
    assert rows(lineage.current_table(log).select("key", "value")) == [(1, 3.0), (3, 5.0)]
    lineage.compact(log, str(tmp_path / "compacted"))
    assert rows(lineage.current_table(spark.read.parquet(str(tmp_path / "compacted"))).select("key", "value")) == [(1, 3.0), (3, 5.0)]


def test_repeats_across_batches_are_dropped(spark, event_files, tmp_path):
    stream = sources.file_stream(spark, event_files, files_per_batch=1).withColumn("run", F.expr("event_id div 3"))
    batches, _ = drain(spark, lineage.drop_repeats(stream.select("run", "ts"), ["run"], "1 day"), tmp_path)
    assert batches.count() == 334


def test_manifest_edges_need_both_ends(spark):
    doc = json.dumps({
        "nodes": {"model.a": {"name": "a", "resource_type": "model", "depends_on": {"nodes": ["source.s"]}}, "test.t": {"name": "t", "resource_type": "test", "depends_on": {"nodes": ["model.a"]}}},
        "sources": {"source.s": {"name": "s", "source_name": "raw"}}, "exposures": {}, "parent_map": {"model.a": ["source.s"], "test.t": ["model.a", "model.gone"]}})
    parsed = manifests.parse_manifests(spark.createDataFrame([(doc,)], "manifest string"))
    assert rows(manifests.model_graph(parsed)[1]) == [("source.s", "model.a")]
    assert rows(manifests.resource_graph(parsed)[1]) == [("model.a", "test.t"), ("source.s", "model.a")]


def test_column_edges_take_all_transformations_and_default_names(spark, tmp_path):
    steps = [{"description": "trim"}, {"description": "upper"}]
    fields = {"c": {"inputFields": [{"name": "raw", "field": "a", "transformations": steps}, {"namespace": "wh", "name": "dim", "field": "b"}]}}
    event = {"eventType": "COMPLETE", "eventTime": "t", "run": {"runId": "r"}, "job": {"name": "j"}, "outputs": [{"name": "mart", "facets": {"columnLineage": {"fields": fields}}}]}
    (tmp_path / "e.json").write_text(json.dumps(event))
    got = rows(run_events.facet_column_edges(run_events.well_formed(run_events.read_run_events(spark, str(tmp_path)))))
    assert got == [("default/raw", "a", "default/mart", "c", "trim"), ("default/raw", "a", "default/mart", "c", "upper"), ("wh/dim", "b", "default/mart", "c", "IDENTITY")]


def test_the_last_write_wins_by_id_and_ties_are_ordered(spark, tmp_path):
    event = lambda state, run, at: json.dumps({"eventType": state, "eventTime": at, "run": {"runId": run}, "job": {"namespace": "n", "name": "x"}, "inputs": [{"namespace": "n", "name": "x"}]})
    lines = [event("START", "r2", "2024"), event("FAIL", "r1", "2024"), event("COMPLETE", "r0", "2023")]
    for k, order in enumerate((lines, lines[::-1])):
        (tmp_path / f"{k}.json").write_text("\n".join(order))
        node, = run_events.event_nodes(run_events.well_formed(run_events.read_run_events(spark, str(tmp_path / f"{k}.json")))).collect()
        assert (node["id"], node["type"], node["last_state"], node["n_events"]) == ("n/x", "job", "START", 6)


def test_the_batch_log_outlives_what_spark_remembers(spark, event_files, tmp_path):
    spark.conf.set("spark.sql.streaming.numRecentProgressUpdates", "2")
    try:
        _, query = drain(spark, sources.file_stream(spark, event_files, files_per_batch=1).select("event_id"), tmp_path)
        log = sinks.batch_log(query)
        assert len(query.recentProgress) == 1
        assert sorted((r["batch_id"], r["n_rows"]) for r in log.collect()) == [(i, 250) for i in range(4)]
    finally:
        spark.conf.unset("spark.sql.streaming.numRecentProgressUpdates")

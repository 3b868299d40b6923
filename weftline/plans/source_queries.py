"""Registered queries over sources, sinks, exports and event builders."""

from __future__ import annotations

from pyspark.sql import functions as F

from weftline.operators import traversal
from weftline.plans.registry import query
from weftline.session import scratch_path
from weftline.sources import emitters, exports, inspect, manifests, run_events, statements


def parsed_events(t):
    return run_events.well_formed(run_events.parse_run_events(t.event_docs()))


@query("s01_run_event_source", """SELECT event_id, state AS event_type, et AS event_time, run_id, CASE WHEN k = 1 THEN NULL ELSE job_ns END AS job_namespace,
    CASE WHEN k = 2 THEN NULL ELSE job_name END AS job_name, in_a AS first_input, out_a AS first_output FROM docs""")
def s01(t):
    return parsed_events(t).selectExpr(
        "event_id", "eventType AS event_type", "eventTime AS event_time", "run.runId AS run_id", "job.namespace AS job_namespace",
        "job.name AS job_name", "inputs[0].name AS first_input", "outputs[0].name AS first_output")


@query("s02_batch_ingest_counts", "SELECT count(*) FILTER (k IS NULL OR k <> 3) AS success, count(*) FILTER (k = 3) AS failed FROM ol")
def s02(t):
    return run_events.ingest_counts(run_events.parse_run_events(t.event_docs()))


_LINEITEM = [("l_orderkey", "bigint"), ("l_partkey", "bigint"), ("l_suppkey", "bigint"), ("l_linenumber", "int"), ("l_quantity", "double"),
             ("l_extendedprice", "double"), ("l_discount", "double"), ("l_tax", "double"), ("l_returnflag", "string"), ("l_linestatus", "string"),
             ("l_shipdate", "timestamp_ntz")]


@query("s03_parquet_inspect", " UNION ALL ".join(
    f"SELECT '{c}' AS column_name, '{k}' AS column_type, true AS nullable, CAST(min({c}) AS VARCHAR) AS min_value, CAST(max({c}) AS VARCHAR) AS max_value, "
    f"count(*) FILTER ({c} IS NULL) AS null_count, count(*) AS num_values FROM lineitem" for c, k in _LINEITEM))
def s03(t):
    return inspect.inspect_table(t.read("lineitem"))


_CUSTOMER = ["c_custkey", "c_name", "c_nationkey", "c_acctbal", "c_mktsegment"]


@query("s04_csv_inspect", f"""SELECT '{",".join(_CUSTOMER)}' AS columns, 'string' AS column_type, count(*) AS row_count, sum(strlen({" || ',' || ".join(f"CAST({c} AS VARCHAR)" for c in _CUSTOMER)}) + 1)::BIGINT AS body_bytes,
    true AS named, true AS timed FROM customer""")
def s04(t):
    path = scratch_path(t.spark, "csv")
    t.read("customer").write.option("header", True).csv(path)
    files = inspect.inspect_csv(t.spark, path)
    # How many files there are is up to the writer: sizes are compared without their header lines.
    return files.groupBy("columns", "column_type").agg(
        F.sum("row_count").alias("row_count"), F.sum(F.col("file_size") - F.octet_length("columns") - 1).alias("body_bytes"),
        F.bool_and(F.col("file_name").rlike(r"^part-.*\.csv$")).alias("named"), F.bool_and(F.col("modified_at").between(F.expr("current_timestamp() - INTERVAL 1 DAY"), F.current_timestamp())).alias("timed"))


@query("s05_json_schema_inference", """SELECT key, CASE WHEN json_type(props, '$.' || key) IN ('UBIGINT', 'BIGINT') THEN 'int' WHEN json_type(props, '$.' || key) = 'VARCHAR' THEN 'str' ELSE 'float' END AS value_type,
    count(*) AS n FROM (SELECT props, unnest(json_keys(props)) AS key FROM events) GROUP BY ALL""")
def s05(t):
    return inspect.json_key_types(t.read("events"), "props")


@query("s06_snapshot_log", """SELECT out_a AS dataset, event_id AS snapshot_id, epoch_us(ts) // 1000 AS timestamp_ms,
    CASE WHEN event_type = 'error' THEN 'delete' ELSE 'append' END AS operation, k AS added_records FROM ol""")
def s06(t):
    # Four events make a run, so a metadata document holds at most four snapshots.
    docs = t.runs().selectExpr(
        "out_a", "run_no", "named_struct('snapshot-id', event_id, 'timestamp-ms', unix_millis(CAST(ts AS TIMESTAMP)), 'operation', "
        "if(event_type = 'error', 'delete', 'append'), 'summary', map('added-records', CAST(k AS STRING))) AS snapshot",
    ).groupBy("out_a", "run_no").agg(F.collect_list("snapshot").alias("snapshots")).selectExpr("to_json(named_struct('table', out_a, 'snapshots', snapshots)) AS metadata")
    return manifests.snapshot_changes(docs)


@query("s07_column_catalog", """SELECT dataset, column_name, ordinal, CASE WHEN column_name LIKE '%_id' THEN 'BIGINT' WHEN column_name LIKE '%date%' THEN 'DATE' WHEN column_name = 'amount' THEN 'DECIMAL(10,2)' ELSE 'VARCHAR' END AS data_type
    FROM dataset_columns""")
def s07(t):
    return t.dataset_columns().selectExpr(
        "dataset", "column_name", "ordinal", "CASE WHEN endswith(column_name, '_id') THEN 'BIGINT' WHEN contains(column_name, 'date') THEN 'DATE' "
        "WHEN column_name = 'amount' THEN 'DECIMAL(10,2)' ELSE 'VARCHAR' END AS data_type")


@query("s08_foreign_keys", """SELECT 'fk_' || dataset || '_' || column_name AS constraint_name, dataset AS src_dataset, column_name AS src_column,
    'dim_' || replace(column_name, '_id', '') AS target_dataset, column_name AS target_column FROM dataset_columns WHERE column_name LIKE '%_id'""")
def s08(t):
    keys = t.dataset_columns().selectExpr("*", "endswith(column_name, '_id') AS is_key")
    named = keys.selectExpr("if(is_key, 'fk_', 'ck_') || dataset || '_' || column_name AS constraint_name", "dataset", "column_name", "is_key")
    constraints = named.selectExpr("constraint_name", "if(is_key, 'FOREIGN KEY', 'CHECK') AS constraint_type")
    references = named.filter("is_key").selectExpr("constraint_name", "'dim_' || replace(column_name, '_id', '') AS target_dataset", "column_name AS target_column")
    return inspect.foreign_keys(constraints, named.select("constraint_name", "dataset", "column_name"), references)


@query("s09_top_statements", "SELECT job_name, out_a, statement, calls, total_exec_time FROM query_log WHERE upper(statement) LIKE '%INSERT INTO%' ORDER BY total_exec_time DESC, job_name, out_a LIMIT 10")
def s09(t):
    return statements.top_statements(t.query_log()).select("job_name", "out_a", "statement", "calls", "total_exec_time")


@query("s09_last_day_inserts", "SELECT job_name, in_a, out_a, statement, start_time FROM query_log WHERE start_time > (SELECT max(ts) - INTERVAL 1 DAY FROM events) AND statement LIKE 'insert%'")
def s09_recent(t):
    cutoff = t.read("events").agg(F.max("ts") - F.expr("INTERVAL 1 DAY")).scalar()
    return statements.recent_statements(t.query_log(), cutoff, "insert").select("job_name", "in_a", "out_a", "statement", "start_time")


def manifest_docs(t):
    """One project manifest per job: a model, a test on every third, sources and an exposure."""
    jobs = t.triples().groupBy("job_name", "job_no").agg(F.sort_array(F.collect_set("input")).alias("ins"), F.min("output").alias("out"))
    return jobs.selectExpr(
        "to_json(named_struct("
        "'nodes', map_concat(map('model.' || job_name, named_struct('name', job_name, 'resource_type', 'model', 'depends_on', named_struct('nodes', transform(ins, i -> 'source.' || i)))), "
        "if(job_no % 3 = 0, map('test.' || job_name, named_struct('name', 'not_null_' || job_name, 'resource_type', 'test', 'depends_on', named_struct('nodes', array('model.' || job_name)))), map())), "
        "'sources', map_from_entries(transform(ins, i -> struct('source.' || i, named_struct('name', i, 'source_name', 'raw')))), "
        "'exposures', map('exposure.' || out, named_struct('name', out, 'type', 'dashboard')), "
        "'parent_map', map_concat(map('model.' || job_name, transform(ins, i -> 'source.' || i), 'exposure.' || out, array('model.' || job_name, 'model.missing')), "
        "if(job_no % 3 = 0, map('test.' || job_name, array('model.' || job_name)), map())))) AS manifest")


_JOB_OUT = "SELECT job_name, job_no, min(output) AS out FROM triples GROUP BY ALL"


@query("s10_manifest_graph", "SELECT DISTINCT 'source.' || input AS src, 'model.' || job_name AS dst FROM triples")
def s10(t):
    return manifests.model_graph(manifests.parse_manifests(manifest_docs(t)))[1]


@query("s10_manifest_nodes", "SELECT 'source.' || input AS id, input AS name, 'source' AS type FROM triples UNION SELECT 'model.' || job_name, job_name, 'model' FROM triples")
def s10_nodes(t):
    return manifests.model_graph(manifests.parse_manifests(manifest_docs(t)))[0]


@query("s11_manifest_all_resources", """SELECT 'source.' || input AS src, 'model.' || job_name AS dst FROM triples
    UNION SELECT 'model.' || job_name, 'exposure.' || out FROM job_out UNION SELECT 'model.' || job_name, 'test.' || job_name FROM job_out WHERE job_no % 3 = 0""", job_out=_JOB_OUT)
def s11(t):
    return manifests.resource_graph(manifests.parse_manifests(manifest_docs(t)))[1]


@query("s12_catalog_enrichment", """SELECT id, name, type, coalesce(n_columns, 0) AS n_columns, coalesce(row_count, 0) AS row_count FROM (SELECT 'source.' || input AS id, input AS name, 'source' AS type FROM triples UNION SELECT 'model.' || job_name, job_name, 'model' FROM triples)
    LEFT JOIN (SELECT 'source.' || dataset AS id, count(*) AS n_columns FROM dataset_columns GROUP BY 1) USING (id)
    LEFT JOIN (SELECT 'source.' || in_a AS id, sum(k)::BIGINT AS row_count FROM ol GROUP BY 1) USING (id)""")
def s12(t):
    nodes, _ = manifests.model_graph(manifests.parse_manifests(manifest_docs(t)))
    columns = t.dataset_columns().groupBy(F.concat(F.lit("source."), "dataset").alias("id")).agg(F.count("*").alias("n_columns"))
    counts = t.runs().groupBy(F.concat(F.lit("source."), "in_a").alias("id")).agg(F.sum("k").alias("row_count"))
    return manifests.with_catalog(manifests.with_catalog(nodes, columns), counts).select("id", "name", "type", "n_columns", "row_count").fillna(0)


def declarations(t):
    return t.products().selectExpr("product AS name", "input_ports AS inputs", "output_ports AS outputs")


@query("s13_task_declaration", """SELECT DISTINCT in_ns || '/' || in_a AS src, job_name AS dst, 'input' AS type FROM ol UNION SELECT in_ns || '/' || in_b, job_name, 'input' FROM ol
    UNION SELECT job_name, out_ns || '/' || out_a, 'output' FROM ol""")
def s13(t):
    return manifests.declared_graph(declarations(t))


def dag_rows(t):
    """One declaration per job with an extract and a load task."""
    return t.runs().selectExpr("job_name AS dag_id", "in_ns", "in_a", "out_ns", "out_a").distinct().selectExpr(
        "dag_id || '_' || out_a AS dag_id",
        "array(named_struct('task_id', 'extract', 'operator', 'PythonOperator', 'inputs', array(named_struct('namespace', in_ns, 'name', in_a)), "
        "'outputs', array(named_struct('namespace', 'tmp', 'name', in_a))), named_struct('task_id', 'load', 'operator', 'SqlOperator', "
        "'inputs', array(named_struct('namespace', 'tmp', 'name', in_a)), 'outputs', array(named_struct('namespace', out_ns, 'name', out_a)))) AS tasks",
        "map('extract', array('load')) AS dependencies")



@query("s14_dag_to_events", """SELECT dag_id, task_id, '{"eventType":"COMPLETE","eventTime":"2024-01-01T00:00:00.000000","job":{"namespace":"airflow://' || dag_id || '","name":"' || task_id ||
    '","facets":{"jobType":{"processingType":"BATCH","integration":"AIRFLOW","jobType":"' || op || '"}}},"inputs":[{"namespace":"' || ins || '","name":"' || iname || '"}],"outputs":[{"namespace":"' || ons || '","name":"' || oname || '"}]}' AS event FROM (
    SELECT job_name || '_' || out_a AS dag_id, 'extract' AS task_id, 'PythonOperator' AS op, in_ns AS ins, in_a AS iname, 'tmp' AS ons, in_a AS oname FROM ol
    UNION SELECT job_name || '_' || out_a, 'load', 'SqlOperator', 'tmp', in_a, out_ns, out_a FROM ol)""")
def s14(t):
    tasks = dag_rows(t).selectExpr("dag_id", "inline(tasks)")
    return tasks.select("dag_id", "task_id", emitters.run_event(
        "COMPLETE", F.lit("2024-01-01T00:00:00.000000"), F.concat(F.lit("airflow://"), "dag_id"), F.col("task_id"), F.col("inputs"), F.col("outputs"),
        job_facets={"jobType": emitters.job_type("BATCH", "AIRFLOW", F.col("operator"))}).alias("event"))


@query("s14_task_edges", "SELECT DISTINCT job_name || '_' || out_a AS dag_id, 'extract' AS src, 'load' AS dst FROM ol")
def s14_tasks(t):
    return manifests.dag_task_edges(dag_rows(t)).distinct()


@query("s15_server_payload", """SELECT 'dataset:' || in_ns || ':' || in_a AS src, 'job:' || job_ns || ':' || job_name AS dst FROM ol UNION SELECT 'dataset:' || in_ns || ':' || in_b, 'job:' || job_ns || ':' || job_name FROM ol
    UNION SELECT 'job:' || job_ns || ':' || job_name, 'dataset:' || out_ns || ':' || out_a FROM ol""")
def s15(t):
    ids = t.runs().selectExpr("lower('JOB') || ':' || job_ns || ':' || job_name AS id", "array('dataset:' || in_ns || ':' || in_a, 'dataset:' || in_ns || ':' || in_b) AS ins",
                              "'dataset:' || out_ns || ':' || out_a AS target").distinct()
    payload = ids.selectExpr("id", "transform(ins, i -> named_struct('origin', i, 'destination', id)) AS in_edges", "array(named_struct('origin', id, 'destination', target)) AS out_edges")
    return manifests.payload_edges(payload)


@query("s18_batch_sink", "SELECT CAST(ts AS DATE)::VARCHAR AS event_date, count(*) AS n, round(sum(value), 4) AS total FROM events GROUP BY 1")
def s18(t):
    path = scratch_path(t.spark, "curated")
    exports.write_curated(t.read("events"), path, "ts")
    return t.spark.read.parquet(path).groupBy(F.col("event_date").cast("string").alias("event_date")).agg(F.count("*").alias("n"), F.round(F.sum("value"), 4).alias("total"))


@query("s19_node_link_export", """SELECT 'node' AS kind, '{"id":"' || id || '","type":"' || type || '"}' AS body FROM nodes UNION ALL SELECT 'link', '{"source":"' || src || '","target":"' || dst || '"}' FROM edges""")
def s19(t):
    edges, nodes = t.graph
    return exports.graph_json(nodes, edges)


@query("s19_node_link_import", "SELECT src, dst FROM edges")
def s19_import(t):
    edges, nodes = t.graph
    path = scratch_path(t.spark, "graph-json")
    exports.graph_json(nodes, edges).select("body").write.text(path)
    return exports.read_graph_json(t.spark, path)[1]


@query("s20_flat_attribute_export", """SELECT dataset, '{"owner":"team_' || layer || '","first_column":"' || min(column_name) || '"}' AS schema_json FROM dataset_columns GROUP BY dataset, layer""")
def s20(t):
    nested = t.dataset_columns().groupBy("dataset", "layer").agg(F.min("column_name").alias("first_column")).selectExpr(
        "dataset", "named_struct('owner', 'team_' || layer, 'first_column', first_column) AS schema")
    return exports.flat_attributes(nested, "schema")


_LINES = """SELECT 0 AS ord, 'graph LR' AS line UNION ALL
    SELECT 1, CASE WHEN type = 'dataset' THEN '    ' || id || '[("' || id || '")]' ELSE '    ' || id || '["' || id || '"]' END FROM nodes
    UNION ALL SELECT 2, '    ' || src || ' --> ' || dst FROM edges"""


@query("s21_diagram_export", _LINES)
def s21(t):
    edges, nodes = t.graph
    return exports.diagram_lines(nodes, edges)


@query("s22_subgraph_diagram", """SELECT DISTINCT root, 0 AS ord, 'graph LR' AS line FROM kept UNION ALL
    SELECT root, 1, CASE WHEN type = 'dataset' THEN '    ' || id || '[("' || id || '")]' ELSE '    ' || id || '["' || id || '"]' END FROM kept JOIN nodes ON id = node
    UNION ALL SELECT a.root, 2, '    ' || src || ' --> ' || dst FROM kept a JOIN (SELECT DISTINCT src, dst FROM edges) e ON e.src = a.node JOIN kept b ON b.root = a.root AND b.node = e.dst""",
       kept="SELECT root, node FROM down WHERE depth <= 5 UNION SELECT root, root FROM down")
def s22(t):
    from weftline.plans.graph_queries import source_datasets

    edges, nodes = t.graph
    return exports.subgraph_lines(traversal.reach(edges, source_datasets(t), max_depth=5, include_root=True), nodes, edges)


@query("s23_schema_facet", """SELECT dataset, '{"namespace":"wh","name":"' || dataset || '","facets":{"schema":{"fields":[' ||
    string_agg('{"name":"' || column_name || '","type":"STRING"}', ',' ORDER BY ordinal) || ']}}}' AS body FROM dataset_columns GROUP BY dataset""")
def s23(t):
    # A dataset of this catalog has six columns.
    rows = t.dataset_columns().groupBy("dataset").agg(F.sort_array(F.collect_list(F.struct("ordinal", "column_name"))).alias("c"))
    fields = F.transform("c", lambda x: x["column_name"])
    return rows.select("dataset", F.to_json(emitters.dataset("wh", F.col("dataset"), schema=emitters.schema_facet(fields))).alias("body"))


@query("s24_observed_run_event", """SELECT stage, '{"eventType":"COMPLETE","eventTime":"' || strftime(mt, '%Y-%m-%dT%H:%M:%S.%f') || '","job":{"namespace":"obs","name":"' || stage ||
    '"},"inputs":[{"namespace":"obs","name":"' || in_a || '","facets":{"dataQualityMetrics":{"rowCount":' || ki || '}}}],"outputs":[{"namespace":"obs","name":"' || out_a || '","facets":{"dataQualityMetrics":{"rowCount":' || ko || '}}}]}' AS event
    FROM (SELECT job_name AS stage, in_a, out_a, max(ts) AS mt, sum(k)::BIGINT AS ki, count(*) AS ko FROM ol GROUP BY ALL)""")
def s24(t):
    measured = t.runs().groupBy(F.col("job_name").alias("stage"), "in_a", "out_a").agg(F.max("ts").alias("mt"), F.sum("k").alias("ki"), F.count("*").alias("ko"))
    metrics = lambda c: F.struct(F.col(c).alias("rowCount"))
    return measured.select("stage", emitters.run_event(
        "COMPLETE", emitters.event_time("mt"), "obs", F.col("stage"),
        F.array(emitters.dataset("obs", F.col("in_a"), dataQualityMetrics=metrics("ki"))),
        F.array(emitters.dataset("obs", F.col("out_a"), dataQualityMetrics=metrics("ko")))).alias("event"))


# Fixed values of the event builders below: namespaces, integrations, job types and frameworks.
CLUSTER, TRAINING, WAREHOUSE, MODEL_STORE = "kafka://cluster-prod", "ml://training", "warehouse://prod", "mlflow://models"
FINE_TUNING, LANGUAGE_MODELS, TRAINING_DATA, PRODUCTION = "llm://fine-tuning", "llm://models", "storage://training-data", "spark://production"
CONSUMER_JOB, TRAINING_JOB, TUNING_JOB = ("STREAMING", "KAFKA", "CONSUMER_GROUP"), ("BATCH", "MLFLOW", "ML_TRAINING"), ("BATCH", "LLM_FINE_TUNE", "FINE_TUNING")


def _job_sql(kind: tuple[str, str, str]) -> str:
    return '{"jobType":{"processingType":"%s","integration":"%s","jobType":"%s"}}' % kind


def consumer_events(t):
    """One event for each consumer group with all its topics."""
    topics = lambda c: F.sort_array(F.collect_set(c))
    read = t.runs().select(F.col("job_name").alias("consumer"), F.explode(F.array("in_a", "in_b")).alias("topic"), F.lit(None).cast("string").alias("written"), "ts")
    both = read.unionByName(t.runs().select(F.col("job_name").alias("consumer"), F.lit(None).cast("string").alias("topic"), F.col("out_a").alias("written"), "ts"))
    # A group reads and writes the topics of its job: a handful.
    groups = both.groupBy("consumer").agg(topics("topic").alias("inputs"), topics("written").alias("outputs"), F.max("ts").alias("mt"))
    entries = lambda c: F.transform(c, lambda x: emitters.dataset(CLUSTER, x))
    offsets = F.map_from_entries(F.transform("inputs", lambda x: F.struct(x, F.struct(F.lit(0).alias("lag"), F.lit(-1).alias("offset")))))
    return groups.select("consumer", emitters.run_event(
        "RUNNING", emitters.event_time("mt"), CLUSTER, F.col("consumer"), entries("inputs"), entries("outputs"), run_id=F.concat("consumer", F.lit("-streaming")),
        job_facets={"jobType": emitters.job_type(*CONSUMER_JOB)}, run_facets={"streaming": F.struct(offsets.alias("topic_partitions"))}).alias("event"))


_GROUP_TOPICS = """SELECT job_name AS consumer, side, topic FROM (SELECT job_name, 'in' AS side, in_a AS topic FROM ol UNION SELECT job_name, 'in', in_b FROM ol UNION SELECT job_name, 'out', out_a FROM ol)"""


@query("s25_consumer_event", f"""SELECT consumer, '{{"eventType":"RUNNING","eventTime":"' || strftime(mt, '%Y-%m-%dT%H:%M:%S.%f') || '","job":{{"namespace":"{CLUSTER}","name":"' || consumer ||
    '","facets":{_job_sql(CONSUMER_JOB)}}},"run":{{"runId":"' || consumer || '-streaming","facets":{{"streaming":{{"topic_partitions":{{' || parts || '}}}}}}}},"inputs":[' || ins || '],"outputs":[' || outs || ']}}' AS event
    FROM (SELECT consumer, string_agg('"' || topic || '":{{"lag":0,"offset":-1}}', ',' ORDER BY topic) FILTER (side = 'in') AS parts,
      string_agg('{{"namespace":"{CLUSTER}","name":"' || topic || '"}}', ',' ORDER BY topic) FILTER (side = 'in') AS ins,
      string_agg('{{"namespace":"{CLUSTER}","name":"' || topic || '"}}', ',' ORDER BY topic) FILTER (side = 'out') AS outs FROM group_topics GROUP BY consumer)
    JOIN (SELECT job_name AS consumer, max(ts) AS mt FROM ol GROUP BY job_name) USING (consumer)""", group_topics=_GROUP_TOPICS)
def s25(t):
    return consumer_events(t)


_FITTED = "SELECT * FROM models JOIN (SELECT model, count(*) AS n FROM model_features GROUP BY model) USING (model)"
_FACTS = """'{"framework":"xgboost","hyperparameters":{"max_depth":' || (3 + model_no % 6) || ',"n_estimators":' || (100 * (1 + model_no % 5)) || '},"metrics":' || metrics || '}'"""
_METRICS = "SELECT *, '{\"features\":' || n || ',\"version\":' || version || '}' AS metrics FROM fitted"


def fitted_models(t):
    return t.models().join(t.model_features().groupBy("model").agg(F.count("*").alias("n")), "model").withColumn(
        "metrics", F.struct(F.col("n").alias("features"), F.col("version").cast("int").alias("version")))


def training_events(t):
    """One event for each trained model, with its hyperparameters and metrics."""
    settings = F.struct((3 + F.col("model_no") % 6).alias("max_depth"), (100 * (1 + F.col("model_no") % 5)).alias("n_estimators"))
    return fitted_models(t).select("model", emitters.run_event(
        "COMPLETE", F.lit("2024-01-01T00:00:00.000000"), TRAINING, F.concat("model", F.lit("-training")),
        F.array(emitters.dataset(WAREHOUSE, F.col("training_dataset"), dataQualityMetrics=F.struct(F.col("n").alias("rowCount")))),
        F.array(emitters.dataset(MODEL_STORE, F.concat_ws(":", "model", "version"), modelMetrics=F.col("metrics"))),
        run_id=F.concat(F.lit("run_"), "model_no"), job_facets={"jobType": emitters.job_type(*TRAINING_JOB)},
        run_facets={"mlTraining": F.struct(F.lit("xgboost").alias("framework"), settings.alias("hyperparameters"), F.col("metrics"))}).alias("event"))


@query("s26_training_event", f"""SELECT model, '{{"eventType":"COMPLETE","eventTime":"2024-01-01T00:00:00.000000","job":{{"namespace":"{TRAINING}","name":"' || model || '-training","facets":{_job_sql(TRAINING_JOB)}}},"run":{{"runId":"run_' || model_no ||
    '","facets":{{"mlTraining":' || {_FACTS} || '}}}},"inputs":[{{"namespace":"{WAREHOUSE}","name":"' || training_dataset || '","facets":{{"dataQualityMetrics":{{"rowCount":' || n || '}}}}}}],"outputs":[{{"namespace":"{MODEL_STORE}","name":"' || model || ':' || version || '","facets":{{"modelMetrics":' || metrics || '}}}}]}}' AS event
    FROM measured""", fitted=_FITTED, measured=_METRICS)
def s26(t):
    return training_events(t)


def tuning_events(t):
    """One event for each fine-tuned model: base model and training data in, the model with its metrics out."""
    no_facets = F.lit(None).cast("struct<dataQualityMetrics: struct<rowCount: bigint>>")
    base = F.struct(F.lit(LANGUAGE_MODELS).alias("namespace"), F.concat(F.lit("base_"), "nation").alias("name"), no_facets.alias("facets"))
    data = emitters.dataset(TRAINING_DATA, F.col("training_dataset"), dataQualityMetrics=F.struct(F.col("n").alias("rowCount")))
    return fitted_models(t).select("model", emitters.run_event(
        "COMPLETE", F.lit("2024-01-01T00:00:00.000000"), FINE_TUNING, F.concat(F.lit("fine-tune-"), "model_no"), F.array(base, data),
        F.array(emitters.dataset(LANGUAGE_MODELS, F.col("model"), modelMetrics=F.col("metrics"))),
        job_facets={"jobType": emitters.job_type(*TUNING_JOB)}).alias("event"))


@query("s26_fine_tune_event", f"""SELECT model, '{{"eventType":"COMPLETE","eventTime":"2024-01-01T00:00:00.000000","job":{{"namespace":"{FINE_TUNING}","name":"fine-tune-' || model_no || '","facets":{_job_sql(TUNING_JOB)}}},"inputs":[{{"namespace":"{LANGUAGE_MODELS}","name":"base_' || nation || '"}},{{"namespace":"{TRAINING_DATA}","name":"' || training_dataset || '","facets":{{"dataQualityMetrics":{{"rowCount":' || n || '}}}}}}],"outputs":[{{"namespace":"{LANGUAGE_MODELS}","name":"' || model || '","facets":{{"modelMetrics":' || metrics || '}}}}]}}' AS event
    FROM measured""", fitted=_FITTED, measured=_METRICS)
def s26_tune(t):
    return tuning_events(t)


_PLAN_FIELDS = """SELECT job_name, dst_ds, '"' || dst_col || '":{"inputFields":[' || string_agg('{"namespace":"wh","name":"' || src_ds || '","field":"' || src_col || '"}', ',' ORDER BY src_ds, src_col) || '],"transformationType":"' || min(transformation) || '"}' AS field, dst_col
    FROM (SELECT DISTINCT job_name, dst_ds, dst_col, src_ds, src_col, transformation FROM column_edges) GROUP BY job_name, dst_ds, dst_col"""
_PLAN_OUTPUTS = """SELECT job_name, string_agg('{"namespace":"wh","name":"' || dst_ds || '","facets":{"columnLineage":{"fields":{' || fields || '}}}}', ',' ORDER BY dst_ds) AS outs
    FROM (SELECT job_name, dst_ds, string_agg(field, ',' ORDER BY dst_col) AS fields FROM plan_fields GROUP BY ALL) GROUP BY job_name"""
_PLAN_INPUTS = """SELECT job_name, array_to_string(list_sort(list(DISTINCT src_col)), ', ') AS cols, array_to_string(list_transform(list_sort(list(DISTINCT src_ds)), lambda x: '{"namespace":"wh","name":"' || x || '"}'), ',') AS ins FROM column_edges GROUP BY job_name"""


@query("s27_plan_event", f"""SELECT job_name, '{{"eventType":"COMPLETE","eventTime":"2024-01-01T00:00:00.000000","job":{{"namespace":"{PRODUCTION}","name":"' || job_name || '","facets":{{"sourceCode":{{"type":"SPARK_SQL","plan":"Project [' || cols || ']"}}}}}},"run":{{"runId":"plan-' || job_name || '"}},"inputs":[' || ins || '],"outputs":[' || outs || ']}}' AS event
    FROM plan_inputs JOIN plan_outputs USING (job_name)""", plan_fields=_PLAN_FIELDS, plan_outputs=_PLAN_OUTPUTS, plan_inputs=_PLAN_INPUTS)
def s27(t):
    """One event for each plan: its inputs, and its outputs with all columns."""
    edges = t.column_edges()
    # Lists are as long as a job has columns and datasets.
    source = F.struct(F.lit("wh").alias("namespace"), F.col("src_ds").alias("name"), F.col("src_col").alias("field"))
    fields = edges.groupBy("job_name", "dst_ds", "dst_col").agg(
        F.struct(F.sort_array(F.collect_set(source)).alias("inputFields"), F.min("transformation").alias("transformationType")).alias("field"))
    tables = fields.groupBy("job_name", "dst_ds").agg(F.sort_array(F.collect_list(F.struct("dst_col", "field"))).alias("fields"))
    written = tables.groupBy("job_name").agg(F.sort_array(F.collect_list(F.struct("dst_ds", "fields"))).alias("written"))
    read = edges.groupBy("job_name").agg(F.sort_array(F.collect_set("src_ds")).alias("read"), F.sort_array(F.collect_set("src_col")).alias("cols"))
    outputs = F.transform("written", lambda w: emitters.dataset("wh", w["dst_ds"], columnLineage=F.struct(F.map_from_entries(w["fields"]).alias("fields"))))
    code = F.struct(F.lit("SPARK_SQL").alias("type"), F.concat(F.lit("Project ["), F.concat_ws(", ", "cols"), F.lit("]")).alias("plan"))
    return read.join(written, "job_name").select("job_name", emitters.run_event(
        "COMPLETE", F.lit("2024-01-01T00:00:00.000000"), PRODUCTION, F.col("job_name"), F.transform("read", lambda x: emitters.dataset("wh", x)), outputs,
        run_id=F.concat(F.lit("plan-"), "job_name"), job_facets={"sourceCode": code}).alias("event"))


@query("s28_domain_run_event", """SELECT event_id, '{"eventType":"' || state || '","eventTime":"' || strftime(ts, '%Y-%m-%dT%H:%M:%S.%f') || '","job":{"namespace":"acme://d' || layer || '","name":"' || job_name || '"},"inputs":[{"namespace":"acme","name":"acme://d' || layer || '.prod/' || in_a || '"}],"outputs":[{"namespace":"acme","name":"acme://d' || layer || '.prod/' || out_a || '"}]}' AS event FROM ol""")
def s28(t):
    name = lambda c: F.format_string("acme://d%d.prod/%s", F.col("layer"), F.col(c))
    return t.runs().select("event_id", emitters.run_event(
        F.col("state"), emitters.event_time("ts"), F.concat(F.lit("acme://d"), "layer"), F.col("job_name"),
        F.array(emitters.dataset("acme", name("in_a"))), F.array(emitters.dataset("acme", name("out_a")))).alias("event"))


@query("s29_node_run_log", """SELECT 'START' AS state, 'enrich_orders' AS node, 'orders' AS dataset, 'input' AS role, 0::BIGINT AS n_rows, 6 AS n_columns
    UNION ALL SELECT 'START', 'enrich_orders', 'customer', 'input', 0, 5 UNION ALL SELECT 'COMPLETE', 'enrich_orders', 'orders', 'input', (SELECT count(*) FROM orders), 6
    UNION ALL SELECT 'COMPLETE', 'enrich_orders', 'customer', 'input', (SELECT count(*) FROM customer), 5 UNION ALL SELECT 'COMPLETE', 'enrich_orders', 'enriched', 'output', (SELECT count(*) FROM orders), 11""")
def s29(t):
    def enrich(orders, customer):
        return orders.join(customer, orders["o_custkey"] == customer["c_custkey"], "left")

    return emitters.run_node_logged("enrich_orders", {"orders": t.read("orders"), "customer": t.read("customer")}, enrich, "enriched", scratch_path(t.spark, "enriched"))


@query("s30_fail_event", """SELECT event_id, '{"eventType":"FAIL","eventTime":"' || strftime(ts, '%Y-%m-%dT%H:%M:%S.%f') || '","job":{"namespace":"' || job_ns || '","name":"' || job_name || '"},"run":{"runId":"' || run_id || '","facets":{"errorMessage":{"message":"task failed","programmingLanguage":"PYTHON"},"cost":{"units":' || k || '}}},"inputs":[{"namespace":"' || in_ns || '","name":"' || in_a || '"}],"outputs":[]}' AS event FROM ol WHERE state = 'FAIL'""")
def s30(t):
    error = F.struct(F.lit("task failed").alias("message"), F.lit("PYTHON").alias("programmingLanguage"))
    none = F.array().cast("array<struct<namespace: string, name: string>>")
    return t.runs().filter("state = 'FAIL'").select("event_id", emitters.run_event(
        F.col("state"), emitters.event_time("ts"), F.col("job_ns"), F.col("job_name"), F.array(emitters.dataset(F.col("in_ns"), F.col("in_a"))), none,
        run_id=F.col("run_id"), run_facets={"errorMessage": error, "cost": F.struct(F.col("k").alias("units"))}).alias("event"))


@query("s31_table_time_travel", """SELECT key, version, value, event_id FROM (SELECT user_id AS key, event_id // 100 AS version, event_id, value, event_type = 'error' AS deleted,
    row_number() OVER (PARTITION BY user_id ORDER BY event_id DESC) AS rn FROM events WHERE event_id // 100 <= (SELECT max(event_id) // 200 FROM events)) WHERE rn = 1 AND NOT deleted""")
def s31(t):
    versions = t.change_stream().selectExpr("key", "event_id div 100 AS version", "event_id", "operation = 'DELETE' AS deleted", "value")
    half = t.read("events").agg(F.expr("max(event_id) div 200 AS half"))
    return inspect.table_history(versions, half.scalar(), ["key"], "event_id").select("key", "version", "value", "event_id")


def written_events(t):
    """Events of several builders in JSON files, read back with every facet."""
    from weftline.plans.stream_queries import changes
    from weftline.streaming.lineage import change_events

    changed = change_events(changes(t.read("events")), "shop", "public.users", "cdc.public.users")
    path = scratch_path(t.spark, "events")
    for events in (s24(t), training_events(t), tuning_events(t), consumer_events(t), changed):
        events.select(F.col("event").alias("value")).write.mode("append").text(path)
    return run_events.well_formed(run_events.read_run_events(t.spark, path, all_facets=True))


_FACETS = f"""SELECT 'obs' AS job_namespace, stage AS job, 'input' AS owner, 'obs/' || in_a AS id, 'dataQualityMetrics' AS facet, '{{"rowCount":' || ki || '}}' AS body FROM observed
    UNION ALL SELECT 'obs', stage, 'output', 'obs/' || out_a, 'dataQualityMetrics', '{{"rowCount":' || ko || '}}' FROM observed
    UNION ALL SELECT '{TRAINING}', model || '-training', 'run', 'run_' || model_no, 'mlTraining', {_FACTS} FROM measured
    UNION ALL SELECT '{TRAINING}', model || '-training', 'job', '{TRAINING}/' || model || '-training', 'jobType', '{{"integration":"{TRAINING_JOB[1]}","jobType":"{TRAINING_JOB[2]}","processingType":"{TRAINING_JOB[0]}"}}' FROM measured
    UNION ALL SELECT '{TRAINING}', model || '-training', 'input', '{WAREHOUSE}/' || training_dataset, 'dataQualityMetrics', '{{"rowCount":' || n || '}}' FROM measured
    UNION ALL SELECT '{TRAINING}', model || '-training', 'output', '{MODEL_STORE}/' || model || ':' || version, 'modelMetrics', metrics FROM measured
    UNION ALL SELECT '{FINE_TUNING}', 'fine-tune-' || model_no, 'job', '{FINE_TUNING}/fine-tune-' || model_no, 'jobType', '{{"integration":"{TUNING_JOB[1]}","jobType":"{TUNING_JOB[2]}","processingType":"{TUNING_JOB[0]}"}}' FROM measured
    UNION ALL SELECT '{FINE_TUNING}', 'fine-tune-' || model_no, 'input', '{TRAINING_DATA}/' || training_dataset, 'dataQualityMetrics', '{{"rowCount":' || n || '}}' FROM measured
    UNION ALL SELECT '{FINE_TUNING}', 'fine-tune-' || model_no, 'output', '{LANGUAGE_MODELS}/' || model, 'modelMetrics', metrics FROM measured
    UNION ALL SELECT '{CLUSTER}', consumer, 'job', '{CLUSTER}/' || consumer, 'jobType', '{{"integration":"{CONSUMER_JOB[1]}","jobType":"{CONSUMER_JOB[2]}","processingType":"{CONSUMER_JOB[0]}"}}' FROM (SELECT DISTINCT consumer FROM group_topics)
    UNION ALL SELECT '{CLUSTER}', consumer, 'run', consumer || '-streaming', 'streaming', '{{"topic_partitions":{{' || string_agg('"' || topic || '":{{"lag":0,"offset":-1}}', ',' ORDER BY topic) || '}}}}' FROM group_topics WHERE side = 'in' GROUP BY consumer
    UNION ALL SELECT 'cdc://shop', 'debezium.public.users', 'job', 'cdc://shop/debezium.public.users', 'jobType', '{{"integration":"DEBEZIUM","jobType":"CDC_CONNECTOR","processingType":"STREAMING"}}' FROM change_stream
    UNION ALL SELECT 'cdc://shop', 'debezium.public.users', 'input', 'postgres://shop/public.users', 'lifecycleStateChange', '{{"lifecycleStateChange":"' || operation || '"}}' FROM change_stream"""
_OBSERVED = "SELECT job_name AS stage, in_a, out_a, sum(k)::BIGINT AS ki, count(*) AS ko FROM ol GROUP BY ALL"


@query("s01_all_facets", _FACETS, observed=_OBSERVED, fitted=_FITTED, measured=_METRICS, group_topics=_GROUP_TOPICS)
def s01_facets(t):
    """Every facet of every event, whatever its name."""
    return run_events.facets(written_events(t))

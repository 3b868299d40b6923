"""Registered queries that turn events, names and statements into graph rows."""

from __future__ import annotations

from pyspark.sql import functions as F

from weftline.operators import catalog, columns, topology
from weftline.plans.registry import query
from weftline.plans.source_queries import parsed_events
from weftline.sources import run_events, statements

_UPSERT = "SELECT id, type, namespace, name, last_state, created_at, updated_at, n_events FROM upserted"


@query("p01_node_upsert", _UPSERT)
def p01(t):
    return run_events.event_nodes(parsed_events(t)).drop("n_fields", "known_fields")


@query("p02_event_edges", """SELECT in_ns || '/' || in_a AS src, jns || '/' || jname AS dst, 'CONSUMED_BY' AS type, count(*) AS n_events FROM (SELECT in_ns, in_a, jns, jname FROM docs UNION ALL SELECT in_ns, in_b, jns, jname FROM docs) GROUP BY ALL
    UNION ALL SELECT jns || '/' || jname, out_ns || '/' || out_a, 'PRODUCED_BY', count(*) FROM docs GROUP BY ALL""")
def p02(t):
    return run_events.event_edges(parsed_events(t))


@query("p03_reads_writes", """SELECT jns || '/' || jname AS src, 'READS' AS relation, in_ns || '/' || in_a AS dst FROM docs UNION SELECT jns || '/' || jname, 'READS', in_ns || '/' || in_b FROM docs
    UNION SELECT jns || '/' || jname, 'WRITES', out_ns || '/' || out_a FROM docs UNION SELECT run_id, 'OF_JOB', jns || '/' || jname FROM docs""")
def p03(t):
    return run_events.relationships(parsed_events(t))


@query("p03_latest_run_state", "SELECT run_id, arg_max(state, et) AS state, max(et) AS event_time FROM docs GROUP BY run_id")
def p03_state(t):
    return run_events.latest_run_states(parsed_events(t))


@query("p04_schema_facet_columns", "SELECT DISTINCT out_ns || '/' || out_a AS dataset, c1 AS column_name, 'STRING' AS column_type FROM docs UNION SELECT out_ns || '/' || out_a, c2, '' FROM docs")
def p04(t):
    return run_events.schema_columns(parsed_events(t))


@query("p05_column_lineage_facet", """SELECT DISTINCT in_ns || '/' || in_a AS src_ds, c2 AS src_col, out_ns || '/' || out_a AS dst_ds, c1 AS dst_col,
    CASE WHEN event_id % 2 = 0 THEN 'SUM(x)' ELSE 'IDENTITY' END AS transformation FROM docs""")
def p05(t):
    return run_events.facet_column_edges(parsed_events(t))


@query("p06_list_datasets_page", "SELECT id, type, namespace FROM nodes WHERE type = 'dataset' AND namespace = 'wh_2' ORDER BY id LIMIT 20 OFFSET 5")
def p06(t):
    return catalog.page(t.nodes().filter("type = 'dataset'"), "wh_2", 20, 5)


@query("p07_point_lookup", "SELECT id, type, namespace FROM nodes WHERE id = (SELECT min(id) FROM nodes)")
def p07(t):
    nodes = t.nodes()
    return catalog.lookup(nodes, nodes.agg(F.min("id")).scalar())


@query("p08_search", "SELECT id, type, namespace FROM nodes WHERE contains(lower(id), 's_1_') OR contains(lower(namespace), 's_1_')")
def p08(t):
    return catalog.search(t.nodes(), "S_1_", ["id", "namespace"])


_DESCRIBED = """SELECT id, type, namespace, id AS name, CASE WHEN type = 'dataset' THEN 'Table of layer ' || split_part(id, '_', 2) || ', written by job_1' ELSE 'Loads layer ' || split_part(id, '_', 2) END AS description FROM nodes"""
_PAGE = """SELECT id, type, name, namespace, description, count(*) OVER () AS total FROM described WHERE (contains(lower(name), '{text}') OR contains(lower(description), '{text}')){kind} ORDER BY type, id LIMIT {limit}"""


def described(t):
    """Nodes with a description; a word can be in the name of some and in the description of others."""
    layer = "split_part(id, '_', 2)"
    return t.nodes().selectExpr("id", "type", "namespace", "id AS name", f"CASE WHEN type = 'dataset' THEN 'Table of layer ' || {layer} || ', written by job_1' ELSE 'Loads layer ' || {layer} END AS description")


@query("p09_search_page", _PAGE.format(text="job_1", kind="", limit=400), described=_DESCRIBED)
def p09(t):
    return catalog.search_page(described(t), "JOB_1", ["name", "description"], limit=400).select("id", "type", "name", "namespace", "description", "total")


@query("p09_search_page_of_kind", _PAGE.format(text="layer 2", kind=" AND type = 'job'", limit=10), described=_DESCRIBED)
def p09_kind(t):
    return catalog.search_page(described(t), "Layer 2", ["name", "description"], kind="job", limit=10).select("id", "type", "name", "namespace", "description", "total")


_TAGGED = "SELECT dataset AS id, dataset AS name, 'team ' || layer AS description, list_sort(list(DISTINCT column_name)) AS tags FROM dataset_columns GROUP BY dataset, layer"


@query("p10_catalog_search_tags", "SELECT id, description FROM tagged WHERE contains(name, 'email') OR contains(description, 'email') OR len(list_filter(tags, lambda x: contains(x, 'email'))) > 0", tagged=_TAGGED)
def p10(t):
    tagged = t.dataset_columns().groupBy("dataset", "layer").agg(F.collect_set("column_name").alias("tags")).selectExpr("dataset AS id", "dataset AS name", "'team ' || layer AS description", "tags")
    return catalog.search_with_tags(tagged, "EMAIL").select("id", "description")


@query("p11_qualify_parse", "SELECT 'acme://d' || split_part(id, '_', 2) || '.prod/' || id AS fqn, 'acme' AS org, 'd' || split_part(id, '_', 2) AS domain, 'prod' AS environment, id AS dataset FROM nodes WHERE type = 'dataset'")
def p11(t):
    named = t.nodes().select(F.when(F.col("type") == "dataset", catalog.qualify(
        F.lit("acme"), F.concat(F.lit("d"), F.split_part("id", F.lit("_"), F.lit(2))), F.lit("prod"), F.col("id"))).otherwise(F.col("id")).alias("fqn"))
    return catalog.parse_qualified(named, "fqn")


@query("p12_urn_resolve", "SELECT 'urn:' || id AS urn, CASE WHEN type = 'dataset' THEN namespace || '/' || id ELSE 'urn:' || id END AS name FROM nodes")
def p12(t):
    nodes = t.nodes()
    registry = nodes.filter("type = 'dataset'").selectExpr("'urn:' || id AS urn", "namespace || '/' || id AS name")
    return catalog.resolve_urns(nodes.selectExpr("'urn:' || id AS urn"), registry)


@query("p12_urn_reverse_lookup", "SELECT namespace AS name, 'urn:' || id AS urn FROM nodes WHERE namespace IN (SELECT out_ns FROM ol WHERE state = 'FAIL')")
def p12_reverse(t):
    registry = t.nodes().selectExpr("namespace AS name", "'urn:' || id AS urn")
    return catalog.urns_of(registry, t.runs().filter("state = 'FAIL'").selectExpr("out_ns AS name").distinct())


@query("p13_transcoding", "SELECT in_a AS name, count(*) AS n FROM ol GROUP BY in_a")
def p13(t):
    coded = t.runs().selectExpr("in_a || if(event_id % 2 = 0, '@pandas', '@spark') AS coded")
    return coded.groupBy(catalog.base_name("coded").alias("name")).agg(F.count("*").alias("n"))


@query("p14_modular_prefix", "SELECT DISTINCT job_ns, input AS dataset, CASE WHEN input NOT IN (SELECT dst FROM edges) THEN input ELSE job_ns || '.' || input END AS prefixed FROM (SELECT in_a AS input, job_ns FROM ol UNION SELECT in_b, job_ns FROM ol)")
def p14(t):
    used = t.runs().selectExpr("explode(array(in_a, in_b)) AS dataset", "job_ns").distinct()
    written = t.runs().selectExpr("out_a AS dataset", "true AS inner").distinct()
    return used.join(written, "dataset", "left").select("job_ns", "dataset", catalog.prefixed("dataset", F.col("job_ns"), F.col("inner").isNull()).alias("prefixed"))


@query("p15_statement_tables", r"""SELECT job_name, in_a, out_a, role, table_name FROM (
    SELECT job_name, in_a, out_a, 'target' AS role, regexp_extract(upper(statement), '(?:INSERT\s+INTO|CREATE\s+TABLE)\s+(\S+)', 1) AS table_name FROM query_log
    UNION ALL SELECT job_name, in_a, out_a, 'source', trim(unnest(regexp_extract_all(upper(statement), '(?:FROM|JOIN)\s+(\S+)', 1)), '()') FROM query_log)
    WHERE table_name NOT IN ('', 'SELECT', 'WHERE')""")
def p15(t):
    return statements.statement_tables(t.query_log().select("job_name", "in_a", "out_a", "statement")).drop("statement")


@query("p16_script_tables", """SELECT DISTINCT job_name, out_a, role, table_name FROM (SELECT job_name, out_a, 'target' AS role, out_a AS table_name FROM query_log
    UNION ALL SELECT job_name, out_a, 'source', in_a FROM query_log UNION ALL SELECT job_name, out_a, 'source', in_b FROM query_log WHERE job_no % 6 IN (0, 2, 3, 4)
    UNION ALL SELECT job_name, out_a, 'target', in_b FROM query_log WHERE job_no % 6 = 5)""")
def p16(t):
    return statements.script_tables(t.query_log().select("job_name", "out_a", "statement")).drop("statement").distinct()


@query("p16_script_shapes", """SELECT DISTINCT job_name, out_a, role, table_name FROM (SELECT job_name, out_a, 'target' AS role, out_a AS table_name FROM ol
    UNION ALL SELECT job_name, out_a, 'source', in_a FROM ol UNION ALL SELECT job_name, out_a, 'source', in_b FROM ol WHERE job_no % 12 IN (2, 4, 6, 7)
    UNION ALL SELECT job_name, out_a, 'target', in_b FROM ol WHERE job_no % 12 = 11)""")
def p16_shapes(t):
    return statements.script_tables(t.script_log().select("job_name", "out_a", "statement")).drop("statement").distinct()


@query("p17_plan_sources", """SELECT DISTINCT job_name, 'file' AS kind, 's3://lake/' || in_a AS source, 'id,amount' AS columns FROM ol UNION SELECT job_name, 'jdbc', in_b, '' FROM ol""")
def p17(t):
    plans = t.runs().selectExpr(
        "job_name", "'Join\\n+- FileScan parquet [id,amount] Batched: true, Location: s3://lake/' || in_a || ', PartitionFilters: []\\n+- Scan JDBCRelation(' || in_b || ')' AS plan_text").distinct()
    return statements.plan_sources(plans).distinct()



@query("p18_classification", """SELECT job_name, src, dst, kind, CASE WHEN kind IN ('FILTER', 'JOIN_KEY') THEN 'INDIRECT' ELSE 'DIRECT' END AS directness FROM (
    SELECT *, CASE WHEN transformation NOT IN ('IDENTITY', 'RENAME') THEN transformation WHEN src_col = dst_col THEN 'IDENTITY' ELSE 'RENAME' END AS kind FROM column_edges)""")
def p18(t):
    written = t.column_edges().selectExpr("job_name", "src", "dst", "src_col", "dst_col", """CASE transformation WHEN 'FILTER' THEN 'where x > 0' WHEN 'JOIN_KEY' THEN 'on a.x = b.x' WHEN 'AGGREGATION' THEN 'sum(x)'
        WHEN 'CONDITIONAL' THEN 'case when x then y end' WHEN 'CAST' THEN 'cast(x as int)' WHEN 'EXPRESSION' THEN 'x + 1' END AS expression""")
    kind = columns.classify(F.col("src_col"), F.col("dst_col"), F.col("expression"))
    return written.select("job_name", "src", "dst", kind.alias("kind"), columns.directness(kind).alias("directness"))


@query("p19_system_roll_up", "SELECT a.namespace AS src_group, b.namespace AS dst_group, count(*) AS n_edges FROM edges JOIN nodes a ON a.id = src JOIN nodes b ON b.id = dst GROUP BY ALL")
def p19(t):
    edges, nodes = t.graph
    return topology.roll_up(edges, nodes.select("id", F.col("namespace").alias("grp")))


@query("p20_edge_usage", """SELECT src, dst, rows_read, bytes_read, reads, columns_used, CASE WHEN reads > 1 THEN 'repeated' ELSE 'single' END AS access_pattern FROM (
    SELECT dataset AS src, user_name AS dst, sum(event_id % 100)::BIGINT AS rows_read, sum(event_id % 100 * 8)::BIGINT AS bytes_read, count(*) AS reads FROM access_log GROUP BY ALL)
    JOIN (SELECT src, dst, string_agg(c, ',' ORDER BY c) AS columns_used FROM (SELECT DISTINCT dataset AS src, user_name AS dst, unnest(columns) AS c FROM access_log) GROUP BY ALL) USING (src, dst)""")
def p20(t):
    return catalog.edge_usage(t.access_log().selectExpr("dataset AS src", "user_name AS dst", "columns", "event_id % 100 AS rows_read", "event_id % 100 * 8 AS bytes_read"))


@query("p21_catalog_entry", """SELECT product, domain, domain || '/' || product || '/' || input_ports[1] || ';' || domain || '/' || product || '/' || input_ports[2] AS inputs, array_to_string(output_ports, ';') AS outputs,
    '{"freshness_hours":' || sla_hours || '}' AS sla FROM products""")
def p21(t):
    return t.products().select(
        "product", "domain", F.array_join(F.transform("input_ports", lambda p: F.concat_ws("/", "domain", "product", p)), ";").alias("inputs"),
        F.array_join("output_ports", ";").alias("outputs"), F.to_json(F.when(F.col("sla_hours").isNotNull(), F.struct(F.col("sla_hours").alias("freshness_hours")))).alias("sla"))


@query("p25_list_namespaces", "SELECT namespace, min(created_at) AS created_at, count(*) FILTER (type = 'dataset') AS datasets, count(*) FILTER (type = 'job') AS jobs FROM upserted GROUP BY namespace")
def p25(t):
    return catalog.namespaces(run_events.event_nodes(parsed_events(t)))

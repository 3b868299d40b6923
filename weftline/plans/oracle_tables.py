"""The derivations of ``weftline.fixtures`` in SQL, as CTEs for the oracle queries."""

from __future__ import annotations

import re

_ARR = "['customer_id','email','first_name','amount','order_date']"
_TRF = "['IDENTITY','RENAME','CAST','EXPRESSION','AGGREGATION','CONDITIONAL','FILTER','JOIN_KEY']"
_NAMES = (
    "['customer_id','email','first_name','last_name','phone','date_of_birth','zip_code','city',"
    "'ssn','order_id','amount','order_date','region','hotel_id','email_hash','capacity']"
)
_MODELS = "['gpt-4-turbo','gpt-4o','gpt-3.5-turbo','claude-3-opus','claude-3-sonnet']"

# name -> (CTE body, names it reads)
CTES: dict[str, str] = {
    "sc": "SELECT greatest(count(*) // 1000, 1) AS s FROM events",
    "ol": """SELECT *, 'run_' || run_no AS run_id, 'job_' || layer || '_' || job_no AS job_name, 'ns_' || layer AS job_ns,
        'wh_' || layer AS in_ns, 'wh_' || (layer + 1) AS out_ns,
        CASE event_type WHEN 'signup' THEN 'START' WHEN 'view' THEN 'RUNNING' WHEN 'purchase' THEN 'COMPLETE'
          WHEN 'error' THEN 'FAIL' WHEN 'click' THEN 'ABORT' END AS state,
        'ds_' || layer || '_' || ((job_no * 7 + run_no % 3) % (24 * s)) AS in_a,
        'ds_' || layer || '_' || ((job_no * 11 + 5) % (24 * s)) AS in_b,
        'ds_' || (layer + 1) || '_' || ((job_no * 13 + run_no % 2) % (24 * s)) AS out_a
      FROM (SELECT event_id, ts, user_id, event_type, value, CAST(json_extract_string(props, '$.k') AS BIGINT) AS k,
        event_id // 4 AS run_no, (event_id // 4) % (60 * s) AS job_no, ((event_id // 4) % (60 * s)) % 5 AS layer, s
        FROM events, sc)""",
    "elog": """SELECT event_id, ts, run_no, job_no, value, k, in_a AS src, job_name AS dst, 'CONSUMED_BY' AS type FROM ol
      UNION ALL SELECT event_id, ts, run_no, job_no, value, k, in_b, job_name, 'CONSUMED_BY' FROM ol
      UNION ALL SELECT event_id, ts, run_no, job_no, value, k, job_name, out_a, 'PRODUCED_BY' FROM ol""",
    "docs": f"""SELECT *, strftime(ts, '%Y-%m-%dT%H:%M:%S.%f') AS et, CASE WHEN k = 1 THEN 'default' ELSE job_ns END AS jns,
        CASE WHEN k = 2 THEN 'unknown' ELSE job_name END AS jname, {_ARR}[event_id % 5 + 1] AS c1, {_ARR}[(event_id + 2) % 5 + 1] AS c2
      FROM ol WHERE k IS NULL OR k <> 3""",
    "mentions": """SELECT jns || '/' || jname AS id, 'job' AS type, jns AS namespace, jname AS name, state, et, NULL AS n_fields, run_id FROM docs
      UNION ALL SELECT in_ns || '/' || in_a, 'dataset', in_ns, in_a, state, et, NULL, run_id FROM docs
      UNION ALL SELECT in_ns || '/' || in_b, 'dataset', in_ns, in_b, state, et, NULL, run_id FROM docs
      UNION ALL SELECT out_ns || '/' || out_a, 'dataset', out_ns, out_a, state, et, 2, run_id FROM docs""",
    "upserted": """SELECT id, arg_max(type, (et, run_id, state, type)) AS type, arg_max(namespace, (et, run_id, state, type)) AS namespace, arg_max(name, (et, run_id, state, type)) AS name,
        arg_max(state, (et, run_id, state, type)) AS last_state, min(et) AS created_at, max(et) AS updated_at,
        count(*) AS n_events, max(n_fields) AS known_fields FROM mentions GROUP BY id""",
    "edges": "SELECT DISTINCT src, dst, type FROM elog",
    "nodes": """SELECT id, CASE WHEN id LIKE 'job_%' THEN 'job' ELSE 'dataset' END AS type,
        (CASE WHEN id LIKE 'job_%' THEN 'ns_' ELSE 'wh_' END) || split_part(id, '_', 2) AS namespace
      FROM (SELECT src AS id FROM edges UNION SELECT dst FROM edges)""",
    "triples": """SELECT DISTINCT input, job_name, job_no, layer, out_a AS output FROM (
      SELECT in_a AS input, job_name, job_no, layer, out_a FROM ol UNION ALL SELECT in_b, job_name, job_no, layer, out_a FROM ol)""",
    "entity_edges": """SELECT 'part:' || l_partkey AS src, 'order:' || l_orderkey AS dst FROM lineitem
      UNION SELECT 'supplier:' || l_suppkey, 'order:' || l_orderkey FROM lineitem
      UNION SELECT 'order:' || o_orderkey, 'customer:' || o_custkey FROM orders
      UNION SELECT 'customer:' || c_custkey, 'nation:' || c_nationkey FROM customer
      UNION SELECT 'nation:' || n_nationkey, 'region:' || n_regionkey FROM nation""",
    "column_edges": f"""SELECT src_ds || '.' || src_col AS src, dst_ds || '.' || dst_col AS dst, src_ds, src_col, dst_ds, dst_col,
        transformation, job_name, src_col IN ('email', 'first_name') AND layer = 0 AS is_pii
      FROM (SELECT input AS src_ds, {_ARR}[i + 1] AS src_col, output AS dst_ds, {_ARR}[(i * 3 + job_no) % 5 + 1] AS dst_col,
        {_TRF}[(job_no + i) % 8 + 1] AS transformation, job_name, layer FROM triples, range(5) r(i))""",
    "dataset_columns": f"""SELECT dataset, {_NAMES}[(layer * 24 + ds_no + 5 * ordinal) % 16 + 1] AS column_name, CAST(ordinal AS INTEGER) AS ordinal,
        layer, ds_no
      FROM (SELECT id AS dataset, CAST(split_part(id, '_', 2) AS BIGINT) AS layer, CAST(split_part(id, '_', 3) AS BIGINT) AS ds_no
        FROM nodes WHERE type = 'dataset'), range(6) r(ordinal)""",
    "quality_checks": """SELECT event_id, out_a AS dataset, 'chk_' || (event_id % 3) AS check_name, event_type <> 'error' AS passed,
        value, CAST(50.0 AS DOUBLE) AS threshold, ts AS checked_at FROM ol""",
    "metric_history": """SELECT event_id, 'p_' || layer AS pipeline, job_name AS stage, ts AS recorded_at, 'row_count' AS metric, value AS metric_value FROM ol
      UNION ALL SELECT event_id, 'p_' || layer, job_name, ts, 'duration_sec', CAST(k * 3 AS DOUBLE) FROM ol
      UNION ALL SELECT event_id, 'p_' || layer, job_name, ts, 'completed', CASE WHEN event_type <> 'error' THEN 1.0::DOUBLE ELSE 0.0::DOUBLE END FROM ol""",
    "versioned_edges": """SELECT src, dst, valid_from, coalesce(lead(valid_from) OVER w,
          CASE WHEN job_no % 7 = 0 THEN (SELECT max(ts) FROM events) END) AS valid_to
      FROM (SELECT src, dst, run_no // 500 AS version, job_no, min(ts) AS valid_from FROM elog GROUP BY ALL)
      WINDOW w AS (PARTITION BY src, dst ORDER BY valid_from)""",
    "access_log": f"""SELECT event_id, 'u_' || user_id AS user_name, in_a AS dataset,
        [{_ARR}[event_id % 5 + 1], {_ARR}[(event_id + 2) % 5 + 1]] AS columns,
        CASE event_type WHEN 'view' THEN 'SELECT' WHEN 'signup' THEN 'INSERT' WHEN 'click' THEN 'UPDATE'
          WHEN 'error' THEN 'DELETE' ELSE 'SELECT' END AS access_type, md5(CAST(event_id AS VARCHAR)) AS query_hash, ts AS accessed_at
      FROM ol""",
    "query_log": """SELECT job_name, job_no, in_a, in_b, out_a, calls, total_exec_time, start_time, CASE job_no % 6
        WHEN 0 THEN 'insert into ' || out_a || ' select a.amount from ' || in_a || ' a join ' || in_b || ' b on a.id = b.id'
        WHEN 1 THEN 'create table ' || out_a || ' as select * from ' || in_a || ' where amount > 0'
        WHEN 2 THEN 'insert into ' || out_a || ' with recent as (select * from ' || in_a || ') select * from recent join ' || in_b || ' using (id)'
        WHEN 3 THEN 'insert into ' || out_a || ' select * from ' || in_a || ' where id in (select id from ' || in_b || ')'
        WHEN 4 THEN 'insert into ' || out_a || ' select id from ' || in_a || ' union all select id from ' || in_b
        ELSE 'create view ' || out_a || ' as select * from ' || in_a || '; delete from ' || in_b END AS statement
      FROM (SELECT job_name, job_no, in_a, in_b, out_a, count(*) AS calls, round(sum(value), 2) AS total_exec_time, max(ts) AS start_time
        FROM ol GROUP BY ALL)""",
    "products": """SELECT DISTINCT job_no AS reg_order, job_name AS product, 'd_' || layer AS domain, 'team_' || layer AS owner,
        [in_ns || '/' || in_a, in_ns || '/' || in_b] AS input_ports, [out_ns || '/' || out_a] AS output_ports,
        CAST(6 + 6 * layer AS BIGINT) AS sla_hours FROM ol""",
    "features": f"""SELECT p_partkey AS feature_no, 'feature_' || p_partkey AS feature,
        ['ds_0_' || (p_partkey % (24 * s)), 'ds_0_' || ((p_partkey * 5) % (24 * s))] AS source_tables,
        [{_ARR}[p_partkey % 5 + 1], {_ARR}[(p_partkey + 2) % 5 + 1]] AS source_columns, p_retailprice AS metric FROM part, sc""",
    "models": """SELECT 'model_' || s_suppkey AS model, CAST(1 + s_suppkey % 3 AS VARCHAR) AS version, s_suppkey AS model_no,
        'ds_1_' || (s_suppkey % (24 * s)) AS training_dataset, 'pred_' || s_suppkey AS predictions,
        s_nationkey AS nation, s_acctbal AS score FROM supplier, sc""",
    "model_features": "SELECT DISTINCT 'model_' || l_suppkey AS model, 'feature_' || l_partkey AS feature FROM lineitem WHERE l_partkey % 11 <> 0",
    "chunks": """SELECT doc_id, source, left(md5(doc_id || ':' || (idx * 200)), 12) AS chunk_id, idx AS chunk_index,
        array_to_string(words[idx * 200 + 1 : idx * 200 + 200], ' ') AS chunk_text,
        len(words[idx * 200 + 1 : idx * 200 + 200]) AS n_words
      FROM (SELECT doc_id, source, words, unnest(range(0, (len(words) + 199) // 200)) AS idx FROM (
        SELECT doc_id, source, list_filter(string_split_regex(text, '[ \\t\\r\\n]+'), lambda x: x <> '') AS words FROM documents))""",
    "rag_events": f"""SELECT event_id, ts, [event_id % n, (event_id * 7) % n] AS docs, {_MODELS}[event_id % 5 + 1] AS model,
        value AS latency_ms, k * 10 AS prompt_tokens, k AS completion_tokens, event_type, run_no
      FROM ol, (SELECT count(*) AS n FROM documents) WHERE event_type IN ('view', 'click')""",
    "change_stream": """SELECT event_id, user_id AS key, ts, value, CASE event_type WHEN 'signup' THEN 'INSERT' WHEN 'error' THEN 'DELETE'
        ELSE 'UPDATE' END AS operation FROM events""",
    # closures -----------------------------------------------------------------
    "down_walk": """SELECT src AS root, dst AS node, 1 AS depth FROM edges WHERE src NOT IN (SELECT dst FROM edges)
      UNION SELECT w.root, e.dst, w.depth + 1 FROM down_walk w JOIN edges e ON e.src = w.node""",
    "down": "SELECT root, node, min(depth) AS depth FROM down_walk GROUP BY root, node",
    "up_walk": """SELECT dst AS root, src AS node, 1 AS depth FROM edges WHERE dst NOT IN (SELECT src FROM edges)
      UNION SELECT w.root, e.src, w.depth + 1 FROM up_walk w JOIN edges e ON e.dst = w.node""",
    "up": "SELECT root, node, min(depth) AS depth FROM up_walk GROUP BY root, node",
    "all_walk": """SELECT src AS ancestor, dst AS descendant, 1 AS depth FROM edges
      UNION SELECT w.ancestor, e.dst, w.depth + 1 FROM all_walk w JOIN edges e ON e.src = w.descendant""",
    "closure": "SELECT ancestor, descendant, min(depth) AS depth FROM all_walk GROUP BY ancestor, descendant",
    "col_walk": """SELECT src AS root, dst AS node, 1 AS depth FROM column_edges
      UNION SELECT w.root, e.dst, w.depth + 1 FROM col_walk w JOIN column_edges e ON e.src = w.node""",
    "col_closure": "SELECT root, node, min(depth) AS depth FROM col_walk GROUP BY root, node",
}


def with_tables(body: str, **extra: str) -> str:
    """Prefix ``body`` with the CTEs it names, directly or through other CTEs.

    A CTE that keeps one row for each key while it recurs starts with its columns and key: ``(a, b) USING KEY (a) AS (SELECT …)``.
    """
    known = {**CTES, **extra}
    ordered: list[str] = []

    def visit(text: str, path: tuple[str, ...]) -> None:
        for name in known:
            if name not in path and name not in ordered and re.search(rf"\b{name}\b", text):
                visit(known[name], path + (name,))
                if name not in ordered:
                    ordered.append(name)

    visit(body, ())
    if not ordered:
        return body
    said = [f"{name}{known[name]}" if " USING KEY " in known[name] else f"{name} AS ({known[name]})" for name in ordered]
    return "WITH RECURSIVE " + ",\n".join(said) + "\n" + body

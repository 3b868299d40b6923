"""Registered privacy, access and classification queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from weftline.operators import governance as gov
from weftline.operators import topology
from weftline.plans.registry import query
from weftline.plans.source_queries import parsed_events
from weftline.session import cut_lineage
from weftline.sources.run_events import schema_columns


def _kind_case(patterns: dict, column: str = "column_name") -> str:
    return "CASE " + " ".join(f"WHEN regexp_matches({column}, '{'|'.join(words)}') THEN '{kind}'" for kind, words in patterns.items()) + " END"


def _kind_rows(patterns: dict, source: str) -> str:
    return " UNION ALL ".join(f"SELECT dataset, column_name, '{kind}' AS pii_type FROM {source} WHERE regexp_matches(column_name, '{'|'.join(words)}')" for kind, words in patterns.items())


_FIRST = f"SELECT dataset, column_name, {_kind_case(gov.BASIC_PATTERNS)} AS pii_type FROM dataset_columns WHERE {_kind_case(gov.BASIC_PATTERNS)} IS NOT NULL"


@query("v01_pii_columns_first_type", _FIRST)
def v01(t):
    return gov.first_pii_type(t.dataset_columns())


@query("v02_pii_columns_all_types", _kind_rows(gov.STORE_PATTERNS, "dataset_columns"))
def v02(t):
    return gov.all_pii_types(t.dataset_columns())


@query("v02_auto_classification", f"SELECT dataset, column_name, CASE WHEN {_kind_case(gov.WIDE_PATTERNS)} IS NULL THEN 'INTERNAL' ELSE 'RESTRICTED' END AS classification FROM dataset_columns")
def v02_auto(t):
    return gov.auto_classify(t.dataset_columns()).select("dataset", "column_name", "classification")


_FACETS = "SELECT DISTINCT out_ns || '/' || out_a AS dataset, c1 AS column_name FROM docs UNION SELECT out_ns || '/' || out_a, c2 FROM docs"


@query("v03_scan_schema_facets", f"SELECT dataset, count(*) AS n_findings, count(DISTINCT column_name) AS n_columns FROM ({_kind_rows(gov.STORE_PATTERNS, 'facets')}) GROUP BY dataset", facets=_FACETS)
def v03(t):
    columns = schema_columns(parsed_events(t)).select("dataset", "column_name").distinct()
    return gov.all_pii_types(columns).groupBy("dataset").agg(F.count("*").alias("n_findings"), F.countDistinct("column_name").alias("n_columns"))


def marked_sources(t):
    """Source datasets with a personal-data column."""
    found = gov.first_pii_type(t.dataset_columns()).select(F.col("dataset").alias("id")).distinct()
    return topology.roots(t.graph[1], t.graph[0]).join(found, "id", "left_semi").select("id")


_SOURCES = f"SELECT DISTINCT dataset AS id FROM ({_FIRST}) WHERE dataset NOT IN (SELECT dst FROM edges)"


@query("v04_pii_flow", "SELECT root, node, depth FROM down WHERE root IN (SELECT id FROM marked) AND node LIKE 'ds_%'", marked=_SOURCES)
def v04(t):
    edges, nodes = t.graph
    return gov.pii_flow(edges, nodes, cut_lineage(marked_sources(t)))


@query("v04_tagged_downstream", f"SELECT root, dataset, column_name FROM down JOIN (SELECT dataset, column_name FROM dataset_columns WHERE {_kind_case(gov.WIDE_PATTERNS)} IS NOT NULL) ON dataset = node WHERE root IN (SELECT id FROM marked)", marked=_SOURCES)
def v04_tagged(t):
    return gov.tagged_downstream(t.graph[0], cut_lineage(marked_sources(t)), gov.auto_classify(t.dataset_columns()))


def tags(t):
    return gov.auto_classify(t.dataset_columns()).withColumn("masked", F.expr("(ds_no + ordinal) % 3 = 0"))


_TAGS = f"SELECT *, (ds_no + ordinal) % 3 = 0 AS masked, CASE WHEN {_kind_case(gov.WIDE_PATTERNS)} IS NULL THEN 'INTERNAL' ELSE 'RESTRICTED' END AS classification FROM dataset_columns"


@query("v05_pii_locations", "SELECT dataset, column_name, classification, masked FROM tags WHERE regexp_matches(column_name, 'email|e_mail|email_addr')", tags=_TAGS)
def v05(t):
    return gov.pii_locations(tags(t), "EMAIL")


@query("v06_erasure_plan_by_dataset", f"""SELECT root, dataset, CASE WHEN root = dataset THEN 'DELETE' WHEN n > 0 THEN 'ANONYMIZE' ELSE 'NOTIFY' END AS action, coalesce(n, 0) AS n_columns FROM (
    SELECT id AS root, id AS dataset FROM marked UNION ALL SELECT root, node FROM down WHERE root IN (SELECT id FROM marked) AND node LIKE 'ds_%') LEFT JOIN (SELECT dataset, count(*) AS n FROM ({_FIRST}) GROUP BY 1) USING (dataset)""", marked=_SOURCES)
def v06(t):
    edges, nodes = t.graph
    subjects = cut_lineage(marked_sources(t))
    return gov.erasure_by_dataset(gov.pii_flow(edges, nodes, subjects), subjects, gov.first_pii_type(t.dataset_columns()))


_REQUESTS = """SELECT 'req_' || user_id AS request_id, min(ts) AS requested_at, ['EMAIL', 'PHONE', 'SSN', 'NAME'][user_id % 4 + 1] AS pii_type FROM events GROUP BY user_id"""
_PLAN = " UNION ALL ".join(
    f"SELECT '{kind}' AS pii_type, dataset, column_name, CASE WHEN masked THEN 'verify_masked' ELSE 'delete' END AS action, CASE WHEN masked THEN 'low' ELSE 'high' END AS priority FROM tags WHERE regexp_matches(column_name, '{'|'.join(words)}')"
    for kind, words in gov.WIDE_PATTERNS.items())


def requests(t):
    return t.read("events").groupBy("user_id").agg(F.min("ts").alias("requested_at")).selectExpr(
        "'req_' || user_id AS request_id", "requested_at", "element_at(array('EMAIL', 'PHONE', 'SSN', 'NAME'), CAST(user_id % 4 AS INT) + 1) AS pii_type", "user_id")


@query("v07_erasure_plan_by_type", _PLAN, tags=_TAGS)
def v07(t):
    return gov.erasure_by_type(tags(t))


@query("v08_erasure_audit", f"""SELECT request_id, coalesce(planned, 0) AS planned, coalesce(done, 0) AS done, CASE WHEN planned > 0 AND coalesce(done, 0) >= planned THEN 'completed' WHEN planned > 0 THEN 'in_progress' ELSE 'pending' END AS status,
    NOT (planned > 0 AND coalesce(done, 0) >= planned) AND DATE '2024-02-10' > CAST(requested_at AS DATE) + 30 AS overdue FROM requests LEFT JOIN (SELECT pii_type, count(*) AS planned FROM plan_rows GROUP BY 1) USING (pii_type)
    LEFT JOIN (SELECT 'req_' || user_id AS request_id, sum(k)::BIGINT AS done FROM ol WHERE event_type = 'error' GROUP BY 1) USING (request_id)""", requests=_REQUESTS, tags=_TAGS, plan_rows=_PLAN)
def v08(t):
    done = t.runs().filter("event_type = 'error'").selectExpr("'req_' || user_id AS request_id", "explode(array_repeat(1, CAST(k AS INT))) AS one")
    audit = gov.erasure_audit(requests(t), gov.erasure_by_type(tags(t)), done, F.lit("2024-02-10").cast("date"))
    return audit.select("request_id", "planned", "done", "status", "overdue")


@query("v09_erasure_execution", "SELECT c_custkey, c_name FROM customer WHERE c_custkey NOT IN (SELECT user_id FROM events WHERE event_type = 'error')")
def v09(t):
    subjects = t.read("events").filter("event_type = 'error'").selectExpr("user_id AS c_custkey")
    return gov.erase_subjects(t.read("customer"), "c_custkey", subjects).select("c_custkey", "c_name")


@query("v09_erasure_masking", "SELECT c_custkey, CASE WHEN c_custkey IN (SELECT user_id FROM events WHERE event_type = 'error') THEN sha256(c_name) ELSE c_name END AS c_name FROM customer")
def v09_mask(t):
    subjects = t.read("events").filter("event_type = 'error'").selectExpr("user_id AS c_custkey")
    return gov.mask_subjects(t.read("customer"), "c_custkey", subjects, ["c_name"]).select("c_custkey", "c_name")


@query("v09_erasure_tables", """SELECT 'customer' AS dataset, c_custkey AS row_id FROM customer WHERE c_custkey NOT IN (SELECT user_id FROM events WHERE event_type = 'error')
    UNION ALL SELECT 'orders', o_orderkey FROM orders WHERE o_custkey NOT IN (SELECT user_id FROM events WHERE event_type = 'error')
    UNION ALL SELECT 'events', event_id FROM events WHERE user_id NOT IN (SELECT user_id FROM events WHERE event_type = 'error')""")
def v09_tables(t):
    subjects = t.read("events").filter("event_type = 'error'").selectExpr("user_id AS subject")
    return gov.erase_everywhere({
        "customer": (t.read("customer"), "c_custkey", "c_custkey"), "orders": (t.read("orders"), "o_custkey", "o_orderkey"), "events": (t.read("events"), "user_id", "event_id")}, subjects)


@query("v10_who_accessed", "SELECT dataset, user_name, access_type, query_hash FROM access_log WHERE accessed_at >= (SELECT max(ts) - INTERVAL 5 DAY FROM events)")
def v10(t):
    since = t.read("events").agg(F.max("ts") - F.expr("INTERVAL 5 DAY"))
    return gov.accesses(t.access_log(), since=since.scalar()).select("dataset", "user_name", "access_type", "query_hash")


@query("v11_pii_accessed", "SELECT event_id, user_name, dataset, array_to_string(list_sort(list_filter(columns, lambda c: c IN ('email', 'first_name'))), ',') AS pii FROM access_log WHERE list_has_any(columns, ['email', 'first_name'])")
def v11(t):
    return gov.pii_accessed(t.access_log(), ["email", "first_name"]).select("event_id", "user_name", "dataset", F.array_join(F.sort_array("pii"), ",").alias("pii"))


@query("v12_tag_propagation", f"SELECT dataset, tag, bool_and(inherited) AS inherited FROM (SELECT dataset, pii_type AS tag, false AS inherited FROM ({_FIRST}) UNION ALL SELECT descendant, pii_type, true FROM closure JOIN ({_FIRST}) f ON f.dataset = ancestor) GROUP BY ALL")
def v12(t):
    return gov.propagate_tags(t.graph[0], gov.first_pii_type(t.dataset_columns()))


# The policy of each kind of personal data: masking and days of retention. Kinds without one are reviewed.
_POLICIES = [("EMAIL", "HASH", 365), ("PHONE", "PARTIAL", 365), ("SSN", "REDACT", 90), ("NAME", "PARTIAL", 730)]
_TAGGED = f"SELECT dataset, tag, bool_and(inherited) AS inherited FROM (SELECT dataset, pii_type AS tag, false AS inherited FROM ({_FIRST}) UNION ALL SELECT descendant, pii_type, true FROM closure JOIN ({_FIRST}) f ON f.dataset = ancestor) GROUP BY ALL"
_ACTIONS = f"""SELECT dataset, tag, inherited, coalesce(masking, 'REVIEW') AS masking, coalesce(retention_days, 0) AS retention_days, CASE WHEN dataset LIKE 'ds_%' THEN 'team_' || split_part(dataset, '_', 2) ELSE '' END AS owner
    FROM ptags LEFT JOIN (VALUES {", ".join(map(str, _POLICIES))}) p(tag, masking, retention_days) USING (tag)"""


def policy_actions(t):
    policies = t.spark.createDataFrame(_POLICIES, "tag string, masking string, retention_days int")
    owners = t.nodes().filter("type = 'dataset'").selectExpr("id AS dataset", "'team_' || split_part(id, '_', 2) AS owner")
    tagged = gov.propagate_tags(t.graph[0], gov.first_pii_type(t.dataset_columns()))
    return gov.apply_policies(tagged, policies, owners)


@query("v12_policy_actions", "SELECT * FROM pactions", ptags=_TAGGED, pactions=_ACTIONS)
def v12_actions(t):
    return policy_actions(t)


@query("v12_notifications", "SELECT DISTINCT unnest([owner, 'governance']) AS recipient, dataset, tag FROM pactions WHERE owner <> '' UNION SELECT 'governance', dataset, tag FROM pactions", ptags=_TAGGED, pactions=_ACTIONS)
def v12_notify(t):
    return gov.notifications(policy_actions(t))


@query("a22_highest_classification", "SELECT id AS dataset, coalesce(['PUBLIC', 'INTERNAL', 'CONFIDENTIAL', 'RESTRICTED'][max(list_position(['PUBLIC', 'INTERNAL', 'CONFIDENTIAL', 'RESTRICTED'], classification))], 'PUBLIC') AS classification FROM nodes LEFT JOIN tags ON dataset = id GROUP BY id", tags=_TAGS)
def a22(t):
    return gov.highest_classification(t.graph[1].select(F.col("id").alias("dataset")), tags(t))


@query("v13_compliance_report", "SELECT DISTINCT dataset, 'team_' || layer AS owner FROM tags WHERE classification = 'RESTRICTED'", tags=_TAGS)
def v13(t):
    tagged = tags(t)
    owners = tagged.selectExpr("dataset", "'team_' || layer AS owner").distinct()
    return gov.highest_classification(owners.select("dataset"), tagged).filter("classification = 'RESTRICTED'").join(owners, "dataset").select("dataset", "owner")


@query("v14_retention_expiry", "SELECT o_orderpriority, count(*) AS n_expired FROM orders WHERE date_diff('day', CAST(o_orderdate AS DATE), DATE '2001-08-01') > CASE WHEN o_orderpriority LIKE '1%' THEN 730 ELSE 365 END GROUP BY 1")
def v14(t):
    days = F.when(F.col("o_orderpriority").startswith("1"), 730).otherwise(365)
    expired = t.read("orders").filter(F.datediff(F.lit("2001-08-01").cast("date"), F.to_date("o_orderdate")) > days)
    return expired.groupBy("o_orderpriority").agg(F.count("*").alias("n_expired"))


_TEXT_SQL = " UNION ALL ".join(
    f"SELECT doc_id, '{k}' AS pii_type, CAST(len(regexp_extract_all(text, '{p}')) AS INTEGER) AS n, 'REDACT' AS action FROM documents WHERE regexp_matches(text, '{p}')" for k, p in gov.TEXT_PATTERNS.items())


@query("v15_pii_in_text", _TEXT_SQL)
def v15(t):
    return gov.scan_text(t.read("documents"), "doc_id", "text")


def _redact_sql() -> str:
    out = "text"
    for kind, pattern in gov.TEXT_PATTERNS.items():
        out = f"regexp_replace({out}, '{pattern}', '[{kind.upper()}]', 'g')"
    return out


@query("v15_redacted_text", f"SELECT doc_id, md5({_redact_sql()}) AS text_hash FROM documents")
def v15_redacted(t):
    return t.read("documents").select("doc_id", F.md5(gov.redact("text")).alias("text_hash"))

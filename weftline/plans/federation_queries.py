"""Registered data-product and cross-domain queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from weftline.operators import federation as fed
from weftline.operators import traversal
from weftline.plans.registry import query
from weftline.session import cut_lineage

_PORTS = "SELECT product, domain, reg_order, 'input' AS role, unnest(input_ports) AS port FROM products UNION ALL SELECT product, domain, reg_order, 'output', unnest(output_ports) FROM products"
_PE = "SELECT DISTINCT CASE WHEN role = 'input' THEN port ELSE product END AS src, CASE WHEN role = 'input' THEN product ELSE port END AS dst FROM ports"
_PW = "SELECT src AS root, dst AS node, 1 AS depth FROM pedges WHERE src LIKE 'job_%' UNION SELECT w.root, e.dst, w.depth + 1 FROM pwalk w JOIN pedges e ON e.src = w.node"
_CTES = {"ports": _PORTS, "pedges": _PE, "pwalk": _PW}


@query("f01_register_products", "SELECT src, dst FROM pedges", **_CTES)
def f01(t):
    return fed.product_edges(t.products())


@query("f02_trace_products_downstream", "SELECT root, node AS product, min(depth) AS depth FROM pwalk WHERE node LIKE 'job_%' GROUP BY ALL", **_CTES)
def f02(t):
    products = cut_lineage(t.products())
    return fed.trace_products(fed.product_edges(products), products, traversal.roots_of(products, "product"), "downstream")


@query("f02_trace_products_upstream", "SELECT node AS root, root AS product, min(depth) AS depth FROM pwalk WHERE node LIKE 'job_%' GROUP BY ALL", **_CTES)
def f02_up(t):
    products = cut_lineage(t.products())
    return fed.trace_products(fed.product_edges(products), products, traversal.roots_of(products, "product"), "upstream")


@query("j06_port_match", "SELECT DISTINCT port, role, product FROM ports WHERE port IN (SELECT port FROM ports WHERE role = 'output' INTERSECT SELECT port FROM ports WHERE role = 'input')", **_CTES)
def j06(t):
    return fed.matched_ports(t.products())


@query("j06_port_match_last", "SELECT producer, consumer, port FROM (SELECT port, arg_max(product, (reg_order, product)) AS producer FROM ports WHERE role = 'output' GROUP BY port) JOIN (SELECT port, arg_max(product, (reg_order, product)) AS consumer FROM ports WHERE role = 'input' GROUP BY port) USING (port)", **_CTES)
def j06_last(t):
    return fed.stitch_last(t.products())


_FQN = "'acme://d' || {l} || '.prod/' || {c}"
_LOCAL = f"SELECT DISTINCT layer, {_FQN.format(l='layer', c='in_a')} AS src, {_FQN.format(l='layer', c='job_name')} AS dst, false AS cross_domain FROM ol UNION SELECT layer, {_FQN.format(l='layer', c='in_b')}, {_FQN.format(l='layer', c='job_name')}, false FROM ol"
_CROSS = f"SELECT DISTINCT layer, {_FQN.format(l='layer', c='job_name')} AS src, {_FQN.format(l='(layer + 1)', c='out_a')} AS dst, true AS cross_domain FROM ol"
_FE = "SELECT src, dst, cross_domain FROM (SELECT * FROM flocal UNION ALL SELECT * FROM fcross) WHERE layer <> 3"
_FW = "SELECT src AS root, dst AS node, 1 AS depth FROM fedges WHERE src NOT IN (SELECT dst FROM fedges) UNION SELECT w.root, e.dst, w.depth + 1 FROM fwalk w JOIN fedges e ON e.src = w.node"
_FED = {"flocal": _LOCAL, "fcross": _CROSS, "fedges": _FE, "fwalk": _FW}


def federated(t):
    """Edges of all domains but the unregistered d3, and the datasets nothing writes."""
    name = lambda layer, c: F.format_string("acme://d%d.prod/%s", F.expr(layer), F.col(c))
    runs = t.runs().select(F.concat(F.lit("d"), "layer").alias("domain"), name("layer", "in_a").alias("a"), name("layer", "in_b").alias("b"),
                           name("layer", "job_name").alias("job"), name("layer + 1", "out_a").alias("out")).distinct()
    local = runs.select("domain", F.explode(F.array("a", "b")).alias("src"), F.col("job").alias("dst")).distinct()
    cross = runs.select("domain", F.col("job").alias("src"), F.col("out").alias("dst")).distinct()
    edges = cut_lineage(fed.federated_edges(local, cross, runs.filter("domain <> 'd3'").select("domain").distinct()))
    roots = edges.select(F.col("src").alias("root")).distinct().join(edges.select(F.col("dst").alias("root")), "root", "left_anti")
    return edges, cut_lineage(roots)


@query("f03_federated_graph", "SELECT root, node, min(depth) AS depth FROM fwalk GROUP BY ALL", **_FED)
def f03(t):
    edges, roots = federated(t)
    return traversal.reach(edges, roots)


@query("f04_affected_domains", "SELECT root, regexp_extract(node, '^[^:]+://([^.]+)', 1) AS domain, count(DISTINCT node) AS n_nodes FROM fwalk GROUP BY ALL", **_FED)
def f04(t):
    edges, roots = federated(t)
    return fed.affected_domains(traversal.reach(edges, roots), F.regexp_extract("node", r"^([^:]+)://([^.]+)\.([^/.]+)/(.+)$", 2))


@query("f04_cross_domain_edges", "SELECT DISTINCT w.root, e.src, e.dst FROM (SELECT root, node FROM fwalk UNION SELECT root, root FROM fwalk) w JOIN fedges e ON e.src = w.node WHERE cross_domain", **_FED)
def f04_edges(t):
    edges, roots = federated(t)
    return fed.leaving_edges(traversal.reach(edges, roots), roots, edges)



@query("f05_freshness_contract", "SELECT product, port, sla_hours, age_hours, age_hours <= sla_hours AS met FROM (SELECT product, sla_hours, unnest(output_ports) AS port FROM products) JOIN ages USING (port)",
       ages="SELECT out_ns || '/' || out_a AS port, date_diff('second', max(ts), (SELECT max(ts) FROM events)) // 3600 AS age_hours FROM ol GROUP BY 1")
def f05(t):
    end = t.read("events").agg(F.max("ts"))
    seen = t.runs().groupBy(F.concat_ws("/", "out_ns", "out_a").alias("port")).agg(F.max("ts").alias("last"))
    ages = seen.select("port", F.expr("last"), F.timestamp_diff("SECOND", F.col("last"), end.scalar()).alias("age_s")).selectExpr("port", "age_s div 3600 AS age_hours")
    return fed.freshness_contract(t.products(), ages)


@query("f06_namespace_conflicts", "SELECT name, count(DISTINCT domain) AS n_domains FROM (SELECT regexp_replace(input, 'ds_[0-9]+_', 'ds_') AS name, layer AS domain FROM triples) GROUP BY name HAVING count(DISTINCT domain) > 1")
def f06(t):
    return fed.name_conflicts(t.triples().select(F.regexp_replace("input", "ds_[0-9]+_", "ds_").alias("name"), F.col("layer").alias("domain")))


@query("u03_contract_validation", """SELECT product, 'Undeclared inputs: ' || in_ns || '/' || in_b AS message FROM (SELECT DISTINCT job_name AS product, in_ns, in_a, in_b FROM ol) WHERE in_a <> in_b
    UNION ALL SELECT DISTINCT job_name, 'Missing outputs: ' || job_name || '_report' FROM ol WHERE job_no % 2 = 0""")
def u03(t):
    contracts = t.products().selectExpr(
        "product", "slice(input_ports, 1, 1) AS declared_in", "input_ports AS actual_in", "if(reg_order % 2 = 0, concat(output_ports, array(product || '_report')), output_ports) AS declared_out", "output_ports AS actual_out")
    return fed.contract_violations(contracts)

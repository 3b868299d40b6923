"""Registered traversal, path and centrality queries over the event-derived graph."""

from __future__ import annotations

from pyspark.sql import functions as F

from weftline.operators import centrality, communities, components, paths, topology, traversal
from weftline.plans.registry import query
from weftline.session import cut_lineage


def source_datasets(t):
    return traversal.roots_of(topology.roots(t.graph[1], t.graph[0]))


def final_datasets(t):
    return traversal.roots_of(topology.leaves(t.graph[1], t.graph[0]))


def source_to_final(t):
    """(root, target) pairs of a source dataset and a final dataset it reaches."""
    finals = final_datasets(t).withColumnRenamed("root", "target")
    reached = traversal.reach(t.graph[0], source_datasets(t)).select("root", F.col("node").alias("target"))
    return cut_lineage(reached.join(finals, "target", "left_semi"))


def joined(column: str):
    return F.concat_ws(">", column).alias(column)


@query("g01_downstream_closure", "SELECT root, node, depth FROM down")
def g01(t):
    edges, nodes = t.graph
    return traversal.reach(edges, source_datasets(t))


@query("g02_upstream_closure", "SELECT root, node, depth FROM up")
def g02(t):
    edges, nodes = t.graph
    return traversal.reach(edges, final_datasets(t), "upstream")


@query("g02_upstream_depth_bound", "SELECT root, node, depth FROM up WHERE depth <= 3")
def g02_bound(t):
    edges, nodes = t.graph
    return traversal.reach(edges, final_datasets(t), "upstream", max_depth=3)


@query("g03_task_slice_from_inputs", """SELECT DISTINCT d.root, d.node AS task, p.role, p.dataset FROM down d JOIN (
    SELECT dst AS task, src AS dataset, 'input' AS role FROM edges UNION ALL SELECT src, dst, 'output' FROM edges) p ON p.task = d.node
    WHERE d.node LIKE 'job_%'""")
def g03_from(t):
    edges, nodes = t.graph
    return topology.task_slice(traversal.reach(edges, source_datasets(t)), nodes, edges)


@query("g03_task_slice_to_outputs", """SELECT DISTINCT d.root, d.node AS task, p.role, p.dataset FROM up d JOIN (
    SELECT dst AS task, src AS dataset, 'input' AS role FROM edges UNION ALL SELECT src, dst, 'output' FROM edges) p ON p.task = d.node
    WHERE d.node LIKE 'job_%'""")
def g03_to(t):
    edges, nodes = t.graph
    return topology.task_slice(traversal.reach(edges, final_datasets(t), "upstream"), nodes, edges)


@query("g04_bounded_bfs", """SELECT root, node, depth, position FROM (SELECT *, CAST(row_number() OVER (PARTITION BY root ORDER BY depth, node) AS INTEGER) AS position
    FROM down WHERE depth <= 5) WHERE position <= 10""")
def g04(t):
    edges, nodes = t.graph
    return traversal.bounded_reach(edges, source_datasets(t), max_depth=5, max_nodes=10)


_BOTH = """SELECT DISTINCT a.root, e.src, e.dst FROM inside a JOIN edges e ON e.src = a.node JOIN inside b ON b.root = a.root AND b.node = e.dst"""
_INSIDE = """SELECT root, node FROM set_down UNION SELECT root, node FROM set_up UNION SELECT id, id FROM nodes WHERE type = 'dataset'"""
_SET_DOWN = """SELECT src AS root, dst AS node FROM edges WHERE src LIKE 'ds_%' UNION SELECT w.root, e.dst FROM set_down w JOIN edges e ON e.src = w.node"""
_SET_UP = """SELECT dst AS root, src AS node FROM edges WHERE dst LIKE 'ds_%' UNION SELECT w.root, e.src FROM set_up w JOIN edges e ON e.dst = w.node"""


@query("g05_lineage_subgraph", _BOTH, inside=_INSIDE, set_down=_SET_DOWN, set_up=_SET_UP)
def g05(t):
    edges, nodes = t.graph
    return traversal.lineage_subgraph(edges, traversal.roots_of(nodes.filter("type = 'dataset'")))


@query("g06_impact_analysis", """SELECT root, count(*) AS total, count(*) FILTER (type = 'dataset') AS datasets,
    count(*) FILTER (type = 'job') AS jobs, max(depth) AS max_depth
    FROM down JOIN nodes ON id = node GROUP BY root""")
def g06(t):
    edges, nodes = t.graph
    return traversal.impact_counts(traversal.reach(edges, source_datasets(t)), nodes)


@query("g06_impact_nodes", "SELECT root, node, type, namespace, depth FROM down JOIN nodes ON id = node")
def g06_nodes(t):
    edges, nodes = t.graph
    reached = traversal.reach(edges, source_datasets(t))
    return reached.join(nodes.withColumnRenamed("id", "node"), "node").select("root", "node", "type", "namespace", "depth")


@query("g07_impact_radius", """SELECT root, count(*) FILTER (depth = 1) AS direct, count(*) FILTER (depth <= 2) AS depth_2,
    count(*) FILTER (depth <= 5) AS depth_5, count(*) AS total FROM down GROUP BY root""")
def g07(t):
    edges, nodes = t.graph
    return traversal.impact_radius(traversal.reach(edges, source_datasets(t)))


@query("g08_blast_radius", """SELECT root, round(100.0::DOUBLE * count(*) / (SELECT count(*) FROM nodes), 6) AS pct FROM down GROUP BY root""")
def g08(t):
    edges, nodes = t.graph
    size = nodes.agg(F.count("*"))
    return traversal.reach(edges, source_datasets(t)).groupBy("root").agg(F.count("*").alias("n")).select(
        "root", F.round(F.lit(100.0) * F.col("n") / size.scalar(), 6).alias("pct"))


@query("g09_closure_table", "SELECT ancestor, descendant, depth FROM closure")
def g09(t):
    return traversal.closure_table(t.graph[0])


@query("g09_closure_incremental", "SELECT ancestor, descendant, depth FROM closure")
def g09_incremental(t):
    edges, _ = t.graph
    fresh = "startswith(src, 'job_2_')"
    return traversal.extend_closure(traversal.closure_table(edges.filter(f"NOT {fresh}")), edges.filter(fresh))


_SIMPLE = """SELECT src AS root, dst AS node, [src, dst] AS path FROM edges WHERE src NOT IN (SELECT dst FROM edges)
    UNION ALL SELECT w.root, e.dst, list_append(w.path, e.dst) FROM simple_walk w JOIN edges e ON e.src = w.node WHERE NOT list_contains(w.path, e.dst)"""


@query("g10_simple_paths", "SELECT root, node AS target, array_to_string(path, '>') AS path FROM simple_walk WHERE node NOT IN (SELECT src FROM edges)", simple_walk=_SIMPLE)
def g10(t):
    edges, nodes = t.graph
    pairs = source_to_final(t)
    return paths.simple_paths(edges, pairs).select("root", "target", joined("path"))


@query("g11_shortest_path", """SELECT root, node, len(p) - 1 AS depth, array_to_string(p, '>') AS path FROM (
    SELECT root, node, min({'n': len(path), 'p': path}).p AS p FROM simple_walk GROUP BY root, node)""", simple_walk=_SIMPLE)
def g11(t):
    edges, nodes = t.graph
    return paths.shortest_paths(edges, source_datasets(t)).select("root", "node", F.col("depth").cast("long").alias("depth"), joined("path"))


@query("g11_shortest_path_node_limit", """SELECT root, node, len(p) - 1 AS depth FROM (
    SELECT root, node, min({'n': len(path), 'p': path}).p AS p FROM simple_walk GROUP BY root, node) WHERE len(p) <= 7""", simple_walk=_SIMPLE)
def g11_limit(t):
    edges, nodes = t.graph
    return paths.shortest_paths(edges, source_datasets(t), max_nodes=7).select("root", "node", F.col("depth").cast("long").alias("depth"))


_UND = "SELECT src, dst FROM edges UNION SELECT dst, src FROM edges"
_UND_WALK = """(root, node, depth) USING KEY (root, node) AS (SELECT DISTINCT src, src, 0 FROM edges WHERE src NOT IN (SELECT dst FROM edges)
    UNION SELECT DISTINCT w.root, e.dst, w.depth + 1 FROM und_walk w JOIN und_links e ON e.src = w.node
    WHERE NOT EXISTS (SELECT 1 FROM recurring.und_walk r WHERE r.root = w.root AND r.node = e.dst))"""


@query("g11_shortest_path_undirected", "SELECT root, node, depth FROM und_walk WHERE depth > 0", und_links=_UND, und_walk=_UND_WALK)
def g11_undirected(t):
    edges, nodes = t.graph
    return paths.shortest_paths(edges, source_datasets(t), undirected=True).select("root", "node", "depth")


def dataset_pairs(t):
    """The final datasets that each source reaches, and a final dataset for each dataset, most of which it can't reach."""
    nodes = t.graph[1].filter("type = 'dataset'").selectExpr("id AS root", "CAST(split_part(id, '_', 3) AS BIGINT) AS n")
    others = nodes.selectExpr("root", f"'ds_5_' || ((n div 5 * 5 + 2 + n % 2) % {24 * t.scale}) AS target")
    return source_to_final(t).select("root", "target").unionByName(others).distinct()


_PAIRS = """SELECT root, node AS target FROM down WHERE node NOT IN (SELECT src FROM edges) UNION SELECT id, 'ds_5_' || ((n // 5 * 5 + 2 + n % 2) % (24 * s))
    FROM (SELECT id, CAST(split_part(id, '_', 3) AS BIGINT) AS n FROM nodes WHERE type = 'dataset'), sc"""
# How far every node is from each wanted target, then from each root the least name that is one nearer.
_FAR = """(target, node, depth) USING KEY (target, node) AS (SELECT DISTINCT target, target, 0 FROM wanted WHERE target IN (SELECT id FROM nodes)
    UNION SELECT DISTINCT w.target, e.src, w.depth + 1 FROM far w JOIN {links} e ON e.dst = w.node
    WHERE NOT EXISTS (SELECT 1 FROM recurring.far r WHERE r.target = w.target AND r.node = e.src))"""
_NEARER = """SELECT a.target, a.node, min(e.dst) AS next FROM far a JOIN {links} e ON e.src = a.node
    JOIN far b ON b.target = a.target AND b.node = e.dst AND b.depth = a.depth - 1 GROUP BY ALL"""
_READ = """SELECT w.root, w.target, f.depth, w.root AS node, [w.root] AS path FROM wanted w JOIN far f ON f.target = w.target AND f.node = w.root
    UNION ALL SELECT r.root, r.target, r.depth, n.next, list_append(r.path, n.next) FROM read_off r JOIN nearer n ON n.target = r.target AND n.node = r.node"""
_BETWEEN = "SELECT root, target, CAST(depth AS INTEGER) AS depth, array_to_string(path, '>') AS path FROM read_off WHERE node = target"


@query("g11_shortest_path_between", _BETWEEN, wanted=_PAIRS, far=_FAR.format(links="edges"), nearer=_NEARER.format(links="edges"), read_off=_READ)
def g11_between(t):
    return paths.shortest_path_between(t.graph[0], dataset_pairs(t)).select("root", "target", "depth", joined("path"))


@query("g11_shortest_path_between_undirected", _BETWEEN, wanted=_PAIRS, und_links=_UND, far=_FAR.format(links="und_links"), nearer=_NEARER.format(links="und_links"), read_off=_READ)
def g11_between_undirected(t):
    return paths.shortest_path_between(t.graph[0], dataset_pairs(t), undirected=True).select("root", "target", "depth", joined("path"))


@query("g12_dag_check", "SELECT count(*) = 0 AS is_dag FROM all_walk WHERE ancestor = descendant")
def g12(t):
    return paths.cycle_members(t.graph[0]).agg((F.count("*") == 0).alias("is_dag"))


def with_retries(t):
    """The graph with an edge from the output of a failed run back to its job."""
    retries = t.runs().filter("state = 'FAIL'").selectExpr("out_a AS src", "job_name AS dst").distinct()
    return t.graph[0].select("src", "dst").unionByName(retries)


_LOOPED = "SELECT src, dst FROM edges UNION SELECT out_a, job_name FROM ol WHERE state = 'FAIL'"
_LOOP_WALK = """SELECT src AS a, dst AS b FROM looped UNION SELECT w.a, e.dst FROM loop_walk w JOIN looped e ON e.src = w.b"""


@query("g12_strong_components", """SELECT a.a AS node, min(a.b) AS component FROM loop_walk a JOIN loop_walk b ON b.a = a.b AND b.b = a.a GROUP BY a.a""", looped=_LOOPED, loop_walk=_LOOP_WALK)
def g12_components(t):
    return components.strong_components(with_retries(t))


@query("g12_cycle_members", "SELECT a AS node FROM loop_walk WHERE a = b", looped=_LOOPED, loop_walk=_LOOP_WALK)
def g12_members(t):
    return paths.cycle_members(with_retries(t))


_LEVEL = """SELECT id AS node, 0 AS hops FROM nodes WHERE id NOT IN (SELECT dst FROM edges)
    UNION SELECT e.dst, w.hops + 1 FROM level_walk w JOIN edges e ON e.src = w.node"""


@query("g13_topological_levels", "SELECT node, max(hops) AS level FROM level_walk GROUP BY node", level_walk=_LEVEL)
def g13(t):
    return paths.topological_levels(t.graph[0])


@query("g14_longest_path_length", "SELECT node, max(hops) + 1 AS length FROM level_walk GROUP BY node", level_walk=_LEVEL)
def g14(t):
    return paths.longest_paths(t.graph[0]).select("node", "length")


_LONG = """SELECT id AS node, [id] AS path FROM nodes WHERE id NOT IN (SELECT dst FROM edges)
    UNION ALL SELECT e.dst, list_append(w.path, e.dst) FROM long_walk w JOIN edges e ON e.src = w.node"""


@query("g14_longest_chains", """SELECT node, CAST(len(path) AS INTEGER) AS length, array_to_string(path, '>') AS path FROM (
      SELECT node, path, row_number() OVER (PARTITION BY node ORDER BY len(path) DESC, path) AS rn FROM long_walk
      WHERE node NOT IN (SELECT src FROM edges)) WHERE rn = 1
    ORDER BY len(path) DESC, path LIMIT 5""", long_walk=_LONG)
def g14_chains(t):
    chains = paths.longest_chains(t.graph[0])
    return chains.select("node", "length", joined("path"))


@query("g15_free_inputs", "SELECT id, type, namespace FROM nodes WHERE type = 'dataset' AND id NOT IN (SELECT dst FROM edges)")
def g15(t):
    edges, nodes = t.graph
    return topology.roots(nodes, edges)


@query("g16_terminal_outputs", "SELECT id, type, namespace FROM nodes WHERE type = 'dataset' AND id NOT IN (SELECT src FROM edges)")
def g16(t):
    edges, nodes = t.graph
    return topology.leaves(nodes, edges)


@query("g17_unused_datasets", """SELECT id, type, namespace FROM nodes WHERE type = 'dataset' AND id NOT IN (SELECT src FROM edges)
    AND id NOT IN (SELECT out_a FROM ol GROUP BY out_a HAVING count(*) FILTER (event_type = 'purchase') > 3)""")
def g17(t):
    edges, nodes = t.graph
    shown = t.runs().groupBy(F.col("out_a").alias("id")).agg(F.count_if(F.col("event_type") == "purchase").alias("shown")).filter("shown > 3")
    return topology.unused_datasets(nodes, edges, shown)


@query("g18_degree_ranking", """SELECT id, CAST(sum(incoming) AS BIGINT) AS in_degree, CAST(sum(outgoing) AS BIGINT) AS out_degree, count(*) AS total FROM (
    SELECT src AS id, 1 AS outgoing, 0 AS incoming FROM edges UNION ALL SELECT dst, 0, 1 FROM edges) GROUP BY id""")
def g18(t):
    return centrality.degrees(t.graph[0])


@query("g18_top_hubs", """SELECT id, CAST(sum(incoming) AS BIGINT) AS writers, CAST(sum(outgoing) AS BIGINT) AS readers, count(*) AS total FROM (
    SELECT src AS id, 1 AS outgoing, 0 AS incoming FROM edges UNION ALL SELECT dst, 0, 1 FROM edges)
    WHERE id LIKE 'ds_%' GROUP BY id ORDER BY total DESC, id LIMIT 10""")
def g18_hubs(t):
    edges, nodes = t.graph
    datasets = centrality.degrees(edges).join(nodes.filter("type = 'dataset'").select("id"), "id", "left_semi")
    return datasets.orderBy(F.desc("total"), "id").limit(10).select(
        "id", F.col("in_degree").alias("writers"), F.col("out_degree").alias("readers"), "total")


_RANK_WALK = """SELECT id, 1.0::DOUBLE / (SELECT count(*) FROM nodes) AS mass FROM nodes
    UNION ALL SELECT s.dst, w.mass * s.share FROM rank_walk w JOIN shares s ON s.src = w.id"""
_SHARES = "SELECT src, dst, 0.85::DOUBLE / count(*) OVER (PARTITION BY src) AS share FROM (SELECT DISTINCT src, dst FROM edges)"


@query("g19_pagerank", "SELECT id, round(sum(mass) / (SELECT sum(mass) FROM rank_walk), 9) AS rank FROM rank_walk GROUP BY id", shares=_SHARES, rank_walk=_RANK_WALK)
def g19(t):
    return centrality.pagerank(t.graph[0]).select("id", F.round("rank", 9).alias("rank"))


_BC = """SELECT id, round(coalesce(raw, 0) / ((n - 1) * (n - 2)), 9) AS score FROM nodes
    CROSS JOIN (SELECT count(*)::DOUBLE AS n FROM nodes) LEFT JOIN (
      SELECT a.descendant AS id, sum(a.c * b.c / p.c) AS raw FROM spc a JOIN spc b ON b.ancestor = a.descendant
      JOIN spc p ON p.ancestor = a.ancestor AND p.descendant = b.descendant AND p.depth = a.depth + b.depth GROUP BY 1) USING (id)"""
_WALKS = """SELECT src AS ancestor, dst AS descendant, 1 AS depth FROM edges
    UNION ALL SELECT w.ancestor, e.dst, w.depth + 1 FROM every_walk w JOIN edges e ON e.src = w.descendant"""
_SPC = """SELECT ancestor, descendant, depth, count(*)::DOUBLE AS c FROM every_walk
    WHERE (ancestor, descendant, depth) IN (SELECT (ancestor, descendant, depth) FROM closure) GROUP BY ALL"""


@query("g20_betweenness", _BC, every_walk=_WALKS, spc=_SPC)
def g20(t):
    return centrality.betweenness(t.graph[0]).select("id", F.round("score", 9).alias("score"))


_DEGREES = """SELECT id, CAST(sum(incoming) AS BIGINT) AS in_degree, CAST(sum(outgoing) AS BIGINT) AS out_degree, count(*) AS total FROM (
    SELECT src AS id, 1 AS outgoing, 0 AS incoming FROM edges UNION ALL SELECT dst, 0, 1 FROM edges) GROUP BY id"""


@query("g20_critical_nodes", f"""SELECT id, score, in_degree, out_degree, total, rank FROM ({_BC}) JOIN ({_DEGREES}) USING (id)
    JOIN (SELECT id, round(sum(mass) / (SELECT sum(mass) FROM rank_walk), 9) AS rank FROM rank_walk GROUP BY id) USING (id) ORDER BY score DESC, id LIMIT 5""",
       every_walk=_WALKS, spc=_SPC, shares=_SHARES, rank_walk=_RANK_WALK)
def g20_top(t):
    best = centrality.critical_nodes(t.graph[0], top_n=5)
    return best.withColumns({"score": F.round("score", 9), "rank": F.round("rank", 9)})


_COMP_WALK = """SELECT id AS a, id AS b FROM nodes UNION SELECT w.a, e.dst FROM comp_walk w JOIN und_links e ON e.src = w.b"""


@query("g21_components", "SELECT a AS id, min(b) AS component FROM comp_walk GROUP BY a", und_links=_UND, comp_walk=_COMP_WALK)
def g21(t):
    return centrality.components(t.graph[0])


_SYM = "SELECT src, dst FROM und_links UNION SELECT id, id FROM nodes"


def _label_round(done: int) -> str:
    """Labels after ``done`` rounds of propagation."""
    if done == 0:
        return "SELECT id, id AS community FROM nodes"
    return (f"SELECT src AS id, arg_min(community, (-votes, community)) AS community FROM (SELECT s.src, l.community, count(*) AS votes "
            f"FROM sym_links s JOIN label_{done - 1} l ON l.id = s.dst GROUP BY ALL) GROUP BY src")


# No label moves from the fifth to the sixth round, or the oracle has no rows.
@query("g21_communities", "SELECT id, community FROM label_6 WHERE NOT EXISTS (SELECT * FROM label_5 EXCEPT SELECT * FROM label_6)", und_links=_UND, sym_links=_SYM, **{f"label_{i}": _label_round(i) for i in range(7)})
def g21_communities(t):
    return centrality.communities(t.graph[0])


@query("g21_louvain")
def g21_louvain(t):
    """Communities of the greatest modularity that local moves reach; tests hold it against the best partition of small graphs."""
    return communities.louvain(t.graph[0])


@query("g22_bipartite_check", "SELECT src, dst, 'dataset' AS type FROM (SELECT DISTINCT in_a AS src, out_a AS dst FROM ol UNION SELECT src, dst FROM edges) WHERE src LIKE 'ds_%' AND dst LIKE 'ds_%'")
def g22(t):
    edges, nodes = t.graph
    shortcuts = t.runs().selectExpr("in_a AS src", "out_a AS dst").distinct()
    return topology.type_violations(nodes, edges.select("src", "dst").unionByName(shortcuts))


@query("g23_graph_stats", """SELECT 'total_nodes' AS stat, count(*) AS value FROM nodes UNION ALL SELECT 'total_edges', count(*) FROM (SELECT DISTINCT src, dst FROM edges)
    UNION ALL SELECT 'nodes:' || type, count(*) FROM nodes GROUP BY type""")
def g23(t):
    edges, nodes = t.graph
    return topology.graph_stats(nodes, edges)


_CATALOG = """SELECT in_a AS id, 'team_' || min(layer) AS owner, bool_or(event_type = 'error') AS contains_pii FROM ol GROUP BY in_a"""


@query("g24_enriched_nodes", """SELECT n.id, n.type, n.namespace, coalesce(du, 0) AS direct_upstream, coalesce(dd, 0) AS direct_downstream,
    coalesce(tu, 0) AS total_upstream, coalesce(td, 0) AS total_downstream, coalesce(owner, 'none') AS owner,
    CASE WHEN contains_pii THEN 'RESTRICTED' WHEN contains_pii IS NULL THEN 'UNKNOWN' ELSE 'INTERNAL' END AS classification,
    coalesce(contains_pii, false) AS contains_pii FROM nodes n
    LEFT JOIN (SELECT dst AS id, count(*) AS du FROM edges GROUP BY 1) USING (id) LEFT JOIN (SELECT src AS id, count(*) AS dd FROM edges GROUP BY 1) USING (id)
    LEFT JOIN (SELECT descendant AS id, count(*) AS tu FROM closure GROUP BY 1) USING (id) LEFT JOIN (SELECT ancestor AS id, count(*) AS td FROM closure GROUP BY 1) USING (id)
    LEFT JOIN catalog USING (id)""", catalog=_CATALOG)
def g24(t):
    edges, nodes = t.graph
    catalog = t.runs().groupBy(F.col("in_a").alias("id")).agg(
        F.concat(F.lit("team_"), F.min("layer")).alias("owner"), F.bool_or(F.col("event_type") == "error").alias("contains_pii"),
    ).withColumn("classification", F.when(F.col("contains_pii"), "RESTRICTED").otherwise("INTERNAL"))
    return topology.enrich_nodes(nodes, edges, traversal.closure_table(edges), catalog)


@query("g25_paths_with_hops", """SELECT root, node AS target, array_to_string(path, ' -> ') AS names, CAST(len(path) - 1 AS INTEGER) AS hops
    FROM simple_walk WHERE node NOT IN (SELECT src FROM edges)""", simple_walk=_SIMPLE)
def g25(t):
    edges, nodes = t.graph
    pairs = source_to_final(t)
    found = paths.simple_paths(edges, pairs)
    return found.select("root", "target", F.concat_ws(" -> ", "path").alias("names"), (F.size("path") - 1).alias("hops"))


_KEPT = "SELECT src, dst FROM edges WHERE src NOT IN (SELECT job FROM failing) AND dst NOT IN (SELECT job FROM failing)"
_FAILING = "SELECT job_name AS job FROM ol WHERE layer = 2 GROUP BY job_name HAVING count(*) FILTER (state = 'FAIL') > 3"
_KEPT_WALK = """SELECT src AS root, dst AS node FROM kept_links WHERE src NOT IN (SELECT dst FROM edges) UNION SELECT w.root, e.dst FROM kept_walk w JOIN kept_links e ON e.src = w.node"""


@query("g26_broken_links", """SELECT root, node FROM down WHERE node NOT IN (SELECT job FROM failing) EXCEPT SELECT root, node FROM kept_walk""",
       kept_links=_KEPT, failing=_FAILING, kept_walk=_KEPT_WALK)
def g26(t):
    edges, nodes = t.graph
    failing = t.runs().filter("layer = 2").groupBy(F.col("job_name").alias("id")).agg(
        F.count_if(F.col("state") == "FAIL").alias("fails")).filter("fails > 3")
    return topology.broken_by_removal(edges, source_datasets(t), cut_lineage(failing))


_ENTITY_WALK = """SELECT src AS root, dst AS node, 1 AS depth FROM entity_edges WHERE src LIKE 'supplier:%' OR src LIKE 'part:%'
    UNION SELECT w.root, e.dst, w.depth + 1 FROM entity_walk w JOIN entity_edges e ON e.src = w.node"""


@query("g06_entity_impact", """SELECT root, count(*) AS reached, count(*) FILTER (node LIKE 'order:%') AS orders, count(*) FILTER (node LIKE 'customer:%') AS customers
    FROM (SELECT root, node, min(depth) AS depth FROM entity_walk GROUP BY root, node) GROUP BY root""", entity_walk=_ENTITY_WALK)
def g06_entity(t):
    # Pairs of numbers are a third of the bytes of pairs of names; a layer's depth says what its nodes are.
    found = traversal.layered_reach(t.entity_keys()).groupBy("root").agg(
        F.count("*").alias("reached"), F.count_if(F.col("depth") == 1).alias("orders"), F.count_if(F.col("depth") == 2).alias("customers"))
    return found.selectExpr("if(root % 2 = 0, 'part:', 'supplier:') || (root div 2) AS root", "reached", "orders", "customers")

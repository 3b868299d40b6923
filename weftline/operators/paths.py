"""Path enumeration, shortest and longest paths, levels and cycles."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from weftline.operators.components import require_acyclic, strong_components
from weftline.operators.traversal import HOPS_PER_ROUND, flow, reach, roots_of, stored_flow
from weftline.session import cut_lineage

SEEN_PER_CUT = 12


def simple_paths(edges: DataFrame, pairs: DataFrame, hops_per_round: int = HOPS_PER_ROUND) -> DataFrame:
    """(root, target, path) for every simple path of each (root, target) pair.

    Walks start at the root and only enter nodes from which the target can be reached, so no dead branch is
    expanded and no path has to be dropped. What is stored for that is (target, node), not (root, target, node).
    """
    steps = stored_flow(edges, "downstream")
    pairs = pairs.select("root", "target").distinct()
    behind = cut_lineage(reach(steps, roots_of(pairs, "target"), "upstream", include_root=True).select(F.col("root").alias("target"), "node"))
    allowed = behind.withColumnRenamed("node", "dst")
    live = pairs.join(behind.withColumnRenamed("node", "root"), ["root", "target"], "left_semi").select(
        "root", "target", F.array("root").alias("path"))
    arrived = F.element_at("path", -1) == F.col("target")
    finished = None
    while True:
        step, found = live, None
        for hop in range(1, hops_per_round + 1):
            step = (
                step.withColumn("src", F.element_at("path", -1)).join(steps, "src")
                .join(allowed, ["target", "dst"], "left_semi")
                .filter(~F.array_contains("path", F.col("dst")))
                .select("root", "target", F.concat("path", F.array("dst")).alias("path"))
            )
            at = step.withColumn("hop", F.lit(hop))
            found = at if found is None else found.unionByName(at)
            step = step.filter(~arrived)
        found = cut_lineage(found)
        ended = found.filter(arrived).drop("hop")
        finished = ended if finished is None else finished.unionByName(ended)
        live = found.filter((F.col("hop") == hops_per_round) & ~arrived).drop("hop")
        if live.isEmpty():
            return finished


def shortest_paths(
    edges: DataFrame, roots: DataFrame, max_nodes: int | None = None, undirected: bool = False,
    hops_per_round: int = HOPS_PER_ROUND,
) -> DataFrame:
    """(root, node, depth, path): one shortest path per reached node, smallest names first.

    ``max_nodes`` drops paths with more nodes than that. Unreachable nodes have no row.
    """
    steps = flow(edges, "downstream")
    if undirected:
        steps = steps.unionByName(flow(edges, "upstream")).distinct()
    steps = cut_lineage(steps).filter("src IS NOT NULL AND dst IS NOT NULL")
    limit = None if max_nodes is None else max_nodes - 1
    seen = roots.select("root", F.col("root").alias("node"), F.lit(0).alias("depth"), F.array("root").alias("path")).distinct()
    frontier, level = seen, 0
    while limit is None or level < limit:
        hops = hops_per_round if limit is None else min(hops_per_round, limit - level)
        step, found = frontier, None
        for hop in range(1, hops + 1):
            step = (
                step.select("root", F.col("node").alias("src"), "path").join(steps, "src")
                .groupBy("root", F.col("dst").alias("node"))
                .agg(F.min(F.concat("path", F.array("dst"))).alias("path"))
            )
            at = step.withColumn("hop", F.lit(hop))
            found = at if found is None else found.unionByName(at)
        fresh = cut_lineage(
            found.unionByName(seen.select("root", "node", "path", F.lit(0).alias("hop")))
            .groupBy("root", "node").agg(F.min(F.struct("hop", "path")).alias("best")).filter("best.hop > 0")
            .select("root", "node", "best.hop", (F.size("best.path") - 1).alias("depth"), "best.path")
        )
        seen = seen.unionByName(fresh.drop("hop"))
        level += hops
        frontier = fresh.filter(F.col("hop") == hops)
        if frontier.isEmpty():
            break
    return seen.filter("depth > 0")


def named_walks(edges: DataFrame, keep_path: bool, hops_per_round: int = HOPS_PER_ROUND) -> DataFrame:
    """(node, hops[, path]): every length at which a node is met when walking from the roots.

    Each length keeps its smallest path. The graph must be acyclic; a cycle raises before the first step.
    """
    steps = stored_flow(edges, "downstream")
    require_acyclic(steps)
    starts = steps.select(F.col("src").alias("node")).distinct().join(
        steps.select(F.col("dst").alias("node")), "node", "left_anti")
    path = F.array("node") if keep_path else F.array().cast("array<string>")
    frontier = starts.select("node", F.lit(0).alias("hops"), path.alias("path"))
    walks = frontier
    while True:
        step, found = frontier, None
        for hop in range(1, hops_per_round + 1):
            longer = F.concat("path", F.array("dst")) if keep_path else F.col("path")
            step = (
                step.select(F.col("node").alias("src"), "path", "hops").join(steps, "src")
                .groupBy(F.col("dst").alias("node"), (F.col("hops") + 1).alias("hops")).agg(F.min(longer).alias("path"))
            )
            at = step.withColumn("hop", F.lit(hop))
            found = at if found is None else found.unionByName(at)
        found = cut_lineage(found)
        walks = walks.unionByName(found.drop("hop"))
        frontier = found.filter(F.col("hop") == hops_per_round)
        if frontier.isEmpty():
            return walks if keep_path else walks.drop("path")


def topological_levels(edges: DataFrame) -> DataFrame:
    """(node, level): longest distance from any root; ascending levels are a safe order."""
    return named_walks(edges, keep_path=False).groupBy("node").agg(F.max("hops").alias("level"))


def longest_paths(edges: DataFrame) -> DataFrame:
    """(node, length, path): the longest chain ending in each node; ties give the smallest path."""
    best = named_walks(edges, keep_path=True).groupBy("node").agg(
        F.min(F.struct((-F.col("hops")).alias("order"), "path")).alias("best"))
    return best.select("node", (-F.col("best.order") + 1).alias("length"), "best.path")


def longest_chains(edges: DataFrame, top_n: int = 5) -> DataFrame:
    """The longest source-to-sink chains."""
    sinks = longest_paths(edges).join(edges.select(F.col("src").alias("node")), "node", "left_anti")
    return sinks.orderBy(F.desc("length"), "path").limit(top_n)


def cycle_members(edges: DataFrame) -> DataFrame:
    """Nodes that can reach themselves; empty iff the graph is acyclic."""
    return strong_components(edges).select("node")


# Paths of pairs.

def shortest_path_nodes(edges: DataFrame, pairs: DataFrame, undirected: bool = False, max_nodes: int | None = None, hops_per_round: int = HOPS_PER_ROUND) -> DataFrame:
    """(root, target, position, node): the nodes of one shortest path of each (root, target) pair, of all of them the one of the smallest names.

    Each pair has two frontiers, one that walks from the root and one that walks against the edges from the target. Of every
    pair the smaller one takes the next step, until a node is in both. A node keeps the least neighbour that leads on to the target; on the
    root's side that is found by walking back from the nodes where the two met. The path is then read off from these pointers. No row
    holds a path. A pair without a path, with more nodes than ``max_nodes``, or with an end that no edge has gives no row.
    """
    ways = flow(edges, "downstream")
    if undirected:
        ways = ways.unionByName(flow(edges, "upstream")).distinct()
    ways = cut_lineage(ways).filter("src IS NOT NULL AND dst IS NOT NULL")
    steps = cut_lineage(ways.select(F.lit("f").alias("side"), F.col("src").alias("at"), F.col("dst").alias("next")).unionByName(
        ways.select(F.lit("b").alias("side"), F.col("dst").alias("at"), F.col("src").alias("next"))))
    ends = ways.selectExpr("explode(array(src, dst)) AS id").distinct()
    known = pairs.select("root", "target").distinct().join(ends.withColumnRenamed("id", "root"), "root", "left_semi").join(
        ends.withColumnRenamed("id", "target"), "target", "left_semi")
    named = cut_lineage(known.select("root", "target").withColumn("pair", F.monotonically_increasing_id()))
    start = F.expr("inline(array(named_struct('side', 'f', 'node', root), named_struct('side', 'b', 'node', target)))")
    frontier = cut_lineage(named.filter("root <> target").select("pair", start).select("pair", "side", "node", F.lit(0).alias("depth"), F.lit(None).cast("string").alias("toward")))
    seen, meets, length = frontier, None, 0
    while not frontier.isEmpty() and (max_nodes is None or length < max_nodes - 1):
        sizes = frontier.groupBy("pair").agg(F.count_if(F.col("side") == "f").alias("fs"), F.count_if(F.col("side") == "b").alias("bs"))
        # A side that has no frontier left has found all it can reach without meeting the other.
        turn = sizes.filter("fs > 0 AND bs > 0").select("pair", F.expr("if(fs <= bs, 'f', 'b')").alias("turn"))
        due = cut_lineage(frontier.join(turn, "pair"))
        grown = due.filter("side = turn").join(steps, (F.col("node") == F.col("at")) & (due["side"] == steps["side"])).groupBy("pair", due["side"], F.col("next").alias("node")).agg(
            (F.min("depth") + 1).alias("depth"), F.min("node").alias("toward"))
        fresh = cut_lineage(grown.join(seen, ["pair", "side", "node"], "left_anti"))
        other = seen.select("pair", "node", F.expr("if(side = 'f', 'b', 'f')").alias("side"), F.col("depth").alias("opposite"))
        met = cut_lineage(fresh.join(other, ["pair", "side", "node"]).select(
            "pair", "node", F.expr("if(side = 'f', depth, opposite)").alias("depth"), F.expr("depth + opposite").alias("length")))
        seen = seen.unionByName(fresh)
        meets = met if meets is None else meets.unionByName(met)
        waiting = due.filter("side <> turn").drop("turn").unionByName(fresh)
        frontier = cut_lineage(waiting.join(met.select("pair"), "pair", "left_anti"))
        length += 1
        if length % SEEN_PER_CUT == 0:
            seen = cut_lineage(seen)
    same = named.filter("root = target").select("root", "target", F.lit(0).alias("position"), F.col("root").alias("node"))
    if meets is None:
        return same
    seen, meets = cut_lineage(seen), cut_lineage(meets)
    lengths = meets.select("pair", "length").distinct()
    # From the meeting nodes back to the root: every node there on a shortest path, with its least follower.
    back, forth = steps.filter("side = 'b'").select("at", F.col("next").alias("prior")), seen.filter("side = 'f'").select("pair", F.col("node").alias("prior"), F.col("depth").alias("prior_depth"))
    marked, pointers = meets.select("pair", "node", "depth"), seen.filter("side = 'b' AND toward IS NOT NULL").select("pair", "node", F.col("toward").alias("next"))
    pointers = pointers.join(lengths.select("pair"), "pair", "left_semi")
    while not marked.isEmpty():
        step, found = marked, None
        for hop in range(1, hops_per_round + 1):
            step = step.filter("depth > 0").join(back, F.col("node") == F.col("at")).join(forth, ["pair", "prior"]).filter("prior_depth = depth - 1").groupBy(
                "pair", F.col("prior").alias("node")).agg(F.min("node").alias("next"), F.min("prior_depth").alias("depth"))
            at = step.withColumn("hop", F.lit(hop))
            found = at if found is None else found.unionByName(at)
        found = cut_lineage(found)
        pointers = pointers.unionByName(found.select("pair", "node", "next"))
        marked = found.filter(F.col("hop") == hops_per_round).select("pair", "node", "depth")
    pointers = cut_lineage(pointers)
    walk = cut_lineage(named.join(lengths, "pair").select("pair", F.lit(0).alias("position"), F.col("root").alias("node"), "length"))
    read = walk
    while not walk.isEmpty():
        step, found = walk, None
        for hop in range(1, hops_per_round + 1):
            step = step.filter("position < length").join(pointers, ["pair", "node"]).select("pair", (F.col("position") + 1).alias("position"), F.col("next").alias("node"), "length")
            at = step.withColumn("hop", F.lit(hop))
            found = at if found is None else found.unionByName(at)
        found = cut_lineage(found)
        read = read.unionByName(found.drop("hop"))
        walk = found.filter((F.col("hop") == hops_per_round) & (F.col("position") < F.col("length"))).drop("hop")
    return read.join(named, "pair").select("root", "target", "position", "node").unionByName(same)


def shortest_path_between(edges: DataFrame, pairs: DataFrame, undirected: bool = False, max_nodes: int | None = None) -> DataFrame:
    """(root, target, depth, path) of one shortest path of each (root, target) pair; see ``shortest_path_nodes``."""
    nodes = shortest_path_nodes(edges, pairs, undirected, max_nodes)
    return nodes.groupBy("root", "target").agg(
        F.max("position").alias("depth"), F.sort_array(F.collect_list(F.struct("position", "node")))["node"].alias("path"))

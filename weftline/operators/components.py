"""Strongly connected components: which nodes are on cycles, and on which together.

Edges that can't be on a cycle are peeled off from both ends. Long chains and rings are shortened by taking out nodes with
one way in and one way out, an independent set of them at a time, so a ring takes as many rounds as its
length has digits to base 4/3 instead of one for each hop. What is left is coloured: the least name that leads to a node is its colour, and the nodes
that lead back to the name of their colour, inside it, are its component. Every node has one colour, so no table of roots by nodes arises.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from weftline.operators.traversal import HOPS_PER_ROUND, reach, roots_of, stored_flow
from weftline.session import cut_lineage

#: Chains are shortened as long as a round takes out this share of the edges.
SHORTENED = 0.15
#: So many rounds of peeling between two rounds of shortening.
PEEL_ROUNDS = 4


def peeled(edges: DataFrame, rounds: int | None = None) -> DataFrame:
    """Stored edges whose source has a way in and whose target has a way out, until none goes any more or for some ``rounds``."""
    core, size, done = edges, edges.count(), 0
    while size and (rounds is None or done < rounds):
        for _ in range(2):
            core = core.join(core.select(F.col("dst").alias("src")), "src", "left_semi").join(
                core.select(F.col("src").alias("dst")), "dst", "left_semi").select("src", "dst")
        core = cut_lineage(core)
        left = core.count()
        if left == size:
            break
        size, done = left, done + 1
    return core


def shortened(core: DataFrame, number: int) -> tuple[DataFrame, DataFrame]:
    """(edges, taken): a round of taking out chain nodes; ``taken`` has (node, before, after) with their neighbours.

    A node is taken if its coin shows heads and that of the node before it does not, so no two neighbours go at once.
    """
    loops = core.filter("src = dst").select(F.col("src").alias("node"))
    into = core.groupBy(F.col("dst").alias("node")).agg(F.count("*").alias("ins"), F.min("src").alias("before"))
    out = core.groupBy(F.col("src").alias("node")).agg(F.count("*").alias("outs"), F.min("dst").alias("after"))

    def heads(node: str):
        return F.pmod(F.xxhash64(F.lit(number), node), F.lit(2)) == 1

    chain = into.join(out, "node").filter("ins = 1 AND outs = 1").join(loops, "node", "left_anti").select("node", "before", "after")
    taken = cut_lineage(chain.filter(heads("node") & ~heads("before")))
    kept = core.join(taken.select(F.col("node").alias("src")), "src", "left_anti").join(taken.select(F.col("node").alias("dst")), "dst", "left_anti")
    bridges = taken.select(F.col("before").alias("src"), F.col("after").alias("dst"))
    return cut_lineage(kept.select("src", "dst").unionByName(bridges).distinct()), taken


def cyclic_core(edges: DataFrame) -> tuple[DataFrame, list[DataFrame]]:
    """(edges, rounds): what is left of the edges once nothing can be peeled off or shortened; empty iff there is no cycle."""
    core, rounds = peeled(stored_flow(edges, "downstream"), PEEL_ROUNDS), []
    size = core.count()
    while size:
        core, taken = shortened(core, len(rounds))
        rounds.append(taken)
        core = peeled(core, PEEL_ROUNDS)
        left = core.count()
        if left > (1 - SHORTENED) * size:
            break
        size = left
    return (peeled(core) if size else core), rounds


def has_cycle(edges: DataFrame) -> bool:
    return not cyclic_core(edges)[0].isEmpty()


def require_acyclic(edges: DataFrame) -> None:
    if has_cycle(edges):
        raise ValueError("the graph has a cycle")


def colours(core: DataFrame, hops_per_round: int = HOPS_PER_ROUND) -> DataFrame:
    """Stored (node, colour): the least name that leads to each node, its own included. Only names that fell walk on."""
    known = cut_lineage(core.selectExpr("explode(array(src, dst)) AS node").distinct().withColumn("colour", F.col("node")))
    fallen = known
    while True:
        step, found = fallen, None
        for _ in range(hops_per_round):
            step = step.join(core, step["node"] == core["src"]).groupBy(F.col("dst").alias("node")).agg(F.min("colour").alias("colour"))
            found = step if found is None else found.unionByName(step)
        offered = found.groupBy("node").agg(F.min("colour").alias("offered"))
        now = cut_lineage(known.join(offered, "node", "left").select(
            "node", F.least("colour", "offered").alias("colour"), F.coalesce(F.col("offered") < F.col("colour"), F.lit(False)).alias("fell")))
        known, fallen = now.select("node", "colour"), now.filter("fell").select("node", "colour")
        if fallen.isEmpty():
            return known


def strong_components(edges: DataFrame) -> DataFrame:
    """(node, component) of every node on a cycle; a component is named after its smallest node."""
    core, rounds = cyclic_core(edges)
    found = core.filter("src = dst").select(F.col("src").alias("node"), F.col("src").alias("component")).limit(0)
    while not core.isEmpty():
        colour = colours(core)
        same = core.join(colour, F.col("node") == F.col("src")).select("src", "dst", "colour").join(
            colour.select(F.col("node").alias("dst"), F.col("colour").alias("other")), "dst").filter("colour = other").select("src", "dst")
        # Inside a colour only its own name is a root, so each node is met once.
        inside = reach(same, roots_of(colour.filter("node = colour"), "node"), "upstream", include_root=True)
        loops = core.filter("src = dst").select(F.col("src").alias("node"))
        larger = inside.groupBy("root").agg(F.count("*").alias("n")).filter("n > 1").select("root")
        own = inside.select("root", "node")
        members = own.join(larger, "root", "left_semi").unionByName(own.join(loops, "node", "left_semi").select("root", "node")).distinct()
        found = cut_lineage(found.unionByName(members.select("node", F.col("root").alias("component"))))
        done = cut_lineage(own.select("node").distinct())
        core = peeled(cut_lineage(core.join(done.select(F.col("node").alias("src")), "src", "left_anti").join(
            done.select(F.col("node").alias("dst")), "dst", "left_anti").select("src", "dst")))
    for taken in reversed(rounds):
        before = found.select(F.col("node").alias("before"), "component")
        after = found.select(F.col("node").alias("after"), F.col("component").alias("other"))
        back = taken.join(before, "before").join(after, "after").filter("component = other").select("node", "component")
        found = cut_lineage(found.unionByName(back))
    names = found.groupBy("component").agg(F.min("node").alias("name"))
    return found.join(names, "component").select("node", F.col("name").alias("component"))

"""Reachability over an edge table by frontier expansion.

All operators take many roots at once (a ``root`` column), so one loop answers a whole
batch of questions. A round expands several hops before the lineage is cut; the loop
ends when no new (root, node) pair appears, so cycles are safe.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from weftline.session import cut_lineage

HOPS_PER_ROUND = 4
ROUNDS_PER_CUT = 12


def flow(edges: DataFrame, direction: str) -> DataFrame:
    """(src, dst) pairs oriented so that following src -> dst walks in ``direction``."""
    if direction == "downstream":
        pairs = edges.select("src", "dst")
    elif direction == "upstream":
        pairs = edges.select(F.col("dst").alias("src"), F.col("src").alias("dst"))
    else:
        raise ValueError(f"unknown direction {direction!r}")
    return pairs.distinct()


def stored_flow(edges: DataFrame, direction: str) -> DataFrame:
    """``flow`` as a stored table. Saying that no end is null spares every later join a filter of
    its own, so the hops of a round stay identical plans and share one shuffle each."""
    return cut_lineage(flow(edges, direction)).filter("src IS NOT NULL AND dst IS NOT NULL")


def roots_of(df: DataFrame, column: str = "id") -> DataFrame:
    return df.select(F.col(column).alias("root")).distinct()


def literal_roots(spark, *names: str) -> DataFrame:
    return spark.createDataFrame([(n,) for n in names], "root string")


def reach(
    edges: DataFrame,
    roots: DataFrame,
    direction: str = "downstream",
    max_depth: int | None = None,
    include_root: bool = False,
    hops_per_round: int = HOPS_PER_ROUND,
    stop_after: int | None = None,
) -> DataFrame:
    """(root, node, depth) with the least depth of every node reachable from each root.

    ``roots`` has a ``root`` column; with a ``node`` column too, the walk of a root starts at
    those nodes, so many starts can share one label. Starts are left out unless ``include_root``. ``max_depth`` is inclusive.
    ``stop_after`` ends the loop once every level up to that many nodes per root is complete.
    """
    pairs = stored_flow(edges, direction)
    start = F.col("node") if "node" in roots.columns else F.col("root")
    frontier = cut_lineage(roots.select("root", start.alias("node"), F.lit(0).alias("depth")).distinct())
    seen, level, rounds = frontier, 0, 0
    while max_depth is None or level < max_depth:
        hops = hops_per_round if max_depth is None else min(hops_per_round, max_depth - level)
        # Depth and hop are columns, not literals that change: every round then runs the code
        # generated for the first one.
        step, found = frontier.select("root", "node", "depth"), None
        for hop in range(1, hops + 1):
            step = (
                step.join(pairs, step["node"] == pairs["src"])
                .groupBy("root", F.col("dst").alias("node")).agg(F.min(F.col("depth") + 1).alias("depth"))
            )
            at = step.withColumn("hop", F.lit(hop))
            found = at if found is None else found.unionByName(at)
        # Known pairs take part with hop 0 and win; one sum replaces a sum and an anti join.
        fresh = cut_lineage(
            found.unionByName(seen.withColumn("hop", F.lit(0)))
            .groupBy("root", "node").agg(F.min("depth").alias("depth"), F.min("hop").alias("hop"))
            .filter("hop > 0")
        )
        seen = seen.unionByName(fresh.drop("hop"))
        level += hops
        rounds += 1
        if rounds % ROUNDS_PER_CUT == 0:
            seen = cut_lineage(seen)
        frontier = fresh.filter(F.col("hop") == hops)
        if stop_after is not None:
            full = fresh.groupBy("root").count().filter(F.col("count") >= stop_after).select("root")
            frontier = frontier.join(full, "root", "left_anti")
        if frontier.isEmpty():
            break
    return seen if include_root else seen.filter("depth > 0")


def layered_reach(layers: list[DataFrame]) -> DataFrame:
    """(root, node, depth) from every start of the first edge table, where each table leads to the starts of the next.

    The number of hops is known and no node is met at two depths, so there is no loop and no visited set: a hop is
    a join with its own layer alone and one distinct.
    """
    step, found = None, None
    for depth, layer in enumerate(layers, 1):
        edges = layer.select("src", "dst").filter("src IS NOT NULL AND dst IS NOT NULL")
        if step is None:
            step = edges.select(F.col("src").alias("root"), F.col("dst").alias("node")).distinct()
        else:
            step = step.join(edges, step["node"] == edges["src"]).select("root", F.col("dst").alias("node")).distinct()
        at = step.withColumn("depth", F.lit(depth))
        found = at if found is None else found.unionByName(at)
    return found


def bounded_reach(edges: DataFrame, roots: DataFrame, max_depth: int, max_nodes: int, direction: str = "downstream") -> DataFrame:
    """The ``max_nodes`` nearest nodes of each root within ``max_depth``, in (depth, node) order."""
    from pyspark.sql import Window

    order = Window.partitionBy("root").orderBy("depth", "node")
    found = reach(edges, roots, direction, max_depth, stop_after=max_nodes)
    return found.withColumn("position", F.row_number().over(order)).filter(F.col("position") <= max_nodes)


def lineage_subgraph(edges: DataFrame, roots: DataFrame, max_depth: int | None = None, direction: str = "both") -> DataFrame:
    """(root, src, dst) edges with both ends among the root and its reached nodes."""
    ways = ["downstream", "upstream"] if direction == "both" else [direction]
    inside = None
    for way in ways:
        part = reach(edges, roots, way, max_depth, include_root=True).select("root", "node")
        inside = part if inside is None else inside.unionByName(part)
    inside = cut_lineage(inside.distinct())
    left = inside.select("root", F.col("node").alias("src"))
    right = inside.select("root", F.col("node").alias("dst"))
    pairs = edges.select("src", "dst").distinct()
    return left.join(pairs, "src").join(right, ["root", "dst"], "left_semi").select("root", "src", "dst")


def impact_counts(reached: DataFrame, nodes: DataFrame) -> DataFrame:
    """Per root: nodes, datasets and jobs reached and the largest depth."""
    kinds = nodes.select(F.col("id").alias("node"), "type")
    return reached.join(kinds, "node").groupBy("root").agg(
        F.count("*").alias("total"),
        F.count_if(F.col("type") == "dataset").alias("datasets"),
        F.count_if(F.col("type") == "job").alias("jobs"),
        F.max("depth").alias("max_depth"),
    )


def impact_radius(reached: DataFrame) -> DataFrame:
    """Direct, two-hop, five-hop and total counts."""
    def within(k: int) -> Column:
        return F.count_if(F.col("depth") <= k)

    return reached.groupBy("root").agg(
        F.count_if(F.col("depth") == 1).alias("direct"),
        within(2).alias("depth_2"), within(5).alias("depth_5"), F.count("*").alias("total"),
    )


def closure_table(edges: DataFrame) -> DataFrame:
    """(ancestor, descendant, depth) for every reachable pair."""
    return reach(edges, roots_of(edges, "src")).select(
        F.col("root").alias("ancestor"), F.col("node").alias("descendant"), "depth"
    )


def extend_closure(closure: DataFrame, new_edges: DataFrame) -> DataFrame:
    """Closure after adding edges, from the stored closure and the new edges only.

    Each pass prepends known ancestors and appends known descendants of the new edges and
    keeps the least depth; passes repeat until no pair gets shorter, so chains of several
    new edges are found too.
    """
    known = closure
    step = new_edges.select(F.col("src").alias("a"), F.col("dst").alias("b")).distinct()
    while True:
        before = known.select(F.col("ancestor").alias("p"), F.col("descendant").alias("a"), F.col("depth").alias("d1"))
        after = known.select(F.col("ancestor").alias("b"), F.col("descendant").alias("q"), F.col("depth").alias("d2"))
        heads = step.select("a", "b", F.col("a").alias("p"), F.lit(0).alias("d1")).unionByName(
            step.join(before, "a").select("a", "b", "p", "d1"))
        tails = step.select("a", "b", F.col("b").alias("q"), F.lit(0).alias("d2")).unionByName(
            step.join(after, "b").select("a", "b", "q", "d2"))
        offered = heads.join(tails, ["a", "b"]).groupBy(
            F.col("p").alias("ancestor"), F.col("q").alias("descendant")
        ).agg(F.min(F.col("d1") + F.col("d2") + 1).alias("depth"))
        old = known.withColumnRenamed("depth", "old_depth")
        better = cut_lineage(
            offered.filter("ancestor <> descendant").join(old, ["ancestor", "descendant"], "left")
            .filter("old_depth IS NULL OR depth < old_depth").select("ancestor", "descendant", "depth")
        )
        if better.isEmpty():
            return known
        known = cut_lineage(
            known.unionByName(better).groupBy("ancestor", "descendant").agg(F.min("depth").alias("depth")))

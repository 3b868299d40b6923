"""Degree, PageRank, betweenness, components and communities of an edge table."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from weftline.operators.traversal import ROUNDS_PER_CUT, flow, roots_of, stored_flow
from weftline.session import cut_lineage


def degrees(edges: DataFrame) -> DataFrame:
    """(id, in_degree, out_degree, total) over distinct edges."""
    ends = flow(edges, "downstream").selectExpr(
        "inline(array(named_struct('id', src, 'outgoing', 1, 'incoming', 0), named_struct('id', dst, 'outgoing', 0, 'incoming', 1)))")
    return ends.groupBy("id").agg(
        F.sum("incoming").alias("in_degree"), F.sum("outgoing").alias("out_degree"), F.count("*").alias("total"))


def pagerank(edges: DataFrame, alpha: float = 0.85, tol: float = 1e-6, steps_per_cut: int = 4) -> DataFrame:
    """(id, rank): uniform teleport, the rank of dangling nodes spread evenly, sum 1.

    With both spread evenly, the stationary rank is the sum of the uniform start after
    0, 1, 2, ... damped steps along the edges, scaled to sum 1. A step is one join and one sum,
    no scalar has to travel between steps, and on an acyclic graph the steps run out by themselves.
    Ends when the steps still to come hold less than ``tol`` of the rank, which takes at most
    log(tol * (1 - alpha)) / log(alpha) steps.
    """
    pairs = flow(edges, "downstream")
    fan_out = pairs.groupBy("src").agg((F.lit(alpha) / F.count("*")).alias("share"))
    links = cut_lineage(pairs.join(fan_out, "src")).filter("src IS NOT NULL AND dst IS NOT NULL")
    ids = cut_lineage(links.selectExpr("explode(array(src, dst)) AS id").distinct())
    start = 1.0 / max(ids.count(), 1)
    mass = ids.withColumn("mass", F.lit(start))
    parts, done = mass, 0
    while True:
        found = None
        for _ in range(steps_per_cut):
            done += 1
            mass = links.join(mass.withColumnRenamed("id", "src"), "src").groupBy(F.col("dst").alias("id")).agg(F.sum(F.col("share") * F.col("mass")).alias("mass"))
            at = mass.withColumn("step", F.lit(done))
            found = at if found is None else found.unionByName(at)
        found = cut_lineage(found)
        mass = found.filter(F.col("step") == done).drop("step")
        parts = cut_lineage(parts.unionByName(found.drop("step")).groupBy("id").agg(F.sum("mass").alias("mass")))
        left = mass.agg(F.sum("mass")).first()[0]
        if left is None or left * alpha / (1 - alpha) < tol:
            break
    total = parts.agg(F.sum("mass"))
    return parts.select("id", (F.col("mass") / total.scalar()).alias("rank"))


#: Rows of (source, edge) that a batch of sources may make.
BATCH_ROWS = 50_000_000
#: Sources are dealt over so many slots; a batch is a range of them.
SLOTS = 1 << 30
#: A batch may hold so many times the sources that its size was judged by.
GROWTH = 256


def betweenness(edges: DataFrame, levels_per_cut: int = 4, batch_rows: int = BATCH_ROWS) -> DataFrame:
    """(id, score): share of shortest paths through each node, normalised by (n-1)(n-2).

    Sources come in hashed batches of about ``batch_rows`` (source, edge) rows and their dependencies are added up, so what is
    stored at a time doesn't grow with the number of sources. The first batch is small enough if every source leads to every edge;
    each later one is as large as the rows of those before it allow. Names are numbered first.
    """
    pairs = stored_flow(edges, "downstream")
    ids = cut_lineage(pairs.selectExpr("explode(array(src, dst)) AS id").distinct().withColumn("number", F.monotonically_increasing_id()))
    links = cut_lineage(
        pairs.join(ids.select(F.col("id").alias("src"), F.col("number").alias("a")), "src")
        .join(ids.select(F.col("id").alias("dst"), F.col("number").alias("b")), "dst").select(F.col("a").alias("src"), F.col("b").alias("dst"))
    ).filter("src IS NOT NULL AND dst IS NOT NULL")
    sources = cut_lineage(roots_of(links, "src").withColumn("slot", F.pmod(F.xxhash64("root"), F.lit(SLOTS))))
    n, low, rows, raw = ids.count(), 0, 0, None
    wide = max(1, SLOTS * batch_rows // max(1, sources.count() * links.count()))
    while low < SLOTS:
        high = min(SLOTS, low + wide)
        near = _shortest(links, sources.filter((F.col("slot") >= low) & (F.col("slot") < high)), levels_per_cut)
        own = _dependencies(links, near, levels_per_cut)
        raw, low = own if raw is None else raw.unionByName(own), high
        if low < SLOTS:
            fan_out = links.groupBy(F.col("src").alias("node")).agg(F.count("*").alias("outs"))
            met = near.groupBy("node").agg(F.count("*").alias("roots")).join(fan_out, "node", "left")
            rows += met.agg(F.sum(F.col("roots") * F.coalesce("outs", F.lit(1)))).first()[0] or 0
            wide = max(1, min(low * batch_rows // max(1, rows), low * GROWTH))
    scale = 1.0 / ((n - 1) * (n - 2)) if n > 2 else 0.0
    totals = raw.groupBy("number").agg(F.sum("raw").alias("raw"))
    return ids.join(totals, "number", "left").select("id", (F.coalesce("raw", F.lit(0.0)) * scale).alias("score"))


def _shortest(links: DataFrame, sources: DataFrame, hops: int) -> DataFrame:
    """(root, node, depth, paths): least depth and number of shortest paths of every node below each source, itself at depth 0.

    As many walks as the least number of hops allows are as many shortest paths, so a round counts walks of several hops and
    keeps the shortest of each node.
    """
    frontier = sources.select("root", F.col("root").alias("node"), F.lit(0).alias("depth"), F.lit(1.0).alias("paths"))
    near, rounds = frontier, 0
    while True:
        step, found = frontier.select("root", "node", "depth", "paths"), None
        for hop in range(1, hops + 1):
            step = step.join(links, step["node"] == links["src"]).groupBy("root", F.col("dst").alias("node")).agg(
                F.min(F.col("depth") + 1).alias("depth"), F.sum("paths").alias("paths"))
            at = step.withColumn("hop", F.lit(hop))
            found = at if found is None else found.unionByName(at)
        # Known pairs take part with hop 0 and win.
        fresh = cut_lineage(
            found.unionByName(near.withColumn("hop", F.lit(0))).groupBy("root", "node")
            .agg(F.min("depth").alias("depth"), F.min_by("paths", "hop").alias("paths"), F.min("hop").alias("hop")).filter("hop > 0"))
        near = near.unionByName(fresh.drop("hop"))
        rounds += 1
        if rounds % ROUNDS_PER_CUT == 0:
            near = cut_lineage(near)
        frontier = fresh.filter(F.col("hop") == hops)
        if frontier.isEmpty():
            return near


def _dependencies(links: DataFrame, near: DataFrame, levels_per_cut: int) -> DataFrame:
    """Stored (number, raw): what each node carries of the shortest paths in ``near`` (see ``_shortest``).

    Dependencies are summed backwards, level by level, over the edges that lie on shortest paths.
    """
    above = near.select("root", F.col("node").alias("u"), (F.col("depth") + 1).alias("dv"), F.col("paths").alias("paths_u"))
    below = near.select("root", F.col("node").alias("v"), F.col("depth").alias("dv"), F.col("paths").alias("paths_v"))
    ratios = cut_lineage(
        above.join(links, above["u"] == links["src"]).withColumnRenamed("dst", "v").join(below, ["root", "v", "dv"])
        .select("root", "u", "v", "dv", (F.col("paths_u") / F.col("paths_v")).alias("ratio")))
    deepest = ratios.agg(F.max("dv")).first()[0] or 0
    share = ratios.limit(0).select("root", F.col("v").alias("node"), F.col("ratio").alias("share"))
    summed = share
    for d in range(deepest, 0, -1):
        level = ratios.filter(F.col("dv") == d)
        # Nothing lies below the deepest level.
        known = level.withColumn("share", F.lit(0.0)) if d == deepest else level.join(share.withColumnRenamed("node", "v"), ["root", "v"], "left")
        share = known.groupBy("root", F.col("u").alias("node")).agg(F.sum(F.col("ratio") * (1 + F.coalesce("share", F.lit(0.0)))).alias("share"))
        if d % levels_per_cut == 0:
            share = cut_lineage(share)
        summed = summed.unionByName(share)
    return cut_lineage(summed.filter("root <> node").groupBy(F.col("node").alias("number")).agg(F.sum("share").alias("raw")))


def critical_nodes(edges: DataFrame, top_n: int = 5, batch_rows: int = BATCH_ROWS) -> DataFrame:
    """Highest betweenness first, with degrees and PageRank. ``batch_rows`` is that of ``betweenness``."""
    best = cut_lineage(betweenness(edges, batch_rows=batch_rows).orderBy(F.desc(F.round("score", 9)), "id").limit(top_n))
    return best.join(degrees(edges), "id").join(pagerank(edges), "id")


def components(edges: DataFrame) -> DataFrame:
    """(id, component): smallest node name of the weakly connected component.

    Each round takes the smallest label among the neighbours and then the label of that
    label, which shortens long chains quickly.
    """
    links = cut_lineage(
        flow(edges, "downstream").unionByName(flow(edges, "upstream"))
        .unionByName(edges.selectExpr("explode(array(src, dst)) AS src").selectExpr("src", "src AS dst")).distinct())
    labels = cut_lineage(links.groupBy(F.col("src").alias("id")).agg(F.min("dst").alias("component")))
    while True:
        spread = links.join(labels.withColumnRenamed("id", "dst"), "dst").groupBy(F.col("src").alias("id")).agg(
            F.min("component").alias("component"))
        jump = spread.select(F.col("id").alias("component"), F.col("component").alias("further"))
        moved = cut_lineage(
            spread.join(jump, "component").select("id", F.col("further").alias("component"))
            .join(labels.withColumnRenamed("component", "old"), "id"))
        labels = moved.select("id", "component")
        if moved.filter("component <> old").isEmpty():
            return labels


def communities(edges: DataFrame) -> DataFrame:
    """(id, community) by label propagation: each node takes the commonest label among its
    neighbours and itself; ties go to the smallest label. Counts are summed before the pick.

    Rounds go on until no label moves. Labels that all nodes choose at once can also come to swing
    between two states; then each node keeps the smaller of its two labels.
    """
    links = cut_lineage(
        flow(edges, "downstream").unionByName(flow(edges, "upstream"))
        .unionByName(edges.selectExpr("explode(array(src, dst)) AS src").selectExpr("src", "src AS dst")).distinct())
    labels = links.select(F.col("src").alias("id"), F.col("src").alias("community"), F.col("src").alias("before")).distinct()
    while True:
        votes = links.join(labels.withColumnRenamed("id", "dst"), "dst").groupBy("src", "community").count()
        chosen = votes.groupBy(F.col("src").alias("id")).agg(
            F.min(F.struct((-F.col("count")).alias("votes"), "community"))["community"].alias("chosen"))
        labels = cut_lineage(labels.join(chosen, "id").select("id", F.col("chosen").alias("community"), F.col("community").alias("before"), F.col("before").alias("earlier")))
        moves = labels.agg(F.count_if(F.col("community") != F.col("before")).alias("moved"), F.count_if(F.col("community") != F.col("earlier")).alias("swung")).first()
        if moves.moved == 0 or moves.swung == 0:
            return labels.select("id", F.least("community", "before").alias("community"))
        labels = labels.drop("earlier")

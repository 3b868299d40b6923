"""Communities by modularity: Louvain's local moves and contraction, level by level.

The graph is undirected, each pair of linked nodes counts once and an edge of a node to itself is its own weight. A round lets a hashed part of the nodes move, each to the
community among its neighbours that gains most modularity; since the others stand still, few gains contradict each other. A
round that doesn't raise the modularity of the whole is undone and the next one moves fewer nodes at once. When no part gains any
more, every community becomes one node, its inner weight a loop, and the next level begins, until a level moves nothing.

Rounds over a table cost several jobs each. From the level on whose links fit into one task, that task does the rounds that are left,
over arrays and with the same moves.
"""

from __future__ import annotations

import struct
from collections.abc import Iterator
from functools import partial

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from weftline.session import cut_lineage

#: A round must raise the modularity by that much.
LEAST_GAIN = 1e-9
#: Parts of the nodes that move at once: first a half, then a quarter.
PARTS = (2, 4)
#: So many links, in both directions, fit into one task.
TASK_LINKS = 3_000_000


def weighted_links(edges: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(links, nodes): stored (a, b, weight) in both directions, and (id, loop) with twice the weight inside each node."""
    pairs = edges.select(F.least("src", "dst").alias("a"), F.greatest("src", "dst").alias("b")).filter("a IS NOT NULL AND b IS NOT NULL").distinct()
    both = pairs.filter("a <> b").select("a", "b").unionByName(pairs.filter("a <> b").select(F.col("b").alias("a"), F.col("a").alias("b")))
    links = cut_lineage(both.withColumn("weight", F.lit(1.0)))
    loops = pairs.filter("a = b").select(F.col("a").alias("id"), F.lit(2.0).alias("loop"))
    nodes = pairs.selectExpr("explode(array(a, b)) AS id").distinct().join(loops, "id", "left").fillna({"loop": 0.0})
    return links, cut_lineage(nodes)


def _strengths(links: DataFrame, nodes: DataFrame) -> DataFrame:
    """Stored (id, strength): the weight of all ends at a node."""
    out = links.groupBy(F.col("a").alias("id")).agg(F.sum("weight").alias("out"))
    return cut_lineage(nodes.join(out, "id", "left").select("id", (F.col("loop") + F.coalesce("out", F.lit(0.0))).alias("strength")))


def modularity(edges: DataFrame, labels: DataFrame) -> float:
    """Modularity of the communities ``labels`` (id, community) of the undirected graph."""
    links, nodes = weighted_links(edges)
    return _modularity(links, nodes, _strengths(links, nodes), labels.select("id", "community"))


def _modularity(links: DataFrame, nodes: DataFrame, strengths: DataFrame, labels: DataFrame) -> float:
    of_a, of_b = labels.select(F.col("id").alias("a"), F.col("community").alias("of_a")), labels.select(F.col("id").alias("b"), F.col("community").alias("of_b"))
    # Sums of whole numbers stay exact whatever the order of rows.
    inside = links.join(of_a, "a").join(of_b, "b").filter("of_a = of_b").agg(F.coalesce(F.sum("weight"), F.lit(0.0)))
    loops = nodes.agg(F.coalesce(F.sum("loop"), F.lit(0.0)))
    sums = strengths.join(labels, "id").groupBy("community").agg(F.sum("strength").alias("s"))
    found = sums.agg(F.sum("s").alias("total"), F.sum(F.col("s") * F.col("s")).alias("squares")).select("total", "squares", inside.scalar().alias("inside"), loops.scalar().alias("loops")).first()
    return (found.inside + found.loops) / found.total - found.squares / found.total ** 2 if found.total else 0.0


def _moved(links: DataFrame, strengths: DataFrame, labels: DataFrame, total: float, turn: Column) -> DataFrame:
    """(id, community) after the nodes whose ``turn`` it is took their best community; ties go to the least name."""
    known = labels.join(strengths, "id")
    sums = known.groupBy("community").agg(F.sum("strength").alias("sum"), F.count("*").alias("size"))
    near = links.join(labels.select(F.col("id").alias("b"), "community"), "b").groupBy(F.col("a").alias("id"), "community").agg(F.sum("weight").alias("weight"))
    movers = known.filter(turn).select("id", F.col("community").alias("own"), "strength")
    stay = movers.select("id", F.col("own").alias("community"), F.lit(0.0).alias("weight"))
    offers = near.join(movers.select("id"), "id", "left_semi").unionByName(stay).groupBy("id", "community").agg(F.sum("weight").alias("weight"))
    judged = offers.join(movers, "id").join(sums, "community")
    here = F.col("community") == F.col("own")
    # What is gained over standing alone; a node's own strength doesn't count against the community it is in.
    gain = F.col("weight") - F.col("strength") * (F.col("sum") - F.when(here, F.col("strength")).otherwise(0.0)) / F.lit(total)
    # Of two nodes alone the one of the greater name moves.
    alone = movers.join(sums.select(F.col("community").alias("own"), F.col("size").alias("own_size")), "own").select("id", "own_size")
    fair = judged.join(alone, "id").filter(here | (F.col("size") > 1) | (F.col("own_size") > 1) | (F.col("community") < F.col("own")))
    best = fair.groupBy("id").agg(F.min(F.struct((-F.round(gain, 9)).alias("loss"), (~here).cast("int").alias("away"), "community")).alias("best")).select("id", "best.community")
    return labels.join(best.withColumnRenamed("community", "next"), "id", "left").select("id", F.coalesce("next", "community").alias("community"))


def _local_moves(links: DataFrame, nodes: DataFrame, strengths: DataFrame, level: int) -> DataFrame:
    """Stored (id, community) once no part of the nodes gains any more."""
    labels = cut_lineage(nodes.select("id", F.col("id").alias("community")))
    total = strengths.agg(F.sum("strength")).first()[0] or 1.0
    reached, number, part, idle = _modularity(links, nodes, strengths, labels), 0, 0, 0
    while part < len(PARTS):
        parts = PARTS[part]
        turn = F.pmod(F.xxhash64(F.lit(level), F.lit(number // parts), "id"), F.lit(parts)) == number % parts
        number += 1
        offered = cut_lineage(_moved(links, strengths, labels, total, turn))
        now = _modularity(links, nodes, strengths, offered)
        if now > reached + LEAST_GAIN:
            labels, reached, idle = offered, now, 0
            continue
        # Once every part in turn has gained nothing, smaller parts move.
        idle += 1
        if idle >= parts:
            part, idle, number = part + 1, 0, 0
    return labels


class _Arrays:
    """A level as arrays: links (a, b, weight) in both directions and nodes, numbered in the order of their names."""

    def __init__(self, names: pa.Array, a: np.ndarray, b: np.ndarray, weight: np.ndarray, loop: np.ndarray):
        self.names, self.a, self.b, self.weight, self.loop = names, a, b, weight, loop
        self.strength = loop + np.bincount(a, weight, len(loop))
        self.seed, self.coins = None, None

    def modularity(self, labels: np.ndarray) -> float:
        inside, loops, total = self.weight[labels[self.a] == labels[self.b]].sum(), self.loop.sum(), self.strength.sum()
        sums = np.bincount(labels, self.strength)
        return float((inside + loops) / total - (sums * sums).sum() / total ** 2) if total else 0.0

    def turn(self, level: int, cycle: int, parts: int, part: int) -> np.ndarray:
        """Spark's ``pmod(xxhash64(level, cycle, name), parts) = part`` for each node; parts are a power of two."""
        seed = xxhash.xxh64_intdigest(struct.pack("<i", cycle), xxhash.xxh64_intdigest(struct.pack("<i", level), 42))
        if seed != self.seed:
            names = self.names.cast(pa.binary()).to_pylist()
            self.seed, self.coins = seed, np.fromiter((xxhash.xxh64_intdigest(name, seed) % max(PARTS) for name in names), np.int64, len(names))
        return self.coins % parts == part

    def moved(self, labels: np.ndarray, total: float, turn: np.ndarray) -> np.ndarray:
        """As ``_moved``."""
        n, sums, size = len(labels), np.bincount(labels, self.strength, len(labels)), np.bincount(labels, minlength=len(labels))
        near, movers = np.flatnonzero(turn[self.a]), np.flatnonzero(turn)
        pairs = np.concatenate([self.a[near] * n + labels[self.b[near]], movers * n + labels[movers]])
        pairs, at = np.unique(pairs, return_inverse=True)
        weight = np.bincount(at, np.concatenate([self.weight[near], np.zeros(len(movers))]))
        node, community = np.divmod(pairs, n)
        own, strength = labels[node], self.strength[node]
        here = community == own
        gain = (weight - strength * (sums[community] - np.where(here, strength, 0.0)) / total) * 1e9
        # Half away from zero, as Spark rounds.
        gain = np.copysign(np.floor(np.abs(gain) + 0.5), gain)
        fair = np.flatnonzero(here | (size[community] > 1) | (size[own] > 1) | (community < own))
        fair = fair[np.lexsort((community[fair], ~here[fair], -gain[fair], node[fair]))]
        movers, first = np.unique(node[fair], return_index=True)
        offered = labels.copy()
        offered[movers] = community[fair[first]]
        return offered

    def local_moves(self, level: int) -> np.ndarray:
        """As ``_local_moves``."""
        labels, total = np.arange(len(self.names)), float(self.strength.sum()) or 1.0
        reached, number, part, idle = self.modularity(labels), 0, 0, 0
        while part < len(PARTS):
            parts = PARTS[part]
            offered = self.moved(labels, total, self.turn(level, number // parts, parts, number % parts))
            number += 1
            now = self.modularity(offered)
            if now > reached + LEAST_GAIN:
                labels, reached, idle = offered, now, 0
                continue
            idle += 1
            if idle >= parts:
                part, idle, number = part + 1, 0, 0
        return labels

    def merged(self, labels: np.ndarray) -> tuple[_Arrays, np.ndarray]:
        """(next level, number of each node in it)."""
        kept, to = np.unique(labels, return_inverse=True)
        n = len(kept)
        pairs, at = np.unique(to[self.a] * n + to[self.b], return_inverse=True)
        weight = np.bincount(at, self.weight, len(pairs))
        a, b = np.divmod(pairs, n)
        inner, out = a == b, a != b
        loop = np.bincount(to, self.loop, n) + np.bincount(a[inner], weight[inner], n)
        return _Arrays(self.names.take(pa.array(kept)), a[out], b[out], weight[out], loop), to


def _in_task(batches: Iterator[pa.RecordBatch], level: int) -> Iterator[pa.RecordBatch]:
    """(id, community) after all levels from ``level`` on; links have both ends, nodes have no ``b`` and their loop as weight."""
    held = [x for x in batches if x.num_rows]
    if not held:
        return
    rows = pa.Table.from_batches(held)
    del held
    alone = pc.is_null(rows["b"])
    nodes, links = rows.filter(alone), rows.filter(pc.invert(alone))
    del rows, alone
    nodes = nodes.take(pc.sort_indices(nodes["a"]))
    names = nodes["a"].combine_chunks()
    a, b = (pc.index_in(links[c], value_set=names).to_numpy().astype(np.int64) for c in ("a", "b"))
    arrays = _Arrays(names, a, b, links["weight"].to_numpy(), nodes["weight"].to_numpy())
    del links, nodes, a, b
    members = np.arange(len(names))
    while True:
        labels = arrays.local_moves(level)
        if (labels == np.arange(len(labels))).all():
            break
        arrays, to = arrays.merged(labels)
        members, level = to[members], level + 1
    yield from pa.table({"id": names, "community": arrays.names.take(pa.array(members))}).to_batches(max_chunksize=100_000)


def _finished(links: DataFrame, nodes: DataFrame, level: int) -> DataFrame:
    """Stored (id, community) of the nodes of a level after all levels from this one on."""
    rows = links.select("a", "b", "weight").unionByName(nodes.select(F.col("id").alias("a"), F.lit(None).cast("string").alias("b"), F.col("loop").alias("weight")))
    return cut_lineage(rows.repartition(1).mapInArrow(partial(_in_task, level=level), "id string, community string"))


def _named(members: DataFrame) -> DataFrame:
    names = members.groupBy("community").agg(F.min("id").alias("name"))
    return members.join(names, "community").select("id", F.col("name").alias("community"))


def louvain(edges: DataFrame, task_links: int = TASK_LINKS) -> DataFrame:
    """(id, community) of every node of an edge; a community is named after its least node. Null ends are left out.

    A level of up to ``task_links`` links and those after it are done in one task; the result is the same.
    """
    links, nodes = weighted_links(edges)
    members, level = nodes.select("id", F.col("id").alias("community")), 0
    while True:
        if dict(links.dtypes)["a"] == "string" and links.count() <= task_links:
            last = _finished(links, nodes, level).select(F.col("id").alias("community"), F.col("community").alias("last"))
            return _named(members.join(last, "community").select("id", F.col("last").alias("community")))
        strengths = _strengths(links, nodes)
        labels = _local_moves(links, nodes, strengths, level)
        if labels.filter("id <> community").isEmpty():
            return _named(members)
        members = cut_lineage(members.join(labels.select(F.col("id").alias("community"), F.col("community").alias("next")), "community").select("id", F.col("next").alias("community")))
        ends = links.join(labels.select(F.col("id").alias("a"), F.col("community").alias("of_a")), "a").join(labels.select(F.col("id").alias("b"), F.col("community").alias("of_b")), "b")
        merged = cut_lineage(ends.groupBy(F.col("of_a").alias("a"), F.col("of_b").alias("b")).agg(F.sum("weight").alias("weight")))
        inner = merged.filter("a = b").select(F.col("a").alias("id"), F.col("weight").alias("inner"))
        loops = nodes.join(labels, "id").groupBy(F.col("community").alias("id")).agg(F.sum("loop").alias("loop"))
        nodes = cut_lineage(loops.join(inner, "id", "left").select("id", (F.col("loop") + F.coalesce("inner", F.lit(0.0))).alias("loop")))
        links = cut_lineage(merged.filter("a <> b"))
        level += 1

"""Prefix trie of conversations by sorted shards and a skeleton of their borders.

A turn is a 32-byte digest of role and text, a conversation a route: the digests of its turns end to end. Equal routes
are one row with a count, so copies of a conversation weigh nothing from there on. The different routes are dealt into
sorted ranges. A node of the trie is a run of sorted routes; only nodes that both sides of a border between two ranges share can
span ranges. Those borders, cut to what both sides share, are the splitter paths, and their trie is the skeleton. It is broadcast: at most
``SEGMENT`` digests for each range, whatever the rows. Every shard finishes all nodes outside the skeleton by itself, from the deepest level up
with arrays, and gives partial sums for its share of skeleton nodes, which are then added up. Nothing else crosses shards.

Routes are cut into segments of ``SEGMENT`` turns. A round builds the tries of one segment, each below the node where the segment before
ended (its portal). Conversations that share a portal with no other leave: their nodes further down follow from their length alone. So rounds go on only
as long as two conversations are equal for all turns so far, and a conversation of any length is never held in one row.

Turns are ordered by turn (null first), then by digest; repeated rows are turns of their own. Null roles and texts are empty. Rows without a
conversation id belong to no conversation and give no node. An empty table has no root. Long texts are hashed in the JVM
and not shuffled. Other columns, whatever their names, are not read. Remainders have the sign of the id, as in SQL.

The digest of the conversations that end at a node runs over their sorted ids in sequence: ids are sorted in ranges, joined
to chunks of ``IDS_A_CHUNK`` and streamed through the hash chunk by chunk, so no task holds a node's ids.
"""

from __future__ import annotations

import hashlib
from bisect import bisect_left
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from weftline.llm.ranking import counted, ranked, ranges_for
from weftline.llm.registry import query, table
from weftline.session import cut_lineage

KEY = 32
#: Turns of a round; not below HEADS - 1, so that borrowed turns all lie in the first.
SEGMENT = 64
ROUTES_A_SHARD = 50_000
IDS_A_CHUNK = 4096
BLOCK = 4096
#: Skeleton rows up to this number (some 40 bytes each) are broadcast; more are joined by shuffle.
SKELETON_ROWS = 200_000
HEADS = 9
FAMILY = 5

NO_ENDS = hashlib.sha256(b"").hexdigest()
START = bytes(KEY)
NODE = ["conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256"]
FOUND = "kind int, node binary, depth long, conv_id long, parent_conv_id long, n_convs long, n_children long, n_leaves long, saved_tokens long, bytes long, ends_sha256 string"
LOCAL, PARTIAL, PORTAL = 0, 1, 2


# Conversations and their segments.

def turns_of(df: DataFrame) -> DataFrame:
    """Stored: (conv_id, key, bytes, rank, copies, rows) of every different turn; ``rank`` is its place in the conversation, ``rows`` that one's length."""
    role, text = F.coalesce("role", F.lit("")), F.coalesce("text", F.lit(""))
    key = F.unhex(F.sha2(F.concat(F.octet_length(role).cast("string"), F.lit(":"), role, text), 256))
    rows = df.filter("conv_id IS NOT NULL").select(F.col("conv_id").cast("long"), "turn", key.alias("key"), F.octet_length(text).cast("long").alias("bytes"))
    return cut_lineage(ranked(counted(rows), ["conv_id"], ["turn", "key"]).drop("turn"))


def _window(turns: DataFrame, low: Column, high: Column) -> DataFrame:
    """(conv_id, own): the turns of the ranks from ``low`` to ``high``, in order; a bounded number for each conversation."""
    inside = turns.filter((F.col("rank") < high) & (F.col("rank") + F.col("copies") > low))
    times = (F.least(F.col("rank") + F.col("copies"), high) - F.greatest(F.col("rank"), low)).cast("int")
    entry = F.struct("rank", F.array_repeat(F.struct("key", "bytes"), times).alias("turns"))
    lists = inside.groupBy("conv_id").agg(F.sort_array(F.collect_list(entry)).alias("lists"))
    return lists.select("conv_id", F.flatten(F.transform("lists", lambda e: e["turns"])).alias("own"))


def rebuilt(turns: DataFrame) -> DataFrame:
    """(conv_id, total, shift, segment): the first ``SEGMENT`` turns of each rebuilt conversation and its length.

    A rebuilt conversation starts with the first h turns of the conversation ``conv_id - conv_id % FAMILY`` and goes on with
    its own turns after its first h, h being the checksum of its id modulo ``HEADS``. ``shift`` is what its own ranks are moved by.
    """
    sizes = turns.filter("rank = 0").select("conv_id", F.col("rows").alias("n"))
    own = cut_lineage(_window(turns, F.lit(0), F.lit(SEGMENT + HEADS)).join(sizes, "conv_id"))
    heads = own.filter(F.col("conv_id") % FAMILY == 0).select(F.col("conv_id").alias("base"), F.slice("own", 1, HEADS - 1).alias("head"))
    h = (F.crc32(F.col("conv_id").cast("string").cast("binary")) % HEADS).cast("int")
    joined = own.withColumn("h", h).withColumn("base", F.col("conv_id") - F.col("conv_id") % FAMILY).join(heads, "base", "left")
    joined = joined.withColumn("head", F.slice(F.coalesce("head", F.array().cast("array<struct<key:binary,bytes:bigint>>")), F.lit(1), F.col("h")))
    kept = F.size("head")
    return joined.select(
        "conv_id", (kept + F.greatest(F.col("n") - F.col("h"), F.lit(0))).cast("long").alias("total"), (kept - F.col("h")).cast("long").alias("shift"),
        F.slice(F.concat("head", F.slice("own", F.col("h") + 1, F.lit(SEGMENT))), 1, SEGMENT).alias("segment"))


def later(turns: DataFrame, active: DataFrame, depth: int) -> DataFrame:
    """``active`` (conv_id, total, shift, …) with the ``segment`` of turns from ``depth`` on."""
    near = turns.filter((F.col("rank") < depth + SEGMENT + HEADS) & (F.col("rank") + F.col("copies") > depth - HEADS))
    met = near.join(active.select("conv_id", "shift"), "conv_id")
    low = F.lit(depth) - F.col("shift")
    return active.join(_window(met, low, low + SEGMENT).withColumnRenamed("own", "segment"), "conv_id")


def routes_of(convs: DataFrame) -> DataFrame:
    """``convs`` (portal, segment, …) with ``route``, the portal and the digests of the segment, ``sizes`` and ``place``, a digest of the route."""
    said = F.array_join(F.transform("segment", lambda t: F.hex(t["key"])), "")
    routed = convs.withColumn("route", F.concat("portal", F.unhex(said))).withColumn("sizes", F.transform("segment", lambda t: t["bytes"]))
    return routed.withColumn("place", F.unhex(F.sha2(F.col("route"), 256))).drop("segment", "portal")


# Digests of the conversations that end at a node.

def ends_of(rows: DataFrame) -> DataFrame:
    """(place, ends): SHA-256 of the ids of each place, in order and joined by commas. ``rows`` are (place, conv_id), all different."""
    stored = cut_lineage(rows)

    def chunks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            places, ids = batch.column("place").to_pylist(), batch.column("conv_id").to_pylist()
            edges = [i for i in range(len(ids)) if not i or places[i] != places[i - 1]] + [len(ids)]
            cuts = [(i, min(i + IDS_A_CHUNK, b)) for a, b in zip(edges, edges[1:], strict=False) for i in range(a, b, IDS_A_CHUNK)]
            yield pa.RecordBatch.from_arrays([
                pa.array([places[a] for a, _ in cuts], pa.binary()), pa.array([ids[a] for a, _ in cuts], pa.int64()),
                pa.array([",".join(map(str, ids[a:b])) for a, b in cuts], pa.string())], names=["place", "low", "said"])

    def digests(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at, running = None, None
        for batch in batches:
            done: list[tuple[bytes, str]] = []
            for place, said in zip(batch.column("place").to_pylist(), batch.column("said").to_pylist(), strict=True):
                if place == at:
                    running.update(b"," + said.encode())
                    continue
                if at is not None:
                    done.append((at, running.hexdigest()))
                at, running = place, hashlib.sha256(said.encode())
            yield pa.RecordBatch.from_arrays([pa.array([p for p, _ in done], pa.binary()), pa.array([d for _, d in done], pa.string())], names=["place", "ends"])
        if at is not None:
            yield pa.RecordBatch.from_arrays([pa.array([at], pa.binary()), pa.array([running.hexdigest()], pa.string())], names=["place", "ends"])

    dealt = stored.repartitionByRange(ranges_for(stored), "place", "conv_id").sortWithinPartitions("place", "conv_id")
    lists = dealt.mapInArrow(chunks, "place binary, low long, said string")
    return lists.repartition("place").sortWithinPartitions("place", "low").mapInArrow(digests, "place binary, ends string")


# The skeleton.

def shared_keys(a: bytes, b: bytes) -> int:
    """How many whole digests two routes share at their start."""
    n = min(len(a), len(b)) // KEY
    if a[:n * KEY] == b[:n * KEY]:
        return n
    low, high = 0, n
    while high - low > 1:
        middle = (low + high) // 2
        low, high = (middle, high) if a[:middle * KEY] == b[:middle * KEY] else (low, middle)
    return low


class Skeleton:
    """The trie of the splitter paths, as a sorted list of them."""

    def __init__(self, ranges: list[tuple[bytes, bytes]]):
        """``ranges``: first and last route of every shard, in order."""
        paths = {b[:KEY * shared_keys(a, b)] for (_, a), (b, _) in zip(ranges, ranges[1:], strict=False)}
        self.paths = sorted(p for p in paths if p)

    def depth(self, route: bytes) -> int:
        """Depth of the deepest skeleton node on a route; -1 if there is none."""
        at = bisect_left(self.paths, route)
        return max((shared_keys(route, p) for p in self.paths[max(at - 1, 0):at + 1]), default=0) - 1

    def nodes(self) -> int:
        return sum(len(p) // KEY for p in self.paths)


# One shard.

def finish(routes: list[bytes], sizes: list[list[int]], columns: dict[str, np.ndarray], ends: pa.Array, above: int, skeleton: Skeleton) -> Iterator[pa.RecordBatch]:
    """Rows of ``FOUND`` for all nodes of one shard's sorted routes, or of its share of them.

    ``columns``: n, conv_id (smallest), portal_conv, and what lies below the end of a route: below_children, below_leaves, below_saved.
    ``above``: depth of the portals.
    """
    m = len(routes)
    length = np.array([len(r) // KEY - 1 for r in routes])
    common = np.array([-1] + [shared_keys(a, b) - 1 for a, b in zip(routes, routes[1:], strict=False)])
    low, high = skeleton.depth(routes[0]), skeleton.depth(routes[-1])
    kids_at, leaves_at, saved_at = (np.zeros(m, np.int64) for _ in range(3))
    waiting: dict[str, np.ndarray] = {}

    def rows(of: dict[str, np.ndarray], parents: np.ndarray | None, hidden: np.ndarray | None, depth: int) -> Iterator[pa.RecordBatch]:
        """Nodes of one depth, once their parents are known; ``hidden``: whether those are in the skeleton."""
        n = of["head"].size
        kind = np.where(of["skeleton"], PARTIAL, LOCAL if depth or not above else PORTAL)
        if parents is None:
            parents, hidden = np.zeros(n, np.int64), np.ones(n, bool)
        if depth == 1 and above:
            parents, hidden = columns["portal_conv"][of["head"]], np.zeros(n, bool)
        node: list[bytes | None] = [None] * n
        for i in np.flatnonzero(of["skeleton"] | (kind == PORTAL)).tolist():
            node[i] = routes[of["head"][i]][:KEY * (depth + 1)]
        if depth:
            for i in np.flatnonzero(hidden & ~of["skeleton"]).tolist():
                node[i] = routes[of["head"][i]][:KEY * depth]
        ending = ends.take(pa.array(of["head"], mask=~of["own"]))
        yield pa.RecordBatch.from_arrays([
            pa.array(kind, pa.int32()), pa.array(node, pa.binary()), pa.array(np.full(n, above + depth), pa.int64()), pa.array(of["conv_id"], pa.int64()),
            pa.array(parents, pa.int64(), mask=hidden), *(pa.array(of[k], pa.int64()) for k in ("n", "kids", "leaves", "saved", "bytes")), ending],
            names=["kind", "node", "depth", "conv_id", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "bytes", "ends_sha256"])

    for depth in range(int(length.max()), -1, -1):
        active = np.flatnonzero(length >= depth)
        starts = np.flatnonzero(common[active] < depth)
        head = active[starts]
        own = length[head] == depth
        n, conv_id = np.add.reduceat(columns["n"][active], starts), np.minimum.reduceat(columns["conv_id"][active], starts)
        kids, leaves, saved = (np.add.reduceat(a[active], starts) for a in (kids_at, leaves_at, saved_at))
        for a, name in ((kids, "below_children"), (leaves, "below_leaves"), (saved, "below_saved")):
            a += np.where(own, columns[name][head], 0)
        in_skeleton = np.zeros(head.size, bool)
        in_skeleton[0] = head[0] == 0 and depth <= low
        in_skeleton[-1] |= active[-1] == m - 1 and depth <= high
        leaves = np.where((kids == 0) & ~in_skeleton, 1, leaves)
        size = np.array([sizes[i][depth - 1] for i in head.tolist()] if depth else np.zeros(head.size), np.int64)
        # What skeleton nodes add themselves needs their whole number of conversations.
        saved = saved + np.where(in_skeleton, 0, (n - 1) * size)
        if waiting:
            parent = np.searchsorted(head, waiting["head"], "right") - 1
            yield from rows(waiting, conv_id[parent], in_skeleton[parent], depth + 1)
        waiting = {"head": head, "own": own, "n": n, "conv_id": conv_id, "kids": kids, "leaves": leaves, "saved": saved, "bytes": size, "skeleton": in_skeleton}
        for a in (kids_at, leaves_at, saved_at):
            a[:] = 0
        kids_at[head], leaves_at[head], saved_at[head] = ~in_skeleton, leaves, saved
    yield from rows(waiting, None, None, 0)


def build(routes: DataFrame, above: int) -> tuple[DataFrame, DataFrame]:
    """(nodes, portals) of the tries of one segment.

    ``routes``: different routes with n, conv_id, portal_conv, sizes, ends and what lies below. ``portals`` has (portal, children, leaves, saved).
    """
    spark = routes.sparkSession
    stored = cut_lineage(routes)
    dealt = cut_lineage(stored.repartitionByRange(ranges_for(stored, ROUTES_A_SHARD), "route").withColumn("shard", F.spark_partition_id()))
    # Two routes for each shard.
    ranges = dealt.groupBy("shard").agg(F.min("route").alias("low"), F.max("route").alias("high")).orderBy("shard").collect()
    skeleton = Skeleton([(bytes(r.low), bytes(r.high)) for r in ranges])
    trie = spark.sparkContext.broadcast(skeleton)
    numbers = ["n", "conv_id", "portal_conv", "below_children", "below_leaves", "below_saved"]

    def shard(group: pa.Table) -> Iterator[pa.RecordBatch]:
        group = group.take(pc.sort_indices(group.column("route").cast(pa.large_binary())))
        columns = {c: group.column(c).to_numpy() for c in numbers}
        return finish(group.column("route").to_pylist(), group.column("sizes").to_pylist(), columns, group.column("ends").combine_chunks(), above, trie.value)

    def run(group: pa.Table) -> pa.Table:
        return pa.Table.from_batches(shard(group))

    found = cut_lineage(dealt.groupBy("shard").applyInArrow(run, FOUND))
    units = F.octet_length("node") / KEY
    partial = cut_lineage(found.filter(F.col("kind") == PARTIAL).withColumn("portal", F.when(F.col("depth") == above + 1, F.col("parent_conv_id"))).groupBy("node").agg(
        F.max("depth").alias("depth"), F.min("conv_id").alias("conv_id"), *[F.sum(c).alias(c) for c in ("n_convs", "n_children", "n_leaves", "saved_tokens")],
        F.max("bytes").alias("bytes"), F.max("ends_sha256").alias("ends_sha256"), F.max("portal").alias("portal")))
    # A portal has members that end there too: its smallest id comes from the round before.
    # Each skeleton node adds its own tokens to all skeleton nodes above it and itself to its parent's children.
    upwards = partial.select(F.explode(F.sequence(F.lit(1), units.cast("int"))).alias("u"), "node", ((F.col("n_convs") - 1) * F.col("bytes")).alias("own"))
    upwards = upwards.groupBy(F.expr(f"substring(node, 1, u * {KEY})").alias("node")).agg(
        F.sum("own").alias("own"), F.sum((F.col("u") == units - 1).cast("long")).alias("kids"))
    names = partial.select(F.col("node").alias("parent"), F.col("conv_id").alias("skeleton_conv"))
    if skeleton.nodes() <= SKELETON_ROWS:
        names = F.broadcast(names)
    whole = partial.join(upwards, "node").withColumn("parent", F.expr(f"substring(node, 1, octet_length(node) - {KEY})")).join(names, "parent", "left").select(
        "node", "depth", "conv_id", F.coalesce("portal", "skeleton_conv").alias("parent_conv_id"), "n_convs", (F.col("n_children") + F.col("kids")).alias("n_children"), "n_leaves",
        (F.col("saved_tokens") + F.col("own")).alias("saved_tokens"), "ends_sha256")
    whole = cut_lineage(whole)
    local = found.filter(F.col("kind") == LOCAL)
    inside = local.filter("node IS NULL")
    hanging = local.filter("node IS NOT NULL").join(names, F.col("node") == F.col("parent"), "left").withColumn("parent_conv_id", F.col("skeleton_conv"))
    inner = whole.filter(F.col("depth") > above) if above else whole
    nodes = inside.select(NODE).unionByName(hanging.select(NODE)).unionByName(inner.select(NODE))
    portal = ["node", "n_children", "n_leaves", "saved_tokens"]
    portals = found.filter(F.col("kind") == PORTAL).select(portal).unionByName(whole.filter(F.col("depth") == above).select(portal))
    return nodes.fillna({"ends_sha256": NO_ENDS}), portals.toDF("place", "below_children", "below_leaves", "below_saved")


def tails(convs: DataFrame, depth: int) -> DataFrame:
    """Nodes below ``depth`` of conversations (conv_id, total, portal_conv) that share none of them with another."""
    blocks = convs.select("conv_id", "total", "portal_conv", F.explode(F.sequence(F.lit(depth + 1), "total", F.lit(BLOCK).cast("long"))).alias("block")).repartition("conv_id", "block")
    rows = blocks.select("*", F.explode(F.sequence("block", F.least(F.col("block") + BLOCK - 1, "total"))).alias("depth"))
    last, one = F.col("depth") == F.col("total"), F.lit(1).cast("long")
    return rows.select(
        "conv_id", "depth", F.when(F.col("depth") == depth + 1, F.col("portal_conv")).otherwise(F.col("conv_id")).alias("parent_conv_id"), one.alias("n_convs"),
        F.when(last, 0).otherwise(1).cast("long").alias("n_children"), one.alias("n_leaves"), F.lit(0).cast("long").alias("saved_tokens"),
        F.when(last, F.sha2(F.col("conv_id").cast("string"), 256)).otherwise(F.lit(NO_ENDS)).alias("ends_sha256"))


def trie(turns: DataFrame) -> DataFrame:
    """One row of ``NODE`` for each node of the trie of the rebuilt conversations of ``turns`` (see ``turns_of``)."""
    convs = rebuilt(turns).withColumn("portal", F.lit(START)).withColumn("portal_conv", F.lit(0).cast("long"))
    rounds, single, depth = [], [], 0
    while True:
        routed = cut_lineage(routes_of(convs))
        goes_on = F.col("total") > depth + SEGMENT
        different = cut_lineage(routed.groupBy("place", "route").agg(
            F.count("*").alias("n"), F.min("conv_id").alias("conv_id"), F.first("sizes").alias("sizes"), F.first("portal_conv").alias("portal_conv"), F.count(F.when(goes_on, 1)).alias("going")))
        rounds.append((different, routed.filter(~goes_on).select("place", "conv_id")))
        onward = routed.filter(goes_on).select("conv_id", "total", "shift", "place").join(
            different.filter("going > 0").select("place", "going", F.col("conv_id").alias("portal_conv")), "place")
        onward = cut_lineage(onward)
        depth += SEGMENT
        single.append(tails(onward.filter("going = 1"), depth))
        active = onward.filter("going > 1").withColumnRenamed("place", "portal").drop("going")
        if not active.limit(1).count():
            break
        convs = later(turns, active, depth)
    ending = rounds[0][1]
    for _, rows in rounds[1:]:
        ending = ending.unionByName(rows)
    ends = cut_lineage(ends_of(ending))
    found, below = None, None
    for number in reversed(range(len(rounds))):
        routes = rounds[number][0].join(ends, "place", "left")
        counts = {"below_children": F.col("going"), "below_leaves": F.col("going"), "below_saved": F.lit(0).cast("long")}
        if below is None:
            routes = routes.withColumns(counts)
        else:
            routes = routes.join(below, "place", "left").withColumns({c: F.coalesce(F.col(c), other) for c, other in counts.items()})
        nodes, below = build(routes.drop("place", "going"), number * SEGMENT)
        found = nodes if found is None else found.unionByName(nodes)
    for rows in single:
        found = found.unionByName(rows)
    return found


ORACLE = f"""
WITH own AS (SELECT conv_id, list(struct_pack(r := coalesce(role, ''), t := coalesce(text, '')) ORDER BY turn NULLS FIRST) AS turns FROM conversations WHERE conv_id IS NOT NULL GROUP BY conv_id),
sums AS (SELECT conv_id, xor(list_reduce(list_prepend(4294967295, list_transform(string_split(CAST(conv_id AS VARCHAR), ''), lambda c: CAST(ascii(c) AS BIGINT))),
    lambda h, b: list_reduce(list_prepend(xor(h, b), range(8)), lambda x, i: xor(x >> 1, 3988292384 * (x & 1)))), 4294967295) % {HEADS} AS h FROM own),
routes AS (SELECT o.conv_id, coalesce(b.turns[:s.h], []) || o.turns[s.h + 1:] AS turns FROM own o JOIN sums s USING (conv_id) LEFT JOIN own b ON b.conv_id = o.conv_id - o.conv_id % {FAMILY}),
members AS (SELECT conv_id, d, turns[:d] AS path, len(turns) = d AS ending FROM (SELECT conv_id, turns, unnest(range(len(turns) + 1)) AS d FROM routes)),
nodes AS (SELECT path, d, min(conv_id) AS conv_id, count(*) AS n_convs, sha256(coalesce(string_agg(CASE WHEN ending THEN CAST(conv_id AS VARCHAR) END, ',' ORDER BY conv_id), '')) AS ends_sha256,
    (count(*) - 1) * coalesce(strlen(any_value(path[d].t)), 0) AS own FROM members GROUP BY path, d),
kids AS (SELECT path[:d - 1] AS path, count(*) AS n FROM nodes WHERE d > 0 GROUP BY ALL),
below AS (SELECT path[:a] AS path, sum(own) AS saved, count(*) FILTER (childless) AS leaves
    FROM (SELECT n.path, n.own, k.n IS NULL AS childless, unnest(range(n.d + 1)) AS a FROM nodes n LEFT JOIN kids k USING (path)) GROUP BY ALL)
SELECT n.conv_id, CAST(n.d AS BIGINT) AS depth, p.conv_id AS parent_conv_id, n.n_convs, coalesce(k.n, 0) AS n_children, CAST(b.leaves AS BIGINT) AS n_leaves,
    CAST(b.saved AS BIGINT) AS saved_tokens, n.ends_sha256
FROM nodes n JOIN below b USING (path) LEFT JOIN kids k USING (path) LEFT JOIN nodes p ON n.d > 0 AND p.path = n.path[:n.d - 1]"""


@query("op13_prefix_trie", ORACLE)
def op13_prefix_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    return trie(turns_of(table(spark, sf_dir, "conversations"))).select(NODE)

"""Shards by a consistent-hash ring with virtual nodes and bounded loads. DataFrame operations only.

Every shard owns ``VIRTUAL_NODES`` points of a ring of 2^63 places. A row's place is a hash of its id, size and
checksum; its home is the shard of the next point clockwise. A shard takes rows until its load reaches the bound,
the rest of an arc moves on to the next shard clockwise that has room. The bound is the mean load, rounded down in
a first pass and up for the few rows that are left, so shards end at most one row apart.

Which rows of an arc stay and which move on depends on counts alone: arcs are filled in ring order, so an arc is
cut into at most as many runs as there are shards. The cutting works on a table of one row per arc, whose size is
``shards * VIRTUAL_NODES`` whatever the input; rows then need only their rank in their arc, which comes from counts
of small cells of the ring and a rank inside each cell. No window holds a shard or an arc.

Rows that are equal in id, size and checksum are counted first and dealt out as a run of slots, in pieces of ``SLOTS``, so repeated rows
heat neither a cell nor a task. Null ids and null texts are values like any other (a null text has size 1 and checksum 0).
"""

from __future__ import annotations

from bisect import bisect_left

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from weftline.llm.registry import query, table
from weftline.session import cut_lineage

SHARDS = 8
VIRTUAL_NODES = 64
CELL_ROWS = 4096
PIECES_BITS = 12
#: Slots that one row is dealt at a time.
SLOTS = 4096


def place(*columns: Column) -> Column:
    return F.shiftrightunsigned(F.xxhash64(*columns), 1)


def ring_points(spark: SparkSession, shards: int, virtual_nodes: int) -> list[tuple[int, int]]:
    """(point, shard) of every virtual node in ring order. A shard's points don't depend on how many shards there are."""
    nodes = spark.range(shards).select(F.col("id").alias("shard"), F.explode(F.sequence(F.lit(0), F.lit(virtual_nodes - 1))).alias("node"))
    return sorted((r.point, r.shard) for r in nodes.select(place(F.lit("node"), "shard", "node").alias("point"), "shard").collect())


def runs_of(arcs: list[int], owners: list[int], shards: int) -> list[tuple[int, int, int, int, int]]:
    """(arc, from rank, to rank, shard, first slot): which ranks of an arc go to which shard.

    ``arcs`` has the rows of each arc, ``owners`` the shard at its end. Homes are filled first, in ring order; what
    overflows goes clockwise to the next shards below the bound.
    """
    load, taken, runs = [0] * shards, [0] * len(arcs), []

    def fill(arc: int, at: int, bound: int) -> None:
        shard = owners[at % len(arcs)]
        n = min(arcs[arc] - taken[arc], bound - load[shard])
        if n > 0:
            runs.append((arc, taken[arc], taken[arc] + n, shard, load[shard]))
            taken[arc] += n
            load[shard] += n

    low = sum(arcs) // shards
    for arc in range(len(arcs)):
        fill(arc, arc, low)
    for bound in (low, low + 1):
        for arc in range(len(arcs)):
            for step in range(len(arcs)):
                if taken[arc] == arcs[arc]:
                    break
                fill(arc, arc + step, bound)
    return runs


def assign(df: DataFrame, keys: list[str], shards: int = SHARDS, virtual_nodes: int = VIRTUAL_NODES) -> DataFrame:
    """(keys, shard int, slot long), one row for each row of ``df``; slots of a shard count from 0 without a gap.

    Only ``keys`` are read, and they decide alone: rows that are equal in all keys are alike. An empty table gives
    no rows. Null keys are one value.
    """
    spark = df.sparkSession
    renamed = df.select([df[f"`{k}`"].alias(f"k{i}") for i, k in enumerate(keys)])
    names = renamed.columns
    counted = cut_lineage(renamed.groupBy(*names).agg(F.count("*").alias("copies")).withColumn("place", place(*names)))
    total = counted.agg(F.sum("copies")).first()[0] or 0
    cell_bits = min(40, max(0, (total // CELL_ROWS).bit_length()))
    points = ring_points(spark, shards, virtual_nodes)
    marks = [p for p, _ in points]
    width = 63 - PIECES_BITS
    pieces = []
    for piece in range(1 << PIECES_BITS):
        first, end = bisect_left(marks, piece << width), bisect_left(marks, (piece + 1) << width)
        pieces.append((piece, first, marks[first:end]))
    # 2^PIECES_BITS rows and shards * virtual_nodes points in all: small whatever the input.
    lookup = F.broadcast(spark.createDataFrame(pieces, "piece long, first int, inside array<long>"))
    passed = F.size(F.filter("inside", lambda p: p < F.col("place")))
    placed = counted.withColumn("piece", F.shiftrightunsigned("place", width)).join(lookup, "piece").select(
        *names, "copies", "place", ((F.col("first") + passed) % len(points)).alias("arc"), F.shiftrightunsigned("place", 63 - cell_bits).alias("cell"),
        # The first arc also holds the end of the ring; its rows there come before those after zero.
        (F.col("first") + passed < len(points)).cast("int").alias("lap"))
    cells = placed.groupBy("arc", "lap", "cell").agg(F.sum("copies").alias("rows"))
    before = Window.partitionBy("arc").orderBy("lap", "cell").rowsBetween(Window.unboundedPreceding, -1)
    cells = cut_lineage(cells.withColumn("start", F.coalesce(F.sum("rows").over(before), F.lit(0))))
    sizes = {r.arc: r.rows for r in cells.groupBy("arc").agg(F.sum("rows").alias("rows")).collect()}
    runs = runs_of([sizes.get(i, 0) for i in range(len(points))], [s for _, s in points], shards)
    dealt = F.broadcast(spark.createDataFrame(runs, "arc int, low long, high long, shard int, slot long"))
    inside = Window.partitionBy("arc", "lap", "cell").orderBy("place", *names).rowsBetween(Window.unboundedPreceding, -1)
    ranked = placed.withColumn("inner", F.coalesce(F.sum("copies").over(inside), F.lit(0))).join(
        cells.select("arc", "lap", "cell", "start"), ["arc", "lap", "cell"]).withColumn("rank", F.col("start") + F.col("inner"))
    met = cut_lineage(ranked.join(dealt, "arc").filter("low < rank + copies AND high > rank").select(
        *names, "shard", (F.col("slot") - F.col("low")).alias("shift"), F.greatest("low", "rank").alias("first"), (F.least("high", F.expr("rank + copies")) - 1).alias("last")))
    # A row of very many copies is cut into pieces that go to tasks of their own before its slots are dealt out.
    few = F.col("last") - F.col("first") < SLOTS
    pieces = met.filter(~few).select(*names, "shard", "shift", F.explode(F.sequence("first", "last", F.lit(SLOTS).cast("long"))).alias("first"), F.col("last").alias("end"))
    pieces = pieces.withColumn("last", F.least(F.col("first") + SLOTS - 1, "end")).drop("end").repartition("shard", "first")
    out = met.filter(few).unionByName(pieces).select(*names, "shard", "shift", F.explode(F.sequence("first", "last")).alias("at"))
    return out.select(*[F.col(n).alias(k) for n, k in zip(names, keys, strict=True)], "shard", (F.col("shift") + F.col("at")).alias("slot"))


@query("op3_sharding")
def op3_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Law ``rows``: counts of shards are at most one apart. ``grown_shard`` is null under this law."""
    text = F.coalesce("text", F.lit(""))
    docs = table(spark, sf_dir, "documents").select(
        "doc_id", (F.octet_length(text).cast("long") + 1).alias("size"), F.crc32(text.cast("binary")).alias("text_crc32"))
    return assign(docs, docs.columns).select(
        "doc_id", "size", "text_crc32", F.lit("rows").alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard"))

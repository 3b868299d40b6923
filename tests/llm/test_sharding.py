"""The ring against a row-by-row walk, and its bounds."""

import random
import zlib
from collections import Counter

from pyspark.sql import functions as F

from weftline.llm import sharding


def frame(spark, rows):
    return spark.createDataFrame(rows, "id long, size long, sum long, shard string")


def test_balance_slots_and_repeats(spark):
    rows = [(None, 1, 0, "x")] * 5 + [(7, 3, 9, "y")] * 700 + [(i, i % 13, i * 7, None) for i in range(1501)]
    got = sharding.assign(frame(spark, rows), ["id", "size", "sum"], 8).collect()
    assert Counter((r.id, r.size, r.sum) for r in got) == Counter(r[:3] for r in rows)
    loads = Counter(r.shard for r in got)
    assert max(loads.values()) - min(loads.values()) <= 1 and len(loads) == 8
    for shard, n in loads.items():
        assert sorted(r.slot for r in got if r.shard == shard) == list(range(n))


def walk(arcs, owners, shards):
    """Row by row: home while the mean isn't reached, then clockwise to the first shard with room, then one more each."""
    load, place, n = [0] * shards, {}, len(arcs)
    rows = [(arc, rank) for arc in range(n) for rank in range(arcs[arc])]

    def put(row, shard):
        place[row] = (shard, load[shard])
        load[shard] += 1

    mean = len(rows) // shards
    for row in rows:
        if load[owners[row[0]]] < mean:
            put(row, owners[row[0]])
    for bound in (mean, mean + 1):
        for row in rows:
            if row not in place:
                shard = next((owners[(row[0] + k) % n] for k in range(n) if load[owners[(row[0] + k) % n]] < bound), None)
                if shard is not None:
                    put(row, shard)
    return place


def test_runs_against_a_walk_row_by_row():
    draw = random.Random(9)
    for _ in range(60):
        shards, arcs = draw.randrange(1, 6), [draw.choice([0, 0, 1, 3, 40]) for _ in range(draw.randrange(1, 20))]
        owners = [draw.randrange(shards) for _ in arcs]
        # Every shard owns an arc, as every shard has virtual nodes.
        arcs, owners = arcs + [0] * shards, owners + list(range(shards))
        got = {}
        for arc, low, high, shard, slot in sharding.runs_of(arcs, owners, shards):
            got |= {(arc, rank): (shard, slot + rank - low) for rank in range(low, high)}
        assert got == walk(arcs, owners, shards)


def test_many_copies_are_dealt_in_pieces(spark, monkeypatch):
    monkeypatch.setattr(sharding, "SLOTS", 7)
    rows = [(7, 3, 9, "y")] * 200 + [(i, 1, i, "") for i in range(40)]
    got = sharding.assign(frame(spark, rows), ["id", "size", "sum"], 3).collect()
    assert Counter((r.id, r.size, r.sum) for r in got) == Counter(r[:3] for r in rows)
    assert all(sorted(r.slot for r in got if r.shard == k) == list(range(80)) for k in range(3))


def test_empty_and_few_rows(spark):
    assert sharding.assign(frame(spark, []), ["id"], 8).count() == 0
    got = sharding.assign(frame(spark, [(1, 1, 1, "a"), (2, 2, 2, "b")]), ["id", "shard"], 8)
    assert got.columns == ["id", "shard", "shard", "slot"] and len(got.collect()) == 2


def test_most_rows_stay_home_and_a_new_shard_moves_few(spark):
    rows = frame(spark, [(i, 1, i, "") for i in range(6000)])
    points = sharding.ring_points(spark, 8, sharding.VIRTUAL_NODES)
    places = {r.id: r.at for r in rows.select("id", sharding.place(F.col("id")).alias("at")).collect()}
    home = {i: next((s for p, s in points if p >= at), points[0][1]) for i, at in places.items()}
    eight = {r.id: r.shard for r in sharding.assign(rows, ["id"], 8).collect()}
    nine = {r.id: r.shard for r in sharding.assign(rows, ["id"], 9).collect()}
    assert sum(eight[i] == home[i] for i in home) > 0.85 * len(home)
    # A ninth of the rows has to move; overflow shifts some more, far from the eight ninths of a modulus.
    assert sum(eight[i] != nine[i] for i in eight) < 0.35 * len(eight)


def test_query_fields(spark):
    docs = {r.doc_id: r.text for r in spark.read.parquet("/root/testdata/sf0.001/documents.parquet").collect()}
    got = sharding.op3_sharding(spark, "/root/testdata/sf0.001").collect()
    assert len(got) == len(docs)
    for r in got:
        raw = docs[r.doc_id].encode()
        assert (r.size, r.text_crc32, r.law, r.grown_shard) == (len(raw) + 1, zlib.crc32(raw), "rows", None)

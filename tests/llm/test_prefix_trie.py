"""The trie against prefixes held in Python dictionaries."""

import random
import zlib
from hashlib import sha256

import pytest

from weftline.llm import prefix_trie as pt

SCHEMA = "conv_id long, turn long, role string, text string, place string, n long"


def remainder(a, b):
    return a - b * int(a / b)


def tie(turn):
    role, text = turn
    return sha256(f"{len(role.encode())}:{role}{text}".encode()).digest()


def brute(rows):
    own = {}
    for conv, turn, role, text in rows:
        if conv is not None:
            own.setdefault(conv, []).append((turn is not None, turn or 0, tie((role or "", text or "")), (role or "", text or "")))
    own = {c: [t[-1] for t in sorted(turns)] for c, turns in own.items()}
    members = {}
    for c in own:
        h = zlib.crc32(str(c).encode()) % 9
        path = tuple(own.get(c - remainder(c, 5), [])[:h] + own[c][h:])
        for d in range(len(path) + 1):
            members.setdefault(path[:d], []).append((c, d == len(path)))
    kids, leaves, saved = ({} for _ in range(3))
    for path in sorted(members, key=len, reverse=True):
        leaves[path] = leaves.get(path, 0) or 1
        saved[path] = saved.get(path, 0) + ((len(members[path]) - 1) * len(path[-1][1].encode()) if path else 0)
        if path:
            for of, n in ((kids, 1), (leaves, leaves[path]), (saved, saved[path])):
                of[path[:-1]] = of.get(path[:-1], 0) + n
    out = []
    for path, found in members.items():
        ends = ",".join(str(c) for c in sorted(c for c, last in found if last))
        parent = min(members[path[:-1]])[0] if path else None
        out.append((min(found)[0], len(path), parent, len(found), kids.get(path, 0), leaves[path], saved[path], sha256(ends.encode()).hexdigest()))
    return sorted(out, key=str)


def run(spark, rows):
    frame = spark.createDataFrame([(*r, "x", 1) for r in rows], SCHEMA)
    return sorted(map(tuple, pt.trie(pt.turns_of(frame)).select(pt.NODE).collect()), key=str)


def conversation(conv, turns):
    return [(conv, i, role, text) for i, (role, text) in enumerate(turns)]


ODD = [
    (None, 0, "user", "lost"), (1, None, None, "first"), (1, 0, "user", None), (1, 0, "user", None), (1, 3, "user", "ä" * 50_000), (2, 0, "", ""), (-3, 0, "u", "x"), (-5, 0, "u", "base"),
    (-5, 1, "u", "base"), (-4, 0, "u", "y"), (0, 7, "ab", "c"), (5, 7, "a", "bc"), (10, 7, "a", "bc"), (10, 7, "a", "bc"), (11, 0, "s", "t"), (13, 1, "s", "t")]


def test_odd_rows(spark):
    assert run(spark, ODD) == brute(ODD)


def test_empty_and_rows_without_conversation(spark):
    assert run(spark, []) == []
    assert run(spark, [(None, 1, "user", "x")]) == []


def test_random_trees_over_many_shards(spark, monkeypatch):
    draw = random.Random(3)
    rows = []
    for c in range(300):
        rows += conversation(c, [("u", draw.choice("ab" if d < 4 else "abc")) for d in range(draw.randrange(1, 7))])
    monkeypatch.setattr(pt, "ROUTES_A_SHARD", 7)
    # Beyond the bound, skeleton nodes are joined instead of broadcast.
    monkeypatch.setattr(pt, "SKELETON_ROWS", 0)
    assert run(spark, rows) == brute(rows)


@pytest.mark.parametrize("segment", [8, 11])
def test_rounds_of_segments(spark, monkeypatch, segment):
    draw = random.Random(segment)
    rows = []
    for c in range(40):
        rows += conversation(c, [("u", "a")] * draw.choice([0, 5, 8, 15, 22, 23, 33]) + [("u", draw.choice("ab")) for _ in range(draw.randrange(1, 4))])
    rows += conversation(100, [("u", "a")] * 40) + conversation(105, [("u", "a")] * 40) + conversation(110, [("u", "a")] * 16)
    monkeypatch.setattr(pt, "SEGMENT", segment)
    monkeypatch.setattr(pt, "ROUTES_A_SHARD", 5)
    assert run(spark, rows) == brute(rows)


def test_long_and_repeated_conversations(spark, monkeypatch):
    monkeypatch.setattr(pt, "IDS_A_CHUNK", 7)
    monkeypatch.setattr(pt, "BLOCK", 50)
    rows = []
    for c in range(0, 400, 5):
        rows += conversation(c, [("u", "hello"), ("a", "there")])
    for c in (1000, 1005, 1010):
        rows += conversation(c, [("u", str(i)) for i in range(150)])
    rows += [(2000, 1, "u", "again")] * 300 + conversation(2005, [("u", "again")] * 90)
    assert run(spark, rows) == brute(rows)


def test_skeleton_holds_what_borders_share():
    def route(*keys):
        return b"".join(bytes([k]) * pt.KEY for k in keys)

    skeleton = pt.Skeleton([(route(0, 1), route(0, 2, 5)), (route(0, 2, 7), route(0, 9)), (route(0, 9, 1), route(0, 9, 1, 4)), (route(3), route(3, 1))])
    assert skeleton.paths == [route(0, 2), route(0, 9)]
    assert [skeleton.depth(r) for r in (route(0), route(0, 2, 9), route(0, 3), route(0, 9, 1), route(3, 1))] == [0, 1, 0, 1, -1]


def test_query(spark):
    folder = "/root/testdata/sf0.001"
    rows = [tuple(r) for r in spark.read.parquet(f"{folder}/conversations.parquet").select("conv_id", "turn", "role", "text").collect()]
    assert sorted(map(tuple, pt.op13_prefix_trie(spark, folder).collect()), key=str) == brute(rows)

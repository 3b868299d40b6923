"""Traversal, path and centrality operators against plain Python on small random graphs."""

import itertools
import random
from collections import defaultdict, deque
from types import SimpleNamespace

import numpy as np
import pytest
from pyspark.sql import functions as F

from tests.conftest import rows
from weftline.operators import centrality, communities, components, paths, temporal, topology, traversal
from weftline.plans import graph_queries


def random_pairs(seed, n=12, m=22, acyclic=True):
    rng = random.Random(seed)
    found = set()
    while len(found) < m:
        a, b = rng.randrange(n), rng.randrange(n)
        if a == b or (acyclic and a > b):
            continue
        found.add((f"n{a:02d}", f"n{b:02d}"))
    return sorted(found)


def bfs(pairs, root, limit=None):
    out, queue = {root: 0}, deque([root])
    after = defaultdict(list)
    for a, b in pairs:
        after[a].append(b)
    while queue:
        node = queue.popleft()
        if limit is not None and out[node] >= limit:
            continue
        for nxt in after[node]:
            if nxt not in out:
                out[nxt] = out[node] + 1
                queue.append(nxt)
    return {k: d for k, d in out.items() if k != root}


def all_paths(pairs, src, dst):
    after = defaultdict(list)
    for a, b in pairs:
        after[a].append(b)

    def walk(path):
        for nxt in after[path[-1]]:
            if nxt in path:
                continue
            if nxt == dst:
                yield [*path, nxt]
            else:
                yield from walk([*path, nxt])

    return list(walk([src]))


@pytest.mark.parametrize("acyclic,hops", [(True, 1), (True, 4), (False, 3)])
def test_reach_equals_breadth_first_search(edges_of, acyclic, hops):
    pairs = random_pairs(3, acyclic=acyclic)
    edges = edges_of(pairs)
    got = rows(traversal.reach(edges, traversal.roots_of(edges, "src"), hops_per_round=hops))
    want = sorted((r, n, d) for r in {a for a, _ in pairs} for n, d in bfs(pairs, r).items())
    assert got == want
    up = rows(traversal.reach(edges, traversal.roots_of(edges, "dst"), "upstream"))
    assert {(b, a, d) for a, b, d in up} == set(want)


def test_depth_bound_unknown_root_and_node_budget(spark, edges_of):
    edges = edges_of([("a", "b"), ("b", "c"), ("c", "d"), ("a", "x")])
    root = traversal.literal_roots(spark, "a", "nobody")
    assert rows(traversal.reach(edges, root, max_depth=2)) == [("a", "b", 1), ("a", "c", 2), ("a", "x", 1)]
    assert rows(traversal.bounded_reach(edges, root, 5, 2).select("node", "position")) == [("b", 1), ("x", 2)]
    shared = spark.createDataFrame([("tag", "b"), ("tag", "x")], "root string, node string")
    assert rows(traversal.reach(edges, shared)) == [("tag", "c", 1), ("tag", "d", 2)]


def test_incremental_closure_finds_chains_of_new_edges(edges_of):
    pairs = random_pairs(5, n=10, m=16)
    old, new = pairs[::2], pairs[1::2]
    grown = traversal.extend_closure(traversal.closure_table(edges_of(old)), edges_of(new))
    assert rows(grown) == rows(traversal.closure_table(edges_of(pairs)))


def test_simple_and_shortest_paths(spark, edges_of):
    pairs = random_pairs(8, n=8, m=18, acyclic=False)
    edges = edges_of(pairs)
    ends = [("n00", "n05"), ("n01", "n06"), ("n02", "n02")]
    found = paths.simple_paths(edges, spark.createDataFrame(ends, "root string, target string"))
    want = sorted(tuple(p) for a, b in ends[:2] for p in all_paths(pairs, a, b))
    got = sorted(tuple(r["path"]) for r in found.filter("root <> target").collect())
    assert got == want
    short = {(r["root"], r["node"]): r["path"] for r in paths.shortest_paths(edges, traversal.roots_of(edges, "src")).collect()}
    for root in {a for a, _ in pairs}:
        for node in bfs(pairs, root):
            assert short[root, node] == min(all_paths(pairs, root, node), key=lambda p: (len(p), p))


def test_undirected_query_walks_to_the_end(spark, edges_of):
    # Two sources meet after a chain, twelve hops apart; a third one is on its own.
    chain = ["ds_a0", *(f"{kind}{i}" for i in range(1, 5) for kind in ("job_", "ds_"))]
    pairs = [*itertools.pairwise(chain), ("ds_b0", "job_b1"), ("job_b1", "ds_b1"), ("ds_b1", "job_b2"), ("job_b2", "ds_4"), ("ds_c0", "job_c1")]
    names = sorted({x for p in pairs for x in p})
    nodes = spark.createDataFrame([(x, "dataset" if x.startswith("ds") else "job", "n") for x in names], "id string, type string, namespace string")
    got = rows(graph_queries.g11_undirected(SimpleNamespace(graph=(edges_of(pairs), nodes))))
    both = pairs + [(b, a) for a, b in pairs]
    assert got == sorted((root, node, depth) for root in ("ds_a0", "ds_b0", "ds_c0") for node, depth in bfs(both, root).items())
    assert max(depth for _, _, depth in got) == 12


@pytest.mark.parametrize("undirected", [False, True])
def test_paths_of_pairs(spark, edges_of, undirected):
    pairs = random_pairs(31, n=24, m=40, acyclic=False) + [(f"long{i:02}", f"long{i + 1:02}") for i in range(14)] + [("x", "x")]
    both = pairs + [(b, a) for a, b in pairs] if undirected else pairs
    names = sorted({n for p in pairs for n in p})
    wanted = [(a, names[(i * 7 + 3 * k) % len(names)]) for i, a in enumerate(names) for k in range(3)] + [("long00", "long14"), ("x", "x"), ("nowhere", "x"), ("x", "nowhere"), (None, "x")]
    frame = spark.createDataFrame(wanted + wanted[:5], "root string, target string")
    got = {(r.root, r.target): (r.depth, r.path) for r in paths.shortest_path_between(edges_of(pairs), frame, undirected).collect()}
    want = {}
    for root, target in wanted:
        far = {target: 0} | bfs([(b, a) for a, b in both], target)
        if root in far and root in names:
            path = [root]
            while path[-1] != target:
                path.append(min(b for a, b in both if a == path[-1] and far.get(b) == far[path[-1]] - 1))
            want[root, target] = (len(path) - 1, path)
    assert got == want and got["long00", "long14"][0] == 14 and got["x", "x"] == (0, ["x"])
    if not undirected:
        short = paths.shortest_path_between(edges_of(pairs), frame, max_nodes=3).collect()
        assert {(r.root, r.target) for r in short} == {k for k, (depth, _) in want.items() if depth <= 2}
        # One row for each node of a path, no arrays on the way.
        nodes = paths.shortest_path_nodes(edges_of(pairs), frame)
        assert nodes.columns == ["root", "target", "position", "node"] and nodes.count() == sum(len(p) for _, p in want.values())


def brute_components(pairs):
    reached = {a: set(bfs(pairs, a)) | {a} for a in {n for p in pairs for n in p}}
    out = {}
    for a in reached:
        members = {b for b in reached[a] if a in reached[b]}
        if len(members) > 1 or (a, a) in pairs:
            out[a] = min(members)
    return out


def test_strong_components(edges_of):
    ring = [(f"r{i:03}", f"r{(i + 1) % 90:03}") for i in range(90)]
    tail = [(f"t{i:02}", f"t{i + 1:02}") for i in range(12)]
    cases = [
        random_pairs(44, n=40, m=54, acyclic=False),
        [*ring, *tail, ("r007", "t00"), ("t12", "s"), ("s", "s"), ("two", "s"), ("two", "one"), ("one", "two"), ("alone", "r000")]]
    for pairs in cases:
        got = components.strong_components(edges_of(pairs)).collect()
        assert {r.node: r.component for r in got} == brute_components(pairs) and len(got) == len({r.node for r in got})
    assert components.strong_components(edges_of([])).count() == 0


def test_a_long_ring_is_shortened_and_a_cycle_is_seen_at_once(spark, edges_of, monkeypatch):
    ring = spark.range(2000).selectExpr("'n' || id AS src", "'n' || ((id + 1) % 2000) AS dst")
    core, rounds = components.cyclic_core(ring)
    # Thousands of hops, some dozens of rounds.
    assert core.count() < 200 and len(rounds) < 25
    monkeypatch.setattr(paths, "cut_lineage", lambda df: pytest.fail("walked into a cycle"))
    with pytest.raises(ValueError):
        paths.topological_levels(edges_of([("r", "a"), ("a", "b"), ("b", "a")]))


def test_levels_longest_paths_and_cycles(edges_of):
    pairs = random_pairs(11)
    levels = {r["node"]: r["level"] for r in paths.topological_levels(edges_of(pairs)).collect()}
    assert all(levels[a] < levels[b] for a, b in pairs)
    longest = {r["node"]: (r["length"], r["path"]) for r in paths.longest_paths(edges_of(pairs)).collect()}
    assert all(longest[n][0] == levels[n] + 1 == len(longest[n][1]) for n in levels)
    assert paths.cycle_members(edges_of(pairs)).count() == 0
    looped = random_pairs(12, n=10, m=14, acyclic=False)
    want = {a for a in {x for p in looped for x in p} if any(b in bfs(looped, a) or b == a for b, c in looped if c == a and (b == a or b in bfs(looped, a)))}
    assert {r["node"] for r in paths.cycle_members(edges_of(looped)).collect()} == want
    with pytest.raises(ValueError):
        paths.topological_levels(edges_of([("r", "a"), ("a", "b"), ("b", "a")]))


def test_pagerank_solves_the_damped_system(edges_of):
    pairs = random_pairs(21, acyclic=False)
    names = sorted({x for p in pairs for x in p})
    at = {n: i for i, n in enumerate(names)}
    size = len(names)
    step = np.zeros((size, size))
    fan = defaultdict(list)
    for a, b in pairs:
        fan[a].append(b)
    for a in names:
        for b in (fan[a] or names):
            step[at[b], at[a]] += 1.0 / len(fan[a] or names)
    rank = np.full(size, 1.0 / size)
    for _ in range(300):
        rank = 0.15 / size + 0.85 * step @ rank
    got = {r["id"]: r["rank"] for r in centrality.pagerank(edges_of(pairs), tol=1e-9).collect()}
    assert abs(sum(got.values()) - 1) < 1e-9
    assert max(abs(got[n] - rank[at[n]]) for n in names) < 1e-7


def test_betweenness_counts_shortest_paths(edges_of):
    pairs = random_pairs(31, n=9, m=18, acyclic=False)
    names = sorted({x for p in pairs for x in p})
    score = dict.fromkeys(names, 0.0)
    for a, b in itertools.permutations(names, 2):
        found = all_paths(pairs, a, b)
        if not found:
            continue
        best = min(map(len, found))
        short = [p for p in found if len(p) == best]
        for n in names:
            if n not in (a, b):
                score[n] += sum(n in p for p in short) / len(short)
    scale = 1 / ((len(names) - 1) * (len(names) - 2))
    got = {r["id"]: r["score"] for r in centrality.betweenness(edges_of(pairs)).collect()}
    assert max(abs(got[n] - score[n] * scale) for n in names) < 1e-9


def test_components_follow_a_long_chain(edges_of):
    pairs = [(f"c{i:03d}", f"c{i + 1:03d}") for i in range(60)] + [("z1", "z2")]
    got = {r["id"]: r["component"] for r in centrality.components(edges_of(pairs)).collect()}
    assert set(got.values()) == {"c000", "z1"}
    assert got["c060"] == "c000" and got["z2"] == "z1"


def test_removal_breaks_links_and_roots_leaves(spark, edges_of):
    edges = edges_of([("raw", "j1"), ("j1", "mid"), ("mid", "j2"), ("j2", "out"), ("raw", "j3"), ("j3", "out")])
    nodes = spark.createDataFrame([(n, "job" if n.startswith("j") else "dataset") for n in ("raw", "j1", "mid", "j2", "out", "j3")], "id string, type string")
    assert rows(topology.roots(nodes, edges).select("id")) == [("raw",)]
    assert rows(topology.leaves(nodes, edges).select("id")) == [("out",)]
    gone = spark.createDataFrame([("j1",)], "id string")
    assert rows(topology.broken_by_removal(edges, traversal.literal_roots(spark, "raw"), gone)) == [("raw", "j2"), ("raw", "mid")]
    assert topology.type_violations(nodes, edges.union(edges_of([("raw", "out")]))).count() == 1
    counts = traversal.impact_counts(traversal.reach(edges, traversal.literal_roots(spark, "raw")), nodes).first()
    assert (counts["total"], counts["datasets"], counts["jobs"]) == (5, 2, 3)
    radius = traversal.impact_radius(traversal.reach(edges, traversal.literal_roots(spark, "raw"))).select(F.struct("*")).first()[0]
    assert (radius["direct"], radius["depth_2"], radius["total"]) == (2, 4, 5)


def test_counts_have_no_cap(spark, edges_of):
    wide = edges_of([("r", "j")] + [("j", f"d{i}") for i in range(1500)])
    radius = traversal.impact_radius(traversal.reach(wide, traversal.literal_roots(spark, "r"))).first()
    assert (radius["direct"], radius["depth_2"], radius["depth_5"], radius["total"]) == (1, 1501, 1501, 1501)
    chain = edges_of([(f"n{i}", f"n{i + 1}") for i in range(23)])
    nodes = spark.createDataFrame([(f"n{i}", "dataset") for i in range(24)], "id string, type string")
    assert traversal.impact_counts(traversal.reach(chain, traversal.literal_roots(spark, "n0")), nodes).first()["max_depth"] == 23


def test_pages_are_as_long_as_asked(spark):
    from weftline.operators import catalog

    nodes = spark.range(400).selectExpr("format_string('d%03d', id) AS id", "'ns' AS namespace")
    assert catalog.page(nodes, "ns", 250, 10).count() == 250
    with pytest.raises(ValueError):
        catalog.page(nodes, "ns", 0)


def test_communities_come_to_rest(edges_of):
    pairs = [(f"n{i:02d}", f"n{i + 1:02d}") for i in range(40)]
    near = {}
    for a, b in pairs:
        near.setdefault(a, {a}).add(b)
        near.setdefault(b, {b}).add(a)
    now, before = {n: n for n in near}, None
    while True:
        votes = {n: [now[m] for m in near[n]] for n in near}
        after = {n: min(votes[n], key=lambda x: (-votes[n].count(x), x)) for n in near}
        if after == now or after == before:
            break
        now, before = after, now
    got = {r["id"]: r["community"] for r in centrality.communities(edges_of(pairs)).collect()}
    assert got == {n: min(now[n], after[n]) for n in near}


def test_betweenness_in_batches_of_sources(edges_of):
    pairs = random_pairs(21, n=16, m=40, acyclic=False)
    whole = {r["id"]: r["score"] for r in centrality.betweenness(edges_of(pairs)).collect()}
    # Some five batches instead of one.
    parts = {r["id"]: r["score"] for r in centrality.betweenness(edges_of(pairs), batch_rows=140).collect()}
    assert whole.keys() == parts.keys() and all(np.isclose(whole[k], parts[k]) for k in whole) and max(whole.values()) > 0


def test_betweenness_batches_follow_the_rows_that_are_made(edges_of, monkeypatch):
    # Two hundred short chains: no source leads to more than two edges, so 2,000 rows hold far more sources than if each led to all 400.
    pairs = [e for i in range(200) for e in ((f"a{i}", f"b{i}"), (f"b{i}", f"c{i}"))]
    made = []
    one = centrality._dependencies
    monkeypatch.setattr(centrality, "_dependencies", lambda *args: made.append(1) or one(*args))
    got = {r["id"]: r["score"] for r in centrality.betweenness(edges_of(pairs), batch_rows=2_000).collect()}
    assert len(made) <= 4
    assert len(got) == 600 and all(np.isclose(v, (k[0] == "b") / (599 * 598)) for k, v in got.items())


def test_critical_nodes_of_many_sources_take_few_batches(edges_of, monkeypatch):
    # Stars of three levels; the hub of the largest lies on most paths.
    pairs = [e for i in range(60) for e in ([(f"a{i}", f"hub{i:02d}")] + [(f"hub{i:02d}", f"z{i}.{j}") for j in range(1 + i // 10)])]
    made = []
    one = centrality._dependencies
    monkeypatch.setattr(centrality, "_dependencies", lambda *args: made.append(1) or one(*args))
    got = centrality.critical_nodes(edges_of(pairs), top_n=3, batch_rows=1_500).collect()
    n = len({x for p in pairs for x in p})
    assert len(made) <= 4
    assert [(r.id, r.in_degree, r.out_degree, r.total) for r in sorted(got, key=lambda r: r.id)] == [(f"hub{i}", 1, 6, 7) for i in (50, 51, 52)]
    assert all(np.isclose(r.score, 6 / ((n - 1) * (n - 2))) and r.rank > 0 for r in got)


def modularity_of(pairs, community):
    links = {frozenset(p) for p in pairs}
    strength = defaultdict(int)
    for link in links:
        for x in link if len(link) == 2 else [*link, *link]:
            strength[x] += 1
    total = sum(strength.values())
    inside = sum(2 for link in links if len({community[x] for x in link}) == 1)
    sums = defaultdict(int)
    for x, s in strength.items():
        sums[community[x]] += s
    return inside / total - sum(s * s for s in sums.values()) / total ** 2


def partitions(names):
    if not names:
        yield []
        return
    for rest in partitions(names[1:]):
        yield [[names[0]], *rest]
        for i, group in enumerate(rest):
            yield [*rest[:i], [names[0], *group], *rest[i + 1:]]


def test_louvain_communities(spark, edges_of):
    small = [*itertools.combinations("abcd", 2), *itertools.combinations("efgh", 2), ("d", "e"), ("h", "h"), ("b", "a")]
    got = {r.id: r.community for r in communities.louvain(edges_of(small)).collect()}
    best = max(modularity_of(small, {x: i for i, group in enumerate(p) for x in group}) for p in partitions(list("abcdefgh")))
    assert np.isclose(modularity_of(small, got), best) and set(got.values()) == {"a", "e"}
    # Four groups of nodes with many links inside and few between.
    rng = random.Random(8)
    names = [f"g{g}m{i}" for g in range(4) for i in range(8)]
    pairs = sorted({(a, b) for a in names for b in names if a < b and rng.random() < (0.6 if a[:2] == b[:2] else 0.03)})
    edges = edges_of(pairs)
    found = communities.louvain(edges)
    label = {r.id: r.community for r in found.collect()}
    spread = {r.id: r.community for r in centrality.communities(edges).collect()}
    assert np.isclose(communities.modularity(edges, found), modularity_of(pairs, label))
    assert modularity_of(pairs, label) >= max(modularity_of(pairs, spread), modularity_of(pairs, {x: x[:2] for x in names})) - 1e-9
    assert all(label[c] == c == min(x for x in label if label[x] == c) for c in set(label.values()))


def test_louvain_in_one_task_is_louvain_over_tables(spark, edges_of):
    rng = random.Random(5)
    names = [f"g{g}é{i}" for g in range(3) for i in range(5)]
    pairs = [(a, b) for a in names for b in names if rng.random() < (0.4 if a[:2] == b[:2] else 0.05)] + [("alone", "alone"), ("x", "y"), ("y", "x"), (None, "x"), ("z", None)]
    edges = edges_of(pairs)
    one, tables = ({r.id: r.community for r in communities.louvain(edges, task_links=n).collect()} for n in (10_000, 0))
    assert one == tables and set(one) == {x for p in pairs for x in p if x} and len(set(one.values())) < len(one)
    assert communities.louvain(edges.limit(0)).count() == 0
    # The order of names, the coins and the rounding are Spark's.
    coins = [r.coin for r in spark.createDataFrame([(n,) for n in names], "id string").select(F.pmod(F.xxhash64(F.lit(3), F.lit(7), "id"), F.lit(4)).alias("coin")).collect()]
    none = np.zeros(0, np.int64)
    arrays = communities._Arrays(communities.pa.array(names), none, none, none, np.zeros(len(names)))
    assert [next(p for p in range(4) if arrays.turn(3, 7, 4, p)[i]) for i in range(len(names))] == coins


def test_intervals_meet_instants_on_few_bins(spark):
    rng = random.Random(2)
    day = 86_400
    times = [rng.randrange(0, 20 * 365 * day) for _ in range(60)] + [0, 20 * 365 * day]
    spans = [(rng.randrange(-day, 20 * 365 * day), rng.choice([1, 60, day, 400 * day, 20 * 365 * day])) for _ in range(80)] + [(0, 20 * 365 * day), (times[3], 0), (-5 * day, day), (20 * 365 * day + 1, 5)]
    rows = [(f"s{i}", "d", a, None if i % 9 == 0 else a + n) for i, (a, n) in enumerate(spans)]
    versions = spark.createDataFrame(rows, "src string, dst string, f long, t long").selectExpr("src", "dst", "timestamp_seconds(f) AS valid_from", "timestamp_seconds(t) AS valid_to")
    instants = spark.createDataFrame([(t,) for t in times * 2], "t long").selectExpr("timestamp_seconds(t) AS at")
    for levels in (3, 20):
        found = temporal.active_at_each(versions, instants, levels=levels)
        got = sorted((r.a, r.src) for r in found.selectExpr("unix_seconds(at) AS a", "src").collect())
        assert got == sorted((t, src) for t in set(times) for src, _, a, b in rows if a <= t and (b is None or t <= b))
    # Twenty years by the day would be 7,300 rows; the cover has two bins a level at most.
    one = spark.sql("SELECT 3L AS first, (1L << 20) - 2 AS last")
    cover = [(r.bin << r.level, (r.bin + 1 << r.level) - 1) for r in temporal.tree_cover(one, 20).collect()]
    assert len(cover) < 40 and sorted(cover)[0][0] == 3 and all(b[0] == a[1] + 1 for a, b in itertools.pairwise(sorted(cover))) and max(cover)[1] == (1 << 20) - 2
    assert temporal.active_at_each(versions, instants.limit(0)).count() == 0


def test_models_affected_by_data_store_no_pairs(spark, tmp_path):
    from pathlib import Path

    import __spark_entry__
    from weftline.session import checkpoint_root

    rng = random.Random(4)
    parts, suppliers = [*range(40), 3, None], [*range(6), 2, None]
    items = [(rng.choice([*range(45), None]), rng.choice([*range(8), None])) for _ in range(300)]
    frames = {
        "events": spark.range(10).selectExpr("id AS event_id"), "part": spark.createDataFrame([(p, 1.0) for p in parts], "p_partkey long, p_retailprice double"),
        "supplier": spark.createDataFrame([(x, 1, 1.0) for x in suppliers], "s_suppkey long, s_nationkey int, s_acctbal double"),
        "lineitem": spark.createDataFrame(items, "l_partkey long, l_suppkey long")}
    for name, frame in frames.items():
        frame.write.parquet(f"{tmp_path}/{name}.parquet")
    folder = Path(checkpoint_root(spark).removeprefix("file:"))
    before = sorted(folder.iterdir())
    got = rows(__spark_entry__.queries()["m03_models_affected_by_data"](spark, str(tmp_path)))
    want, declared = set(), {x for x in suppliers if x is not None}
    for p in (p for p in parts if p is not None):
        for d in (p % 24, p * 5 % 24):
            want.add((f"ds_0_{d}", f"feature_{p}", "feature"))
            want |= {(f"ds_0_{d}", f"model_{x}:{1 + x % 3}", "model") for q, x in items if q == p and x in declared and p % 11}
    want |= {(f"ds_1_{x % 24}", f"model_{x}:{1 + x % 3}", "model") for x in declared}
    assert got == sorted(want) and sorted(folder.iterdir()) == before

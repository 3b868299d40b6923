"""The join against all pairs."""

import random
import re

import numpy as np
import pyarrow as pa
import pytest

from pyspark.sql import functions as F

from weftline.llm import jaccard_join as jj

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def shingles(text):
    w = WORD.findall(re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    return {tuple(w[i:i + 3]) for i in range(len(w) - 2)} if len(w) >= 3 else {tuple(w)} - {()}


def brute(rows):
    sets = [shingles(t) for _, t in rows]
    root = list(range(len(rows)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for i in range(len(rows)):
        for j in range(i):
            both = len(sets[i] & sets[j])
            if both and 100 * both >= 90 * (len(sets[i]) + len(sets[j]) - both):
                root[find(i)] = find(j)
    ids = {}
    for i, (d, _) in enumerate(rows):
        if d is not None:
            ids[find(i)] = min(ids.get(find(i), d), d)
    return [(str(d), len(s), str(ids.get(find(i)) if s else d)) for i, ((d, _), s) in enumerate(zip(rows, sets, strict=True))]


def check(spark, rows):
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    got = sorted((str(r.id), r.n, str(r.component)) for r in jj.groups(df).collect())
    assert got == sorted(brute(rows))
    return got


def edited(rng, words, edits):
    out = list(words)
    for _ in range(edits):
        at = rng.randrange(len(out))
        kind = rng.random()
        if kind < 0.4:
            out[at] = f"new{rng.randrange(10**6)}"
        elif kind < 0.7:
            del out[at]
        else:
            out.insert(at, f"new{rng.randrange(10**6)}")
    return " ".join(out)


def test_near_copies_passages_and_odd_rows(spark):
    rng = random.Random(5)
    fresh = lambda n: [f"w{rng.randrange(400)}" for _ in range(n)]
    rows, passage = [], fresh(60)
    for size, members, edits in [(300, 70, 5), (80, 40, 2), (500, 6, 9), (45, 30, 1), (12, 25, 1), (1500, 25, 30)]:
        base = fresh(size)
        rows += [" ".join(base)] * 3 + [edited(rng, base, rng.randrange(edits + 1)) for _ in range(members)]
    # Texts put together from shared passages, so that all their tokens are frequent.
    lines = [fresh(30) for _ in range(8)]
    rows += [" ".join(sum(rng.sample(lines, 5), [])) for _ in range(60)]
    rows += [" ".join(passage + fresh(rng.choice([2, 20, 300]))) for _ in range(60)]
    # A chain whose ends are far apart.
    link = fresh(200)
    for _ in range(12):
        rows.append(" ".join(link))
        link = edited(rng, link, 4).split()
    rows += [None, "", " \t\n", "one", "one", "ONE", "one two", "one two three", "one\x0btwo", "a b c d e f g h i j k", "a b c d e f g h i j k l", "a b c d e f g h i"]
    rng.shuffle(rows)
    rows = list(enumerate(rows)) + [(None, "a b c d e f g h i j k"), (None, "none alike here"), (None, None), (3, rows[3]), (3, "other text of the same id")]
    got = check(spark, rows)
    assert len({c for _, _, c in got}) < len(got) - 150


@pytest.mark.parametrize("rows", [[], [(1, None)], [(5, "x y z"), (2, "x y z")]])
def test_small_tables(spark, rows):
    check(spark, rows)


def test_borders_of_the_threshold(spark):
    words = [f"t{i}" for i in range(11)]
    # 9 of 10, 18 of 20 and 17 of 19 tokens.
    rows = [(1, " ".join(words)), (2, " ".join([*words, "x"])), (3, " ".join(f"u{i}" for i in range(20))), (4, " ".join(f"u{i}" for i in range(22))), (5, " ".join(f"v{i}" for i in range(19))), (6, " ".join(f"v{i}" for i in range(21)))]
    got = check(spark, rows)
    assert ("2", 10, "1") in got and ("4", 20, "3") in got and ("6", 19, "6") in got


def test_keep_first_keeps_columns(spark):
    rows = [(3, "a b c d", "p"), (1, "A b c d", "q"), (None, "a b c d", "r"), (4, "", "s"), (5, None, "t"), (6, "", "u")]
    df = spark.createDataFrame(rows, "doc_id long, text string, key string")
    kept = jj.keep_first(df)
    assert kept.columns == df.columns
    assert sorted(r.key for r in kept.collect()) == ["q", "s", "t", "u"]


def test_keep_first_keeps_one_row_of_each_group(spark):
    near = [f"n{i}" for i in range(40)]
    rows = [
        (1, "a b c d", "p"), (1, "a b c d", "q"), (1, "A b c d", "p"), (2, "a b c d", "r"), (2, "a b c d", "r"),  # repeated rows and two texts of the smallest id
        (None, "x y z", "s"), (None, "x y z", "s"), (None, "X y z", "t"), (None, "none alike here", "t"),  # no ids
        (3, " ".join(near), "u"), (3, " ".join([*near, "more"]), "u"), (3, "other text of the same id", "v"),
        (4, "", "w"), (4, "", "w"), (None, None, "w"), (None, None, "w")]
    df = spark.createDataFrame(rows, "doc_id long, text string, key string").repartition(3)
    kept = jj.keep_first(df)
    assert kept.columns == df.columns
    got = sorted((str(r.doc_id), (r.text or "").lower()[:5]) for r in kept.collect())
    assert got == sorted([("1", "a b c"), ("None", "x y z"), ("None", "none "), ("3", "n0 n1"), ("3", "other"), ("4", ""), ("4", ""), ("None", ""), ("None", "")])
    assert set(map(tuple, kept.collect())) <= set(rows)


def clusters(members, seed=5):
    """Copies of a text of 100 words with up to ten of them replaced."""
    draw, rows = random.Random(seed), []
    for _ in range(2):
        base = [f"w{draw.randrange(10 ** 6)}" for _ in range(100)]
        for _ in range(members):
            own = list(base)
            for _ in range(draw.randrange(11)):
                own[draw.randrange(100)] = f"x{draw.randrange(10 ** 9)}"
            rows.append((len(rows), " ".join(own)))
    return rows


def test_pairs_grow_with_the_members_of_a_cluster(spark, monkeypatch):
    made, real = [], jj.pairs_of

    def counting(left, right, condition, percent):
        met = left.alias("a").join(right.alias("b"), (F.col("a.sig") == F.col("b.sig")) & condition & jj.near(percent))
        made[-1] += met.count()
        return real(left, right, condition, percent)

    monkeypatch.setattr(jj, "pairs_of", counting)
    for members in (60, 300):
        made.append(0)
        rows = clusters(members)
        jj.groups(spark.createDataFrame(rows, "doc_id long, text string"), words=5, percent=80)
    # Five times the members; all their pairs would be 25 times as many.
    assert made[1] < 7 * made[0]


def test_members_with_many_own_tokens_make_no_pairs(spark, monkeypatch):
    rng = random.Random(11)
    base = [rng.choice("abcdefghijklmnop") + str(rng.randrange(10**6)) for _ in range(3000)]
    rows = []
    for i in range(20):
        words = list(base)
        # 56 own words are 168 own tokens: two members differ by 336 tokens, and 90 percent allows 314.
        for place in rng.sample(range(0, 3000, 4), 56):
            words[place] = f"own{i}x{place}"
        rows.append((i, " ".join(words)))
    rows.append((20, rows[0][1] + " end"))
    made, real = [], jj.linked

    def counting(pairs, sets, percent):
        made.append(pairs.count())
        return real(pairs, sets, percent)

    monkeypatch.setattr(jj, "linked", counting)
    check(spark, rows)
    assert sum(made) <= len(rows)


def test_sketches_bound_the_difference():
    rng = np.random.default_rng(1)
    texts = [" ".join(map(str, rng.integers(0, 50, 200))) for _ in range(6)]
    own = jj.Sets(pa.array(texts), 3)
    sketch = own.sketches().view(np.uint64)
    for i in range(6):
        for j in range(6):
            a, b = (set(own.tokens[own.first[k]:own.first[k] + own.sizes[k]].tolist()) for k in (i, j))
            assert sum(int(x).bit_count() for x in sketch[i] ^ sketch[j]) <= len(a ^ b)


def test_query(spark):
    folder = "/root/testdata/sf0.001"
    rows = [tuple(r) for r in spark.read.parquet(f"{folder}/documents.parquet").select("doc_id", "text").collect()]
    assert sorted((str(a), b, str(c)) for a, b, c in jj.op7_jaccard_join(spark, folder).collect()) == sorted(brute(rows))

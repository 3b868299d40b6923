"""The bounds against all scores."""

import math

import numpy as np
import pytest

from weftline.llm import topk


def brute(rows, wanted, k=5):
    def usable(v):
        return v is not None and all(x is not None and math.isfinite(x) for x in v)

    ints = [(i, [math.floor(256 * float(np.float32(x))) for x in v]) for i, v in rows if i is not None and usable(v)]
    out = []
    for i, q in {(i, tuple(v)) for i, v in ints if wanted(i)}:
        scores = sorted((-sum(a * b for a, b in zip(q, v, strict=True)), j) for j, v in ints if j != i and len(v) == len(q))
        out += [(i, r, j, -s) for r, (s, j) in enumerate(scores[:k], 1)]
    return sorted(out)


def frame(spark, rows):
    return spark.createDataFrame(rows, "vec_id long, embedding array<float>").selectExpr("vec_id", "embedding", "'x' AS score", "1 AS query_id")


@pytest.fixture(scope="module")
def rows():
    rng = np.random.default_rng(1)
    vectors = [(i, [float(x) for x in rng.normal(0, 0.4, 6).astype(np.float32)]) for i in range(700)]
    ties = [(1000 + i, [0.5, -0.25, 0.0, 0.0, 1.0, 0.125]) for i in range(30)]
    odd = [(2000, None), (2050, [None, 1.0]), (2100, [float("nan")] * 6), (2150, [float("inf")] * 6), (None, [9.0] * 6), (2200, []), (2250, []), (2300, [1.0]), (2350, [2.0]), (50, [0.1] * 6)]
    return vectors + ties + odd + ties[:3]


@pytest.mark.parametrize("block, chunk, resolve", [(4096, 256, 64), (97, 7, 6)])
def test_all_scores(spark, rows, monkeypatch, block, chunk, resolve):
    for name, value in [("BLOCK_ROWS", block), ("TASK_ROWS", 4 * block), ("CHUNK", chunk), ("RESOLVE", resolve)]:
        monkeypatch.setattr(topk, name, value)
    df = frame(spark, rows)
    got = topk.search(df, df.filter("vec_id % 50 = 0"))
    assert got.columns == ["query_id", "rank", "vec_id", "score"]
    assert sorted(map(tuple, got.collect())) == brute(rows, lambda i: i % 50 == 0)


def test_blocks_alone():
    rng = np.random.default_rng(2)
    values, ids = rng.integers(-300, 300, (500, 9)), rng.permutation(500)
    for scale in (1, 10_000, 1 << 21):
        block = topk.Block(ids, values * scale)
        found = block.search(np.array([7, -1]), values[:2] * scale, 4, np.full(2, -np.inf))
        for i, q in enumerate(values[:2]):
            exact = sorted((-int(s), int(j)) for s, j in zip(values @ q, ids, strict=True) if j != [7, -1][i])[:4]
            best = sorted((-int(s), int(ids[r])) for r, s in zip(*found[i], strict=True))[:4]
            assert best == [(s * scale * scale, j) for s, j in exact]


def test_few_and_no_rows(spark):
    few = [(0, [1.0, 0.0]), (1, [0.5, 0.5])]
    df = frame(spark, few)
    assert sorted(map(tuple, topk.search(df, df.filter("vec_id % 50 = 0")).collect())) == brute(few, lambda i: i % 50 == 0)
    assert topk.search(df.limit(0), df.limit(0)).count() == 0

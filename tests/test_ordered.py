"""Order statistics and windows with one key that holds most of the rows."""

import random
import statistics
from collections import defaultdict

import pytest
from pyspark.sql import functions as F

from weftline.functions import ordered
from weftline.operators import quality


@pytest.fixture(scope="module")
def skewed(spark):
    rng = random.Random(7)
    data = []
    for i in range(1500):
        key = "hot" if rng.random() < 0.6 else f"k{rng.randrange(5)}"
        data.append((i, key, round(rng.choice([rng.gauss(1e6, 3), 5.0, rng.random()]), 4), i // 50))
    return data, spark.createDataFrame(data, "i int, key string, v double, day int")


def by_key(data):
    out = defaultdict(list)
    for i, key, v, _ in data:
        out[key].append((i, v))
    return out


def test_running_moments_match_a_scan(skewed):
    data, df = skewed
    got = {r["i"]: r for r in ordered.running_moments(df, ["key"], "v", ["i"], F.col("day")).collect()}
    for values in by_key(data).values():
        for n, (i, _) in enumerate(values):
            before = [v for _, v in values[:n]]
            assert got[i]["prior_n"] == n
            if n >= 2:
                assert got[i]["prior_mean"] == pytest.approx(statistics.fmean(before), rel=1e-9)
                assert got[i]["prior_stdev"] == pytest.approx(statistics.stdev(before), rel=1e-6)


def test_positions_match_a_scan(skewed):
    data, df = skewed
    got = {r["i"]: r["position"] for r in ordered.positions(df, ["key"], ["i"], F.col("day")).collect()}
    assert all(got[i] == n + 1 for values in by_key(data).values() for n, (i, _) in enumerate(values))


def test_ranks_and_quantiles_are_exact(skewed):
    data, df = skewed
    ranks = {r["key"]: r for r in ordered.values_at_ranks(df, ["key"], "v", {"p99": F.floor(F.col("n") * 0.99), "least": F.lit(0)}).collect()}
    mids = {r["key"]: r for r in ordered.quantiles(df, ["key"], "v", {"q": 0.5}).collect()}
    for key, values in by_key(data).items():
        seen = sorted(v for _, v in values)
        assert ranks[key]["p99"] == seen[int(len(seen) * 0.99)]
        assert ranks[key]["least"] == seen[0]
        assert mids[key]["q"] == pytest.approx(statistics.median(seen))


def test_previous_value_crosses_buckets(skewed):
    data, df = skewed
    got = {r["i"]: r["before"] for r in ordered.previous_value(df, ["key"], "v", "i", F.col("day"), "before").collect()}
    for values in by_key(data).values():
        assert [got[i] for i, _ in values] == [None] + [v for _, v in values[:-1]]


def test_equal_values_have_no_spread(spark):
    df = spark.createDataFrame([(i, "a", 0.1, i // 3) for i in range(12)] + [(12, "a", 9.0, 4)], "i int, key string, v double, day int")
    plain = {r["i"]: r["is_anomaly"] for r in quality.z_scores(df, ["key"], "v", ["i"], F.col("day")).collect()}
    strict = {r["i"]: r["is_anomaly"] for r in quality.z_scores(df, ["key"], "v", ["i"], F.col("day"), zero_spread_is_anomaly=True).collect()}
    assert plain[12] is False and strict[12] is True and strict[11] is False


def test_top_rows_cut_before_the_shuffle(skewed):
    _, df = skewed
    top = ordered.top_rows(df, ["key"], [F.desc("i")], 3)
    assert top.filter("key = 'hot'").count() == 3
    plan = top._jdf.queryExecution().executedPlan().toString()
    assert plan.count("WindowGroupLimit") == 2

"""Held-out quality of the classifier, its prior, and odd rows."""

import zlib

import numpy as np
import pyarrow as pa
import pytest

from weftline.llm import quality

FOLDER = "/root/testdata/sf0.01"


@pytest.fixture(scope="module")
def result(spark):
    return {r.doc_id: r for r in quality.op2_quality(spark, FOLDER).collect()}


def test_held_out_rows_are_told_apart(spark, result):
    labels = {r.doc_id: r.quality for r in spark.read.parquet(f"{FOLDER}/labels.parquet").collect()}
    held = [(result[d].score, result[d].predicted, q) for d, q in labels.items() if zlib.crc32(str(d).encode()) % 4 == 2]
    good, bad = [s for s, _, q in held if q], [s for s, _, q in held if not q]
    assert len(good) > 20 and len(bad) > 5
    assert np.mean([g > b for g in good for b in bad]) > 0.97
    assert np.mean([p == q for _, p, q in held]) > 0.93
    assert np.mean([p for _, p, q in held if q]) > 0.95


def test_fields(spark, result):
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet").select("doc_id").collect()
    assert len(result) == len(docs)
    for d, r in result.items():
        assert r.held_out == (zlib.crc32(str(d).encode()) % 4 == 2)
        assert 0 <= r.score <= 1 and r.predicted == int(r.score >= 0.7)


def test_prior_of_a_known_mixture():
    rng = np.random.default_rng(3)
    positive = rng.normal(2, 1, 5000)
    unlabelled = np.where(rng.random(8000) < 0.6, rng.normal(2, 1, 8000), rng.normal(-2, 1, 8000))
    assert abs(quality.class_prior(positive, unlabelled) - 0.6) < 0.05


def test_features_by_hand():
    rows = quality.features(pa.array(["Ab ab\nX!!", None, ""]))
    at = quality.N_CLASSES + quality.N_CLASSES ** 2
    assert not rows[1:].any()
    assert rows[0][:4] == pytest.approx([3 / 9, 2 / 9, 0, 1 / 9])
    assert rows[0][at:at + 5] == pytest.approx([1 / 3, 0, 0, 1 / 3, 0])
    assert quality.features(pa.array([], pa.string())).shape == (0, quality.N_FEATURES)


def test_odd_rows_and_clashing_columns(spark, tmp_path):
    rows = [(1, None, 5.0), (None, "", 5.0), (3, "x", 5.0), (3, "x", 5.0), (4, "a b " * 30000, 5.0)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, score double")
    labels = spark.createDataFrame([(3, 1), (4, None), (None, 1), (3, 1)], "doc_id long, quality int")
    got = quality.score(docs, quality.fit_labels(docs, labels))
    assert got.columns == ["doc_id", "text", "score", "predicted"]
    out = got.collect()
    assert len(out) == 5 and all(0 <= r.score <= 1 for r in out)
    assert len({r.score for r in out if r.text == "x"}) == 1
    nothing = quality.fit_labels(docs.limit(0), labels)
    assert {r.score for r in quality.score(docs, nothing).collect()} == {0.5}
    assert quality.score(docs.limit(0), nothing).count() == 0

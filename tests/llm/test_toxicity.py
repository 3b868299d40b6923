"""The field against sums over all taggings, its gradients against differences, and the query on held-out rows."""

import itertools

import numpy as np
import pyarrow as pa
import pytest

from weftline.llm import toxicity as tox

MOVES, BEGIN = np.array([[0.3, -1.1], [-0.4, 0.9]]), np.array([0.2, -0.7])


def brute_marginals(scores):
    """By the weight of every tagging of one text."""
    total, toxic = 0.0, np.zeros(len(scores))
    for tags in itertools.product((0, 1), repeat=len(scores)):
        weight = BEGIN[tags[0]] + sum(MOVES[a, b] for a, b in zip(tags, tags[1:], strict=False)) + sum(s for s, t in zip(scores, tags, strict=True) if t)
        total += np.exp(weight)
        toxic += np.exp(weight) * np.array(tags)
    return toxic / total


@pytest.mark.parametrize("chunk, block", [(2, 3), (3, 7), (64, 1 << 19)])
def test_marginals_by_all_taggings(monkeypatch, chunk, block):
    monkeypatch.setattr(tox, "CHUNK", chunk)
    monkeypatch.setattr(tox, "BLOCK", block)
    draw = np.random.default_rng(2)
    texts = [draw.normal(0, 2, n) for n in (1, 9, 4, 1, 10)]
    first = np.concatenate([np.arange(len(t)) == 0 for t in texts])
    got = tox.marginals(np.concatenate(texts), first, MOVES, BEGIN)
    assert np.allclose(got, np.concatenate([brute_marginals(t) for t in texts]))


def test_marginals_of_extreme_scores_and_long_texts():
    scores = np.tile([500.0, -500.0, 0.0], 2000)
    got = tox.marginals(scores, np.arange(scores.size) == 0, MOVES, BEGIN)
    assert np.isfinite(got).all() and got[0] > 0.999 and got[1] < 0.001


def test_likelihood_and_its_gradients():
    draw = np.random.default_rng(4)
    scores, tags = draw.normal(size=(3, 4)), draw.integers(0, 2, (3, 4))
    inside = np.array([[1, 1, 1, 1], [1, 1, 0, 0], [1, 0, 0, 0]], bool)
    value, *slopes = tox.log_likelihood(scores, tags, inside, MOVES, BEGIN)
    want = 0.0
    for s, t, n in zip(scores, tags, inside.sum(axis=1), strict=True):
        def weight(path):
            return BEGIN[path[0]] + sum(MOVES[a, b] for a, b in zip(path, path[1:], strict=False)) + sum(x for x, y in zip(s, path, strict=False) if y)  # noqa: B023
        want += weight(t[:n]) - np.log(sum(np.exp(weight(p)) for p in itertools.product((0, 1), repeat=int(n))))
    assert np.isclose(value, want)
    for k, start in enumerate((scores, MOVES, BEGIN)):
        for at in np.ndindex(start.shape):
            both = []
            for step in (1e-5, -1e-5):
                moved = [scores.copy(), MOVES.copy(), BEGIN.copy()]
                moved[k][at] += step
                both.append(tox.log_likelihood(moved[0], tags, inside, moved[1], moved[2])[0])
            assert np.isclose(slopes[k][at], (both[0] - both[1]) / 2e-5, atol=1e-6)


def test_units_features_and_spans():
    tokens = tox.Tokens(pa.array(["Ab, ABC-abcdef", None, "", "é abcdxx ab"]))
    assert tokens.doc.tolist() == [0, 0, 0, 3, 3, 3]
    units = tokens.units(0, 6)
    assert units[2, 1] == units[4, 1] and units[2, 0] != units[4, 0] and units[0, 0] == units[5, 0]
    features = tokens.features(0, 6)
    assert (features[[0, 3], tox.KINDS] == 0).all() and (features[[2, 5], tox.KINDS + 1] == 0).all()
    assert np.array_equal(features[2:5], tokens.features(2, 5))
    spans = tox.spans_of(tokens, np.array([0.9, 0.8, 0.1, 0.7, 0.2, 0.6])).to_pylist()
    assert [[(s["start"], s["end"]) for s in doc] for doc in spans] == [[(0, 7)], [], [], [(0, 1), (9, 11)]]


def test_lower_bound():
    got = tox.lower_bound(np.array([0, 6, 7, 100, 10]), np.array([5, 0, 0, 100, 1]), 2.5)
    assert got[0] < 0.01 and got[1] < 0.5 <= got[2] and got[3] < 0.5 < got[4]


def documents(spark, rows):
    return spark.createDataFrame(rows, "doc_id long, text string, score string")


def test_labels_tables_without_them_and_odd_rows(spark):
    rows = [(1, "vile words", "a"), (1, "vile words", "a"), (None, None, "b"), (2, "", None), (3, "x" * 200_000 + " vile", "c")]
    docs = documents(spark, rows)
    for labels, score in (([], 0.5), ([(1, 1)], 0.5), ([(1, 1), (1, 0), (2, 0), (None, 1), (3, None)], 0.5 * 1)):
        model = tox.fit(docs, spark.createDataFrame(labels, "doc_id long, toxic int"))
        got = tox.score(docs, model)
        assert got.columns == ["doc_id", "text", "score", "predicted", "spans"]
        assert {(r.score, r.predicted, len(r.spans)) for r in got.collect()} == {(score, 0, 0)} and got.count() == len(rows)
    assert tox.score(documents(spark, []), model).count() == 0


def test_learnt_words_are_found_in_other_texts(spark, monkeypatch):
    monkeypatch.setattr(tox, "LABELS_A_RANGE", 50)
    plain = [f"w{i % 37} w{i % 11} some w{i % 7} text here" for i in range(300)]
    rows = [(i, t.replace("some", "rudewordy" if i % 2 else "rudewordz") if i % 5 == 0 else t, "") for i, t in enumerate(plain)]
    labels = spark.createDataFrame([(i, int(i % 5 == 0)) for i in range(300)], "doc_id long, toxic int")
    model = tox.fit(documents(spark, rows), labels)
    # A word that wasn't seen shares its first letters with those that were.
    fresh = documents(spark, [(1, "here Rudewordquux text", ""), (2, "w1 text here", ""), (3, None, ""), (4, "y " * 5000 + "rudewordy", "")])
    got = {r.doc_id: r for r in tox.score(fresh, model).collect()}
    assert [got[i].predicted for i in (1, 2, 3, 4)] == [1, 0, 0, 1]
    assert [tuple(s) for s in got[1].spans] == [(5, 17)] and [tuple(s) for s in got[4].spans] == [(10_000, 10_009)]


def test_query_on_held_out_rows(spark):
    folder = "/root/testdata/sf0.1"
    docs = {r.doc_id for r in spark.read.parquet(f"{folder}/documents.parquet").select("doc_id").collect()}
    labels = {r.doc_id: r.toxic for r in spark.read.parquet(f"{folder}/labels.parquet").collect()}
    got = tox.op11_toxicity(spark, folder).collect()
    assert {r.doc_id for r in got} == docs
    held = [(labels[r.doc_id], r.score, r.predicted) for r in got if r.held_out and r.doc_id in labels]
    toxic, clean = [s for y, s, _ in held if y], [s for y, s, _ in held if not y]
    # Some labels of these tables are wrong, and some languages have a few dozen toxic texts of invented words.
    assert np.mean([a > b for a in toxic for b in clean]) > 0.9
    assert np.mean([p for y, _, p in held if y]) > 0.7 and np.mean([p for y, _, p in held if not y]) < 0.01

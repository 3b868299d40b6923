"""Held-out accuracy of the network, its gradients, and odd rows."""

import zlib

import numpy as np
import pytest

from weftline.llm import language

FOLDER = "/root/testdata/sf0.01"


@pytest.fixture(scope="module")
def network(spark):
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet").select("doc_id", "text", "lang")
    return language.fit_labels(docs)


def test_held_out_accuracy(spark, network):
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet")
    got = language.identify(docs.select("doc_id", "text", "lang"), network).collect()
    held = [r for r in got if zlib.crc32(str(r.doc_id).encode()) % 4 == 2 and r.lang_pred != "und"]
    assert len(held) > 150
    assert np.mean([r.lang == r.lang_pred for r in held]) > 0.95


def test_odd_rows_and_clashing_columns(spark, network):
    german = " ".join(r.text for r in spark.read.parquet(f"{FOLDER}/documents.parquet").filter("lang = 'de'").select("text").collect())
    assert len(german) > 100_000
    rows = [(1, None, "q"), (None, "", "q"), (3, "123 !!", "q"), (4, "é", "q"), (4, "é", "q"), (5, german, "q"), (6, "漢字", "q")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang_pred string")
    got = language.identify(docs, network)
    assert got.columns == ["doc_id", "text", "lang_pred", "score"]
    out = {(r.doc_id, r.text and r.text[:12]): r for r in got.collect()}
    for key in [(1, None), (None, ""), (3, "123 !!")]:
        assert (out[key].lang_pred, out[key].score) == ("und", 0.0)
    assert out[4, "é"].lang_pred in network.languages and out[6, "漢字"].lang_pred in network.languages
    assert out[5, german[:12]].lang_pred == "de"
    assert all(0 <= r.score <= 1 for r in out.values())
    assert language.identify(docs.limit(0), network).count() == 0
    none = language.fit(spark.createDataFrame([(1, "a", None)], "doc_id long, text string, lang string"))
    assert {r.lang_pred for r in language.identify(docs, none).collect()} == {"und"}


def test_windows_cover_whole_texts():
    raw = np.frombuffer(b"Abc" + b"x" * 300, np.uint8)
    rows, doc, length = language.windows(raw, np.array([0, 3, 3, 303]))
    assert doc.tolist() == [0, 2, 2] and length.tolist() == [3, 256, 44]
    assert rows[0].tobytes() == b"abc" + b" " * 253 and rows[2].tobytes() == b"x" * 44 + b" " * 212


def test_gradients():
    net = language.Network(["a", "b"])
    net.tables = [t.astype(np.float64) for t in net.tables]
    net.out, net.bias, net.out_bias = net.out.astype(float), net.bias.astype(float) + 0.3, net.out_bias.astype(float)
    rng = np.random.default_rng(0)
    rows, target = rng.integers(97, 103, (5, 20)).astype(np.uint8), np.array([0, 1, 1, 0, 1])
    loss = lambda: -np.log(language.softmax(net.logits(rows))[np.arange(5), target]).mean()
    grads = net._gradients(rows, target)
    for weight, grad in zip([*net.tables, net.bias, net.out, net.out_bias], grads, strict=True):
        for place in [np.unravel_index(np.abs(grad).argmax(), grad.shape)]:
            old = weight[place]
            weight[place] = old + 1e-5
            up = loss()
            weight[place] = old - 1e-5
            down = loss()
            weight[place] = old
            assert (up - down) / 2e-5 == pytest.approx(grad[place], rel=1e-3, abs=1e-7)


def test_query(spark):
    got = language.op6_language(spark, "/root/testdata/sf0.001").collect()
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").count()
    assert len(got) == docs and all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 4 == 2) for r in got)


def test_copies_do_not_crowd_out_a_language(spark, monkeypatch):
    monkeypatch.setattr(language, "DOCS_A_LANGUAGE", 20)
    same = spark.range(4000).selectExpr("id AS doc_id", "repeat('one text ', 90) AS text", "'en' AS lang")
    again = spark.range(300).selectExpr("9000L AS doc_id", "repeat('row again ', 90) AS text", "'en' AS lang")
    other = spark.range(200).selectExpr("10000 + id AS doc_id", "repeat('text ' || id || ' ', 90) AS text", "'en' AS lang")
    rare = spark.createDataFrame([(99999, "una sola frase " * 40, "es")], "doc_id long, text string, lang string")
    rows, langs = language.sample_windows(same.unionByName(again).unionByName(other).unionByName(rare))
    assert langs.count("es") == language.WINDOWS_A_DOC and langs.count("en") == 20 * language.WINDOWS_A_DOC == len(rows) - langs.count("es")

"""The index against windows held in Python sets."""

import hashlib
import re

import pytest

from weftline.llm import decontaminate as dc

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def words(text):
    return WORD.findall(re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))


def brute(docs, items):
    windows = {}
    for item, text in items:
        w = words(text)
        for i in range(max(1, len(w) - 12) if w else 0):
            windows.setdefault(tuple(w[i:i + 13]), set()).add("" if item is None else str(item))
    lengths = {len(w) for w in windows}
    out = []
    for doc, text in docs:
        w, hit, own = words(text), set(), set()
        for n in lengths:
            for i in range(len(w) - n + 1):
                if (key := tuple(w[i:i + n])) in windows:
                    hit.update(range(i, i + n))
                    own |= windows[key]
        digest = hashlib.sha256(",".join(sorted(own)).encode()).hexdigest()
        out.append((str(doc), len(w), len(hit), len(own), digest, bool(hit) and 20 * len(hit) >= len(w)))
    return sorted(out)


def run(spark, docs, items, kind="long"):
    d = spark.createDataFrame(docs, "doc_id long, text string")
    b = spark.createDataFrame(items, f"item_id {kind}, text string")
    got = dc.judge(dc.build_index(d), dc.write_items(b)).drop("text_key")
    return sorted((str(r[0]), *r[1:]) for r in got.collect())


@pytest.fixture(scope="module")
def odd():
    run13 = " ".join(f"w{i}" for i in range(20))
    docs = [
        (1, run13), (2, run13.upper() + "!"), (3, None), (4, ""), (5, "a a a a a a a a"), (6, "a, A"), (None, "é É x"), (1, run13), (7, " ".join(["pad"] * 400) + " " + run13),
        (8, " ".join(f"w{i}" for i in range(12)) + " x " + run13[:30]), (9, "w0 w1"), (10, "w19 short one"), (11, "one"), (12, "...")]
    items = [(1, run13), (10, "short one"), (2, "short   ONE."), (3, "a a a"), (None, "é"), (4, None), (5, ""), (9, "one"), (9, "w0 w1")]
    return docs, items


def test_odd_rows(spark, odd):
    assert run(spark, *odd) == brute(*odd)


def test_small_blocks(spark, odd, monkeypatch):
    docs, items = odd
    import pyarrow as pa
    import numpy as np

    monkeypatch.setattr(dc, "CANDIDATES", 2)
    hashes, counts = dc.word_hashes(pa.array([t for _, t in docs]))
    place = np.arange(hashes.size) + np.repeat(np.arange(counts.size), counts)
    terms, which = np.unique(hashes, return_inverse=True)
    order = np.lexsort((place, which))
    starts = np.searchsorted(which[order], np.arange(terms.size + 1))
    segment = dc.Segment(counts, terms.tobytes(), starts.astype(np.int64).tobytes(), place[order].astype(np.int32).tobytes())
    wanted, _ = dc.word_hashes(pa.array(["a a a"]))
    assert sum(rows.size for rows, _ in segment.phrases(wanted[None, :])) == 6


def test_empty_tables(spark, odd):
    docs, items = odd
    assert run(spark, [], items) == []
    assert run(spark, docs, []) == brute(docs, [])


def test_phrases_and_proximity(spark):
    docs = spark.createDataFrame([(1, "x b a c"), (2, "a y y b"), (3, "b"), (4, "a b a")], "doc_id long, text string")
    index = dc.build_index(docs)
    items = dc.write_items(spark.createDataFrame([("i", "A b")], "item_id string, text string"))
    assert [tuple(r) for r in dc.phrase_matches(index, items).collect()] == [(4, "i", 0, 2)]
    assert sorted(map(tuple, dc.proximity(index, "a b", 2).collect())) == [(1, 1, 2), (4, 0, 1), (4, 1, 2)]
    assert dc.proximity(index, "a zz", 9).count() == 0


def test_clean_keeps_all_columns(spark):
    docs = spark.createDataFrame([(1, "a b", "k"), (1, "c", "k"), (None, None, "k")], "doc_id long, text string, text_key string")
    items = spark.createDataFrame([(1, "a b")], "item_id long, text string")
    assert sorted(map(str, dc.clean(docs, items).collect())) == sorted(map(str, docs.filter("text is null or text = 'c'").collect()))


def test_query(spark):
    folder = "/root/testdata/sf0.001"
    docs = [tuple(r) for r in spark.read.parquet(f"{folder}/documents.parquet").select("doc_id", "text").collect()]
    items = [tuple(r) for r in spark.read.parquet(f"{folder}/benchmark.parquet").select("item_id", "text").collect()]
    want = brute(docs, items)
    assert any(r[5] for r in want)
    assert sorted((str(r[0]), *r[1:]) for r in dc.op10_decontaminate(spark, folder).collect()) == want


def test_item_ids_are_kept_as_they_are(spark):
    docs, items = [(1, "a b c")], [("x\ny", "a b"), ("x y", "b c"), ("", "c")]
    assert run(spark, docs, items, "string") == brute(docs, items)

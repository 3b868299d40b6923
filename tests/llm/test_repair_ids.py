"""Exact round trips of the grammar and of the files."""

import zlib

import numpy as np
import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from weftline.llm import repair_ids as rp
from weftline.llm import shared


@settings(max_examples=200, deadline=None)
@given(st.lists(st.lists(st.integers(0, 3), max_size=120), min_size=1, max_size=8))
def test_grammar_round_trip(docs):
    docs = [d * 3 + [0] for d in docs]
    ids, counts = np.array([i for d in docs for i in d], np.int32), np.array([len(d) for d in docs])
    shard = rp.Shard(np.frombuffer(rp.pack_shard(np.arange(len(docs)), np.zeros(len(docs), bool), ids, counts, 4), np.uint8))
    assert shard.all_ids().tolist() == ids.tolist()
    for k, doc in enumerate(docs):
        assert shard.document(k).tolist() == doc
        assert [shard.id_at(k, p) for p in range(len(doc))] == doc
    assert [len(rp.expand(np.array([4 + r], np.int32), shard.rules, 4)) for r in range(len(shard.rules))] == shard.lengths.tolist()


def test_pairs_that_share_a_counter_are_counted_apart():
    rng = np.random.default_rng(4)
    keys = rng.integers(0, 40, 500).astype(np.int64) << 32 | 7
    cell = (keys >> 32) % 5 * 3
    fullest = np.bincount(cell, minlength=16) > 0
    for got, expected in zip(rp.count_pairs(keys, cell, fullest), np.unique(keys, return_inverse=True, return_counts=True), strict=True):
        assert np.array_equal(got, expected)


def test_grammar_shrinks_repeats():
    ids = np.tile(np.arange(50, dtype=np.int32), 4000)
    symbols, _, rules = rp.compress(ids, np.array([0]), 50)
    assert symbols.size < ids.size / 20 and len(rules) > 40


@pytest.mark.parametrize("shard_ids", [30, 2_000_000])
def test_files_of_odd_rows(spark, monkeypatch, shard_ids):
    texts = [None, "", "a b", "the the the the the the the the the the", "x " * 4000, "<|endoftext|>!", "a b"]
    rows = [(i if i else None, t, "extra") for i, t in enumerate(texts)] + [(3, "again", "extra"), (3, "again", "extra")]
    library = Tokenizer.from_file(rp.vocabulary_path())
    monkeypatch.setattr(rp, "SHARD_IDS", shard_ids)
    got = rp.read_ids(*rp.write_ids(spark.createDataFrame(rows, "doc_id long, text string, start string"))).collect()
    want = []
    for i, t, _ in rows:
        ids = [*library.encode(t or "", add_special_tokens=False).ids, 0]
        want.append((str(i), len(ids), zlib.crc32(np.array(ids, "<u4").tobytes())))
    assert sorted((str(r.doc_id), r.n_tokens, r.ids_crc32) for r in got) == sorted(want)
    at = 0
    for r in sorted(got, key=lambda r: r.start):
        assert r.start == at
        at += r.n_tokens
    order = [-1 if r.doc_id is None else r.doc_id for r in sorted(got, key=lambda r: r.start)]
    assert order == sorted(order)


def test_empty_and_single_document(spark):
    none = spark.createDataFrame([], "doc_id long, text string")
    assert rp.read_ids(*rp.write_ids(none)).count() == 0
    folder, manifest = rp.write_ids(spark.createDataFrame([(5, "a b c")], "doc_id long, text string"))
    shard, = rp.shards_of(shared.mapped(folder, manifest.first().file))
    library = Tokenizer.from_file(rp.vocabulary_path())
    assert shard.document(0).tolist() == [*library.encode("a b c").ids, 0]


def test_query(spark):
    folder = "/root/testdata/sf0.001"
    library, at, want = Tokenizer.from_file(rp.vocabulary_path()), 0, []
    for d, t in sorted(spark.read.parquet(f"{folder}/documents.parquet").select("doc_id", "text").collect()):
        ids = np.array([*library.encode(t, add_special_tokens=False).ids, 0], "<u4")
        want.append((d, at, ids.size, zlib.crc32(ids.tobytes())))
        at += ids.size
    assert sorted(map(tuple, rp.op4_repair_ids(spark, folder).collect())) == want


def test_texts_without_rows():
    ids, counts = rp.encode_texts(pa.array([None, ""], pa.string()), rp.vocabulary_path())
    assert ids.tolist() == [0, 0] and counts.tolist() == [1, 1]

"""Hashes of spans: no regular pairs collide, and pieces are told apart by their bytes."""

import hashlib

import numpy as np
import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from weftline.llm import bpe, decontaminate, jaccard_join, pieces
from weftline.llm.words import SPACES, equal_spans, find_words, hash_spans, text_buffer


def thue_morse(length):
    word = "".join("ab"[bin(i).count("1") & 1] for i in range(length))
    return word, word.translate(str.maketrans("ab", "ba"))


def hashes(texts):
    raw, offsets = text_buffer(pa.array(texts))
    return hash_spans(raw, offsets[:-1], offsets[1:])


@pytest.mark.parametrize("length", [8, 64, 512, 1024, 2048, 4096])
def test_regular_words_have_hashes_of_their_own(length):
    a, b = thue_morse(length)
    one, two, again = hashes([a, b, a])
    assert one != two and one == again


@settings(max_examples=200, deadline=None)
@given(st.lists(st.binary(max_size=40).map(lambda b: b.decode("latin-1")), min_size=1, max_size=8))
def test_equal_hashes_for_equal_bytes_alone(texts):
    found = hashes(texts)
    for t, h in zip(texts, found, strict=True):
        for u, g in zip(texts, found, strict=True):
            assert (t == u) == (h == g)


def test_place_in_the_buffer_does_not_matter():
    raw, offsets = text_buffer(pa.array(["abc defghijkl abc", "defghijkl", "x" * 600 + " " + "x" * 600]))
    start, end, _ = find_words(raw, offsets, SPACES)
    h = hash_spans(raw, start, end)
    assert h[0] == h[2] and h[1] == h[3] and h[4] == h[5] and len(set(h.tolist())) == 3
    assert equal_spans(raw, start[[0, 1, 4, 0]], end[[0, 1, 4, 0]], raw, start[[2, 3, 5, 1]], end[[2, 3, 5, 1]]).tolist() == [True, True, True, False]


def test_a_piece_is_not_taken_for_another_of_the_same_hash(monkeypatch):
    monkeypatch.setattr(pieces, "hash_spans", lambda raw, start, end: np.zeros(start.size, np.uint64))
    store = pieces.PieceStore(lambda found: list(found))
    for _ in range(2):
        texts = [b"ab", b"cd", b"ab", b"x" * 700, b"x" * 699 + b"y", b"abc"]
        ends = np.cumsum([len(t) for t in texts])
        raw = np.frombuffer(b"".join(texts), np.uint8)
        places = store.look_up(raw, np.append(0, ends[:-1]), ends)
        assert [store.values[i] for i in places.tolist()] == texts
    assert len(store.values) == 5


@pytest.mark.parametrize("length", [1024, 4096])
def test_regular_words_through_the_operators(spark, length):
    a, b = thue_morse(length)
    docs = spark.createDataFrame([(1, a), (2, b), (3, a)], "doc_id long, text string").coalesce(1)
    library = Tokenizer.from_file(bpe.vocabulary_path())
    for r in bpe.round_trip(docs).join(docs.withColumnRenamed("text", "said"), "doc_id").collect():
        ids = library.encode(r.said, add_special_tokens=False).ids
        assert r.ids_sha256 == hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest()
        assert r.decoded_sha256 == hashlib.sha256(r.said.encode()).hexdigest()
    assert {r.id: r.component for r in jaccard_join.groups(docs).collect()} == {1: 1, 2: 2, 3: 1}
    items = spark.createDataFrame([("i", b)], "item_id string, text string")
    assert {r.doc_id: r.n_hit for r in decontaminate.judge(decontaminate.build_index(docs), decontaminate.write_items(items)).collect()} == {1: 0, 2: 1, 3: 0}

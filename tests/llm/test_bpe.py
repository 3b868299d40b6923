"""The numpy coder against the tokenizers library."""

import hashlib

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from weftline.llm import bpe

HARD = [
    None, "", "a", "  a  b \n\n c\nd\n", "it's we'll they'VE 'd", "a b 　c  ", "<|endoftext|> x <|endoftext|><|endoftext|>  y",
    "aaaaaaaaaaaaaaaaaaaaaaaa", " é 日本語テキスト 🙂👍🏽", "\x1c a\x1fb \x85z", "x" * 3000 + " " + "ab" * 999, "\n a\nb \nc", "1234567 89 ½ Ⅷ", "a b", "<|endoftext|"]


@pytest.fixture(scope="module")
def library():
    return Tokenizer.from_file(bpe.vocabulary_path())


def sha(raw):
    return hashlib.sha256(raw).hexdigest()


def expected(library, text):
    ids = library.encode(text or "", add_special_tokens=False).ids
    decoded = library.decode(ids, skip_special_tokens=False)
    return len(ids), sha(",".join(map(str, ids)).encode()), sha(decoded.encode())


@settings(max_examples=300, deadline=None)
@given(st.lists(st.text(alphabet=st.sampled_from(list("ab'st \n\t<|endoftext>0é  世🙂\x1c\x85")), max_size=30), min_size=1, max_size=4))
def test_any_text(texts):
    import pyarrow as pa

    library = Tokenizer.from_file(bpe.vocabulary_path())
    found, ends = bpe._pieces_of(pa.array(texts), bpe.vocabulary_path())
    for text, a, b in zip(texts, ends, ends[1:], strict=False):
        assert [i for p in found[a:b] for i in p[0]] == library.encode(text, add_special_tokens=False).ids


def test_hard_texts_repeats_and_clashing_columns(spark, library):
    rows = [(i if i % 3 else None, t, "kept", -1) for i, t in enumerate(HARD + HARD[:4])]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, n_tokens long")
    got = bpe.round_trip(docs)
    assert got.columns == ["doc_id", "text", "lang", "n_tokens", "ids_sha256", "decoded_sha256"]
    want = sorted((str(i), str(t), c, *expected(library, t)) for i, t, c, _ in rows)
    assert sorted((str(r[0]), str(r[1]), *r[2:]) for r in got.collect()) == want
    back = bpe.decode(bpe.encode(docs)).select("text", "decoded").collect()
    assert all(r.decoded == (r.text or "") for r in back)


def test_empty_and_unknown_ids(spark):
    assert bpe.round_trip(spark.createDataFrame([], "doc_id long, text string")).count() == 0
    odd = spark.createDataFrame([([999999, 64],), (None,), ([],)], "ids array<int>")
    assert sorted(r.decoded for r in bpe.decode(odd).collect()) == ["", "", "a"]


def test_query(spark, library):
    folder = "/root/testdata/sf0.001"
    docs = spark.read.parquet(f"{folder}/documents.parquet").select("doc_id", "text").collect()
    assert sorted(map(tuple, bpe.op5_bpe(spark, folder).collect())) == sorted((d, *expected(library, t)) for d, t in docs)

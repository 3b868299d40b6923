"""The model against one held in dictionaries."""

import math
import re
import zlib
from collections import Counter, defaultdict

import pytest

from weftline.llm import kneser_ney as kn

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def tokens(text):
    return [*WORD.findall(re.sub("[A-Z]", lambda m: m[0].lower(), text or "")), "</s>"]


class Brute:
    def __init__(self, texts, order):
        self.order, self.grams = order, [Counter() for _ in range(order + 1)]
        self.raw = Counter()
        for text in texts:
            seq = ["<s>", *tokens(text)]
            self.raw.update(seq[1:])
            for j in range(1, len(seq)):
                level = min(order, j + 1)
                self.grams[level][tuple(seq[j - level + 1:j + 1])] += 1
        for level in range(order - 1, 0, -1):
            for gram in self.grams[level + 1]:
                self.grams[level][gram[1:]] += 1
        self.discounts = [None] + [kn.discounts_of([sum(c == k for c in g.values()) for k in (1, 2, 3, 4)]) for g in self.grams[1:]]
        self.after = [defaultdict(lambda: [0, 0.0]) for _ in range(order + 1)]
        for level in range(1, order + 1):
            for gram, c in self.grams[level].items():
                self.after[level][gram[:-1]][0] += c
                self.after[level][gram[:-1]][1] += (0, *self.discounts[level])[min(c, 3)]

    def p(self, gram):
        level = len(gram)
        if not level:
            return 1 / (len(self.raw) + 1)
        lower = self.p(gram[1:])
        if gram[:-1] not in self.after[level]:
            return lower
        d = (0, *self.discounts[level])
        c, (total, left) = self.grams[level].get(gram, 0), self.after[level][gram[:-1]]
        return (c - d[min(c, 3)]) / total + left / total * lower

    def score(self, text):
        seq = ["<s>", *tokens(text)]
        n, v = sum(self.raw.values()), len(self.raw)
        own = sum(math.log10(self.p(tuple(seq[max(0, j - self.order + 1):j + 1]))) for j in range(1, len(seq)))
        base = sum(math.log10((self.raw[t] + 0.5) / (n + 0.5 * (v + 1))) for t in seq[1:])
        return len(seq) - 1, sum(t in self.raw for t in seq[1:]), n, base, own


def same(got, want):
    assert tuple(got[:3]) == want[:3]
    assert got[3:5] == pytest.approx(want[3:], rel=1e-9, abs=1e-9)


@pytest.mark.parametrize("order, range_bytes", [(2, 12 << 20), (2, 60_000), (3, 90_000), (4, 12 << 20)])
def test_all_texts(spark, monkeypatch, order, range_bytes):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").select("doc_id", "text").collect()
    rows = [(d, t[:3000]) for d, t in docs] + [(None, None), (-1, ""), (-2, "the"), (-2, "the"), (-3, "a " * 700 + "\x0b B c")]
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(5)
    learn = [t for d, t in rows if zlib.crc32(str(d).encode()) % 5 != 1]
    trained = spark.createDataFrame([(t,) for t in learn], "text string").repartition(7)
    model, brute = kn.train(trained, order=order, range_bytes=range_bytes), Brute(learn, order)
    out = kn.score(df.selectExpr("*", "'x' AS score"), model)
    assert out.columns == ["doc_id", "text", *kn.ADDED.fieldNames()]
    got = out.collect()
    assert len(got) == len(rows)
    for r in got:
        same(list(r)[2:7], brute.score(r.text))


def test_probabilities_add_up(spark):
    texts = ["a b a c", "b b a", "c", ""]
    model = kn.train(spark.createDataFrame([(t,) for t in texts], "text string"), order=3)
    brute = Brute(texts, 3)
    for context in (("<s>",), ("a",), ("<s>", "b"), ("b", "a"), ("zz",)):
        assert sum(brute.p((*context, w)) for w in brute.raw) + brute.p((*context, "??")) == pytest.approx(1)
    assert model.tokens == 12 and model.different == 4


def test_empty_tables(spark):
    none = spark.createDataFrame([], "doc_id long, text string")
    model = kn.train(none)
    assert kn.score(none, model).count() == 0
    r = kn.score(spark.createDataFrame([("a b",)], "text string"), model).first()
    assert (r.n_tokens, r.n_known, r.train_tokens, r.score, r.base_score) == (3, 0, 0, 0.0, 0.0)


def test_query_beats_the_base_on_held_out_text(spark):
    got = kn.op1_kneser_ney(spark, "/root/testdata/sf0.001").collect()
    docs = {r.doc_id: r.text for r in spark.read.parquet("/root/testdata/sf0.001/documents.parquet").collect()}
    brute = Brute([t for d, t in docs.items() if zlib.crc32(str(d).encode()) % 5 != 1], kn.ORDER)
    assert len(got) == len(docs)
    for r in got:
        assert r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 5 == 1)
        same([r.n_tokens, r.n_known, r.train_tokens, r.base_score, r.score], brute.score(docs[r.doc_id]))
    held = [r for r in got if r.held_out]
    assert sum(r.score for r in held) > sum(r.base_score for r in held)

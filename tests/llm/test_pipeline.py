"""The pipeline against its stages done by hand, and its stages on odd rows."""

import hashlib
import random
import re

import pytest
from tokenizers import Tokenizer

import corpus_pipeline as cp
from tests.llm.test_decontaminate import brute as brute_hits
from tests.llm.test_jaccard_join import WORD
from weftline.llm import bpe, language, quality

FOLDER = "/root/testdata/sf0.001"


def test_rows_by_hand(spark):
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet")
    model = quality.fit_labels(docs, spark.read.parquet(f"{FOLDER}/labels.parquet"))
    good = {r.doc_id for r in quality.score(docs, model).collect() if r.predicted}
    kept = docs.filter(docs.doc_id.isin(list(good)))
    network = language.fit_labels(kept)
    known = [(r.doc_id, r.text) for r in language.identify(kept, network).collect() if r.lang_pred != "und" and r.score >= language.LEAST_SCORE]
    single = set(near_groups(known).values())
    left = [(d, t) for d, t in known if d in single]
    items = [tuple(r) for r in spark.read.parquet(f"{FOLDER}/benchmark.parquet").select("item_id", "text").collect()]
    bad = {r[0] for r in brute_hits(left, items) if r[5]}
    library, want = Tokenizer.from_file(bpe.vocabulary_path()), []
    for d, t in left:
        if str(d) not in bad:
            ids = library.encode(t, add_special_tokens=False).ids
            want.append((d, len(ids), hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest(), hashlib.sha256(t.encode()).hexdigest()))
    got = sorted(map(tuple, cp.run(spark, FOLDER).collect()))
    assert 0 < len(got) < docs.count()
    assert got == sorted(want)


@pytest.mark.parametrize("name, stage", cp.STAGES)
def test_odd_and_empty_rows(spark, name, stage):
    schema = "doc_id long, text string, lang string, source string, n_chars long, score double"
    rows = [(None, None, None, None, None, 1.0), (1, "", "en", "s", 0, 1.0), (2, "a b", None, "s", 3, 1.0), (2, "a b", None, "s", 3, 1.0), (3, "word " * 50_000, "en", "s", 9, 1.0)]
    for df in (spark.createDataFrame(rows, schema), spark.createDataFrame([], schema)):
        out = stage(spark, df, FOLDER)
        assert out.count() <= df.count()
        assert out.columns == (df.columns if name != "bpe" else ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"])


def near_groups(rows, words=5, percent=80):
    """The smallest id of each row's group, by comparing all pairs."""
    split = [WORD.findall(re.sub("[A-Z]", lambda m: m[0].lower(), t or "")) for _, t in rows]
    sets = [{tuple(w[i:i + words]) for i in range(max(len(w) - words, 0) + 1)} - {()} for w in split]
    group = {d: d for d, _ in rows}
    for i, (d, _) in enumerate(rows):
        for j, (other, _) in enumerate(rows[:i]):
            if sets[i] and 100 * len(sets[i] & sets[j]) >= percent * len(sets[i] | sets[j]):
                a, b = sorted((group[d], group[other]))
                group = {k: a if v == b else v for k, v in group.items()}
    return group


def replaced(words, *places):
    return " ".join(f"new{i}" if i in places else w for i, w in enumerate(words))


def test_near_copies_by_five_words(spark):
    rng = random.Random(3)
    words = [f"w{i}" for i in range(94)]
    # 80 of 100 shingles of five words, 86 of 98 of three words; one more replacement is too many.
    rows = [(1, " ".join(words)), (2, replaced(words, 30, 60)), (3, " ".join(f"x{w}" for w in words)), (4, replaced([f"x{w}" for w in words], 20, 40, 60))]
    for size, members, edits in [(300, 40, 8), (80, 30, 3), (45, 30, 2), (12, 20, 1), (9, 20, 1), (700, 10, 20)]:
        base = [f"v{rng.randrange(400)}" for _ in range(size)]
        rows += [(len(rows) + k, replaced(base, *rng.sample(range(size), rng.randrange(edits + 1)))) for k in range(1, members + 1)]
    want = near_groups(rows)
    assert [want[k] for k in (1, 2, 3, 4)] == [1, 1, 3, 4]
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    got = sorted(r.doc_id for r in cp.keep_one_of_each_group(spark, df, FOLDER).collect())
    assert got == sorted(set(want.values())) and len(got) < len(rows)

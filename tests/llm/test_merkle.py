"""The tree against one built from Python lists."""

import zlib
from hashlib import sha256

import pytest

from weftline.llm import merkle, ranking

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, at string, leaf int, `group` string"


def digest(parts):
    return sha256("".join(parts).encode()).hexdigest()


def leaf(row, lower=False):
    doc_id, text, lang, source, n_chars = row
    if lower and text is not None:
        text = "".join(c.lower() if "A" <= c <= "Z" else c for c in text)
    return digest("-" if v is None else f"{len(str(v).encode())}:{v}" for v in (doc_id, source, lang, n_chars, text))


def levels(hashes):
    """Runs of each level up to the one node."""
    out = []
    while len(hashes) > 1:
        runs = [hashes[i:i + 8] for i in range(0, len(hashes), 8)]
        out.append(runs)
        hashes = [digest(r) for r in runs]
    return out, hashes[0]


def steps(runs, at):
    for level in runs:
        run = level[at // 8]
        yield "".join(run[:at % 8]), "".join(run[at % 8 + 1:])
        at //= 8


def brute(rows):
    by_lang = {}
    for r in rows:
        tampered = zlib.crc32(str(r[0]).encode()) % 3 == 0 if r[0] is not None else False
        by_lang.setdefault(r[2], []).append((r[0] is not None, r[0] or 0, leaf(r), leaf(r, tampered)))
    langs = sorted(by_lang, key=lambda k: (k is not None, (k or "").encode()))
    trees = {k: levels([n[2] for n in sorted(by_lang[k])]) for k in langs}
    top, root = levels([trees[k][1] for k in langs]) if langs else ([], None)
    out = []
    for i, k in enumerate(langs):
        for at, (known, doc_id, own, claimed) in enumerate(sorted(by_lang[k])):
            path = [*steps(trees[k][0], at), *steps(top, i)]
            h = claimed
            for left, right in path:
                h = digest([left, h, right])
            out.append((doc_id if known else None, own, trees[k][1], root, digest(a + b for a, b in path), h, h == root))
    return sorted(out, key=str)


def run(spark, tmp_path, rows):
    spark.createDataFrame([(*r, "x", 7, "y") for r in rows], SCHEMA).write.parquet(f"{tmp_path}/documents.parquet")
    got = merkle.op12_merkle(spark, str(tmp_path))
    assert got.columns == ["doc_id", "leaf", "subroot", "root", "proof_sha256", "folded_root", "verified"]
    return sorted(map(tuple, got.collect()), key=str)


CASES = {
    "empty": [],
    "one row": [(1, "A", "en", "s", 1)],
    "all null": [(None, None, None, None, None)],
    "odd rows": [
        (None, None, None, None, None), (None, "x", "en", None, 3), (1, "Ä A", "en", "s", 0), (1, "Ä A", "en", "s", 0), (1, "other", "en", "s", 0), (-5, "", "", "", -1), (2, "B" * 300_000, "é", "-", 2),
        (3, "C", "z", "2:ab", 2), (3, "C", "z", "2:ab", 2)],
    "many groups": [(i, f"T {i}", f"l{i % 70}", None, i) for i in range(300)],
    "runs of eight": [(i, "Q", f"n{n}", "s", i) for n in (1, 2, 7, 8, 9, 64, 65) for i in range(n)],
    "two rounds": [(i, f"Text {i}", "en", "s", i) for i in range(1200)] + [(i, f"Text {i}", None, "s", i) for i in range(513)],
    "copies": [(7, "Same", "en", "s", 1)] * 1500 + [(i, "t", "en", "s", 1) for i in range(40)],
}


@pytest.mark.parametrize("name", CASES)
def test_against_lists(spark, tmp_path, name):
    rows = CASES[name]
    got = run(spark, tmp_path, rows)
    assert got == brute(rows)
    # Tampered texts with upper-case letters fail alone; repeated rows of one id are alike.
    changed = {r[0] for r in rows if r[0] is not None and zlib.crc32(str(r[0]).encode()) % 3 == 0 and any("A" <= c <= "Z" for c in r[1] or "")}
    assert {r[0] for r in got if not r[-1]} == changed


def test_ranks_over_many_ranges(spark):
    rows = [("a", i, 1) for i in range(500)] + [("b", 3, 4), ("b", 9, 1), (None, 5, 2), (None, None, 1)]
    frame = spark.createDataFrame(rows, "g string, o long, copies long")
    got = {(r.g, r.o): (r.rank, r.rows) for r in ranking.ranked(frame, ["g"], ["o"], rows_a_range=20).collect()}
    assert got == {("a", i): (i, 500) for i in range(500)} | {("b", 3): (0, 5), ("b", 9): (4, 5), (None, None): (0, 3), (None, 5): (1, 3)}


def test_own_fields_and_paths(spark):
    rows = spark.createDataFrame([("k", 2, "x"), ("k", 1, "y"), ("j", 1, "z")], "path string, leaf long, kids string")
    got = {(r.group, r.id): r for r in merkle.manifest(rows, ["leaf", "kids"], "leaf", "path").collect()}
    a, b = got["k", 1], got["k", 2]
    assert a.leaf == digest(["1:1", "1:y"]) and a.subroot == digest([a.leaf, b.leaf]) and got["j", 1].subroot == got["j", 1].leaf
    assert [tuple(s) for s in a.path] == [("", b.leaf), (got["j", 1].leaf, "")] and a.root == digest([got["j", 1].leaf, a.subroot])
    assert a.claimed is None

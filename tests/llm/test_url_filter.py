"""The automaton against a scan term by term, and rules against hand-made urls."""

import duckdb
import pytest

from weftline.llm import url_filter as uf

CASES = [
    (1, "https://Sub.Example.ORG/es/1", "sub.example.org", "/es/1", "example.org/es/", "block"),
    (2, "http://example.org/en/1?x=y#z", "example.org", "/en/1", "example.org/en/1", "block"),
    (3, "http://a.org", "a.org", "", None, "allow"),
    (4, "http://a.org/porn/", "a.org", "/porn/", "org/", "allow"),
    (5, "x://b.com/fr/?free", "b.com", "/fr/", "com/fr/", "allow"),
    (6, "x://b.com/de/#", "b.com", "/de/", "com/de/", "block"),
    (7, "x://b.net/Porn", "b.net", "/Porn", None, "block"),
    (8, "x://b.net/pornography", "b.net", "/pornography", None, "allow"),
    (9, "x://b.net/free-free", "b.net", "/free-free", None, "allow"),
    (10, "x://b.net/free?win", "b.net", "/free", None, "block"),
    (11, None, "", "", None, "allow"),
    (12, "no-scheme.org/es/", "", "", None, "allow"),
    (13, "", "", "", None, "allow"),
    (14, "a://b://c.org/", "b:", "//c.org/", None, "allow"),
    (15, "x://example.orga/es/", "example.orga", "/es/", None, "allow"),
    (15, "x://XXX", "xxx", "", None, "block"),
]


def test_cases_with_clashing_columns_and_oracle(spark):
    pages = spark.createDataFrame([(i, u, "old") for i, u, *_ in CASES], "page_id long, url string, verdict string")
    got = uf.judge(pages).select("page_id", "host", "path", "rule", "verdict").collect()
    want = [(i, h, p, r, v) for i, _, h, p, r, v in CASES]
    key = lambda row: tuple(map(str, row))
    assert sorted(map(tuple, got), key=key) == sorted(want, key=key)
    con = duckdb.connect()
    con.execute("CREATE TABLE pages (page_id BIGINT, url VARCHAR)")
    con.executemany("INSERT INTO pages VALUES (?, ?)", [[i, u] for i, u, *_ in CASES])
    sql = con.execute(f"SELECT page_id, host, path, rule, verdict FROM ({uf._sql()})").fetchall()
    assert sorted(sql, key=key) == sorted(want, key=key)


def test_empty(spark):
    assert uf.judge(spark.createDataFrame([], "page_id long, url string")).count() == 0


@pytest.mark.parametrize("url", ["a xxx b", "xxxx", "1xxx", "éxxxé", "sex.sex.SEX", "bet&bonus", "torrents/torrent"])
def test_boundaries(url):
    import re

    machine = uf.automaton(uf.STRICT, uf.SOFT)
    low = url.lower()
    count = lambda terms: sum(bool(re.search(rf"(?<![a-z0-9]){t}(?![a-z0-9])", low)) for t in terms)
    assert uf.term_hits(url, machine) == (count(uf.STRICT), count(uf.SOFT))

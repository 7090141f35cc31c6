"""URL rules: cascades against sets, and judged urls against a plain rule search and SQL."""

from __future__ import annotations

import random
import re

import duckdb
import numpy as np
import pytest

from ledgerlight.llm import url_filter as U

URLS = [
    None, "", "no scheme.com/en/", "http://", "http://com/", "HTTP://WWW.Example.COM/en/a?x=/es/", "http://example.com/EN/",
    "http://example.com/en/1#f", "http://a.b.example.com/en/", "http://notexample.com/en/", "http://x.net", "http://x.net/es/",
    "http://x.net?/es/", "http://x.net/fr/#?", "http://net/fr/", "http://.net/fr/", "http://x.net./fr/", "http://x.net:80/fr/",
    "a://b://c.com/", "http://é.com/ß", "http://x.com/" + "y/" * 5000, "http://" + "a." * 300 + "com/", "http://ww.İ.com/",
]


def plain(url, rules):
    host = path = ""
    if url is not None and "://" in url:
        rest = url.split("://", 1)[1]
        raw = re.match("[^/?#]*", rest)[0]
        path = re.match("[^?#]*", rest[len(raw) :])[0]
        host = "".join(c.lower() if "A" <= c <= "Z" else c for c in raw)
    fits = [
        (len(h + p), len(h), v == "block", h + p) for h, p, v in rules
        if host and (host == h or host.endswith("." + h)) and path.startswith(p)
    ]
    best = max(fits, default=None)
    return host, path, best and best[3], "block" if best and best[2] else "allow"


def test_cascade_is_exact():
    rng = np.random.default_rng(5)
    for n, m in ((0, 10), (1, 0), (1, 100_000), (5_000, 100_000), (20_000, 10)):
        keys = rng.integers(0, 2**63, (n + m, 2)).astype(np.uint64)
        filters = U.cascade(keys[:n], keys[n:])
        assert U.is_listed(filters, keys).tolist() == [True] * n + [False] * m
        packed = [U.Filter.unpacked(f.depth, *f.packed()) for f in filters]
        assert U.is_listed(packed, keys).sum() == n
        if n == 5_000:
            assert len(filters) > 3 and sum(len(f.bits) for f in filters) < 16 * n


def test_keys_that_cannot_be_told_apart_are_refused():
    with pytest.raises(ArithmeticError):
        U.cascade(np.ones((1, 2), np.uint64), np.ones((1, 2), np.uint64))


def test_query_equals_plain_search_and_sql(spark):
    pages = spark.createDataFrame([(i, u, "x", "y") for i, u in enumerate(URLS * 2)], "page_id long, url string, host string, rule string")
    rows = U.report(pages).collect()
    assert sorted(map(tuple, rows)) == sorted((i, *plain(u, U.RULES)) for i, u in enumerate(URLS * 2))
    with duckdb.connect() as con:
        con.register("pages", pages.select("page_id", "url").toArrow())
        assert sorted(con.sql(U.oracle()).fetchall()) == sorted(map(tuple, rows))
    assert U.report(pages.where("false")).count() == 0
    assert {tuple(r) for r in U.report(pages, []).select("rule", "verdict").collect()} == {(None, "allow")}


def test_many_rules_in_many_parts(spark, monkeypatch):
    rng = random.Random(3)
    monkeypatch.setattr(U, "PER_SHARD", 40)
    monkeypatch.setattr(U, "PART", 200)
    name = lambda: rng.choice("abc") + rng.choice("abcdef")
    host = lambda: ".".join(name() for _ in range(rng.randint(1, 3)))
    path = lambda: "".join("/" + name() for _ in range(rng.randint(0, 2))) + rng.choice(["", "/"])
    rules = [(host(), path(), rng.choice(["allow", "block"])) for _ in range(300)]
    rules += [rules[0][:2] + ("block",), (None, "/", "block"), ("aa", None, "block")]
    urls = [f"http://{host().upper() if rng.random() < 0.2 else host()}{path()}{rng.choice(['', '?q', '#f'])}" for _ in range(1500)]
    pages = spark.createDataFrame([(i, u) for i, u in enumerate(urls)], "page_id long, url string")
    usable = [r for r in rules if None not in r]
    assert sorted(map(tuple, U.report(pages, rules).collect())) == sorted((i, *plain(u, usable)) for i, u in enumerate(urls))


def test_other_columns_stay(spark):
    rules = spark.createDataFrame([("com", "/", "block")], "host string, path string, verdict string")
    row = U.judge(spark.createDataFrame([("http://a.com/", 1, 2)], "`my url` string, `a.b` int, verdict int"), rules, "my url").first()
    assert row.asDict() == {"my url": "http://a.com/", "a.b": 1, "host": "a.com", "path": "/", "rule": "com/", "verdict": "block"}

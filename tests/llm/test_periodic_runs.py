"""Periodic runs against every period of every text."""

from __future__ import annotations

import hashlib
import random
import zlib

import numpy as np
import pytest

from ledgerlight.llm import periodic_runs as R


def plain(words):
    """All runs: for each period, the maximal stretches whose words are equal that far apart."""
    n, smallest = len(words), {}
    for q in range(1, n // 3 + 1):
        i = 0
        while i + q < n:
            j = i
            while j + q < n and words[j] == words[j + q]:
                j += 1
            if j + q - i >= max(24, 3 * q):
                smallest.setdefault((i, j + q), q)
            i = max(j, i + 1)
    return sorted((s, e - s, q) for (s, e), q in smallest.items())


def text(rng):
    letters = rng.choice([1, 2, 2, 3, 5, 50])
    word = lambda: str(rng.randrange(letters)).encode()
    words = [word() for _ in range(rng.randint(0, 300))]
    for _ in range(rng.randint(0, 4)):
        unit = [word() for _ in range(rng.randint(1, 40))]
        if len(unit) > 6 and rng.random() < 0.5:
            unit = unit[: len(unit) // 3] * 4
        at, made = rng.randint(0, len(words)), unit * rng.randint(2, 9)
        words[at:at] = made[: len(made) - rng.randrange(len(unit))]
    return words * 3 if rng.random() < 0.2 else words


def test_runs_equal_plain_search():
    rng, n = random.Random(11), 0
    for _ in range(8):
        texts = [text(rng) for _ in range(25)]
        for words, found in zip(texts, R.runs_of(texts)):
            assert found == plain(words)
            n += len(found)
    assert n > 300


def test_structured_texts(monkeypatch):
    fib = [b"a"], [b"a", b"b"]
    while len(fib[1]) < 1500:
        fib = fib[1], fib[1] + fib[0]
    morse = [b"ab"[bin(i).count("1") % 2 :][:1] for i in range(1024)]
    texts = [[b"a"] * 1000, ([b"a"] * 97 + [b"b"]) * 12, fib[1], morse, morse * 3, [], [b"x"], [b"a"] * 23, [b"a"] * 24]
    monkeypatch.setattr(R, "PAIRS", 100)
    assert R.runs_of(texts) == [plain(t) for t in texts]
    assert R.runs_of(texts)[-2:] == [[], [(0, 24, 1)]]


def test_wrong_hashes_are_mended(monkeypatch):
    weak = lambda self, start, length: ((self.sums[start + length] - self.sums[start]) * self.shift[start]) >> np.uint64(52)
    monkeypatch.setattr(R.Hashes, "of", weak)
    rng = random.Random(12)
    texts = [text(rng) for _ in range(40)]
    assert R.runs_of(texts) == [plain(t) for t in texts]


def test_grammar_derives_its_texts():
    rng = random.Random(13)
    texts = [text(rng) for _ in range(20)]
    flat = np.array([int(w) for t in texts for w in t])
    text_of = np.repeat(np.arange(20), [len(t) for t in texts])
    g = R.re_pair(flat, text_of)
    assert len(g.symbols) < len(flat) // 2 and len(set(zip(g.left[g.words :], g.right[g.words :], text_of[g.seen[g.words :]]))) == len(g.left) - g.words

    def derived(s):
        return [s] if s < g.words else derived(g.left[s]) + derived(g.right[s])

    assert [w for s in g.symbols for w in derived(s)] == flat.tolist()
    assert all(flat[g.seen[s] : g.seen[s] + g.size[s]].tolist() == derived(s) for s in range(g.words, len(g.left)))


@pytest.mark.parametrize("group", [1 << 18, 50])
def test_query_equals_plain_search(spark, group):
    rng = random.Random(14)
    joined = lambda ws: rng.choice([" ", "\n\t ", "\x0b"]).join(w.decode() for w in ws)
    rows = [(i, joined(text(rng)), 1) for i in range(60)] + [(61, None, 1), (61, "", 1), (None, "é " * 30, 1), (7, "a\u00a0b \x1c " * 30, 1)]
    docs = spark.createDataFrame(rows * 2, "doc_id long, text string, n_runs int")
    want = []
    for d, t, _ in rows * 2:
        words = (t or "").encode().split()
        h, n = 1 if d is None else zlib.crc32(str(d).encode()), len(words)
        if h % 10 == 0 and n:
            g = h // 10
            a = g % n
            p = 1 + (n - a) // (3 + g % 8)
            words = [words[i if i < a else a + (i - a) % p] for i in range(n)]
        runs = plain(words)
        best = max(runs, key=lambda r: (r[1] / r[2], -r[0], -r[2]), default=(None,) * 3)
        dropped = {i for s, m, q in runs for i in range(s + q, s + m)}
        digest = lambda x: hashlib.sha256(x).hexdigest()
        want.append((
            d, len(runs), *best, best[0] if best[0] is None else 1000 * best[1] // best[2],
            digest("".join(f"{s},{m},{q}\n" for s, m, q in runs).encode()),
            digest(b" ".join(w for i, w in enumerate(words) if i not in dropped)),
        ))
    was, R.GROUP = R.GROUP, group
    try:
        got = [tuple(r) for r in R.report(docs).collect()]
    finally:
        R.GROUP = was
    key = lambda r: (r[0] is None, r)
    assert sorted(map(str, got)) == sorted(map(str, want))
    assert R.report(docs.where("false")).count() == 0


def test_collapse_keeps_columns(spark):
    docs = spark.createDataFrame([(1, "a b " * 20 + "c", 5), (2, None, 6), (3, " x  y ", 7)], "doc_id long, text string, `odd name` int")
    rows = {r["doc_id"]: r.asDict(True) for r in R.collapse(docs).collect()}
    assert rows[1]["text"] == "a b c" and rows[1]["runs"] == [{"start": 0, "length": 40, "period": 2}] and rows[1]["odd name"] == 5
    assert rows[2]["text"] is None and rows[3]["text"] == " x  y " and rows[3]["runs"] == []

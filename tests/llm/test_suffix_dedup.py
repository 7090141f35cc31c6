"""Repeated passages against a count of all strings, and the merge against sorting."""

from __future__ import annotations

import hashlib
import random
from collections import Counter

import pytest

from ledgerlight.llm import registry
from ledgerlight.llm import suffix_dedup as S


def plain(rows):
    texts = [(i, (t or "").encode()) for i, t in rows]
    seen = Counter(t[k : k + S.LENGTH] for _, t in texts for k in range(len(t) - S.LENGTH + 1))
    out = []
    for i, t in texts:
        gone = bytearray(len(t))
        for k in range(len(t) - S.LENGTH + 1):
            if seen[t[k : k + S.LENGTH]] > 1:
                gone[k : k + S.LENGTH] = b"\1" * S.LENGTH
        kept = bytes(b for b, g in zip(t, gone) if not g)
        spans = sum(g and not (k and gone[k - 1]) for k, g in enumerate(gone))
        out.append((i, len(t), sum(gone), spans, hashlib.sha256(kept).hexdigest()))
    return out


def same(found, expected):
    key = lambda r: (r[0] is not None, *map(str, r))
    assert sorted(map(tuple, found), key=key) == sorted(expected, key=key)


def passages(seed):
    rng = random.Random(seed)
    text = lambda n: "".join(rng.choice("abcdefgé \n") for _ in range(n))
    shared = [text(n) for n in (150, 199, 200, 201, 260, 500, 900)]
    rows = []
    for i in range(70):
        made = text(rng.randint(0, 300))
        for _ in range(rng.randint(0, 3)):
            p = rng.choice(shared)
            a = rng.randint(0, 60)
            made += p[a if rng.random() < 0.4 else 0 :] + text(rng.randint(0, 200))
        rows.append((i, made))
    rows += [(100, None), (101, ""), (102, "short"), (103, "ab" * 400), (104, "x" * 199), (105, "y" * 201), (None, rows[3][1])]
    rows += [(106, shared[5]), (107, shared[5]), (107, shared[5]), (108, shared[6][:450] + "Q" + shared[6][451:])]
    return rows


@pytest.mark.parametrize("seed,block_bytes,hot", [(1, S.BLOCK_BYTES, S.HOT), (2, 3000, S.HOT), (3, 3000, 1), (4, 100, 1)])
def test_report_equals_counting_all_strings(spark, monkeypatch, seed, block_bytes, hot):
    monkeypatch.setattr(S, "BLOCK_BYTES", block_bytes)
    monkeypatch.setattr(S, "HOT", hot)
    rows = passages(seed)
    docs = spark.createDataFrame([(i, t, "b") for i, t in rows], "doc_id long, text string, block string")
    expected = plain(rows)
    assert sum(e[2] for e in expected)
    same(S.report(docs).collect(), expected)


def test_chunks_of_long_texts(spark, monkeypatch):
    monkeypatch.setattr(S, "CHUNK", 700)
    rng = random.Random(9)
    long = "".join(rng.choice("abcdef ") for _ in range(4000))
    rows = [(1, long), (2, long[300:2900]), (3, "z" + long[1000:1500] + "z")]
    same(S.report(spark.createDataFrame(rows, "doc_id long, text string")).collect(), plain(rows))
    none = spark.createDataFrame([], "doc_id long, text string")
    assert S.report(none).count() == 0


def test_merge_equals_sorting():
    rng = random.Random(4)
    for n in (0, 1, 2, 3, 7, 8):
        runs = [sorted(bytes(rng.choice(b"ab") for _ in range(rng.randint(0, 9))) for _ in range(rng.randint(0, 40))) for _ in range(n)]
        streams = [S.unfolded(*S.front_coded(r)) for r in runs]
        got = list(S.merged(streams))
        words = [s for _, _, s in got]
        assert words == sorted(s for r in runs for s in r)
        for (_, p, s), before in zip(got[1:], words):
            assert p == S.common_prefix(before, s)
        for k, r in enumerate(runs):
            assert [s for run, _, s in got if run == k] == r


def test_query_equals_counting(spark):
    sf_dir = "/root/testdata/sf0.001"
    rows = [(r["doc_id"], r["text"]) for r in registry.table(spark, sf_dir, "documents").collect()]
    same(registry.queries()["op5_suffix_dedup"](spark, sf_dir).collect(), plain(rows))

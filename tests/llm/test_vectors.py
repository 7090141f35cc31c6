"""Vector searches against brute force."""

from __future__ import annotations

import math
import random

import numpy as np
import parity
import pytest

from ledgerlight.llm import exact_topk, hnsw, registry, vectors

SF_DIR = "/root/testdata/sf0.001"
SCHEMA = "vec_id long, embedding array<float>, score string"


def rows(seed, n=240):
    rng = random.Random(seed)
    made = [(i, [rng.gauss(0, 0.2) for _ in range(6)], "s") for i in range(n)]
    made = [(i, [float(np.float32(x)) for x in v], s) for i, v, s in made]
    copy = made[3][1]
    made += [(n + i, copy, "s") for i in range(60)]  # a group of copies, queries among them
    made += [made[5], made[100], made[100]]  # repeated rows
    made += [(2000, None, "s"), (2050, [0.0] * 6, "s"), (2100, [1.0, None] * 3, "s"), (2150, [float("nan")] * 6, "s")]
    made += [(2200, [float("inf")] * 6, "s"), (2300, [], "s"), (None, copy, "s")]
    made += [(3000, [0.5, -0.5], "s"), (3001, [0.25, 0.75], "s")]  # another length
    return made


def usable(row, zero):
    i, v, _ = row
    return i is not None and v and all(x is not None and math.isfinite(x) for x in v) and (zero or any(v))


def brute(table, every, k, score, zero, descending):
    out = []
    good = [(r[0], r[1]) for r in table if usable(r, zero)]
    for q, qv in sorted({i: v for i, v in good if i % every == 0}.items()):
        found = [(score(qv, v), i) for i, v in good if i != q and len(v) == len(qv)]
        found.sort(key=lambda x: (-x[0] if descending else x[0], x[1]))
        out += [(q, rank, i, s) for rank, (s, i) in enumerate(found[:k], 1)]
    return out


@pytest.mark.parametrize("per_shard", [4096, 50])
def test_top_k_is_exact(spark, monkeypatch, per_shard):
    monkeypatch.setattr(exact_topk, "PER_SHARD", per_shard)
    monkeypatch.setattr(exact_topk, "PER_BLOCK", 3)
    table = rows(1)
    found = sorted(tuple(r) for r in exact_topk.report(spark.createDataFrame(table, SCHEMA)).collect())
    product = lambda a, b: sum(math.floor(256 * x) * math.floor(256 * y) for x, y in zip(a, b))
    assert found == brute(table, 50, 5, product, True, True)


def test_scores_beyond_doubles(spark):
    table = [(0, [1e9, 1.0, -1e9], "s"), (1, [1e9, 3.0, 1e9], "s"), (2, [-1e9, 2.0, 7e8], "s"), (50, [1e30, 0.0, 0.0], "s")]
    found = {(r["query_id"], r["vec_id"]): r["score"] for r in exact_topk.report(spark.createDataFrame(table, SCHEMA)).collect()}
    whole = [[math.floor(256 * float(np.float32(x))) for x in v] for _, v, _ in table]
    for (q, v), s in found.items():
        x = sum(a * b for a, b in zip(whole[min(q, 3)], whole[min(v, 3)]))
        assert s == min(max(x, -(2**63)), 2**63 - 1)
    assert len(found) == 6


@pytest.mark.parametrize("per_shard", [4096, 60])
def test_neighbours_of_small_tables_are_exact(spark, monkeypatch, per_shard):
    monkeypatch.setattr(hnsw, "PER_SHARD", per_shard)
    monkeypatch.setattr(hnsw, "PER_BLOCK", 2)
    table = rows(2)
    found = sorted(tuple(r) for r in hnsw.report(spark.createDataFrame(table, SCHEMA)).collect())
    distance = lambda a, b: math.sqrt(sum((x - y) ** 2 for x, y in zip(a, b)))
    expected = brute(table, 100, 10, distance, False, False)
    assert [f[:3] for f in found] == [e[:3] for e in expected]
    assert np.allclose([f[3] for f in found], [e[3] for e in expected], rtol=1e-12)


def test_recall_of_the_graph():
    rng = np.random.default_rng(1)
    points = rng.normal(size=(1500, 48))
    points[:400] = points[0] + rng.normal(size=(400, 48)) * 1e-3  # a dense group
    graph, _ = hnsw.build(np.unique(points, axis=0))
    queries = points[::10]
    far = ((queries[:, None, :] - graph.points[None]) ** 2).sum(axis=2)
    true = np.argsort(far, axis=1)[:, :10]
    found = hnsw.nearest(graph, queries, hnsw.SEARCH_BEAM)
    best = np.take_along_axis(far, found, axis=1)
    assert np.mean([len(set(t) & set(f[np.argsort(b)][:10])) / 10 for t, f, b in zip(true, found, best)]) >= 0.9
    assert all((layer < len(layer)).all() for layer in graph.layers)


def test_empty_tables(spark):
    none = spark.createDataFrame([], SCHEMA)
    assert exact_topk.report(none).count() == hnsw.report(none).count() == 0


def test_parity(spark):
    name = "op8_exact_top_k"
    assert parity.compare(registry.queries()[name](spark, SF_DIR), parity.connect(SF_DIR), registry.oracle_sql()[name])


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("module", [exact_topk, hnsw])
def test_pairs_of_shards_and_blocks_are_not_shuffled(spark, monkeypatch, module):
    monkeypatch.setattr(module, "PER_SHARD", 20)
    monkeypatch.setattr(module, "PER_BLOCK", 2)
    plan = plan_of(module.report(spark.createDataFrame(rows(3), SCHEMA)))
    above, _, below = plan.partition("CartesianProduct")
    # what the searches found is dealt out by query, and what they read lies in storage
    assert below and "Exchange" not in below and above.count("Exchange hash") == 1


def test_many_shards_share_tasks(spark):
    df = vectors.usable(spark.createDataFrame(rows(4), SCHEMA), True)
    packed, shards = vectors.pack(df, 1)
    assert shards > 300 and packed.rdd.getNumPartitions() <= max(4 * spark.sparkContext.defaultParallelism, shards // 8 + 1)


def test_parts_of_the_queries_give_the_same(spark, monkeypatch):
    table = spark.createDataFrame(rows(5), SCHEMA)
    whole = sorted(map(tuple, exact_topk.report(table).collect()))
    monkeypatch.setattr(exact_topk, "PER_BLOCK", 1)
    monkeypatch.setattr(exact_topk, "PER_SHARD", 7)
    monkeypatch.setattr(vectors, "HELD", 50)
    monkeypatch.setattr(vectors, "TASKS", 1)
    assert sorted(map(tuple, exact_topk.report(table).collect())) == whole

"""Near duplicates against all pairs of full shingle sets."""

from __future__ import annotations

import os
import random
import re

import pytest

from ledgerlight.llm import near_dedup, registry, shared

LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def plain_set(text):
    words = re.findall("[^\x20\x09-\x0d]+", (text or "").translate(LOWER))
    if not words:
        return frozenset()
    return frozenset(tuple(words[i : i + 5]) for i in range(max(1, len(words) - 4)))


def plain_groups(rows, similarity):
    sets = [(i, plain_set(t)) for i, t in rows]
    root = {i: i for i, _ in sets}

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for k, (i, x) in enumerate(sets):
        for j, y in sets[:k]:
            if x and y and 100 * len(x & y) >= similarity * len(x | y):
                a, b = sorted((find(i), find(j)))
                root[b] = a
    return sorted((i, len(s), find(i), find(i) == i) for i, s in sets)


def near_copies(seed):
    rng = random.Random(seed)
    word = lambda: "".join(rng.choice("abcdeé") for _ in range(3))
    rows = []
    for _ in range(6):
        text = [word() for _ in range(rng.choice([3, 5, 40, 300]))]
        for _ in range(rng.randint(1, 12)):
            made = list(text)
            for _ in range(rng.randint(0, max(1, len(text) // 40))):
                made[rng.randrange(len(made))] = word()
            rows.append(" ".join(made).title() if rng.random() < 0.3 else " \n".join(made))
    ids = rng.sample(range(-50, 1000), len(rows))
    return list(zip(ids, rows)) + [(2000, None), (2001, ""), (2002, " \t\n"), (2003, "one"), (2004, "ONE"), (2005, "ÉA")]


@pytest.mark.parametrize("seed,similarity", [(1, 85), (2, 80)])
def test_groups_equal_all_pairs(spark, seed, similarity):
    rows = near_copies(seed)
    docs = spark.createDataFrame([(i, t, "k") for i, t in rows], "doc_id long, text string, keys string")
    found = sorted(tuple(r) for r in near_dedup.groups(docs, similarity).collect())
    assert found == plain_groups(rows, similarity)


def test_query_equals_all_pairs_on_the_small_table(spark):
    sf_dir = "/root/testdata/sf0.001"
    rows = [(r["doc_id"], r["text"]) for r in registry.table(spark, sf_dir, "documents").collect()]
    found = sorted(tuple(r) for r in registry.queries()["op9_near_dedup"](spark, sf_dir).collect())
    assert found == plain_groups(rows, 85)


def test_every_pair_within_the_distance_shares_a_key():
    rng = random.Random(3)
    import numpy as np

    for _ in range(300):
        a = np.array([rng.randrange(1 << 16) for _ in range(near_dedup.HASHES)], np.uint64)
        b = a.copy()
        for k in rng.sample(range(near_dedup.HASHES), near_dedup.DISTANCE):
            b[k] ^= np.uint64(1 + rng.randrange(255))
        assert set(near_dedup._keys(a).tolist()) & set(near_dedup._keys(b).tolist())
        differ = np.bitwise_or.reduce(near_dedup._slices(a) ^ near_dedup._slices(b))
        assert bin(int(differ)).count("1") == near_dedup.DISTANCE


def test_deduplicate_keeps_one_of_each_group_and_repeated_rows_once(spark):
    text = " ".join(f"w{i}" for i in range(60))
    rows = [(1, text, "a"), (2, text.upper(), "b"), (3, text + " more", "c"), (4, "other", "d"), (4, "other", "d"), (5, None, "e")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, component_id string")
    kept = near_dedup.deduplicate(docs)
    assert kept.columns == docs.columns
    assert sorted(r["doc_id"] for r in kept.collect()) == [1, 4, 5]
    assert near_dedup.groups(docs.where("false")).count() == 0


def test_components(spark):
    rng = random.Random(5)
    edges = [(rng.randrange(400), rng.randrange(400)) for _ in range(250)] + [(i, i + 1) for i in range(500, 560)] + [(9, 9)]
    root = list(range(600))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for a, b in edges:
        a, b = sorted((find(a), find(b)))
        root[b] = a
    found = {r["id"]: r["component"] for r in shared.components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert found == {n: find(n) for e in edges if e[0] != e[1] for n in e}


def test_rows_without_doc_id_are_linked_and_kept_by_rule(spark):
    words = lambda k: [f"{k}{i}" for i in range(60)]
    a, b, c = (" ".join(words(k)) for k in "abc")
    near = lambda k: " ".join(words(k)[:-1] + ["other"])
    rows = [(None, a, 1), (5, a, 2), (3, a.upper(), 3), (9, near("a"), 4), (None, near("a") + " more", 5)]
    rows += [(None, b, 6), (None, b, 7), (None, near("b"), 8), (None, None, 9), (None, " ", 10), (None, c, 11)]
    rows += [(20, near("c"), 12), (None, "alone", 13), (21, None, 14)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, n int")
    found = near_dedup.groups(docs, 80).collect()
    assert len(found) == len(rows) and all(r["kept"] is not None for r in found)
    of_a = [r for r in found if r["component_id"] == 3]
    assert sorted((r["doc_id"] is None, r["doc_id"] or 0, r["kept"]) for r in of_a) == [
        (False, 3, True), (False, 5, False), (False, 9, False), (True, 0, False), (True, 0, False)
    ]
    of_c = [r for r in found if r["component_id"] == 20]
    assert sorted((r["doc_id"] or 0, r["kept"]) for r in of_c) == [(0, False), (20, True)]
    made = [r for r in found if (r["component_id"] or 0) >= 1 << 62]
    assert sorted(sum(r["component_id"] == i for r in made) for i in {r["component_id"] for r in made}) == [1, 3]
    assert sum(r["kept"] for r in found if r["component_id"] is None) == 2
    kept = near_dedup.deduplicate(docs)
    assert kept.columns == docs.columns
    left = sorted(r["n"] for r in kept.collect())
    assert [n for n in left if n not in (6, 7, 8)] == [3, 9, 10, 12, 13, 14] and len(left) == 7


def test_small_steps_are_few_tasks(spark):
    """With many shuffle partitions that nothing joins, each task would write files for a handful of edges."""
    held = {"spark.sql.shuffle.partitions": "40", "spark.sql.adaptive.coalescePartitions.enabled": "false"}
    before = {k: spark.conf.get(k) for k in held}
    edges = spark.createDataFrame([(i, i + 1) for i in range(60)], "a long, b long")
    folder = shared.checkpoint_folder(spark).removeprefix("file:")
    known = set(os.listdir(folder)) if os.path.exists(folder) else set()
    try:
        for k, v in held.items():
            spark.conf.set(k, v)
        assert {r["component"] for r in shared.components(edges).collect()} == {0}
        assert shared.gathered(edges.repartition(40)).rdd.getNumPartitions() <= spark.sparkContext.defaultParallelism
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)
    rounds = sorted(set(os.listdir(folder)) - known, key=lambda name: int(name.split("-")[1]))
    parts = [sum(f.startswith("part-") for f in os.listdir(f"{folder}/{r}")) for r in rounds]
    assert len(parts) > 2 and max(parts[1:]) <= spark.sparkContext.defaultParallelism

"""Pfair mixing against a slot-by-slot simulation."""

from __future__ import annotations

import math
from collections import Counter, defaultdict
from fractions import Fraction

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from ledgerlight.llm import mixing, registry


@given(st.lists(st.integers(1, 40), min_size=1, max_size=12))
@settings(max_examples=60, deadline=None)
def test_a_period_is_fair_at_every_slot(shares):
    slots = mixing.period_slots(shares)
    period = sum(shares)
    assert sorted(x for own in slots for x in own) == list(range(period))
    for a, own in zip(shares, slots):
        for i, slot in enumerate(own):
            assert i * period // a <= slot < math.ceil(Fraction((i + 1) * period, a))
        had = 0
        for slot in range(period):
            had += slot in set(own)
            assert abs(had - Fraction(a * (slot + 1), period)) < 1


def simulated(blocks, weights):
    """Slot by slot: (source, block) in order."""
    left, order = list(blocks), []
    while active := [s for s in range(len(left)) if left[s]]:
        shares = dict(zip(active, mixing.parts([weights[s] for s in active], max(mixing.PERIOD, 10 * len(active)))))
        period, had, slot = sum(shares.values()), Counter(), 0
        while all(left[s] for s in active):
            ready = [s for s in active if Fraction(had[s] * period, shares[s]) < slot + 1]
            s = min(ready, key=lambda s: (math.ceil(Fraction((had[s] + 1) * period, shares[s])), s))
            order.append((s, blocks[s] - left[s]))
            had[s] += 1
            left[s] -= 1
            slot += 1
    return order


def test_phases_equal_the_simulation():
    for blocks, weights in [([5, 700, 40], [1.0, 1.0, 3.0]), ([1], [2.0]), ([3000, 2, 9, 9], [0.7, 0.1, 0.1, 0.1])]:
        made = mixing.phases(blocks, weights)
        order = {}
        for s, n in enumerate(blocks):
            for j in range(n):
                p = [p for p in made[s] if p["first"] <= j][-1]
                own = j - p["first"]
                order[p["begin"] + own // p["share"] * p["period"] + p["slots"][own % p["share"]]] = (s, j)
        assert [order[i] for i in range(sum(blocks))] == simulated(blocks, weights)


def test_parts_add_up():
    assert mixing.parts([0.5, 0.25, 0.25], 100) in ([49, 26, 25], [50, 25, 25])
    assert sum(mixing.parts([1e-9, 1.0, 3.0], 1000)) == 1000 and min(mixing.parts([1e-9, 1.0], 1000)) == 1


def test_mix_keeps_all_rows_within_one_block(spark):
    rows = [(i, None if i % 17 == 0 else "hot" if i % 3 else f"s{i % 7}", "t" * (i % 5), "p") for i in range(900)]
    rows += [rows[4], rows[4], (None, "s1", None, "p")]
    docs = spark.createDataFrame(rows, "doc_id long, source string, text string, position string")
    weights = {s: 1.0 + (s == "hot") for s in {r[1] for r in rows}}
    found = mixing.mix(docs, weights=weights, block=4).collect()
    assert len(found) == len(rows)
    assert Counter((r["doc_id"], r["source"], r["text"]) for r in found) == Counter(r[:3] for r in rows)
    assert len({r["position"] for r in found}) == len(rows)
    assert all(abs(r["deviation"]) < 1 and r["release"] <= r["slot"] < r["deadline"] for r in found)
    by_slot = defaultdict(set)
    for r in found:
        by_slot[r["slot"]].add((r["source"], r["block"]))
    assert sorted(by_slot) == list(range(len(by_slot))) and all(len(v) == 1 for v in by_slot.values())
    ordered = mixing.in_order(docs, weights=weights, block=4)
    assert ordered.columns == docs.columns
    place = {(r["doc_id"], r["text"]): r["position"] for r in found}
    positions = [place[r["doc_id"], r["text"]] for r in ordered.collect() if r["doc_id"] != 4]
    assert positions == sorted(positions)


def test_weights_must_be_given_for_all(spark):
    docs = spark.createDataFrame([(1, "a"), (2, "b")], "doc_id long, source string")
    with pytest.raises(ValueError, match="'b'"):
        mixing.mix(docs, weights={"a": 1.0})
    assert mixing.mix(docs.where("false")).count() == 0


def test_query_covers_the_table(spark):
    sf_dir = "/root/testdata/sf0.01"
    rows = registry.queries()["op3_mixture"](spark, sf_dir).collect()
    assert len(rows) == registry.table(spark, sf_dir, "documents").count()
    assert all(abs(r["deviation"]) < 1 for r in rows)


def most_off(blocks, weights):
    """The largest deviation of any block from the given weights in the first phase, exactly."""
    total = sum(map(Fraction, weights))
    own = [p[0] for p in mixing.phases(blocks, weights)]
    return max(abs(i + 1 - (slot + 1) * Fraction(w) / total) for w, p in zip(weights, own) for i, slot in enumerate(p["slots"]))


def test_long_phases_keep_to_the_given_weights():
    assert most_off([20_000] * 3, [1.0, 1.0, 1.0]) < 1
    assert most_off([20_000] + [500] * 40, [0.5] + [0.0125] * 40) < 1
    assert most_off([30_000, 9, 30_000], [1.0, 0.0001, math.sqrt(2)]) < 1
    # A half stays a half with a hundred sources and more.
    own = mixing.phases([6000] + [100] * 120, [0.5] + [0.5 / 120] * 120)[0][0]
    assert abs(own["share"] / own["period"] - 0.5) < 1e-12


def test_deviation_is_from_the_given_weights(spark):
    weights = {"a": 0.9, "b": 0.0999, "c": 0.0001}
    docs = spark.range(9000).selectExpr("id as doc_id", "if(id % 9 < 7, 'a', if(id % 9 < 8, 'b', 'c')) as source")
    found = [r for r in mixing.mix(docs, weights=weights, block=1).collect() if r["phase"] == 1]
    assert len(found) > 5000
    for s, w in weights.items():
        for i, r in enumerate(sorted((r for r in found if r["source"] == s), key=lambda r: r["slot"])):
            assert r["deviation"] == pytest.approx(i + 1 - (r["slot"] + 1) * w, abs=1e-6) and abs(r["deviation"]) < 1

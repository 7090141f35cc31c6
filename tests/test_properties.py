"""Operators against brute force in plain Python, on random rows."""

from __future__ import annotations

import datetime as dt
import random
from decimal import ROUND_HALF_UP, Decimal

from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

import rows as R
from ledgerlight.functions import exprs as X
from ledgerlight.operators import spans
from ledgerlight.operators.upsert import MergeSpec, merge_by_key, one_row_per_key
from ledgerlight.plans import billing, lists, marts, staging


def test_rounded_ratio_is_exact(spark):
    rnd = random.Random(5)
    pairs = [(rnd.randint(-5000, 5000), rnd.choice([0, 1, 3, 8, 16, 40, 64, 200, 4000, 20000])) for _ in range(2000)]
    df = spark.createDataFrame(pairs, "n long, d long")
    for digits in (1, 2):
        unit = Decimal(1).scaleb(-digits)
        for row in df.withColumn("r", X.rounded_ratio(F.col("n"), F.col("d"), digits)).collect():
            if row.d == 0:
                assert row.r is None
            else:
                assert row.r == (Decimal(row.n) / row.d).quantize(unit, ROUND_HALF_UP)


MONTHS = st.integers(0, 14)
SPANS = st.lists(st.tuples(st.integers(1, 3), MONTHS, st.one_of(st.none(), MONTHS)), max_size=25)


def first_of(n):
    return dt.date(2020 + n // 12, n % 12 + 1, 1)


@settings(max_examples=15, deadline=None)
@given(SPANS)
def test_uncovered_parts_are_disjoint_and_cover_the_same_months(spark, rows):
    rows = [(k, a, b) for k, a, b in rows if b is None or a < b]
    data = [(k, first_of(a), None if b is None else first_of(b)) for k, a, b in rows]
    df = spark.createDataFrame(data, "k int, start_m date, end_m date")
    out = spans.uncovered_parts(df, "k").collect()
    for m in range(20):
        month = first_of(m)
        for key in (1, 2, 3):
            active = any(k == key and a <= m and (b is None or m < b) for k, a, b in rows)
            covering = [r for r in out if r.k == key and r.start_m <= month and (r.end_m is None or month < r.end_m)]
            assert len(covering) == int(active)


def upsert_in_python(target, batches, spec, columns):
    state = {r[0]: dict(zip(columns, r)) for r in target}
    for row in batches:
        new = dict(zip(columns, row))
        if row[0] in state:
            state[row[0]] |= {c: new[c] for c in spec.update}
        else:
            state[row[0]] = new
    return sorted(tuple(r[c] for c in columns) for r in state.values())


def test_replayed_batches_equal_row_by_row_upserts(spark):
    rnd = random.Random(11)
    spec, columns = MergeSpec("id", ("status", "canceled")), ["id", "plan", "status", "canceled"]
    row = lambda k: (k, rnd.choice("pqr"), rnd.choice("st"), rnd.choice([None, 1, 2]))
    target = [row(k) for k in range(0, 60)]
    # a third of the batch is one key
    batch = [row(5 if rnd.random() < 0.33 else rnd.randint(30, 90)) for _ in range(300)]
    now = dt.datetime(2024, 1, 1)
    fields = "id int, plan string, status string, canceled int"
    old = spark.createDataFrame([(*r, None) for r in target], f"{fields}, synced_at timestamp_ntz")
    placed = [(*r, i // 100, i % 100) for i, r in enumerate(batch)]
    new = spark.createDataFrame(placed, f"{fields}, page int, position int")
    once = one_row_per_key(new.repartition(7), spec, ("page", "position"), "latest")
    expected = upsert_in_python(target, batch, spec, columns)
    for size in (None, 0):
        out = merge_by_key(old, once, spec, now, size).select(*columns)
        assert sorted((tuple(r) for r in out.collect()), key=repr) == sorted(expected, key=repr)


def test_billing_periods_equal_a_loop(spark):
    rnd = random.Random(3)
    as_of = dt.datetime(2024, 6, 15)
    rows, expected = [], []
    for i in range(200):
        start = dt.datetime(2023, 1, 1) + dt.timedelta(seconds=rnd.randint(0, 500 * 86400))
        end = start + dt.timedelta(days=rnd.randint(-10, 120)) if rnd.random() < 0.5 else None
        rows.append((i, 1, "starter", "active", i, start.isoformat(), end and end.isoformat()))
        at = start
        while at < (end or as_of):
            expected.append((i, at))
            at += dt.timedelta(days=30)
    out = billing.operational_charges(R.subscriptions(spark, rows), as_of.date())
    assert sorted(tuple(r) for r in out.select("amount_cents", "created_at").collect()) == sorted(expected)


def test_pages_equal_list_slices(spark):
    keys = sorted(f"c{n:03d}" for n in random.Random(2).sample(range(500), 57))
    df = R.payment_customers(spark, [(k, None) for k in keys]).repartition(5).cache()
    for cursor in [None, keys[0], keys[30], keys[-2], keys[-1], "nobody"]:
        start = keys.index(cursor) + 1 if cursor in keys else 0
        for limit in (1, 20, 57, 58):
            page = lists.list_customers_page(df, cursor, limit).collect()
            assert [r.id for r in page] == keys[start : start + limit]
            assert {r.has_more for r in page} <= {start + limit < len(keys)}
    df.unpersist()


def test_funnel_counts_are_consistent(spark):
    rnd = random.Random(9)
    people = []
    for i in range(400):
        signup = dt.datetime(2024, 1, 1) + dt.timedelta(hours=rnd.randint(0, 240))
        active = signup + dt.timedelta(hours=rnd.randint(1, 168)) if rnd.random() < 0.7 else None
        plan = rnd.choice(["starter", None])
        people.append((i, f"u{i}", signup.isoformat(), active and active.isoformat(), plan))
    out = marts.activation_funnel(staging.stg_users(R.users(spark, people))).collect()
    assert sum(r.signups for r in out) == 400
    assert sum(r.activated for r in out) == sum(p[3] is not None for p in people)
    assert sum(r.converted_to_paid for r in out) == sum(p[4] is not None for p in people)
    assert all(r.activated <= r.signups and r.activation_rate <= 100 for r in out)
    assert [r.signup_date for r in out] == sorted((r.signup_date for r in out), reverse=True)

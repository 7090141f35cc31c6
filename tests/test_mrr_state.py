"""Recurring revenue from daily changes equals the full build of every day."""

from __future__ import annotations

import datetime as dt
import random

import rows as R
from ledgerlight.plans import marts, mrr_state, staging
from ledgerlight.sources import keyed

AT = dt.datetime(2024, 1, 1)


def staged(spark, rows):
    return staging.stg_subscriptions(R.subscriptions(spark, list(rows)))


def report(df):
    return df.columns, [tuple(r) for r in df.collect()]


def check(spark, state, rows):
    assert report(mrr_state.mrr_by_month(spark, state, R.AS_OF)) == report(marts.mrr_by_month(staged(spark, rows), R.AS_OF))


def test_day_by_day_equals_the_full_build(spark, tmp_path):
    rng, state, known = random.Random(4), str(tmp_path / "state"), {}
    month = lambda: f"2023-{rng.randint(1, 12):02d}-{rng.randint(1, 28):02d}"
    for epoch in range(5):
        before = dict(known)
        for i in rng.sample(range(40), 12):
            if i in known and rng.random() < 0.2:
                del known[i]  # a subscription is deleted
            elif i in known:  # a late cancel, or one taken back; or another amount, plan or customer
                row = list(known[i])
                row[6] = rng.choice([None, month()])
                row[4] = rng.choice([row[4], None, 500])
                row[1] = rng.choice([row[1], row[1], 1, None])
                row[2] = rng.choice([row[2], "other", None])
                known[i] = tuple(row)
            else:
                user = rng.choice([1, 1, 2, 3, 4, None])
                started = rng.choice([month(), month(), None])
                known[i] = (i, user, rng.choice(["starter", "enterprise", "legacy"]), "active", rng.choice([100, 250, None]), started, rng.choice([None, month()]))
        moved = mrr_state.changed(staged(spark, before.values()), staged(spark, known.values()))
        assert moved[1].count() <= 12
        mrr_state.update(spark, state, *moved, epoch, AT, buckets=3)
        check(spark, state, known.values())
    mrr_state.update(spark, state, *moved, epoch, AT, buckets=3)  # repeated: nothing changes
    check(spark, state, known.values())


def test_a_failure_leaves_the_state_and_is_repeated(spark, tmp_path, monkeypatch):
    state = str(tmp_path / "state")
    first = R.SUBSCRIPTIONS[:3]
    mrr_state.update(spark, state, staged(spark, []), staged(spark, first), 1, AT, buckets=2)
    check(spark, state, first)

    def fail(*_):
        raise OSError("lost")

    later = staged(spark, R.SUBSCRIPTIONS[3:])
    with monkeypatch.context() as m:
        m.setattr(keyed, "_publish", fail)
        try:
            mrr_state.update(spark, state, staged(spark, []), later, 2, AT)
        except OSError:
            pass
    check(spark, state, first)
    mrr_state.update(spark, state, staged(spark, []), later, 2, AT)
    check(spark, state, R.SUBSCRIPTIONS)


def test_customers_without_periods_are_let_go(spark, tmp_path):
    state = str(tmp_path / "state")
    rows = [(1, 7, "starter", "active", 100, "2024-01-05", None)]
    mrr_state.update(spark, state, staged(spark, []), staged(spark, rows), 1, AT, buckets=2)
    mrr_state.update(spark, state, staged(spark, rows), staged(spark, []), 2, AT)
    assert mrr_state.mrr_by_month(spark, state, R.AS_OF).count() == 0
    assert keyed.read(spark, mrr_state.periods_table(state)).first()["periods"] == []
    assert mrr_state.mrr_by_month(spark, str(tmp_path / "none"), R.AS_OF).count() == 0


def test_changes_are_read_twice_however_much_they_move(spark, tmp_path):
    state, seen = str(tmp_path / "state"), spark.sparkContext.accumulator(0)

    def counted(batches):
        for batch in batches:
            seen.add(batch.num_rows)
            yield batch

    for epoch, rows in ((1, R.SUBSCRIPTIONS[:3]), (2, R.SUBSCRIPTIONS[3:])):
        changes = staged(spark, rows)
        before = seen.value
        mrr_state.update(spark, state, changes.where("false"), changes.mapInArrow(counted, changes.schema), epoch, AT, buckets=2)
        # once for the customers' pairs of months, once for the sums
        assert seen.value - before == 2 * len(rows)
    check(spark, state, R.SUBSCRIPTIONS)

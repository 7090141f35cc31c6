"""Three ways to compute recurring revenue give the same rows, also on random data."""

from __future__ import annotations

import datetime as dt
import random

import pytest

import rows as R
from ledgerlight.plans import marts, staging


def pairwise(spark, staged, as_of):
    """Every month against every subscription."""
    staged.createOrReplaceTempView("mrr_subs")
    return spark.sql(f"""
        WITH spine AS (
            SELECT trunc(date(started_at), 'MM') AS month FROM mrr_subs WHERE started_at IS NOT NULL
            UNION SELECT trunc(DATE '{as_of}', 'MM'))
        SELECT month, count(DISTINCT subscription_id) AS subs, count(DISTINCT user_id) AS customers,
               sum(mrr) AS total, round(avg(mrr), 6) AS mean,
               sum(CASE WHEN plan = 'starter' THEN mrr ELSE 0 END) AS starter,
               sum(CASE WHEN plan = 'professional' THEN mrr ELSE 0 END) AS professional,
               sum(CASE WHEN plan = 'enterprise' THEN mrr ELSE 0 END) AS enterprise
        FROM spine JOIN mrr_subs ON trunc(date(started_at), 'MM') <= month
             AND (canceled_at IS NULL OR trunc(date(canceled_at), 'MM') > month)
        GROUP BY month ORDER BY month""")


def expanded(spark, staged, as_of):
    """One row per subscription and active month, kept where the month is in the spine."""
    staged.createOrReplaceTempView("mrr_subs")
    return spark.sql(f"""
        WITH spine AS (
            SELECT trunc(date(started_at), 'MM') AS month FROM mrr_subs WHERE started_at IS NOT NULL
            UNION SELECT trunc(DATE '{as_of}', 'MM')),
        horizon AS (SELECT max(month) AS last FROM spine),
        months AS (
            SELECT *, explode(filter(sequence(start_m, greatest(start_m, last), INTERVAL 1 MONTH),
                                     m -> end_m IS NULL OR m < end_m)) AS month
            FROM (SELECT *, trunc(date(started_at), 'MM') AS start_m, trunc(date(canceled_at), 'MM') AS end_m
                  FROM mrr_subs WHERE started_at IS NOT NULL), horizon)
        SELECT month, count(DISTINCT subscription_id) AS subs, count(DISTINCT user_id) AS customers,
               sum(mrr) AS total, round(avg(mrr), 6) AS mean,
               sum(CASE WHEN plan = 'starter' THEN mrr ELSE 0 END) AS starter,
               sum(CASE WHEN plan = 'professional' THEN mrr ELSE 0 END) AS professional,
               sum(CASE WHEN plan = 'enterprise' THEN mrr ELSE 0 END) AS enterprise
        FROM months WHERE month IN (SELECT month FROM spine)
        GROUP BY month ORDER BY month""")


def as_numbers(df):
    return [tuple(float(v) if i and v is not None else v for i, v in enumerate(r)) for r in df.collect()]


def random_subscriptions(seed):
    rnd = random.Random(seed)
    start = dt.datetime(2022, 11, 1)
    rows = []
    for i in range(300):
        begin = start + dt.timedelta(days=rnd.randint(0, 500), hours=rnd.randint(0, 23))
        end = begin + dt.timedelta(days=rnd.randint(-20, 200)) if rnd.random() < 0.6 else None
        if rnd.random() < 0.05:
            begin = None
        # a third of all subscriptions belong to one user
        user = 1 if rnd.random() < 0.33 else rnd.choice([None, *range(2, 40)])
        rows.append(
            (i, user, rnd.choice(["starter", "professional", "enterprise", "legacy", None]),
             rnd.choice(["active", "canceled"]), rnd.choice([None, 100, 2900, 9905]),
             begin and begin.isoformat(), end and end.isoformat())
        )
    return rows


@pytest.mark.parametrize(
    "seed, as_of", [(1, dt.date(2024, 5, 20)), (2, dt.date(2023, 6, 1)), (3, dt.date(2021, 2, 28))]
)
def test_three_forms_agree(spark, seed, as_of):
    # as_of lies after, within and before the data: later starts count all the same
    staged = staging.stg_subscriptions(R.subscriptions(spark, random_subscriptions(seed))).cache()
    expected = as_numbers(pairwise(spark, staged, as_of))
    assert len(expected) > 10
    assert as_numbers(expanded(spark, staged, as_of)) == expected
    for unique_ids in (True, False):
        out = marts.mrr_by_month(staged, as_of, unique_ids)
        assert as_numbers(out) == expected
        totals = out.where("mrr_starter + mrr_professional + mrr_enterprise > total_mrr")
        assert totals.isEmpty()
    staged.unpersist()

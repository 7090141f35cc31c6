"""The marts on hand-made rows, with literal results."""

from __future__ import annotations

import datetime as dt
from decimal import Decimal as D

import pytest

import rows as R
from ledgerlight.plans import marts, staging


def collect(df, *columns):
    return [tuple(r) for r in df.select(*(columns or df.columns)).collect()]


def day(text):
    return dt.date.fromisoformat(text)


def test_activation_funnel(spark):
    out = collect(marts.activation_funnel(staging.stg_users(R.users(spark, R.USERS))))
    assert out == [
        (day("2024-01-03"), 1, 0, 1, D("0.00"), None, D("100.00"), None),
        (day("2024-01-02"), 1, 1, 1, D("100.00"), D("100.00"), D("100.00"), D("0.0")),
        (day("2024-01-01"), 2, 1, 1, D("50.00"), D("100.00"), D("50.00"), D("2.0")),
    ]


def test_funnel_averages_round_half_away_and_allow_early_activation(spark):
    people = [
        (1, "a", "2024-01-10", "2024-01-08", None),  # -2 days
        (2, "b", "2024-01-10", "2024-01-09 12:00", None),  # -0.5 days, truncated to 0
        (3, "c", "2024-01-10", "2024-01-11", None),
        (4, "d", "2024-01-10", "2024-01-10", None),
        (5, "e", "2024-01-11", "2024-01-11", None),
        (6, "f", "2024-01-11", "2024-01-11", None),
        (7, "g", "2024-01-11", "2024-01-12", None),
        (8, "h", "2024-01-11", "2024-01-11", None),
    ]
    out = marts.activation_funnel(staging.stg_users(R.users(spark, people)))
    assert collect(out, "avg_days_to_activate") == [(D("0.3"),), (D("-0.3"),)]


@pytest.mark.parametrize("unique_ids", [True, False])
def test_mrr_by_month(spark, unique_ids):
    staged = staging.stg_subscriptions(R.subscriptions(spark, R.SUBSCRIPTIONS))
    assert collect(marts.mrr_by_month(staged, R.AS_OF, unique_ids)) == [
        (day("2024-01-01"), 2, 2, D("48.00"), D("24.000000"), D("29.00"), D("0.00"), D("0.00")),
        (day("2024-03-01"), 3, 2, D("347.00"), D("115.666667"), D("29.00"), D("0.00"), D("299.00")),
        (day("2024-06-01"), 2, 1, D("328.00"), D("164.000000"), D("29.00"), D("0.00"), D("299.00")),
    ]


def test_mrr_null_amounts(spark):
    subs = [
        (1, 1, "starter", "active", None, "2024-01-15", "2024-03-01"),
        (2, 1, "starter", "active", None, "2024-02-15", None),
        (3, None, "enterprise", "active", 100, "2024-03-01", None),
    ]
    staged = staging.stg_subscriptions(R.subscriptions(spark, subs))
    assert collect(marts.mrr_by_month(staged, day("2024-03-31"))) == [
        # only starter rows without an amount: their sum is NULL, the others add zeros
        (day("2024-01-01"), 1, 1, None, None, None, D("0.00"), D("0.00")),
        (day("2024-02-01"), 2, 1, None, None, None, D("0.00"), D("0.00")),
        # the amount's subscription has no user; the users' have no amount
        (day("2024-03-01"), 2, 1, D("1.00"), D("1.000000"), D("0.00"), D("0.00"), D("1.00")),
    ]


def test_mrr_counts_a_repeated_id_once_when_ids_are_not_trusted(spark):
    subs = [(1, 1, "starter", "active", 100, "2024-01-15", None)] * 2
    staged = staging.stg_subscriptions(R.subscriptions(spark, subs))
    out = marts.mrr_by_month(staged, day("2024-01-31"), unique_ids=False)
    assert collect(out, "active_subscriptions", "paying_customers", "total_mrr") == [(1, 1, D("2.00"))]


def test_mrr_without_active_subscriptions_is_empty(spark):
    subs = [(1, 1, "starter", "canceled", 100, "2024-01-15", "2024-01-20")]
    staged = staging.stg_subscriptions(R.subscriptions(spark, subs))
    assert collect(marts.mrr_by_month(staged, R.AS_OF)) == []


def test_user_metrics(spark):
    out = marts.user_metrics(
        staging.stg_users(R.users(spark, R.USERS)),
        staging.stg_subscriptions(R.subscriptions(spark, R.SUBSCRIPTIONS)),
        staging.stg_events(R.events(spark, [*R.EVENTS, (400, None, "2024-02-01"), (401, 1, None)])),
    )
    columns = ("user_id", "total_events", "active_days", "current_mrr", "is_paying", "engagement_level")
    assert sorted(collect(out, *columns)) == [
        (1, 21, 20, D("299.00"), True, "high"),
        (2, 1, 1, D("0.00"), False, "low"),
        (3, 5, 5, D("0.00"), False, "medium"),
        (4, 0, 0, D("0.00"), False, "none"),
    ]


def test_user_whose_events_have_no_time_is_not_engaged(spark):
    out = marts.user_metrics(
        staging.stg_users(R.users(spark, R.USERS[:1])),
        staging.stg_subscriptions(R.subscriptions(spark, R.SUBSCRIPTIONS)),
        staging.stg_events(R.events(spark, [(1, 1, None)])),
    )
    assert collect(out, "total_events", "active_days", "engagement_level") == [(1, 0, "none")]


CUSTOMERS = [("cus_a", "ann@x.COM"), ("cus_b", "ANN@x.com"), ("cus_c", None), ("cus_d", "zed@x.com")]
PAID = [
    ("sub_1", "cus_a", "active", 2900, "2024-01-02", None),
    ("sub_2", "cus_b", "canceled", 9900, "2023-12-30 01:00", "2024-02-01"),
    ("sub_3", "cus_d", "active", 2900, "2024-01-05", None),
]


@pytest.mark.parametrize("zone", ["UTC", "America/New_York"])
def test_revenue_attribution_in_any_session_zone(spark, zone):
    spark.conf.set("spark.sql.session.timeZone", zone)
    try:
        out = marts.revenue_attribution(
            staging.stg_users(R.users(spark, R.USERS)),
            staging.stg_stripe_customers(R.payment_customers(spark, CUSTOMERS)),
            staging.stg_stripe_subscriptions(R.payment_subscriptions(spark, PAID)),
            R.AS_OF,
        )
        columns = ("user_id", "stripe_customer_id", "stripe_subscription_id", "subscription_days", "days_to_subscribe")
        assert sorted(collect(out, *columns)) == [
            (1, "cus_a", "sub_1", 165, 1),
            (1, "cus_b", "sub_2", 32, -1),
        ]
        assert collect(out.where("stripe_subscription_id = 'sub_2'"), "subscription_start_date") == [
            (R.ts("2023-12-30 01:00"),)
        ]
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")


def test_unknown_status_is_inactive(spark):
    subs = [(1, 1, "starter", None, 100, "2024-01-15", None)]
    assert collect(staging.stg_subscriptions(R.subscriptions(spark, subs)), "is_active") == [(False,)]

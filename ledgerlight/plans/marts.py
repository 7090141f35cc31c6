"""The four reporting tables, built from the staging views."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerlight.functions import exprs as X
from ledgerlight.operators import spans as S
from ledgerlight.operators.skew import join_skewed

# Plans with a revenue column of their own (fixed values)
PLANS = ("starter", "professional", "enterprise")

# Active days from which a user counts as high / medium (fixed values)
HIGH_DAYS, MEDIUM_DAYS = 20, 5


def mrr_by_month(subscriptions: DataFrame, as_of: dt.date, unique_ids: bool = True) -> DataFrame:
    """Monthly recurring revenue per month with at least one start, and the ``as_of`` month.

    A subscription counts from its start month up to the month before it is
    canceled. Subscriptions and revenue are running sums of monthly changes;
    paying customers first get the overlaps of their subscriptions removed.
    ``unique_ids`` relies on the primary key; without it subscription ids are
    counted as distinct values too. No month is ever joined to a subscription.
    """
    spans = active_spans(subscriptions)
    grouped = grouped_spans(spans)
    lasting_spans = spans.where(LASTING)
    changes = [S.distinct_key_changes(lasting_spans, "user_id", "customers")]
    if not unique_ids:
        changes.append(S.distinct_key_changes(lasting_spans, "subscription_id", "ids"))
    return mrr_of(grouped, changes, as_of, unique_ids)


# otherwise canceled in its first month or before: never active at a month's end
LASTING = "(end_m IS NULL OR end_m > start_m)"


def active_spans(subscriptions: DataFrame) -> DataFrame:
    """Started subscriptions by their months; plans without a revenue column share one group, which keeps the groups few."""
    return subscriptions.where(F.col("started_at").isNotNull()).select(
        "subscription_id",
        "user_id",
        "mrr",
        F.when(F.col("plan").isin(*PLANS), F.col("plan")).alias("plan"),
        X.month(F.col("started_at")).alias("start_m"),
        X.month(F.col("canceled_at")).alias("end_m"),
    )


def grouped_spans(spans: DataFrame) -> DataFrame:
    """All that is summed up of subscriptions, per pair of months and plan."""
    return spans.groupBy("start_m", "end_m", "plan").agg(
        F.count(F.lit(1)).alias("rows"),
        F.count("subscription_id").alias("known_ids"),
        F.count("mrr").alias("known_amounts"),
        F.coalesce(F.sum(X.to_cents(F.col("mrr"))), F.lit(0)).alias("sum_cents"),
    )


def mrr_of(grouped: DataFrame, distinct_changes: list[DataFrame], as_of: dt.date, unique_ids: bool = True) -> DataFrame:
    """The report from ``grouped_spans`` and the monthly changes in distinct customers (and ids, if not unique)."""
    lasting = LASTING
    measures = {
        "n": f"if({lasting}, rows, 0)",
        "ids": f"if({lasting}, known_ids, 0)",
        "amounts": f"if({lasting}, known_amounts, 0)",
        "cents": f"if({lasting}, sum_cents, 0)",
    }
    for plan in PLANS:
        here = f"{lasting} AND plan = '{plan}'"
        measures[f"cents_{plan}"] = f"if({here}, sum_cents, 0)"
        measures[f"missing_{plan}"] = f"if({here}, rows - known_amounts, 0)"
    if not unique_ids:
        del measures["ids"]
    measured = grouped.selectExpr("start_m", "end_m", *[f"{e} AS {m}" for m, e in measures.items()])

    changes = [
        S.monthly_changes(measured, [*measures]),
        *distinct_changes,
        grouped.sparkSession.range(0, 1, 1, 1).select(
            F.trunc(F.lit(X.as_date(as_of)), "month").alias("month"), F.lit(1).alias("is_start")
        ),
    ]
    running = [*measures, "customers"]
    if not unique_ids:
        running.append("ids")
    totals = S.monthly_totals(changes, running)

    def revenue(cents: str, has_value):
        return F.when(has_value, X.units(F.col(cents), X.MONEY_SUM))

    return (
        totals.where((F.col("is_start") == 1) & (F.col("n") > 0))
        .select(
            "month",
            F.col("ids").alias("active_subscriptions"),
            F.col("customers").alias("paying_customers"),
            revenue("cents", F.col("amounts") > 0).alias("total_mrr"),
            # the mean over subscriptions with an amount, whatever its name says
            (
                F.col("cents").cast("decimal(18,0)")
                / (F.nullif(F.col("amounts"), F.lit(0)) * 100).cast("decimal(18,0)")
            )
            .cast("decimal(18,6)")
            .alias("avg_mrr_per_customer"),
            # NULL only if every active row is of this plan and has no amount
            *[
                revenue(f"cents_{p}", F.col("n") > F.col(f"missing_{p}")).alias(f"mrr_{p}")
                for p in PLANS
            ],
        )
        .orderBy("month")
    )


def daily_activity(events: DataFrame) -> DataFrame:
    """Events per user and day: how many, and the first and last time."""
    return (
        events.where(F.col("user_id").isNotNull())
        .groupBy("user_id", X.day(F.col("event_at")).alias("day"))
        .agg(
            F.count(F.lit(1)).alias("n"),
            F.min("event_at").alias("first_at"),
            F.max("event_at").alias("last_at"),
        )
    )


def user_metrics(users: DataFrame, subscriptions: DataFrame, events: DataFrame) -> DataFrame:
    """Activity, revenue and engagement level of every user.

    Events are rolled up per user and day before they are rolled up per user,
    so a user with a huge share of the events is spread over their days, and
    the distinct days need no second pass. The summaries are then already
    partitioned by the join key; only users are shuffled for the joins.
    """
    return user_metrics_of(users, subscriptions, daily_activity(events))


def user_metrics_of(users: DataFrame, subscriptions: DataFrame, per_day: DataFrame) -> DataFrame:
    """The same from ``daily_activity``, one row per user and day."""
    activity = per_day.groupBy("user_id").agg(
        F.sum("n").alias("total_events"),
        F.count("day").alias("active_days"),
        F.min("first_at").alias("first_event_at"),
        F.max("last_at").alias("last_event_at"),
    )
    revenue = (
        subscriptions.where(F.col("user_id").isNotNull())
        .groupBy("user_id")
        .agg(
            # the largest active amount, not the sum
            F.max(F.when(F.col("is_active"), F.col("mrr")).otherwise(F.lit(0).cast(X.MONEY))).alias("mrr"),
            F.count_if("is_active").alias("active"),
        )
    )
    days = F.col("active_days")
    return (
        users.join(activity, "user_id", "left")
        .join(revenue, "user_id", "left")
        .select(
            "user_id",
            "email",
            "user_name",
            "company",
            "signup_at",
            "activated_at",
            "is_activated",
            "days_to_activate",
            "plan",
            F.coalesce("total_events", F.lit(0)).cast("bigint").alias("total_events"),
            F.coalesce(days, F.lit(0)).cast("bigint").alias("active_days"),
            "first_event_at",
            "last_event_at",
            F.coalesce("mrr", F.lit(0)).cast(X.MONEY).alias("current_mrr"),
            (F.coalesce("active", F.lit(0)) > 0).alias("is_paying"),
            F.when(days >= HIGH_DAYS, "high")
            .when(days >= MEDIUM_DAYS, "medium")
            .when(days > 0, "low")
            .otherwise("none")
            .alias("engagement_level"),
        )
    )


def activation_funnel(users: DataFrame) -> DataFrame:
    """Signups, activations, conversions and their rates per signup day, newest first."""
    daily = (
        users.where(F.col("signup_at").isNotNull())
        .groupBy(X.day(F.col("signup_at")).alias("signup_date"))
        .agg(
            F.count(F.lit(1)).alias("signups"),
            F.count_if("is_activated").alias("activated"),
            F.count_if(F.col("plan").isNotNull()).alias("converted_to_paid"),
            F.sum(F.when(F.col("is_activated"), F.col("days_to_activate"))).alias("days"),
            F.count(F.when(F.col("is_activated"), F.col("days_to_activate"))).alias("timed"),
        )
    )
    signups, activated, paid = F.col("signups"), F.col("activated"), F.col("converted_to_paid")
    return daily.select(
        "signup_date",
        "signups",
        "activated",
        "converted_to_paid",
        X.percent(activated, signups).alias("activation_rate"),
        X.percent(paid, activated).alias("activation_to_paid_rate"),
        X.percent(paid, signups).alias("signup_to_paid_rate"),
        X.rounded_ratio(F.col("days"), F.col("timed"), 1).alias("avg_days_to_activate"),
    ).orderBy(F.col("signup_date").desc())


def revenue_attribution(
    users: DataFrame, customers: DataFrame, subscriptions: DataFrame, as_of: dt.date, split_hot_keys: bool = False
) -> DataFrame:
    """One row per user, payment customer with the same email, and subscription.

    Emails match without regard to case and need not be unique, so rows may fan
    out. Users without a subscription do not appear, hence inner joins. Customers
    with very many subscriptions, and emails with very many customers, are split by
    the adaptive skew join, or with ``split_hot_keys`` by salts, also where that is off.
    """
    if split_hot_keys:
        return _attributed(_split_joins(users, customers, subscriptions), as_of)
    u, c, s = users.alias("u"), customers.alias("c"), subscriptions.alias("s")
    joined = u.join(c, F.lower("u.email") == F.lower("c.email")).join(
        s, F.col("c.stripe_customer_id") == F.col("s.stripe_customer_id")
    )
    return _attributed(joined, as_of)


def _split_joins(users: DataFrame, customers: DataFrame, subscriptions: DataFrame) -> DataFrame:
    """The same joins, with hot keys of customers' emails and of subscriptions' customers split."""
    as_struct = lambda df, name: df.select(F.struct(*df.columns).alias(name))
    known = join_skewed(
        as_struct(customers, "c"), as_struct(users, "u"), F.lower("c.email"), F.lower("u.email"), F.col("c.stripe_customer_id")
    )
    return join_skewed(
        as_struct(subscriptions, "s"), known, F.col("s.stripe_customer_id"), F.col("c.stripe_customer_id"), F.col("s.stripe_subscription_id")
    )


def _attributed(joined: DataFrame, as_of: dt.date) -> DataFrame:
    until = F.coalesce(F.col("s.canceled_at"), X.timestamp(X.as_date(as_of)))
    return (
        joined
        .where(F.col("s.stripe_subscription_id").isNotNull())
        .select(
            "u.user_id",
            "u.email",
            "u.user_name",
            "u.company",
            "c.stripe_customer_id",
            "s.stripe_subscription_id",
            "s.plan_id",
            "s.mrr",
            "s.status",
            F.col("s.created_at").alias("subscription_start_date"),
            F.col("s.canceled_at").alias("subscription_end_date"),
            X.whole_days(until, F.col("s.created_at")).alias("subscription_days"),
            "u.signup_at",
            X.whole_days(F.col("s.created_at"), F.col("u.signup_at")).alias("days_to_subscribe"),
        )
    )

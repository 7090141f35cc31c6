"""Typed, renamed views of the sources. One projection each, no shuffle.

Each is told once, as SQL expressions, which serve lazy frames and catalog views alike.
"""

from __future__ import annotations

from pyspark.sql import DataFrame

from ledgerlight.functions import exprs as X

# The source of each view, and its columns
SOURCES = {
    "stg_users": "users",
    "stg_subscriptions": "subscriptions",
    "stg_events": "events",
    "stg_stripe_customers": "stripe.customers",
    "stg_stripe_subscriptions": "stripe.subscriptions",
}
COLUMNS = {
    "stg_users": {
        "user_id": "id",
        "email": "email",
        "user_name": "name",
        "company": "company",
        "signup_at": "created_at",
        "activated_at": "activated_at",
        "plan": "plan",
        "is_activated": "activated_at IS NOT NULL",
        "days_to_activate": X.whole_days_sql("activated_at", "created_at"),
    },
    "stg_subscriptions": {
        "subscription_id": "id",
        "user_id": "user_id",
        "stripe_subscription_id": "stripe_subscription_id",
        "plan": "plan",
        "status": "status",
        "mrr": X.units_sql("mrr_cents"),
        "started_at": "started_at",
        "canceled_at": "canceled_at",
        "created_at": "created_at",
        "is_active": X.is_active_sql("status"),
    },
    "stg_events": {
        "event_id": "id",
        "user_id": "user_id",
        "event_name": "event_name",
        "event_properties": "event_properties",
        "event_at": "created_at",
    },
    "stg_stripe_customers": {
        "stripe_customer_id": "id",
        "email": "email",
        "customer_name": "name",
        "created_at": X.from_epoch_sql("created"),
        "currency": "currency",
        "company": "company",
        "industry": "industry",
    },
    "stg_stripe_subscriptions": {
        "stripe_subscription_id": "id",
        "stripe_customer_id": "customer_id",
        "status": "status",
        "plan_id": "plan_id",
        "mrr": X.units_sql("plan_amount"),
        "plan_currency": "plan_currency",
        "plan_interval": "plan_interval",
        "created_at": X.from_epoch_sql("created"),
        "canceled_at": X.from_epoch_sql("canceled_at"),
        "is_active": X.is_active_sql("status"),
    },
}


def _columns(view: str) -> list[str]:
    return [f"{sql} AS {name}" for name, sql in COLUMNS[view].items()]


def view_sql(view: str, relation: str) -> str:
    """The view over a table or view of the catalog, as a query."""
    return f"SELECT {', '.join(_columns(view))} FROM {relation}"


def stg_users(users: DataFrame) -> DataFrame:
    return users.selectExpr(*_columns("stg_users"))


def stg_subscriptions(subscriptions: DataFrame) -> DataFrame:
    return subscriptions.selectExpr(*_columns("stg_subscriptions"))


def stg_events(events: DataFrame) -> DataFrame:
    return events.selectExpr(*_columns("stg_events"))


def stg_stripe_customers(customers: DataFrame) -> DataFrame:
    return customers.selectExpr(*_columns("stg_stripe_customers"))


def stg_stripe_subscriptions(subscriptions: DataFrame) -> DataFrame:
    return subscriptions.selectExpr(*_columns("stg_stripe_subscriptions"))

"""Declared table layouts, as Spark DDL. Nothing is ever inferred.

The first four tables belong to the product database, the ``stripe.*`` tables
to the payment provider. Provider times are epoch seconds.
"""

from __future__ import annotations

USERS = """
    id BIGINT, email STRING, name STRING, company STRING,
    created_at TIMESTAMP_NTZ, activated_at TIMESTAMP_NTZ, plan STRING
"""

SUBSCRIPTIONS = """
    id BIGINT, user_id BIGINT, stripe_subscription_id STRING, plan STRING,
    status STRING, mrr_cents INT, started_at TIMESTAMP_NTZ,
    canceled_at TIMESTAMP_NTZ, created_at TIMESTAMP_NTZ
"""

EVENTS = """
    id BIGINT, user_id BIGINT, event_name STRING, event_properties STRING,
    created_at TIMESTAMP_NTZ
"""

STRIPE_CHARGES = """
    id STRING, customer_id STRING, amount_cents INT, status STRING,
    created_at TIMESTAMP_NTZ
"""

PAYMENT_CUSTOMERS = """
    id STRING, email STRING, name STRING, created BIGINT, currency STRING,
    company STRING, industry STRING, synced_at TIMESTAMP_NTZ
"""

PAYMENT_SUBSCRIPTIONS = """
    id STRING, customer_id STRING, status STRING, plan_id STRING,
    plan_amount INT, plan_currency STRING, plan_interval STRING,
    created BIGINT, canceled_at BIGINT, synced_at TIMESTAMP_NTZ
"""

PAYMENT_CHARGES = """
    id STRING, customer_id STRING, amount INT, currency STRING, status STRING,
    paid BOOLEAN, created BIGINT, subscription_id STRING,
    synced_at TIMESTAMP_NTZ
"""

PAYMENT_INVOICES = """
    id STRING, customer_id STRING, subscription_id STRING, amount_due INT,
    amount_paid INT, status STRING, created BIGINT, period_start BIGINT,
    period_end BIGINT, synced_at TIMESTAMP_NTZ
"""

TABLES = {
    "users": USERS,
    "subscriptions": SUBSCRIPTIONS,
    "events": EVENTS,
    "stripe_charges": STRIPE_CHARGES,
    "stripe.customers": PAYMENT_CUSTOMERS,
    "stripe.subscriptions": PAYMENT_SUBSCRIPTIONS,
    "stripe.charges": PAYMENT_CHARGES,
    "stripe.invoices": PAYMENT_INVOICES,
}

# One record of each provider list, as it stands inside a page's ``data`` array.
RECORDS = {
    "customers": """
        id: STRING, object: STRING, email: STRING, name: STRING,
        created: BIGINT, currency: STRING, delinquent: BOOLEAN,
        metadata: STRUCT<company: STRING, industry: STRING>
    """,
    "subscriptions": """
        id: STRING, object: STRING, customer: STRING, status: STRING,
        plan: STRUCT<id: STRING, object: STRING, amount: INT, currency: STRING,
                     interval: STRING, product: STRING>,
        current_period_start: BIGINT, current_period_end: BIGINT,
        created: BIGINT, canceled_at: BIGINT,
        metadata: STRUCT<plan_name: STRING>
    """,
    "charges": """
        id: STRING, object: STRING, amount: INT, currency: STRING,
        customer: STRING, status: STRING, paid: BOOLEAN, created: BIGINT,
        metadata: STRUCT<subscription_id: STRING, plan: STRING>
    """,
    "invoices": """
        id: STRING, object: STRING, customer: STRING, subscription: STRING,
        amount_due: INT, amount_paid: INT, status: STRING, created: BIGINT,
        currency: STRING, period_start: BIGINT, period_end: BIGINT
    """,
}


def envelope(table: str) -> str:
    """DDL of one list page of ``table`` (customers, subscriptions, ...)."""
    record = RECORDS[table]
    return f"object STRING, data ARRAY<STRUCT<{record}>>, has_more BOOLEAN, url STRING"

"""Charges and invoices implied by subscriptions: one per started 30-day period.

A subscription becomes dozens of rows. ``partitions`` spreads the subscriptions
over that many tasks first: shuffling them is far cheaper than having each input
split grow many times over inside one task.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerlight.functions import exprs as X
from ledgerlight.operators.schedule import PERIOD_DAYS, PERIOD_SECONDS, expand_periods


def _spread(subscriptions: DataFrame, partitions: int | None) -> DataFrame:
    return subscriptions if partitions is None else subscriptions.repartition(partitions, "id")


def _payment_periods(subscriptions: DataFrame, as_of: dt.date, partitions: int | None) -> DataFrame:
    billed = subscriptions.select("id", "customer_id", "plan_amount", "plan_currency", "created", "canceled_at")
    # an end of 0 counts as "not canceled", like NULL
    end = F.coalesce(F.nullif(F.col("canceled_at"), F.lit(0)), F.lit(X.epoch_seconds(as_of)))
    step = F.lit(PERIOD_SECONDS).cast("bigint")
    return expand_periods(
        _spread(billed, partitions), F.col("created"), end.cast("bigint"), step, F.lit(1)
    )


def invoice_schedule(subscriptions: DataFrame, as_of: dt.date, partitions: int | None = None) -> DataFrame:
    """Invoices of provider subscriptions up to their end, or ``as_of`` while running."""
    return invoices_of(_payment_periods(subscriptions, as_of, partitions))


def invoices_of(periods: DataFrame) -> DataFrame:
    """Invoices of periods: provider subscriptions with ``period_no`` and ``period_at``."""
    return periods.select(
        X.hashed_id("in_", F.col("id"), F.col("period_no")).alias("id"),
        "customer_id",
        F.col("id").alias("subscription_id"),
        F.col("plan_amount").alias("amount_due"),
        F.col("plan_amount").alias("amount_paid"),
        F.lit("paid").alias("status"),
        F.col("period_at").alias("created"),
        F.col("period_at").alias("period_start"),
        (F.col("period_at") + PERIOD_SECONDS).alias("period_end"),
    )


def charge_schedule(
    subscriptions: DataFrame,
    as_of: dt.date,
    partitions: int | None = None,
    status: Column | None = None,
) -> DataFrame:
    """Charges on the same schedule. ``status`` may depend on the subscription's
    columns and ``period_no``; a charge is paid when it succeeded."""
    outcome = F.lit("succeeded") if status is None else status
    return _payment_periods(subscriptions, as_of, partitions).select(
        X.hashed_id("ch_", F.col("id"), F.col("period_no")).alias("id"),
        "customer_id",
        F.col("plan_amount").alias("amount"),
        F.col("plan_currency").alias("currency"),
        outcome.alias("status"),
        (outcome == "succeeded").alias("paid"),
        F.col("period_at").alias("created"),
        F.col("id").alias("subscription_id"),
    )


def operational_charges(subscriptions: DataFrame, as_of: dt.date, partitions: int | None = None) -> DataFrame:
    """Charges of the product database's own subscriptions.

    Ids are derived from the subscription and the period number, set apart by a
    dash because numeric ids vary in length.
    """
    billed = subscriptions.select("id", "user_id", "started_at", "canceled_at", "mrr_cents")
    periods = expand_periods(
        _spread(billed, partitions),
        F.col("started_at"),
        F.coalesce("canceled_at", X.timestamp(as_of)),
        F.expr(f"INTERVAL '{PERIOD_DAYS}' DAY"),
        F.expr("INTERVAL '0.000001' SECOND"),
    )
    return periods.select(
        X.hashed_id("ch_", F.col("id"), F.lit("-"), F.col("period_no")).alias("id"),
        X.hashed_id("cus_", F.col("user_id")).alias("customer_id"),
        F.col("mrr_cents").alias("amount_cents"),
        F.lit("succeeded").alias("status"),
        F.col("period_at").alias("created_at"),
    )

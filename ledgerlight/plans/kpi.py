"""Headline figures and table sizes."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerlight.functions import exprs as X
from ledgerlight.sources.tables import Sources

KPIS = [
    "total_users",
    "activated_users",
    "active_subscriptions",
    "total_events",
    "total_charges",
    "activation_rate",
    "conversion_rate",
    "current_mrr",
]


def kpi_summary(sources: Sources) -> DataFrame:
    """Users, activations, subscriptions, events, charges, rates and revenue, one row.

    Rates count distinct user ids: a first aggregation brings each id down to
    one row, so repeated ids neither count twice nor gather in one task. A rate
    whose denominator is zero is NULL (a database would raise).
    """
    per_id = (
        sources["users"]
        .groupBy("id")
        .agg(
            F.count(F.lit(1)).alias("n"),
            F.count("activated_at").alias("activated"),
            F.max(F.col("activated_at").isNotNull()).alias("is_activated"),
            F.max(F.col("plan").isNotNull()).alias("has_plan"),
        )
    )
    known = F.col("id").isNotNull()
    users = per_id.agg(
        F.coalesce(F.sum("n"), F.lit(0)).alias("total_users"),
        F.coalesce(F.sum("activated"), F.lit(0)).alias("activated_users"),
        F.count_if(known & F.col("is_activated")).alias("activated_ids"),
        F.count_if(known & F.col("has_plan")).alias("paying_ids"),
    )
    active = F.col("status") == "active"
    subscriptions = sources["subscriptions"].agg(
        F.count_if(active).alias("active_subscriptions"),
        F.sum(F.when(active, F.col("mrr_cents"))).alias("cents"),
    )
    events = sources["events"].agg(F.count(F.lit(1)).alias("total_events"))
    charges = sources["stripe_charges"].agg(F.count(F.lit(1)).alias("total_charges"))

    # one row each: put side by side by a union, so nothing has to be joined
    rows = reduce(
        lambda a, b: a.unionByName(b, allowMissingColumns=True), [users, subscriptions, events, charges]
    )
    merged = rows.agg(*[F.max(c).alias(c) for c in rows.columns])

    def rate(part: str, whole: str):
        return F.col(part).cast("double") / F.nullif(F.col(whole).cast("double"), F.lit(0.0)) * 100

    return merged.select(
        "*",
        rate("activated_ids", "total_users").alias("activation_rate"),
        rate("paying_ids", "activated_ids").alias("conversion_rate"),
        X.units(F.col("cents"), X.MONEY_SUM).alias("current_mrr"),
    ).select(*KPIS)


def table_counts(sources: Sources) -> DataFrame:
    """Row count of every given table."""
    counts = [
        df.agg(F.count(F.lit(1)).alias("row_count")).select(F.lit(name).alias("table_name"), "row_count")
        for name, df in sources.items()
    ]
    return reduce(DataFrame.unionByName, counts)

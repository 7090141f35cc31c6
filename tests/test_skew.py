"""Joins with hot keys: the same rows, over tasks of like size, without adaptive execution."""

from __future__ import annotations

from statistics import median

import pytest
from pyspark.sql import functions as F

import rows as R
from ledgerlight.operators import skew
from ledgerlight.plans import marts, staging
from test_plans import settings

PARTITIONS = 16


def customers(spark, n):
    """A third of all customers have one email, in several cases."""
    email = F.when(F.col("id") % 3 == 0, F.when(F.col("id") % 2 == 0, "Hot@x").otherwise("hot@X")).otherwise(
        F.concat(F.lit("u"), (F.col("id") % 500).cast("string"), F.lit("@x"))
    )
    return spark.range(n).select(F.concat(F.lit("cus_"), F.col("id").cast("string")).alias("id"), email.alias("email"))


def users(spark):
    made = [(i, f"U{i}@x", "2024-01-01", None, None) for i in range(500)] + [(500, "HOT@x", "2024-01-01", None, None), (501, None, "2024-01-01", None, None)]
    return R.users(spark, made).select("id", "email")


def sizes(df):
    per_task = {r["p"]: r["count"] for r in df.groupBy(F.spark_partition_id().alias("p")).count().collect()}
    return [per_task.get(p, 0) for p in range(PARTITIONS)]


def test_hot_keys_are_found_by_their_share(spark):
    found = skew.hot_keys(customers(spark, 30_000), F.lower("email"), PARTITIONS)
    assert list(found) == ["hot@x"] and 15 <= found["hot@x"] <= 25
    assert skew.hot_keys(customers(spark, 0), F.lower("email"), PARTITIONS) == {}
    even = spark.range(1000).select(F.col("id").cast("string").alias("k"))
    assert skew.hot_keys(even, F.col("k"), PARTITIONS) == {}


def test_a_hot_email_is_spread_over_tasks(spark):
    big, small = customers(spark, 60_000).toDF("cid", "cemail"), users(spark)
    with settings(spark, adaptive__enabled="false", shuffle__partitions=str(PARTITIONS), autoBroadcastJoinThreshold="-1"):
        plain = big.join(small, F.lower("cemail") == F.lower("email"))
        split = skew.join_skewed(big, small, F.lower("cemail"), F.lower("email"), F.col("cid"))
        assert max(sizes(plain)) > 4 * median(sizes(plain))
        assert max(sizes(split)) < 3 * median(sizes(split))
        assert split.columns == plain.columns
        assert split.exceptAll(plain).isEmpty() and plain.exceptAll(split).isEmpty()


@pytest.mark.parametrize("hot", [True, False])
def test_attribution_is_the_same(spark, hot):
    payers = [(f"cus_{i}", "Ann@x" if hot and i % 3 else f"p{i}@x") for i in range(60)] + [("cus_n", None)]
    subs = [(f"s{i}", "cus_1" if hot and i % 2 else f"cus_{i % 61}", "active", 100, "2024-01-02", None) for i in range(200)]
    people = [(i, e, "2024-01-01", None, None) for i, e in enumerate(["ANN@x", "ann@X", "p3@x", "P5@x", None])]
    staged = (
        staging.stg_users(R.users(spark, people)),
        staging.stg_stripe_customers(R.payment_customers(spark, payers)),
        staging.stg_stripe_subscriptions(R.payment_subscriptions(spark, subs)),
    )
    plain, split = (marts.revenue_attribution(*staged, R.AS_OF, split_hot_keys=s) for s in (False, True))
    assert split.schema == plain.schema and plain.count() > 0
    assert sorted(map(repr, split.collect())) == sorted(map(repr, plain.collect()))

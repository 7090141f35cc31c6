"""Physical plans and skew: what must, and must not, be in them."""

from __future__ import annotations

import contextlib

import pytest
from pyspark.sql import functions as F

import __spark_entry__ as driver
import rows as R
from ledgerlight.operators import upsert as U
from ledgerlight.plans import ingest, lists, marts, pipeline, quality, staging
from ledgerlight.schemas import TABLES
from ledgerlight.sources import tables

SF_DIR = "/root/testdata/sf0.001"


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


@contextlib.contextmanager
def settings(spark, **values):
    """Spark SQL settings for the block; double underscores stand for dots."""
    keys = {"spark.sql." + k.replace("__", "."): v for k, v in values.items()}
    before = {k: spark.conf.get(k, None) for k in keys}
    for k, v in keys.items():
        spark.conf.set(k, v)
    try:
        yield
    finally:
        for k, v in before.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)


@pytest.mark.parametrize("name", sorted(driver.queries()))
def test_no_query_pairs_all_rows_or_runs_python_code(spark, name):
    text = plan(driver.queries()[name](spark, SF_DIR))
    for operator in ("CartesianProduct", "BroadcastNestedLoopJoin", "Python", "InPandas"):
        assert operator not in text


def test_attribution_has_inner_joins_only(spark):
    text = plan(driver.queries()["revenue_attribution"](spark, SF_DIR))
    assert text.count("Inner") == 2 and "Outer" not in text


def test_mrr_has_no_join(spark):
    assert "Join" not in plan(driver.queries()["mrr_by_month"](spark, SF_DIR))


@pytest.mark.parametrize("name", ["list_charges", "list_invoices", "list_subscriptions", "list_customers_page"])
def test_lists_are_top_k(spark, name):
    text = plan(driver.queries()[name](spark, SF_DIR))
    assert "TakeOrderedAndProject" in text and "rangepartitioning" not in text


def test_filters_and_columns_reach_the_scan(spark, tmp_path):
    base = str(tmp_path)
    tables.write_table(R.payment_customers(spark, [("cus_1", "a@x")]), base, "stripe.customers")
    tables.write_table(R.subscriptions(spark, R.SUBSCRIPTIONS), base, "subscriptions")
    tables.write_table(R.events(spark, R.EVENTS), base, "events")
    stored = tables.parquet_sources(spark, base, ["stripe.customers", "subscriptions", "events"])
    page = lists.list_customers_page(stored["stripe.customers"], "cus_1")
    assert "EqualTo(id,cus_1)" in plan(page)
    mrr = plan(marts.mrr_by_month(staging.stg_subscriptions(stored["subscriptions"]), R.AS_OF))
    assert "IsNotNull(started_at)" in mrr and "stripe_subscription_id" not in mrr
    users = staging.stg_users(R.users(spark, R.USERS))
    subs = staging.stg_subscriptions(stored["subscriptions"])
    metrics = plan(marts.user_metrics(users, subs, staging.stg_events(stored["events"])))
    assert "ReadSchema: struct<user_id:bigint,created_at:timestamp_ntz>" in metrics


def test_user_metrics_shuffles_each_input_once_per_level(spark):
    with settings(spark, autoBroadcastJoinThreshold="-1"):
        text = plan(driver.queries()["user_metrics"](spark, SF_DIR))
    # events by (user, day) and by user, subscriptions by user, users by user:
    # the joins reuse the partitioning of the aggregates
    assert text.count("Exchange hashpartitioning") == 4


def test_small_batch_leaves_the_target_in_place(spark):
    target = spark.createDataFrame([], TABLES["stripe.charges"])
    batch = target.drop("synced_at")
    out = U.merge_by_key(target, batch, ingest.MERGES["charges"], R.ts("2024-01-01"), broadcast_batch=True)
    # only the keys that both sides have meet, to be told apart once
    assert plan(out).count("Exchange hashpartitioning") == 1
    with settings(spark, autoBroadcastJoinThreshold="-1"):
        large = U.merge_by_key(target, batch, ingest.MERGES["charges"], R.ts("2024-01-01"))
        assert plan(large).count("Exchange hashpartitioning") == 2


def test_merge_input_is_shuffled_once(spark):
    target = spark.createDataFrame([], TABLES["stripe.charges"])
    batch = U.one_row_per_key(target.drop("synced_at"), ingest.MERGES["charges"])
    with settings(spark, autoBroadcastJoinThreshold="-1"):
        out = U.merge_by_key(target, batch, ingest.MERGES["charges"], R.ts("2024-01-01"))
        assert plan(out).count("Exchange hashpartitioning") == 2  # the batch's and the target's


def test_bucketed_target_is_not_shuffled(spark):
    rows = [(f"ch_{n}", "cus", n, "usd", "failed", False, n, None, None) for n in range(100)]
    spark.sql("CREATE DATABASE IF NOT EXISTS bucketed")
    tables.save_bucketed(spark.createDataFrame(rows, TABLES["stripe.charges"]), "bucketed.charges", "id", 4)
    target = spark.table("bucketed.charges")
    batch = spark.createDataFrame(rows[50:], TABLES["stripe.charges"]).drop("synced_at")
    out = U.merge_by_key(target, batch, ingest.MERGES["charges"], R.ts("2024-01-01"))
    assert plan(out).count("Exchange hashpartitioning") == 1
    assert out.count() == 100


# --- one key holding a third of the rows -------------------------------------


def many_events(spark, n, hot_user):
    user = F.when(F.col("id") % 3 == 0, hot_user).otherwise(F.col("id") % 1000)
    return spark.range(0, n, 1, 16).select(
        "id",
        user.cast("bigint").alias("user_id"),
        F.lit("login").alias("event_name"),
        F.lit("{}").alias("event_properties"),
        (F.expr("TIMESTAMP_NTZ '2024-01-01'") + F.make_dt_interval(F.lit(0), (F.col("id") % 700).cast("int"))).alias(
            "created_at"
        ),
    )


def test_hot_user_reaches_the_reducer_as_days(spark):
    """The per-user step sees one row per user and day, however many events there are."""
    events = many_events(spark, 300_000, 5_000_000)
    users = R.users(spark, [(5_000_000, "hot@x", "2024-01-01", None, None), (1, "one@x", "2024-01-01", None, None)])
    subs = R.subscriptions(spark, [])
    out = marts.user_metrics(staging.stg_users(users), staging.stg_subscriptions(subs), staging.stg_events(events))
    result = {r.user_id: (r.total_events, r.active_days) for r in out.collect()}
    assert result[5_000_000] == (100_000, 30)
    expected = events.where("user_id = 1").selectExpr("count(1)", "count(DISTINCT date(created_at))").first()
    assert result[1] == tuple(expected)


def skewed_small_partitions(spark):
    """Settings under which these small inputs count as large and skewed."""
    return settings(
        spark,
        autoBroadcastJoinThreshold="-1",
        adaptive__autoBroadcastJoinThreshold="-1",
        adaptive__advisoryPartitionSizeInBytes="64KB",
        adaptive__skewJoin__skewedPartitionThresholdInBytes="64KB",
        adaptive__skewJoin__skewedPartitionFactor="1.5",
    )


def test_hot_email_is_split_by_the_skew_join(spark):
    """A third of the payment customers share the email of one user."""
    n = 60_000
    customers = spark.range(0, n, 1, 16).select(
        F.concat(F.lit("cus_"), "id").alias("id"),
        F.when(F.col("id") % 3 == 0, "U0@x").otherwise(F.concat(F.lit("u"), "id", F.lit("@x"))).alias("email"),
        F.lit("n").alias("name"), F.lit(1704067200).cast("bigint").alias("created"), F.lit("usd").alias("currency"),
        F.lit(None).cast("string").alias("company"), F.lit(None).cast("string").alias("industry"),
    )
    users = R.users(spark, [(k, f"u{k}@x", "2024-01-01", None, None) for k in range(1000)])
    paid = [(f"sub_{k}", f"cus_{k}", "active", 1, "2024-01-02", None) for k in range(900)]
    subs = R.payment_subscriptions(spark, paid)
    with skewed_small_partitions(spark):
        out = marts.revenue_attribution(
            staging.stg_users(users),
            staging.stg_stripe_customers(customers),
            staging.stg_stripe_subscriptions(subs),
            R.AS_OF,
        )
        found = {r.stripe_subscription_id: r.user_id for r in out.collect()}
        assert "skew=true" in plan(out)
    assert found == {f"sub_{k}": 0 if k % 3 == 0 else k for k in range(900)}


def test_hot_customer_is_split_by_the_skew_join(spark):
    n = 60_000
    subs = spark.range(0, n, 1, 16).select(
        F.concat(F.lit("sub_"), "id").alias("id"),
        F.when(F.col("id") % 3 == 0, "cus_0")
        .otherwise(F.concat(F.lit("cus_"), F.col("id") % 1000))
        .alias("customer_id"),
        F.lit("active").alias("status"), F.lit("starter").alias("plan_id"), F.lit(100).alias("plan_amount"),
        F.lit("usd").alias("plan_currency"), F.lit("month").alias("plan_interval"),
        F.lit(1704067200).cast("bigint").alias("created"), F.lit(None).cast("bigint").alias("canceled_at"),
        F.lit(None).cast("timestamp_ntz").alias("synced_at"),
    )
    customers = R.payment_customers(spark, [(f"cus_{k}", f"u{k}@x") for k in range(1000)])
    users = R.users(spark, [(k, f"U{k}@X", "2024-01-01", None, None) for k in range(1000)])
    with skewed_small_partitions(spark):
        out = marts.revenue_attribution(
            staging.stg_users(users),
            staging.stg_stripe_customers(customers),
            staging.stg_stripe_subscriptions(subs),
            R.AS_OF,
        )
        assert len(out.collect()) == n
        assert "skew=true" in plan(out)


# --- the whole pipeline ------------------------------------------------------


def test_pipeline_stores_the_marts_and_reruns_to_the_same_tables(spark, tmp_path):
    ops, pay, out = str(tmp_path / "ops"), str(tmp_path / "pay"), str(tmp_path / "out")
    sources = {
        "users": R.users(spark, R.USERS),
        "subscriptions": R.subscriptions(spark, R.SUBSCRIPTIONS),
        "events": R.events(spark, R.EVENTS),
        "stripe_charges": tables.empty(spark, "stripe_charges"),
    }
    for name, df in sources.items():
        tables.write_table(df, ops, name)
    customers = R.payment_customers(spark, [("cus_a", "ann@x.COM")])
    tables.write_table(customers, pay, "stripe.customers")
    paid = R.payment_subscriptions(spark, [("sub_1", "cus_a", "active", 2900, "2024-01-02", None)])
    tables.write_table(paid, pay, "stripe.subscriptions")
    for name in ("stripe.charges", "stripe.invoices"):
        tables.write_table(tables.empty(spark, name), pay, name)

    def contents(frames):
        return {name: sorted(map(repr, df.collect())) for name, df in frames.items()}

    stored = pipeline.stored_sources(spark, ops, pay)
    first = contents(pipeline.run(spark, stored, out, R.AS_OF))
    assert {name: len(r) for name, r in first.items()} == {
        "fct_mrr_by_month": 3,
        "fct_user_metrics": 4,
        "fct_activation_funnel": 3,
        "fct_revenue_attribution": 1,
        "kpi_summary": 1,
        "data_quality": len(first["data_quality"]),
    }
    # only the users table is there
    few = pipeline.stored_sources(spark, ops, "nowhere", ["fct_activation_funnel"])
    assert list(few) == ["users"]
    few = pipeline.run(spark, few, str(tmp_path / "few"), R.AS_OF, only=["fct_activation_funnel"])
    assert contents(few) == {"fct_activation_funnel": first["fct_activation_funnel"]}
    some = ["fct_user_metrics", "kpi_summary"]
    again = contents(pipeline.run(spark, stored, out, R.AS_OF, only=some))
    assert again == {name: first[name] for name in some}
    with pytest.raises(ValueError):
        pipeline.run(spark, stored, out, R.AS_OF, only=["fct_nothing"])
    assert spark.sql("SELECT count(*) FROM stg_users WHERE is_activated").first()[0] == 2
    assert spark.read.parquet(f"{out}/data_quality").count() > 0


def test_quality_report_reads_each_table_once(spark, tmp_path):
    base = str(tmp_path)
    for name in TABLES:
        tables.write_table(tables.empty(spark, name), base, name)
    with settings(spark, autoBroadcastJoinThreshold="-1"):
        text = plan(quality.data_quality(tables.parquet_sources(spark, base)))
    assert text.count("FileScan parquet") == len(TABLES)
    # keys, references and broken checks meet in one exchange; the other counts what is left by constraint
    assert text.count("hashpartitioning(tag") == 3 and text.count("hashpartitioning(tag#") >= 2
    assert text.count(", value#") > 0 and "LeftAnti" not in text

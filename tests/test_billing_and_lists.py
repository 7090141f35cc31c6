"""Billing periods, list queries, KPIs and checks on hand-made rows."""

from __future__ import annotations

import datetime as dt
import hashlib
import json
from decimal import Decimal as D

import pytest
from pyspark.sql import functions as F

import rows as R
from ledgerlight.functions import exprs as X
from ledgerlight.operators import paging
from ledgerlight.operators import quality as Q
from ledgerlight.plans import billing, ingest, kpi, lists, quality
from ledgerlight.schemas import TABLES
from ledgerlight.sources import landed, tables


def rows(df):
    return [tuple(r) for r in df.collect()]


def digest(text):
    return hashlib.md5(text.encode()).hexdigest()[:24]


SPANS = [
    ("sub_a", "cus_1", "canceled", 2900, "2024-01-01", "2024-03-01"),  # 60 days: two periods
    ("sub_b", "cus_1", "canceled", 2900, "2024-01-01", "2024-01-01"),  # nothing
    ("sub_c", "cus_2", "canceled", 2900, "2024-01-02", "2024-01-01"),  # reversed: nothing
    ("sub_d", "cus_2", "active", 9900, "2024-05-17", None),  # one before the as-of day
    ("sub_e", "cus_2", "active", 9900, "2024-05-16", None),  # 30 days exactly: one
    ("sub_f", "cus_2", "active", 9900, None, None),
    ("sub_g", "cus_2", "active", 9900, "2024-06-14", "1970-01-01"),  # end 0 is no end
]


@pytest.mark.parametrize("partitions", [None, 3])
def test_invoice_schedule(spark, partitions):
    subs = R.payment_subscriptions(spark, SPANS)
    out = billing.invoice_schedule(subs, R.AS_OF, partitions)
    starts = {}
    for i, _, sub, due, paid, status, created, start, end in rows(out):
        starts.setdefault(sub, []).append((i, created))
        assert due == paid and status == "paid" and start == created and end - start == 30 * 86400
    assert {k: len(v) for k, v in starts.items()} == {"sub_a": 2, "sub_d": 1, "sub_e": 1, "sub_g": 1}
    assert sorted(starts["sub_a"], key=lambda x: x[1]) == [
        ("in_" + digest("sub_a0"), R.epoch("2024-01-01")),
        ("in_" + digest("sub_a1"), R.epoch("2024-01-31")),
    ]


def test_charge_status_may_depend_on_the_period(spark):
    subs = R.payment_subscriptions(spark, SPANS[:1])
    status = F.when(F.col("period_no") == 1, "failed").otherwise("succeeded")
    out = billing.charge_schedule(subs, R.AS_OF, status=status).orderBy("created")
    assert rows(out.select("id", "status", "paid", "amount", "currency")) == [
        ("ch_" + digest("sub_a0"), "succeeded", True, 2900, "usd"),
        ("ch_" + digest("sub_a1"), "failed", False, 2900, "usd"),
    ]


def test_operational_charges_have_distinct_ids(spark):
    # 1 and period 11 must not meet 11 and period 1
    subs = R.subscriptions(
        spark,
        [(1, 7, "starter", "active", 2900, "2023-01-01", None), (11, 7, "starter", "active", 2900, "2023-01-01", None),
         (12, 7, "starter", "active", 2900, None, None)],
    )
    out = billing.operational_charges(subs, R.AS_OF)
    assert out.count() == out.select("id").distinct().count() == 2 * 18
    assert rows(out.select(F.max("created_at"), F.max("status"))) == [(R.ts("2024-05-25"), "succeeded")]


def test_periods_keep_microseconds(spark):
    subs = R.subscriptions(
        spark, [(1, 7, "starter", "active", 2900, "2024-01-01 00:00:00.000001", "2024-01-31 00:00:00.000002")]
    )
    assert billing.operational_charges(subs, R.AS_OF).count() == 2


@pytest.fixture(scope="module")
def customers(spark):
    return R.payment_customers(spark, [(f"cus_{n:02d}", f"u{n}@x") for n in range(10)]).repartition(4)


def ids(df):
    return [r.id for r in df.collect()]


def test_customers_page(spark, customers):
    first = lists.list_customers_page(customers, limit=4)
    assert ids(first) == ["cus_00", "cus_01", "cus_02", "cus_03"]
    assert {r.has_more for r in first.collect()} == {True}
    second = lists.list_customers_page(customers, "cus_03", 4)
    assert ids(second) == ["cus_04", "cus_05", "cus_06", "cus_07"]
    last = lists.list_customers_page(customers, "cus_07", 4)
    assert [(r.id, r.has_more) for r in last.collect()] == [("cus_08", False), ("cus_09", False)]
    exact = lists.list_customers_page(customers, "cus_05", 4)
    assert {r.has_more for r in exact.collect()} == {False}
    assert ids(lists.list_customers_page(customers, "cus_09", 4)) == []
    for unknown in ("cus_055", "zzz", None, ""):
        assert ids(lists.list_customers_page(customers, unknown, 4)) == ids(first)


def test_pages_walk_the_whole_table(spark, customers):
    seen, cursor = [], None
    while True:
        page = lists.list_customers_page(customers, cursor, 3).collect()
        seen += [r.id for r in page]
        if not page[-1].has_more:
            break
        cursor = page[-1].id
    assert seen == [f"cus_{n:02d}" for n in range(10)]


def test_lists_filter_and_order(spark):
    charges = spark.createDataFrame(
        [(i, c, 1, "usd", "succeeded", True, t, None, None)
         for i, c, t in [("ch_b", "x", 5), ("ch_a", "x", 5), ("ch_c", "y", 9), ("ch_d", "x", 1)]],
        TABLES["stripe.charges"],
    )
    assert ids(lists.list_charges(charges)) == ["ch_c", "ch_a", "ch_b", "ch_d"]
    assert ids(lists.list_charges(charges, "x", 2)) == ["ch_a", "ch_b"]
    assert ids(lists.list_charges(charges, "")) == ids(lists.list_charges(charges))
    subs = R.payment_subscriptions(spark, SPANS)
    assert ids(lists.list_subscriptions(subs, "active", 2)) == ["sub_d", "sub_e"]
    assert len(ids(lists.list_subscriptions(subs))) == len(SPANS)


def test_envelope_can_be_landed_and_read_back(spark, customers, tmp_path):
    page = lists.list_customers_page(customers, "cus_03", 4)
    records = page.select(
        "id", "email", "name", "created", "currency", F.struct("company", "industry").alias("metadata"), "has_more"
    )
    out = paging.envelope(records, "/v1/customers", [F.col("id")])
    body = json.loads(out.toJSON().first())
    assert (body["object"], body["has_more"], body["url"]) == ("list", True, "/v1/customers")
    assert [d["id"] for d in body["data"]] == ["cus_04", "cus_05", "cus_06", "cus_07"]
    out.write.json(str(tmp_path / "customers"))
    back = landed.records(landed.read_pages(spark, str(tmp_path / "customers"), "customers", page_per_line=True))
    assert ids(ingest.flatten(back, "customers")) == ["cus_04", "cus_05", "cus_06", "cus_07"]
    empty = paging.envelope(page.where("false"), "/v1/customers", [F.col("id")])
    assert rows(empty.select(F.size("data"), "has_more")) == [(0, False)]


def operational(spark):
    return {
        "users": R.users(spark, R.USERS),
        "subscriptions": R.subscriptions(spark, R.SUBSCRIPTIONS),
        "events": R.events(spark, R.EVENTS),
        "stripe_charges": tables.empty(spark, "stripe_charges"),
    }


def test_kpi_summary(spark):
    out = kpi.kpi_summary(operational(spark)).first()
    assert out.asDict() == {
        "total_users": 4, "activated_users": 2, "active_subscriptions": 2, "total_events": 26, "total_charges": 0,
        "activation_rate": 50.0, "conversion_rate": 150.0, "current_mrr": D("328.00"),
    }


def test_kpis_of_empty_tables(spark):
    out = kpi.kpi_summary({t: tables.empty(spark, t) for t in TABLES}).first()
    assert (out.total_users, out.activation_rate, out.conversion_rate, out.current_mrr) == (0, None, None, None)


def test_table_counts(spark):
    counts = dict(rows(kpi.table_counts(operational(spark))))
    assert counts == {"users": 4, "subscriptions": 5, "events": 26, "stripe_charges": 0}


def violations(df):
    return {(r.check, r.table, r.column): r.violations for r in df.collect()}


def test_quality_of_good_tables(spark):
    found = violations(quality.data_quality(operational(spark)))
    assert {k: v for k, v in found.items() if v} == {("not_empty", "stripe_charges", "*"): 1}
    assert len(found) == 4 * 3 + 2 + 1 + (4 + 3 + 1 + 3) + 2


def test_quality_finds_violations(spark):
    sources = {
        "users": R.users(
            spark,
            [*R.USERS, (1, "ann@x.com", None, None, None), (None, "bob@x.com", "2024-01-01", None, None),
             (7, None, "2024-01-01", None, None), (8, None, "2024-01-01", None, "p" * 51)],
        ),
        "events": R.events(spark, [*R.EVENTS, (1, 99, None), (2, 99, None), (3, None, None)]),
    }
    found = violations(quality.data_quality(sources))
    assert {k: v for k, v in found.items() if v} == {
        ("unique", "users", "id"): 1,
        ("not_null", "users", "id"): 1,
        ("unique", "users", "email"): 1,  # bob; Ann differs by case
        ("not_null", "users", "email"): 2,
        ("not_null", "users", "created_at"): 1,
        ("max_length", "users", "plan"): 1,
        ("foreign_key", "events", "user_id"): 2,
    }


def test_expressions(spark):
    df = spark.sql(
        "SELECT TIMESTAMP_NTZ '2024-02-29 23:30:00' AS a, TIMESTAMP_NTZ '2024-02-28 00:29:00' AS b, 5L AS n, 8L AS d"
    )
    out = df.select(
        X.month(F.col("a")),
        X.whole_days(F.col("a"), F.col("b")),
        X.whole_days(F.col("b"), F.col("a")),
        X.percent(F.col("n"), F.col("d")),
        X.rounded_ratio(-F.col("n"), F.col("d"), 2),
        X.percent(F.col("n"), F.lit(0)),
        X.from_epoch(X.to_epoch(F.col("a"))) == F.col("a"),
        X.units(F.lit(2147483647)),
    )
    assert rows(out) == [
        (dt.date(2024, 2, 1), 1, -1, D("62.50"), D("-0.63"), None, True, D("21474836.47"))
    ]


def test_sources(spark, tmp_path):
    sources = operational(spark)
    base = str(tmp_path / "tables")
    for name, df in sources.items():
        tables.write_table(df, base, name)
    stored = tables.parquet_sources(spark, base, sources)
    for name, df in sources.items():
        assert stored[name].dtypes == df.dtypes
        assert sorted(map(repr, stored[name].collect())) == sorted(map(repr, df.collect()))
    tables.write_table(sources["users"], base, "users", mode="append")
    assert stored["users"].sparkSession.read.parquet(f"{base}/users").count() == 8
    tables.write_table(sources["users"], base, "users")
    assert tables.read_table(spark, base, "users").count() == 4


def test_events_by_day_skip_other_days(spark, tmp_path):
    base = str(tmp_path / "by_day")
    tables.write_events_by_day(R.events(spark, [*R.EVENTS, (999, 1, None)]), base)
    days = [p.name for p in (tmp_path / "by_day" / "events").glob("event_date=*")]
    assert len(days) == 21
    back = tables.read_table(spark, base, "events")
    assert back.columns == [c for c in R.events(spark, []).columns]
    assert back.count() == len(R.EVENTS) + 1
    day = R.events(spark, R.EVENTS).selectExpr("min(date(created_at)) AS d").first()["d"]
    some = tables.read_events_by_day(spark, base, day, day)
    assert 0 < some.count() < len(R.EVENTS) and some.columns == back.columns
    assert "PartitionFilters: [isnotnull(event_date" in some._jdf.queryExecution().toString()


def test_catalog_sources_and_existence(spark):
    spark.sql("CREATE DATABASE IF NOT EXISTS ops")
    R.users(spark, R.USERS).write.mode("overwrite").saveAsTable("ops.users")
    assert tables.exists(spark, "ops.users") and not tables.exists(spark, "ops.nothing")
    found = tables.catalog_sources(spark, {"": "ops"}, ["users"])
    assert found["users"].count() == 4


def test_jdbc_options():
    assert tables.jdbc_options("jdbc:x", "users")["dbtable"] == "users"
    split = tables.jdbc_options("jdbc:x", "stripe.charges", (0, 100), 8)
    assert (split["partitionColumn"], split["numPartitions"], split["upperBound"]) == ("created", "8", "100")
    with pytest.raises(ValueError):
        tables.jdbc_options("jdbc:x", "users", partitions=4)


def test_broken_chains_of_pages_are_reported(spark):
    made = [
        ("in/page_9.json", [("a",), ("b",)], True), ("in/page_10.json", [("b",), ("c",)], False), ("in/page_12.json", [("d",)], True),
        ("in/page_12.json", [("e",)], None), ("in/page_13.json", None, False), ("noname", [("a",)], False),
    ]
    pages = spark.createDataFrame(made, "page string, data array<struct<id: string>>, has_more boolean")
    found = {r["check"]: r["violations"] for r in Q.check_chain(pages, "t").collect()}
    assert found == {"page_gap": 1, "page_repeated": 1, "early_end": 2, "page_overlap": 1}
    whole = pages.where("page IN ('in/page_9.json')")
    assert {r["violations"] for r in Q.check_chain(whole, "t").collect()} == {0}
    assert {r["violations"] for r in Q.check_chain(pages.where("false"), "t").collect()} == {0}

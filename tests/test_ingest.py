"""Landed pages: reading, flattening, required fields, and syncing them into tables."""

from __future__ import annotations

import datetime as dt
import json
import os

import pytest

from ledgerlight.plans import ingest, pipeline
from ledgerlight.sources import landed
from ledgerlight.sources.tables import empty, read_table
from ledgerlight.streaming import payments

DAY1, DAY2 = dt.datetime(2024, 1, 1), dt.datetime(2024, 2, 1)


def customer(i, email="a@x", **more):
    return {"id": i, "object": "customer", "email": email, "name": f"N {i}", "created": 1, "currency": "usd",
            "delinquent": False, "metadata": {"company": "Co", "industry": "SaaS"}} | more


def subscription(i, **more):
    plan = {"id": "starter", "object": "plan", "amount": 2900, "currency": "usd", "interval": "month"}
    return {"id": i, "object": "subscription", "customer": "cus_1", "status": "active", "plan": plan,
            "created": 1} | more


def charge(i, **more):
    return {"id": i, "amount": 2900, "currency": "usd", "customer": "cus_1", "status": "succeeded", "paid": True,
            "created": 1, "metadata": {"subscription_id": "sub_1"}} | more


def invoice(i, **more):
    return {"id": i, "customer": "cus_1", "subscription": "sub_1", "amount_due": 2900, "amount_paid": 2900,
            "status": "paid", "created": 1, "period_start": 1, "period_end": 2} | more


def page(records):
    return {"object": "list", "data": records, "has_more": False, "url": "/v1/x"}


def land(folder, table, **pages):
    target = folder / table
    target.mkdir(parents=True, exist_ok=True)
    for name, records in pages.items():
        (target / f"{name}.json").write_text(json.dumps(page(records), indent=1))


def rows(df):
    return sorted(tuple(r) for r in df.collect())


def read(spark, folder, table, **options):
    return landed.records(landed.read_pages(spark, str(folder / table), table, **options))


def test_flatten_customers(spark, tmp_path):
    bare = customer("cus_2")
    del bare["metadata"]
    land(tmp_path, "customers", p1=[customer("cus_1"), bare], p2=[customer("cus_3", metadata={})], p3=[])
    out = ingest.flatten(read(spark, tmp_path, "customers"), "customers")
    assert rows(out) == [
        ("cus_1", "a@x", "N cus_1", 1, "usd", "Co", "SaaS"),
        ("cus_2", "a@x", "N cus_2", 1, "usd", None, None),
        ("cus_3", "a@x", "N cus_3", 1, "usd", None, None),
    ]


def test_flatten_subscriptions_and_rejects(spark, tmp_path):
    no_plan = subscription("sub_3")
    del no_plan["plan"]
    land(tmp_path, "subscriptions", p1=[subscription("sub_1"), subscription("sub_2", canceled_at=5), no_plan])
    records = read(spark, tmp_path, "subscriptions")
    kept = ingest.flatten(records, "subscriptions", on_missing="reject")
    assert rows(kept.select("id", "plan_id", "plan_amount", "canceled_at")) == [
        ("sub_1", "starter", 2900, None),
        ("sub_2", "starter", 2900, 5),
    ]
    assert rows(ingest.rejects(records, "subscriptions").select("record.id", "missing")) == [
        ("sub_3", "plan.id, plan.amount, plan.currency, plan.interval")
    ]
    with pytest.raises(Exception, match="subscriptions record without plan.id"):
        ingest.flatten(records, "subscriptions").collect()


def test_flatten_charges_and_invoices(spark, tmp_path):
    bare = charge("ch_2")
    del bare["metadata"]
    land(tmp_path, "charges", p=[charge("ch_1"), bare])
    land(tmp_path, "invoices", p=[invoice("in_1")])
    assert rows(ingest.flatten(read(spark, tmp_path, "charges"), "charges")) == [
        ("ch_1", "cus_1", 2900, "usd", "succeeded", True, 1, "sub_1"),
        ("ch_2", "cus_1", 2900, "usd", "succeeded", True, 1, None),
    ]
    assert rows(ingest.flatten(read(spark, tmp_path, "invoices"), "invoices")) == [
        ("in_1", "cus_1", "sub_1", 2900, 2900, "paid", 1, 1, 2)
    ]


def test_pages_one_per_line(spark, tmp_path):
    folder = tmp_path / "customers"
    folder.mkdir()
    lines = [json.dumps(page([customer(f"cus_{n}")])) for n in range(3)]
    (folder / "all.json").write_text("\n".join(lines))
    out = ingest.flatten(read(spark, tmp_path, "customers", page_per_line=True), "customers")
    assert [r[0] for r in rows(out)] == ["cus_0", "cus_1", "cus_2"]


def test_broken_page_stops_the_job(spark, tmp_path):
    land(tmp_path, "customers", p1=[customer("cus_1")])
    (tmp_path / "customers" / "p2.json").write_text('{"object": "list", "data": [{"id": ')
    with pytest.raises(Exception, match="(?i)malformed"):
        read(spark, tmp_path, "customers").collect()


def test_all_pages_are_ingested(spark, tmp_path):
    pages = {f"p{n:02d}": [customer(f"cus_{n}_{k}") for k in range(100)] for n in range(15)}
    land(tmp_path, "customers", **pages)
    assert ingest.flatten(read(spark, tmp_path, "customers"), "customers").count() == 1500


def land_day(folder, day):
    land(folder, "customers", p1=[customer("cus_1", f"{day}@x"), customer(f"cus_{day}")])
    land(folder, "subscriptions", p1=[subscription("sub_1", status=day)])
    land(folder, "charges", p1=[charge("ch_1", status=day, paid=day == "one")])
    land(folder, "invoices", p1=[invoice("in_1", status=day)])


def check_tables(read_one):
    assert rows(read_one("customers").select("id", "email", "synced_at")) == [
        ("cus_1", "two@x", DAY2),
        ("cus_one", "a@x", DAY1),
        ("cus_two", "a@x", DAY2),
    ]
    assert rows(read_one("subscriptions").select("id", "status")) == [("sub_1", "two")]
    assert rows(read_one("charges").select("id", "status", "paid")) == [("ch_1", "two", True)]
    assert rows(read_one("invoices").select("id", "status", "synced_at")) == [("in_1", "two", DAY2)]


def test_sync_payments_to_directories(spark, tmp_path):
    land_day(tmp_path / "one", "one")
    land_day(tmp_path / "two", "two")
    first, second = str(tmp_path / "v1"), str(tmp_path / "v2")
    pipeline.sync_payments(spark, str(tmp_path / "one"), first, DAY1)
    for _ in range(2):  # a repeated run gives the same tables
        pipeline.sync_payments(spark, str(tmp_path / "two"), second, DAY2, previous=first)
        check_tables(lambda t: read_table(spark, second, f"stripe.{t}"))
    with pytest.raises(ValueError):
        pipeline.sync_payments(spark, str(tmp_path / "two"), second + "/", DAY2, previous=second)


def test_sync_payments_to_bucketed_tables(spark, tmp_path):
    land_day(tmp_path / "one", "one")
    land_day(tmp_path / "two", "two")
    pipeline.sync_payment_tables(spark, str(tmp_path / "one"), "pay", "r1", DAY1, 4)
    pipeline.sync_payment_tables(spark, str(tmp_path / "two"), "pay", "r2", DAY2, 4, previous_run="r1")
    check_tables(lambda t: spark.table(f"pay.{t}"))
    with pytest.raises(ValueError):
        pipeline.sync_payment_tables(spark, str(tmp_path / "two"), "pay", "r2", DAY2, 4, previous_run="r2")


def test_sync_fails_on_a_repeated_id_unless_told_to_replay(spark, tmp_path):
    land_day(tmp_path / "in", "one")
    land(tmp_path / "in", "customers", p1=[customer("cus_1", "old@x")], p2=[customer("cus_1", "new@x", currency="eur")])
    with pytest.raises(Exception, match="duplicate key"):
        pipeline.sync_payments(spark, str(tmp_path / "in"), str(tmp_path / "v1"), DAY1)
    pipeline.sync_payments(spark, str(tmp_path / "in"), str(tmp_path / "v2"), DAY1, on_duplicate="latest")
    out = read_table(spark, str(tmp_path / "v2"), "stripe.customers")
    assert rows(out.select("id", "email", "currency")) == [("cus_1", "new@x", "usd")]


def test_stream_merges_each_page_once(spark, tmp_path):
    source, snapshots, progress = tmp_path / "in", str(tmp_path / "out"), str(tmp_path / "progress")

    def run(synced_at):
        query = payments.sync_stream(
            spark, str(source), "customers", snapshots, synced_at, progress, max_files=1
        )
        query.awaitTermination(120)
        return rows(spark.table("stripe_customers").select("id", "email", "synced_at"))

    land(source, "customers", p1=[customer("cus_1"), customer("cus_2")])
    assert run(DAY1) == [("cus_1", "a@x", DAY1), ("cus_2", "a@x", DAY1)]
    land(source, "customers", p2=[customer("cus_2", "new@x")], p3=[customer("cus_3")])
    expected = [("cus_1", "a@x", DAY1), ("cus_2", "new@x", DAY2), ("cus_3", "a@x", DAY2)]
    assert run(DAY2) == expected
    assert run(dt.datetime(2024, 3, 1)) == expected  # nothing new landed


def test_stream_checkpoint_comes_from_the_session(spark):
    shared = spark.conf.get("spark.checkpoint.dir")
    assert payments.checkpoint_location(spark, "x", "out", "/given") == "/given"
    one, other = (payments.checkpoint_location(spark, "x", out) for out in ("out/", "out2"))
    assert one.startswith(f"{shared}/sync_x_") and one != other
    assert one == payments.checkpoint_location(spark, "x", "out")


@pytest.mark.parametrize("by_name", [False, True])
def test_page_numbers_are_numbers(spark, tmp_path, by_name):
    land(tmp_path / "in", "customers", page_2=[customer("cus_1", "old@x")], page_10=[customer("cus_1", "new@x")])
    for table in ("subscriptions", "charges", "invoices"):
        land(tmp_path / "in", table, p1=[])
    same = (tmp_path / "in" / "customers" / "page_2.json").stat().st_mtime
    os.utime(tmp_path / "in" / "customers" / "page_10.json", (same, same - (5 if by_name else 0)))
    os.utime(tmp_path / "in" / "customers" / "page_2.json", (same, same))
    where = str(tmp_path / f"v{by_name}")
    pipeline.sync_payments(spark, str(tmp_path / "in"), where, DAY1, on_duplicate="latest", by_name=by_name)
    assert rows(read_table(spark, where, "stripe.customers").select("email")) == [("new@x",)]
    query = payments.sync_stream(spark, str(tmp_path / "in"), "customers", str(tmp_path / "s"), DAY1, by_name=by_name)
    query.awaitTermination(120)
    assert rows(spark.table("stripe_customers").select("email")) == [("new@x",)]


def test_later_pages_win_whatever_their_name(spark, tmp_path):
    land(tmp_path, "customers", page_10=[customer("cus_1", "old@x")], page_9=[customer("cus_1", "new@x")])
    os.utime(tmp_path / "customers" / "page_10.json", (1_700_000_000, 1_700_000_000))
    pages = landed.read_pages(spark, str(tmp_path / "customers"), "customers")
    out = pipeline.merged_pages(pages, "customers", None, DAY1, on_duplicate="latest")
    assert rows(out.select("email")) == [("new@x",)]


def test_pages_without_order_cannot_be_replayed(spark, tmp_path):
    with pytest.raises(ValueError, match="no order"):
        pipeline.sync_payments(spark, "in", "out", DAY1, on_duplicate="latest", page_per_line=True)
    with pytest.raises(ValueError, match="no order"):
        payments.sync_stream(spark, "in", "customers", "out", DAY1, page_per_line=True)


def test_rejected_records_are_kept(spark, tmp_path):
    bad = customer("cus_2")
    del bad["email"]
    land(tmp_path / "in", "customers", p1=[customer("cus_1"), bad], p2=[customer("cus_3")])
    for table in ("subscriptions", "charges", "invoices"):
        land(tmp_path / "in", table, p1=[])
    out = str(tmp_path / "v1")
    counts = pipeline.sync_payments(spark, str(tmp_path / "in"), out, DAY1, on_missing="reject")
    assert counts == {"customers": 1, "subscriptions": 0, "charges": 0, "invoices": 0}
    kept = spark.read.parquet(f"{out}/rejects/customers")
    assert rows(kept.select("record.id", "missing")) == [("cus_2", "email")]
    assert read_table(spark, out, "stripe.customers").count() + kept.count() == 3
    query = payments.sync_stream(
        spark, str(tmp_path / "in"), "customers", str(tmp_path / "s"), DAY1, on_missing="reject"
    )
    query.awaitTermination(120)
    assert spark.read.parquet(str(tmp_path / "s" / "0" / "rejects" / "customers")).count() == 1
    assert spark.table("stripe_customers").count() == 2


def test_stream_goes_on_from_a_sync_and_feeds_a_build(spark, tmp_path):
    land(tmp_path / "one", "customers", p1=[customer("cus_1"), customer("cus_2")])
    for table in ("subscriptions", "charges", "invoices"):
        land(tmp_path / "one", table, p1=[])
        land(tmp_path / "two", table, p1=[])
    v1, snapshots = str(tmp_path / "v1"), str(tmp_path / "s")
    pipeline.sync_payments(spark, str(tmp_path / "one"), v1, DAY1)
    land(tmp_path / "two", "customers", p1=[customer("cus_2", "new@x")], p2=[customer("cus_3")])
    for table in pipeline.PAYMENT_LISTS:
        # uneven batches: two for customers, one for the others
        payments.sync_stream(
            spark, str(tmp_path / "two"), table, snapshots, DAY2, max_files=1, previous=v1
        ).awaitTermination(120)
    for table in pipeline.OPERATIONAL:
        empty(spark, table).write.parquet(str(tmp_path / "ops" / table))
    sources = pipeline.stored_sources(spark, str(tmp_path / "ops"), snapshots)
    found = rows(sources["stripe.customers"].select("id", "email"))
    assert found == [("cus_1", "a@x"), ("cus_2", "new@x"), ("cus_3", "a@x")]
    assert sources["stripe.charges"].count() == 0
    with pytest.raises(ValueError, match="no progress"):
        payments.sync_stream(spark, str(tmp_path / "two"), "customers", snapshots, DAY2, str(tmp_path / "fresh"))


def test_unfinished_lists_are_told(spark, tmp_path):
    folder = tmp_path / "customers"
    folder.mkdir()
    for name, more in (("page_2", True), ("page_10", False)):
        (folder / f"{name}.json").write_text(json.dumps({**page([customer(name)]), "has_more": more}))
    both = landed.read_pages(spark, str(folder), "customers", by_name=True)
    assert landed.unfinished(both).first()["unfinished"] == 0
    assert landed.unfinished(both.where("page like '%page_2.json'")).first()["unfinished"] == 1
    assert landed.unfinished(both.where("false")).first()["unfinished"] == 0

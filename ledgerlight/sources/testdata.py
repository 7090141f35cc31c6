"""The driver's star-schema test tables seen as this package's sources.

Customers become users and payment customers, orders become subscriptions, and
events stay events; every row is used. Values only the payment side knows are
derived by plain arithmetic, which ``oracle`` repeats in SQL.
"""

from __future__ import annotations

import datetime as dt
import tempfile
import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerlight.functions import exprs as X
from ledgerlight.operators.schedule import period_starts
from ledgerlight.plans import billing
from ledgerlight.schemas import TABLES
from ledgerlight.sources.tables import Sources

# The day on which the derived data is looked at
AS_OF = dt.date(2001, 12, 1)

# Between these two moments the payment tables changed (see earlier_state)
FIRST_SYNC = dt.datetime(2000, 1, 1)
SECOND_SYNC = dt.datetime(2001, 12, 1)

PRICES = {"1-URGENT": ("enterprise", 29900), "2-HIGH": ("professional", 9900), "5-LOW": ("legacy", 1900)}
DEFAULT_PRICE = ("starter", 2900)


def _read(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _days(n: Column) -> Column:
    return F.make_dt_interval(n.cast("int"))


def _hours(n: Column) -> Column:
    return F.make_dt_interval(F.lit(0), n.cast("int"))


def _by_priority(index: int) -> Column:
    chosen = None
    for priority, price in PRICES.items():
        condition = F.col("o_orderpriority") == priority
        chosen = F.when(condition, price[index]) if chosen is None else chosen.when(condition, price[index])
    return chosen.otherwise(DEFAULT_PRICE[index])


def users(spark: SparkSession, sf_dir: str) -> DataFrame:
    key = F.col("c_custkey")
    signup = F.expr("TIMESTAMP_NTZ '2023-10-01 00:00:00'") + _days(key % 181)
    activated = F.when(key % 7 < 5, signup + _hours(1 + key * 31 % 168))
    plan = F.when(key % 11 < 7, "starter").when(key % 11 < 9, "professional").otherwise("enterprise")
    local_part = F.when(key % 4 == 0, "USER").otherwise("user")
    return _read(spark, sf_dir, "customer").select(
        key.alias("id"),
        F.concat(local_part, key.cast("string"), F.lit("@example.com")).alias("email"),
        F.col("c_name").alias("name"),
        F.col("c_mktsegment").alias("company"),
        signup.alias("created_at"),
        activated.alias("activated_at"),
        F.when(activated.isNotNull() & (key % 5 < 2), plan).alias("plan"),
    )


def _cancel_at() -> Column:
    return F.when(
        F.col("o_orderstatus") == "F", F.col("o_orderdate") + _days(F.col("o_orderkey") % 151)
    )


def _status() -> Column:
    return F.when(F.col("o_orderstatus") == "F", "canceled").otherwise("active")


def subscriptions(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _read(spark, sf_dir, "orders").select(
        F.col("o_orderkey").alias("id"),
        F.col("o_custkey").alias("user_id"),
        X.hashed_id("sub_", F.col("o_orderkey")).alias("stripe_subscription_id"),
        _by_priority(0).alias("plan"),
        _status().alias("status"),
        _by_priority(1).alias("mrr_cents"),
        F.col("o_orderdate").alias("started_at"),
        _cancel_at().alias("canceled_at"),
        F.col("o_orderdate").alias("created_at"),
    )


def events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events folded onto the first 1 + user_id % 30 days of their month.

    No event is left out, and the number of active days differs between users.
    """
    day_of_month = F.dayofmonth("ts") - 1
    folded = day_of_month % (1 + F.col("user_id") % 30)
    return _read(spark, sf_dir, "events").select(
        F.col("event_id").alias("id"),
        "user_id",
        F.col("event_type").alias("event_name"),
        F.col("props").alias("event_properties"),
        (F.col("ts") - _days(day_of_month) + _days(folded)).alias("created_at"),
    )


def payment_customers(spark: SparkSession, sf_dir: str) -> DataFrame:
    key = F.col("c_custkey")
    email = F.concat(F.lit("User"), key.cast("string"), F.lit("@Example.com"))
    return _read(spark, sf_dir, "customer").select(
        X.hashed_id("cus_", key).alias("id"),
        F.when(key % 3 != 0, email).alias("email"),
        F.col("c_name").alias("name"),
        (F.lit(1696118400) + key % 181 * 86400).alias("created"),
        F.lit("usd").alias("currency"),
        F.when(key % 9 != 0, F.col("c_mktsegment")).alias("company"),
        F.lit(None).cast("string").alias("industry"),
        X.timestamp(FIRST_SYNC).alias("synced_at"),
    )


def payment_subscriptions(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _read(spark, sf_dir, "orders").select(
        X.hashed_id("sub_", F.col("o_orderkey")).alias("id"),
        X.hashed_id("cus_", F.col("o_custkey")).alias("customer_id"),
        _status().alias("status"),
        _by_priority(0).alias("plan_id"),
        _by_priority(1).alias("plan_amount"),
        F.lit("usd").alias("plan_currency"),
        F.lit("month").alias("plan_interval"),
        X.to_epoch(F.col("o_orderdate")).alias("created"),
        X.to_epoch(_cancel_at()).alias("canceled_at"),
        X.timestamp(FIRST_SYNC).alias("synced_at"),
    )


def _stamped(df: DataFrame) -> DataFrame:
    return df.withColumn("synced_at", X.timestamp(FIRST_SYNC))


def spread(spark: SparkSession) -> int:
    """Tasks over which subscriptions are spread before their billing periods multiply them."""
    return max(spark.sparkContext.defaultParallelism, int(spark.conf.get("spark.sql.shuffle.partitions")))


def stripe_charges(spark: SparkSession, sf_dir: str) -> DataFrame:
    return billing.operational_charges(subscriptions(spark, sf_dir), AS_OF, spread(spark))


def payment_charges(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _stamped(billing.charge_schedule(payment_subscriptions(spark, sf_dir), AS_OF, spread(spark)))


def payment_invoices(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _stamped(billing.invoice_schedule(payment_subscriptions(spark, sf_dir), AS_OF, spread(spark)))


BUILDERS = {
    "users": users,
    "subscriptions": subscriptions,
    "events": events,
    "stripe_charges": stripe_charges,
    "stripe.customers": payment_customers,
    "stripe.subscriptions": payment_subscriptions,
    "stripe.charges": payment_charges,
    "stripe.invoices": payment_invoices,
}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return BUILDERS[name](spark, sf_dir)


def sources(spark: SparkSession, sf_dir: str) -> Sources:
    return {name: table(spark, sf_dir, name) for name in TABLES}


def scratch_folder(spark: SparkSession) -> str:
    """A new folder below ``spark.checkpoint.dir``, which a cluster shares; a temporary one where none is set."""
    shared = spark.conf.get("spark.checkpoint.dir", None) or tempfile.mkdtemp(prefix="ledgerlight-")
    return f"{shared.rstrip('/')}/tables-{uuid.uuid4().hex}"


# --- landed pages -----------------------------------------------------------


def _page(table_name: str, page: Column, data: Column, has_more: bool | Column = False) -> list[Column]:
    """A page as it would lie in a file: its name and its JSON text."""
    body = F.to_json(
        F.struct(
            F.lit("list").alias("object"),
            data.alias("data"),
            (F.lit(has_more) if isinstance(has_more, bool) else has_more).alias("has_more"),
            F.lit(f"/v1/{table_name}").alias("url"),
        )
    )
    return [page.cast("string").alias("page"), body.alias("value")]


def _customer_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    record = F.struct(
        "id",
        F.lit("customer").alias("object"),
        F.coalesce("email", F.lit("")).alias("email"),
        "name",
        "created",
        "currency",
        F.lit(False).alias("delinquent"),
        # to_json leaves out a NULL: these customers have no metadata at all
        F.when(F.col("company").isNotNull(), F.struct("company")).alias("metadata"),
    )
    customers = payment_customers(spark, sf_dir)
    return customers.select(*_page("customers", F.col("id"), F.array(record)))


def _subscription_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    plan = F.struct(
        F.col("plan_id").alias("id"),
        F.lit("plan").alias("object"),
        F.col("plan_amount").alias("amount"),
        F.col("plan_currency").alias("currency"),
        F.col("plan_interval").alias("interval"),
        F.col("plan_id").alias("product"),
    )
    record = F.struct(
        "id",
        F.lit("subscription").alias("object"),
        F.col("customer_id").alias("customer"),
        "status",
        # legacy plans are no longer described: such records must be rejected
        F.when(F.col("plan_id") != "legacy", plan).alias("plan"),
        F.col("created").alias("current_period_start"),
        (F.col("created") + billing.PERIOD_SECONDS).alias("current_period_end"),
        "created",
        "canceled_at",
        F.struct(F.col("plan_id").alias("plan_name")).alias("metadata"),
    )
    subs = payment_subscriptions(spark, sf_dir)
    return subs.select(*_page("subscriptions", F.col("id"), F.array(record)))


def _schedule(subs: DataFrame) -> DataFrame:
    """Subscriptions with the array of their period starts."""
    end = F.coalesce("canceled_at", F.lit(X.epoch_seconds(AS_OF)).cast("bigint"))
    step = F.lit(billing.PERIOD_SECONDS).cast("bigint")
    starts = period_starts(F.col("created"), end, step, F.lit(1))
    return subs.where(F.col("created") < end).withColumn("starts", starts)


def _charge_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One page per subscription, with all its charges."""

    def record(start: Column, n: Column) -> Column:
        return F.struct(
            X.hashed_id("ch_", F.col("id"), n).alias("id"),
            F.lit("charge").alias("object"),
            F.col("plan_amount").alias("amount"),
            F.col("plan_currency").alias("currency"),
            F.col("customer_id").alias("customer"),
            F.lit("succeeded").alias("status"),
            F.lit(True).alias("paid"),
            start.alias("created"),
            F.struct(F.col("id").alias("subscription_id"), F.col("plan_id").alias("plan")).alias("metadata"),
        )

    billed = _schedule(payment_subscriptions(spark, sf_dir).repartition(spread(spark), "id"))
    return billed.select(*_page("charges", F.col("id"), F.transform("starts", record)))


def _invoice_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One page per subscription, with all its invoices."""

    def record(start: Column, n: Column) -> Column:
        return F.struct(
            X.hashed_id("in_", F.col("id"), n).alias("id"),
            F.lit("invoice").alias("object"),
            F.col("customer_id").alias("customer"),
            F.col("id").alias("subscription"),
            F.col("plan_amount").alias("amount_due"),
            F.col("plan_amount").alias("amount_paid"),
            F.lit("paid").alias("status"),
            start.alias("created"),
            F.col("plan_currency").alias("currency"),
            start.alias("period_start"),
            (start + billing.PERIOD_SECONDS).alias("period_end"),
        )

    billed = _schedule(payment_subscriptions(spark, sf_dir).repartition(spread(spark), "id"))
    return billed.select(*_page("invoices", F.col("id"), F.transform("starts", record)))


PAGES = {
    "customers": _customer_pages,
    "subscriptions": _subscription_pages,
    "charges": _charge_pages,
    "invoices": _invoice_pages,
}


def replayed_charge_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Twelve pages per subscription, on which every charge comes twice.

    The n-th charge is pending on page 1 + n % 9, and has another status and another
    amount on page 10 + n % 3. Read as text, most of the later names come first.
    """

    def record(start: Column, n: Column) -> Column:
        later = F.col("k") >= 10
        return F.struct(
            X.hashed_id("ch_", F.col("id"), n).alias("id"),
            F.lit("charge").alias("object"),
            (F.col("plan_amount") + F.when(later, 100).otherwise(0)).alias("amount"),
            F.col("plan_currency").alias("currency"),
            F.col("customer_id").alias("customer"),
            F.when(later, "succeeded").otherwise("pending").alias("status"),
            later.alias("paid"),
            start.alias("created"),
            F.struct(F.col("id").alias("subscription_id"), F.col("plan_id").alias("plan")).alias("metadata"),
        )

    billed = _schedule(payment_subscriptions(spark, sf_dir).repartition(spread(spark), "id"))
    numbered = billed.withColumn("last", F.size("starts") - 1).drop("starts")
    paged = numbered.withColumn("k", F.explode(F.sequence(F.lit(1), F.lit(12))))
    # every ninth charge from the page's first one on, or every third, without looking at all of them on each page
    first, step = (F.when(F.col("k") < 10, a).otherwise(b) for a, b in ((F.col("k") - 1, F.col("k") - 10), (F.lit(9), F.lit(3))))
    here = F.when(first <= F.col("last"), F.sequence(first, F.greatest(first, "last"), step)).otherwise(F.array().cast("array<int>"))
    page = F.concat(F.lit("page_"), F.col("k").cast("string"))
    return paged.select(*_page("charges", page, F.transform(here, lambda n: record(F.col("created") + n * billing.PERIOD_SECONDS, n))))


def faulty_pages(spark: SparkSession, sf_dir: str, table_name: str) -> DataFrame:
    """Pages of a list on which some records lack required fields, and after which more pages follow."""
    if table_name == "customers":
        key = F.col("c_custkey")
        record = F.struct(
            X.hashed_id("cus_", key).alias("id"),
            F.when(key % 4 != 0, F.col("c_name")).alias("email"),
            F.when(key % 6 != 0, F.col("c_name")).alias("name"),
            key.alias("created"),
            F.lit("usd").alias("currency"),
        )
        rows, page = _read(spark, sf_dir, "customer"), key
    else:
        key = F.col("o_orderkey")
        common = {
            "id": X.hashed_id("x_", key),
            "customer": F.when(key % 5 != 0, X.hashed_id("cus_", F.col("o_custkey"))),
            "status": F.col("o_orderstatus"),
            "created": X.to_epoch(F.col("o_orderdate")),
        }
        if table_name == "charges":
            own = {"amount": F.when(key % 7 != 0, 100), "currency": F.lit("usd"), "paid": F.lit(True)}
        else:
            own = {
                "subscription": F.lit("sub_1"), "amount_due": F.lit(1), "amount_paid": F.when(key % 3 != 0, 1),
                "period_start": F.lit(1), "period_end": F.lit(2),
            }
        record = F.struct(*[c.alias(n) for n, c in (common | own).items()])
        rows, page = _read(spark, sf_dir, "orders"), key
    return rows.select(*_page(table_name, page, F.array(record), has_more=True))


def broken_chain(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Numbered pages of ten customers each, of which some are lost, some say that nothing follows, and
    some have the next page's first customer too."""
    key = F.col("c_custkey")
    page = F.call_function("div", key, F.lit(10))
    record = F.struct(
        X.hashed_id("cus_", key).alias("id"), F.col("c_name").alias("email"), F.col("c_name").alias("name"),
        key.alias("created"), F.lit("usd").alias("currency"),
    )
    rows = _read(spark, sf_dir, "customer").select(page.alias("p"), key.alias("key"), record.alias("record"))
    early = rows.where((F.col("key") % 10 == 0) & ((F.col("p") - 1) % 6 == 1)).withColumn("p", F.col("p") - 1)
    paged = rows.unionByName(early).groupBy("p").agg(F.array_sort(F.collect_list(F.struct("key", "record"))).alias("r"))
    paged = paged.where(F.col("p") % 9 != 4).withColumn("r", F.transform("r", lambda x: x["record"]))
    name = F.concat(F.lit("customers/page_"), F.col("p").cast("string"), F.lit(".json"))
    return paged.select(*_page("customers", name, F.col("r"), F.col("p") % 5 != 2))


def faulty_sources(spark: SparkSession, sf_dir: str) -> Sources:
    """Four of the tables with faults: repeated and missing keys, long texts, orphans, no rows."""
    people = users(spark, sf_dir)
    key = F.col("id")
    people = people.union(people.where(key % 10 == 3)).withColumns(
        {
            "id": F.when(key % 50 != 7, key),
            "email": F.when(key % 60 == 5, F.lit(None)).when(key % 20 == 0, "same@example.com").when(
                key % 70 == 1, F.repeat(F.lit("e"), 300)
            ).otherwise(F.col("email")),
            "name": F.when(key % 30 == 1, F.repeat(F.lit("n"), 256)).otherwise(F.col("name")),
            "created_at": F.when(key % 40 != 2, F.col("created_at")),
        }
    )
    subs = subscriptions(spark, sf_dir)
    subs = subs.withColumns(
        {
            "user_id": F.when(key % 25 == 0, F.col("user_id") + 10_000_000).otherwise(F.col("user_id")),
            "status": F.when(key % 90 == 1, F.repeat(F.lit("s"), 51)).otherwise(F.col("status")),
        }
    )
    charges = payment_customers(spark, sf_dir).select(
        F.when(F.col("created") % 7 == 0, F.repeat(F.lit("c"), 260)).otherwise(F.col("id")).alias("id"),
        F.col("id").alias("customer_id"),
        F.lit(1).alias("amount_cents"),
        F.lit("succeeded").alias("status"),
        X.timestamp(FIRST_SYNC).alias("created_at"),
    )
    return {"users": people, "subscriptions": subs, "events": events(spark, sf_dir).where("false"), "stripe_charges": charges}


def landed_pages(spark: SparkSession, sf_dir: str, table_name: str) -> DataFrame:
    """Pages of a provider list: ``page`` and its JSON text as ``value``."""
    return PAGES[table_name](spark, sf_dir)


# --- two states of the payment tables, for merges ---------------------------


def earlier_state(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A payment table as it stood at the first sync.

    Holds what had been created by then; cancellations, payments and renamed
    customers that came later are not known yet. (Customers all sign up later
    than that, so for them the first half of their signup days counts.)
    """
    df = table(spark, sf_dir, f"stripe.{name}")
    cutoff = F.lit(X.epoch_seconds(FIRST_SYNC)).cast("bigint")
    if name == "customers":
        known = df.where(F.col("created") < 1696118400 + 90 * 86400)
        return known.withColumn("name", F.concat(F.lit("Old "), F.col("name")))
    known = df.where(F.col("created") < cutoff)
    if name == "subscriptions":
        pending = F.col("canceled_at") >= cutoff
        return known.withColumns(
            {
                "status": F.when(pending, "active").otherwise(F.col("status")),
                "canceled_at": F.when(~pending, F.col("canceled_at")),
            }
        )
    if name == "charges":
        return known.withColumns({"status": F.lit("failed"), "paid": F.lit(False)})
    return known.withColumns({"status": F.lit("open"), "amount_paid": F.lit(0)})


def later_batch(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """What the second sync brings: everything new or changed since the first.

    Amounts, currencies and companies differ from the first state as well, and
    a merge must not take those over for known rows. Some known rows are not in the
    batch, and in some an updated column is NULL, which a merge must take over.
    """
    df = table(spark, sf_dir, f"stripe.{name}").drop("synced_at")
    cutoff = F.lit(X.epoch_seconds(FIRST_SYNC)).cast("bigint")
    key = F.col("id")
    if name == "customers":
        # Some are absent from the batch, and others lose their email.
        some = df.where(~key.rlike("[01]$"))
        lost = F.when(~key.rlike("[23]$"), F.col("email"))
        return some.withColumns({"email": lost, "currency": F.lit("eur"), "company": F.lit("moved")})
    if name == "subscriptions":
        changed = df.where((F.col("created") >= cutoff) | (F.col("canceled_at") >= cutoff))
        lost = F.when(~key.rlike("[23]$"), F.col("status"))
        return changed.withColumns({"status": lost, "plan_amount": F.col("plan_amount") + 100})
    some = df.where(~key.rlike("[01]$"))
    if name == "charges":
        lost = F.when(~key.rlike("[23]$"), F.col("status"))
        return some.withColumns({"status": lost, "amount": F.col("amount") + 100})
    lost = F.when(~key.rlike("[23]$"), F.col("amount_paid"))
    return some.withColumns({"amount_paid": lost, "amount_due": F.col("amount_due") + 100})

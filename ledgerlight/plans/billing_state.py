"""Billing run by run: each run issues the periods that have started since the last one.

For each provider subscription a keyed table holds how many of its periods are issued. A
run compares that with how many have started by its date, which is arithmetic on the
subscription's start and end, and writes only the difference: periods newly started, of
subscriptions that came late too, and as ``reversed`` those that were issued before a
cancellation with an earlier date was known. Marks that do not move are not written.

Below the state's folder, ``marks`` is the keyed table and ``runs/<epoch>`` what a run
wrote: a row per subscription whose mark moved, with the first of its ``periods`` periods that
follow each other. They become single periods when they are read, so neither files nor
shuffles grow with the number of periods. A run counts once its marks are merged; one that failed before is repeated under the
same ``epoch``, and one that is repeated later changes nothing.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerlight.functions import exprs as X
from ledgerlight.operators.schedule import PERIOD_SECONDS
from ledgerlight.operators.upsert import MergeSpec
from ledgerlight.sources import keyed

MARKS = "id STRING, issued BIGINT, updated_at TIMESTAMP_NTZ"
PERIODS = """
    id STRING, customer_id STRING, plan_amount INT, plan_currency STRING, created BIGINT, canceled_at BIGINT,
    period_no INT, period_at BIGINT, kind STRING
"""
# A stored row without ``periods`` is one period.
STRETCHES = f"{PERIODS.rstrip()}, periods INT"


def marks_table(state: str, buckets: int = 64) -> keyed.KeyedTable:
    return keyed.KeyedTable(f"{state.rstrip('/')}/marks", "marks", MergeSpec("id", ("issued",), "updated_at"), buckets, columns=MARKS)


def run(
    spark: SparkSession, state: str, subscriptions: DataFrame, as_of: dt.date, epoch: int, at: dt.datetime, buckets: int = 64
) -> None:
    """Issue and reverse periods so that those in force are ``billing.invoice_schedule`` as of ``as_of``.

    Subscriptions that are no longer given keep what was issued.
    """
    table = marks_table(state, buckets)
    version = keyed.current(spark, table)
    if version is not None and version.epoch is not None and epoch <= version.epoch:
        return
    end = F.coalesce(F.nullif(F.col("canceled_at"), F.lit(0)), F.lit(X.epoch_seconds(as_of))).cast("bigint")
    started = F.call_function("div", end - F.col("created") + (PERIOD_SECONDS - 1), F.lit(PERIOD_SECONDS).cast("bigint"))
    billed = subscriptions.select("id", "customer_id", "plan_amount", "plan_currency", "created", "canceled_at").withColumn(
        "due", F.when(F.col("created") < end, started).otherwise(F.lit(0)).cast("bigint")
    )
    if version is None:
        known = billed.withColumn("issued", F.lit(0).cast("bigint"))
    else:
        marks = keyed.read(spark, table).select("id", "issued")
        known = billed.join(marks, "id", "left").withColumn("issued", F.coalesce("issued", F.lit(0)))
    moved = known.where("due <> issued")

    first, last = F.least("due", "issued"), F.greatest("due", "issued") - 1
    stretches = moved.select(
        "id", "customer_id", "plan_amount", "plan_currency", "created", "canceled_at", first.cast("int").alias("period_no"),
        (F.col("created") + first * PERIOD_SECONDS).alias("period_at"),
        F.when(F.col("due") > F.col("issued"), "issued").otherwise("reversed").alias("kind"),
        (last - first + 1).cast("int").alias("periods"),
    )
    folder = f"{state.rstrip('/')}/runs/{epoch}"
    stretches.write.mode("overwrite").options(**keyed.STORED).parquet(folder)
    # What is stored tells the marks: the subscriptions meet their old marks once.
    due = F.col("period_no").cast("bigint") + F.when(F.col("kind") == "issued", F.col("periods")).otherwise(F.lit(0))
    keyed.merge(spark, table, spark.read.schema(STRETCHES).parquet(folder).select("id", due.alias("issued")), at, epoch)


def _stretches(spark: SparkSession, state: str, epochs: list[int] | None = None) -> DataFrame:
    """What complete runs stored, with their ``epoch`` and the ``last_no`` of each row's periods."""
    version = keyed.current(spark, marks_table(state))
    folder = f"{state.rstrip('/')}/runs"
    if version is None:
        return spark.createDataFrame([], f"{STRETCHES}, epoch int, last_no int")
    stored = spark.read.schema(STRETCHES).option("recursiveFileLookup", True).parquet(folder)
    epoch = F.regexp_extract("_metadata.file_path", "/runs/([0-9]+)/", 1).cast("int")
    complete = stored.withColumn("epoch", epoch).where(F.col("epoch") <= version.epoch)
    chosen = complete if epochs is None else complete.where(F.col("epoch").isin(epochs))
    return chosen.withColumn("last_no", F.col("period_no") + F.coalesce("periods", F.lit(1)) - 1)


def _at(period_no: str) -> Column:
    return F.col("created") + F.col(period_no).cast("bigint") * PERIOD_SECONDS


def issued(spark: SparkSession, state: str, epochs: list[int] | None = None) -> DataFrame:
    """What complete runs issued and reversed, a row per period, with their ``epoch``."""
    columns = [c for c in _stretches(spark, state).columns if c not in ("period_no", "period_at", "kind", "periods", "epoch", "last_no")]
    numbers = F.explode_outer(F.sequence("period_no", "last_no")).alias("period_no")
    single = _stretches(spark, state, epochs).select(*columns, numbers, "kind", "epoch")
    return single.select(*columns, "period_no", _at("period_no").alias("period_at"), "kind", "epoch")


def in_force(spark: SparkSession, state: str) -> DataFrame:
    """The periods issued and not reversed since, as ``billing.invoices_of`` takes them.

    The runs of a subscription meet, newest first, and a period is as the first of them
    that has it says. An id given many times is as many rows as it has different stretches.
    """
    columns = ["customer_id", "plan_amount", "plan_currency", "created", "canceled_at"]
    place = ["epoch", "kind", "period_no", "last_no"]
    # Dealt out once, by id alone, for both groupings.
    once = _stretches(spark, state).repartition(F.col("id")).groupBy("id", *place).agg(F.max(F.struct(*columns)).alias("row"))
    runs = once.groupBy("id").agg(F.sort_array(F.collect_list(F.struct(*place, "row")), asc=False).alias("runs"))
    each = runs.select("id", "runs", F.posexplode_outer("runs").alias("newer", "run")).where("run.kind = 'issued'")

    def open_(n: Column) -> Column:
        return ~F.exists(F.slice("runs", F.lit(1), F.col("newer")), lambda r: n.between(r["period_no"], r["last_no"]))

    numbers = F.sequence("run.period_no", "run.last_no")
    numbers = F.when(F.col("newer") == 0, numbers).otherwise(F.filter(numbers, open_))
    # The outer form spares a filter on the array's size, which would build the array twice.
    single = each.select("id", "run.row.*", F.explode_outer(numbers).alias("period_no")).where(F.col("period_no").isNotNull())
    return single.select("id", "period_no", *columns, _at("period_no").alias("period_at"))

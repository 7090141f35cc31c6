"""Recurring revenue kept up to date by a day's changed subscriptions, without reading the others.

What the report sums up is additive: per pair of months and plan, a changed subscription
takes its old row's part away and adds its new row's. Distinct paying customers are not,
so for each customer the pairs of months are kept with the number of subscriptions that
have them: of the customers that a day touches, the old and the new disjoint periods tell
how the monthly counts change. A customer with very many subscriptions has as many pairs
as there are months, at most squared.

Below the state's folder, ``periods`` is a keyed table (a merge writes the files that it
touches) and ``months/<epoch>`` holds the sums, which are few, and the pairs that the update moved. An update is named by its
``epoch``, a number that grows; the table's newest version names the state's epoch, so that
both change over at once, and an update that is repeated changes nothing.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerlight.operators import spans as S
from ledgerlight.operators.upsert import MergeSpec
from ledgerlight.plans import marts
from ledgerlight.sources import keyed

PERIODS = """
    user_id BIGINT, periods ARRAY<STRUCT<start_m: DATE, end_m: DATE, n: BIGINT>>, updated_at TIMESTAMP_NTZ
"""
GROUPS = "start_m DATE, end_m DATE, plan STRING, rows BIGINT, known_ids BIGINT, known_amounts BIGINT, sum_cents BIGINT"
CUSTOMERS = "month DATE, customers BIGINT"
MEASURES = ("rows", "known_ids", "known_amounts", "sum_cents")


def periods_table(state: str, buckets: int = 64) -> keyed.KeyedTable:
    spec = MergeSpec("user_id", ("periods",), "updated_at")
    return keyed.KeyedTable(f"{state.rstrip('/')}/periods", "periods", spec, buckets, columns=PERIODS)


def _sums(spark: SparkSession, state: str, epoch: int | None, name: str, schema: str) -> DataFrame:
    if epoch is None:
        return spark.createDataFrame([], schema)
    return spark.read.schema(schema).parquet(f"{state.rstrip('/')}/months/{epoch}/{name}")


def _signed(df: DataFrame, measures: tuple[str, ...], sign: int) -> DataFrame:
    return df.withColumns({m: F.col(m) * sign for m in measures})


def _counted(spans: DataFrame, sign: int) -> DataFrame:
    """Lasting periods of customers: how many subscriptions each pair of months gains or loses."""
    lasting = spans.where(marts.LASTING).where(F.col("user_id").isNotNull())
    return lasting.groupBy("user_id", "start_m", "end_m").agg((F.count(F.lit(1)) * sign).alias("n"))


def _kept(df: DataFrame, path: str) -> DataFrame:
    """``df`` written to a place and read from there."""
    df.write.mode("overwrite").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def update(
    spark: SparkSession, state: str, before: DataFrame, after: DataFrame, epoch: int, at: dt.datetime, buckets: int = 64
) -> None:
    """Take over changes: ``before`` and ``after`` are the staged rows of those subscriptions that changed.

    A new subscription has no row before, a deleted one none after. The first update may
    bring all subscriptions.
    """
    table = periods_table(state, buckets)
    version = keyed.current(spark, table)
    known = None if version is None else version.epoch
    if known is not None and epoch <= known:
        return
    old_spans, new_spans = marts.active_spans(before), marts.active_spans(after)

    # Stored once each: the sums and the keyed table would otherwise read all changes and the touched files again.
    folder = f"{state.rstrip('/')}/months/{epoch}"
    moved = _kept(_counted(new_spans, 1).unionByName(_counted(old_spans, -1)), f"{folder}/moved")
    users = moved.select("user_id").distinct()
    known_pairs = keyed.lookup(spark, table, users).select("user_id", F.inline("periods"))
    none = F.lit(0).cast("bigint")
    both = known_pairs.withColumn("known", F.col("n")).unionByName(moved.withColumn("known", none))
    both = both.groupBy("user_id", "start_m", "end_m").agg(F.sum("n").alias("n"), F.sum("known").alias("known"))
    both = _kept(both, f"{folder}/pairs")
    now = both.where("n <> 0").drop("known")
    held = both.where("known <> 0").select("user_id", "start_m", "end_m", F.col("known").alias("n"))
    listed = now.groupBy("user_id").agg(F.sort_array(F.collect_list(F.struct("start_m", "end_m", "n"))).alias("periods"))
    # Customers whose last period is gone keep an empty list.
    none = F.array().cast("array<struct<start_m: date, end_m: date, n: bigint>>")
    rows = users.join(listed, "user_id", "left").withColumn("periods", F.coalesce("periods", none))

    groups = _sums(spark, state, known, "groups", GROUPS)
    groups = groups.unionByName(marts.grouped_spans(new_spans)).unionByName(_signed(marts.grouped_spans(old_spans), MEASURES, -1))
    groups = groups.groupBy("start_m", "end_m", "plan").agg(*[F.sum(m).alias(m) for m in MEASURES]).where("rows <> 0")
    customers = _sums(spark, state, known, "customers", CUSTOMERS)
    for periods, sign in ((now, 1), (held, -1)):
        changes = S.distinct_key_changes(periods.where("n > 0"), "user_id", "customers")
        customers = customers.unionByName(_signed(changes, ("customers",), sign))
    customers = customers.where("month IS NOT NULL").groupBy("month").agg(F.sum("customers").alias("customers")).where("customers <> 0")
    groups.write.mode("overwrite").parquet(f"{folder}/groups")
    customers.write.mode("overwrite").parquet(f"{folder}/customers")
    keyed.merge(spark, table, rows, at, epoch)


def changed(before: DataFrame, after: DataFrame, key: str = "subscription_id") -> tuple[DataFrame, DataFrame]:
    """Of two snapshots with the same columns, the rows of those keys that are new, gone or different."""
    told = lambda df, name: df.select(key, F.xxhash64(*df.columns).alias(name))
    both = told(before, "old").join(told(after, "new"), key, "full_outer")
    keys = both.where(~F.col("old").eqNullSafe(F.col("new"))).select(key)
    return before.join(keys, key, "left_semi"), after.join(keys, key, "left_semi")


def mrr_by_month(spark: SparkSession, state: str, as_of: dt.date) -> DataFrame:
    """The report as of the state's newest epoch; subscription ids count as unique."""
    version = keyed.current(spark, periods_table(state))
    epoch = None if version is None else version.epoch
    return marts.mrr_of(_sums(spark, state, epoch, "groups", GROUPS), [_sums(spark, state, epoch, "customers", CUSTOMERS)], as_of)

"""User activity kept per day, and brought up to date by reading only the days whose files changed.

Events lie in one folder per day (``tables.write_events_by_day``). Their roll-up per user
and day adds up: counts are summed, first and last times are minima and maxima, and active
days are counted, so days can be rolled up again one by one. Below the state's folder lie

* ``days/run=<n>/event_date=<day>``: the roll-up of a day, as run n found it;
* ``manifests/<n>``: for each day the run that holds it, and what its files were then.

A run lists the events' files, without opening them, rolls up the days whose files differ
from the manifest's, late events and lost files included, and writes a manifest with the
others as they were. A manifest counts once it is complete; a run that failed before is
repeated under the same number. One job updates a state at a time.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerlight.plans import marts, staging
from ledgerlight.schemas import TABLES
from ledgerlight.sources.tables import path_exists, path_of

MANIFEST = "day date, run long, files long, told long"
DAYS = """user_id bigint, n bigint, first_at timestamp_ntz, last_at timestamp_ntz, run long, event_date date"""


def listed(spark: SparkSession, base: str) -> DataFrame:
    """Per day of the stored events: its number of files, and a digest of their names, sizes and times."""
    files = spark.read.format("binaryFile").option("pathGlobFilter", "*.parquet").option("recursiveFileLookup", True)
    found = files.load(path_of(base, "events")).select("path", "length", "modificationTime")
    day = F.to_date(F.try_to_timestamp(F.regexp_extract("path", "/event_date=([^/]*)/", 1)))
    return found.groupBy(day.alias("day")).agg(
        F.count(F.lit(1)).alias("files"), F.bit_xor(F.xxhash64("path", "length", "modificationTime")).alias("told")
    )


def _newest(spark: SparkSession, state: str) -> int:
    """The number of the newest complete manifest; 0 if there is none."""
    folder = f"{state}/manifests"
    if not path_exists(spark, folder):
        return 0
    place = spark._jvm.org.apache.hadoop.fs.Path(folder)
    fs = place.getFileSystem(spark._jsc.hadoopConfiguration())
    numbers = [int(s.getPath().getName()) for s in fs.listStatus(place) if s.getPath().getName().isdigit()]
    return max((n for n in numbers if path_exists(spark, f"{folder}/{n}/_SUCCESS")), default=0)


def manifest(spark: SparkSession, state: str) -> DataFrame:
    n = _newest(spark, state)
    return spark.read.schema(MANIFEST).parquet(f"{state}/manifests/{n}") if n else spark.createDataFrame([], MANIFEST)


def _among(column: str, days: list) -> Column:
    """A filter on the partition column; NULL is a day of its own."""
    known = [F.lit(d) for d in days if d is not None]
    chosen = F.col(column).isin(known) if known else F.lit(False)
    return chosen | F.col(column).isNull() if None in days else chosen


def events_of_days(spark: SparkSession, base: str, days: list) -> DataFrame:
    """The events of some days; other days' folders are not read."""
    stored = spark.read.schema(f"{TABLES['events']}, event_date date").parquet(path_of(base, "events"))
    return stored.where(_among("event_date", days)).drop("event_date")


def changed_days(spark: SparkSession, base: str, state: str) -> DataFrame:
    """The days whose files are not those of the manifest: day, files, told."""
    known = manifest(spark, state).select(F.col("day").alias("old_day"), F.col("files").alias("old_files"), F.col("told").alias("old_told"))
    now = listed(spark, base)
    same = now["day"].eqNullSafe(known["old_day"]) & (now["files"] == known["old_files"]) & (now["told"] == known["old_told"])
    return now.join(known, same, "left_anti")


def update(spark: SparkSession, base: str, state: str) -> list:
    """Roll up the changed days of the events under ``base``; returns them (None: events without a time)."""
    run = _newest(spark, state) + 1
    # Days are few, whatever the number of events.
    days = [r["day"] for r in changed_days(spark, base, state).select("day").toLocalIterator()]
    if days:
        daily = marts.daily_activity(staging.stg_events(events_of_days(spark, base, days)))
        rolled = daily.withColumnRenamed("day", "event_date").hint("rebalance", F.col("event_date"))
        rolled.write.mode("overwrite").partitionBy("event_date").parquet(f"{state}/days/run={run}")
    now, known = listed(spark, base), manifest(spark, state).select("day", F.col("run").alias("old_run"))
    # Days that are no longer there are left out.
    kept = now.join(known, now["day"].eqNullSafe(known["day"]), "left").select(
        now["day"], F.when(_among_day(now, days), F.lit(run)).otherwise(F.col("old_run")).alias("run"), "files", "told"
    )
    kept.coalesce(1).write.mode("overwrite").parquet(f"{state}/manifests/{run}")
    return days


def _among_day(now: DataFrame, days: list) -> Column:
    known = [F.lit(d) for d in days if d is not None]
    chosen = F.coalesce(now["day"].isin(known), F.lit(False)) if known else F.lit(False)
    return chosen | now["day"].isNull() if None in days else chosen


def read(spark: SparkSession, state: str) -> DataFrame:
    """The roll-up per user and day, of the runs that the manifest names: (user_id, day, n, first_at, last_at)."""
    runs = manifest(spark, state).groupBy("run").agg(F.collect_list("day").alias("days"), F.count_if(F.col("day").isNull()).alias("none"))
    chosen = F.lit(False)
    for r in runs.toLocalIterator():
        days = [*r["days"], *([None] if r["none"] else [])]
        if path_exists(spark, f"{state}/days/run={r['run']}"):
            chosen = chosen | ((F.col("run") == r["run"]) & _among("event_date", days))
    if not path_exists(spark, f"{state}/days"):
        stored = spark.createDataFrame([], DAYS)
    else:
        stored = spark.read.schema(DAYS).parquet(f"{state}/days")
    return stored.where(chosen).select("user_id", F.col("event_date").alias("day"), "n", "first_at", "last_at")


def user_metrics(spark: SparkSession, users: DataFrame, subscriptions: DataFrame, state: str) -> DataFrame:
    """The mart, from staged users and subscriptions and the stored activity: no event is read."""
    return marts.user_metrics_of(users, subscriptions, read(spark, state))

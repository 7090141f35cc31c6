"""Readers and writers of the declared tables.

A set of sources is a plain mapping from table name (the keys of
``schemas.TABLES``) to DataFrame; every reader returns the declared columns.
"""

from __future__ import annotations

import datetime as dt
import uuid
from collections.abc import Iterable, Mapping

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from ledgerlight.schemas import TABLES

Sources = Mapping[str, DataFrame]

# Numeric columns along which a database read can be split into ranges.
SPLIT_COLUMNS = {
    "users": "id",
    "subscriptions": "id",
    "events": "id",
    "stripe_charges": "created_at",
    "stripe.customers": "created",
    "stripe.subscriptions": "created",
    "stripe.charges": "created",
    "stripe.invoices": "created",
}


def empty(spark: SparkSession, table: str) -> DataFrame:
    """A declared table without rows, for a target that does not exist yet."""
    return spark.createDataFrame([], TABLES[table])


def conform(df: DataFrame, table: str) -> DataFrame:
    """Select and cast to the declared columns."""
    fields = StructType.fromDDL(TABLES[table]).fields
    return df.select(*[F.col(f.name).cast(f.dataType).alias(f.name) for f in fields])


def path_of(base: str, table: str) -> str:
    return f"{base.rstrip('/')}/{table.replace('.', '/')}"


def read_table(spark: SparkSession, base: str, table: str) -> DataFrame:
    """A table stored as parquet under ``base`` (``stripe.charges`` → ``stripe/charges``)."""
    return conform(spark.read.schema(TABLES[table]).parquet(path_of(base, table)), table)


def parquet_sources(spark: SparkSession, base: str, tables: Iterable[str] = tuple(TABLES)) -> Sources:
    return {t: read_table(spark, base, t) for t in tables}


def catalog_sources(
    spark: SparkSession, databases: Mapping[str, str], tables: Iterable[str] = tuple(TABLES)
) -> Sources:
    """Tables of the session catalog; ``databases`` maps '' and 'stripe' to databases."""
    found = {}
    for table in tables:
        schema, _, name = table.rpartition(".")
        found[table] = conform(spark.table(f"{databases[schema]}.{name}"), table)
    return found


def exists(spark: SparkSession, name: str) -> bool:
    """Whether a table or view of that name is in the catalog."""
    return spark.catalog.tableExists(name)


def jdbc_options(
    url: str, table: str, bounds: tuple[object, object] | None = None, partitions: int = 1
) -> dict[str, str]:
    """Reader options for one table; ``bounds`` split the read into parallel ranges.

    The bounds only shape the ranges: rows outside them are still read.
    """
    options = {"url": url, "dbtable": table, "preferTimestampNTZ": "true", "fetchsize": "10000"}
    if partitions > 1:
        if bounds is None:
            raise ValueError("a parallel read needs the bounds of its split column")
        options |= {
            "partitionColumn": SPLIT_COLUMNS[table],
            "lowerBound": str(bounds[0]),
            "upperBound": str(bounds[1]),
            "numPartitions": str(partitions),
        }
    return options


def read_jdbc(
    spark: SparkSession,
    url: str,
    table: str,
    bounds: tuple[object, object] | None = None,
    *,
    partitions: int,
    properties: Mapping[str, str] | None = None,
) -> DataFrame:
    """A table of an operational database, over so many connections; filters and columns are pushed to it."""
    options = jdbc_options(url, table, bounds, partitions) | dict(properties or {})
    return conform(spark.read.format("jdbc").options(**options).load(), table)


def write_table(
    df: DataFrame, base: str, table: str, mode: str = "overwrite", partition_by: str | None = None
) -> None:
    """Store a table: ``append`` adds rows, ``overwrite`` drops and reloads.

    With ``partition_by`` rows are first gathered by that column; the rebalance
    hint lets Spark split a value that holds far more rows than the others.
    """
    writer = df
    if partition_by is not None:
        writer = df.hint("rebalance", F.col(partition_by))
    out = writer.write.mode(mode)
    if partition_by is not None:
        out = out.partitionBy(partition_by)
    out.parquet(path_of(base, table))


def write_events_by_day(events: DataFrame, base: str, mode: str = "overwrite") -> None:
    """Store events in one directory per day, so that date filters skip files."""
    dated = events.withColumn("event_date", F.to_date("created_at"))
    write_table(dated, base, "events", mode, partition_by="event_date")


def read_events_by_day(spark: SparkSession, base: str, first: dt.date, last: dt.date) -> DataFrame:
    """Events of the days from ``first`` to ``last``; other days' directories are not read."""
    stored = spark.read.schema(f"{TABLES['events']}, event_date date").parquet(path_of(base, "events"))
    return conform(stored.where(F.col("event_date").between(F.lit(first), F.lit(last))), "events")


def save_bucketed(df: DataFrame, name: str, key: str, buckets: int, laid_out: bool = False) -> None:
    """Replace a catalog table bucketed and sorted by ``key``, with one file per bucket.

    Joins on the key read it without a shuffle. ``laid_out`` says that the rows are
    partitioned that way already, as a merge with such a table leaves them.
    """
    rows = df if laid_out else df.repartition(buckets, key)
    rows.write.mode("overwrite").format("parquet").bucketBy(buckets, key).sortBy(key).saveAsTable(name)


def bucketed(df: DataFrame, key: str, path: str) -> DataFrame:
    """The same rows, stored in a new place by bucket of ``key``: joins and groupings by it read them without a shuffle.

    Ids of random letters take half the disk of a shuffle there, as columns with an entropy code. Each task that
    writes sorts its rows by bucket, so the tasks should be small; there are as many buckets as a shuffle has
    partitions. Of the catalog only the layout is asked: the table is external, and its name is dropped again.
    """
    spark, name = df.sparkSession, f"bucketed_{uuid.uuid4().hex}"
    out = df.write.format("parquet").option("path", path).option("compression", "zstd")
    # a unique key gains nothing from a dictionary
    out = out.option(f"parquet.enable.dictionary#{key}", "false")
    out.bucketBy(int(spark.conf.get("spark.sql.shuffle.partitions")), key).saveAsTable(name)
    stored = spark.table(name)
    spark.sql(f"DROP TABLE {name}")
    return stored


def path_exists(spark: SparkSession, path: str) -> bool:
    """Whether there is a file or folder of that name in whatever store it names."""
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    return place.getFileSystem(spark._jsc.hadoopConfiguration()).exists(place)


def snapshot(snapshots: str, epoch: int) -> str:
    return f"{snapshots.rstrip('/')}/{epoch}"


def _finished(snapshots: str, table: str) -> str:
    return f"{snapshots.rstrip('/')}/finished/{table}"


def note_snapshot(spark: SparkSession, snapshots: str, table: str, epoch: int) -> None:
    """Note that a payment table's snapshot is complete; noting it twice does no harm."""
    spark.createDataFrame([(epoch,)], "epoch long").coalesce(1).write.mode("append").parquet(_finished(snapshots, table))


def newest_snapshot(spark: SparkSession, snapshots: str, table: str) -> str | None:
    """The folder of a payment table's newest complete snapshot; None if no stream wrote there."""
    if not path_exists(spark, _finished(snapshots, table)):
        return None
    noted = spark.read.schema("epoch long").parquet(_finished(snapshots, table))
    return snapshot(snapshots, noted.agg(F.max("epoch").alias("epoch")).first()["epoch"])

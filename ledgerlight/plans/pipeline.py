"""The whole run: landed pages to payment tables, staging views, stored marts."""

from __future__ import annotations

import datetime as dt
from collections.abc import Collection, Mapping

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerlight.functions import exprs as X
from ledgerlight.operators import quality as Q
from ledgerlight.operators.upsert import merge_by_key, one_row_per_key
from ledgerlight.plans import activity, ingest, kpi, marts, quality, release, staging
from ledgerlight.schemas import TABLES
from ledgerlight.sources import keyed, landed
from ledgerlight.sources.tables import (
    Sources,
    bucketed,
    conform,
    newest_snapshot,
    parquet_sources,
    path_of,
    read_table,
    save_bucketed,
    write_table,
)

STAGING = {name: (table, getattr(staging, name)) for name, table in staging.SOURCES.items()}
OPERATIONAL = ("users", "subscriptions", "events", "stripe_charges")
MARTS = ("fct_mrr_by_month", "fct_user_metrics", "fct_activation_funnel", "fct_revenue_attribution")
STORED = ("data_quality", *MARTS, "kpi_summary")
# The tables that each mart is built from; the other results read all of them.
NEEDS = {
    "fct_mrr_by_month": ("subscriptions",),
    "fct_user_metrics": ("users", "subscriptions", "events"),
    "fct_activation_funnel": ("users",),
    "fct_revenue_attribution": ("users", "stripe.customers", "stripe.subscriptions"),
}
PAYMENT_LISTS = ("customers", "subscriptions", "charges", "invoices")


def stage(sources: Sources) -> dict[str, DataFrame]:
    """The staging views whose source is given."""
    return {name: build(sources[table]) for name, (table, build) in STAGING.items() if table in sources}


def register_views(frames: Mapping[str, DataFrame]) -> None:
    """Make lazy frames available to SQL under their names."""
    for name, df in frames.items():
        df.createOrReplaceTempView(name)


def build_marts(
    staged: Mapping[str, DataFrame], as_of: dt.date, unique_ids: bool = True, only: Collection[str] = MARTS
) -> dict[str, DataFrame]:
    """The marts named in ``only``, from the staging views that they need."""
    builders = {
        "fct_mrr_by_month": lambda subs: marts.mrr_by_month(subs, as_of, unique_ids),
        "fct_user_metrics": marts.user_metrics,
        "fct_activation_funnel": marts.activation_funnel,
        "fct_revenue_attribution": lambda *inputs: marts.revenue_attribution(*inputs, as_of),
    }
    names = {table: name for name, (table, _) in STAGING.items()}
    return {mart: builders[mart](*[staged[names[t]] for t in NEEDS[mart]]) for mart in MARTS if mart in only}


def write_marts(frames: Mapping[str, DataFrame], out: str) -> None:
    """Replace the stored tables under ``out`` (nothing read here lies there)."""
    for name, df in frames.items():
        df.write.mode("overwrite").parquet(f"{out}/{name}")


def batch_of_pages(
    pages: DataFrame, table: str, on_missing: str = "fail", on_duplicate: str = "error", store: str | None = None
) -> DataFrame:
    """The rows of a list's pages, one per key, as a merge takes them.

    Rows of a key meet in a shuffle, or in buckets kept under ``store``, a new place: less disk, see ``bucketed``.
    """
    rows = ingest.flatten(landed.records(pages), table, on_missing, keep_order=True)
    if store is not None:
        rows = bucketed(rows, ingest.MERGES[table].key, store)
    return one_row_per_key(rows, ingest.MERGES[table], ingest.ORDER, on_duplicate)


def merged_pages(
    pages: DataFrame,
    table: str,
    previous: DataFrame | None,
    synced_at: dt.datetime,
    on_missing: str = "fail",
    on_duplicate: str = "error",
    store: str | None = None,
) -> DataFrame:
    """The table after upserting pages of one list over ``previous`` (None: no rows yet); ``store`` as for their batch."""
    spec = ingest.MERGES[table]
    batch = batch_of_pages(pages, table, on_missing, on_duplicate, store)
    if previous is None:
        return conform(batch.withColumn(spec.touch, X.timestamp(synced_at)), f"stripe.{table}")
    return merge_by_key(previous, batch, spec, synced_at)


def rejected_rows(pages: DataFrame, table: str) -> DataFrame:
    """Records that a sync with ``on_missing="reject"`` leaves out: page, position, missing fields, the record."""
    return ingest.rejects(landed.records(pages), table).select("page", "position", "missing", "record")


def _check_order(page_per_line: bool, on_duplicate: str) -> None:
    if page_per_line and on_duplicate == "latest":
        raise ValueError("pages of one file have no order, so repeated ids cannot be replayed")


def sync_payments(
    spark: SparkSession,
    landed_dir: str,
    out: str,
    synced_at: dt.datetime,
    previous: str | None = None,
    on_missing: str = "fail",
    on_duplicate: str = "error",
    page_per_line: bool = False,
    by_name: bool = False,
) -> dict[str, int]:
    """Merge landed pages (``landed_dir/customers`` ...) over the ``previous`` tables into ``out``.

    ``out`` must be a new place: the tables being read are never overwritten,
    and a failed or repeated run leaves ``previous`` as it was. Whoever calls
    decides when readers move on to ``out``. With ``on_missing="reject"``
    incomplete records are kept under ``out/rejects``; their numbers are returned.
    """
    if previous is not None and previous.rstrip("/") == out.rstrip("/"):
        raise ValueError("write to a new directory, not over the previous tables")
    _check_order(page_per_line, on_duplicate)
    rejected = {}
    for table in PAYMENT_LISTS:
        pages = landed.read_pages(spark, f"{landed_dir}/{table}", table, page_per_line, by_name)
        before = None if previous is None else read_table(spark, previous, f"stripe.{table}")
        write_table(merged_pages(pages, table, before, synced_at, on_missing, on_duplicate), out, f"stripe.{table}")
        if on_missing == "reject":
            path = f"{out.rstrip('/')}/rejects/{table}"
            rejected_rows(pages, table).write.mode("overwrite").parquet(path)
            rejected[table] = spark.read.parquet(path).count()
    return rejected


def keyed_table(store: str, table: str, buckets: int = 64, file_rows: int = 4_000_000) -> keyed.KeyedTable:
    """A payment table kept as files with key filters under ``store``."""
    return keyed.KeyedTable(path_of(store, f"stripe.{table}"), f"stripe.{table}", ingest.MERGES[table], buckets, file_rows)


def sync_keyed(
    spark: SparkSession,
    landed_dir: str,
    store: str,
    synced_at: dt.datetime,
    on_missing: str = "fail",
    on_duplicate: str = "error",
    page_per_line: bool = False,
    by_name: bool = False,
    buckets: int = 64,
) -> dict[str, int]:
    """Merge landed pages into the keyed tables under ``store``, writing only the files that they touch.

    Each table changes over to its new version at once, and a failed run leaves it as it
    was. Rejected records are kept under ``store/rejects`` and counted, as by ``sync_payments``.
    """
    _check_order(page_per_line, on_duplicate)
    rejected = {}
    for table in PAYMENT_LISTS:
        pages = landed.read_pages(spark, f"{landed_dir}/{table}", table, page_per_line, by_name)
        keyed.merge(spark, keyed_table(store, table, buckets), batch_of_pages(pages, table, on_missing, on_duplicate), synced_at)
        if on_missing == "reject":
            path = f"{store.rstrip('/')}/rejects/{table}"
            rejected_rows(pages, table).write.mode("overwrite").parquet(path)
            rejected[table] = spark.read.parquet(path).count()
    return rejected


def _buckets(spark: SparkSession, name: str) -> int | None:
    """The number of buckets of a catalog table; None if it is not bucketed."""
    found = spark.sql(f"DESCRIBE TABLE EXTENDED {name}").where("col_name = 'Num Buckets'").first()
    return int(found["data_type"]) if found else None


def sync_payment_tables(
    spark: SparkSession,
    landed_dir: str,
    database: str,
    run_id: str,
    synced_at: dt.datetime,
    buckets: int,
    previous_run: str | None = None,
    on_missing: str = "fail",
    on_duplicate: str = "error",
    page_per_line: bool = False,
    by_name: bool = False,
) -> dict[str, int]:
    """The same sync over catalog tables bucketed by id, so a large target is never shuffled.

    Each run writes ``<table>_<run_id>`` and then points the view ``<table>`` at
    it. Repeating a run with the same ids replaces its own tables only. Rejected
    records go to ``<table>_<run_id>_rejects``.
    """
    if previous_run == run_id:
        raise ValueError("a run cannot build on itself")
    _check_order(page_per_line, on_duplicate)
    spark.sql(f"CREATE DATABASE IF NOT EXISTS {database}")
    rejected = {}
    for table in PAYMENT_LISTS:
        pages = landed.read_pages(spark, f"{landed_dir}/{table}", table, page_per_line, by_name)
        earlier = None if previous_run is None else f"{database}.{table}_{previous_run}"
        before = None if earlier is None else spark.table(earlier)
        merged = merged_pages(pages, table, before, synced_at, on_missing, on_duplicate)
        # A merge with a table of as many buckets is laid out like it already.
        laid_out = earlier is not None and _buckets(spark, earlier) == buckets
        save_bucketed(merged, f"{database}.{table}_{run_id}", "id", buckets, laid_out)
        spark.sql(f"CREATE OR REPLACE VIEW {database}.{table} AS SELECT * FROM {database}.{table}_{run_id}")
        if on_missing == "reject":
            name = f"{database}.{table}_{run_id}_rejects"
            rejected_rows(pages, table).write.mode("overwrite").format("parquet").saveAsTable(name)
            rejected[table] = spark.table(name).count()
    return rejected


def needed_tables(only: Collection[str]) -> set[str]:
    """The tables that the results named in ``only`` are built from."""
    return set().union(*(NEEDS.get(name, TABLES) for name in only))


def stored_sources(
    spark: SparkSession, operational: str, payments: str, only: Collection[str] = STORED
) -> Sources:
    """The product tables under one directory and the payment tables under another.

    The latter is what a sync wrote, the keyed tables of a sync or a stream, or the
    snapshots of a stream, of which each table's newest is read. Only tables that ``only``
    needs have to be there.
    """
    needed = needed_tables(only)
    lists = [t for t in PAYMENT_LISTS if f"stripe.{t}" in needed]
    return {
        **parquet_sources(spark, operational, [t for t in OPERATIONAL if t in needed]),
        **{f"stripe.{t}": _payment_table(spark, payments, t) for t in lists},
    }


def _payment_table(spark: SparkSession, payments: str, table: str) -> DataFrame:
    target = keyed_table(payments, table)
    if keyed.current(spark, target) is not None:
        return keyed.read(spark, target)
    return read_table(spark, newest_snapshot(spark, payments, table) or payments, f"stripe.{table}")


def stored_origins(spark: SparkSession, operational: str, payments: str, only: Collection[str] = STORED) -> dict[str, str]:
    """The folders of those ``stored_sources`` that have one: keyed tables have many files, of which versions choose."""
    needed = needed_tables(only)
    origins = {t: path_of(operational, t) for t in OPERATIONAL if t in needed}
    for t in PAYMENT_LISTS:
        if f"stripe.{t}" in needed and keyed.current(spark, keyed_table(payments, t)) is None:
            origins[f"stripe.{t}"] = path_of(newest_snapshot(spark, payments, t) or payments, f"stripe.{t}")
    return origins


def catalog_origins(databases: Mapping[str, str], only: Collection[str] = STORED) -> dict[str, str]:
    """The catalog names of the tables that ``only`` needs; ``databases`` as for ``catalog_sources``."""
    split = {t: t.rpartition(".") for t in TABLES if t in needed_tables(only)}
    return {t: f"{databases[schema]}.{name}" for t, (schema, _, name) in split.items()}


def run(
    spark: SparkSession,
    sources: Sources,
    out: str,
    as_of: dt.date,
    only: Collection[str] = STORED,
    run_id: str | None = None,
    origins: Mapping[str, str] | None = None,
    activity_state: str | None = None,
) -> dict[str, DataFrame]:
    """Build and store what is named in ``only``: the quality report, marts and KPIs.

    Only the tables that these need are read. Registers the staging views;
    returns what was stored, read back. ``out`` is a folder, or with a ``run_id`` a
    catalog database, in which all views change over together once all tables are
    complete. There the staging views are kept too: over the sources' ``origins``, and
    stored for those without one. User metrics come from an ``activity_state``, if given,
    instead of from events.
    """
    unknown = sorted(set(only) - set(STORED))
    if unknown:
        raise ValueError(f"no such table: {', '.join(unknown)}")
    staged = stage(sources)
    register_views(staged)
    frames = {}
    if "data_quality" in only:
        frames["data_quality"] = quality.data_quality(sources)
    if set(only) & set(MARTS):
        unique = True
        if "fct_mrr_by_month" in only:
            keys = Q.key_checks(sources["subscriptions"], "subscriptions", quality.PRIMARY_KEY)
            unique = keys.where((F.col("check") == "unique") & (F.col("violations") > 0)).isEmpty()
        kept = ["fct_user_metrics"] if activity_state is not None and "fct_user_metrics" in only else []
        frames |= build_marts(staged, as_of, unique, [name for name in only if name not in kept])
        for name in kept:
            frames[name] = activity.user_metrics(spark, staged["stg_users"], staged["stg_subscriptions"], activity_state)
    if "kpi_summary" in only:
        frames["kpi_summary"] = kpi.kpi_summary(sources)
    chosen = {name: frames[name] for name in only}
    if run_id is not None:
        loose = {name: df for name, df in staged.items() if origins is not None and staging.SOURCES[name] not in origins}
        release.save(spark, out, run_id, chosen | loose, origins)
        return {name: spark.table(f"{out}.{name}") for name in only}
    write_marts(chosen, out)
    return {name: spark.read.parquet(f"{out}/{name}") for name in only}

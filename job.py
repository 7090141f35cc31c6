"""Jobs for spark-submit.

    spark-submit job.py sync   --landed DIR --out DIR [--previous DIR] --at 2024-06-15T00:00:00
    spark-submit job.py sync   --landed DIR --store DIR --at 2024-06-15T00:00:00
    spark-submit job.py stream --landed DIR --out DIR [--previous DIR] --at 2024-06-15T00:00:00
    spark-submit job.py stream --landed DIR --store DIR --at 2024-06-15T00:00:00
    spark-submit job.py compact --store DIR [--keep VERSIONS]
    spark-submit job.py sync   --landed DIR --database DB --run ID [--previous-run ID] --at 2024-06-15T00:00:00
    spark-submit job.py events --exported DIR --operational DIR
    spark-submit job.py activity --operational DIR --state DIR
    spark-submit job.py build  --operational DIR --payments DIR --out DIR --as-of 2024-06-15 [--only NAME ...]
    spark-submit job.py build  --operational DIR --payments DIR --database DB --run ID --as-of 2024-06-15
    spark-submit job.py build  --operational-database DB --payments-database DB --database DB --run ID --as-of 2024-06-15
    spark-submit job.py counts --operational DIR --payments DIR

The session, with its resources and shared checkpoint folder, comes from the cluster.
"""

from __future__ import annotations

import argparse
import datetime as dt
import os
import sys
from collections.abc import Sequence

from pyspark.sql import SparkSession

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from ledgerlight.plans import activity, kpi, pipeline  # noqa: E402
from ledgerlight.schemas import TABLES  # noqa: E402
from ledgerlight.sources import keyed  # noqa: E402
from ledgerlight.sources.tables import Sources, catalog_sources, conform, write_events_by_day  # noqa: E402
from ledgerlight.streaming.payments import merge_stream, sync_stream  # noqa: E402


def parser() -> argparse.ArgumentParser:
    root = argparse.ArgumentParser(description=__doc__, formatter_class=argparse.RawDescriptionHelpFormatter)
    commands = root.add_subparsers(dest="command", required=True)

    sync = commands.add_parser("sync", help="merge landed pages over the previous payment tables")
    stream = commands.add_parser("stream", help="merge the pages that landed since the last run")
    stream.add_argument("--max-files", type=int)
    for sub, default in ((sync, "error"), (stream, "latest")):
        sub.add_argument("--landed", required=True)
        kept = sub.add_mutually_exclusive_group(required=True)
        kept.add_argument("--out")
        if sub is sync:
            kept.add_argument("--database", help="catalog tables bucketed by id; needs --run")
        kept.add_argument("--store", help="keyed tables, of which a merge writes only the files that it touches")
        sub.add_argument("--buckets", type=int, default=64, help="of catalog tables, and of a store's when they are created")
        sub.add_argument("--at", type=dt.datetime.fromisoformat, required=True)
        sub.add_argument("--on-missing", choices=["fail", "reject"], default="fail")
        sub.add_argument("--on-duplicate", choices=["error", "latest"], default=default)
        sub.add_argument("--previous")
        sub.add_argument("--page-per-line", action="store_true")
        sub.add_argument("--by-name", action="store_true", help="pages follow each other by name, not by time")

    sync.add_argument("--run", help="names this run's catalog tables, behind views of the plain names")
    sync.add_argument("--previous-run")
    stream.add_argument("--compact-after", type=int, default=20, help="delta runs of a store's table")
    compact = commands.add_parser("compact", help="merge the delta runs of a store, and delete versions no longer kept")
    compact.add_argument("--store", required=True)
    compact.add_argument("--keep", type=int)

    events = commands.add_parser("events", help="add exported events to the folders of their days")
    events.add_argument("--exported", required=True)
    events.add_argument("--operational", required=True)
    activity_ = commands.add_parser("activity", help="roll up the days whose event files changed")
    activity_.add_argument("--operational", required=True)
    activity_.add_argument("--state", required=True)

    build = commands.add_parser("build", help="store the quality report, the marts and the KPIs")
    place = build.add_mutually_exclusive_group(required=True)
    place.add_argument("--out")
    place.add_argument("--database", help="a catalog database instead of a folder; needs --run")
    build.add_argument("--run", help="names this run's tables, behind views of the plain names")
    build.add_argument("--activity", help="the state of the activity job, read instead of the events")
    build.add_argument("--as-of", type=dt.date.fromisoformat, required=True)
    build.add_argument("--only", nargs="+", choices=pipeline.STORED, default=pipeline.STORED)
    counts = commands.add_parser("counts", help="print the row count of every table")
    for sub in (build, counts):
        for name in ("operational", "payments"):
            place = sub.add_mutually_exclusive_group(required=True)
            place.add_argument(f"--{name}")
            place.add_argument(f"--{name}-database", help="catalog tables instead of a folder")
    return root


def sources_of(spark: SparkSession, args: argparse.Namespace, only: Sequence[str]) -> tuple[Sources, dict[str, str]]:
    """The sources that a build or count reads, and where they lie."""
    databases = args.operational_database, args.payments_database
    if any(databases):
        if not all(databases):
            raise SystemExit("--operational-database and --payments-database go together")
        named = dict(zip(("", "stripe"), databases))
        return catalog_sources(spark, named, pipeline.needed_tables(only)), pipeline.catalog_origins(named, only)
    folders = args.operational, args.payments
    return pipeline.stored_sources(spark, *folders, only), pipeline.stored_origins(spark, *folders, only)


def main(arguments: list[str] | None = None) -> None:
    args = parser().parse_args(arguments)
    if args.command in ("build", "sync") and bool(args.database) != bool(args.run):
        raise SystemExit("--database and --run go together")
    spark = SparkSession.builder.getOrCreate()
    if args.command in ("sync", "stream") and args.store and args.previous:
        raise SystemExit("a store goes on from itself, not from --previous")
    if args.command == "sync":
        how = (args.on_missing, args.on_duplicate, args.page_per_line, args.by_name)
        if args.store:
            rejected = pipeline.sync_keyed(spark, args.landed, args.store, args.at, *how, args.buckets)
        elif args.database:
            rejected = pipeline.sync_payment_tables(
                spark, args.landed, args.database, args.run, args.at, args.buckets, args.previous_run, *how
            )
        else:
            rejected = pipeline.sync_payments(spark, args.landed, args.out, args.at, args.previous, *how)
        for table, count in rejected.items():
            place = f"{args.store or args.out}/rejects/{table}" if not args.database else f"{args.database}.{table}_{args.run}_rejects"
            print(f"{count} records of {table} rejected, kept under {place}")
    elif args.command == "stream":
        for table in pipeline.PAYMENT_LISTS:
            how = {
                "max_files": args.max_files, "on_missing": args.on_missing, "on_duplicate": args.on_duplicate,
                "page_per_line": args.page_per_line, "by_name": args.by_name,
            }
            if args.store:
                query = merge_stream(
                    spark, args.landed, table, args.store, args.at, **how, compact_after=args.compact_after, buckets=args.buckets
                )
            else:
                query = sync_stream(spark, args.landed, table, args.out, args.at, **how, previous=args.previous)
            query.awaitTermination()
    elif args.command == "compact":
        for table in pipeline.PAYMENT_LISTS:
            target = pipeline.keyed_table(args.store, table)
            keyed.compact(spark, target)
            if args.keep:
                keyed.vacuum(spark, target, args.keep)
    elif args.command == "events":
        exported = conform(spark.read.schema(TABLES["events"]).parquet(args.exported), "events")
        write_events_by_day(exported, args.operational, mode="append")
    elif args.command == "activity":
        print(f"{len(activity.update(spark, args.operational, args.state))} days rolled up")
    else:
        only = args.only if args.command == "build" else pipeline.STORED
        sources, origins = sources_of(spark, args, only)
        if args.command == "build":
            pipeline.run(spark, sources, args.database or args.out, args.as_of, only, args.run, origins, args.activity)
        else:
            kpi.table_counts(sources).show(truncate=False)


if __name__ == "__main__":
    main()

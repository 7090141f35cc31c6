"""The payment sync as a stream: pages are merged as they land, each page once.

``sync_stream`` writes a snapshot of the table per micro-batch. ``merge_stream`` appends
what a micro-batch brings to a keyed table, whose readers merge it, and whose files are
merged once enough of such runs wait.
"""

from __future__ import annotations

import datetime as dt
import hashlib

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery

from ledgerlight.plans.pipeline import batch_of_pages, keyed_table, merged_pages, rejected_rows
from ledgerlight.schemas import envelope
from ledgerlight.sources.landed import STRICT, named_pages
from ledgerlight.sources import keyed
from ledgerlight.sources.tables import note_snapshot, path_exists, read_table, snapshot, write_table


def checkpoint_location(spark: SparkSession, table: str, snapshots: str, given: str | None = None) -> str:
    """Where a stream keeps its progress: ``given``, or a folder of its own in the cluster's checkpoint folder.

    The name belongs to the output, so that two streams never share their progress.
    """
    if given is not None:
        return given
    shared = spark.conf.get("spark.checkpoint.dir", None)
    if not shared:
        raise ValueError("name a checkpoint folder, or set spark.checkpoint.dir")
    output = hashlib.md5(snapshots.rstrip("/").encode()).hexdigest()[:16]
    return f"{shared.rstrip('/')}/sync_{table}_{output}"


def _landing_pages(
    spark: SparkSession, landed_dir: str, table: str, max_files: int | None, page_per_line: bool, by_name: bool
) -> DataFrame:
    reader = spark.readStream.schema(envelope(table)).options(**STRICT)
    if not page_per_line:
        reader = reader.option("multiLine", True)
    if max_files is not None:
        reader = reader.option("maxFilesPerTrigger", max_files)
    return named_pages(reader.json(f"{landed_dir}/{table}"), by_name)


def sync_stream(
    spark: SparkSession,
    landed_dir: str,
    table: str,
    snapshots: str,
    synced_at: dt.datetime,
    checkpoint: str | None = None,
    max_files: int | None = None,
    on_missing: str = "fail",
    on_duplicate: str = "latest",
    previous: str | None = None,
    page_per_line: bool = False,
    by_name: bool = False,
) -> StreamingQuery:
    """Merge every page of ``landed_dir/<table>`` not merged by an earlier run, then stop.

    Micro-batch n reads snapshot n - 1 and writes snapshot n, so repeating a
    batch after a failure gives the same snapshot; the first one starts from the
    ``previous`` tables, if given. A key that comes twice in a batch is replayed in
    page order. Rejected records are kept under ``<snapshots>/<n>/rejects``. Each
    batch rewrites the table: prefer few large batches. The newest snapshot is
    noted for ``newest_snapshot``, and is also the view ``stripe_<table>``.
    """
    if page_per_line and on_duplicate == "latest":
        raise ValueError("pages of one file have no order, so repeated ids cannot be replayed")
    progress = checkpoint_location(spark, table, snapshots, checkpoint)
    name = f"stripe.{table}"
    if not path_exists(spark, progress) and path_exists(spark, f"{snapshots.rstrip('/')}/finished/{table}"):
        raise ValueError(f"{snapshots} has snapshots of {table}, but {progress} has no progress to go on from")
    pages = _landing_pages(spark, landed_dir, table, max_files, page_per_line, by_name)

    def merge_batch(batch: DataFrame, epoch: int) -> None:
        session = batch.sparkSession
        folder = snapshot(snapshots, epoch - 1) if epoch > 0 else previous
        before = None if folder is None else read_table(session, folder, name)
        merged = merged_pages(batch, table, before, synced_at, on_missing, on_duplicate)
        write_table(merged, snapshot(snapshots, epoch), name)
        if on_missing == "reject":
            rejected = rejected_rows(batch, table)
            rejected.write.mode("overwrite").parquet(f"{snapshot(snapshots, epoch)}/rejects/{table}")
        note_snapshot(session, snapshots, table, epoch)
        # in the caller's session: the stream runs in a copy of it
        read_table(spark, snapshot(snapshots, epoch), name).createOrReplaceTempView(f"stripe_{table}")

    return (
        pages.writeStream.foreachBatch(merge_batch)
        .option("checkpointLocation", progress)
        .trigger(availableNow=True)
        .start()
    )


def merge_stream(
    spark: SparkSession,
    landed_dir: str,
    table: str,
    store: str,
    synced_at: dt.datetime,
    checkpoint: str | None = None,
    max_files: int | None = None,
    on_missing: str = "fail",
    on_duplicate: str = "latest",
    page_per_line: bool = False,
    by_name: bool = False,
    compact_after: int = 20,
    buckets: int = 64,
) -> StreamingQuery:
    """Merge every page of ``landed_dir/<table>`` not merged yet into the keyed table under ``store``, then stop.

    A micro-batch becomes a delta run: it neither reads nor writes the table's other rows,
    and a batch repeated after a failure is appended once. With ``compact_after`` runs, all
    of them are merged into the files that they touch. Rejected records are kept under
    ``<store>/rejects/<table>/<n>``. Starting over with a new checkpoint is refused.
    """
    if page_per_line and on_duplicate == "latest":
        raise ValueError("pages of one file have no order, so repeated ids cannot be replayed")
    progress = checkpoint_location(spark, table, store, checkpoint)
    target = keyed_table(store, table, buckets)
    known = keyed.current(spark, target)
    if not path_exists(spark, progress) and known is not None and known.epoch is not None:
        raise ValueError(f"{store} has a stream's rows of {table}, but {progress} has no progress to go on from")
    pages = _landing_pages(spark, landed_dir, table, max_files, page_per_line, by_name)

    def append_batch(batch: DataFrame, epoch: int) -> None:
        session = batch.sparkSession
        if on_missing == "reject":
            rejected_rows(batch, table).write.mode("overwrite").parquet(f"{store.rstrip('/')}/rejects/{table}/{epoch}")
        rows = batch_of_pages(batch, table, on_missing, on_duplicate)
        keyed.append(session, target, rows, synced_at, epoch)
        if keyed.delta_runs(session, target) >= compact_after:
            keyed.compact(session, target)

    return (
        pages.writeStream.foreachBatch(append_batch)
        .option("checkpointLocation", progress)
        .trigger(availableNow=True)
        .start()
    )

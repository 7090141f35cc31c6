"""The command-line jobs, end to end on small landed files."""

from __future__ import annotations

import pytest

import job
import rows as R
from ledgerlight.sources import tables
from test_ingest import land_day


def test_sync_build_counts(spark, tmp_path, capsys):
    land_day(tmp_path / "one", "one")
    land_day(tmp_path / "two", "two")
    ops, v1, v2, out = (str(tmp_path / n) for n in ("ops", "v1", "v2", "out"))
    tables.write_table(R.users(spark, R.USERS), ops, "users")
    tables.write_table(R.subscriptions(spark, R.SUBSCRIPTIONS), ops, "subscriptions")
    tables.write_table(R.events(spark, R.EVENTS), ops, "events")
    tables.write_table(tables.empty(spark, "stripe_charges"), ops, "stripe_charges")

    job.main(["sync", "--landed", str(tmp_path / "one"), "--out", v1, "--at", "2024-01-01T00:00:00"])
    job.main(
        ["sync", "--landed", str(tmp_path / "two"), "--out", v2, "--previous", v1, "--at", "2024-02-01T00:00:00"]
    )
    assert tables.read_table(spark, v2, "stripe.customers").count() == 3

    where = ["--operational", ops, "--payments", v2]
    job.main(["build", *where, "--out", out, "--as-of", "2024-06-15", "--only", "fct_mrr_by_month"])
    assert spark.read.parquet(f"{out}/fct_mrr_by_month").count() == 3
    job.main(["counts", *where])
    shown = capsys.readouterr().out
    assert "stripe.customers" in shown and "26" in shown


def test_stream_job_keeps_its_progress_in_the_shared_folder(spark, tmp_path):
    land_day(tmp_path / "in", "one")
    arguments = ["stream", "--landed", str(tmp_path / "in"), "--out", str(tmp_path / "snapshots"), "--at",
                 "2024-01-01T00:00:00"]
    job.main(arguments)
    assert spark.table("stripe_customers").count() == 2
    assert spark.table("stripe_invoices").count() == 1
    job.main(arguments)
    assert spark.table("stripe_customers").count() == 2


def test_arguments_are_checked():
    with pytest.raises(SystemExit):
        job.main(["build", "--out", "x"])

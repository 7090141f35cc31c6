"""Activity per day: equal to the full mart, with only changed days read."""

from __future__ import annotations

import datetime as dt

import job
import rows as R
from ledgerlight.plans import activity, marts, staging
from ledgerlight.sources.tables import path_exists, write_events_by_day, write_table


def staged(spark):
    return staging.stg_users(R.users(spark, R.USERS)), staging.stg_subscriptions(R.subscriptions(spark, R.SUBSCRIPTIONS))


def check(spark, state, events):
    want = marts.user_metrics(*staged(spark), staging.stg_events(R.events(spark, events)))
    got = activity.user_metrics(spark, *staged(spark), state)
    assert got.schema == want.schema
    assert sorted(map(repr, got.collect())) == sorted(map(repr, want.collect()))


def day(n):
    return dt.date(2024, 2, n)


def test_updates_read_changed_days_and_equal_the_full_mart(spark, tmp_path):
    base, state = str(tmp_path / "ops"), str(tmp_path / "state")
    write_events_by_day(R.events(spark, R.EVENTS), base)
    assert sorted(activity.update(spark, base, state)) == [day(n) for n in range(1, 21)]
    check(spark, state, R.EVENTS)
    assert activity.update(spark, base, state) == []

    # a new day, a late event, a user without an id and an event without a time
    more = [(400, 2, "2024-03-01 09:00"), (401, 3, "2024-02-04 00:00"), (402, None, "2024-03-02 00:00"), (403, 2, None)]
    write_events_by_day(R.events(spark, more), base, mode="append")
    plan = activity.events_of_days(spark, base, [day(4), None])._jdf.queryExecution().executedPlan().toString()
    filters = plan.split("PartitionFilters: [")[1].split("]")[0]
    assert "2024-02-04" in filters and "isnull(event_date" in filters
    changed = activity.update(spark, base, state)
    assert sorted(d for d in changed if d) == [day(4), dt.date(2024, 3, 1), dt.date(2024, 3, 2)] and None in changed
    check(spark, state, R.EVENTS + more)
    run = activity._newest(spark, state)
    stored = {r["event_date"] for r in spark.read.schema(activity.DAYS).parquet(f"{state}/days").where(f"run = {run}").collect()}
    assert stored == {day(4), dt.date(2024, 3, 1), None}  # the others stay as they were
    scan = activity.read(spark, state)._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters" in scan and "run" in scan.split("PartitionFilters: [")[1].split("\n")[0]


def test_a_failed_run_is_repeated(spark, tmp_path, monkeypatch):
    base, state = str(tmp_path / "ops"), str(tmp_path / "state")
    write_events_by_day(R.events(spark, R.EVENTS), base)
    activity.update(spark, base, state)
    write_events_by_day(R.events(spark, [(500, 1, "2024-02-01 23:00")]), base, mode="append")
    calls = []

    def fail(*_):
        calls.append(1)
        raise OSError("lost")

    with monkeypatch.context() as m:
        m.setattr(activity, "_among_day", fail)  # after the days are written, before the manifest
        try:
            activity.update(spark, base, state)
        except OSError:
            pass
    assert calls and path_exists(spark, f"{state}/days/run=2")
    check(spark, state, R.EVENTS)
    assert activity.update(spark, base, state) == [day(1)]
    check(spark, state, R.EVENTS + [(500, 1, "2024-02-01 23:00")])


def test_days_that_vanish_no_longer_count(spark, tmp_path):
    base, state = str(tmp_path / "ops"), str(tmp_path / "state")
    write_events_by_day(R.events(spark, R.EVENTS), base)
    activity.update(spark, base, state)
    write_events_by_day(R.events(spark, R.EVENTS[:3]), base)  # drop and reload
    activity.update(spark, base, state)
    check(spark, state, R.EVENTS[:3])


def test_a_state_without_runs_is_empty(spark, tmp_path):
    check(spark, str(tmp_path / "state"), [])


def test_jobs(spark, tmp_path, capsys):
    base, state, out = (str(tmp_path / n) for n in ("ops", "state", "out"))
    write_table(R.users(spark, R.USERS), base, "users")
    write_table(R.subscriptions(spark, R.SUBSCRIPTIONS), base, "subscriptions")
    for name, some in (("one", R.EVENTS[:10]), ("two", R.EVENTS[10:])):
        R.events(spark, some).write.parquet(str(tmp_path / name))
        job.main(["events", "--exported", str(tmp_path / name), "--operational", base])
        job.main(["activity", "--operational", base, "--state", state])
    assert "10 days rolled up" in capsys.readouterr().out
    job.main(["build", "--operational", base, "--payments", "none", "--out", out, "--as-of", "2024-06-15", "--only", "fct_user_metrics", "--activity", state])
    want = marts.user_metrics(*staged(spark), staging.stg_events(R.events(spark, R.EVENTS)))
    assert sorted(map(repr, spark.read.parquet(f"{out}/fct_user_metrics").collect())) == sorted(map(repr, want.collect()))

"""Column expressions shared by the plans. All of them compile to JVM code.

Times are ``timestamp_ntz`` holding UTC wall time, so no result depends on the
session time zone.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column
from pyspark.sql import functions as F

MONEY = "decimal(12,2)"
MONEY_SUM = "decimal(20,2)"
SECOND = "INTERVAL '1' SECOND"


def month(ts: Column) -> Column:
    """First day of the month, as a date."""
    # date_trunc would turn a zone-less timestamp into a zoned one
    return F.trunc(ts.cast("date"), "month")


def day(ts: Column) -> Column:
    return ts.cast("date")


def whole_days_sql(later: str, earlier: str) -> str:
    return f"CAST(extract(DAY FROM {later} - {earlier}) AS BIGINT)"


def whole_days(later: Column, earlier: Column) -> Column:
    """Full 24-hour days between two timestamps, truncated toward zero."""
    return F.extract(F.lit("DAY"), later - earlier).cast("bigint")


def from_epoch_sql(seconds: str) -> str:
    """Epoch seconds as UTC wall time."""
    return f"TIMESTAMP_NTZ '1970-01-01 00:00:00' + {seconds} * {SECOND}"


def from_epoch(seconds: Column) -> Column:
    """Epoch seconds as UTC wall time."""
    return F.expr("TIMESTAMP_NTZ '1970-01-01 00:00:00'") + seconds * F.expr(SECOND)


def to_epoch(ts: Column) -> Column:
    """Epoch seconds of a UTC wall time."""
    return F.unix_timestamp(ts)


def timestamp(value: dt.date | dt.datetime) -> Column:
    """Zone-less timestamp literal; a plain date means its midnight."""
    if isinstance(value, dt.datetime):
        if value.tzinfo is not None:
            value = value.astimezone(dt.timezone.utc).replace(tzinfo=None)
        return F.lit(value.isoformat(sep=" ")).cast("timestamp_ntz")
    return F.lit(value).cast("timestamp_ntz")


def epoch_seconds(value: dt.date | dt.datetime) -> int:
    """Epoch seconds of a date's midnight or of a timestamp, read as UTC."""
    if not isinstance(value, dt.datetime):
        value = dt.datetime(value.year, value.month, value.day)
    if value.tzinfo is None:
        value = value.replace(tzinfo=dt.timezone.utc)
    return int(value.timestamp())


def as_date(value: dt.date | dt.datetime) -> dt.date:
    return value.date() if isinstance(value, dt.datetime) else value


def units_sql(cents: str) -> str:
    """Integer cents as exact currency units."""
    return f"CAST(CAST({cents} AS DECIMAL(18,0)) / CAST(100 AS DECIMAL(3,0)) AS {MONEY})"


def units(cents: Column, decimal_type: str = MONEY) -> Column:
    """Integer cents as exact currency units."""
    return (cents.cast("decimal(18,0)") / F.lit(100).cast("decimal(3,0)")).cast(decimal_type)


def to_cents(amount: Column) -> Column:
    """Currency units back to integer cents, so that sums run on longs."""
    return (amount * 100).cast("bigint")


def rounded_ratio(numerator: Column, denominator: Column, digits: int) -> Column:
    """numerator / denominator rounded half away from zero; NULL when the denominator is 0.

    Works on integers, so no intermediate rounding can move a tie.
    """
    scale = 10**digits
    n = numerator.cast("bigint") * (2 * scale)
    d = F.nullif(denominator.cast("bigint"), F.lit(0))
    magnitude = F.call_function("div", F.abs(n) + d, d * 2)
    signed = F.when(n < 0, -magnitude).otherwise(magnitude)
    return (signed.cast("decimal(18,0)") / F.lit(scale)).cast(f"decimal(18,{digits})")


def percent(part: Column, whole: Column) -> Column:
    """100 * part / whole to two digits."""
    return rounded_ratio(part * 100, whole, 2)


def is_active_sql(status: str) -> str:
    """Never NULL: an unknown status is inactive."""
    return f"coalesce({status} = 'active', false)"


def hashed_id(prefix: str, *parts: Column) -> Column:
    """Deterministic id: prefix and the first 24 hex digits of an md5."""
    digest = F.md5(F.concat(*[p.cast("string") for p in parts]))
    return F.concat(F.lit(prefix), F.substring(digest, 1, 24))

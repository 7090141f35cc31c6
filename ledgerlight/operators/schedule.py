"""Expansion of subscriptions into billing periods of fixed length."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

PERIOD_DAYS = 30
PERIOD_SECONDS = PERIOD_DAYS * 86_400


def period_starts(start: Column, end: Column, step: Column, tick: Column) -> Column:
    """Array ``start, start + step, ...`` below ``end``, for rows with ``start < end``.

    ``tick`` is the smallest step of the time type and makes the inclusive
    ``sequence`` stop short of ``end``. Other rows must be filtered out; their
    bounds are still kept in order, because Spark may evaluate an expression
    ahead of the filter and ``sequence`` raises on reversed bounds.
    """
    return F.sequence(start, F.greatest(start, end - tick), step)


def expand_periods(
    subscriptions: DataFrame, start: Column, end: Column, step: Column, tick: Column
) -> DataFrame:
    """One row per period start, with ``period_no`` from 0 and ``period_at``.

    The expansion is per row: no shuffle, and a row's array is bounded by its
    span. After the filter no array is empty, so the outer form changes nothing;
    it spares an inferred size() filter that would build every array twice.
    """
    starts = period_starts(start, end, step, tick)
    return subscriptions.where(start < end).select(
        "*", F.posexplode_outer(starts).alias("period_no", "period_at")
    )

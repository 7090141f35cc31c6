"""Counting over active periods without pairing periods with months.

An active period runs from ``start_m`` up to but not including ``end_m``
(NULL: still running). Both are month starts. Instead of one row per period and
month, the totals of each month come from what starts and ends in it.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

OPEN_END = "DATE '9999-12-01'"


def uncovered_parts(spans: DataFrame, key: str) -> DataFrame:
    """Disjoint periods per ``key`` that cover the same months as ``spans``.

    Of the periods a key starts in one month only the longest matters, so the
    first aggregation leaves at most one row per key and month, however many
    rows a hot key has; the window then runs over that bounded set.
    """
    longest = (
        spans.where(F.col(key).isNotNull())
        .groupBy(key, "start_m")
        .agg(F.max(F.coalesce("end_m", F.expr(OPEN_END))).alias("end_m"))
    )
    earlier = (
        Window.partitionBy(key).orderBy("start_m").rowsBetween(Window.unboundedPreceding, -1)
    )
    return (
        longest.withColumn("covered_to", F.max("end_m").over(earlier))
        .withColumn("start_m", F.greatest("start_m", "covered_to"))
        .where(F.col("start_m") < F.col("end_m"))
        .select(
            key,
            "start_m",
            F.when(F.col("end_m") < F.expr(OPEN_END), F.col("end_m")).alias("end_m"),
        )
    )


def monthly_changes(grouped: DataFrame, measures: list[str]) -> DataFrame:
    """Rows (month, is_start, measures): plus at ``start_m``, minus at ``end_m``.

    ``grouped`` should already be aggregated to (start_m, end_m, ...): its size
    is then bounded by the number of month pairs, not by the data. A period
    without an end gives a row without a month, which ``monthly_totals`` drops.
    """
    plus, minus = ", ".join(measures), ", ".join(f"-{m}" for m in measures)
    names = ", ".join(["month", "is_start", *measures])
    return grouped.selectExpr(f"stack(2, start_m, 1, {plus}, end_m, 0, {minus}) AS ({names})")


def distinct_key_changes(spans: DataFrame, key: str, name: str) -> DataFrame:
    """Monthly changes in the number of distinct active keys."""
    grouped = uncovered_parts(spans, key).groupBy("start_m", "end_m").agg(F.count(F.lit(1)).alias(name))
    return monthly_changes(grouped, [name]).drop("is_start")


def monthly_totals(changes: list[DataFrame], measures: list[str]) -> DataFrame:
    """Changes of several measures added up and run forward: one row per month.

    ``is_start`` is 1 for months in which something starts. The window has no
    partition key; its input is one row per month.
    """
    together = reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), changes)
    upto = Window.orderBy("month").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    return (
        together.where(F.col("month").isNotNull())
        .groupBy("month")
        .agg(F.max("is_start").alias("is_start"), *[F.sum(m).alias(m) for m in measures])
        .select(
            "month",
            "is_start",
            *[F.coalesce(F.sum(m).over(upto), F.lit(0)).alias(m) for m in measures],
        )
    )

"""Ordered lists: top-k, keyset pages and the list envelope."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def top(df: DataFrame, order: list[Column], limit: int) -> DataFrame:
    """First ``limit`` rows in a total order (a TakeOrderedAndProject, no global sort)."""
    return df.orderBy(*order).limit(limit)


def page_after(df: DataFrame, key: str, cursor: str | None, limit: int) -> DataFrame:
    """The ``limit`` rows after ``cursor`` in ``key`` order, with ``has_more``.

    A cursor that is not in ``df`` gives the first page. ``key`` is unique.
    """
    rows = df
    if cursor:
        # The string right after the cursor is cursor + U+0000; an unknown
        # cursor yields '', which every key reaches. As a scalar subquery this
        # is one key lookup, and the bound reaches the scan as a plain filter.
        bound = (
            df.where(F.col(key) == cursor)
            .agg(F.coalesce(F.concat(F.max(key), F.lit("\u0000")), F.lit("")).alias("bound"))
            .scalar()
        )
        rows = df.where(F.col(key) >= bound)
    # One row beyond the page tells whether more follow; the windows below see
    # at most limit + 1 rows.
    in_order = Window.orderBy(key)
    return (
        top(rows, [F.col(key)], limit + 1)
        .select(
            "*",
            F.row_number().over(in_order).alias("_rank"),
            (F.count(F.lit(1)).over(Window.partitionBy()) > limit).alias("has_more"),
        )
        .where(F.col("_rank") <= limit)
        .drop("_rank")
    )


def envelope(page: DataFrame, url: str, order: list[Column]) -> DataFrame:
    """A page as one list object: ``object``, ``data``, ``has_more``, ``url``.

    The input is one page, so the single output row is bounded by its limit.
    """
    fields = [c for c in page.columns if c != "has_more"]
    has_more = F.col("has_more") if "has_more" in page.columns else F.lit(False)
    ranked = page.select(
        F.struct(F.row_number().over(Window.orderBy(*order)).alias("rank"), *fields).alias("item"),
        has_more.alias("more"),
    )
    return ranked.agg(
        F.array_sort(F.collect_list("item")).alias("items"),
        F.coalesce(F.max("more"), F.lit(False)).alias("has_more"),
    ).select(
        F.lit("list").alias("object"),
        F.transform("items", lambda i: F.struct(*[i[f].alias(f) for f in fields])).alias("data"),
        "has_more",
        F.lit(url).alias("url"),
    )

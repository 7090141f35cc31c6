"""List queries over the payment tables, as the provider's API answers them.

An empty filter value means no filter. Orders are total, so a list is the same
on every run.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerlight.operators import paging

DEFAULT_LIMIT = 100


def _matching(df: DataFrame, column: str, value: str | None) -> DataFrame:
    return df.where(F.col(column) == value) if value else df


def list_customers_page(
    customers: DataFrame, starting_after: str | None = None, limit: int = DEFAULT_LIMIT
) -> DataFrame:
    """Customers after a given id, in id order, with ``has_more``."""
    return paging.page_after(customers, "id", starting_after, limit)


def list_subscriptions(
    subscriptions: DataFrame, status: str | None = None, limit: int = DEFAULT_LIMIT
) -> DataFrame:
    return paging.top(_matching(subscriptions, "status", status), [F.col("id").asc()], limit)


def _newest(df: DataFrame, customer: str | None, limit: int) -> DataFrame:
    order = [F.col("created").desc(), F.col("id").asc()]
    return paging.top(_matching(df, "customer_id", customer), order, limit)


def list_charges(charges: DataFrame, customer: str | None = None, limit: int = DEFAULT_LIMIT) -> DataFrame:
    """Newest charges, optionally of one customer."""
    return _newest(charges, customer, limit)


def list_invoices(invoices: DataFrame, customer: str | None = None, limit: int = DEFAULT_LIMIT) -> DataFrame:
    """Newest invoices, optionally of one customer."""
    return _newest(invoices, customer, limit)

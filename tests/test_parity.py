"""Every registered query against its oracle, on the smallest test tables."""

from __future__ import annotations

import pytest

import __spark_entry__ as driver
import parity

SF_DIR = "/root/testdata/sf0.001"


# The optional training-data operators have tests of their own.
OPTIONAL = set(driver._training_data_queries())
QUERIES = sorted(set(driver.queries()) - OPTIONAL)


@pytest.fixture(scope="module")
def con():
    return parity.connect(SF_DIR)


def test_every_query_has_an_oracle():
    assert set(QUERIES) == set(driver.oracle_sql()) - OPTIONAL


@pytest.mark.parametrize("name", QUERIES)
def test_parity(spark, con, name):
    rows = parity.compare(driver.queries()[name](spark, SF_DIR), con, driver.oracle_sql()[name])
    assert rows > 0


def test_entry_is_lazy_and_has_rows(spark):
    assert driver.entry(spark).count() == 81

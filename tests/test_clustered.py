"""Pages of tables stored in order: the same rows, from few files."""

from __future__ import annotations

import pytest

from ledgerlight.operators import paging
from ledgerlight.sources import clustered as C

SCHEMA = "id string, n long"


@pytest.fixture(scope="module")
def stored(spark, tmp_path_factory):
    path = str(tmp_path_factory.mktemp("clustered") / "rows")
    df = spark.range(6400).selectExpr("concat('k', lpad(cast(id * 7 % 6400 as string), 5, '0')) AS id", "id AS n")
    C.write(df, path, "id", 64)
    return path, df.cache()


def key(i):
    return f"k{i:05d}"


@pytest.mark.parametrize("cursor", [None, "", key(0), key(57), key(99), key(3199), key(6390), key(6399), "k", "unknown", "zzz", "a"])
def test_a_page_equals_the_plain_one_and_reads_two_files(spark, stored, cursor):
    path, df = stored
    got = C.page_after(spark, path, SCHEMA, "id", cursor, 20)
    assert sorted(map(tuple, got.collect())) == sorted(map(tuple, paging.page_after(df, "id", cursor, 20).collect()))
    files, _ = C.page_files(spark, path, SCHEMA, "id", cursor, 20)
    assert len(files) <= 2 and C.boundaries(spark, path).count() == 64


def test_cursors_at_file_ends(spark, stored):
    path, df = stored
    for r in C.boundaries(spark, path).orderBy("low").limit(3).collect():
        for cursor in (r["low"], r["high"]):
            got = C.page_after(spark, path, SCHEMA, "id", cursor, 5)
            assert sorted(map(tuple, got.collect())) == sorted(map(tuple, paging.page_after(df, "id", cursor, 5).collect()))


def test_many_cursors_in_one_job(spark, stored):
    path, df = stored
    cursors = spark.range(10_000).selectExpr("concat('k', lpad(cast(id as string), 5, '0')) AS cursor")
    pages = C.pages_after(spark, path, SCHEMA, "id", cursors, 3)
    plan = pages._jdf.queryExecution().executedPlan().toString()
    assert "NestedLoop" not in plan and "Cartesian" not in plan
    found = {}
    for r in pages.collect():
        found.setdefault(r["cursor"], []).append((r["rank"], r["id"], r["has_more"]))
    assert len(found) == 10_000 - 1  # after the last row there is nothing
    for i in range(10_000):
        start = i + 1 if i < 6400 else 0
        want = [(j - start + 1, key(j), start + 3 < 6400) for j in range(start, min(start + 3, 6400))]
        assert sorted(found.get(key(i), [])) == want


def test_odd_tables(spark, tmp_path):
    empty = spark.createDataFrame([], SCHEMA)
    C.write(empty, str(tmp_path / "none"), "id", 3)
    assert C.page_after(spark, str(tmp_path / "none"), SCHEMA, "id", "x", 3).count() == 0
    cursors = spark.createDataFrame([("x",)], "cursor string")
    assert C.pages_after(spark, str(tmp_path / "none"), SCHEMA, "id", cursors, 3).count() == 0
    with pytest.raises(Exception, match="NULL"):
        C.write(spark.createDataFrame([(None, 1)], SCHEMA), str(tmp_path / "null"), "id", 3)

"""Releases: marts and staging views of a catalog database that change over together.

Each stored result is a table ``<name>_runs`` with a partition per release, behind a view
``<name>`` that shows the partition of the newest release in the table ``releases``. That
table is the manifest of all views: adding one row to it publishes a release, in one
commit of one file, and until then every view shows the release before. The release is
looked up when a view is read, and only that partition's files are.

Staging views are views over the sources. Where a release has other sources than the one
before, they first become unions of both, of which the manifest shows one; once published,
views over the new sources alone. A failure between any two steps leaves all views on one
release. Sources without a place of their own in the catalog or the file system (keyed
tables, whose files change with each merge) have their staging view stored like a mart.
"""

from __future__ import annotations

import hashlib
from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession

from ledgerlight.plans import staging
from ledgerlight.schemas import TABLES
from ledgerlight.sources.tables import exists

MANIFEST = "number BIGINT, release STRING, sources STRING"
RUN = "release_run"  # the partition column


def _run(spark: SparkSession, statement: str) -> None:
    """Every change of the catalog but rows of results passes here."""
    spark.sql(statement)


def _insert(df: DataFrame, table: str, release: str) -> None:
    """Replace a release's partition. (Overwriting from a frame would replace all partitions of a catalog table.)"""
    rows = "release_rows"
    df.createOrReplaceTempView(rows)
    try:
        columns = ", ".join(f"`{c}`" for c in df.columns)
        df.sparkSession.sql(f"INSERT OVERWRITE TABLE {table} PARTITION ({RUN} = '{release}') SELECT {columns} FROM {rows}")
    finally:
        df.sparkSession.catalog.dropTempView(rows)


def _newest(database: str, column: str) -> str:
    return f"(SELECT max_by({column}, number) FROM {database}.releases)"


def current(spark: SparkSession, database: str) -> tuple[str, str] | None:
    """The newest release and the id of its sources; None before the first one."""
    if not exists(spark, f"{database}.releases"):
        return None
    found = spark.sql(f"SELECT max_by(release, number) AS release, max_by(sources, number) AS sources FROM {database}.releases").first()
    return None if found["release"] is None else (found["release"], found["sources"])


def sources_id(origins: Mapping[str, str]) -> str:
    """A name for a set of places that sources come from."""
    told = "\n".join(f"{table} {origin}" for table, origin in sorted(origins.items()))
    return hashlib.md5(told.encode()).hexdigest()[:12]


def _relation(database: str, table: str, sources: str) -> str:
    return f"{database}.src_{table.replace('.', '_')}_{sources}"


def _qualified(spark: SparkSession, folder: str) -> str:
    place = spark._jvm.org.apache.hadoop.fs.Path(folder)
    return place.getFileSystem(spark._jsc.hadoopConfiguration()).makeQualified(place).toString()


def _register_sources(spark: SparkSession, database: str, origins: Mapping[str, str], sources: str) -> None:
    """Make each source a table or view of the database; an origin is a folder of Parquet files, or a catalog name."""
    for table, origin in origins.items():
        name = _relation(database, table, sources)
        if "/" in origin:
            _run(spark, f"CREATE TABLE IF NOT EXISTS {name} ({TABLES[table]}) USING parquet LOCATION '{_qualified(spark, origin)}'")
        else:
            _run(spark, f"CREATE VIEW IF NOT EXISTS {name} AS SELECT * FROM {origin}")


def _store(database: str, name: str, df: DataFrame, release: str) -> None:
    """A result as its table's partition of this release, which no view shows yet."""
    spark, table = df.sparkSession, f"{database}.{name}_runs"
    columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in df.schema)
    _run(spark, f"CREATE TABLE IF NOT EXISTS {table} ({columns}, {RUN} STRING) USING parquet PARTITIONED BY ({RUN})")
    known = [(f.name, f.dataType) for f in spark.table(table).schema][:-1]
    if known != [(f.name, f.dataType) for f in df.schema]:
        raise ValueError(f"{table} has other columns than this release of {name}")
    _insert(df, table, release)
    shown = ", ".join(f"`{c}`" for c in df.columns)
    _run(spark, f"CREATE VIEW IF NOT EXISTS {database}.{name} AS SELECT {shown} FROM {table} WHERE {RUN} = {_newest(database, 'release')}")


def _gated(database: str, view: str, sources: str) -> str:
    query = staging.view_sql(view, _relation(database, staging.SOURCES[view], sources))
    return f"{query} WHERE {_newest(database, 'sources')} = '{sources}'"


def save(
    spark: SparkSession, database: str, release: str, frames: Mapping[str, DataFrame], origins: Mapping[str, str] | None = None
) -> None:
    """Store the results as a release, and point all views at it at once.

    ``origins`` tells where sources lie; their staging views become views of the database.
    Repeating a release replaces its own partitions only.
    """
    if not release.replace("_", "").replace("-", "").isalnum():
        raise ValueError(f"a release is named by letters, digits, _ and -, not {release!r}")
    origins = dict(origins or {})
    sources = sources_id(origins)
    _run(spark, f"CREATE DATABASE IF NOT EXISTS {database}")
    _run(spark, f"CREATE TABLE IF NOT EXISTS {database}.releases ({MANIFEST}) USING parquet")
    before = current(spark, database)
    for name, df in frames.items():
        _store(database, name, df, release)
    _register_sources(spark, database, origins, sources)
    views = [v for v, table in staging.SOURCES.items() if table in origins]
    moved = before is None or before[1] != sources
    if moved:
        for view in views:
            parts = [_gated(database, view, sources)]
            if before is not None and exists(spark, _relation(database, staging.SOURCES[view], before[1])):
                parts.insert(0, _gated(database, view, before[1]))
            _run(spark, f"CREATE OR REPLACE VIEW {database}.{view} AS {' UNION ALL '.join(parts)}")
    _run(
        spark,
        f"INSERT INTO {database}.releases SELECT /*+ COALESCE(1) */ coalesce(max(number), 0) + 1, '{release}', '{sources}' FROM {database}.releases",
    )
    # From here on every view shows this release; what follows only makes staging views simple again.
    for view in views:
        query = staging.view_sql(view, _relation(database, staging.SOURCES[view], sources))
        if moved or not exists(spark, f"{database}.{view}"):
            _run(spark, f"CREATE OR REPLACE VIEW {database}.{view} AS {query}")


def forget(spark: SparkSession, database: str, keep: int = 3) -> list[str]:
    """Delete the stored results of all but the newest ``keep`` releases; returns the releases deleted."""
    listed = spark.sql(f"SELECT release FROM {database}.releases GROUP BY release ORDER BY max(number) DESC").toLocalIterator()
    gone = [r["release"] for r in listed][max(keep, 1) :]
    for table in [t.name for t in spark.catalog.listTables(database) if t.name.endswith("_runs")]:
        described = spark.sql(f"DESCRIBE TABLE EXTENDED {database}.{table}").where("col_name = 'Location'").first()
        for release in gone:
            place = spark._jvm.org.apache.hadoop.fs.Path(f"{described['data_type']}/{RUN}={release}")
            place.getFileSystem(spark._jsc.hadoopConfiguration()).delete(place, True)
        spark.catalog.refreshTable(f"{database}.{table}")
    return gone

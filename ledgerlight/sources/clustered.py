"""Tables stored in the order of a key, so that a page reads the files it lies in.

``write`` sorts a table by a unique key into files of consecutive ranges, and keeps their
boundaries: file, first and last key, and the position of its first row in the whole order.
A row's position is that plus its place in the file, which the reader knows, so positions
cost nothing to store. A page is then a range of positions: ``page_after`` reads the file
that has the cursor and those that the page lies in, two as a rule, and ``pages_after``
answers any number of cursors by joins on key and position, without a range join.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

POSITION = "_position"


def write(df: DataFrame, path: str, key: str, files: int) -> None:
    """Store ``df`` under ``path`` in about so many files; a NULL key is not allowed."""
    checked = df.withColumn(key, F.coalesce(F.col(key), F.raise_error(F.lit(f"{key} is NULL"))))
    checked.repartitionByRange(files, key).sortWithinPartitions(key).write.parquet(f"{path}/rows")
    stored = df.sparkSession.read.schema(df.schema).parquet(f"{path}/rows")
    ranges = stored.groupBy(_file().alias("file")).agg(
        F.min(key).alias("low"), F.max(key).alias("high"), F.count(F.lit(1)).alias("rows")
    )
    before = Window.orderBy("low").rowsBetween(Window.unboundedPreceding, -1)  # over one row a file
    ranges.withColumn("first", F.coalesce(F.sum("rows").over(before), F.lit(0))).coalesce(1).write.parquet(f"{path}/boundaries")


def _file():
    return F.regexp_extract("_metadata.file_path", "([^/]+)$", 1)


def boundaries(spark: SparkSession, path: str) -> DataFrame:
    """One row per file: file, low, high, rows, first."""
    return spark.read.parquet(f"{path}/boundaries")


def read(spark: SparkSession, path: str, schema: str | StructType, files: list[str] | None = None) -> DataFrame:
    """The rows of all files, or of some, with their position in the whole order, from 0."""
    paths = [f"{path}/rows"] if files is None else [f"{path}/rows/{f}" for f in files]
    stored = spark.read.schema(schema).parquet(*paths)
    placed = stored.select("*", _file().alias("file"), F.col("_metadata.row_index").alias("_row"))
    return placed.join(boundaries(spark, path).select("file", "first"), "file").withColumn(
        POSITION, F.col("first") + F.col("_row")
    ).drop("file", "first", "_row")


def _files(found: DataFrame) -> list[str]:
    return [r["file"] for r in found.select("file").toLocalIterator()]


def page_files(spark: SparkSession, path: str, schema: str | StructType, key: str, cursor: str | None, limit: int) -> tuple[list[str], int]:
    """The files that a page and the row after it lie in, and the position after the cursor's (0 for an unknown one)."""
    ranges, start = boundaries(spark, path), 0
    if cursor:
        holding = _files(ranges.where((F.col("low") <= cursor) & (F.col("high") >= cursor)))
        if holding:
            found = read(spark, path, schema, holding).where(F.col(key) == cursor).select(POSITION).first()
            start = 0 if found is None else found[POSITION] + 1
    end = F.col("first") + F.col("rows")
    return _files(ranges.where((end > start) & (F.col("first") <= start + limit)).orderBy("first")), start


def page_after(spark: SparkSession, path: str, schema: str | StructType, key: str, cursor: str | None, limit: int) -> DataFrame:
    """The ``limit`` rows after ``cursor`` in key order, with ``has_more``; an unknown cursor gives the first page."""
    files, start = page_files(spark, path, schema, key, cursor, limit)
    columns = (StructType.fromDDL(schema) if isinstance(schema, str) else schema).fieldNames()
    total = boundaries(spark, path).agg(F.coalesce(F.sum("rows"), F.lit(0)).alias("n")).scalar()
    rows = read(spark, path, schema, files) if files else read(spark, path, schema).where("false")
    page = rows.where((F.col(POSITION) >= start) & (F.col(POSITION) < start + limit))
    return page.select(*columns, (total > start + limit).alias("has_more"))


def pages_after(spark: SparkSession, path: str, schema: str | StructType, key: str, cursors: DataFrame, limit: int) -> DataFrame:
    """The pages of all ``cursors`` (one column of that name) in one job: cursor, rank, the row, has_more.

    Each cursor meets its position by key, and each place of its page meets a row by
    position; a cursor that no row has gets the first page.
    """
    columns = (StructType.fromDDL(schema) if isinstance(schema, str) else schema).fieldNames()
    rows = read(spark, path, schema)
    asked = cursors.select("cursor").distinct()
    known = rows.select(F.col(key).alias("cursor"), (F.col(POSITION) + 1).alias("start"))
    placed = asked.join(known, "cursor", "left").withColumn("start", F.coalesce("start", F.lit(0)))
    places = placed.select("cursor", "start", F.explode(F.sequence(F.lit(1), F.lit(limit))).alias("rank"))
    places = places.withColumn(POSITION, F.col("start") + F.col("rank") - 1)
    total = boundaries(spark, path).agg(F.coalesce(F.sum("rows"), F.lit(0)).alias("n")).scalar()
    found = places.join(rows, POSITION)
    return found.select("cursor", "rank", *columns, (total > F.col("start") + limit).alias("has_more"))

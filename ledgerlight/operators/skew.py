"""Inner joins with keys that hold a large share of one side, split without the adaptive planner.

The adaptive skew join splits what a shuffle has made, so neither bucketed inputs nor
sessions without it get any help. Here a mergeable sketch of frequent items finds the keys
that would outgrow a task; their rows are dealt out over so many salts as make each part
small, and the other side's rows of these keys are copied to each salt. All other rows are
joined as they are.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

PARTS = 4  # a hot key's part has at most this fraction of a task's mean of rows
TRACKED = 4  # items of the sketch for each key that may be hot


def hot_keys(df: DataFrame, key: Column, partitions: int) -> dict[object, int]:
    """The keys with more rows than a part may have, and over how many salts to deal them: few, whatever the table."""
    most = PARTS * partitions  # no more keys can have that share
    sketch = F.expr(f"approx_top_k(key, {min(most, 1000)}, {min(TRACKED * most, 100_000)})")
    found = df.select(key.alias("key")).where("key IS NOT NULL").agg(F.count("key").alias("n"), sketch.alias("top")).first()
    if not found["n"]:
        return {}
    part = max(found["n"] / most, 1)
    return {r["item"]: -int(-r["count"] // part) for r in found["top"] if r["count"] > part}


def join_skewed(
    big: DataFrame, small: DataFrame, big_key: Column, small_key: Column, spread_by: Column, partitions: int | None = None
) -> DataFrame:
    """Inner join of ``big``, some of whose keys may be hot, with ``small``.

    ``spread_by`` is a column of ``big``, such as its own id, that deals a hot key's rows
    out; it must not depend on the order of rows, or a repeated task could lose some.
    Copies of ``small`` are made of its rows with hot keys only. Columns of both sides are kept.
    """
    if partitions is None:
        partitions = int(big.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    hot = hot_keys(big, big_key, partitions)
    if not hot:
        return big.withColumn("_big_key", big_key).join(
            small.withColumn("_small_key", small_key), F.col("_big_key") == F.col("_small_key")
        ).drop("_big_key", "_small_key")
    salts = F.create_map(*[F.lit(x) for pair in hot.items() for x in pair])
    many = lambda key: F.coalesce(F.try_element_at(salts, key), F.lit(1))
    dealt = big.withColumn("_big_key", big_key).where("_big_key IS NOT NULL").withColumn(
        "_big_salt", F.pmod(F.xxhash64(spread_by), many(F.col("_big_key"))).cast("int")
    )
    copied = small.withColumn("_small_key", small_key).where("_small_key IS NOT NULL").withColumn(
        "_small_salt", F.explode(F.sequence(F.lit(0), many(F.col("_small_key")) - 1))
    )
    met = dealt.join(copied, (F.col("_big_key") == F.col("_small_key")) & (F.col("_big_salt") == F.col("_small_salt")))
    return met.drop("_big_key", "_big_salt", "_small_key", "_small_salt")

"""Helpers of the operators: cutting lineage, connected components, hashing of words."""

from __future__ import annotations

import tempfile

import numpy as np
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def cut(df: DataFrame) -> DataFrame:
    """``df`` computed once and kept in the folder of ``spark.checkpoint.dir``, which survives lost executors.

    A folder of our own is set only where the session names none, as in tests.
    """
    checkpoint_folder(df.sparkSession)
    return df.checkpoint()


def checkpoint_folder(spark: SparkSession) -> str:
    """The session's own folder below ``spark.checkpoint.dir``, where tables can be stored too."""
    context = spark.sparkContext
    if context.getCheckpointDir() is None:
        named = context.getConf().get("spark.checkpoint.dir")
        context.setCheckpointDir(named or tempfile.mkdtemp(prefix="checkpoints-"))
    return context.getCheckpointDir()


TASK_ROWS = 50_000  # of a small stored table, before another task is worth its files


def tasks(spark: SparkSession, rows: int) -> int:
    """How many tasks so many short rows are worth: a core each, and more as they grow.

    A task writes files of some KB for each shuffle, however little it has to send.
    """
    return max(spark.sparkContext.defaultParallelism, -(-rows // TASK_ROWS))


def gathered(stored: DataFrame) -> DataFrame:
    """A stored table of short rows, read by no more tasks than these are worth."""
    return stored.coalesce(tasks(stored.sparkSession, stored.count()))


def components(edges: DataFrame) -> DataFrame:
    """(id, component) of every node of ``edges`` (a, b): the smallest id it is connected with.

    Alternates the large-star and small-star steps of Kiveris et al. (2014),
    with minima taken by partial aggregation, so a node with very many edges
    costs a row per task; the number of rounds is logarithmic in practice.
    """
    def starred(edges: DataFrame, large: bool, n: int) -> DataFrame:
        both = edges.union(edges.select("b", "a")).toDF("u", "v")
        near = both if large else both.where("v < u")
        least = near.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        linked = (both.where("v > u") if large else near).join(least, "u").select(F.col("v").alias("a"), F.col("m").alias("b"))
        if not large:
            linked = linked.union(least.select(F.col("u").alias("a"), F.col("m").alias("b")))
        return linked.where("a <> b").coalesce(n).distinct().coalesce(n)

    edges = cut(edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).where("a <> b").distinct())
    state = None
    while True:
        now = edges.agg(F.count("a"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        if now == state:
            break
        state, n = now, tasks(edges.sparkSession, now[0])
        # A step gives about as many rows as there are edges.
        edges = cut(starred(starred(edges.coalesce(n), True, n), False, n))
    edges = edges.coalesce(tasks(edges.sparkSession, state[0]))
    nodes = edges.select(F.col("a").alias("id"), F.col("b").alias("component"))
    return nodes.union(edges.select("b", "b")).distinct()


# Hashing of whole words, a document's bytes at a time.
_RANDOM = np.random.default_rng(20240601)
_BYTE = _RANDOM.integers(0, 1 << 63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_BASE = np.uint64(0x9E3779B97F4A7C15)
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
_SPACE = np.zeros(256, bool)
_SPACE[[32, *range(9, 14)]] = True


def mixed(h: np.ndarray) -> np.ndarray:
    """Every bit of 64-bit numbers spread over all others."""
    h = (h ^ (h >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    h = (h ^ (h >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return h ^ (h >> np.uint64(31))


def lowered_words(data: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Of a text's bytes: A-Z lower-cased, and where words (runs without white space) start and end."""
    data = _LOWER[data]
    inside = np.zeros(len(data) + 2, np.int8)
    inside[1:-1] = ~_SPACE[data]
    edge = np.diff(inside)
    return data, np.flatnonzero(edge == 1), np.flatnonzero(edge == -1)


def word_hashes(text: str | None) -> np.ndarray:
    """A 64-bit hash of each word ``[^\\x20\\x09-\\x0D]+`` of the text, in order, A-Z lower-cased."""
    data, start, end = lowered_words(np.frombuffer((text or "").encode(), np.uint8))
    if not len(start):
        return np.zeros(0, np.uint64)
    longest = int((end - start).max())
    powers = np.cumprod(np.full(longest, _BASE, np.uint64))
    place = np.arange(len(data)) - np.repeat(start, np.diff(np.append(start, len(data))), axis=0) if start[0] == 0 else None
    if place is None:
        bounds = np.append(start, len(data))
        place = np.concatenate([np.zeros(start[0], np.int64), np.arange(start[0], len(data)) - np.repeat(start, np.diff(bounds))])
    value = _BYTE[data] * powers[np.minimum(place, longest - 1)]
    value[_SPACE[data]] = 0
    return mixed(np.add.reduceat(value, start) + (end - start).astype(np.uint64))

"""Labelled documents for training: a bounded sample, the same for the same tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def remainder(mod: int) -> Column:
    """crc32 of doc_id as text, modulo ``mod``: what tells training from held-out documents."""
    return F.pmod(F.crc32(F.coalesce(F.col("doc_id").cast("string"), F.lit("")).cast("binary")), F.lit(mod))


def sample(docs: DataFrame, labels: DataFrame, label: str, training: Column, most: int, longest: int) -> DataFrame:
    """At most ``most`` rows (doc_id, text, label) of those in ``training``, the smallest by a hash of doc_id.

    Only texts of at most ``longest`` characters are learned from. A doc_id with
    several labels counts with the smallest; rows without doc_id or label do not.
    """
    known = labels.where(F.col("doc_id").isNotNull() & F.col(label).isin(0, 1) & training)
    known = known.groupBy("doc_id").agg(F.min(label).alias("label"))
    chosen = known.orderBy(F.xxhash64("doc_id"), "doc_id").limit(most)
    texts = docs.select("doc_id", "text").where(F.col("text").isNotNull() & (F.length("text") <= longest))
    # ``most`` bounds what is broadcast.
    return texts.join(F.broadcast(chosen), "doc_id").select("doc_id", "text", "label")

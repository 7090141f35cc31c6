"""From raw documents to token ids: quality, near duplicates, secrets, mixture, encoding.

``STAGES`` names the stages in order. Each function takes (spark, docs, sf_dir)
and returns a DataFrame that is written as Parquet and read again as the next
one's ``docs``; all but the last keep the columns of ``documents``.
"""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerlight.llm import bpe, mixing, near_dedup, quality, secrets, shared

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]

VOCABULARY = "byte_bpe_multi_50k.tiktoken"


def drop_poor_documents(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents that the quality classifier, learned from ``labels``, does not reject."""
    return quality.keep_good(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates: five-word shingles, a similarity of 0.8 or more."""
    return near_dedup.deduplicate(docs, similarity=80)


def mask_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every document, with each finding of the secret scan masked in its text, and its length anew."""
    return secrets.redact(docs).withColumn("n_chars", F.length("text").cast("long"))


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every document, in the order of a mixture by the square root of the sources' sizes."""
    return mixing.in_order(docs)


def encode_texts(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Per document, in the same order: doc_id, lang, source, n_tokens, and the ids of its text."""
    merges = bpe.load_merges(public_tokenizers.path(VOCABULARY), public_tokenizers.PATTERN)
    encoded = bpe.encode(docs.select("doc_id", "lang", "source", "text"), merges, out="ids")
    return encoded.select("doc_id", "lang", "source", F.size("ids").cast("long").alias("n_tokens"), "ids")


STAGES: list[tuple[str, Stage]] = [
    ("quality", drop_poor_documents),
    ("near duplicates", drop_near_duplicates),
    ("secrets", mask_secrets),
    ("mixture", mix_sources),
    ("encoding", encode_texts),
]

# Neither the learned classifier nor the byte-pair encoding can be told in SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stages applied to ``documents``; what each one returns is kept once for the next."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for _, stage in STAGES[:-1]:
        docs = shared.cut(stage(spark, docs, sf_dir))
    return STAGES[-1][1](spark, docs, sf_dir)

"""The queries of this subpackage, and the SQL of those that SQL can express."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from ledgerlight.llm import (
    bpe,
    exact_topk,
    hnsw,
    mixing,
    near_dedup,
    ngram_model,
    periodic_runs,
    quality,
    secrets,
    suffix_dedup,
    toxicity,
    url_filter,
    whitening,
)

Query = Callable[[SparkSession, str], DataFrame]


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _over(name: str, operator: Callable[[DataFrame], DataFrame]) -> Query:
    return lambda spark, sf_dir: operator(table(spark, sf_dir, name))


def _learned(operator: Callable[[DataFrame, DataFrame], DataFrame]) -> Query:
    return lambda spark, sf_dir: operator(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def _byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    vocabulary = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")
    return bpe.report(table(spark, sf_dir, "documents"), bpe.load_merges(vocabulary, public_tokenizers.PATTERN))


def queries() -> dict[str, Query]:
    return {
        "op1_secret_scan": _over("documents", secrets.report),
        "op2_quality": _learned(quality.report),
        "op3_mixture": _over("documents", mixing.report),
        "op4_nearest_neighbours": _over("embeddings", hnsw.report),
        "op5_suffix_dedup": _over("documents", suffix_dedup.report),
        "op6_byte_bpe": _byte_bpe,
        "op7_language_model": _over("documents", ngram_model.score),
        "op8_exact_top_k": _over("embeddings", exact_topk.report),
        "op9_near_dedup": _over("documents", near_dedup.groups),
        "op10_toxicity": _learned(toxicity.report),
        "op11_url_filter": _over("pages", url_filter.report),
        "op12_whitening": _over("embeddings", whitening.report),
        "op13_periodic_runs": _over("documents", periodic_runs.report),
    }


def oracle_sql() -> dict[str, str]:
    return {
        "op1_secret_scan": secrets.oracle(),
        "op8_exact_top_k": exact_topk.oracle(),
        "op9_near_dedup": near_dedup.oracle(),
        "op11_url_filter": url_filter.oracle(),
    }

"""The pipeline on the smallest table, against its stages in plain Python."""

from __future__ import annotations

import public_tokenizers
import tiktoken

import __spark_entry__ as driver
import corpus_pipeline
from ledgerlight.llm import bpe, registry
from test_near_dedup import plain_groups
from test_secrets import base, entropy

SF_DIR = "/root/testdata/sf0.001"


def masked(text):
    out, at = "", 0
    for start, _, end, _ in sorted(base(text) + entropy(text)):
        if start >= at:
            out += text[at:start] + "<SECRET>"
        at = max(at, end)
    return out + text[at:]


def test_run_equals_plain_stages(spark):
    docs = registry.table(spark, SF_DIR, "documents")
    good = {r["doc_id"] for r in corpus_pipeline.drop_poor_documents(spark, docs, SF_DIR).collect()}
    truth = {r["doc_id"]: r["quality"] for r in registry.table(spark, SF_DIR, "labels").collect()}
    # There are few labels to learn from in this table.
    assert sum((i in good) == (q == 1) for i, q in truth.items()) >= 0.9 * len(truth)
    texts = {r["doc_id"]: r["text"] for r in docs.collect() if r["doc_id"] in good}
    kept = [g[0] for g in plain_groups(sorted(texts.items()), 80) if g[3]]
    merges = bpe.load_merges(public_tokenizers.path(corpus_pipeline.VOCABULARY), public_tokenizers.PATTERN)
    plain = tiktoken.Encoding("own", pat_str=merges.pattern, mergeable_ranks=merges.ranks, special_tokens={})
    found = {r["doc_id"]: r for r in driver.queries()["pipeline"](spark, SF_DIR).collect()}
    assert sorted(found) == kept
    for i, r in found.items():
        assert r["ids"] == plain.encode_ordinary(masked(texts[i])) and r["n_tokens"] == len(r["ids"])


def test_stages_keep_the_columns_and_take_nulls_and_copies(spark):
    docs = spark.read.parquet(f"{SF_DIR}/documents.parquet").limit(20)
    odd = spark.createDataFrame([(9001, None, None, None, None), (9002, "", "en", "x", 0)] * 2 + [(None, "a b", "en", "x", 3)], docs.schema)
    docs = docs.union(odd)
    for some in (docs, docs.where("false")):
        for _, stage in corpus_pipeline.STAGES[:-1]:
            out = stage(spark, some, SF_DIR)
            assert out.columns == docs.columns
            out.collect()
        assert corpus_pipeline.STAGES[-1][1](spark, some, SF_DIR).count() == some.count()


def test_stages():
    assert len(corpus_pipeline.STAGES) == 5 and corpus_pipeline.ORACLE_SQL is None

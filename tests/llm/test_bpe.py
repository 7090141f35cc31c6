"""Byte-level BPE against the public library, and streaming decoding."""

from __future__ import annotations

import hashlib
import random
import time

import pytest
import public_tokenizers as P
import tiktoken

from ledgerlight.llm import bpe, registry

PATH = P.path("byte_bpe_multi_50k.tiktoken")
CASES = [None, "", "a", "  \n\t x", "don't I'LL 12345", "é😀日本 мир", "word" * 3000, "!!!###$$$ | |", "\x85\x1c　 x"]


@pytest.fixture(scope="module")
def merges():
    return bpe.load_merges(PATH, P.PATTERN)


@pytest.fixture(scope="module")
def plain(merges):
    return tiktoken.Encoding("own", pat_str=P.PATTERN, mergeable_ranks=merges.ranks, special_tokens={})


def test_encoder_equals_the_library(merges, plain):
    encoder, small = bpe.Encoder(merges), bpe.Encoder(merges, 50, 2000)
    rng = random.Random(7)
    parts = ["a", "b", "th", "é", "😀", "日", " ", "\n", "1", "!", "'s", "ß", "́", "х", "##", "tion", "ñ"]
    for _ in range(3000):
        text = "".join(rng.choice(parts) for _ in range(rng.randint(0, 25)))
        assert encoder.encode(text) == plain.encode_ordinary(text) == small.encode(text)


def test_decoder_carries_cut_characters(merges):
    decoder, encoder = bpe.Decoder({r: b for b, r in merges.ranks.items()}), bpe.Encoder(merges)
    text = "a😀日é́" * 20
    ids = encoder.encode(text)
    assert "".join(decoder.feed([i]) for i in ids) + decoder.finish() == text
    byte = lambda b: merges.ranks[bytes([b])]
    assert decoder.decode([byte(0xE2), byte(0x82)]) == "�"
    assert decoder.decode([byte(0xE2), byte(0x41), byte(0xFF), byte(0xC3), byte(0xA9)]) == "�A��"[:3] + "é"
    assert decoder.decode([byte(0xED), byte(0xA0), byte(0x80)]) == "���"


def test_operators_round_trip(spark, merges, plain):
    docs = spark.createDataFrame([(i, t, 5) for i, t in enumerate(CASES)] * 2, "doc_id long, text string, ids int")
    made = bpe.encode(docs, merges, out="ids")
    assert made.columns == ["doc_id", "text", "ids"]
    for r in bpe.decode(made, merges, out="back").collect():
        assert r["ids"] == plain.encode_ordinary(r["text"] or "") and r["back"] == (r["text"] or "")
    for r in bpe.report(docs, merges).collect():
        text = CASES[r["doc_id"]] or ""
        ids = plain.encode_ordinary(text)
        assert r["n_tokens"] == len(ids) and r["decoded_sha256"] == hashlib.sha256(text.encode()).hexdigest()
        assert r["ids_sha256"] == hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest()
    empty = docs.where("false")
    assert bpe.encode(empty, merges).count() == bpe.report(empty, merges).count() == 0


def test_query_equals_the_library(spark, plain):
    rows = registry.queries()["op6_byte_bpe"](spark, "/root/testdata/sf0.001").collect()
    texts = {r["doc_id"]: r["text"] for r in registry.table(spark, "/root/testdata/sf0.001", "documents").collect()}
    assert len(rows) == len(texts)
    for r in rows:
        ids = plain.encode_ordinary(texts[r["doc_id"]])
        assert r["ids_sha256"] == hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest()


def test_any_bytes_decode_as_a_stream_decoder_does(merges):
    rng = random.Random(8)
    lead = [0x41, 0x80, 0xBF, 0xC2, 0xC3, 0xE0, 0xA0, 0xED, 0x9F, 0xEF, 0xF0, 0x90, 0xF4, 0x8F, 0xF5, 0xFF]
    for _ in range(2000):
        data = bytes(rng.choice(lead) for _ in range(rng.randint(0, 12)))
        decoder, ids = bpe.Decoder({r: b for b, r in merges.ranks.items()}), [merges.ranks[bytes([b])] for b in data]
        cuts = sorted(rng.randint(0, len(ids)) for _ in range(2))
        parts = [ids[: cuts[0]], ids[cuts[0] : cuts[1]], ids[cuts[1] :]]
        assert "".join(map(decoder.feed, parts)) + decoder.finish() == data.decode(errors="replace")


def test_every_token_goes_through_the_state_machine(merges, monkeypatch):
    decoder, encoder = bpe.Decoder({r: b for b, r in merges.ranks.items()}), bpe.Encoder(merges)
    seen = []
    step = bpe._step
    monkeypatch.setattr(bpe, "_step", lambda state, byte: seen.append(byte) or step(state, byte))
    text = "Some text, some more: é日😀"
    ids = encoder.encode(text)
    assert decoder.decode(ids) == text
    assert {bytes(b) for b in map(decoder.bytes_of, ids)} and set(text.encode()) <= set(seen)


def test_idle_workers_give_their_encoder_up(spark, merges, monkeypatch):
    monkeypatch.setattr(bpe, "IDLE", 0.2)
    docs = spark.createDataFrame([(i, f"some text {i}") for i in range(40)], "doc_id long, text string").repartition(8)

    def held(batches):
        import sys

        import pyarrow as pa

        for _ in batches:
            yield pa.RecordBatch.from_pydict({"n": [sum(m.startswith("byte_bpe_") for m in sys.modules)]})

    assert bpe.encode(docs, merges).count() == 40
    bpe.encode(docs, merges).write.format("noop").mode("overwrite").save()
    time.sleep(1.5)
    assert [r["n"] for r in docs.mapInArrow(held, "n long").collect()] == [0] * 8

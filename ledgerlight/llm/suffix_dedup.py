"""Repeated passages: a distributed merge sort of sampled suffixes, told by common prefixes.

Every byte covered by a string of ``LENGTH`` bytes that also starts elsewhere is
removed. Sorting all suffixes would send each byte ``LENGTH`` times, so suffixes are
sampled by content, which loses nothing:

1. The anchor of a string of ``LENGTH`` bytes is its leftmost ``GRAM``-byte gram with
   the smallest hash. Equal strings have equal anchors at the same place, so a
   string repeats only if its anchor's gram does. Strings that follow each
   other mostly share an anchor; what they cover together is the anchor's context.
2. Grams and contexts are counted by hash, per block of documents first. A gram that
   stands once is done. One whose contexts are all equal makes all its strings
   repeats. Only contexts of grams with differing contexts go on.
3. These suffixes, from the anchor to the context's end, are sorted within a block,
   front-coded (each holds only what differs from the one before), and sent to the
   shard of their gram. A shard merges the sorted runs with a loser tree
   that keeps the common prefix of each entry with the last winner, so that no known
   prefix is compared again; the merge yields the common prefixes of neighbours.
   Where these reach far enough, strings are equal if what stands before their
   anchors is, which a 64-bit hash of it tells.
4. The marks go back to the blocks, which cut the repeats out.

A gram with more than ``HOT`` contexts is dealt out by classes of the anchor's place
within the string: strings of a class share a longer core around the anchor, whose
hash tells the shard, so no task gathers a hot gram.

Defined results: texts are UTF-8 bytes and a null text is an empty one; strings
never cross documents; texts under ``LENGTH`` bytes stay whole; repeated rows are
repeats of each other; an empty table gives an empty result. Columns beside doc_id
and text are ignored by ``report`` and pass through neither.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerlight.llm import shared

LENGTH, GRAM = 200, 64
PLACES = LENGTH - GRAM + 1  # of a gram in a string
BLOCK_BYTES = 6_000_000
CHUNK = (1 << 20) - 2 * LENGTH  # string starts looked at together; places must fit 20 bits
HOT, CLASS = 20_000, 17
NO_ID = -(2**63)  # stands for a null doc_id within blocks

_RANDOM = np.random.default_rng(20240603)
_BYTE = _RANDOM.integers(0, 1 << 63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_BASE = 0xD1342543DE82EF95
_INVERSE = pow(_BASE, -1, 1 << 64)
_ODD = _RANDOM.integers(0, 1 << 62, 4, dtype=np.uint64) * np.uint64(2) + np.uint64(1)


@dataclass
class Contexts:
    """Of a block: per context its gram, its own hash, its first and last string start, its anchor."""

    gram: np.ndarray
    own: np.ndarray
    first: np.ndarray
    last: np.ndarray
    anchor: np.ndarray


def _chunk_contexts(data: np.ndarray, valid: np.ndarray, powers: np.ndarray, inverse: np.ndarray) -> tuple[np.ndarray, ...]:
    """Of one chunk; ``valid`` tells which of its starts have a whole string in their document."""
    n = len(valid)
    prefix = np.zeros(len(data) + 1, np.uint64)
    np.cumsum(_BYTE[data] * powers[: len(data)], out=prefix[1:])
    grams = len(data) - GRAM + 1
    gram = shared.mixed((prefix[GRAM:] - prefix[:grams]) * inverse[:grams])
    # The place in the low bits breaks ties to the left.
    least = (gram & ~np.uint64((1 << 20) - 1)) | np.arange(grams, dtype=np.uint64)
    width = 1
    while width * 2 <= PLACES:
        least = np.minimum(least[:-width], least[width:])
        width *= 2
    least = np.minimum(least[:n], least[PLACES - width : PLACES - width + n])
    anchor = (least & np.uint64((1 << 20) - 1)).astype(np.int64)
    fresh = np.ones(n, bool)
    fresh[1:] = (anchor[1:] != anchor[:-1]) | ~valid[:-1]
    first = np.flatnonzero(fresh & valid)
    ends = np.ones(n, bool)
    ends[:-1] = fresh[1:] | ~valid[1:]
    last = np.flatnonzero(ends & valid)
    anchor = anchor[first]
    whole = (prefix[last + LENGTH] - prefix[first]) * inverse[first]
    own = shared.mixed(whole + (anchor - first).astype(np.uint64) * _ODD[0] + (last - first).astype(np.uint64) * _ODD[1])
    return gram[anchor], own, first, last, anchor


def contexts(data: np.ndarray, ends: np.ndarray) -> Contexts:
    """All contexts of documents that lie one after the other in ``data``."""
    size = min(len(data), CHUNK + LENGTH)
    powers = np.cumprod(np.append(np.uint64(1), np.full(size, _BASE, np.uint64)))
    inverse = np.cumprod(np.append(np.uint64(1), np.full(size, _INVERSE, np.uint64)))
    valid = np.zeros(len(data), bool)
    starts = np.append(0, ends[:-1])
    step = np.zeros(len(data) + 1, np.int32)
    long = ends - starts >= LENGTH
    np.add.at(step, starts[long], 1)
    np.add.at(step, ends[long] - LENGTH + 1, -1)
    valid = np.cumsum(step[:-1]) > 0
    parts = []
    for low in range(0, max(0, len(data) - LENGTH + 1), CHUNK):
        n = min(CHUNK, len(data) - LENGTH + 1 - low)
        if valid[low : low + n].any():
            gram, own, *where = _chunk_contexts(data[low : low + n + LENGTH - 1], valid[low : low + n], powers, inverse)
            parts.append((gram, own, *(w + low for w in where)))
    if not parts:
        none = np.zeros(0, np.int64)
        return Contexts(none, none, none, none, none)
    gram, own, *where = (np.concatenate(p) for p in zip(*parts))
    return Contexts(gram.view(np.int64), own.view(np.int64), *where)


# Front-coded runs of sorted suffixes, and their merge.


def common_prefix(a: bytes, b: bytes, start: int = 0) -> int:
    """The length of the common prefix, given that ``start`` bytes are known to be common."""
    end, step = min(len(a), len(b)), 32
    while start < end:
        if a[start : start + step] == b[start : start + step]:
            start += step
        elif step == 1:
            break
        else:
            step = max(1, step // 4)
    return min(start, end)


def front_coded(suffixes: list[bytes]) -> tuple[np.ndarray, np.ndarray, bytes]:
    """Of sorted suffixes: common prefixes with the one before, lengths of the rest, the rests."""
    shared_, rest, last = [], [], b""
    for s in suffixes:
        n = common_prefix(last, s)
        shared_.append(n)
        rest.append(s[n:])
        last = s
    return np.array(shared_, np.uint8), np.array([len(r) for r in rest], np.uint8), b"".join(rest)


def unfolded(prefixes: np.ndarray, lengths: np.ndarray, rest: bytes) -> Iterator[tuple[int, bytes]]:
    """The suffixes of a run with their common prefixes."""
    last, at = b"", 0
    for n, m in zip(prefixes.tolist(), lengths.tolist()):
        last = last[:n] + rest[at : at + m]
        at += m
        yield n, last


def merged(runs: list[Iterator[tuple[int, bytes]]]) -> Iterator[tuple[int, int, bytes]]:
    """(run, common prefix with the one before, suffix) of all runs in order, by a loser tree.

    An entry carries its common prefix with the last winner. Of two entries the
    longer such prefix wins unseen; equal ones are compared from there on, and the loser
    then carries its common prefix with the one it lost to.
    """
    k = 1
    while k < len(runs):
        k *= 2
    heads: list[tuple[int, bytes] | None] = [next(r, None) for r in runs] + [None] * (k - len(runs))
    # Nothing has won yet: no prefix is known.
    heads = [h and (0, h[1]) for h in heads]
    tree = [-1] * k

    def play(a: int, b: int) -> tuple[int, int]:
        """Winner and loser."""
        x, y = heads[a], heads[b]
        if x is None or y is None:
            return (b, a) if x is None else (a, b)
        if x[0] != y[0]:
            return (a, b) if x[0] > y[0] else (b, a)
        n = common_prefix(x[1], y[1], x[0])
        if x[1][n:] <= y[1][n:]:
            heads[b] = n, y[1]
            return a, b
        heads[a] = n, x[1]
        return b, a

    def first(node: int) -> int:
        if node >= k:
            return node - k
        winner, tree[node] = play(first(2 * node), first(2 * node + 1))
        return winner

    winner = first(1) if k > 1 else 0
    while heads[winner] is not None:
        n, s = heads[winner]
        yield winner, n, s
        heads[winner] = next(runs[winner], None)
        node = (winner + k) // 2
        while node:
            winner, tree[node] = play(winner, tree[node])
            node //= 2


def repeats(prefix: np.ndarray, left: np.ndarray, low: np.ndarray, high: np.ndarray, count: np.ndarray) -> np.ndarray:
    """Which strings repeat: a row per suffix in sorted order, a column per place of the anchor.

    ``left`` holds what stands before the anchors, nearest first; ``low`` and ``high``
    the places that a suffix has strings for; ``count`` how often its context stands.
    """
    n = len(prefix)
    out = np.zeros((n, PLACES), bool)
    total = np.zeros(n, np.uint64)
    powers = np.cumprod(np.append(np.uint64(1), np.full(PLACES, _BASE, np.uint64)))
    for place in range(PLACES):
        if place:
            total = total + _BYTE[left[:, place - 1]] * powers[place]
        here = np.flatnonzero((low <= place) & (place <= high))
        if not len(here):
            continue
        group = np.cumsum(prefix < LENGTH - place).astype(np.uint64)
        key = shared.mixed(total[here] + group[here] * _ODD[2])
        _, at, times = np.unique(key, return_inverse=True, return_counts=True)
        at = at.ravel()
        out[here, place] = (times[at] > 1) | (np.bincount(at, count[here])[at] > 1)
    return out


# The jobs.

BLOCKS = "block long, docs binary, ends binary, body binary"


def _blocks(docs: DataFrame) -> DataFrame:
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        # A retried task makes the same blocks with the same numbers.
        number, ids, texts, size = TaskContext.get().partitionId() << 32, [], [], 0

        def done() -> pa.RecordBatch:
            row = {
                "block": number,
                "docs": np.array(ids, np.int64).tobytes(),
                "ends": np.cumsum([len(t) for t in texts]).astype(np.int64).tobytes(),
                "body": zstandard.compress(b"".join(texts), 1),
            }
            return pa.RecordBatch.from_pylist([row], schema=schema)

        for batch in batches:
            for i, text in zip(batch.column("doc_id").to_pylist(), batch.column("text")):
                ids.append(i)
                texts.append((text.as_py() or "").encode())
                size += len(texts[-1]) + 1
                if size >= BLOCK_BYTES:
                    yield done()
                    number, ids, texts, size = number + 1, [], [], 0
        if ids:
            yield done()

    schema = pa.schema([("block", pa.int64()), *((c, pa.binary()) for c in ("docs", "ends", "body"))])
    return docs.select(F.coalesce(F.col("doc_id").cast("long"), F.lit(NO_ID)).alias("doc_id"), "text").mapInArrow(run, BLOCKS)


def _opened(row: dict) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    data = np.frombuffer(zstandard.decompress(row["body"]) if row["body"] else b"", np.uint8)
    return np.frombuffer(row["docs"], np.int64), np.frombuffer(row["ends"], np.int64), data


def _distinct(c: Contexts) -> tuple[np.ndarray, np.ndarray]:
    """Of equal contexts, the first one's number, and how many there are."""
    order = np.lexsort((c.own, c.gram))
    new = np.ones(len(order), bool)
    new[1:] = (c.gram[order][1:] != c.gram[order][:-1]) | (c.own[order][1:] != c.own[order][:-1])
    at = np.flatnonzero(new)
    return order[at], np.diff(np.append(at, len(order)))


def _found(sorted_keys: np.ndarray, keys: np.ndarray) -> np.ndarray:
    """Places of keys among sorted ones; -1 for those that are not there."""
    if not len(sorted_keys):
        return np.full(len(keys), -1)
    place = np.minimum(np.searchsorted(sorted_keys, keys), len(sorted_keys) - 1)
    return np.where(sorted_keys[place] == keys, place, -1)


def _shard(*parts: np.ndarray) -> np.ndarray:
    total = np.zeros(len(parts[0]), np.uint64)
    for i, p in enumerate(parts):
        total = shared.mixed(total + p.view(np.uint64) * _ODD[i % 4] + np.uint64(i + 1))
    return total


def cut_repeats(docs: DataFrame) -> DataFrame:
    """Per row of ``docs``: doc_id, n_bytes, removed (array of byte spans start, end), kept (the remaining bytes)."""
    blocks = _blocks(docs.select("doc_id", "text"))
    partitions = max(1, int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions")))
    # All that follows reads this one shuffle of the blocks.
    blocks = blocks.repartition(partitions, "block")

    def count(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                _, ends, data = _opened(row)
                c = contexts(data, ends)
                one, n = _distinct(c)
                for low in range(0, len(one), 100_000):
                    some = slice(low, low + 100_000)
                    yield pa.RecordBatch.from_pydict(
                        {
                            "gram": pa.array(c.gram[one[some]]), "own": pa.array(c.own[one[some]]),
                            "block": pa.array(np.full(len(one[some]), row["block"])), "n": pa.array(n[some].astype(np.int64)),
                        }
                    )

    counted = blocks.mapInArrow(count, "gram long, own long, block long, n long")
    grams = counted.groupBy("gram").agg(
        F.sum("n").alias("total"), F.count(F.lit(1)).alias("rows"), F.min("own").alias("low"), F.max("own").alias("high")
    )
    # 0: all contexts equal; 1: differing contexts; 2: so many of them that they are dealt out.
    kind = F.when(F.col("low") == F.col("high"), 0).when(F.col("rows") <= HOT, 1).otherwise(2)
    grams = grams.where("total > 1").select("gram", kind.alias("kind"))
    told = shared.cut(counted.join(grams, "gram").select("block", "gram", "kind").distinct())

    def send(left: pa.Table, right: pa.Table) -> pa.Table:
        out = {c: [] for c in ("shard", "block", "run")}
        gram = right.column("gram").to_numpy()
        order = np.argsort(gram)
        gram, kind = gram[order], right.column("kind").to_numpy()[order]
        for row in left.to_pylist():
            _, ends, data = _opened(row)
            c = contexts(data, ends)
            one, n = _distinct(c)
            place = _found(gram, c.gram[one])
            keep = (place >= 0) & (kind[np.maximum(place, 0)] > 0) if len(gram) else np.zeros(len(one), bool)
            one, n, hot = one[keep], n[keep], kind[place[keep]] == 2 if keep.any() else np.zeros(0, bool)
            low, high = c.anchor[one] - c.last[one], c.anchor[one] - c.first[one]
            low = np.maximum(low, 0)
            # Entries: a context, or for hot grams its part in each class of places.
            entry = [(np.flatnonzero(~hot), low[~hot], high[~hot], None)]
            for lowest in range(0, PLACES, CLASS):
                some = np.flatnonzero(hot & (low < lowest + CLASS) & (high >= lowest))
                if len(some):
                    entry.append((some, np.maximum(low[some], lowest), np.minimum(high[some], lowest + CLASS - 1), lowest))
            buffer = data.tobytes()
            by_shard: dict[int, list] = {}
            for some, lo, hi, lowest in entry:
                anchors = c.anchor[one[some]]
                if lowest is None:
                    shard = _shard(c.gram[one[some]])
                else:
                    top = lowest + CLASS - 1
                    core = [hashlib.blake2b(buffer[a - lowest : a + max(GRAM, LENGTH - top)], digest_size=8).digest() for a in anchors]
                    shard = _shard(c.gram[one[some]], np.full(len(some), lowest), np.frombuffer(b"".join(core), np.int64))
                shard = (shard % np.uint64(4 * partitions)).astype(np.int64)
                for s, i, a, l, h in zip(shard.tolist(), some.tolist(), anchors.tolist(), lo.tolist(), hi.tolist()):
                    by_shard.setdefault(s, []).append((buffer[a : a + LENGTH - l], buffer[a - h : a], l, h, min(int(n[i]), 2), c.gram[one[i]], c.own[one[i]]))
            for s, entries in by_shard.items():
                entries.sort(key=lambda e: e[0])
                prefix, length, rest = front_coded([e[0] for e in entries])
                parts = [
                    prefix.tobytes(), length.tobytes(),
                    bytes(e[2] for e in entries), bytes(e[3] for e in entries), bytes(e[4] for e in entries),
                    np.array([e[5] for e in entries], np.int64).tobytes(), np.array([e[6] for e in entries], np.int64).tobytes(),
                    np.array([len(rest)], np.int64).tobytes(), rest, b"".join(e[1] for e in entries),
                ]
                out["shard"].append(s)
                out["block"].append(row["block"])
                out["run"].append(np.array([len(entries)], np.int64).tobytes() + b"".join(parts))
        return pa.table(out, schema=pa.schema([("shard", pa.int64()), ("block", pa.int64()), ("run", pa.binary())]))

    runs = blocks.groupBy("block").cogroup(told.where("kind > 0").groupBy("block")).applyInArrow(send, "shard long, block long, run binary")

    def merge(table: pa.Table) -> pa.Table:
        block_of, streams, sides = [], [], []
        for block, run in zip(table.column("block").to_pylist(), table.column("run").to_pylist()):
            n = int(np.frombuffer(run, np.int64, 1)[0])
            at = 8
            head = np.frombuffer(run, np.uint8, 5 * n, at).reshape(5, n)
            at += 5 * n
            gram, own = np.frombuffer(run, np.int64, 2 * n, at).reshape(2, n)
            at += 16 * n
            size = int(np.frombuffer(run, np.int64, 1, at)[0])
            rest, before = run[at + 8 : at + 8 + size], run[at + 8 + size :]
            streams.append(unfolded(head[0], head[1], rest))
            sides.append((head[2], head[3], head[4], gram, own, np.frombuffer(before, np.uint8)))
            block_of.append(block)
        order, prefix = [], []
        for run, n, _ in merged(streams):
            order.append(run)
            prefix.append(n)
        order, prefix = np.array(order, np.int64), np.array(prefix, np.int64)
        # Entries of a run come in its own order: bring all sides into the merged one.
        into = np.argsort(order, kind="stable")
        place = np.empty(len(order), np.int64)
        place[into] = np.arange(len(order))
        low, high, many, gram, own = (np.concatenate([s[i] for s in sides])[place] for i in range(5))
        block = np.repeat(block_of, [len(s[0]) for s in sides])[place]
        flat = np.concatenate([s[5] for s in sides])
        widths = np.concatenate([s[1] for s in sides]).astype(np.int64)
        ends = np.cumsum(widths)[place]
        out = {c: [] for c in ("block", "gram", "own", "low", "marks")}
        # Strings of different grams have nothing in common: cut where little is shared, so that pieces stay small.
        edges = np.append(np.flatnonzero(prefix < GRAM), len(prefix))
        edges[0] = 0
        begin = 0
        while begin < len(prefix):
            i = np.searchsorted(edges, begin + 20_000)
            end = int(edges[min(i, len(edges) - 1)])
            if end <= begin:
                end = int(edges[np.searchsorted(edges, begin, "right")])
            part = slice(begin, end)
            index = ends[part][:, None] - 1 - np.arange(PLACES - 1)[None, :]
            left = flat[np.maximum(index, 0)] if len(flat) else np.zeros(index.shape, np.uint8)
            marks = repeats(prefix[part], left, low[part].astype(int), high[part].astype(int), many[part].astype(float))
            some = np.flatnonzero(marks.any(axis=1))
            packed = np.packbits(marks[some], axis=1)
            out["block"].append(block[part][some])
            out["gram"].append(gram[part][some])
            out["own"].append(own[part][some])
            out["marks"] += [m.tobytes() for m in packed]
            begin = end
        join = lambda c: np.concatenate(out[c]) if out[c] else np.zeros(0, np.int64)
        return pa.table(
            {"block": join("block"), "gram": join("gram"), "own": join("own"), "marks": pa.array(out["marks"], pa.binary())}
        )

    runs = runs.repartition(partitions, "shard")
    marked = runs.groupBy("shard").applyInArrow(merge, "block long, gram long, own long, marks binary")
    nothing = F.lit(None).cast("binary")
    answers = told.where("kind = 0").select("block", "gram", F.lit(0).cast("long").alias("own"), nothing.alias("marks")).union(marked)

    def finish(left: pa.Table, right: pa.Table) -> pa.Table:
        out = {c: [] for c in ("doc_id", "n_bytes", "removed", "kept")}
        gram, own = right.column("gram").to_numpy(), right.column("own").to_numpy()
        marks = right.column("marks").combine_chunks()
        whole = right.column("marks").is_null().to_numpy()
        closed = np.sort(gram[whole])
        partly = np.flatnonzero(~whole)
        bits = np.frombuffer(b"".join(marks[int(i)].as_py() for i in partly), np.uint8).reshape(len(partly), (PLACES + 7) // 8)
        key = _shard(gram[partly], own[partly])
        order = np.argsort(key, kind="stable")
        for row in left.to_pylist():
            ids, ends, data = _opened(row)
            c = contexts(data, ends)
            step = np.zeros(len(data) + 1, np.int32)
            full = _found(closed, c.gram) >= 0
            np.add.at(step, c.first[full], 1)
            np.add.at(step, c.last[full] + LENGTH, -1)
            mine = _shard(c.gram, c.own)
            # A hot context may have come back in several parts.
            begin, end = np.searchsorted(key[order], mine, "left"), np.searchsorted(key[order], mine, "right")
            for part in range(int((end - begin).max()) if len(mine) else 0):
                some = np.flatnonzero(begin + part < end)
                for at in range(0, len(some), 50_000):
                    few = some[at : at + 50_000]
                    at_row, at_place = np.nonzero(np.unpackbits(bits[order[begin[few] + part]], axis=1)[:, :PLACES])
                    start = c.anchor[few[at_row]] - at_place
                    np.add.at(step, start, 1)
                    np.add.at(step, start + LENGTH, -1)
            gone = np.cumsum(step[:-1]) > 0
            low = 0
            for i, high in zip(ids.tolist(), ends.tolist()):
                g = gone[low:high]
                edge = np.flatnonzero(np.diff(np.concatenate([[False], g, [False]]).astype(np.int8)))
                out["doc_id"].append(i)
                out["n_bytes"].append(high - low)
                out["removed"].append([{"start": int(a), "end": int(b)} for a, b in edge.reshape(-1, 2)])
                out["kept"].append(data[low:high][~g].tobytes())
                low = high
        return pa.table(out, schema=arrow)

    arrow = pa.schema(
        [("doc_id", pa.int64()), ("n_bytes", pa.int64()), ("removed", pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))), ("kept", pa.binary())]
    )
    done = blocks.groupBy("block").cogroup(answers.groupBy("block")).applyInArrow(
        finish, "doc_id long, n_bytes long, removed array<struct<start:long,end:long>>, kept binary"
    )
    return done.withColumn("doc_id", F.when(F.col("doc_id") != NO_ID, F.col("doc_id")))


def report(docs: DataFrame) -> DataFrame:
    """Per document: sizes, the number of removed runs, and the digest of what is left."""
    done = cut_repeats(docs)
    n_removed = F.aggregate("removed", F.lit(0).cast("long"), lambda acc, r: acc + r["end"] - r["start"])
    return done.select(
        "doc_id", "n_bytes", n_removed.alias("n_removed"), F.size("removed").cast("long").alias("n_spans"), F.sha2("kept", 256).alias("kept_sha256")
    )

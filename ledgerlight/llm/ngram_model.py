"""Language-model scores from an Elias-Fano trie of word pairs.

Tokens are words ``[^\\x20\\x09-\\x0D]+`` with A-Z lower-cased, and one end a text.
The model interpolates: the probability of w after h is the discounted share of
the pair among what follows h, plus what is left of h's mass times the unigram
probability (c + 0.1) / (N + 0.1 (V + 1)). Every pair of training tokens seen at
least ``LEAST`` times is in the model, whatever its words, and all words and pairs have
exact counts, so the model grows with the input. (A ``SHARE`` above zero keeps only
pairs of words with that share of all tokens, the start and the end.)

How the work is spread:

1. Each partition of documents is turned into blocks of token numbers, kept in
   the checkpoint folder. Words are 64-bit hashes from here on.
2. A block's words with their counts go out once per block, packed into one row a shard
   by hash, are added up, and the totals come back in the order they were asked in.
   Nothing is as large as the vocabulary in any one place, and a hot word costs a few
   bytes per block.
3. A block's distinct pairs, as hashes, go out once per block, packed into one row a
   shard. All pairs of a context are one shard's, which so knows how often the context is
   followed; only contexts with ``SPREAD`` of all tokens, a list of at most 1 / SPREAD,
   are many shards' work, by ranges of successors. A shard adds the pairs up, numbers its
   own contexts and successors and builds its trie: contexts, pointers and successors
   as Elias-Fano sequences and quantised log probabilities, in one memory-mapped level
   after the other. Successors are numbered relative to their context, and a pair is
   looked up by a successor search in the context's range. What is found goes back to
   the blocks in the order they asked in.
4. Each block scores its documents with what came back.

Defined results: a null text is an empty one, whose only token is the end; texts of
any length are scored whole; repeated rows are scored alike and each one counts in
training; without training documents every count is zero; an empty table gives an
empty result. Columns beside doc_id and text are ignored.
"""

from __future__ import annotations

import mmap
from collections.abc import Iterable, Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerlight.llm import labelled, shared

SHARE = 0.0
SPREAD = 1 / 20_000  # of all tokens; contexts that have it are dealt out to several shards
ADDED, DISCOUNT, LEAST = 0.1, 0.5, 1
BLOCK_BYTES = 24_000_000  # of text
STEP = 4096  # quanta of a decimal order of magnitude
PIECE = 1 << 18  # pairs looked up at once
RANGES = 9  # bits of a successor's hash, by whose values the pairs of a common context are dealt out
END = 1  # its hash; words hash to anything else but for a chance of 2**-64
START = 0  # hash of the start as a context, likewise


# Elias-Fano sequences.


class EliasFano:
    """A non-decreasing sequence: low bits packed, high bits in unary, with counts of ones by word.

    Lives in a buffer of its own layout, so that it can be mapped instead of read.
    """

    def __init__(self, buffer, at: int = 0):
        n, low_bits, n_low, n_high = (int(x) for x in np.frombuffer(buffer, np.int64, 4, at))
        self.n, self.low_bits = n, low_bits
        self.low = np.frombuffer(buffer, np.uint64, n_low, at + 32)
        self.high = np.frombuffer(buffer, np.uint64, n_high, at + 32 + 8 * n_low)
        self.ones = np.frombuffer(buffer, np.int64, n_high + 1, at + 32 + 8 * (n_low + n_high))
        self.end = at + 32 + 8 * (n_low + 2 * n_high + 1)

    @staticmethod
    def build(values: np.ndarray) -> bytes:
        values = np.asarray(values, np.uint64)
        n, top = len(values), int(values[-1]) + 1 if len(values) else 1
        low_bits = max(0, (top // max(n, 1)).bit_length() - 1)
        low = np.zeros(n * low_bits // 64 + 2, np.uint64)
        if low_bits:
            part = values & np.uint64((1 << low_bits) - 1)
            place = np.arange(n, dtype=np.uint64) * np.uint64(low_bits)
            word, shift = (place >> np.uint64(6)).astype(np.int64), place & np.uint64(63)
            np.bitwise_or.at(low, word, part << shift)
            over = shift + np.uint64(low_bits) > 64
            np.bitwise_or.at(low, word[over] + 1, part[over] >> (np.uint64(64) - shift[over]))
        place = (values >> np.uint64(low_bits)).astype(np.int64) + np.arange(n)
        high = np.zeros((int(place[-1]) if n else 0) // 64 + 1, np.uint64)
        np.bitwise_or.at(high, place >> 6, np.uint64(1) << (place & 63).astype(np.uint64))
        ones = np.append(0, np.cumsum(np.bitwise_count(high).astype(np.int64)))
        head = np.array([n, low_bits, len(low), len(high)], np.int64)
        return b"".join(x.tobytes() for x in (head, low, high, ones))

    def get(self, index: np.ndarray) -> np.ndarray:
        """The values at ``index``."""
        index = np.asarray(index, np.int64)
        word = np.searchsorted(self.ones, index, "right") - 1
        rest = index - self.ones[word]
        bits = self.high[word]
        at = np.zeros(len(index), np.int64)
        # The place of the rest-th one in a word, by halves.
        for width in (32, 16, 8, 4, 2, 1):
            lower = np.bitwise_count(bits & np.uint64((1 << width) - 1)).astype(np.int64)
            skip = rest >= lower
            rest = np.where(skip, rest - lower, rest)
            at += np.where(skip, width, 0)
            bits = np.where(skip, bits >> np.uint64(width), bits)
        value = (word * 64 + at - index).astype(np.uint64) << np.uint64(self.low_bits)
        if self.low_bits:
            place = index.astype(np.uint64) * np.uint64(self.low_bits)
            w, shift = (place >> np.uint64(6)).astype(np.int64), place & np.uint64(63)
            part = self.low[w] >> shift
            over = shift > 64 - self.low_bits
            part[over] |= self.low[w[over] + 1] << (np.uint64(64) - shift[over])
            value |= part & np.uint64((1 << self.low_bits) - 1)
        return value.astype(np.int64)

    def successor(self, target: np.ndarray, low: np.ndarray, high: np.ndarray) -> np.ndarray:
        """Per target the first index in [low, high) whose value is not less; ``high`` if none is."""
        low, high = low.copy(), high.copy()
        while (open_ := low < high).any():
            middle = (low + high) // 2
            less = np.zeros(len(low), bool)
            less[open_] = self.get(middle[open_]) < target[open_]
            low = np.where(open_ & less, middle + 1, low)
            high = np.where(open_ & ~less, middle, high)
        return low


class Trie:
    """Pairs of numbers under ``universe`` with quantised log probabilities, in one mapped buffer."""

    def __init__(self, first: np.ndarray, second: np.ndarray, quanta: np.ndarray, universe: int):
        """The pairs are sorted and distinct."""
        self.universe = universe
        contexts, begin = np.unique(first, return_index=True)
        rank = np.searchsorted(contexts, first)
        parts = [
            EliasFano.build(contexts),
            EliasFano.build(np.append(begin, len(first))),
            # Relative to its context, a successor is a number under ``universe``.
            EliasFano.build(rank * universe + second),
            quanta.astype(np.uint16).tobytes(),
        ]
        level = mmap.mmap(-1, sum(map(len, parts)))
        level.write(b"".join(parts))
        self.contexts = EliasFano(level)
        self.pointers = EliasFano(level, self.contexts.end)
        self.successors = EliasFano(level, self.pointers.end)
        self.quanta = np.frombuffer(level, np.uint16, len(first), self.successors.end)

    def find(self, first: np.ndarray, second: np.ndarray) -> np.ndarray:
        """The quanta of the pairs; -1 where there is none."""
        out = np.full(len(first), -1, np.int64)
        n = self.contexts.n
        if not n or not len(first):
            return out
        rank = self.contexts.successor(first, np.zeros(len(first), np.int64), np.full(len(first), n))
        some = np.flatnonzero(rank < n)
        some = some[self.contexts.get(rank[some]) == first[some]]
        if not len(some):
            return out
        low, high = self.pointers.get(rank[some]), self.pointers.get(rank[some] + 1)
        target = rank[some] * self.universe + second[some]
        place = self.successors.successor(target, low, high)
        inside = place < high
        some, place, target = some[inside], place[inside], target[inside]
        hit = self.successors.get(place) == target
        out[some[hit]] = self.quanta[place[hit]]
        return out


# Blocks of documents.

BLOCKS = "block long, words binary, tokens binary, docs binary, ends binary, held binary"


def _others(ends: np.ndarray) -> np.ndarray:
    """Which of a block's tokens are words, not ends."""
    word = np.ones(ends[-1], bool)
    word[ends - 1] = False
    return word


def _coded(a: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The distinct values, ascending, and the place of each entry's among them; holds half of what ``np.unique`` does."""
    order = np.argsort(a)
    values = a[order]
    new = np.ones(len(a), bool)
    np.not_equal(values[1:], values[:-1], out=new[1:])
    values = values[new]
    place = np.empty(len(a), np.uint32)
    place[order] = np.cumsum(new, dtype=np.uint32) - np.uint32(1)
    return values, place


def _block(number: int, ids: list[int], held: list[bool], hashes: list[np.ndarray]) -> dict:
    ends = np.cumsum([len(h) + 1 for h in hashes])
    every = np.full(ends[-1], END, np.uint64)
    every[_others(ends)] = np.concatenate(hashes)
    hashes.clear()
    words, token = _coded(every)
    del every
    order = np.argsort(-np.bincount(token), kind="stable")  # frequent words get small numbers
    rank = np.empty(len(order), np.uint32)
    rank[order] = np.arange(len(order), dtype=np.uint32)
    token = rank[token]
    planes = token.view(np.uint8).reshape(-1, 4).T  # bytes of one weight together
    return {
        "block": number,
        "words": words[order].tobytes(),
        "tokens": zstandard.compress(planes.tobytes(), 1),
        "docs": np.array(ids, np.int64).tobytes(),
        "ends": ends.astype(np.int64).tobytes(),
        "held": np.array(held, np.uint8).tobytes(),
    }


class Block:
    """A block's words by number, their training counts, and its documents' tokens by number."""

    def __init__(self, row: dict):
        self.number, self.words = row["block"], np.frombuffer(row["words"], np.int64)
        planes = np.frombuffer(zstandard.decompress(row["tokens"]), np.uint8)
        self.tokens = np.ascontiguousarray(planes.reshape(4, -1).T).view(np.uint32).ravel()
        self.docs, self.ends = np.frombuffer(row["docs"], np.int64), np.frombuffer(row["ends"], np.int64)
        self.held = np.frombuffer(row["held"], np.uint8).astype(bool)
        self.starts = np.append(0, self.ends[:-1])
        self.training = np.repeat(~self.held, self.ends - self.starts)
        self.counts = np.bincount(self.tokens[self.training], minlength=len(self.words))

    def by_shard(self, shards: int) -> tuple[np.ndarray, np.ndarray]:
        """Words in the order of their shards, and these."""
        shard = (shared.mixed(self.words.view(np.uint64)) % np.uint64(shards)).astype(np.int64)
        order = np.argsort(shard, kind="stable")
        return order, shard[order]

    def before(self) -> np.ndarray:
        """Per token, the number of its context plus one; 0 for the start."""
        before = np.empty_like(self.tokens)
        np.add(self.tokens[:-1], np.uint32(1), out=before[1:])
        before[self.starts] = 0
        return before

    def pairs(self, listed: np.ndarray, shards: int, only_listed: bool) -> Pairs:
        """The distinct pairs by shard and context; ``listed`` (sorted) are the common contexts' hashes."""
        key, used = self.before().astype(np.int64), slice(None)
        if only_listed:
            known = np.isin(self.words, listed)
            used = np.flatnonzero(np.append(True, known)[key] & known[self.tokens])
        key <<= 32
        key |= self.tokens
        key, place = _coded(key[used])
        number = (key >> 32).astype(np.uint32)
        key &= 0xFFFFFFFF
        second = self.words[key]
        del key
        first = np.append(START, self.words)[number]
        shard = _shard_of_pairs(first, second, np.append(True, np.isin(self.words, listed))[number], shards)
        order = np.lexsort((first, shard))
        rank = np.empty(len(order), np.uint32)
        rank[order] = np.arange(len(order), dtype=np.uint32)
        place = rank[place]
        del rank
        first, shard = first[order], shard[order]
        head = np.flatnonzero(np.append(True, (first[1:] != first[:-1]) | (shard[1:] != shard[:-1]))[: len(first)])
        return Pairs(used, place, first[head], number[order[head]], head, second[order], shard)


def _shard_of_pairs(first: np.ndarray, second: np.ndarray, is_listed: np.ndarray, shards: int) -> np.ndarray:
    """A context's pairs are one shard's, a common context's by ranges of the second word's hash."""
    part = second.view(np.uint64) >> np.uint64(64 - RANGES)
    part += np.uint64(1)
    part *= is_listed
    part = shared.mixed(part)
    part += first.view(np.uint64)
    return (shared.mixed(part) % np.uint64(shards)).astype(np.int32)


FIRST = 1  # answers: quanta from 1 on; below it there is none


def _quanta(count: np.ndarray, of: np.ndarray) -> np.ndarray:
    return np.minimum(np.rint(-np.log10((count - DISCOUNT) / of) * STEP), 65535 - FIRST).astype(np.int64)


class Pairs(NamedTuple):
    """The distinct pairs of a block, each context's together."""

    used: np.ndarray | slice  # tokens that end a pair
    place: np.ndarray  # which pair each of them ends
    context: np.ndarray  # hashes of the contexts
    number: np.ndarray  # their numbers in the block plus one, 0 for the start
    head: np.ndarray  # the first pair of each
    second: np.ndarray  # per pair, the hash of its second word
    shard: np.ndarray  # per pair, in ascending order

    def counts(self, block: Block) -> np.ndarray:
        """How often each pair is in the block's training documents."""
        return np.bincount(self.place[block.training[self.used]], minlength=len(self.second)).astype(np.uint32)


def _packed(*arrays: np.ndarray) -> bytes:
    """Bytes of one weight together, compressed."""
    sizes = np.array([len(a) for a in arrays], np.int64)
    planes = (np.ascontiguousarray(a).view(np.uint8).reshape(-1, a.itemsize).T.tobytes() for a in arrays)
    return zstandard.compress(b"".join((sizes.tobytes(), *planes)), 1)


def _unpacked(data: bytes, *types: type) -> list[np.ndarray]:
    data = zstandard.decompress(data)
    at, out = 8 * len(types), []
    for size, kind in zip(np.frombuffer(data, np.int64, len(types)), types):
        width = np.dtype(kind).itemsize
        planes = np.frombuffer(data, np.uint8, size * width, at).reshape(width, -1)
        out.append(np.ascontiguousarray(planes.T).view(kind).ravel())
        at += size * width
    return out


def _steps(a: np.ndarray) -> np.ndarray:
    """The differences of ascending numbers, which have fewer bits; ``cumsum`` undoes it, overflow included."""
    return np.diff(a, prepend=a.dtype.type(0))


def _packed_pairs(context: np.ndarray, length: np.ndarray, second: np.ndarray, n: np.ndarray) -> bytes:
    """A block's pairs for a shard; contexts ascend, and a second word that many of them have is sent once."""
    seconds, place = _coded(second)
    return _packed(_steps(context), length, _steps(seconds), place, n)


def _unpacked_pairs(data: bytes) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    context, length, seconds, place, n = _unpacked(data, np.int64, np.uint32, np.int64, np.uint32, np.uint32)
    return np.cumsum(context), length, np.cumsum(seconds)[place], n


def _packed_answer(found: np.ndarray, mass: np.ndarray) -> bytes:
    """Quanta of pairs and masses of contexts, most of which are alike."""
    return _packed(found, *_coded(mass))


def _unpacked_answer(data: bytes) -> tuple[np.ndarray, np.ndarray]:
    found, masses, place = _unpacked(data, np.uint16, np.float64, np.uint32)
    return found, masses[place]


def _blocks(docs: DataFrame) -> DataFrame:
    held = labelled.remainder(10) == 0

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        # A retried task makes the same blocks with the same numbers.
        number = TaskContext.get().partitionId() << 32
        ids, flags, hashes, size = [], [], [], 0

        def done() -> pa.RecordBatch:
            return pa.RecordBatch.from_pylist([_block(number, ids, flags, hashes)], schema=schema)

        for batch in batches:
            for i, h, text in zip(batch.column("doc_id").to_pylist(), batch.column("held").to_pylist(), batch.column("text")):
                text = text.as_py() or ""
                ids.append(i)
                flags.append(h)
                hashes.append(shared.word_hashes(text))
                size += len(text) + 1
                if size >= BLOCK_BYTES:
                    yield done()
                    number += 1
                    ids, flags, hashes, size = [], [], [], 0
        if ids:
            yield done()

    schema = pa.schema([("block", pa.int64()), *((c, pa.binary()) for c in ("words", "tokens", "docs", "ends", "held"))])
    return docs.select(F.coalesce(F.col("doc_id").cast("long"), F.lit(NO_ID)).alias("doc_id"), held.alias("held"), "text").mapInArrow(run, BLOCKS)


NO_ID = -(2**63)  # stands for a null doc_id within blocks


def _rows(batches: Iterable[pa.RecordBatch]) -> Iterator[dict]:
    for batch in batches:
        for i in range(batch.num_rows):
            yield {c: batch.column(c)[i].as_py() for c in batch.schema.names}


def _training_tokens(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for row in _rows(batches):
        ends, held = np.frombuffer(row["ends"], np.int64), np.frombuffer(row["held"], np.uint8).astype(bool)
        yield pa.RecordBatch.from_pydict({"n": pa.array([int(np.diff(ends, prepend=0)[~held].sum())])})


ASKED = pa.schema([("shard", pa.int64()), ("block", pa.int64()), ("asked", pa.binary())])


def _asked(shard: int, block: int, data: bytes) -> pa.RecordBatch:
    return pa.RecordBatch.from_pydict({"shard": [int(shard)], "block": [block], "asked": [data]}, schema=ASKED)


def _runs(shard: np.ndarray) -> Iterator[tuple[int, int]]:
    """Where each shard's entries begin and end."""
    bounds = np.append(np.flatnonzero(np.diff(shard, prepend=-1)), len(shard))
    return zip(bounds[:-1], bounds[1:])


def score(docs: DataFrame) -> DataFrame:
    """Per row of ``docs``: doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score."""
    context = docs.sparkSession.sparkContext
    blocks = shared.cut(_blocks(docs))
    sizes = blocks.select("ends", "held").mapInArrow(_training_tokens, "n long").agg(F.sum("n").alias("n"), F.count("n").alias("blocks")).first()
    # A shard is about two blocks' worth of pairs: with more shards a word is sent to more of them.
    n_tokens, shards = sizes["n"] or 0, max(1, sizes["blocks"] // 2)
    # At most 1 / least words can have that share.
    only_listed, least = SHARE > 0, SHARE or SPREAD

    def words(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for row in _rows(batches):
            b = Block(row)
            order, shard = b.by_shard(shards)
            for low, high in _runs(shard):
                yield _asked(shard[low], b.number, _packed(b.words[order[low:high]], b.counts[order[low:high]].astype(np.uint32)))

    def totals(table: pa.Table) -> pa.Table:
        """A shard's words: added up, with the totals for each block; to block -1 how many there are and the common ones."""
        block, shard = table.column("block").to_pylist(), table.column("shard")[0].as_py()
        asked = [_unpacked(x, np.int64, np.uint32) for x in table.column("asked").to_pylist()]
        distinct, place = np.unique(np.concatenate([a[0] for a in asked]), return_inverse=True)
        place = place.ravel()
        c = np.bincount(place, np.concatenate([a[1] for a in asked]), len(distinct)).astype(np.int64)
        p = np.cumsum([0, *(len(a[0]) for a in asked)])
        blobs = [_packed(c[place[p[i] : p[i + 1]]]) for i in range(len(asked))]
        some = np.flatnonzero((c > 0) & ((c >= least * n_tokens) | (distinct == END)))
        return pa.table(
            {
                "block": np.append(np.array(block, np.int64), np.full(len(some) + 1, -1)),
                "key": np.concatenate([np.full(len(block), shard), distinct[some], [NO_ID]]),
                "value": np.concatenate([np.zeros(len(block)), c[some], [(c > 0).sum()]]).astype(float),
                "found": pa.array(blobs + [None] * (len(some) + 1), pa.binary()),
            }
        )

    asked, answered = "shard long, block long, asked binary", "block long, key long, value double, found binary"
    every = blocks.select("block", "words", "tokens", "docs", "ends", "held")
    counted = every.mapInArrow(words, asked).repartition(shards, "shard").groupBy("shard").applyInArrow(totals, answered)
    counted = shared.cut(counted)
    told = [(r["key"], int(r["value"])) for r in counted.where("block = -1").collect()]
    n_words = sum(c for w, c in told if w == NO_ID)
    frequent = [(w, c) for w, c in told if w != NO_ID]
    n_starts = next((c for w, c in frequent if w == END), 0)
    frequent = sorted([(w, c) for w, c in frequent if c >= least * n_tokens] + [(START, n_starts)])
    # Contexts, and how often each is followed by a token.
    common = context.broadcast(tuple(np.array(x, np.int64) for x in zip(*frequent)))

    def pairs(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        listed, _ = common.value
        for row in _rows(batches):
            b = Block(row)
            p = b.pairs(listed, shards, only_listed)
            n = p.counts(b)
            length = np.diff(np.append(p.head, len(p.second))).astype(np.uint32)
            for low, high in _runs(p.shard):
                c, d = np.searchsorted(p.head, (low, high))
                yield _asked(p.shard[low], b.number, _packed_pairs(p.context[c:d], length[c:d], p.second[low:high], n[low:high]))

    def answer(table: pa.Table) -> pa.Table:
        """A shard's pairs: added up, put into a trie, and looked up for the blocks that hold them."""
        listed, counts = common.value
        block, shard = table.column("block").to_pylist(), table.column("shard")[0].as_py()
        parts = [list(x) for x in zip(*(_unpacked_pairs(x) for x in table.column("asked").to_pylist()))]
        c, p = (np.cumsum([0, *map(len, parts[i])]) for i in (0, 2))
        # What has been taken is let go, so that a shard's pairs are not held many times over.
        n, second = (np.concatenate(parts.pop()) for _ in range(2))
        contexts, of_block = _coded(np.concatenate(parts[0]))
        pair = np.repeat(of_block, np.concatenate(parts[1])).astype(np.int64)
        del parts
        seconds, second = _coded(second)
        pair *= len(seconds)
        pair += second
        del second
        distinct, place = _coded(pair)
        del pair
        total = np.bincount(place, n, len(distinct))
        del n
        first, second = np.divmod(distinct, len(seconds))
        del distinct
        # How often each context is followed by a token: all its pairs are here, or it is listed.
        of = np.bincount(first, total, len(contexts))
        at = np.minimum(np.searchsorted(listed, contexts), len(listed) - 1)
        is_listed = listed[at] == contexts
        of[is_listed] = counts[at[is_listed]]
        kept = total >= LEAST
        quanta = _quanta(total[kept], of[first[kept]])
        trie = Trie(first[kept], second[kept], quanta, len(seconds))
        looked_up = [trie.find(first[i : i + PIECE], second[i : i + PIECE]) for i in range(0, len(first), PIECE)]
        found = (np.concatenate(looked_up) + FIRST).clip(0).astype(np.uint16)[place]
        mass = np.bincount(first[kept], 10.0 ** (-quanta / STEP), len(contexts))
        # The mass that the shard's pairs take from a listed context goes to block -1.
        some = np.flatnonzero(is_listed & (mass > 0))
        own = np.where(is_listed, 0, mass)[of_block]
        blobs = [_packed_answer(found[p[i] : p[i + 1]], own[c[i] : c[i + 1]]) for i in range(len(block))]
        return pa.table(
            {
                "block": np.append(np.array(block, np.int64), np.full(len(some), -1)),
                "key": np.append(np.full(len(block), shard), contexts[some]),
                "value": np.append(np.zeros(len(block)), mass[some]),
                "found": pa.array(blobs + [None] * len(some), pa.binary()),
            }
        )

    paired = every.mapInArrow(pairs, asked).repartition(shards, "shard")
    answers = shared.cut(paired.groupBy("shard").applyInArrow(answer, answered))
    taken = {r["key"]: r["mass"] for r in answers.where("block = -1").groupBy("key").agg(F.sum("value").alias("mass")).collect()}
    left = context.broadcast(np.maximum(1 - np.array([taken.get(w, 0.0) for w, _ in frequent]), 1e-12))

    returned = counted.where("block >= 0").select("block", F.lit(0).alias("kind"), "key", "found")
    returned = returned.union(answers.where("block >= 0").select("block", F.lit(1), "key", "found"))

    def finish(asking: pa.Table, got: pa.Table) -> pa.Table:
        listed, _ = common.value
        kind, key = got.column("kind").to_numpy(), got.column("key").to_numpy()

        def answers_of(k: int) -> list[bytes]:
            """In the order the block asked in."""
            which = np.flatnonzero(kind == k)
            return [got.column("found")[i].as_py() for i in which[np.argsort(key[which])]]

        out = {c: [] for c in ("doc_id", "held_out", "n_tokens", "n_known", "base_score", "score")}
        for row in asking.to_pylist():
            b = Block(row)
            c = np.zeros(len(b.words))
            c[b.by_shard(shards)[0]] = np.concatenate([_unpacked(x, np.int64)[0] for x in answers_of(0)])
            unigram = (c + ADDED) / (n_tokens + ADDED * (n_words + 1))
            add = lambda x: np.add.reduceat(x, b.starts)
            out["doc_id"].append(b.docs)
            out["held_out"].append(b.held)
            out["n_tokens"].append(b.ends - b.starts)
            out["n_known"].append(add((c > 0)[b.tokens].astype(np.int64)))
            out["base_score"].append(add(np.log10(unigram)[b.tokens]))
            p, after = b.pairs(listed, shards, only_listed), np.ones(len(b.words) + 1)
            data = [_unpacked_answer(x) for x in answers_of(1)]
            quanta, mass = (np.concatenate(x) for x in zip(*data)) if data else (np.zeros(0, np.uint16), np.zeros(0))
            del data
            after[p.number] = np.maximum(1 - mass, 1e-12)
            every = np.append(START, b.words)
            at = np.minimum(np.searchsorted(listed, every), len(listed) - 1)
            after = np.where(listed[at] == every, left.value[at], after)
            full = after[b.before()]
            full *= unigram[b.tokens]
            quanta = quanta.astype(np.int64) - FIRST
            share = np.where(quanta >= 0, 10.0 ** (-quanta / STEP), 0.0)
            full[p.used] += share[p.place]
            out["score"].append(add(np.log10(full, out=full)))
        return pa.table({k: np.concatenate(v) if v else np.zeros(0) for k, v in out.items()})

    schema = "doc_id long, held_out boolean, n_tokens long, n_known long, base_score double, score double"
    done = blocks.groupBy("block").cogroup(returned.groupBy("block")).applyInArrow(finish, schema)
    doc_id = F.when(F.col("doc_id") != NO_ID, F.col("doc_id")).alias("doc_id")
    return done.select(doc_id, "held_out", "n_tokens", "n_known", F.lit(n_tokens).cast("long").alias("train_tokens"), "base_score", "score")

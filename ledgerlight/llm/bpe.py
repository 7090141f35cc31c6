"""Byte-level BPE: encoding by a lazily determinised transducer, streaming decoding.

Encoding. Merging a text's bytes by rank ends in the only sequence of tokens in
which every neighbouring pair stays apart when merged on its own. So a text can
be read from left to right: after each byte, a hypothesis is the tokens of a
shorter start of the text plus a place in the trie of tokens. The set of
hypotheses, less the tokens on which all agree, is a state of a transducer, and
those tokens are what it emits. No hypothesis lags by more than the longest
token, which bounds the lookahead. States and transitions are made when a text
first needs them, and dropped together when there are too many.

Decoding. Token bytes pass through a UTF-8 state machine that carries an
unfinished character from one call to the next, so a stream of ids can be turned
into text piece by piece.

Defined results: a null text is an empty one, which has no ids; texts of any
length are encoded whole; equal texts get equal ids; bytes that are not UTF-8
decode to U+FFFD per malformed start; an unknown id raises ``KeyError``. Other
columns pass through; the result column is named by the caller, and a column of
that name is replaced.
"""

from __future__ import annotations

import base64
import functools
import hashlib
import sys
import threading
import types
import uuid
from collections.abc import Callable, Iterable, Iterator
from contextlib import AbstractContextManager, contextmanager
from dataclasses import dataclass

import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, IntegerType, StringType, StructField, StructType

ENDLESS = 1 << 62
HEAD = 5


@dataclass(frozen=True)
class Merges:
    """A vocabulary: ``ranks`` of byte strings, and the two parts each token was last merged from.

    Only tokens that merging their own bytes leads back to have an entry in
    ``parts``; single bytes have themselves.
    """

    pattern: str
    ranks: dict[bytes, int]
    parts: dict[int, tuple[int, int]]


def _last_merge(token: bytes, ranks: dict[bytes, int]) -> tuple[int, int] | None:
    parts = [token[i : i + 1] for i in range(len(token))]
    while len(parts) > 2:
        best, at = ENDLESS, -1
        for i in range(len(parts) - 1):
            rank = ranks.get(parts[i] + parts[i + 1], ENDLESS)
            if rank < best:
                best, at = rank, i
        if at < 0:
            return None
        parts[at : at + 2] = [parts[at] + parts[at + 1]]
    return (ranks[parts[0]], ranks[parts[-1]]) if all(p in ranks for p in parts) else None


@functools.lru_cache(maxsize=4)
def load_merges(path: str, pattern: str) -> Merges:
    """Read a rank file: one base64 byte string and its rank a line. Its size bounds what is broadcast."""
    with open(path, "rb") as lines:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}
    parts = {}
    for token, rank in ranks.items():
        found = _last_merge(token, ranks)
        if found:
            parts[rank] = found
    return Merges(pattern, ranks, parts)


class Encoder:
    """The transducer of one vocabulary, with what it has determinised so far."""

    def __init__(self, merges: Merges, most_transitions: int = 800_000, most_bytes: int = 160_000_000):
        self.ranks, self.parts = merges.ranks, merges.parts
        self.bytes_of = {r: b for b, r in merges.ranks.items()}
        self.split = regex.compile(merges.pattern).findall
        self.most_transitions, self.most_bytes = most_transitions, most_bytes
        self.apart: dict[int, bool] = {}
        # A node of the trie: its children by byte, and the token that ends in it.
        self.children: list[dict[int, int]] = [{}]
        self.token: list[int] = [-1]
        for rank in merges.parts:
            node = 0
            for byte in self.bytes_of[rank]:
                if byte not in self.children[node]:
                    self.children[node][byte] = len(self.children)
                    self.children.append({})
                    self.token.append(-1)
                node = self.children[node][byte]
            self.token[node] = rank
        # Pieces met, and about how many bytes they take here.
        self.pieces: dict[str, tuple[int, ...]] = {}
        self.held = 0
        self._forget()

    def _forget(self) -> None:
        start = (((-1,), 0),)
        self.states = {start: 0}
        self.hypotheses = [start]
        # By state and byte: the next state and the tokens emitted.
        self.moves: dict[int, tuple[int, tuple[int, ...]]] = {}
        # Where the first bytes of a piece lead, as most pieces share theirs with others.
        self.heads: dict[bytes, tuple[int, list[int]]] = {}
        self.apart.clear()

    def stay_apart(self, a: int, b: int) -> bool:
        """Whether merging the bytes of token ``a`` and of token ``b`` after it never merges across the seam.

        Walks back through the merges at the seam, the latest first: a pair that
        stood there is merged if its rank comes before that of what became of
        either part, the left pair going first among equals.
        """
        ranks, bytes_of, parts = self.ranks, self.bytes_of, self.parts
        left, right = bytes_of[a], bytes_of[b]
        made_a, made_b = a if len(left) > 1 else -1, b if len(right) > 1 else -1
        left_until = right_until = ENDLESS
        while True:
            rank = ranks.get(left + right)
            if rank is not None and rank < left_until and rank <= right_until:
                return False
            if made_a > made_b:
                left_until, a = made_a, parts[a][1]
                left = bytes_of[a]
                made_a = a if len(left) > 1 else -1
            elif made_b >= 0:
                right_until, b = made_b, parts[b][0]
                right = bytes_of[b]
                made_b = b if len(right) > 1 else -1
            else:
                return True

    def _move(self, state: int, byte: int) -> tuple[int, tuple[int, ...]]:
        """Determinise one transition: the next state and the tokens emitted."""
        children, token_of, apart = self.children, self.token, self.apart
        after = []
        for path, node in self.hypotheses[state]:
            child = children[node].get(byte)
            if child is None:
                continue
            if children[child]:
                after.append((path, child))
            token = token_of[child]
            if token >= 0:
                last = path[-1]
                pair = last << 20 | token
                apart_here = last < 0 or apart.get(pair)
                if apart_here is None:
                    apart_here = apart[pair] = self.stay_apart(last, token)
                if apart_here:
                    after.append(((*path, token), 0))
        agreed, emitted = 1, ()
        first = after[0][0]
        if len(after) == 1:
            agreed = len(first)
        else:
            shortest = min([len(path) for path, _ in after])
            while agreed < shortest and all([path[agreed] == first[agreed] for path, _ in after]):
                agreed += 1
        if agreed > 1:
            emitted = first[1:agreed]
            after = [(path[agreed - 1 :], node) for path, node in after]
        if after[0][0][0] >= 0 and all([len(path) > 1 for path, _ in after]):
            # The last token emitted matters to no later pair: states that differ in it alone are one.
            after = [((-1, *path[1:]), node) for path, node in after]
        key = tuple(after)
        to = self.states.get(key)
        if to is None:
            to = self.states[key] = len(self.hypotheses)
            self.hypotheses.append(key)
        move = self.moves[state << 8 | byte] = to, emitted
        return move

    def _run(self, data: bytes, state: int, ids: list[int]) -> tuple[int, list[int]]:
        """Read bytes from a state: the state reached, and ``ids`` with what was emitted."""
        known, move = self.moves.get, self._move
        for byte in data:
            state, emitted = known(state << 8 | byte) or move(state, byte)
            if emitted:
                ids += emitted
        return state, ids

    def _piece(self, piece: str) -> tuple[int, ...]:
        """The ids of one match of the pattern."""
        data = piece.encode()
        whole = self.ranks.get(data)
        if whole is not None:
            return (whole,)
        if len(self.moves) > self.most_transitions:
            self._forget()
        head = self.heads.get(data[:HEAD])
        if head is None:
            head = self.heads[data[:HEAD]] = self._run(data[:HEAD], 0, [])
        state, ids = self._run(data[HEAD:], head[0], head[1].copy())
        for path, node in self.hypotheses[state]:
            if node == 0:
                return (*ids, *path[1:])
        raise AssertionError("a text always has one sequence of tokens")

    def encode(self, text: str | None) -> list[int]:
        """The ids of a whole text."""
        known, ids = self.pieces, []
        for piece in self.split(text or ""):
            found = known.get(piece)
            if found is None:
                found = self._piece(piece)
                self.held += 160 + 4 * len(piece) + 8 * len(found)
                if self.held > self.most_bytes:
                    known.clear()
                    self.held = 0
                known[piece] = found
            ids += found
        return ids


# The UTF-8 state machine. A state is how many continuation bytes are missing
# and the range that the next one must lie in.
ASCII_STATE = (0, 0x80, 0xBF)


def _lead(byte: int) -> tuple[int, int, int] | None:
    """The state after the first byte of a character; None if no character starts so."""
    if byte < 0x80:
        return ASCII_STATE
    if 0xC2 <= byte <= 0xDF:
        return 1, 0x80, 0xBF
    if 0xE0 <= byte <= 0xEF:
        return 2, 0xA0 if byte == 0xE0 else 0x80, 0x9F if byte == 0xED else 0xBF
    if 0xF0 <= byte <= 0xF4:
        return 3, 0x90 if byte == 0xF0 else 0x80, 0x8F if byte == 0xF4 else 0xBF
    return None


def _step(state: tuple[int, int, int, int], byte: int) -> tuple[int, int, int, int] | None:
    """The state after one more byte; None if it cannot follow. The last number of a state is how many bytes wait."""
    missing, low, high, waiting = state
    if missing:
        return ((missing - 1, 0x80, 0xBF, waiting + 1) if missing > 1 else READY) if low <= byte <= high else None
    lead = _lead(byte)
    return None if lead is None else (*lead, 1) if lead[0] else READY


READY = (*ASCII_STATE, 0)
MALFORMED = -1


class Decoder:
    """Turns a stream of ids into text; an unfinished character waits for the next ids.

    Every byte goes through the state machine. What it does with a whole token's bytes is
    worked out once for each state that the token is met in, and looked up from then on:
    a stretch of tokens that all lead from the first state back to it is told at once.
    """

    def __init__(self, bytes_of: dict[int, bytes]):
        self.bytes_of = bytes_of.__getitem__
        self.states, self.numbers = [READY], {READY: 0}
        self.after: list[dict[int, int]] = [{}]  # by state, then id: the next state
        self.whole: set[int] = set()  # ids that lead from the first state back to it
        self.at, self.waiting = 0, b""

    def _after(self, at: int, token: int) -> int:
        state = self.states[at]
        for byte in self.bytes_of(token):
            state = _step(state, byte)
            if state is None:
                break
        to = MALFORMED if state is None else self._number(state)
        self.after[at][token] = to
        if at == to == 0:
            self.whole.add(token)
        return to

    def _number(self, state: tuple[int, int, int, int]) -> int:
        if state not in self.numbers:
            self.numbers[state] = len(self.states)
            self.states.append(state)
            self.after.append({})
        return self.numbers[state]

    def feed(self, ids: list[int]) -> str:
        """The text that is complete after these ids."""
        at = self.at
        if at or not self.whole.issuperset(ids):
            for token in ids:
                to = self.after[at].get(token)
                at = self._after(at, token) if to is None else to
                if at < 0:
                    return self._replacing(ids)
        data = self.waiting + b"".join(map(self.bytes_of, ids))
        cut = len(data) - self.states[at][3]
        self.at, self.waiting = at, data[cut:]
        return data[:cut].decode()

    def _replacing(self, ids: list[int]) -> str:
        """The same byte by byte, where some cannot follow: each malformed stretch becomes one replacement."""
        out, waiting, state = [], bytearray(self.waiting), self.states[self.at]
        for byte in b"".join(map(self.bytes_of, ids)):
            to = _step(state, byte)
            if to is None and state != READY:
                out.append("\ufffd")
                waiting.clear()
                to = _step(READY, byte)
            if to is None:
                out.append("\ufffd")
                to = READY
            else:
                waiting.append(byte)
            if to == READY and waiting:
                out.append(waiting.decode())
                waiting.clear()
            state = to
        self.at, self.waiting = self._number(state), bytes(waiting)
        return "".join(out)

    def finish(self) -> str:
        """What is left at the end of the stream: a character cut short is malformed."""
        left = "\ufffd" if self.waiting else ""
        self.at, self.waiting = 0, b""
        return left

    def decode(self, ids: list[int]) -> str:
        return self.feed(ids) + self.finish()


def _added(docs: DataFrame, out: str, kind) -> tuple[list[str], StructType]:
    kept = [c for c in docs.columns if c != out]
    return kept, StructType([*(docs.schema[c] for c in kept), StructField(out, kind)])


def _small(batches: Iterable[pa.RecordBatch], rows: int = 256) -> Iterator[pa.RecordBatch]:
    """Smaller batches, so that what is made of very long texts is never held for many of them."""
    for batch in batches:
        for at in range(0, batch.num_rows, rows):
            yield batch.slice(at, rows)


IDLE = 2.0  # seconds without a task after which a worker process gives its encoder up


def _broadcast(docs: DataFrame, merges: Merges) -> Callable[[], AbstractContextManager[Encoder]]:
    """What lends a task its worker process's encoder, which keeps what it has determinised for the tasks after it.

    Once no more of them come it goes, so that later stages have its memory.
    """
    shared = docs.sparkSession.sparkContext.broadcast((merges.pattern, merges.ranks, merges.parts))
    name = f"byte_bpe_{uuid.uuid4().hex}"

    @contextmanager
    def encoder() -> Iterator[Encoder]:
        # Modules outlive tasks; of one query's encoder there is one, and the ones before it go.
        if name not in sys.modules:
            for old in [m for m in sys.modules if m.startswith("byte_bpe_")]:
                del sys.modules[old]
            holder = types.ModuleType(name)
            holder.encoder, holder.going = Encoder(Merges(*shared.value)), None
            sys.modules[name] = holder
        holder = sys.modules[name]
        if holder.going is not None:
            holder.going.cancel()
        try:
            yield holder.encoder
        finally:
            holder.going = threading.Timer(IDLE, sys.modules.pop, (name, None))
            holder.going.daemon = True
            holder.going.start()

    return encoder


def encode(docs: DataFrame, merges: Merges, text: str = "text", out: str = "ids") -> DataFrame:
    """``docs`` with ``out``, the token ids of ``text``: one pass where the rows are, no shuffle."""
    kept, schema = _added(docs, out, ArrayType(IntegerType(), False))
    own = _broadcast(docs, merges)

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        with own() as encoder:
            for b in _small(batches):
                ids = pa.array([encoder.encode(t) for t in b.column("__text").to_pylist()], pa.list_(pa.int32()))
                yield pa.RecordBatch.from_arrays([*(b.column(c) for c in kept), ids], [*kept, out])

    return docs.select(*[F.col(f"`{c}`") for c in kept], F.col(f"`{text}`").alias("__text")).mapInArrow(run, schema)


def decode(docs: DataFrame, merges: Merges, ids: str = "ids", out: str = "text") -> DataFrame:
    """``docs`` with ``out``, the text of the token ids; null ids are none."""
    kept, schema = _added(docs, out, StringType())
    shared = docs.sparkSession.sparkContext.broadcast((merges.pattern, merges.ranks, merges.parts))

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        decoder = Decoder({r: b for b, r in shared.value[1].items()})
        for b in _small(batches):
            texts = pa.array([decoder.decode(i or []) for i in b.column("__ids").to_pylist()], pa.string())
            yield pa.RecordBatch.from_arrays([*(b.column(c) for c in kept), texts], [*kept, out])

    return docs.select(*[F.col(f"`{c}`") for c in kept], F.col(f"`{ids}`").alias("__ids")).mapInArrow(run, schema)


def report(docs: DataFrame, merges: Merges, chunk: int = 4096) -> DataFrame:
    """Per document: the number and digest of its ids, and the digest of what they decode to, ``chunk`` ids at a time."""
    own = _broadcast(docs, merges)

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        with own() as encoder:
            decoder = Decoder(encoder.bytes_of)
            for b in batches:
                n_tokens, digests, decoded = [], [], []
                for text in b.column("text"):
                    ids = encoder.encode(text.as_py())
                    back = hashlib.sha256()
                    for at in range(0, len(ids), chunk):
                        back.update(decoder.feed(ids[at : at + chunk]).encode())
                    back.update(decoder.finish().encode())
                    n_tokens.append(len(ids))
                    digests.append(hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest())
                    decoded.append(back.hexdigest())
                yield pa.RecordBatch.from_arrays(
                    [b.column("doc_id"), pa.array(n_tokens, pa.int64()), pa.array(digests), pa.array(decoded)],
                    ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"],
                )

    schema = StructType(
        [
            docs.schema["doc_id"],
            *StructType.fromDDL("n_tokens long, ids_sha256 string, decoded_sha256 string").fields,
        ]
    )
    return docs.select("doc_id", "text").mapInArrow(run, schema)

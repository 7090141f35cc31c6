"""Periodic runs of words, found in grammar-compressed texts.

The words of each text are numbered and compressed by Re-Pair: repeated pairs of
neighbouring symbols become new symbols, the more frequent pair first wherever two
overlap, until no pair is left that pays. A round replaces, in all texts of a group at
once, every occurrence that comes first among its neighbours, so that a grammar takes
few rounds. Each symbol is a left and a right part; every run of a text crosses the
boundary of just one node of its derivation that holds it whole. So the stretches that
cross a symbol's boundary are computed once, at one place where the symbol stands, and
are then copied to all positions of its derivation; boundaries between the symbols that
are left at the end are looked at within the whole text. Of intervals with one period
only those not within another stay, and of periods of one interval the smallest.

A run of period q that crosses a boundary has at least max(12, 1.5 q) words on one side
of it, so the max(12 - q, q / 2) words next to the boundary stand there again q words
away. Periods are taken octave by octave with words of that length, whose occurrences
within the octave's distance are looked up in sorted order: highly periodic places,
which have many, are those that the grammar has few boundaries in. How far a period
extends is found by halving, with hashes; the stretches are compared word by word in
the end, and measured anew if a hash was wrong.

A run is a stretch of words with smallest period q (words q apart are equal) and a length
of at least max(24, 3 q), which no neighbouring word extends. A word is repeated if a run
holds it after that run's first q words. Words are ``[^\\x20\\x09-\\x0D]+``.

Defined results: a null text has no words; null ids stay null, and rows are reported one
by one, repeated or not. Runs never cross texts. A very long text is a group of its own,
in memory proportional to its length; there is no cap. Columns beside those named are
ignored by ``report`` and kept by ``collapse``. Empty tables give empty results.
"""

from __future__ import annotations

import hashlib
import zlib
from collections.abc import Callable, Iterable, Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, StringType, StructField, StructType

SHORTEST, TIMES = 24, 3  # a run has at least so many words, and so many periods
GROUP = 1 << 18  # words that are compressed together
PAIRS = 1 << 21  # pairs of places that are compared at once

Words = list[bytes]


class Grammar(NamedTuple):
    """Symbols below ``words`` are words; ``left``, ``right``, ``size``, ``seen`` and ``level`` are by symbol.

    ``seen`` is one place where the symbol stands; ``symbols`` at ``places`` are what the texts became.
    """

    words: int
    left: np.ndarray
    right: np.ndarray
    size: np.ndarray
    seen: np.ndarray
    level: np.ndarray
    symbols: np.ndarray
    places: np.ndarray


def re_pair(ids: np.ndarray, text_of: np.ndarray) -> Grammar:
    """The grammar of word ids; no pair crosses texts, and each text counts its own pairs."""
    n, words = len(ids), int(ids.max()) + 1 if len(ids) else 0
    limit = words + n
    left, right = np.full(limit, -1), np.full(limit, -1)
    size, seen, level = np.ones(limit, np.int64), np.zeros(limit, np.int64), np.zeros(limit, np.int64)
    known, named, made = np.zeros(0, np.int64), np.zeros(0, np.int64), words
    symbols, places, texts = ids.astype(np.int64), np.arange(n), text_of
    joined = np.append(texts[:-1] == texts[1:], False) if n else np.zeros(0, bool)  # with the next symbol
    candidate = joined.copy()
    done = []
    while True:
        at = np.flatnonzero(candidate)
        key = (texts[at] * limit + symbols[at]) * limit + symbols[at + 1]
        _, group, count = np.unique(key, return_inverse=True, return_counts=True)
        often = count[group] >= 2
        at, key, group = at[often], key[often], group[often]
        if not len(at):
            break
        first = np.zeros(len(symbols) + 2, np.int64)  # which of two overlapping pairs comes first; shifted by one
        first[at + 1] = count[group] * (len(count) + 1) + group + 1
        mine = first[at + 1]
        wins = (first[at] <= mine) & (first[at + 2] <= mine)
        # Where a pair overlaps itself, as in a a a, every second occurrence is taken.
        begins = np.append(True, (np.diff(at) > 1) | (mine[1:] != mine[:-1]))
        offset = np.arange(len(at)) - np.maximum.accumulate(np.where(begins, np.arange(len(at)), 0))
        wins &= offset % 2 == 0
        taken = at[wins]
        pairs, sample, which = np.unique(key[wins], return_index=True, return_inverse=True)
        rule = np.searchsorted(known, pairs)
        old = np.append(known, -1)[rule] == pairs
        rule = np.append(named, -1)[rule]
        fresh = np.flatnonzero(~old)
        rule[fresh] = made + np.arange(len(fresh))
        where = taken[sample[fresh]]
        new = rule[fresh]
        left[new], right[new], seen[new] = symbols[where], symbols[where + 1], places[where]
        size[new] = size[left[new]] + size[right[new]]
        level[new] = 1 + np.maximum(level[left[new]], level[right[new]])
        made += len(fresh)
        known = np.append(known, pairs[fresh])
        order = np.argsort(known, kind="stable")
        known, named = known[order], np.append(named, new)[order]

        candidate[:] = False
        candidate[at] = True
        candidate[taken] = True
        candidate[taken[taken > 0] - 1] = True
        symbols[taken] = rule[which]
        joined[taken] = joined[taken + 1]
        alive = np.ones(len(symbols), bool)
        alive[taken + 1] = False
        # Texts without any pair left to look at are done.
        candidate &= joined
        going = np.zeros(int(texts[-1]) + 1, bool)
        going[texts[candidate & alive]] = True
        stay = going[texts]
        if 4 * stay.sum() < 3 * len(symbols):
            done.append((symbols[alive & ~stay], places[alive & ~stay]))
            alive &= stay
        symbols, places, texts = symbols[alive], places[alive], texts[alive]
        joined, candidate = joined[alive], candidate[alive]
        if not len(symbols):
            break
    done.append((symbols, places))
    symbols, places = np.concatenate([d[0] for d in done]), np.concatenate([d[1] for d in done])
    order = np.argsort(places, kind="stable")
    return Grammar(words, left[:made], right[:made], size[:made], seen[:made], level[:made], symbols[order], places[order])


class Hashes:
    """Hashes of any stretch of words, equal for equal stretches."""

    def __init__(self, ids: np.ndarray):
        value = np.random.default_rng(20240613).integers(0, 1 << 63, int(ids.max()) + 1, np.uint64)[ids]
        base, back = 0x9E3779B97F4A7C15, pow(0x9E3779B97F4A7C15, -1, 1 << 64)
        powers = np.ones(len(ids) + 1, np.uint64)
        self.shift = powers.copy()
        np.cumprod(np.full(len(ids), base, np.uint64), out=powers[1:])
        np.cumprod(np.full(len(ids), back, np.uint64), out=self.shift[1:])
        self.sums = np.zeros(len(ids) + 1, np.uint64)
        np.cumsum(value * powers[:-1], out=self.sums[1:])

    def of(self, start: np.ndarray, length: int) -> np.ndarray:
        return (self.sums[start + length] - self.sums[start]) * self.shift[start]


def _near(octave: int) -> int:
    """How many words next to the boundary stand there again, for any period of an octave."""
    periods = range(1 << octave, 2 << octave) if octave < 6 else (1 << octave,)
    return min(max(SHORTEST // 2 - q, TIMES * q - TIMES * q // 2 - q) for q in periods)


def _extend(h: Hashes, anchor: np.ndarray, q: np.ndarray, low: np.ndarray, high: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Start and end of the stretch of period q about the anchor, within low and high.

    Each word from the anchor on, and before it, is compared with the one q before.
    """
    on, back = np.zeros_like(anchor), np.zeros_like(anchor)
    step = 1 << int(max((high - low).max(), 1)).bit_length()
    while step:
        for reach, room in ((on, high - anchor), (back, anchor - q - low)):
            i = np.flatnonzero(reach + step <= room)
            start = anchor[i] + on[i] if reach is on else anchor[i] - back[i] - step
            same = h.of(start, step) == h.of(start - q[i], step)
            reach[i[same]] += step
        step >>= 1
    return anchor - q - back, anchor + on


def _places(ids: np.ndarray, h: Hashes, text_of: np.ndarray, length: int, among: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Of the places ``among``, those whose next ``length`` words stand elsewhere in the text too, and those words' number."""
    end = among + length
    among = among[end <= len(ids)]
    among = among[text_of[among] == text_of[among + length - 1]]
    key = h.of(among, length) ^ (text_of[among].astype(np.uint64) * np.uint64(0xD6E8FEB86659FD93))
    _, number, count = np.unique(key, return_inverse=True, return_counts=True)
    again = count[number] > 1
    return among[again], number[again]


def stretches(ids: np.ndarray, text_of: np.ndarray, low: np.ndarray, at: np.ndarray, high: np.ndarray) -> tuple[np.ndarray, ...]:
    """(boundary, start, end, period) of the periodic stretches that cross the boundaries ``at`` within low and high.

    Long enough for a run; periods need not be the smallest, and one stretch may come more than once.
    """
    h, n = Hashes(ids), len(ids)
    shortest = _near(3)
    base, _ = _places(ids, h, text_of, shortest, np.arange(n))
    found = [np.zeros((4, 0), np.int64)]
    among, octave = base, 0
    last = int((high - low).max()) // TIMES if len(at) else 0
    number_at = np.full(n + 1, -1)
    while 1 << octave <= last and len(base):
        length = _near(octave)
        where, number = _places(ids, h, text_of, length, base if octave <= 3 else among)
        if octave >= 3:
            among = where
            if not len(among):
                break
        number_at[:] = -1
        number_at[where] = number
        order = np.argsort(number, kind="stable")  # by number, then place
        place, rank = where[order], number[order] * (n + 1) + where[order]
        least, most = 1 << octave, (2 << octave) - 1
        wide = high - low >= max(SHORTEST, TIMES * least)
        for side in (-1, 1):
            start = at - length if side < 0 else at
            fits = wide & (start >= low) & (start + length <= high)
            b = np.flatnonzero(fits)
            b = b[number_at[start[b]] >= 0]
            s = start[b]
            lo = np.maximum(s - most, low[b]) if side < 0 else s + least
            hi = s - least if side < 0 else np.minimum(s + most, high[b] - length)
            one = number_at[s] * (n + 1)
            first, end = np.searchsorted(rank, one + lo), np.searchsorted(rank, one + np.maximum(hi, lo - 1), "right")
            many = np.maximum(end - first, 0)
            cuts = np.flatnonzero(np.diff(np.cumsum(many) // PAIRS)) + 1
            for x, y in zip([0, *cuts], [*cuts, len(b)]):
                m = many[x:y]
                if not m.sum():
                    continue
                i = np.repeat(np.arange(x, y), m)
                partner = place[np.repeat(first[x:y], m) + np.arange(m.sum()) - np.repeat(np.cumsum(m) - m, m)]
                q = np.abs(partner - s[i])
                anchor = np.maximum(partner, s[i])
                started, ended = _extend(h, anchor, q, low[b[i]], high[b[i]])
                enough = ended - started >= np.maximum(SHORTEST, TIMES * q)
                found.append(np.unique(np.stack([b[i], started, ended, q])[:, enough], axis=1))
        octave += 1
    return tuple(np.unique(np.concatenate(found, axis=1), axis=1))


def _exact(ids: np.ndarray, low: np.ndarray, at: np.ndarray, high: np.ndarray, found: tuple[np.ndarray, ...]) -> tuple[np.ndarray, ...]:
    """The stretches compared word by word, each with its smallest period; where hashes were wrong, those that are there instead.

    Of the sorted stretches, those of one boundary, start and end follow each other, the smallest period first; the
    others are its multiples.
    """
    b, start, end, q = found
    opens = _opens(found)
    one, which = np.unique(np.stack([start, end, q])[:, opens], axis=1, return_inverse=True)
    right = np.array([np.array_equal(ids[s : e - p], ids[s + p : e]) for s, e, p in one.T.tolist()], bool)[which]
    out = [np.stack(found)[:, opens][:, right]]
    for i in np.flatnonzero(~right[np.cumsum(opens) - 1]):
        p, x, y = int(q[i]), int(low[b[i]]), int(high[b[i]])
        edge = np.diff(np.concatenate([[0], (ids[x : y - p] == ids[x + p : y]).astype(np.int8), [0]]))
        s, e = x + np.flatnonzero(edge == 1), x + np.flatnonzero(edge == -1) + p
        crosses = (s < at[b[i]]) & (e > at[b[i]]) & (e - s >= max(SHORTEST, TIMES * p))
        out.append(np.stack([np.full(len(s), b[i]), s, e, np.full(len(s), p)])[:, crosses])
    made = np.unique(np.concatenate(out, axis=1), axis=1)
    return tuple(made[:, _opens(made)])


def _opens(found: np.ndarray) -> np.ndarray:
    """Which of the sorted stretches have another boundary, start or end than the one before."""
    opens = np.ones(len(found[0]), bool)
    opens[1:] = (np.diff(found[0]) != 0) | (np.diff(found[1]) != 0) | (np.diff(found[2]) != 0)
    return opens


def runs(ids: np.ndarray, starts: np.ndarray) -> tuple[np.ndarray, ...]:
    """(text, start, length, period) of all runs of texts that begin at ``starts`` (the last one: the end), in order."""
    text_of = np.repeat(np.arange(len(starts) - 1), np.diff(starts))
    if not len(ids):
        return (np.zeros(0, np.int64),) * 4
    g = re_pair(ids, text_of)
    rule = np.flatnonzero(g.size >= SHORTEST)
    rule = rule[rule >= g.words]
    between = np.flatnonzero(text_of[g.places[:-1]] == text_of[g.places[1:]])
    text = text_of[g.places[between]]
    low = np.append(g.seen[rule], starts[text])
    at = np.append(g.seen[rule] + g.size[g.left[rule]], g.places[between + 1])
    high = np.append(g.seen[rule] + g.size[rule], starts[text + 1])
    b, start, end, q = _exact(ids, low, at, high, stretches(ids, text_of, low, at, high))
    inside = b < len(rule)
    found = [np.stack([start[~inside], end[~inside], q[~inside]])]

    # What symbols hold goes to all their positions; only symbols that hold something are expanded.
    holder = rule[b[inside]]
    order = np.argsort(holder, kind="stable")
    holder, offset = holder[order], start[inside][order] - g.seen[holder[order]]
    length, period = (end - start)[inside][order], q[inside][order]
    own = np.bincount(holder, minlength=len(g.left))
    first = np.cumsum(own) - own
    holds = own > 0
    by_level = np.argsort(g.level[g.words :], kind="stable") + g.words
    for some in np.split(by_level, np.flatnonzero(np.diff(g.level[by_level])) + 1):
        holds[some] |= holds[g.left[some]] | holds[g.right[some]]
    symbol, place = g.symbols, g.places
    while True:
        keep = holds[symbol]
        symbol, place = symbol[keep], place[keep]
        if not len(symbol):
            break
        m = own[symbol]
        j = np.repeat(first[symbol], m) + np.arange(m.sum()) - np.repeat(np.cumsum(m) - m, m)
        begin = np.repeat(place, m) + offset[j]
        found.append(np.stack([begin, begin + length[j], period[j]]))
        symbol, place = (
            np.append(g.left[symbol], g.right[symbol]),
            np.append(place, place + g.size[g.left[symbol]]),
        )

    start, end, q = np.concatenate(found, axis=1)
    text = text_of[start]
    order = np.lexsort((-end, start, q, text))
    text, start, end, q = text[order], start[order], end[order], q[order]
    # Intervals of one period within one another: the first that reaches furthest stays.
    group = text * (len(ids) + 1) + q
    opens = np.append(True, group[1:] != group[:-1]) if len(group) else np.zeros(0, bool)
    reach = np.maximum.accumulate(end + np.cumsum(opens) * (len(ids) + 1)) if len(group) else end
    stays = opens | (reach > np.append(0, reach[:-1]))
    text, start, end, q = text[stays], start[stays], end[stays], q[stays]
    # Of the periods of one interval, the smallest.
    order = np.lexsort((q, end, start, text))
    text, start, end, q = text[order], start[order], end[order], q[order]
    if len(text):
        same = (text[1:] == text[:-1]) & (start[1:] == start[:-1]) & (end[1:] == end[:-1])
        keep = np.append(True, ~same)
        text, start, end, q = text[keep], start[keep], end[keep], q[keep]
    order = np.lexsort((q, start, text))
    return text[order], (start - starts[text])[order], (end - start)[order], q[order]


def runs_of(texts: list[Words]) -> list[list[tuple[int, int, int]]]:
    """The runs (start, length, period) of each of some texts."""
    starts = np.append(0, np.cumsum([len(w) for w in texts])).astype(np.int64)
    words = pa.array([w for t in texts for w in t], pa.binary()).dictionary_encode()
    found = [[] for _ in texts]
    for t, *run in zip(*[a.tolist() for a in runs(words.indices.to_numpy().astype(np.int64), starts)]):
        found[t].append(tuple(run))
    return found


def kept_words(words: Words, found: list[tuple[int, int, int]]) -> Words:
    """The words that no run repeats."""
    if not found:
        return words
    change = np.zeros(len(words) + 1, np.int64)
    for start, length, period in found:
        change[start + period] += 1
        change[start + length] -= 1
    return [words[i] for i in np.flatnonzero(np.cumsum(change[:-1]) == 0)]


def _grouped(texts: Iterable[Words]) -> Iterator[tuple[Words, list[tuple[int, int, int]]]]:
    """Each text with its runs; texts are compressed in groups of some ``GROUP`` words."""
    group, n = [], 0
    for words in texts:
        if group and n + len(words) > GROUP:
            yield from zip(group, runs_of(group))
            group, n = [], 0
        group.append(words)
        n += len(words)
    if group:
        yield from zip(group, runs_of(group))


def _words(texts: pa.Array) -> Iterator[Words]:
    for text in texts.cast(pa.binary()):
        yield (text.as_py() or b"").split()


def collapse(docs: DataFrame, text: str = "text", out: str = "runs") -> DataFrame:
    """``docs`` with ``text`` without repeated words (the rest joined by spaces), and ``out``, its runs.

    A run is (start, length, period) in words. A text without runs stays as it was, and null stays null.
    """
    kept = [c for c in docs.columns if c not in (text, out)]
    fields = [StructField(f"__{i}", docs.schema[c].dataType) for i, c in enumerate(kept)]  # columns of any name
    kind = ArrayType(StructType.fromDDL("start long, length long, period long"))
    schema = StructType([*fields, StructField("__text", StringType()), StructField("__runs", kind)])
    run_type = pa.list_(pa.struct([("start", pa.int64()), ("length", pa.int64()), ("period", pa.int64())]))

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            texts, made, found = b.column("__text").to_pylist(), [], []
            for whole, (words, r) in zip(texts, _grouped(_words(b.column("__text")))):
                made.append(b" ".join(kept_words(words, r)).decode() if r else whole)
                found.append([dict(zip(("start", "length", "period"), x)) for x in r])
            arrays = [*b.columns[:-1], pa.array(made, pa.string()), pa.array(found, run_type)]
            yield pa.RecordBatch.from_arrays(arrays, schema.fieldNames())

    numbered = docs.select(*[F.col(f"`{c}`").alias(f.name) for c, f in zip(kept, fields)], F.col(f"`{text}`").alias("__text"))
    return numbered.mapInArrow(run, schema).toDF(*kept, text, out)


def planted(doc_id: int | None, words: Words) -> Words:
    """The words as ``op13`` takes them: every tenth document by a hash of doc_id ends in repetitions of its own words."""
    h, n = 1 if doc_id is None else zlib.crc32(str(doc_id).encode()), len(words)
    if h % 10 or not n:
        return words
    g = h // 10
    a = g % n
    p = 1 + (n - a) // (3 + g % 8)
    return words[:a] + (words[a : a + p] * (-(-(n - a) // p)))[: n - a]


RESULT = """n_runs long, start long, length long, period long, exponent_milli long,
    runs_sha256 string, collapsed_sha256 string"""


def _summary(words: Words, found: list[tuple[int, int, int]]) -> tuple:
    best = (None,) * 3
    for start, length, period in found:  # by start, then period: the first of equal ones stays
        if best[0] is None or length * best[2] > best[1] * period:
            best = (start, length, period)
    milli = None if best[0] is None else 1000 * best[1] // best[2]
    listed = "".join(f"{s},{n},{p}\n" for s, n, p in found)
    left = b" ".join(kept_words(words, found))
    return len(found), *best, milli, hashlib.sha256(listed.encode()).hexdigest(), hashlib.sha256(left).hexdigest()


def report(docs: DataFrame, change: Callable[[int | None, Words], Words] = planted) -> DataFrame:
    """Per document: its number of runs, the one with the most periods, and digests of all runs and of the words left.

    ``change`` makes the words that are looked at from doc_id and the text's words.
    """
    schema = StructType([docs.schema["doc_id"], *StructType.fromDDL(RESULT).fields])
    types = [pa.int64()] * 5 + [pa.string()] * 2

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            texts = (change(d, w) for d, w in zip(b.column("doc_id").to_pylist(), _words(b.column("text"))))
            rows = [_summary(w, found) for w, found in _grouped(texts)]
            columns = list(zip(*rows)) or [[]] * len(types)
            arrays = [b.column("doc_id"), *(pa.array(c, t) for c, t in zip(columns, types))]
            yield pa.RecordBatch.from_arrays(arrays, schema.fieldNames())

    return docs.select("doc_id", "text").mapInArrow(run, schema)

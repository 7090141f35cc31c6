"""Toxicity: Levenshtein automata over a trie of learned terms, scored in context.

1. Terms are learned from labelled documents: starts of words that stand far more
   often in toxic documents than in others, each taken as long as it keeps most
   of its documents. So one term covers a word with all its endings. Of these,
   the fewest that cover the toxic documents twice are kept.
2. The terms form a trie. A state of the automaton is a set of places in the trie
   with the edits spent (the intersection of the trie with the Levenshtein
   automata of all terms at once); states and transitions are made when a word
   first needs them. A word is a hit when it starts with a term, or when the
   whole of it is within the edits allowed for a term: one from ``ONE_EDIT`` letters,
   two from ``TWO_EDITS``, where two neighbouring letters swapped are one edit. A word
   of any length that starts with a misspelled term whose last letter is right, such
   as a misspelled inflection, is a weaker kind of hit. Words with digits or signs that
   look like letters are misspelled forms of what they look like.
3. Every hit looks at its window: whether it stands between quotation marks, and
   how many other hits are near. Counts of exact, misspelled and quoted hits and the
   densest window are weighed by a logistic regression learned from the labels,
   so that reported abuse need not count as abuse. Weaker hits are counted apart, and
   not in the window.

Learning runs on a bounded sample of labelled documents (``SAMPLE`` rows with texts
of up to ``LONGEST`` characters): terms are counted by Spark, and a few numbers
a document come to the driver. At most ``TERMS`` terms are kept, those in most toxic
documents. Every whole text is scored where it is read, with no shuffle.

Defined results: a null or empty text has no hits and gets the score of such texts;
equal texts get equal scores. Without training rows, or with one label only, there
are no terms and the score is the share of label 1, or 0.5. Empty tables give
empty results; columns beside doc_id and text are not looked at, and pass through
``scored``.
"""

from __future__ import annotations

import math
import re
from bisect import bisect_left
from collections import Counter
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, StructField, StructType

from ledgerlight.llm import labelled

SAMPLE, LONGEST = 12_000, 100_000
SHORTEST_TERM, LONGEST_TERM, TERMS = 3, 12, 2000
LEAST_DOCUMENTS, LEAST_RATIO, KEEPS, COVER = 5, 20.0, 0.9, 2
ONE_EDIT, TWO_EDITS = 5, 9
WINDOW = 10  # words to either side of a hit
FEATURES = 10
STARTS = 3  # instead of edits: the word starts with a misspelled term

# Words, with signs put in the place of letters inside of them.
WORD = re.compile(r"\w+(?:[*@$]+\w+)*")
LOOK_ALIKES = str.maketrans("013457@$", "oieastas")
QUOTES = {'"': '"', "“": "”", "„": "“", "«": "»", "‹": "›"}
MARK = re.compile("[" + "".join({*QUOTES, *QUOTES.values()}) + "]")


def starts(text: str) -> set[str]:
    """The starts of a text's words, in lower case."""
    return {w[:n] for w in set(WORD.findall(text.lower())) for n in range(SHORTEST_TERM, min(len(w), LONGEST_TERM) + 1)}


def candidates(counts: Iterable[tuple[str, int, int]], n_toxic: int, n_other: int) -> dict[str, int]:
    """Of (start, toxic documents, other documents), those far more often in toxic ones, as long as may be."""
    toxic = {}
    for start, a, b in counts:
        ratio = ((a + 0.5) / (n_toxic + 1)) / ((b + 0.5) / (n_other + 1))
        if a >= LEAST_DOCUMENTS and ratio >= LEAST_RATIO:
            toxic[start] = a
    longer: dict[str, list[str]] = {}
    for start in toxic:
        longer.setdefault(start[:-1], []).append(start)
    chosen: dict[str, int] = {}
    for start in toxic:
        if any(start[:n] in toxic for n in range(SHORTEST_TERM, len(start))):
            continue  # a shorter one covers it, and is made longer below
        while more := [s for s in longer.get(start, []) if toxic[s] >= KEEPS * toxic[start]]:
            start = max(more, key=lambda s: (toxic[s], s))
        chosen[start] = toxic[start]
    return chosen


def choose_terms(documents: list[list[str]]) -> list[str]:
    """Terms that cover the toxic documents, given the candidates of each, ``COVER`` times where they can.

    The term that adds most goes first. What copies of one document share adds
    nothing once they are covered, so their other words do not become terms.
    """
    holding: dict[str, set[int]] = {}
    for i, found in enumerate(documents):
        for start in found:
            holding.setdefault(start, set()).add(i)
    need = [COVER] * len(documents)
    terms: list[str] = []
    while holding and len(terms) < TERMS:
        start = max(holding, key=lambda s: (len(holding[s]), s))
        if len(holding[start]) < LEAST_DOCUMENTS:
            break
        terms.append(start)
        for i in holding.pop(start):
            need[i] -= 1
            if not need[i]:
                for other in documents[i]:
                    if other in holding:
                        holding[other].discard(i)
    return sorted(terms)


class Automaton:
    """All terms' Levenshtein automata, run together over a trie; determinised as far as words ask for it."""

    def __init__(self, terms: list[str], most: int = 300_000):
        self.children: list[dict[str, int]] = [{}]
        self.allowed: list[int] = [-1]  # edits that a term ending here allows; -1 where none ends
        for term in terms:
            node = 0
            for ch in term:
                if ch not in self.children[node]:
                    self.children[node][ch] = len(self.children)
                    self.children.append({})
                    self.allowed.append(-1)
                node = self.children[node][ch]
            self.allowed[node] = (len(term) >= ONE_EDIT) + (len(term) >= TWO_EDITS)
        self.reach = self.allowed[:]  # the most edits that any term from here on allows
        for node in range(len(self.children) - 1, -1, -1):
            self.reach[node] = max([self.reach[node], *(self.reach[c] for c in self.children[node].values())])
        self.most = most
        self._forget()

    def _forget(self) -> None:
        self.states: dict[frozenset, int] = {}
        self.places: list[frozenset] = []
        self.accepts: list[int] = []
        self.moves: dict[tuple[int, str], tuple[int, bool]] = {}
        self.words: dict[str, int] = {}
        self._state({(0, "", 0)})

    def _state(self, places: set[tuple[int, str, int]]) -> int:
        """The state of these places and of those a skipped letter away; -1 if there are none.

        A place is a node, the letter that must come next if two are being swapped, and the edits spent.
        """
        best: dict[tuple[int, str], int] = {}
        waiting = list(places)
        while waiting:
            node, awaited, spent = waiting.pop()
            if spent > self.reach[node] or best.get((node, awaited), 9) <= spent:
                continue
            best[node, awaited] = spent
            if not awaited:
                waiting += [(child, "", spent + 1) for child in self.children[node].values()]
        key = frozenset(best.items())
        if not key:
            return -1
        if key not in self.states:
            self.states[key] = len(self.places)
            self.places.append(key)
            ends = [spent for (node, awaited), spent in key if not awaited and spent <= self.allowed[node]]
            self.accepts.append(min(ends, default=-1))
        return self.states[key]

    def _move(self, state: int, ch: str) -> tuple[int, bool]:
        """The state after ``ch``, and whether its being right or swapped ends a misspelled term there."""
        after, right = set(), set()
        for (node, awaited), spent in self.places[state]:
            if awaited:
                if awaited == ch:
                    right.add((node, "", spent))
                continue
            for letter, child in self.children[node].items():
                if letter == ch:
                    right.add((child, "", spent))
                else:
                    after.add((child, "", spent + 1))
                    if ch in self.children[child]:
                        after.add((self.children[child][ch], letter, spent + 1))
            after.add((node, "", spent + 1))
        ends = any(0 < spent <= self.allowed[node] for node, _, spent in right)
        to = self.moves[state, ch] = self._state(after | right), ends
        return to

    def _spelled(self, word: str) -> int:
        state, started = 0, False
        for ch in word:
            state, ends = self.moves.get((state, ch)) or self._move(state, ch)
            if state < 0:
                break
            if self.accepts[state] == 0:
                return 0
            started = started or ends
        if state >= 0 and self.accepts[state] > 0:
            return self.accepts[state]
        return STARTS if started else -1

    def edits(self, word: str) -> int:
        """0 if the word starts with a term; else the edits, if allowed, between the word and a term;
        else ``STARTS`` if it starts with a misspelled term; else -1. A word with look-alikes of letters
        that reads as a hit has one edit at least.
        """
        if not self.places:
            return -1  # there are no terms
        known = self.words.get(word)
        if known is not None:
            return known
        if len(self.moves) + len(self.words) > self.most:
            self._forget()
        best = self._spelled(word)
        if best < 0 or best == STARTS:
            read = word.translate(LOOK_ALIKES)
            if read != word and not word.isdecimal():
                found = self._spelled(read)
                best = max(found, 1) if found >= 0 else best
        self.words[word] = best
        return best


def quoted(text: str, spans: Iterable[tuple[int, int]]) -> Iterator[bool]:
    """Per span, in order, whether quotation marks stand open before and are closed after, on the same line.

    Each line's marks are looked up once, however many spans it has.
    """
    line_end, at = -1, {}
    for start, end in spans:
        if start > line_end:
            line = text.rfind("\n", max(0, line_end), start) + 1
            line_end = text.find("\n", end)
            line_end = len(text) if line_end < 0 else line_end
            at = {mark: [] for pair in QUOTES.items() for mark in pair}
            for found in MARK.finditer(text, line, line_end):
                at[found[0]].append(found.start())
        inside = False
        for opening, closing in QUOTES.items():
            n = bisect_left(at[opening], start)
            if n and at[closing] and at[closing][-1] >= end:
                m = bisect_left(at[closing], start)
                inside |= bool(n % 2) if opening == closing else not m or at[opening][n - 1] > at[closing][m - 1]
        yield inside


def features(text: str | None, automaton: Automaton) -> list[float]:
    """What the hits of a text amount to; all but the first are zero where there are none."""
    low = (text or "").lower()
    words = WORD.findall(low)
    edits = automaton.edits
    at = [i for i, w in enumerate(words) if edits(w) >= 0]
    if not at:
        return [1.0] + [0.0] * (FEATURES - 1)
    spans = [m.span() for m in WORD.finditer(low)]
    counts = [[0, 0], [0, 0], [0, 0]]
    for i, inside in zip(at, quoted(low, (spans[i] for i in at))):
        found = edits(words[i])
        counts[2 if found == STARTS else found > 0][inside] += 1
    at = [i for i in at if edits(words[i]) != STARTS]
    densest, j = 0, 0
    for k, i in enumerate(at):
        while i - at[j] > WINDOW:
            j += 1
        densest = max(densest, k - j + 1)
    (plain, _), _, weak = counts
    logs = [math.log1p(c) for kind in counts[:2] for c in kind]
    return [1.0, *logs, float(plain > 0), math.log1p(densest), 100 * len(at) / len(words), *map(math.log1p, weak)]


def misspelled(text: str, automaton: Automaton) -> str:
    """The text with a letter left out of each word that starts with a term."""
    return WORD.sub(lambda m: m[0][:2] + m[0][3:] if automaton.edits(m[0]) == 0 else m[0], text.lower())


def fit(rows: np.ndarray, y: np.ndarray, ridge: float = 0.1) -> np.ndarray:
    """Logistic regression by Newton's method."""
    w = np.zeros(rows.shape[1])
    for _ in range(30):
        p = 1 / (1 + np.exp(-np.clip(rows @ w, -30, 30)))
        hessian = (rows * (p * (1 - p))[:, None]).T @ rows + ridge * np.eye(len(w))
        w = w - np.clip(np.linalg.solve(hessian, rows.T @ (p - y) + ridge * w), -4, 4)
    return w


def train(docs: DataFrame, labels: DataFrame, training: Column, label: str = "toxic", most: int = SAMPLE) -> tuple[list[str], list[float], float]:
    """Terms, weights and the share of label 1 of the labelled documents in ``training``."""
    chosen = labelled.sample(docs, labels, label, training, most, LONGEST).select("text", F.col("label").cast("int").alias("label"))

    def count(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        toxic, other, n = Counter(), Counter(), [0, 0]
        for b in batches:
            for text, y in zip(b.column("text"), b.column("label").to_pylist()):
                (toxic if y else other).update(starts(text.as_py()))
                n[y] += 1
        # The empty start counts the documents.
        toxic[""], other[""] = n[1], n[0]
        every = list(toxic.keys() | other.keys())
        for low in range(0, len(every), 50_000):
            some = every[low : low + 50_000]
            yield pa.RecordBatch.from_arrays(
                [pa.array(some), pa.array([toxic[s] for s in some], pa.int64()), pa.array([other[s] for s in some], pa.int64())],
                ["start", "toxic", "other"],
            )

    counted = chosen.mapInArrow(count, "start string, toxic long, other long").groupBy("start").agg(F.sum("toxic").alias("toxic"), F.sum("other").alias("other"))
    # The sample's bounds are a bound of this too.
    found = counted.where(f"toxic >= {LEAST_DOCUMENTS} and other <= toxic or start = ''").collect()
    n = next(((r["toxic"], r["other"]) for r in found if r["start"] == ""), (0, 0))
    share = n[0] / sum(n) if sum(n) else 0.5
    if not n[0] or not n[1]:
        return [], [], share
    known = candidates([tuple(r) for r in found if r["start"]], *n)

    def hold(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            rows = [sorted(starts(t.as_py()) & known.keys()) for t in b.column("text")]
            yield pa.RecordBatch.from_arrays([pa.array(rows, pa.list_(pa.string()))], ["starts"])

    toxic = chosen.where("label = 1").select("text").distinct()
    terms = choose_terms(sorted(r["starts"] for r in toxic.mapInArrow(hold, "starts array<string>").collect()))

    def measure(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        automaton = Automaton(terms)
        for b in batches:
            made, rows = [], []
            for text, y in zip(b.column("text").to_pylist(), b.column("label").to_pylist()):
                some = [features(text, automaton)]
                if y:
                    # Toxic texts are learned from with their terms misspelled too, where that leaves hits.
                    some += [row for row in [features(misspelled(text, automaton), automaton)] if any(row[1:])]
                rows += some
                made += [y] * len(some)
            yield pa.RecordBatch.from_arrays([pa.array(made, pa.int32()), pa.array(rows, pa.list_(pa.float64()))], ["label", "row"])

    got = sorted((r["label"], r["row"]) for r in chosen.mapInArrow(measure, "label int, row array<double>").collect())
    weights = fit(np.array([r for _, r in got]), np.array([y for y, _ in got], float))
    return terms, weights.tolist(), share


def scored(docs: DataFrame, model: tuple[list[str], list[float], float], text: str = "text", out: str = "score") -> DataFrame:
    """``docs`` with ``out``, the probability of label 1; a column of that name is replaced."""
    terms, weights, share = model
    kept = [c for c in docs.columns if c != out]
    schema = StructType([*(docs.schema[c] for c in kept), StructField(out, DoubleType(), False)])

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        automaton = Automaton(terms)
        for b in batches:
            if weights:
                rows = np.array([features(t.as_py(), automaton) for t in b.column("__text")]).reshape(-1, FEATURES)
                found = 1 / (1 + np.exp(-np.clip(rows @ np.array(weights), -30, 30)))
            else:
                found = np.full(b.num_rows, share)
            yield pa.RecordBatch.from_arrays([*(b.column(c) for c in kept), pa.array(found)], [*kept, out])

    return docs.select(*[F.col(f"`{c}`") for c in kept], F.col(f"`{text}`").alias("__text")).mapInArrow(run, schema)


def report(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """Per document: whether it is held out of training, its score, and the label predicted."""
    held_out = labelled.remainder(5) == 0
    found = scored(docs.select("doc_id", "text"), train(docs, labels, ~held_out))
    predicted = F.when(F.col("score") >= 0.5, 1).otherwise(0)
    return found.select("doc_id", held_out.alias("held_out"), "score", predicted.alias("predicted"))

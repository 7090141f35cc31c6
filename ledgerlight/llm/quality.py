"""Document quality: attention-based multiple-instance learning (Ilse et al. 2018).

A document is a bag of passages of ``PASSAGE`` words. Each passage is encoded
from the shape of its characters (how often one class of characters follows
another) and of its words (lengths, capitals, symbols, repetition). Only documents
have labels; a gated attention learns from them how much each passage
weighs, and the weighted mean of the encoded passages is scored.

Training runs on a bounded sample of labelled documents (``SAMPLE`` rows with texts
of up to ``LONGEST`` characters), whose passage features come to the driver; the
fitted weights are a few thousand numbers. Every whole text is scored where it is
read, with no shuffle.

Defined results: a null text is an empty one; a text without words has one passage
of zeros; equal texts get equal scores. Without training rows, or with one label
only, the score is the share of label 1, or 0.5. Empty tables give empty results;
columns beside doc_id and text are not looked at, and pass through ``scored``.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, StructField, StructType

from ledgerlight.llm import labelled, shared

PASSAGE = 64  # words
SAMPLE, LONGEST = 8000, 100_000
HIDDEN, ROUNDS, BATCH = 16, 25, 64

# Classes of bytes: lower case, upper case, digit, blank, line end, stops, other signs, beyond ASCII.
_CLASS = np.full(256, 6, np.uint8)
_CLASS[ord("a") : ord("z") + 1], _CLASS[ord("A") : ord("Z") + 1], _CLASS[ord("0") : ord("9") + 1] = 0, 1, 2
_CLASS[[9, 32]], _CLASS[10:14], _CLASS[128:] = 3, 4, 7
_CLASS[[ord(c) for c in ".,;:'\"-()?"]] = 5
CLASSES = 8
FEATURES = CLASSES * CLASSES + 9


def features(text: str | None) -> np.ndarray:
    """A row for each passage of the text."""
    raw = np.frombuffer((text or "").encode(), np.uint8)
    low, start, end = shared.lowered_words(raw)
    n = len(start)
    if n == 0:
        return np.zeros((1, FEATURES), np.float32)
    first = np.arange(0, n, PASSAGE)
    m = len(first)
    per = np.diff(np.append(first, n)).astype(np.float64)
    of_word = np.arange(n) // PASSAGE
    edges = np.append(start[first], len(raw))
    kind = _CLASS[raw]
    of_byte = np.repeat(np.arange(m), np.diff(edges))
    inside = kind[edges[0] :]
    pair = of_byte[:-1] * 64 + inside[:-1] * CLASSES + inside[1:]
    out = np.zeros((m, FEATURES), np.float32)
    size = np.diff(edges).astype(np.float64)
    out[:, :64] = np.bincount(pair, minlength=m * 64)[: m * 64].reshape(m, 64) / size[:, None]
    length = (end - start).astype(np.float64)
    mean = lambda x: np.bincount(of_word, x, m) / per
    out[:, 64] = mean(length) / 10
    out[:, 65] = np.sqrt(np.maximum(mean(length**2) - mean(length) ** 2, 0)) / 10
    out[:, 66] = mean(kind[start] == 1)
    out[:, 67] = mean(kind[end - 1] == 6)
    out[:, 68] = mean(length == 1)
    word = shared.word_hashes(text)
    same = np.append(False, word[1:] == word[:-1])
    out[:, 69] = mean(same)
    new = np.zeros(n, bool)
    new[np.unique(word, return_index=True)[1]] = True
    out[:, 70] = mean(~new)  # words that the document has had before
    both = np.unique(word ^ shared.mixed(of_word.astype(np.uint64) + np.uint64(1)))
    out[:, 71] = 1 - len(both) / n  # repetition within passages, over the document
    out[:, 72] = np.minimum(per, PASSAGE) / PASSAGE
    return out


@dataclass
class Model:
    """Weights by name, or only ``base`` where there was nothing to learn from."""

    base: float
    weights: dict[str, np.ndarray] | None

    def score(self, rows: np.ndarray) -> float:
        return float(self.scores(rows, np.array([0, len(rows)]))[0])

    def scores(self, rows: np.ndarray, bounds: np.ndarray) -> np.ndarray:
        """Of each document, whose passages are ``rows[bounds[i]:bounds[i + 1]]``."""
        if self.weights is None:
            return np.full(len(bounds) - 1, self.base)
        return 1 / (1 + np.exp(-np.clip(_forward(self.weights, rows, bounds)["logit"], -30, 30)))


def _forward(w: dict[str, np.ndarray], rows: np.ndarray, bounds: np.ndarray) -> dict[str, np.ndarray]:
    x = (rows - w["mean"]) / w["scale"]
    h = np.tanh(x @ w["encode"] + w["encode_0"])
    t, g = np.tanh(h @ w["tanh"]), 1 / (1 + np.exp(-(h @ w["gate"])))
    e = (t * g) @ w["attend"]
    at, count = bounds[:-1], np.diff(bounds)
    weight = np.exp(e - np.repeat(np.maximum.reduceat(e, at), count))
    weight /= np.repeat(np.add.reduceat(weight, at), count)
    z = np.add.reduceat(weight[:, None] * h, at, axis=0)
    return {"x": x, "h": h, "t": t, "g": g, "a": weight, "z": z, "logit": z @ w["out"] + w["out_0"]}


def _gradients(w: dict[str, np.ndarray], rows: np.ndarray, bounds: np.ndarray, y: np.ndarray) -> dict[str, np.ndarray]:
    f = _forward(w, rows, bounds)
    count = np.diff(bounds)
    d_logit = (1 / (1 + np.exp(-f["logit"])) - y) / len(y)
    d_z = np.repeat(d_logit[:, None] * w["out"], count, axis=0)
    d_a = (d_z * f["h"]).sum(axis=1)
    mean = np.repeat(np.add.reduceat(f["a"] * d_a, bounds[:-1]), count)
    d_e = f["a"] * (d_a - mean)
    d_t = d_e[:, None] * w["attend"] * f["g"] * (1 - f["t"] ** 2)
    d_g = d_e[:, None] * w["attend"] * f["t"] * f["g"] * (1 - f["g"])
    d_h = f["a"][:, None] * d_z + d_t @ w["tanh"].T + d_g @ w["gate"].T
    d_in = d_h * (1 - f["h"] ** 2)
    return {
        "encode": f["x"].T @ d_in, "encode_0": d_in.sum(axis=0), "tanh": f["h"].T @ d_t, "gate": f["h"].T @ d_g,
        "attend": (d_e[:, None] * f["t"] * f["g"]).sum(axis=0), "out": f["z"].T @ d_logit, "out_0": d_logit.sum(keepdims=True),
    }


def fit(bags: list[np.ndarray], y: np.ndarray, seed: int = 1) -> Model:
    """Adam on the logistic loss of the documents, in a fixed order of batches."""
    if not len(y) or y.min() == y.max():
        return Model(float(y.mean()) if len(y) else 0.5, None)
    rng = np.random.default_rng(seed)
    every = np.concatenate(bags).astype(np.float64)
    draw = lambda *shape: rng.normal(0, 1 / np.sqrt(shape[0]), shape)
    w = {
        "encode": draw(FEATURES, HIDDEN), "encode_0": np.zeros(HIDDEN), "tanh": draw(HIDDEN, HIDDEN),
        "gate": draw(HIDDEN, HIDDEN), "attend": draw(HIDDEN), "out": draw(HIDDEN), "out_0": np.zeros(1),
    }
    fixed = {"mean": every.mean(axis=0), "scale": np.maximum(every.std(axis=0), 1e-3)}
    m, v, step = {k: 0 for k in w}, {k: 0 for k in w}, 0
    for _ in range(ROUNDS):
        order = rng.permutation(len(y))
        for low in range(0, len(y), BATCH):
            some = order[low : low + BATCH]
            rows = np.concatenate([bags[i] for i in some]).astype(np.float64)
            bounds = np.cumsum([0, *(len(bags[i]) for i in some)])
            step += 1
            for k, g in _gradients(w | fixed, rows, bounds, y[some]).items():
                g = g + 1e-4 * w[k]
                m[k], v[k] = 0.9 * m[k] + 0.1 * g, 0.999 * v[k] + 0.001 * g * g
                w[k] = w[k] - 0.01 * (m[k] / (1 - 0.9**step)) / (np.sqrt(v[k] / (1 - 0.999**step)) + 1e-8)
    return Model(0.5, w | fixed)


def train(docs: DataFrame, labels: DataFrame, training: Column, label: str = "quality", most: int = SAMPLE) -> Model:
    """The model of the labelled documents in ``training``, at most ``most`` of them."""
    chosen = labelled.sample(docs, labels, label, training, most, LONGEST)

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            rows = [features(t.as_py()).tobytes() for t in b.column("text")]
            yield pa.RecordBatch.from_arrays([b.column("doc_id"), b.column("label"), pa.array(rows, pa.binary())], ["doc_id", "label", "rows"])

    got = chosen.select("doc_id", F.col("label").cast("int").alias("label"), "text").mapInArrow(run, StructType([chosen.schema["doc_id"], *StructType.fromDDL("label int, rows binary").fields])).collect()
    got.sort(key=lambda r: (r["doc_id"], r["rows"]))
    bags = [np.frombuffer(r["rows"], np.float32).reshape(-1, FEATURES) for r in got]
    return fit(bags, np.array([r["label"] for r in got], np.float64))


def scored(docs: DataFrame, model: Model, text: str = "text", out: str = "score") -> DataFrame:
    """``docs`` with ``out``, the probability of label 1; a column of that name is replaced."""
    kept = [c for c in docs.columns if c != out]
    schema = StructType([*(docs.schema[c] for c in kept), StructField(out, DoubleType(), False)])
    base, weights = model.base, model.weights
    # A text that is kept need not go to the Python worker a second time.
    given = text if text in kept else "__text"
    more = [] if text in kept else [F.col(f"`{text}`").alias(given)]

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fitted = Model(base, weights)
        for b in batches:
            for low in range(0, b.num_rows, 64):
                # Given back in small parts, so that a batch of texts is not held twice more on its way.
                part = b.slice(low, 64)
                bags = [features(t.as_py()) for t in part.column(given)]
                found = fitted.scores(np.concatenate(bags), np.cumsum([0, *map(len, bags)]))
                yield pa.RecordBatch.from_arrays([*(part.column(c) for c in kept), pa.array(found)], [*kept, out])

    return docs.select(*[F.col(f"`{c}`") for c in kept], *more).mapInArrow(run, schema)


def report(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """Per document: whether it is held out of training, its score, and the label predicted."""
    held_out = labelled.remainder(3) == 1
    model = train(docs, labels, ~held_out)
    found = scored(docs.select("doc_id", "text"), model)
    predicted = F.when(F.col("score") >= 0.5, 1).otherwise(0)
    return found.select("doc_id", held_out.alias("held_out"), "score", predicted.alias("predicted"))


def keep_good(docs: DataFrame, labels: DataFrame, least: float = 0.5) -> DataFrame:
    """The documents that score at least ``least``, learned from labels as in ``report``."""
    model = train(docs, labels, labelled.remainder(3) != 1)
    return scored(docs, model, out="__score").where(F.col("__score") >= least).drop("__score")

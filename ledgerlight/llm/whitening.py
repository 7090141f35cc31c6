"""Whitening of vectors by their leading principal components, found by FEAST.

The covariance is a small matrix that Spark sums up in two passes over the distinct
vectors: their number and sums, then the products of what is left after centring. Its
leading eigenpairs come from contour integration (Polizzi 2009): an interval is chosen by
counting eigenvalues above a shift, from the inertia of the shifted matrix's LDL' factors;
random vectors are projected onto the interval's eigenspace by solving complex shifted
systems at Gauss-Legendre nodes of a half circle about it; Rayleigh-Ritz extracts the
pairs, and both steps repeat until the residuals are at rounding. The intervals are
halved until each has few eigenvalues, and each must yield just as many pairs as the
inertia counts say: none is missed.

Defined results: rows whose vector is null, or has a null or non-finite entry, are dropped;
a null vec_id is kept, and so are repeated rows. An entry c becomes floor(256 c), cut to the
range of a long. Vectors of different lengths are fitted apart, each length with its own n
and components, at most as many as it has entries; empty vectors have none and give no
row. A component of eigenvalue zero (vectors that do not differ) has whitened null, counts
for nothing in identity_error (null if there is no other), and explained is 0, or null if
all entries are constant. Deviations beyond a long are cut to its range. Empty tables give
empty results; columns beside vec_id and embedding are ignored.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable, Iterable, Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerlight.llm import shared

SCALE = 256.0
NODES = 16  # of the half circle
FEW = 8  # eigenvalues of one interval
ROUNDS = 60
NEAR = 1e-6  # of the matrix's norm: intervals are not halved further
LONG = 2**63 - 1
SAFE = 2**62


def inertia(a: np.ndarray) -> tuple[int, int, int]:
    """Numbers of positive, zero and negative eigenvalues, by an LDL' factorisation with 1 x 1 and 2 x 2 pivots (Bunch and Parlett)."""
    a = a.copy()
    counts = [0, 0, 0]
    tiny = np.abs(a).max(initial=0.0) * len(a) * 1e-18
    while len(a):
        d = np.abs(np.diag(a))
        off = np.abs(a - np.diag(np.diag(a)))
        i, j = np.unravel_index(off.argmax(), off.shape)
        k = int(d.argmax())
        if max(d[k], off[i, j]) <= tiny:
            counts[1] += len(a)
            break
        pivots = [k] if d[k] >= (1 + 17**0.5) / 8 * off[i, j] else [int(i), int(j)]
        block = a[np.ix_(pivots, pivots)]
        if len(pivots) == 1:
            counts[0 if block[0, 0] > 0 else 2] += 1
        else:  # the determinant is negative: one eigenvalue of each sign
            counts[0] += 1
            counts[2] += 1
        rest = np.setdiff1d(np.arange(len(a)), pivots)
        edge = a[np.ix_(rest, pivots)]
        a = a[np.ix_(rest, rest)] - edge @ np.linalg.solve(block, edge.T)
        a = (a + a.T) / 2
    return tuple(counts)


def above(v: np.ndarray, shift: float) -> int:
    """How many eigenvalues of a symmetric matrix lie above ``shift``."""
    return inertia(v - shift * np.eye(len(v)))[0]


def leading_interval(v: np.ndarray, k: int) -> tuple[float, float, int]:
    """An interval (low, high) that holds the ``k`` largest eigenvalues, and how many it holds: few more, if any.

    More only where they are too near each other to be told apart by a shift.
    """
    high = _norm(v) * (1 + 1e-9)
    x, y, over = -high, high, len(v)
    while y - x > NEAR * high and over > k + FEW // 2:
        middle = (x + y) / 2
        n = above(v, middle)
        x, y, over = (middle, y, n) if n >= k else (x, middle, over)
    return x, high, over


def _norm(v: np.ndarray) -> float:
    return float(np.abs(v).sum(axis=1).max())


def feast(v: np.ndarray, low: float, high: float, expected: int) -> tuple[np.ndarray, np.ndarray]:
    """The eigenvalues in (low, high], falling, and their unit eigenvectors as columns; ``expected`` of them."""
    d = len(v)
    size = min(d, 2 * expected + FEW)
    nodes, weights = np.polynomial.legendre.leggauss(NODES)
    angle = np.pi / 2 * (1 - nodes)  # from 0 to pi: the lower half is the conjugate
    centre, radius = (low + high) / 2, (high - low) / 2
    norm = _norm(v)
    y = np.random.default_rng(20240620).standard_normal((d, size))
    best = None
    for _ in range(ROUNDS):
        filtered = np.zeros((d, size))
        for t, w in zip(angle, weights):
            z = centre + radius * np.exp(1j * t)
            filtered += (w / 2) * np.real(radius * np.exp(1j * t) * np.linalg.solve(z * np.eye(d) - v, y))
        q, _ = np.linalg.qr(filtered)
        values, small = np.linalg.eigh(q.T @ v @ q)  # Rayleigh-Ritz
        y = q @ small
        inside = (values > low) & (values <= high)
        residual = np.linalg.norm(v @ y[:, inside] - y[:, inside] * values[inside], axis=0).max(initial=0.0)
        if inside.sum() == expected:
            if residual <= 4 * np.finfo(float).eps * norm or (best is not None and residual < 1e-12 * norm and residual >= best[0] / 2):
                best = min(best or (np.inf,), (residual, values[inside], y[:, inside]), key=lambda b: b[0])
                break
            if best is None or residual < best[0]:
                best = (residual, values[inside], y[:, inside])
    if best is None or best[0] > 1e-9 * max(norm, 1e-300):
        raise ArithmeticError(f"no {expected} eigenpairs were found between {low} and {high}")
    return best[1][::-1], best[2][:, ::-1]


def leading(v: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """The ``k`` largest eigenvalues of a symmetric matrix, falling, and their unit eigenvectors as rows.

    Of either sign, so that an eigenvector's largest entry is positive.
    """
    if not _norm(v):
        return np.zeros(k), np.eye(k, len(v))
    low, high, n = leading_interval(v, k)
    waiting, found = [(low, n, high, 0)], []  # ends of intervals, and how many eigenvalues lie above each
    while waiting:
        low, n, high, beyond = waiting.pop()
        if n - beyond > FEW and high - low > NEAR * _norm(v):
            middle = (low + high) / 2
            upper = above(v, middle)
            waiting += [(low, n, middle, upper), (middle, upper, high, beyond)]
        elif n > beyond:
            found.append(feast(v, low, high, n - beyond))
    values, vectors = np.concatenate([f[0] for f in found]), np.concatenate([f[1] for f in found], axis=1).T
    order = np.argsort(-values, kind="stable")[:k]
    vectors = vectors[order]
    signs = np.sign(vectors[np.arange(len(vectors)), np.abs(vectors).argmax(axis=1)])
    return values[order], vectors * signs[:, None]


class Fit(NamedTuple):
    """Of vectors of one length: how many distinct ones, their sums, and the leading components of their covariance."""

    n: int
    sums: list[int]
    values: np.ndarray
    vectors: np.ndarray
    trace: float
    identity_error: float | None = None

    def means(self) -> np.ndarray:
        return np.array([s / self.n for s in self.sums])

    def usable(self) -> np.ndarray:
        """The components along which vectors differ."""
        return self.values > max(self.trace, 0.0) * len(self.sums) * 1e-14

    def whitened(self, x: np.ndarray) -> np.ndarray:
        """The rows of ``x`` projected on the usable components, each over the root of its eigenvalue."""
        kept = self.usable()
        return (x - self.means()) @ self.vectors[kept].T / np.sqrt(self.values[kept])

    def deviations(self, x: np.ndarray) -> list[int]:
        """Per row, the exact sum over entries of (n x - S)^2."""
        largest = self.n * int(np.abs(x).astype(object).max(initial=0)) + max(map(abs, self.sums))
        if largest**2 * len(self.sums) < SAFE:
            return ((self.n * x - np.array(self.sums, np.int64)) ** 2).sum(axis=1).tolist()
        exact = ((self.n * x.astype(object) - np.array(self.sums, object)) ** 2).sum(axis=1)
        return [min(int(e), LONG) for e in exact]


def integers(vectors: DataFrame, scale: float = SCALE) -> DataFrame:
    """(vec_id, x): floor(scale * c) of the entries of vectors without null or non-finite ones; empty vectors are left out."""
    c = vectors.select("vec_id", F.col("embedding").cast("array<double>").alias("c"))
    finite = lambda e: e.isNotNull() & (F.abs(e) < float("inf"))  # noqa: E731  NaN counts as larger
    whole = lambda e: F.when(e >= 2.0**63, F.lit(LONG)).when(e <= -(2.0**63), F.lit(-LONG - 1)).otherwise(F.floor(e))
    kept = c.where(F.col("c").isNotNull() & (F.size("c") > 0) & F.forall("c", finite))
    return kept.select("vec_id", F.transform("c", lambda e: whole(e * scale)).alias("x"))


def _matrices(batch: pa.RecordBatch, column: str = "x") -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Per length of vectors in a batch: which rows have it, and their vectors as a matrix."""
    x = batch.column(column)
    lengths = np.diff(x.offsets.to_numpy())
    flat = x.flatten().to_numpy(zero_copy_only=False)
    starts = np.append(0, np.cumsum(lengths))[:-1]
    for d in np.unique(lengths):
        rows = np.flatnonzero(lengths == d)
        yield rows, flat[starts[rows][:, None] + np.arange(d)]


def _gathered(distinct: DataFrame, name: str, kind: str, part: Callable[[np.ndarray], Iterator[tuple[int, int, object]]]) -> dict:
    """{length: {(row, column): sum}} over all vectors, from what ``part`` says of each matrix of them.

    Tasks add up what they see; the sums of tasks are added by key, so that what reaches
    the driver depends on the vectors' length and not on their number.
    """

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict = {}
        for b in batches:
            for _, x in _matrices(b):
                made = part(x)
                d = x.shape[1]
                held[d] = held[d] + made if d in held else made
        for d, m in held.items():
            for i in range(len(m)):
                value = pa.array([list(m[i])], pa.list_(pa.decimal128(38, 0) if kind == "decimal(38,0)" else pa.float64()))
                yield pa.RecordBatch.from_arrays([pa.array([d], pa.int32()), pa.array([i], pa.int32()), value], ["d", "i", name])

    parts = distinct.mapInArrow(run, f"d int, i int, {name} array<{kind}>")
    one = parts.select("d", "i", F.posexplode(name).alias("j", "value"))
    sums: dict = {}
    for r in one.groupBy("d", "i", "j").agg(F.sum("value").alias("value")).collect():
        sums.setdefault(r["d"], {})[r["i"], r["j"]] = r["value"]
    return sums


def _counts(x: np.ndarray) -> np.ndarray:
    """One row: the number of vectors, then their sums, in exact integers."""
    small = int(np.abs(x).astype(float).max(initial=0)) * len(x) < SAFE
    sums = x.sum(axis=0).tolist() if small else x.astype(object).sum(axis=0).tolist()
    return np.array([[len(x), *sums]], object)


def fit(distinct: DataFrame, k: int) -> dict[int, Fit]:
    """The fit of each length of vectors, from distinct vectors ``x`` of longs.

    Sums over tasks are those of a matrix of length x length, and its eigenpairs are
    found by the driver: neither grows with the number of vectors.
    """
    known = {d: (int(m[0, 0]), [int(m[0, j]) for j in range(1, d + 1)]) for d, m in _gathered(distinct, "sums", "decimal(38,0)", _counts).items()}
    if not known:
        return {}
    means = {d: np.array([s / n for s in sums]) for d, (n, sums) in known.items()}

    def products(x: np.ndarray) -> np.ndarray:
        centred = x - means[x.shape[1]]
        return centred.T @ centred

    fits = {}
    for d, m in _gathered(distinct, "products", "double", products).items():
        n, sums = known[d]
        v = np.array([[m[min(i, j), max(i, j)] for j in range(d)] for i in range(d)]) / n
        values, vectors = leading(v, min(k, d))
        fits[d] = Fit(n, sums, values, vectors, float(np.trace(v)))

    def squares(x: np.ndarray) -> np.ndarray:
        w = fits[x.shape[1]].whitened(x)
        return np.vstack([w.sum(axis=0), w.T @ w]) if w.shape[1] else np.zeros((1, 1))

    for d, m in _gathered(distinct, "squares", "double", squares).items():
        n, kept = fits[d].n, int(fits[d].usable().sum())
        if kept:
            s = np.array([[m[i, j] for j in range(kept)] for i in range(kept + 1)]) / n
            error = float(np.abs(s[1:] - np.outer(s[0], s[0]) - np.eye(kept)).max())
            fits[d] = fits[d]._replace(identity_error=error)
    return fits


def _stored(df: DataFrame) -> DataFrame:
    """``df`` as a Parquet table in the folder of ``spark.checkpoint.dir``: whole numbers of few values are small there."""
    folder = f"{shared.checkpoint_folder(df.sparkSession)}/distinct-{uuid.uuid4().hex}"
    df.write.parquet(folder)
    return df.sparkSession.read.schema(df.schema).parquet(folder)


RESULT = """vec_id long, component int, n long, deviation long, whitened double,
    explained double, identity_error double"""


def whiten(vectors: DataFrame, k: int = 4, scale: float = SCALE) -> DataFrame:
    """Per usable row and leading component: how far the row is from the mean, and its whitened value.

    One shuffle finds the distinct vectors; they are stored once and read three times. The
    rows themselves are whitened where they are.
    """
    x = integers(vectors, scale)
    fits = fit(_stored(x.select("x").distinct()), k)

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for rows, m in _matrices(b):
                f = fits[m.shape[1]]
                parts = len(f.values)
                kept = f.usable()
                w = np.full((len(rows), parts), np.nan)
                w[:, kept] = f.whitened(m)
                explained = [float(e) if u else 0.0 for e, u in zip(f.values / f.trace, kept)] if f.trace > 0 else [None] * parts
                yield pa.RecordBatch.from_arrays(
                    [
                        b.column("vec_id").take(pa.array(np.repeat(rows, parts))),
                        pa.array(np.tile(np.arange(1, parts + 1), len(rows)), pa.int32()),
                        pa.array(np.full(len(rows) * parts, f.n), pa.int64()),
                        pa.array(np.repeat(np.array(f.deviations(m), np.int64), parts), pa.int64()),
                        pa.array(w.ravel(), mask=np.tile(~kept, len(rows))),
                        pa.array(explained * len(rows), pa.float64()),
                        pa.array([f.identity_error] * (len(rows) * parts), pa.float64()),
                    ],
                    ["vec_id", "component", "n", "deviation", "whitened", "explained", "identity_error"],
                )

    return x.select(F.col("vec_id").cast("long").alias("vec_id"), "x").mapInArrow(run, RESULT)


def report(embeddings: DataFrame) -> DataFrame:
    """The four leading components of every vector."""
    return whiten(embeddings, 4)

"""Exact top-k search by inner product, with multi-resolution segment statistics.

Vectors are rounded to integers. Each is cut into segments, and each segment
keeps its mean and deviation. By the Cauchy-Schwarz inequality the squared
distance of two vectors is at least the sum over segments of length * ((mean
difference)^2 + (deviation difference)^2), which gives an upper bound of their
inner product: (|q|^2 + |x|^2 - distance^2) / 2. Bounds are taken coarse to fine;
after each resolution a query drops the vectors whose bound is under its k-th best
exact score so far, of this shard or the task's shards before it, and exact scores are
computed for the survivors. The result is exact: bounds have a margin for rounding, and
nothing else drops a vector. Blocks of queries are compared with a shard at once.

Defined results: vectors null, or with a component null or not finite, take no
part; zero vectors do, and empty ones do not. Only vectors of equal length are
compared. Ties go to the smaller vec_id; repeated rows are results of their own,
though a query asked twice is answered once. Scores beyond a long are cut to its
range. Null vec_ids take no part. Empty tables give empty results; columns beside
vec_id and embedding are ignored.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerlight.llm import vectors as V

RESOLUTIONS = (1, 4, 16)
PER_SHARD, PER_BLOCK = 4096, 1024
EXACT = 2.0**53  # sums of products under it are exact in doubles
LONG = 2**63
LARGEST = 1.7976931348623157e308


def statistics(body: np.ndarray, segments: int) -> np.ndarray:
    """Per vector and segment, mean and deviation, both times the root of the segment's length.

    The inner product of two such rows bounds the inner product of the vectors.
    """
    edges = np.linspace(0, body.shape[1], min(segments, body.shape[1]) + 1).astype(int)
    width = np.diff(edges)
    mean = np.add.reduceat(body, edges[:-1], axis=1) / width
    spread = np.add.reduceat((body - np.repeat(mean, width, axis=1)) ** 2, edges[:-1], axis=1)
    return np.concatenate([mean * np.sqrt(width), np.sqrt(spread)], axis=1)


def _scores(block: np.ndarray, queries: np.ndarray) -> np.ndarray:
    """Exact inner products of whole numbers, row by row; beyond what doubles hold exactly, by Python's integers."""
    if len(block) == 0 or _exact(block, queries):
        return np.einsum("nd,nd->n", block, queries).astype(np.int64)
    wide = [sum(int(a) * int(b) for a, b in zip(row, query)) for row, query in zip(block, queries)]
    return np.array([min(max(s, -LONG), LONG - 1) for s in wide], np.int64)


def _exact(block: np.ndarray, queries: np.ndarray) -> bool:
    return np.abs(block).max() * np.abs(queries).max() * block.shape[1] < EXACT


class Shard:
    """A shard's vectors with their statistics."""

    def __init__(self, ids: np.ndarray, body: np.ndarray):
        self.ids, self.body = ids, body
        self.levels = [statistics(body, r) for r in RESOLUTIONS]
        self.longest = np.sqrt((body**2).sum(axis=1).max())


def search(shard: Shard, q_ids: np.ndarray, queries: np.ndarray, best: V.Best) -> None:
    """Add a shard's best to those of a block of queries."""
    k, ids, body = best.k, shard.ids, shard.body
    margin = 1e-6 + 1e-9 * shard.longest * np.sqrt((queries**2).sum(axis=1))
    least = np.full(len(q_ids), -np.inf)
    full, score = best.last()
    least[full] = score
    left, columns = None, np.arange(len(ids))
    for level, resolution in zip(shard.levels, RESOLUTIONS):
        bound = statistics(queries, resolution) @ level[columns].T
        if left is None:
            left = ids != q_ids[:, None]
            # For queries without results the exact scores of the most promising set what the others must reach.
            new = np.flatnonzero(np.isinf(least) & (left.sum(axis=1) > k))
            if len(new):
                first = np.argpartition(np.where(left[new], -bound[new], np.inf), k - 1, axis=1)[:, :k]
                exact = _scores(body[first.ravel()], np.repeat(queries[new], k, axis=0)).reshape(-1, k)
                least[new] = np.where(np.take_along_axis(left[new], first, axis=1).all(axis=1), exact.min(axis=1), -np.inf)
            # Scores cut to a long's least are equal, whatever their bounds.
            least[least <= -LONG] = -np.inf
        left &= ~(bound < (least - margin)[:, None])  # a bound too large to tell keeps its vector
        some = left.any(axis=0)
        if not some.any():
            return
        if not some.all():
            columns, left = columns[some], left[:, some]
    chosen = body[columns]
    if not _exact(chosen, queries):
        at, column = np.nonzero(left)
        best.add(at, ids[columns[column]], _scores(chosen[column], queries[at]))
        return
    score = queries @ chosen.T
    score[~left] = -np.inf
    if len(new) and len(columns) > k:
        least[new] = np.maximum(least[new], np.partition(score[new], -k, axis=1)[:, -k])
    at, column = np.nonzero(left & (score >= least[:, None]))
    best.add(at, ids[columns[column]], score[at, column].astype(np.int64))


def top_k(vectors: DataFrame, queries: DataFrame, k: int, scale: float = 256.0) -> DataFrame:
    """(query_id, rank, vec_id, score): each query's ``k`` best by inner product of floor(scale * x)."""

    def scaled(df: DataFrame) -> DataFrame:
        # Doubles from 2**53 on are whole, and may be too large for a long.
        whole = lambda x: F.when(F.abs(x) < EXACT, F.floor(x).cast("double")).otherwise(F.greatest(F.least(x, F.lit(LARGEST)), F.lit(-LARGEST)))
        return V.usable(df, zero=True).select("vec_id", F.transform("embedding", lambda x: whole(x * scale)).alias("embedding"))

    index, _ = V.pack(scaled(vectors), PER_SHARD)
    load = lambda row: Shard(*V.unpack(row["ids"], row["body"], row["dim"]))
    return V.best(V.ask(index, scaled(queries), PER_BLOCK, k, load, search, falling=True), k, F.desc("score"))


def report(embeddings: DataFrame) -> DataFrame:
    """The 5 best of every vector whose vec_id is divisible by 50, among all others."""
    return top_k(embeddings, embeddings.where("vec_id % 50 = 0"), 5)


def oracle() -> str:
    """DuckDB SQL of ``report``."""
    return """
    with v as (
      select vec_id, list_transform(embedding, lambda x: floor(256 * x::double)::bigint) as e from embeddings
      where embedding is not null and len(embedding) > 0
      and len(list_filter(embedding, lambda x: x is null or not isfinite(x))) = 0),
    scored as (
      select q.vec_id as query_id, c.vec_id,
        list_sum(list_transform(range(1, len(q.e) + 1), lambda i: q.e[i] * c.e[i]))::bigint as score
      from v q join v c on q.vec_id <> c.vec_id and len(q.e) = len(c.e) where q.vec_id % 50 = 0),
    ranked as (
      select *, row_number() over (partition by query_id order by score desc, vec_id)::integer as rank from scored)
    select query_id, rank, vec_id, score from ranked where rank <= 5"""

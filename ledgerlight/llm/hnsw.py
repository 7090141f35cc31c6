"""Approximate nearest neighbours: a hierarchical navigable small-world graph per shard.

A shard of bounded size is built into a graph of its distinct vectors (Malkov and
Yashunin 2018): levels drawn from a geometric distribution, neighbours chosen by
the diversity rule, links both ways. Nodes are numbered from the highest level
down, so each layer is the first so many nodes, and its links are one flat array
of neighbour numbers, a fixed number a node, filled up with -1. Insertion and
search advance whole blocks of vectors together. Every query goes to every shard,
and the shards' results are merged by exact distances on the original vectors.

Vectors equal in every component are one node with a list of vec_ids, so copies
neither crowd a graph nor hide each other.

Defined results: vectors null, empty, of length zero, or with a component null or
not finite take no part, nor do null vec_ids; only vectors of equal length are
compared; ties go to the smaller vec_id; repeated rows are results of their own,
though a query asked twice is answered once; empty tables give empty results.
Columns beside vec_id and embedding are ignored.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerlight.llm import vectors as V

PER_SHARD, PER_BLOCK = 4096, 256
LINKS = 16  # a node's links on upper layers; twice as many on the lowest
BUILD_BEAM, SEARCH_BEAM, UPPER_BEAM = 64, 160, 8
INSERTED = 256  # vectors inserted together at most
EXPANDED = 4  # candidates of a beam expanded together


@dataclass
class Graph:
    """``layers[l]`` holds the neighbours of the first nodes, flat array by node."""

    points: np.ndarray
    layers: list[np.ndarray]


def _distances(points: np.ndarray, norms: np.ndarray, queries: np.ndarray, ids: np.ndarray) -> np.ndarray:
    """Squared distances, up to a constant of each query, of each row of ``ids``; infinite at -1."""
    d = norms[ids] - 2 * np.einsum("qmd,qd->qm", points[ids], queries, optimize=True)
    d[ids < 0] = np.inf
    return d


def _beam(points, norms, links, n, queries, start, width) -> tuple[np.ndarray, np.ndarray]:
    """Best-first search of a layer for a block of queries: ids and distances, nearest first."""
    rows = np.arange(len(queries))[:, None]
    seen = np.zeros((len(queries), n + 1), bool)  # the last place stands for -1
    seen[:, n] = True
    seen[rows, start] = True
    ids, d = start, _distances(points, norms, queries, start)
    open_ = ids >= 0
    while True:
        waiting = np.where(open_, d, np.inf)
        some = min(EXPANDED, ids.shape[1])
        pick = np.argpartition(waiting, some - 1, axis=1)[:, :some] if some < ids.shape[1] else np.tile(np.arange(some), (len(queries), 1))
        good = np.isfinite(waiting[rows, pick])
        if not good.any():
            return ids, d
        live = np.flatnonzero(good.any(axis=1))
        open_[rows, pick] = False
        chosen = np.where(good, ids[rows, pick], -1)
        near = np.where(chosen[:, :, None] >= 0, links[chosen], -1).reshape(len(queries), -1)[live]
        at = live[:, None]
        near = np.where(seen[at, near], -1, near)
        # A neighbour found twice in this step is looked at once.
        near.sort(axis=1)
        near[:, 1:][near[:, 1:] == near[:, :-1]] = -1
        seen[at, near] = True
        d_near = _distances(points, norms, queries[live], near)
        all_ids = np.full((len(queries), ids.shape[1] + near.shape[1]), -1)
        all_d = np.full(all_ids.shape, np.inf)
        all_open = np.zeros(all_ids.shape, bool)
        w = ids.shape[1]
        all_ids[:, :w], all_d[:, :w], all_open[:, :w] = ids, d, open_
        all_ids[live, w:], all_d[live, w:], all_open[live, w:] = near, d_near, near >= 0
        order = np.argsort(all_d, axis=1)[:, :width]
        ids, d, open_ = all_ids[rows, order], all_d[rows, order], all_open[rows, order]


def _diverse(points, norms, ids, d, most) -> np.ndarray:
    """Of each row's candidates, nearest first, those nearer to the row's point than to any one chosen; -1 fills up."""
    order = np.argsort(d, axis=1)
    rows = np.arange(len(ids))[:, None]
    ids, d = ids[rows, order], d[rows, order]
    p = points[ids]
    own = norms[ids]
    between = own[:, :, None] + own[:, None, :] - 2 * (p @ p.transpose(0, 2, 1))
    chosen = np.zeros(ids.shape, bool)
    for j in range(ids.shape[1]):
        blocked = (chosen & (between[:, j, :] < d[:, j, None])).any(axis=1)
        chosen[:, j] = np.isfinite(d[:, j]) & ~blocked & (chosen.sum(axis=1) < most)
    # Free places go to the nearest of those left over, which keeps dense groups in touch.
    rank = np.where(chosen, 0, 1) + np.where(np.isfinite(d), 0, 2)
    first = np.argsort(rank, axis=1, kind="stable")[:, :most]
    out = np.where(np.isfinite(d[rows, first]), ids[rows, first], -1)
    if out.shape[1] < most:
        out = np.pad(out, ((0, 0), (0, most - out.shape[1])), constant_values=-1)
    return out


def _true(points, norms, of, ids) -> np.ndarray:
    """Squared distances of each row's ids to its point."""
    return _distances(points, norms, points[of], ids) + norms[of][:, None]


def _connect(points, norms, links, new, near) -> None:
    """Link new nodes to their chosen neighbours and back, keeping each node's number of links."""
    most = links.shape[1]
    links[new] = near
    source = np.repeat(new, most)
    target = near.ravel()
    source, target = source[target >= 0], target[target >= 0]
    order = np.argsort(target, kind="stable")
    source, target = source[order], target[order]
    nodes, at, count = np.unique(target, return_index=True, return_counts=True)
    width = int(count.max()) if len(count) else 0
    for low in range(0, len(nodes), 256):
        part = slice(low, low + 256)
        some, begin, many = nodes[part], at[part], count[part]
        column = np.arange(width)[None, :]
        added = np.where(column < many[:, None], source[np.minimum(begin[:, None] + column, len(source) - 1)], -1)
        ids = np.concatenate([links[some], added], axis=1)
        ids.sort(axis=1)
        ids[:, 1:][ids[:, 1:] == ids[:, :-1]] = -1
        ids[ids == some[:, None]] = -1
        links[some] = _diverse(points, norms, ids, _true(points, norms, some, ids), most)


def build(points: np.ndarray, seed: int = 0) -> Graph:
    """The graph of distinct points; returned ``points`` are in the order of its nodes."""
    n = len(points)
    draw = np.random.default_rng(seed).random(n)
    level = np.minimum((-np.log(np.maximum(draw, 1e-12)) / np.log(LINKS)).astype(int), 8)
    order = np.argsort(-level, kind="stable")
    return Graph(*_inserted(points[order], level[order])), order


def _inserted(points: np.ndarray, level: np.ndarray) -> tuple[np.ndarray, list[np.ndarray]]:
    norms = (points**2).sum(axis=1)
    n = len(points)
    sizes = [int((level >= l).sum()) for l in range(level.max() + 1)]
    layers = [np.full((s, LINKS * (2 if l == 0 else 1)), -1) for l, s in enumerate(sizes)]
    done = 1  # node 0 has no one to be linked with
    while done < n:
        top = level[done]
        size = min(INSERTED, max(1, done))
        new = np.arange(done, min(n, done + size))
        new = new[level[new] == top]
        queries = points[new]
        start = np.zeros((len(new), 1), int)
        for l in range(len(layers) - 1, -1, -1):
            filled = min(done, sizes[l])
            if not filled:
                continue
            wide = BUILD_BEAM if l <= top else UPPER_BEAM
            ids, d = _beam(points, norms, layers[l], n, queries, start, wide)
            if l <= top:
                # Those inserted together are candidates of each other.
                mutual = norms[new][None, :] - 2 * (queries @ queries.T)
                np.fill_diagonal(mutual, np.inf)
                every = np.concatenate([ids, np.tile(new, (len(new), 1))], axis=1)
                d_every = np.concatenate([d, mutual], axis=1)
                first = np.argsort(d_every, axis=1)[:, :BUILD_BEAM]
                rows = np.arange(len(new))[:, None]
                near, d_near = every[rows, first], d_every[rows, first]
                near = np.where(np.isfinite(d_near), near, -1)
                chosen = _diverse(points, norms, near, d_near + norms[new][:, None], LINKS)
                padded = np.full((len(new), layers[l].shape[1]), -1)
                padded[:, :LINKS] = chosen
                _connect(points, norms, layers[l], new, padded)
            start = ids
        done += len(new)
    return points, layers


def nearest(graph: Graph, queries: np.ndarray, width: int) -> np.ndarray:
    """Node numbers of the beam of each query on the lowest layer; -1 fills up."""
    norms = (graph.points**2).sum(axis=1)
    start = np.zeros((len(queries), 1), int)
    for l in range(len(graph.layers) - 1, -1, -1):
        start, _ = _beam(graph.points, norms, graph.layers[l], len(graph.points), queries, start, width if l == 0 else UPPER_BEAM)
    return start


def index(vectors: DataFrame) -> DataFrame:
    """The graphs of the shards, a row each.

    ``ids`` are the shard's vec_ids node by node, ``copies`` how many a node has,
    ``body`` the nodes' vectors, ``links`` the layers' flat neighbour arrays one
    after the other, ``sizes`` how many nodes each layer has.
    """
    packed, _ = V.pack(V.usable(vectors, zero=False), PER_SHARD)

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                ids, body = V.unpack(batch.column("ids")[i].as_py(), batch.column("body")[i].as_py(), batch.column("dim")[i].as_py())
                distinct, node = np.unique(body + 0.0, axis=0, return_inverse=True)
                graph, order = build(distinct)
                place = np.empty(len(order), int)
                place[order] = np.arange(len(order))
                node = place[node.ravel()]
                by_node = np.lexsort((ids, node))
                row = {
                    "dim": batch.column("dim")[i].as_py(),
                    "shard": batch.column("shard")[i].as_py(),
                    "ids": ids[by_node].tobytes(),
                    "copies": np.bincount(node, minlength=len(order)).astype(np.int64).tobytes(),
                    "body": V.squeezed(graph.points),
                    "links": b"".join(layer.astype(np.int32).tobytes() for layer in graph.layers),
                    "sizes": [len(layer) for layer in graph.layers],
                }
                yield pa.RecordBatch.from_pylist([row], schema=arrow)

    arrow = pa.schema(
        [("dim", pa.int32()), ("shard", pa.int32()), ("ids", pa.binary()), ("copies", pa.binary()), ("body", pa.binary()), ("links", pa.binary()), ("sizes", pa.list_(pa.int32()))]
    )
    schema = "dim int, shard int, ids binary, copies binary, body binary, links binary, sizes array<int>"
    return packed.mapInArrow(run, schema)


def _graph(row: dict) -> Graph:
    flat, layers, at = np.frombuffer(row["links"], np.int32), [], 0
    for l, size in enumerate(row["sizes"]):
        width = LINKS * (2 if l == 0 else 1)
        layers.append(flat[at : at + size * width].reshape(size, width).astype(int))
        at += size * width
    points = V.unsqueezed(row["body"], row["sizes"][0], row["dim"])
    return Graph(points, layers)


def neighbours(vectors: DataFrame, queries: DataFrame, k: int, beam: int = SEARCH_BEAM) -> DataFrame:
    """(query_id, rank, vec_id, score): each query's ``k`` nearest found, by Euclidean distance, without itself."""
    def load(row: dict) -> tuple[Graph, np.ndarray, np.ndarray]:
        return _graph(row), np.frombuffer(row["ids"], np.int64), np.frombuffer(row["copies"], np.int64)

    def search(shard: tuple[Graph, np.ndarray, np.ndarray], q_ids: np.ndarray, block: np.ndarray, best: V.Best) -> None:
        graph, ids, copies = shard
        begin = np.cumsum(copies) - copies
        found = nearest(graph, block, min(max(beam, k + 1), len(graph.points)))
        at, held, score = [], [], []
        for i, (q_id, q, nodes) in enumerate(zip(q_ids, block, found)):
            nodes = nodes[nodes >= 0]
            exact = np.sqrt(((graph.points[nodes] - q) ** 2).sum(axis=1))
            first = np.argsort(exact, kind="stable")[: k + 1] if len(nodes) <= k + 1 else np.flatnonzero(exact <= np.partition(exact, k)[k])
            # Copies are in order of vec_id; more than k + 1 of them cannot be among the results.
            some = [ids[begin[n] : begin[n] + min(copies[n], k + 1 + _repeats(ids, begin[n], copies[n], q_id))] for n in nodes[first]]
            far = np.repeat(exact[first], [len(s) for s in some])
            some = np.concatenate(some)
            far, some = far[some != q_id], some[some != q_id]
            top = np.lexsort((some, far))[:k]
            at.append(np.full(len(top), i))
            held.append(some[top])
            score.append(far[top])
        best.add(*(np.concatenate(x) for x in (at, held, score)))

    found = V.ask(index(vectors), V.usable(queries, zero=False), PER_BLOCK, k, load, search)
    return V.best(found, k, F.asc("score"))


def _repeats(ids: np.ndarray, begin: int, count: int, q_id: int) -> int:
    """How often the query's own id stands among a node's copies."""
    own = ids[begin : begin + count]
    return int(np.searchsorted(own, q_id, "right") - np.searchsorted(own, q_id, "left"))


def report(embeddings: DataFrame) -> DataFrame:
    """The 10 nearest of every vector whose vec_id is divisible by 100, among all others."""
    return neighbours(embeddings, embeddings.where("vec_id % 100 = 0"), 10)

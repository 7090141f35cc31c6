"""Vectors in shards of bounded size, and queries that go to every shard in blocks.

A shard is one row: its vec_ids and its vectors, as bytes. Shards are dealt by a
hash of vec_id, so neither a hot label nor a group of copies gathers in one.
Queries are packed the same way. Both are stored once, and a task reads some of the
shards and some of the blocks, without a copy of either for each pair: what is
stored, shuffled and known to the driver grows with the vectors, and only the
searches with their square. A task keeps each query's best over all its shards.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ledgerlight.llm.shared import cut

PACK = "dim int, shard int, n long, ids binary, body binary"
ARROW = pa.schema([("dim", pa.int32()), ("shard", pa.int32()), ("n", pa.int64()), ("ids", pa.binary()), ("body", pa.binary())])
GATHERED = 8  # shards that a task packs, once there are more than tasks
HELD = 16 << 20  # bytes of queries that a task holds, or one block
TASKS = 16  # a core, to which the pairs of shards and blocks are dealt


def usable(vectors: DataFrame, zero: bool) -> DataFrame:
    """(vec_id, embedding as doubles) of the rows that take part: no null, nor any component null or not finite.

    With ``zero`` false, vectors of length zero take no part either.
    """
    v = vectors.select("vec_id", F.col("embedding").cast("array<double>").alias("embedding"))
    finite = lambda x: x.isNotNull() & (F.abs(x) < float("inf"))  # noqa: E731  NaN counts as larger
    keep = F.col("vec_id").isNotNull() & F.col("embedding").isNotNull() & F.forall("embedding", finite)
    if not zero:
        keep &= F.exists("embedding", lambda x: x != 0)
    return v.where(keep)


def squeezed(body: np.ndarray) -> bytes:
    """Doubles as bytes, those of the same weight together: most of rounded numbers' are equal."""
    return pa.compress(body.astype(np.float64).reshape(-1, 1).view(np.uint8).T.tobytes(), "zstd", asbytes=True)


def unsqueezed(body: bytes, rows: int, dim: int) -> np.ndarray:
    flat = np.frombuffer(pa.decompress(body, rows * dim * 8, "zstd", asbytes=True), np.uint8)
    return np.ascontiguousarray(flat.reshape(8, -1).T).view(np.float64).reshape(rows, dim)


def pack(vectors: DataFrame, per_shard: int) -> tuple[DataFrame, int]:
    """Rows (dim, shard, n, ids, body) of about ``per_shard`` vectors each, and the number of shards."""
    count = vectors.count()
    shards = max(1, -(-count // per_shard))

    def run(table: pa.Table) -> pa.Table:
        rows = table.combine_chunks()
        ids = rows.column("vec_id").to_numpy()
        body = np.concatenate([c.flatten().to_numpy(zero_copy_only=False) for c in rows.column("embedding").chunks])
        body = body.reshape(len(ids), -1)
        order = np.argsort(ids, kind="stable")
        made = {
            "dim": [body.shape[1]],
            "shard": [rows.column("shard")[0].as_py()],
            "n": [len(ids)],
            "ids": [ids[order].astype(np.int64).tobytes()],
            "body": [squeezed(body[order])],
        }
        return pa.table(made, schema=ARROW)

    dealt = vectors.where(F.size("embedding") > 0).select(
        F.size("embedding").alias("dim"), F.pmod(F.xxhash64("vec_id"), F.lit(shards)).cast("int").alias("shard"), "vec_id", "embedding"
    )
    # The number of partitions is given, so that none of them are put together again. Many shards share tasks:
    # the driver knows of each task, and of what each sends to each other.
    cores = vectors.sparkSession.sparkContext.defaultParallelism
    tasks = min(2 * shards, max(4 * cores, -(-shards // GATHERED)))
    return dealt.repartition(tasks, "dim", "shard").groupBy("dim", "shard").applyInArrow(run, PACK), shards


def unpack(ids: bytes, body: bytes, dim: int) -> tuple[np.ndarray, np.ndarray]:
    found = np.frombuffer(ids, np.int64)
    return found, unsqueezed(body, len(found), dim)


class Best:
    """The ``k`` best found for each query of a block: smallest score first, or largest ``falling``, then smallest vec_id."""

    def __init__(self, q_ids: np.ndarray, k: int, kind: type, falling: bool):
        self.q_ids, self.k, self.falling = q_ids, k, falling
        self.at, self.ids, self.score = np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, kind)

    def add(self, at: np.ndarray, ids: np.ndarray, score: np.ndarray) -> None:
        """What was found for the queries at the places ``at`` of the block."""
        at, ids, score = (np.concatenate(x) for x in ((self.at, at), (self.ids, ids), (self.score, score)))
        # ~ turns the order of whole numbers around, and none is too large for it
        order = np.lexsort((ids, ~score if self.falling else score, at))
        at = at[order]
        rank = np.arange(len(at)) - np.searchsorted(at, at)
        kept = order[rank < self.k]
        self.at, self.ids, self.score = at[rank < self.k], ids[kept], score[kept]

    def last(self) -> tuple[np.ndarray, np.ndarray]:
        """The queries that have ``k`` results, and the score of the last one."""
        full = np.flatnonzero(np.bincount(self.at, minlength=len(self.q_ids)) == self.k)
        return full, self.score[np.searchsorted(self.at, full, "right") - 1]

    def batch(self) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(self.q_ids[self.at]), pa.array(self.ids), pa.array(self.score)], ["query_id", "vec_id", "score"])


def ask(
    index: DataFrame,
    queries: DataFrame,
    per_block: int,
    k: int,
    load: Callable[[dict], object],
    search: Callable[[object, np.ndarray, np.ndarray, Best], None],
    falling: bool = False,
) -> DataFrame:
    """(query_id, vec_id, score): the best that ``search`` finds for each block of queries in some of the shards of the index.

    ``load`` makes of a row of the index what ``search`` gets for each block's ids and vectors, with their best so
    far, to which it adds. A query's results come from several tasks. Scores are whole numbers if ``falling``.
    """
    one = queries.groupBy("vec_id").agg(F.min("embedding").alias("embedding"))
    packed, _ = pack(one, per_block)
    index, blocks = cut(index), cut(packed.select(*[F.col(c).alias(f"q_{c}") for c in ("dim", "shard", "n", "ids", "body")]))
    cores = index.sparkSession.sparkContext.defaultParallelism
    size = blocks.agg(F.sum(F.col("q_n") * F.col("q_dim") * 8)).first()[0] or 0
    parts = -(-size // HELD) or 1
    # A row of the index is read once for all the blocks of a task, and as often as there are parts of the queries.
    index, blocks = index.coalesce(max(cores, -(-TASKS * cores // parts))), blocks.coalesce(parts)
    # Not as an equation of two columns, for which Spark would send a copy of each block to each shard.
    near = index.hint("shuffle_replicate_nl").join(blocks, F.col("dim") - F.col("q_dim") == 0)
    names = [c for c in index.columns]

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        here, shard, found, asked = None, None, {}, {}
        for batch in batches:
            for i in range(batch.num_rows):
                of = batch.column("dim")[i].as_py(), batch.column("shard")[i].as_py()
                if of != here:
                    here, shard = of, load({c: batch.column(c)[i].as_py() for c in names})
                block = batch.column("q_dim")[i].as_py(), batch.column("q_shard")[i].as_py()
                if block not in found:
                    asked[block] = unpack(batch.column("q_ids")[i].as_py(), batch.column("q_body")[i].as_py(), block[0])
                    found[block] = Best(asked[block][0], k, np.int64 if falling else np.float64, falling)
                search(shard, *asked[block], found[block])
        for best in found.values():
            yield best.batch()

    return near.mapInArrow(run, f"query_id long, vec_id long, score {'long' if falling else 'double'}")


def best(found: DataFrame, k: int, order: Column) -> DataFrame:
    """The first ``k`` of each query by ``order``, then vec_id, with their rank."""
    rank = F.row_number().over(Window.partitionBy("query_id").orderBy(order, "vec_id"))
    return found.withColumn("rank", rank).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")

"""Mixing sources to target weights by Pfair scheduling.

A source's documents are put in an order of their own and dealt into blocks of
``BLOCK``. With weight w, the i-th block of a source is released at slot
floor((i - 1) / w) and due before slot ceil(i / w) (Baruah et al. 1996). In each slot
the released block with the earliest deadline goes next. As the weights add up
to one, every deadline is met and no slot stays empty, so that at every slot each
source is less than one block away from its share.

Weights are whole parts of ``PERIOD``, which holds them as exactly as a double does; no
phase is nearly as long, so what rounding adds up to stays far below a block.
``deviation`` is counted against the given weights. The slots of all blocks are
dealt out on the driver, a few numbers for each ``BLOCK`` documents, and joined to
the counts below, so documents are placed where they are. When a source runs out, a
new phase begins with the weights of the others scaled up; all documents are kept,
and deviations are counted within each phase. There are at most as many phases as
sources.

The order within a source is a hash of doc_id. Positions in it come from counts by
hash bucket, added up, and row numbers within a bucket; so a hot source is
spread over as many tasks as it has buckets. At most ``SOURCES`` sources are
taken, which bounds what is collected and broadcast; for more, give a coarser
column.

Defined results: a null source is a source like any other; a source without a
given weight, or with a weight that is not above zero, raises ``ValueError`` (by
default weights follow the square root of a source's documents); nulls in other
columns, empty and long texts do not matter; repeated rows are documents of their
own, in no defined order among themselves; an empty table gives an empty
result. Columns pass through, those of the schedule replacing any of the same name.
"""

from __future__ import annotations

import heapq
import math
from array import array
from fractions import Fraction

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

BLOCK = 16  # documents
SOURCES = 256
PERIOD = math.lcm(*range(1, 41))  # about 5.3e15; thirds, tenths and the like are whole parts
PER_BUCKET = 4096

SCHEDULE = ("slot", "position", "phase", "block", "release", "deadline", "deviation")


def parts(weights: list[float], period: int) -> list[int]:
    """Whole numbers in the weights' proportion that add up to ``period``; one for what would round to none."""
    exact = [Fraction(w) for w in weights]
    total = sum(exact)
    share = [w * period / total for w in exact]
    whole = [max(1, math.floor(s)) for s in share]
    missing = period - sum(whole)
    rest = sorted(range(len(share)), key=lambda i: (whole[i] - share[i], i))
    for i in rest[: max(0, missing)]:
        whole[i] += 1
    for _ in range(-missing):
        whole[whole.index(max(whole))] -= 1
    return whole


def _dealt(shares: list[int], left: list[int], length: int | None = None) -> tuple[list[tuple[array, array, array]], int]:
    """Per source the slots, releases and deadlines of its blocks, earliest deadline first among
    released ones, until a source has had all it has ``left`` or ``length`` slots are gone; and the slots used.
    """
    period = sum(shares)
    made = [(array("q"), array("q"), array("q")) for _ in shares]
    ready = [(-(-period // a), s, 0) for s, a in enumerate(shares)]
    heapq.heapify(ready)
    waiting: list[tuple[int, int]] = []
    slot = 0
    while length is None or slot < length:
        while waiting and waiting[0][0] <= slot:
            release, s = heapq.heappop(waiting)
            heapq.heappush(ready, (-(-(len(made[s][0]) + 1) * period // shares[s]), s, release))
        deadline, s, release = heapq.heappop(ready)
        for column, value in zip(made[s], (slot, release, deadline)):
            column.append(value)
        slot += 1
        done = len(made[s][0])
        if done == left[s]:
            break
        heapq.heappush(waiting, (done * period // shares[s], s))
    return made, slot


def period_slots(shares: list[int]) -> list[list[int]]:
    """Per source, the slots of its blocks in one period, earliest deadline first among released blocks."""
    made, _ = _dealt(shares, [a + 1 for a in shares], sum(shares))
    return [list(slots) for slots, _, _ in made]


def phases(blocks: list[int], weights: list[float]) -> list[list[dict]]:
    """Per source, the phases it has blocks in: number, first block, share, where the phase begins, and each block's slot in it."""
    out: list[list[dict]] = [[] for _ in blocks]
    left, begin, number = list(blocks), 0, 0
    while active := [s for s, n in enumerate(left) if n]:
        given = [weights[s] for s in active]
        shares = parts(given, max(PERIOD, 10 * len(active)))
        # The phase ends with the last block of the source that is through first.
        made, length = _dealt(shares, [left[s] for s in active])
        number, total = number + 1, math.fsum(given)
        for s, a, w, (slots, releases, deadlines) in zip(active, shares, given, made):
            if slots:
                phase = {"phase": number, "first": blocks[s] - left[s], "share": a, "period": sum(shares), "begin": begin}
                out[s].append(phase | {"weight": w / total, "slots": slots, "releases": releases, "deadlines": deadlines})
            left[s] -= len(slots)
        begin += length
    return out


PLAN = {"block": "long", "slot": "long", "phase": "int", "release": "long", "deadline": "long", "deviation": "double"}


def _plan(made: list[list[dict]]) -> pa.Table:
    """A row per block: the number of its source and the columns of ``PLAN``."""
    columns: list[list[np.ndarray]] = [[np.zeros(0, np.int64)] for _ in range(6)] + [[np.zeros(0)]]
    for s, own in enumerate(made):
        for p in own:
            local = np.array(p["slots"], np.int64)
            i, same = np.arange(len(local)), np.ones(len(local), np.int64)
            # Blocks had, less the share of the slots gone by, when this block is through.
            deviation = (i + 1) - (local + 1) * p["weight"]
            released, due = np.array(p["releases"], np.int64), np.array(p["deadlines"], np.int64)
            values = (s * same, p["first"] + i, p["begin"] + local, p["phase"] * same, p["begin"] + released, p["begin"] + due, deviation)
            for column, value in zip(columns, values):
                column.append(value)
    return pa.table({n: np.concatenate(c) for n, c in zip(("__n", *PLAN), columns)})


def mix(docs: DataFrame, source: str = "source", weights: dict | None = None, block: int = BLOCK) -> DataFrame:
    """``docs`` with their place in the mixture, in columns ``SCHEDULE``; ``position`` orders the documents."""
    spark = docs.sparkSession
    docs = docs.drop(*SCHEDULE)
    label, key = F.col(f"`{source}`").cast("string"), F.xxhash64("doc_id")
    sized = docs.groupBy(label.alias("s")).agg(F.count(F.lit(1)).alias("n")).limit(SOURCES + 1).collect()
    if len(sized) > SOURCES:
        raise ValueError(f"more than {SOURCES} sources; give a coarser column")
    sized.sort(key=lambda r: (r["s"] is not None, r["s"]))
    wanted = {r["s"]: math.sqrt(r["n"]) for r in sized} if weights is None else weights
    if missing := [r["s"] for r in sized if not wanted.get(r["s"], 0) > 0]:
        raise ValueError(f"no weight above zero for sources {missing}")
    made = phases([-(-r["n"] // block) for r in sized], [float(wanted[r["s"]]) for r in sized])
    plan = spark.createDataFrame(_plan(made))
    numbers = spark.createDataFrame([(r["s"], i) for i, r in enumerate(sized)], "s string, __n long")

    buckets = max(1, sum(r["n"] for r in sized) // PER_BUCKET)
    placed = docs.withColumns({"__s": label, "__key": key, "__bucket": F.pmod(key, F.lit(buckets))})
    placed = placed.join(F.broadcast(numbers), placed["__s"].eqNullSafe(numbers["s"])).drop("s")
    counted = placed.groupBy("__n", "__bucket").agg(F.count(F.lit(1)).alias("n"))
    before = F.sum("n").over(Window.partitionBy("__n").orderBy("__bucket").rowsBetween(Window.unboundedPreceding, -1))
    counted = counted.select("__n", "__bucket", F.coalesce(before, F.lit(0)).alias("before"), "n")
    # Each bucket with the plan of the blocks it has documents in.
    low, high = F.floor(F.col("before") / block).cast("long"), F.floor((F.col("before") + F.col("n") - 1) / block).cast("long")
    held = counted.select("__n", "__bucket", "before", F.explode(F.sequence(low, high)).alias("block"))
    planned = held.join(plan, ["__n", "block"]).groupBy("__n", "__bucket", "before").agg(
        F.sort_array(F.collect_list(F.struct(*PLAN))).alias("__plans")
    )
    row = F.row_number().over(Window.partitionBy("__n", "__bucket").orderBy("__key", "doc_id"))
    # The rows are joined where the window has put them.
    placed = placed.withColumn("__row", row - 1).join(planned, ["__n", "__bucket"])

    index = F.col("before") + F.col("__row")
    nth = F.floor(index / block) - F.floor(F.col("before") / block)
    placed = placed.withColumns({"__in": F.pmod(index, F.lit(block)), "__plan": F.get("__plans", nth.cast("int"))})
    placed = placed.withColumns({c: F.col("__plan")[c] for c in PLAN})
    placed = placed.withColumn("position", F.col("slot") * block + F.col("__in"))
    return placed.select(*docs.columns, *SCHEDULE)


def in_order(docs: DataFrame, source: str = "source", weights: dict | None = None, block: int = BLOCK) -> DataFrame:
    """``docs``, all of them and no other columns, in the order of the mixture over partitions and within them."""
    mixed = mix(docs.withColumns({f"__c{i}": F.col(f"`{c}`") for i, c in enumerate(docs.columns)}), source, weights, block)
    ordered = mixed.repartitionByRange("position").sortWithinPartitions("position")
    return ordered.select(*[F.col(f"__c{i}").alias(c) for i, c in enumerate(docs.columns)])


def report(docs: DataFrame) -> DataFrame:
    """Every document's place in the mixture, with weights by the square root of a source's documents."""
    return mix(docs.select("doc_id", "source"))

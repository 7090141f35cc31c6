"""Near duplicates: a multi-index Hamming join of min-hash signatures, confirmed on full sets.

1. A document's set is its distinct five-word shingles, as 64-bit hashes. Equal
   sets are one class, told by two sums over the set; a class has the smallest
   of its doc_ids as its id, and only classes go on.
2. A signature has ``HASHES`` values of 16 bits. Linked sets differ in so few of
   them that ``DISTANCE`` is over five standard deviations off: at a similarity of
   0.85, one in a million linked pairs is farther apart.
3. The signature is split into ``CHUNKS``. Two signatures within ``DISTANCE`` have,
   by the pigeonhole principle, a chunk with at most DISTANCE // CHUNKS = 1
   error; leaving out each place of a chunk in turn enumerates that error. So
   every pair within the distance shares a key, with no exception.
4. Keys of one class go no further. Every other class is first held against the
   nearest of the smallest classes of its keys, and the pairs that are linked are
   joined into components. What is left, pairs in different components that share a
   key and are within the distance, is then confirmed too. Pairs already connected
   need no test, since no link can change their component. So a hot group of
   copies costs a pair for each member, not all pairs. Of the rest, the shingles
   that a class shares with no other bound its similarity to all of them: copies with
   too many changes drop out. The others are held against the least changed
   class of their keys; what two of them lack of it and add to it, folded by parity
   into a few numbers, bounds their similarity from above.
   Only pairs that these bounds leave open are confirmed one by one.
5. A pair is linked when the intersection of the full sets is at least
   ``similarity`` percent of the union.

Defined results: a null or empty text, or one of white space, has no shingle,
is linked with nothing and kept; a text of under five words has its whole
sequence as the one shingle; repeated rows are copies and each gets its row; a row
without doc_id is linked like any other, but is kept only if its component has
no doc_id at all: then ``component_id`` is a number of 2**62 or more made from a set, and
the rows with that set are the kept ones (null if there is no shingle);
an empty table gives an empty result. Columns beside doc_id and text are ignored
by ``groups`` and pass through ``deduplicate``.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import LongType

from ledgerlight.llm import shared

WORDS, HASHES, CHUNKS, DISTANCE = 5, 64, 13, 24
KINDS = ["n_shingles", "sum_a", "sum_b"]  # what tells a set
FOLDS = 4  # of 64 places each, for what a class lacks of its centre and adds to it
SLICES = 8  # of a signature's 16 bits a value, as many are compared

_RANDOM = np.random.default_rng(20240602)
_TIMES = _RANDOM.integers(0, 1 << 62, HASHES, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_PLUS = _RANDOM.integers(0, 1 << 63, HASHES, dtype=np.uint64)
_PLACE = _RANDOM.integers(0, 1 << 62, 8, dtype=np.uint64) * np.uint64(2) + np.uint64(1)


def _key_places() -> list[tuple[int, ...]]:
    """The places that each key holds: those of a chunk less the allowed errors."""
    errors = DISTANCE // CHUNKS
    return [kept for c in np.array_split(np.arange(HASHES), CHUNKS) for kept in combinations(c.tolist(), len(c) - errors)]


def shingles(text: str | None) -> np.ndarray:
    """The sorted hashes of a text's distinct shingles."""
    words = shared.word_hashes(text)
    n = len(words)
    if n == 0:
        return words
    width = min(n, WORDS)
    total = np.zeros(n - width + 1, np.uint64)
    for i in range(width):
        total += words[i : n - width + 1 + i] * _PLACE[i]
    return np.unique(shared.mixed(total + np.uint64(width)))


def signature(hashes: np.ndarray) -> np.ndarray:
    """16-bit min-hash values; long sets are taken in pieces."""
    least = np.full(HASHES, np.iinfo(np.uint64).max, np.uint64)
    for at in range(0, len(hashes), 8192):
        value = np.multiply.outer(_TIMES, hashes[at : at + 8192])
        value += _PLUS[:, None]
        np.minimum(least, value.min(axis=1), out=least)
    return shared.mixed(least) >> np.uint64(48)


def _keys(values: np.ndarray) -> np.ndarray:
    places = _key_places()
    padded = np.append(values, np.uint64(0))
    index = np.array([(*p, *[HASHES] * (WORDS - len(p))) for p in places])
    return shared.mixed((padded[index] * _PLACE[:WORDS]).sum(axis=1, dtype=np.uint64) + np.arange(1, len(places) + 1, dtype=np.uint64) * _PLACE[7])


def _slices(values: np.ndarray) -> np.ndarray:
    bits = (values[None, :] >> np.arange(SLICES, dtype=np.uint64)[:, None]) & np.uint64(1)
    return np.packbits(bits.astype(np.uint8), axis=1).view(">u8").ravel().astype(np.uint64)


def _described(docs: DataFrame) -> DataFrame:
    """Per row: the size of its set, two sums that tell the set, its signature and its keys."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            size, sums, slices, keys = [], [], [], []
            for text in batch.column("text"):
                found = shingles(text.as_py())
                values = signature(found)
                size.append(len(found))
                sums.append([found.sum(dtype=np.uint64), shared.mixed(found + _PLACE[6]).sum(dtype=np.uint64)])
                slices.append(_slices(values))
                keys.append(_keys(values) if len(found) else np.zeros(0, np.uint64))
            sums = np.array(sums, np.uint64).reshape(-1, 2).view(np.int64)
            slices = np.array(slices, np.uint64).reshape(-1, SLICES).view(np.int64)
            offsets = np.cumsum([0, *map(len, keys)])
            flat = np.concatenate([*keys, np.zeros(0, np.uint64)]).view(np.int64)
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("doc_id"),
                    pa.array(size, pa.int64()),
                    *(pa.array(sums[:, i]) for i in range(2)),
                    *(pa.array(slices[:, i]) for i in range(SLICES)),
                    pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), pa.array(flat)),
                ],
                ["doc_id", "n_shingles", "sum_a", "sum_b", *(f"s{i}" for i in range(SLICES)), "keys"],
            )

    fields = ", ".join(f"s{i} long" for i in range(SLICES))
    schema = f"doc_id long, n_shingles long, sum_a long, sum_b long, {fields}, keys array<long>"
    return docs.select(F.col("doc_id").cast(LongType()).alias("doc_id"), "text").mapInArrow(run, schema)


def _sets(docs: DataFrame) -> DataFrame:
    """(id, hashes) of the shingles of each text."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, 256):
                part = batch.slice(at, 256)
                found = [shingles(t.as_py()).view(np.int64) for t in part.column("text")]
                flat = np.concatenate([*found, np.zeros(0, np.int64)])
                lists = pa.ListArray.from_arrays(pa.array(np.cumsum([0, *map(len, found)]), pa.int32()), pa.array(flat))
                yield pa.RecordBatch.from_arrays([part.column("id"), lists], ["id", "hashes"])

    return docs.select(F.col("doc_id").cast(LongType()).alias("id"), "text").mapInArrow(run, "id long, hashes array<long>")


def _distance(a: str, b: str) -> Column:
    """In how many places the compared bits of two signatures differ; never more than the signatures do."""
    differ = F.col(f"{a}.s0").bitwiseXOR(F.col(f"{b}.s0"))
    for i in range(1, SLICES):
        differ = differ.bitwiseOR(F.col(f"{a}.s{i}").bitwiseXOR(F.col(f"{b}.s{i}")))
    return F.bit_count(differ)


def _within_distance(pairs: DataFrame, classes: DataFrame) -> DataFrame:
    slices = [f"s{i}" for i in range(SLICES)]
    a = classes.select(F.col("id").alias("a"), F.col("n_shingles").alias("n_a"), F.struct(*slices).alias("x"))
    b = classes.select(F.col("id").alias("b"), F.col("n_shingles").alias("n_b"), F.struct(*slices).alias("y"))
    near = pairs.join(a, "a").join(b, "b").select("a", "b", "n_a", "n_b", _distance("x", "y").alias("distance"))
    return near.where(F.col("distance") <= DISTANCE)


def _alone(ids: DataFrame, docs: DataFrame) -> DataFrame:
    """(id, alone): how many shingles each of these classes shares with no other of them."""
    sets = _sets(docs.join(ids.select(F.col("id").alias("doc_id")), "doc_id", "left_semi"))
    holders = sets.select("id", F.explode("hashes").alias("hash")).groupBy("hash").agg(
        F.min("id").alias("id"), F.max("id").alias("last")
    )
    single = holders.where("id = last").groupBy("id").agg(F.count(F.lit(1)).alias("alone"))
    return ids.join(single, "id", "left").select("id", F.coalesce("alone", F.lit(0)).alias("alone"))


def _folded(hashes: Column, part: int) -> Column:
    """A set folded by parity onto 64 of the ``64 * FOLDS`` places: two sets' folds differ in no more places than they do."""
    place = lambda h: F.call_function("shiftleft", F.lit(1).cast("long"), F.pmod(h, F.lit(64)).cast("int"))
    own = F.filter(hashes, lambda h: F.pmod(F.shiftright(h, 6), F.lit(FOLDS)) == part)
    return F.aggregate(own, F.lit(0).cast("long"), lambda acc, h: acc.bitwiseXOR(place(h)))


def _folds_apart(a: str, b: str) -> Column:
    differ = [F.bit_count(F.col(f"{a}{i}").bitwiseXOR(F.col(f"{b}{i}"))) for i in range(FOLDS)]
    return sum(differ[1:], differ[0])


def _overlaps(pairs: DataFrame, docs: DataFrame, folds: bool = False) -> DataFrame:
    """The pairs (a, b, n_a, n_b) with ``common``, the size of the intersection of the full sets.

    With ``folds``, also what b lacks of a and what it adds to it, folded.
    """
    pairs = shared.gathered(shared.cut(pairs))
    wanted = pairs.select(F.col("a").alias("doc_id")).union(pairs.select("b")).distinct()
    sets = _sets(docs.join(wanted, "doc_id", "left_semi"))
    left = sets.select(F.col("id").alias("a"), F.col("hashes").alias("x"))
    right = sets.select(F.col("id").alias("b"), F.col("hashes").alias("y"))
    common = F.size(F.array_intersect("x", "y")).cast("long").alias("common")
    more = []
    if folds:
        lacks, adds = F.array_except("x", "y"), F.array_except("y", "x")
        more = [_folded(h, i).alias(f"{n}{i}") for n, h in (("lacks", lacks), ("adds", adds)) for i in range(FOLDS)]
    return pairs.join(left, "a").join(right, "b").select("a", "b", "n_a", "n_b", common, *more)


def _links(overlaps: DataFrame, similarity: int) -> DataFrame:
    union = F.col("n_a") + F.col("n_b") - F.col("common")
    return overlaps.where(100 * F.col("common") >= similarity * union).select("a", "b").distinct()


def _linked(pairs: DataFrame, docs: DataFrame, similarity: int) -> DataFrame:
    """Those of the pairs whose full sets are similar enough."""
    # Sets of sizes too far apart cannot be.
    pairs = pairs.where(100 * F.least("n_a", "n_b") >= similarity * F.greatest("n_a", "n_b"))
    return _links(_overlaps(pairs, docs), similarity)


def _nameless(docs: DataFrame) -> DataFrame:
    """The rows without doc_id, with a number of their own in ``__row``."""
    return shared.cut(docs.where("doc_id is null").withColumn("__row", F.monotonically_increasing_id()))


def _told(nameless: DataFrame) -> DataFrame:
    """(__row, what tells its set) of such rows."""
    found = _described(nameless.select(F.col("__row").alias("doc_id"), "text"))
    return found.select(F.col("doc_id").alias("__row"), *KINDS)


def groups(docs: DataFrame, similarity: int = 85) -> DataFrame:
    """Per row of ``docs``: doc_id, n_shingles, component_id, kept.

    Documents are linked when 100 * intersection >= similarity * union of their
    shingle sets; ``component_id`` is the smallest doc_id reachable. ``similarity``
    must be 80 or more, for which the signature distance is made.
    """
    return _groups(docs, similarity).select("doc_id", "n_shingles", "component_id", "kept")


def _groups(docs: DataFrame, similarity: int) -> DataFrame:
    """What ``groups`` returns, and the sums that tell each row's set."""
    if similarity < 80:
        raise ValueError("the signature distance is made for a similarity of 80 or more")
    docs = docs.select("doc_id", "text")
    rows = shared.cut(_described(docs))
    kinds = KINDS
    slices = [f"s{i}" for i in range(SLICES)]
    # Nulls last: only a class without any doc_id gets a number made from its set.
    smallest = F.min(F.struct(F.col("doc_id").isNull().alias("nameless"), "doc_id", *slices, "keys")).alias("r")
    classes = rows.where("n_shingles > 0").groupBy(*kinds).agg(smallest)
    made = F.pmod(F.xxhash64(*kinds), F.lit(1 << 62)) + F.lit(1 << 62)
    named = F.coalesce("r.doc_id", made).alias("id")
    classes = shared.gathered(shared.cut(classes.select(*kinds, "r.nameless", named, *[f"r.{s}" for s in slices], "r.keys")))
    unnamed = classes.where("nameless").select(*kinds, "id")
    some_unnamed = not unnamed.isEmpty()
    if some_unnamed:
        nameless = _nameless(docs)
        one = _told(nameless).groupBy(*kinds).agg(F.min("__row").alias("__row")).join(unnamed, kinds)
        texts = shared.cut(nameless.join(one.select("__row", "id"), "__row").select(F.col("id").alias("doc_id"), "text"))
        docs = docs.where("doc_id is not null").union(texts)

    keyed = classes.select("id", F.explode("keys").alias("key"))
    busy = keyed.groupBy("key").agg(F.min("id").alias("lead"), F.max("id").alias("last")).where("lead < last")
    members = shared.gathered(shared.cut(keyed.join(busy.select("key", "lead"), "key")))

    # Each class is first held against the nearest of its keys' smallest classes.
    first = members.where("id > lead").select(F.col("lead").alias("a"), F.col("id").alias("b")).distinct()
    first = _within_distance(first, classes).groupBy("b").agg(
        F.min(F.struct("distance", "a", "n_a", "n_b")).alias("r")
    )
    links = shared.gathered(shared.cut(_linked(first.select("r.a", "b", "r.n_a", "r.n_b"), docs, similarity)))
    known = shared.components(links)

    # Classes that share a key but no component yet.
    placed = members.join(known, "id", "left").select("key", "id", F.coalesce("component", "id").alias("component"))
    open_keys = placed.groupBy("key").agg(F.min("component").alias("low"), F.max("component").alias("high"))
    placed = placed.join(open_keys.where("low < high").select("key"), "key", "left_semi").select("key", "id")
    placed = shared.gathered(shared.cut(placed))
    alone = _alone(placed.select("id").distinct(), docs)
    signed = classes.join(alone, "id").select("id", "n_shingles", "alone", F.struct(*slices).alias("sign"))
    # What no other class has cannot be in an intersection, and is in every union.
    signed = signed.where(100 * (F.col("n_shingles") - F.col("alone")) >= similarity * F.col("n_shingles"))
    signed = shared.gathered(shared.cut(signed))
    placed = shared.gathered(shared.cut(placed.join(signed, "id").select("key", "id", "alone")))

    # Each is held against the least changed class of its keys.
    least = placed.groupBy("key").agg(F.min(F.struct("alone", "id")).alias("least"))
    centre = placed.join(least, "key").groupBy("id").agg(F.min("least").alias("c")).select("id", F.col("c.id").alias("centre"))
    centre = shared.gathered(shared.cut(centre))
    held = centre.where("id <> centre").select(F.col("centre").alias("a"), F.col("id").alias("b"))
    held = _overlaps(_within_distance(held, classes).select("a", "b", "n_a", "n_b"), docs, folds=True)
    held = shared.gathered(shared.cut(held))
    links = shared.gathered(shared.cut(links.union(_links(held, similarity))))
    known = shared.components(links)

    # Pairs left over: in different components, within the distance, and by their own
    # shingles and what they lack of a centre they share not too far apart.
    folds = [f"{n}{i}" for n in ("lacks", "adds") for i in range(FOLDS)]
    changes = held.select(F.col("b").alias("id"), F.col("a").alias("centre"), *folds)
    changes = changes.union(centre.where("id = centre").select("id", "centre", *[F.lit(0).cast("long") for _ in folds]))
    signed = signed.join(changes, "id", "left").join(known, "id", "left")
    signed = signed.withColumn("component", F.coalesce("component", "id"))
    placed = placed.select("key", "id").join(signed, "id")
    a, b = placed.alias("a"), placed.alias("b")
    both = F.col("a.n_shingles") + F.col("b.n_shingles")
    alone = F.col("a.alone") + F.col("b.alone")
    # Of one centre's elements they differ in what one of them lacks, of others in what one adds.
    apart = F.when(
        F.col("a.centre") == F.col("b.centre"),
        _folds_apart("a.lacks", "b.lacks") + F.greatest(alone, _folds_apart("a.adds", "b.adds")),
    ).otherwise(alone)
    rest = a.join(
        b,
        (F.col("a.key") == F.col("b.key"))
        & (F.col("a.id") < F.col("b.id"))
        & (F.col("a.component") != F.col("b.component"))
        # Two sets with d elements in but one of them have a similarity of (n - d) / (n + d) for n in both sizes.
        & (100 * (both - apart) >= similarity * (both + apart))
        & (_distance("a.sign", "b.sign") <= DISTANCE),
    ).select(
        F.col("a.id").alias("a"), F.col("b.id").alias("b"), F.col("a.n_shingles").alias("n_a"), F.col("b.n_shingles").alias("n_b")
    ).distinct()
    final = shared.components(links.union(_linked(rest, docs, similarity)))

    component = classes.join(final, "id", "left").withColumn("component_id", F.coalesce("component", "id"))
    if some_unnamed:
        # A component with any doc_id has the smallest one, whatever numbers were made.
        real = component.where("not nameless").groupBy("component_id").agg(F.min("id").alias("real"))
        component = component.join(real, "component_id", "left").select(
            *kinds, F.coalesce("real", "component_id").alias("component_id"), F.when(F.col("nameless"), F.col("id")).alias("made")
        )
    else:
        component = component.select(*kinds, "component_id")
    out = rows.select("doc_id", *kinds).join(component, kinds, "left")
    component_id = F.coalesce("component_id", "doc_id")
    own = F.coalesce("doc_id", "made") if some_unnamed else F.col("doc_id")
    # Without shingles or doc_id there is no component, and nothing to drop a row for.
    kept = F.coalesce(component_id == own, component_id.isNull())
    return out.select("doc_id", *kinds, component_id.alias("component_id"), kept.alias("kept"))


def deduplicate(docs: DataFrame, similarity: int = 80) -> DataFrame:
    """``docs`` with one document of each group of near duplicates, the one of the smallest doc_id.

    Of repeated rows with one doc_id, one stays, and so does one of the rows without
    doc_id whose group has none. Documents without words are all kept, those
    without doc_id each for itself.
    """
    told = [F.when(F.col("doc_id").isNull(), F.col(k)).alias(k) for k in KINDS]
    found = _groups(docs, similarity).where("kept").groupBy("doc_id", *told).agg(F.count(F.lit(1)).alias("__rows"))
    found = shared.cut(found)
    chosen = docs.join(found.select("doc_id", "__rows"), "doc_id").select(*docs.columns, "__rows")
    out = chosen.where("__rows = 1").drop("__rows")
    if not found.where("__rows > 1 and doc_id is not null").isEmpty():
        out = out.union(chosen.where("__rows > 1").drop("__rows").dropDuplicates(["doc_id"]))
    kinds = found.where("doc_id is null").select(*KINDS)
    if not kinds.isEmpty():
        nameless = _nameless(docs)
        rows = shared.cut(_told(nameless))
        one = rows.where("n_shingles > 0").join(kinds, KINDS, "left_semi").groupBy(*KINDS).agg(F.min("__row").alias("__row"))
        stay = one.select("__row").union(rows.where("n_shingles = 0").select("__row"))
        out = out.union(nameless.join(stay, "__row").select(*docs.columns))
    return out


def oracle(similarity: int = 85) -> str:
    """DuckDB SQL of ``groups``: all pairs that share a shingle, and what each document reaches."""
    upper, lower = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
    return f"""
    with recursive words as (
      select doc_id, regexp_extract_all(translate(coalesce(text, ''), '{upper}', '{lower}'), '[^\\x20\\x09-\\x0D]+') as w from documents),
    listed as (
      select doc_id, case when len(w) >= 5 then list_transform(range(1, len(w) - 3), lambda i: array_to_string(w[i:i + 4], ' '))
        when len(w) > 0 then [array_to_string(w, ' ')] else [] end as s from words),
    shingles as (select distinct doc_id, unnest(s) as s from listed),
    sizes as (select doc_id, count(*) as n from shingles group by doc_id),
    pairs as (
      select a.doc_id as x, b.doc_id as y, count(*) as c from shingles a join shingles b on a.s = b.s and a.doc_id < b.doc_id
      group by a.doc_id, b.doc_id),
    links as (
      select x, y from pairs join sizes a on a.doc_id = x join sizes b on b.doc_id = y where 100 * c >= {similarity} * (a.n + b.n - c)),
    edges as (select x, y from links union all select y, x from links),
    reached as (select x, y from edges union select r.x, e.y from reached r join edges e on r.y = e.x),
    least as (select x, min(y) as y from reached group by x)
    select d.doc_id, coalesce(n, 0)::bigint as n_shingles, least(d.doc_id, coalesce(y, d.doc_id)) as component_id,
      coalesce(y, d.doc_id) >= d.doc_id as kept
    from documents d left join sizes using (doc_id) left join least on x = d.doc_id"""

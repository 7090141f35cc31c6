"""URL rules by Bloom filter cascades: exact membership without joins.

A rule is a host and a path; it fits its host and all subdomains where the url's path
starts with the rule's, and the longest rule that fits decides. So a url has a few
candidate keys, a suffix of its host at a dot with a prefix of its path as long as some
rule's, and asks which of them are listed. The candidate keys of all urls are the
corpus's complete universe of keys, over which a cascade answers exactly (Larisch et al.
2017): the first filter holds the listed keys; the keys of the universe that it takes
wrongly go to a second filter, the listed keys that this one takes wrongly to a third, and
so on until none is left. The first filter without a key tells by its depth whether the
key is listed. A second cascade over the listed keys alone tells blocked from allowed ones.

Keys are dealt to shards by hash, and each shard's cascades are built in one task, from
keys that passed the first filter where the urls are: of the universe only listed keys and
false positives are shuffled, once each. Cascades take some bits a listed key. They are
broadcast in parts of at most ``PART`` bytes; where they need more than one part, the urls
pass over the parts one after the other, with a checkpoint between, so that no task holds
more at once. Nothing is joined to the urls.

Defined results: the host is what stands between the first ``://`` and the next ``/``, ``?``
or ``#``, A-Z lower-cased; the path follows up to ``?`` or ``#``. A null url, or one without
``://``, has an empty host and path, and no rule. A url that no rule fits is on no list: the
verdict is allow. The longest rule is that of most characters of host and path, then of the
longer host. A rule given twice counts once, and blocks if either does; rules with a null
are ignored, as are columns beside page_id and url. Rows are judged one by one, repeated or
not. Empty tables, and no rules, are fine.
"""

from __future__ import annotations

import math
from collections.abc import Iterable, Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerlight.llm import shared

PER_SHARD = 1 << 16  # listed keys
PART = 32 << 20  # bytes of filters that are broadcast at once
RATES = (1 / 64, 1 / 2)  # of false positives: of the first filter, and of all others
DEEPEST = 200

# Host, path, verdict
RULES = (
    ("com", "/", "allow"),
    ("example.com", "/en/", "block"),
    ("www.example.com", "/en/", "allow"),
    ("net", "/es/", "block"),
    ("net", "/fr/", "block"),
)

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def host_and_path(url: Column) -> tuple[Column, Column]:
    after = F.when(F.instr(url, "://") > 0, F.substring_index(url, "://", 1)).otherwise(F.lit(None))
    rest = F.substring(url, F.length(after) + 4, F.length(url))
    host = F.regexp_extract(rest, "^[^/?#]*", 0)
    path = F.regexp_extract(F.substring(rest, F.length(host) + 1, F.length(rest)), "^[^?#]*", 0)
    return F.coalesce(F.translate(host, UPPER, LOWER), F.lit("")), F.coalesce(path, F.lit(""))


def candidates(host: Column, path: Column, lengths: list[int]) -> Column:
    """The keys of rules that could fit, as (key, host length, two hashes): host suffixes with path prefixes."""
    labels = F.split(host, r"\.", -1)
    suffixes = F.transform(F.sequence(F.lit(1), F.size(labels)), lambda i: F.array_join(F.slice(labels, i, F.size(labels)), "."))
    fitting = F.filter(F.array(*map(F.lit, lengths)).cast("array<int>"), lambda n: n <= F.length(path))
    keys = F.flatten(F.transform(suffixes, lambda h: F.transform(fitting, lambda n: _key(h, F.substring(path, F.lit(1), n)))))
    return F.when(host != "", keys).otherwise(F.slice(keys, 1, 0))


def _key(host: Column, path: Column) -> Column:
    text = F.concat(host, path)
    return F.struct(
        text.alias("key"), F.length(host).alias("host_length"), F.xxhash64(text).alias("h1"), F.xxhash64(text, F.lit(1)).alias("h2")
    )


class Filter:
    """A Bloom filter over pairs of 64-bit hashes; ``depth`` makes each filter of a cascade its own."""

    def __init__(self, depth: int, hashes: int, bits: np.ndarray):
        self.depth, self.hashes, self.bits = depth, hashes, bits

    @classmethod
    def holding(cls, depth: int, keys: np.ndarray) -> Filter:
        rate = RATES[min(depth, len(RATES) - 1)]
        size = max(64, 8 * math.ceil(len(keys) * math.log(1 / rate) / math.log(2) ** 2 / 8))
        made = cls(depth, max(1, round(math.log2(1 / rate))), np.zeros(size, bool))
        for at in made._places(keys):
            made.bits[at] = True
        return made

    def _places(self, keys: np.ndarray) -> Iterator[np.ndarray]:
        one = shared.mixed(keys[:, 0] + np.uint64(self.depth * 0x9E3779B97F4A7C15 % (1 << 64)))
        two = shared.mixed(keys[:, 1] ^ np.uint64(self.depth)) | np.uint64(1)
        for i in range(self.hashes):
            yield (one + np.uint64(i) * two) % np.uint64(len(self.bits))

    def takes(self, keys: np.ndarray) -> np.ndarray:
        return reduce(np.logical_and, (self.bits[at] for at in self._places(keys)), np.ones(len(keys), bool))

    def packed(self) -> tuple[int, bytes]:
        return self.hashes, np.packbits(self.bits).tobytes()

    @classmethod
    def unpacked(cls, depth: int, hashes: int, bits: bytes) -> Filter:
        return cls(depth, hashes, np.unpackbits(np.frombuffer(bits, np.uint8)).astype(bool))


def cascade(listed: np.ndarray, others: np.ndarray) -> list[Filter]:
    """Filters that tell listed keys from others; both are arrays of pairs of hashes, and share no pair."""
    filters, inside, outside = [], listed, others
    while len(inside):
        filters.append(Filter.holding(len(filters), inside))
        inside, outside = outside[filters[-1].takes(outside)], inside
        if len(filters) > DEEPEST:
            raise ArithmeticError("two keys have the same 128 bits of hashes")
    return filters


def is_listed(filters: list[Filter], keys: np.ndarray) -> np.ndarray:
    """Which keys are listed: those that the first filter without them is an odd one, or that all of an odd number hold."""
    depth = np.zeros(len(keys), np.int64)
    left = np.arange(len(keys))
    for f in filters:
        left = left[f.takes(keys[left])]
        depth[left] += 1
    return depth % 2 == 1


def _pairs(batch: pa.RecordBatch | pa.StructArray) -> np.ndarray:
    columns = [(batch.field(c) if isinstance(batch, pa.StructArray) else batch.column(c)) for c in ("h1", "h2")]
    return np.stack([c.to_numpy(zero_copy_only=False).astype(np.int64).view(np.uint64) for c in columns], axis=1).reshape(-1, 2)


FILTERS = "shard int, kind int, depth int, hashes int, bits binary"


def _built(rows: DataFrame, whole: bool) -> DataFrame:
    """The filters of each shard, from its keys; if not ``whole``, only the first one, which needs listed keys alone.

    Kind 0 tells listed keys from others, kind 1 blocked from allowed ones.
    """

    def build(table: pa.Table) -> pa.Table:
        t = table.combine_chunks().to_batches()[0]
        keys = _pairs(t)
        listed, blocked = (t.column(c).to_numpy(zero_copy_only=False).astype(bool) for c in ("listed", "blocked"))
        if whole:
            made = [cascade(keys[listed], keys[~listed]), cascade(keys[blocked], keys[listed & ~blocked])]
        else:
            made = [[Filter.holding(0, keys)], []]
        rows = [(t.column("shard")[0].as_py(), kind, f.depth, *f.packed()) for kind in (0, 1) for f in made[kind]]
        types = pa.int32(), pa.int32(), pa.int32(), pa.int32(), pa.binary()
        return pa.table([pa.array(c, k) for c, k in zip(zip(*rows), types)], ["shard", "kind", "depth", "hashes", "bits"])

    return rows.groupBy("shard").applyInArrow(build, FILTERS)


def _parts(filters: DataFrame) -> list[list]:
    """Broadcasts of filters, whole shards together, each of at most ``PART`` bytes or one shard."""
    filters = filters.persist()
    sizes = filters.groupBy("shard").agg(F.sum(F.length("bits")).alias("size")).orderBy("shard").toLocalIterator()
    bounds, held = [], None
    for r in sizes:
        if held is None or held + r["size"] > PART:
            bounds.append(r["shard"])
            held = 0
        held += r["size"]
    context = filters.sparkSession.sparkContext
    parts = []
    for low, high in zip(bounds, [*bounds[1:], 1 << 31]):
        rows = filters.where((F.col("shard") >= low) & (F.col("shard") < high)).orderBy("shard", "kind", "depth").collect()
        parts.append(context.broadcast([tuple(r) for r in rows]))
    filters.unpersist()
    return parts


def _loaded(rows: list[tuple]) -> dict[tuple[int, int], list[Filter]]:
    found: dict = {}
    for shard, kind, depth, hashes, bits in rows:
        found.setdefault((shard, kind), []).append(Filter.unpacked(depth, hashes, bytes(bits)))
    return found


def _shards_of(keys: np.ndarray, shards: int) -> np.ndarray:
    return (shared.mixed(keys[:, 0]) % np.uint64(shards)).astype(np.int64)


def _asked(filters: dict, kind: int, keys: np.ndarray, shards: int) -> np.ndarray:
    out, shard = np.zeros(len(keys), bool), _shards_of(keys, shards)
    for s in np.unique(shard):
        at = np.flatnonzero(shard == s)
        out[at] = is_listed(filters.get((int(s), kind), []), keys[at])
    return out


def _passed(keys: DataFrame, part, shards: int) -> DataFrame:
    """Those of the keys (key, h1, h2) that the first filters of one part take, with their shard."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        filters = _loaded(part.value)
        for b in batches:
            pairs = _pairs(b)
            shard, taken = _shards_of(pairs, shards), np.zeros(b.num_rows, bool)
            for s in np.unique(shard):
                if (int(s), 0) in filters:
                    at = np.flatnonzero(shard == s)
                    taken[at] = filters[int(s), 0][0].takes(pairs[at])
            yield b.filter(pa.array(taken)).append_column("shard", pa.array(shard[taken], pa.int32()))

    return keys.mapInArrow(run, "key string, h1 long, h2 long, shard int")


def judge(urls: DataFrame, rules: DataFrame, url: str = "url") -> DataFrame:
    """``urls`` with host, path, rule and verdict; ``rules`` are rows (host, path, verdict: allow or block)."""
    given = rules.where("host is not null and path is not null and verdict is not null")
    keyed = given.select(_key(F.translate("host", UPPER, LOWER), F.col("path")).alias("k"), (F.col("verdict") == "block").alias("blocked"))
    listed = keyed.groupBy("k.key", "k.h1", "k.h2").agg(F.max("blocked").alias("blocked"))
    # Path lengths of rules are no more than the longest path has characters.
    lengths = sorted(r[0] for r in given.select(F.length("path")).distinct().collect())
    shards = max(1, -(-listed.count() // PER_SHARD))

    def shard(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            yield b.append_column("shard", pa.array(_shards_of(_pairs(b), shards), pa.int32()))

    listed = listed.mapInArrow(shard, "key string, h1 long, h2 long, blocked boolean, shard int")
    listed = listed.withColumn("listed", F.lit(True))
    kept = [c for c in urls.columns if c not in ("host", "path", "rule", "verdict")]
    host, path = host_and_path(F.col(f"`{url}`"))
    # Columns of any name are numbered while the rows are in Python.
    split = urls.select(*[F.col(f"`{c}`").alias(f"__{i}") for i, c in enumerate(kept)], host.alias("host"), path.alias("path"))
    keys = candidates(F.col("host"), F.col("path"), lengths)
    # The universe: every candidate key of the corpus. What the first filter takes and is not listed goes to the next.
    universe = split.select("host", "path").select(F.inline(keys)).select("key", "h1", "h2")
    none = listed.where("false").select("key", "h1", "h2", "shard")
    taken = reduce(DataFrame.unionByName, [_passed(universe, part, shards) for part in _parts(_built(listed, whole=False))], none)
    both = taken.select("*", F.lit(False).alias("blocked"), F.lit(False).alias("listed")).unionByName(listed)
    known = both.groupBy("shard", "key", "h1", "h2").agg(F.max("blocked").alias("blocked"), F.max("listed").alias("listed"))
    parts = _parts(_built(known, whole=True))

    parts = parts or [split.sparkSession.sparkContext.broadcast([])]  # no rules
    asked = split.withColumn("__keys", keys).withColumn("__rule", F.lit(None).cast("struct<rank: long, rule: string, verdict: string>"))
    for i, part in enumerate(parts):
        asked = _ruled(shared.cut(asked) if i else asked, part, shards)
    return asked.select(
        *[F.col(f"__{i}").alias(c) for i, c in enumerate(kept)], "host", "path",
        F.col("__rule.rule").alias("rule"), F.coalesce("__rule.verdict", F.lit("allow")).alias("verdict"),
    )


def _ruled(asked: DataFrame, part, shards: int) -> DataFrame:
    """``asked`` with the longest rule among a url's keys in the shards of one part, and the one so far."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        filters = _loaded(part.value)
        for b in batches:
            lists = b.column("__keys")
            keys = lists.flatten()
            pairs, row = _pairs(keys), np.repeat(np.arange(b.num_rows), np.diff(lists.offsets.to_numpy()))
            hit = np.flatnonzero(_asked(filters, 0, pairs, shards))
            blocked = _asked(filters, 1, pairs[hit], shards)
            best = b.column("__rule").to_pylist()
            texts, hosts = keys.field("key").take(pa.array(hit)).to_pylist(), keys.field("host_length").take(pa.array(hit)).to_pylist()
            for r, text, host, block in zip(row[hit], texts, hosts, blocked):
                rank = len(text) << 32 | host
                if best[r] is None or rank > best[r]["rank"]:
                    best[r] = {"rank": rank, "rule": text, "verdict": "block" if block else "allow"}
            at = b.schema.get_field_index("__rule")
            yield b.set_column(at, b.schema.field(at), pa.array(best, b.schema.field(at).type))

    return asked.mapInArrow(run, asked.schema)


def report(pages: DataFrame, rules: Iterable[tuple[str, str, str]] = RULES) -> DataFrame:
    """Every page's url judged by the fixed rules."""
    given = pages.sparkSession.createDataFrame(list(rules), "host string, path string, verdict string")
    return judge(pages.select("page_id", "url"), given).select("page_id", "host", "path", "rule", "verdict")


def oracle() -> str:
    """DuckDB SQL of ``report``."""
    given = ", ".join(f"('{h}', '{p}', '{v}')" for h, p, v in RULES)
    return f"""
    with cut as (
      select *, case when strpos(url, '://') > 0 then substr(url, strpos(url, '://') + 3) else '' end as rest from pages),
    hosts as (select *, regexp_extract(rest, '^[^/?#]*') as raw from cut),
    split as (
      select page_id, translate(raw, '{UPPER}', '{LOWER}') as host,
        regexp_extract(substr(rest, length(raw) + 1), '^[^?#]*') as path, row_number() over () as row from hosts),
    rules(rule_host, rule_path, rule_verdict) as (values {given}),
    ranked as (
      select *, row_number() over (partition by row order by length(rule_host || rule_path) desc nulls last) as place
      from split left join rules on (host = rule_host or suffix(host, '.' || rule_host)) and starts_with(path, rule_path))
    select page_id, host, path, rule_host || rule_path as rule, coalesce(rule_verdict, 'allow') as verdict
    from ranked where place = 1"""

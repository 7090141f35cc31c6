"""Secret scans: known formats, and sliding-window entropy of candidate strings.

Only DataFrame functions are used; every row is scanned where it is read, with
no shuffle. Findings are code point spans with an exclusive end:

- ``assign``, ``access`` and ``hex`` are the known formats. Matches are taken
  leftmost and non-overlapping per kind, and those too short are dropped after
  that, so a short match still uses up its text.
- ``entropy`` spans come from maximal runs of the characters of a class. A
  window of ``WINDOW`` characters slides over each run; its Shannon entropy is
  kept up to date from the counts of the one character that enters and the one
  that leaves. Windows at or over the class's threshold are merged into spans.
  Runs on the allow-list and spans that touch a known format are suppressed.

Defined results: a null text is an empty one and has no findings; a text of any
length is scanned whole; equal rows get equal findings; an empty table gives an
empty result. Other columns pass through; the result column is named by the
caller, and a column of that name is replaced.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# The known formats and their least lengths.
KINDS = ("assign", "access", "hex", "entropy")
ASSIGN = (
    "(?:[Pp][Aa][Ss][Ss][Ww][Oo][Rr][Dd]|[Pp][Aa][Ss][Ss][Ww][Dd]|[Ss][Ee][Cc][Rr][Ee][Tt]|[Tt][Oo][Kk][Ee][Nn]"
    "|[Aa][Pp][Ii]_?[Kk][Ee][Yy])[\"']? *[:=] *[\"']?[A-Za-z0-9+/_.=-]+"
)
# What stands before the value of an assignment.
ASSIGN_HEAD = "^[A-Za-z]+_?[A-Za-z]*[\"']? *[:=] *[\"']?"
ACCESS = "AKIA[A-Z0-9]+"
HEX = "[0-9a-f]+"
LEAST = {"assign": 6, "access": 20, "hex": 24}

# Entropy is compared in whole units of a millionth of a bit, so that no
# rounding depends on the order of the updates.
UNIT = 1_000_000
WINDOW = 20


@dataclass(frozen=True)
class CharacterClass:
    """Runs of ``alphabet`` with a window of at least ``bits`` per character."""

    name: str
    pattern: str
    alphabet: str
    bits: float

    @property
    def most(self) -> int:
        """The largest sum of c * log2(c) over a window's counts c that is suspicious."""
        return math.floor(WINDOW * (math.log2(WINDOW) - self.bits) * UNIT)


DIGITS, LOWER = "0123456789", "abcdefghijklmnopqrstuvwxyz"
CLASSES = (
    CharacterClass("hexadecimal", "[0-9A-Fa-f]", DIGITS + "abcdefABCDEF", 2.9),
    CharacterClass("base64", "[A-Za-z0-9+/_-]", DIGITS + LOWER + LOWER.upper() + "+/_-", 3.7),
)

# Runs that match one of these are no secrets: words or numbers alone, paths,
# identifiers in the form of a UUID, placeholders, counted-up characters.
ALLOWED = (
    "^[A-Za-z+/_-]*$",
    "^[0-9+/_-]*$",
    "^/?([a-z0-9_.-]+/)+[a-z0-9_.-]*$",
    "^[0-9A-Fa-f]{8}-[0-9A-Fa-f]{4}-[0-9A-Fa-f]{4}-[0-9A-Fa-f]{4}-[0-9A-Fa-f]{12}$",
    "EXAMPLE|example|xxxx|XXXX|0123456789|abcdefgh|ABCDEFGH",
)


def terms() -> list[int]:
    """c * log2(c) in whole units, for every count c that a window can hold."""
    return [round(c * math.log2(c) * UNIT) if c else 0 for c in range(WINDOW + 1)]


def _located(text: Column, pattern: str) -> Column:
    """Array of (start, end, value) of the leftmost non-overlapping matches.

    The matches and the texts between them alternate, so that running sums of
    both lengths give the positions. Texts without a match stop at the first step.
    """
    values = F.regexp_extract_all(text, F.lit(pattern), F.lit(0))
    gaps = F.split(text, pattern, -1)

    def step(acc: Column, pair: Column) -> Column:
        start = acc["at"] + F.length(pair["gap"])
        end = start + F.length(pair["value"])
        found = F.struct(start.alias("start"), end.alias("end"), pair["value"].alias("value"))
        return F.struct(end.alias("at"), F.array_append(acc["found"], found).alias("found"))

    nothing = F.array().cast("array<struct<start:int,end:int,value:string>>")
    pairs = F.arrays_zip(values.alias("value"), F.slice(gaps, 1, F.size(values)).alias("gap"))
    begin = F.struct(F.lit(0).alias("at"), nothing.alias("found"))
    return F.when(F.size(values) == 0, nothing).otherwise(
        F.aggregate(pairs, begin, step, lambda acc: acc["found"])
    )


def _named(found: Column, kind: str) -> Column:
    """Spans (start, order, end, kind), in the order of their report."""
    return F.transform(
        found,
        lambda m: F.struct(
            m["start"].alias("start"),
            F.lit(KINDS.index(kind)).alias("order"),
            m["end"].alias("end"),
            F.lit(kind).alias("kind"),
        ),
    )


def _known(text: Column, kind: str) -> Column:
    pattern = {"assign": ASSIGN, "access": ACCESS, "hex": HEX}[kind]
    if kind == "hex":
        # Runs are maximal either way; the shorter ones need no row of their own.
        return _named(_located(text, f"[0-9a-f]{{{LEAST[kind]},}}"), kind)
    size = lambda m: F.length(F.regexp_replace(m["value"], ASSIGN_HEAD, "") if kind == "assign" else m["value"])
    return _named(F.filter(_located(text, pattern), lambda m: size(m) >= LEAST[kind]), kind)


def _hot_windows(value: Column, of: CharacterClass) -> Column:
    """Spans (start, end), within a run, of its merged suspicious windows."""
    codes = F.transform(F.split(value, ""), lambda ch: F.instr(F.lit(of.alphabet), ch))
    table = F.array(*[F.lit(t).cast("long") for t in terms()])
    f = lambda c: F.get(table, c)

    def step(acc: Column, i: Column) -> Column:
        come = F.get(acc["codes"], i)
        gone = F.when(i >= WINDOW, F.get(acc["codes"], i - WINDOW)).otherwise(F.lit(0))
        n_come, n_gone = F.get(acc["counts"], come), F.get(acc["counts"], gone)
        # Code 0 stands for no character: its count is not part of the sum.
        gain = F.when(come == gone, F.lit(0).cast("long")).otherwise(
            f(n_come + 1) - f(n_come) + F.when(gone > 0, f(n_gone - 1) - f(n_gone)).otherwise(F.lit(0).cast("long"))
        )
        total = acc["total"] + gain
        counts = F.transform(
            acc["counts"],
            lambda n, k: n + (k == come).cast("int") - F.when((k == gone) & (gone > 0), 1).otherwise(0),
        )
        start, end = i + 1 - WINDOW, i + 1
        open_ = F.element_at(acc["spans"], -1)
        joined = F.when(
            (F.size(acc["spans"]) > 0) & (F.get(acc["spans"], F.size(acc["spans"]) - 1)["end"] >= start),
            F.array_append(
                F.slice(acc["spans"], 1, F.size(acc["spans"]) - 1),
                F.struct(open_["start"].alias("start"), end.alias("end")),
            ),
        ).otherwise(F.array_append(acc["spans"], F.struct(start.alias("start"), end.alias("end"))))
        spans = F.when((end >= WINDOW) & (total <= of.most), joined).otherwise(acc["spans"])
        return F.struct(
            acc["codes"].alias("codes"), counts.alias("counts"), total.alias("total"), spans.alias("spans")
        )

    begin = F.struct(
        codes.alias("codes"),
        F.array_repeat(F.lit(0), len(of.alphabet) + 1).alias("counts"),
        F.lit(0).cast("long").alias("total"),
        F.array().cast("array<struct<start:int,end:int>>").alias("spans"),
    )
    return F.aggregate(F.sequence(F.lit(0), F.length(value) - 1), begin, step, lambda acc: acc["spans"])


def _suspicious(text: Column, of: CharacterClass) -> Column:
    """Array of (start, end) of suspicious strings of one character class."""
    runs = _located(text, f"{of.pattern}{{{WINDOW},}}")
    runs = F.filter(runs, lambda m: ~m["value"].rlike("|".join(f"(?:{p})" for p in ALLOWED)))
    moved = F.transform(
        runs,
        lambda m: F.transform(
            _hot_windows(m["value"], of),
            lambda s: F.struct((m["start"] + s["start"]).alias("start"), (m["start"] + s["end"]).alias("end")),
        ),
    )
    return F.flatten(moved)


def find_secrets(docs: DataFrame, text: str = "text", out: str = "secrets") -> DataFrame:
    """``docs`` with ``out``: array of (kind, start, end) by start, then kind as in ``KINDS``."""
    names = ["__text", *[f"__{k}" for k in KINDS[:3]], *[f"__{c.name}" for c in CLASSES]]
    df = docs.withColumn(names[0], F.coalesce(F.col(f"`{text}`"), F.lit("")))
    body = F.col(names[0])
    df = df.withColumns(
        {f"__{k}": _known(body, k) for k in KINDS[:3]} | {f"__{c.name}": _suspicious(body, c) for c in CLASSES}
    )
    known = F.concat(*[F.col(f"__{k}") for k in KINDS[:3]])
    apart = lambda a, b: (a["end"] <= b["start"]) | (b["end"] <= a["start"])
    hexes, mixed = (F.col(f"__{c.name}") for c in CLASSES)
    # A string suspicious in both classes is reported once, as the longer one.
    more = F.concat(mixed, F.filter(hexes, lambda h: F.forall(mixed, lambda m: apart(h, m))))
    more = F.filter(more, lambda s: F.forall(known, lambda k: apart(s, k)))
    ordered = F.array_sort(F.concat(known, _named(more, "entropy")))
    found = F.transform(
        ordered, lambda s: F.struct(s["kind"].alias("kind"), s["start"].alias("start"), s["end"].alias("end"))
    )
    return df.withColumn(names[0], found).drop(*([out] if out in docs.columns else []), *names[1:]).withColumnRenamed(
        names[0], out
    )


def redact(docs: DataFrame, text: str = "text", mask: str = "<SECRET>") -> DataFrame:
    """``docs`` with every finding in ``text`` replaced by ``mask``; overlapping findings become one.

    Texts without a finding stay as they are, nulls included.
    """
    found = find_secrets(docs, text, "__found")
    body, spans = F.col(f"`{text}`"), F.col("__found")

    def step(acc: Column, s: Column) -> Column:
        between = F.substring(body, acc["at"] + 1, s["start"] - acc["at"])
        more = F.when(s["start"] >= acc["at"], F.concat(acc["made"], between, F.lit(mask))).otherwise(acc["made"])
        return F.struct(F.greatest(acc["at"], s["end"]).alias("at"), more.alias("made"))

    begin = F.struct(F.lit(0).alias("at"), F.lit("").alias("made"))
    clean = F.aggregate(
        spans, begin, step, lambda acc: F.concat(acc["made"], F.substring(body, acc["at"] + 1, F.length(body)))
    )
    return found.withColumn(text, F.when(F.size(spans) > 0, clean).otherwise(body)).drop("__found")


def _digest(spans: Column) -> Column:
    return F.array_join(
        F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))),
        ",",
    )


def report(docs: DataFrame) -> DataFrame:
    """Per document: how many findings of each known format, and all spans."""
    found = find_secrets(docs.select("doc_id", "text"))
    spans = F.col("secrets")
    count = lambda kind: F.size(F.filter(spans, lambda s: s["kind"] == kind)).cast("long")
    return found.select(
        "doc_id",
        *[count(k).alias(f"n_{k}") for k in KINDS[:3]],
        F.sha2(_digest(F.filter(spans, lambda s: s["kind"] != "entropy")), 256).alias("base_sha256"),
        _digest(spans).alias("spans"),
    )


def oracle() -> str:
    """DuckDB SQL of ``report``; every window's entropy is counted anew."""
    quoted = lambda p: "'" + p.replace("'", "''") + "'"
    table = "[" + ", ".join(map(str, terms())) + "]"
    patterns = [(k, {"assign": ASSIGN, "access": ACCESS, "hex": HEX}[k]) for k in KINDS[:3]]
    patterns += [(c.name, f"{c.pattern}{{{WINDOW},}}") for c in CLASSES]
    located = " union all ".join(
        f"select rid, '{k}' as what, regexp_extract_all(text, {quoted(p)}) as m, string_split_regex(text, {quoted(p)}) as g from docs"
        for k, p in patterns
    )
    allowed = " and ".join(f"not regexp_matches(value, {quoted(p)})" for p in ALLOWED)
    most = " ".join(f"when '{c.name}' then {c.most}" for c in CLASSES)
    classes = ", ".join(f"'{c.name}'" for c in CLASSES)
    return f"""
    with docs as (select row_number() over () as rid, doc_id, coalesce(text, '') as text from documents),
    pieces as ({located}),
    numbered as (select rid, what, unnest(m) as value, unnest(g[1:len(m)]) as gap, unnest(range(len(m))) as n from pieces where len(m) > 0),
    placed as (
      select rid, what, value, (sum(length(gap) + length(value)) over (partition by rid, what order by n))::bigint as e
      from numbered),
    known as (
      select rid, what as kind, e - length(value) as s, e,
        case what when 'assign' then 0 when 'access' then 1 else 2 end as o
      from placed where
        (what = 'assign' and length(regexp_replace(value, {quoted(ASSIGN_HEAD)}, '')) >= {LEAST["assign"]})
        or (what = 'access' and length(value) >= {LEAST["access"]})
        or (what = 'hex' and length(value) >= {LEAST["hex"]})),
    runs as (select rid, what, e - length(value) as pos, value from placed where what in ({classes}) and {allowed}),
    windows as (
      select rid, what, pos, value, unnest(range(length(value) - {WINDOW - 1})) as i from runs),
    hot as (
      select rid, what, pos, i from windows
      where list_sum(list_transform(map_values(list_histogram(string_split(substr(value, i + 1, {WINDOW}), ''))),
        lambda c: ({table})[(c + 1)::bigint])) <= case what {most} end),
    marked as (
      select *, case when i <= lag(i) over w + {WINDOW} then 0 else 1 end as fresh
      from hot window w as (partition by rid, what, pos order by i)),
    islands as (select *, sum(fresh) over (partition by rid, what, pos order by i) as island from marked),
    found as (
      select rid, what, pos + min(i) as s, pos + max(i) + {WINDOW} as e from islands group by rid, what, pos, island),
    more as (
      select rid, 'entropy' as kind, s, e, 3 as o from found f
      where not exists (select 1 from known k where k.rid = f.rid and k.s < f.e and f.s < k.e)
      and not (what = 'hexadecimal' and exists (
        select 1 from found b where b.what = 'base64' and b.rid = f.rid and b.s < f.e and f.s < b.e))),
    spans as (select * from known union all select * from more),
    listed as (
      select rid,
        count(*) filter (where kind = 'assign') as n_assign,
        count(*) filter (where kind = 'access') as n_access,
        count(*) filter (where kind = 'hex') as n_hex,
        string_agg(kind || ':' || s || ':' || e, ',' order by s, o) filter (where kind <> 'entropy') as base,
        string_agg(kind || ':' || s || ':' || e, ',' order by s, o) as spans
      from spans group by rid)
    select doc_id, coalesce(n_assign, 0)::bigint as n_assign, coalesce(n_access, 0)::bigint as n_access,
      coalesce(n_hex, 0)::bigint as n_hex, sha256(coalesce(base, '')) as base_sha256, coalesce(spans, '') as spans
    from docs left join listed using (rid)"""

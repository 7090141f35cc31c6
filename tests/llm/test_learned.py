"""The two classifiers: held-out accuracy, gradients, the automaton against plain edit distance, edge cases."""

from __future__ import annotations

import random
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from ledgerlight.llm import quality, registry, toxicity

SF_DIR = "/root/testdata/sf0.01"


@pytest.mark.parametrize("name,label,mod,held", [("op2_quality", "quality", 3, 1), ("op10_toxicity", "toxic", 5, 0)])
def test_held_out_accuracy(spark, name, label, mod, held):
    rows = registry.queries()[name](spark, SF_DIR).collect()
    assert len(rows) == registry.table(spark, SF_DIR, "documents").count()
    truth = {r["doc_id"]: r[label] for r in registry.table(spark, SF_DIR, "labels").collect()}
    right = []
    for r in rows:
        assert r["held_out"] == (zlib.crc32(str(r["doc_id"]).encode()) % mod == held)
        assert 0 <= r["score"] <= 1 and r["predicted"] == (r["score"] >= 0.5)
        if r["held_out"] and r["doc_id"] in truth:
            right.append(r["predicted"] == truth[r["doc_id"]])
    assert len(right) > 50 and np.mean(right) >= 0.95


def test_gradients_of_the_attention_model():
    rng = np.random.default_rng(3)
    bags = [rng.normal(size=(n, quality.FEATURES)) for n in (1, 4, 7)]
    rows, bounds, y = np.concatenate(bags), np.array([0, 1, 5, 12]), np.array([1.0, 0.0, 1.0])
    w = quality.fit([b.astype(np.float32) for b in bags], y).weights
    loss = lambda: np.mean([np.logaddexp(0, z) - t * z for z, t in zip(quality._forward(w, rows, bounds)["logit"], y)])
    found = quality._gradients(w, rows, bounds, y)
    for name, g in found.items():
        flat, at = w[name].reshape(-1), int(np.argmax(np.abs(g)))
        flat[at] += 1e-5
        high = loss()
        flat[at] -= 2e-5
        low = loss()
        flat[at] += 1e-5
        assert np.isclose((high - low) / 2e-5, g.reshape(-1)[at], rtol=1e-3, atol=1e-8)


def distance(a, b):
    """Edits, two neighbouring letters swapped being one."""
    d = [[max(i, j) for j in range(len(b) + 1)] for i in range(len(a) + 1)]
    for i in range(1, len(a) + 1):
        for j in range(1, len(b) + 1):
            d[i][j] = min(d[i - 1][j] + 1, d[i][j - 1] + 1, d[i - 1][j - 1] + (a[i - 1] != b[j - 1]))
            if i > 1 and j > 1 and a[i - 1] == b[j - 2] and a[i - 2] == b[j - 1]:
                d[i][j] = min(d[i][j], d[i - 2][j - 2] + 1)
    return d[-1][-1]


def started(word, term, allowed):
    """Whether the word starts with the term misspelled, its last letter being right or swapped."""
    for n in range(1, len(word) + 1):
        spent = [distance(word[: n - 1], term[:-1])] if word[n - 1] == term[-1] else []
        if n > 1 and word[n - 1] == term[-2] and word[n - 2] == term[-1]:
            spent.append(distance(word[: n - 2], term[:-2]) + 1)
        if any(s <= allowed for s in spent):
            return True
    return False


@pytest.mark.parametrize("most", [300_000, 40])
def test_automaton_equals_plain_edit_distance(most):
    rng = random.Random(1)
    terms = ["abc", "abcab", "bbbbb", "cabcabc", "abcabcabc", "aacca"]
    automaton = toxicity.Automaton(terms, most)
    allowed = {t: (len(t) >= toxicity.ONE_EDIT) + (len(t) >= toxicity.TWO_EDITS) for t in terms}
    seen = set()
    for _ in range(4000):
        word = "".join(rng.choice("abc") for _ in range(rng.randint(1, 16)))
        edits = [e for t in terms if (e := distance(word, t)) <= allowed[t]]
        expected = 0 if any(word.startswith(t) for t in terms) else min(edits, default=-1)
        if expected < 0 and any(started(word, t, allowed[t]) for t in terms if allowed[t]):
            expected = toxicity.STARTS
        seen.add(expected)
        assert automaton.edits(word) == expected, word
    assert seen == {-1, 0, 1, 2, toxicity.STARTS}


def test_misspelled_inflections_and_swapped_letters():
    automaton = toxicity.Automaton(["idiot", "moron"])
    for word in "idoit idi0ts id1ots idoits m0r0n m0rons idoitically-long"[:-5].split():
        assert automaton.edits(word) > 0, word
    assert automaton.edits("idoits") == toxicity.STARTS == automaton.edits("idoitsandmanymoreletters")
    for word in ("idiosyncratic", "maroon", "10107", "idea", "mor"):
        assert automaton.edits(word) == -1, word
    row = toxicity.features("idoits, 'idoits' and \"idoits\"", automaton)
    assert row[1:8] == [0.0] * 7 and row[8:] == [np.log1p(2), np.log1p(1)]


def test_quotes_of_a_long_line_equal_a_plain_look():
    def plain(text, start, end):
        before, after = text[:start].rsplit("\n", 1)[-1], text[end:].split("\n", 1)[0]
        return any(
            c in after and (before.count(o) % 2 == 1 if o == c else before.rfind(o) > before.rfind(c)) for o, c in toxicity.QUOTES.items()
        )

    rng = random.Random(5)
    for _ in range(300):
        text = "".join(rng.choice('ab  "“”„«»‹›\n') for _ in range(rng.randint(1, 60)))
        spans = [m.span() for m in toxicity.WORD.finditer(text)]
        assert list(toxicity.quoted(text, spans)) == [plain(text, *s) for s in spans], text


def test_context_of_hits():
    automaton = toxicity.Automaton(["idiot"])
    plain = toxicity.features("you idiot, you IDIOTS and idi0t", automaton)
    quoted = toxicity.features('they said "you idiot" to me', automaton)
    assert plain[1] > 0 and plain[2] == 0 and plain[3] > 0 and plain[6] > quoted[6]
    assert quoted[1] == 0 and quoted[2] > 0
    assert toxicity.features("«idiot»\nidiot", automaton)[1:3] == [np.log1p(1)] * 2


CASES = [None, "", " \n", "x", "éÉ😀", "word " * 30_000, "same text", "same text"]


@pytest.mark.parametrize("module,label", [(quality, "quality"), (toxicity, "toxic")])
def test_edge_cases(spark, module, label):
    docs = spark.createDataFrame([(i, t, "k", 0.5) for i, t in enumerate(CASES)], "doc_id long, text string, label string, score double")
    labels = spark.createDataFrame([(i, 1, 1) for i in range(8)], "doc_id long, quality int, toxic int")
    for known in (labels, labels.where("false")):
        rows = {r["doc_id"]: r["score"] for r in module.report(docs, known).collect()}
        assert len(rows) == 8 and all(0 <= s <= 1 for s in rows.values()) and rows[6] == rows[7]
    mixed = labels.union(spark.createDataFrame([(i, i % 2, i % 2) for i in (0, 2, 3, 5)] + [(None, 0, 0), (4, None, None)], labels.schema))
    rows = {r["doc_id"]: r["score"] for r in module.report(docs, mixed).collect()}
    assert rows[0] == rows[1] and rows[6] == rows[7]
    assert module.report(docs.where("false"), labels).count() == 0


def test_a_kept_text_goes_to_the_worker_once(spark):
    rows = [(i, f"A text of {i} words, " * (i % 7)) for i in range(300)] + [(None, None)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    model = quality.fit([quality.features(t) for _, t in rows[:20]], np.arange(20) % 2)
    found = quality.scored(docs, model)
    assert "__text" not in found._jdf.queryExecution().analyzed().toString()
    other = quality.scored(docs.select("doc_id", F.col("text").alias("score")), model, text="score")  # not kept
    want = sorted((r["doc_id"] or -1, r["score"]) for r in found.collect())
    assert want == sorted((r["doc_id"] or -1, r["score"]) for r in other.collect()) and len(want) == len(rows)

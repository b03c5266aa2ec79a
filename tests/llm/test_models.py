"""Language and toxicity models against plain Python, and their samples against hot rows."""

import math
import tracemalloc
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from quotepanel.llm import bpe, langid, neardup, toxicity
from quotepanel.llm.letters import gram_keys
from quotepanel.llm.textbytes import slices
from tests.llm.conftest import prose


def folded(text, lead):
    out = "".join((c.lower() if len(c.lower()) == 1 else c) if c.isalpha() else " " for c in text or "")
    return " " * lead + " ".join(out.split()) + " "


TALK = {
    "aa": ["the cat sat on the mat", "a dog and a cat ran", "mats & hats; cats", "the end of the day", "no más que un día"],
    "bb": ["der hund und die katze", "ein tag im märz", "katzen, hunde", "und noch ein tag", "straße frei"],
    "cc": ["le chat est là", "un jour de mai", "chats et chiens", "ça va bien là"],
}


class PlainKneserNey:
    def __init__(self, rows, order):
        self.order, self.counts = order, {}
        for lang in {lang for _, lang in rows}:
            top = Counter()
            for text in [t for t, own in rows if own == lang]:
                code = folded(text, order - 1)
                top.update(code[i - order + 1 : i + 1] for i in range(order - 1, len(code)))
            by_order = {order: top}
            for m in range(order, 1, -1):
                by_order[m - 1] = Counter(gram[1:] for gram in by_order[m])
            self.counts[lang] = by_order
        self.letters = len({g for by_order in self.counts.values() for g in by_order[1]}) + 1

    def discount(self, lang, m):
        values = list(self.counts[lang][m].values())
        once, twice = values.count(1), values.count(2)
        return min(max(once / (once + 2 * twice), 0.1), 0.9) if once else 0.1

    def p(self, lang, gram):
        m, counts = len(gram), self.counts[lang][len(gram)]
        d = self.discount(lang, m)
        if m == 1:
            total = sum(counts.values())
            return max(counts[gram] - d, 0) / total + d * len(counts) / total / self.letters
        inside = {g: n for g, n in counts.items() if g[:-1] == gram[:-1]}
        below = self.p(lang, gram[1:])
        if not inside:
            return below
        total = sum(inside.values())
        return max(counts[gram] - d, 0) / total + d * len(inside) / total * below

    def cross_entropy(self, lang, text):
        code, order = folded(text, self.order - 1), self.order
        grams = [code[i - order + 1 : i + 1] for i in range(order - 1, len(code))]
        return -sum(math.log(self.p(lang, g)) for g in grams) / len(grams)


def test_language_models_against_plain_kneser_ney(spark):
    rows = [(text, lang) for lang, texts in TALK.items() for text in texts]
    frame = spark.createDataFrame(rows, "text string, lang string")
    counted = frame.mapInArrow(langid._count, "lang string, gram string, n long").groupBy("lang", "gram").agg(F.sum("n").alias("n"))
    model = langid.fit(counted.toPandas())
    plain = PlainKneserNey(rows, langid.ORDER)
    asked = ["the cat and the dog", "ein hund im märz", "le jour", "ΑΒΓ xyz", "mats", "là"]
    for part in slices(pa.array(asked)):
        got, _ = model.cross_entropy(part)
        for i, text in enumerate(asked):
            for k, lang in enumerate(model.languages):
                assert got[i, k] == pytest.approx(plain.cross_entropy(lang, text), rel=1e-4)
    best = {r["text"]: r["lang_pred"] for r in langid.predicted(spark.createDataFrame([(t, t) for t in asked], "doc_id string, text string").withColumnRenamed("doc_id", "asked"), model).collect() for r in [{"text": r["asked"], **r.asDict()}]}
    for text in asked[:3]:
        assert best[text] == min(model.languages, key=lambda lang: plain.cross_entropy(lang, text))


def grams(text):
    code = folded(text, 1)
    return {code[i : i + n] for n in toxicity.ORDERS for i in range(len(code) - n + 1)}


def slot(gram):
    codes = np.array([ord(c) for c in gram], np.uint64)
    return int(gram_keys(codes, len(gram))[0] >> np.uint64(64 - toxicity.SLOT_BITS))


def labelled(n=60):
    return [(i, prose(i, 15) + (" you nasty rotten fool" if i % 3 == 0 else " how very kind"), int(i % 3 == 0)) for i in range(n)]


def test_toxicity_features_against_plain_counts(spark):
    rows = labelled()
    held = [{slot(g) for g in grams(text)} for _, text, _ in rows]
    yes, no = Counter(), Counter()
    for slots, (_, _, toxic) in zip(held, rows, strict=True):
        (yes if toxic else no).update(slots)
    n_yes, n_no = sum(t for *_, t in rows), sum(1 - t for *_, t in rows)
    expected = {}
    for s in yes.keys() | no.keys():
        a, b, n = yes[s], no[s], n_yes + n_no
        total = a + b
        if total < toxicity.LEAST_DOCS or total == n:
            continue
        chi2 = n * (a * (n_no - b) - b * (n_yes - a)) ** 2 / (n_yes * n_no * total * (n - total))
        if chi2 > toxicity.CHI2:
            expected[s] = math.log((a + 1) / (n_yes + 2)) - math.log((b + 1) / (n_no + 2))
    frame = spark.createDataFrame([(t, bool(y)) for _, t, y in rows], "text string, toxic boolean")
    counts = frame.mapInArrow(toxicity._counts, "chunk int, slots binary, toxic binary, other binary")
    found = counts.groupBy("chunk").applyInPandas(toxicity._chosen(n_yes, n_no), "slot long, ratio double").collect()
    assert expected and {r["slot"]: pytest.approx(r["ratio"]) for r in found} == expected


def label_batch(rows):
    return pa.RecordBatch.from_arrays([pa.array([t for t, _ in rows]), pa.array([y for _, y in rows])], names=["text", "toxic"])


def test_toxicity_counts_meet_within_a_task(monkeypatch):
    rows = [*[(text, bool(y)) for _, text, y in labelled()], ("", True), (None, False), ("a" * 3000, True)]
    monkeypatch.setattr(toxicity, "slices", lambda column, limit=700: slices(column, limit))
    yes, no = Counter(), Counter()
    for text, toxic in rows:
        (yes if toxic else no).update({slot(g) for g in grams(text)})
    batches = iter([label_batch(rows[:25]), label_batch([]), label_batch(rows[25:])])
    out = [row for found in toxicity._counts(batches) for row in found.to_pylist()]
    assert len({r["chunk"] for r in out}) == len(out)
    found = [[x for r in out for x in np.frombuffer(r[c], np.int32).tolist()] for c in ("slots", "toxic", "other")]
    assert sorted(zip(*found, strict=True)) == sorted((s, yes[s], no[s]) for s in yes.keys() | no.keys())
    assert list(toxicity._counts(iter([]))) == []


def test_toxicity_counts_hold_little_memory():
    batch = label_batch([(prose(i % 50, 700), i % 2 == 0) for i in range(1000)])
    assert batch.nbytes > 4_000_000
    tracemalloc.start()
    try:
        for _ in toxicity._counts(iter([batch])):
            pass
        peak = tracemalloc.get_traced_memory()[1]
    finally:
        tracemalloc.stop()
    assert peak < 250_000_000


def test_toxicity_steps_against_a_plain_loop(monkeypatch):
    monkeypatch.setattr(toxicity, "STEPS", 4)
    rows = [np.array([0, 2]), np.array([1]), np.array([], int), np.array([0, 1, 2])]
    toxic, ratio, prior = np.array([True, False, False, True]), np.array([0.5, -1.0, 2.0]), 0.2
    got, bias = toxicity.fit(rows, toxic, ratio, prior)
    w, b = [0.0] * 3, math.log(prior / (1 - prior))
    m, v = [0.0] * 4, [0.0] * 4
    for step in range(1, 5):
        g = [toxicity.PENALTY * x for x in w] + [0.0]
        for own, y in zip(rows, toxic, strict=True):
            z = b + sum(w[i] * ratio[i] for i in own)
            error = (prior / 0.5 if y else (1 - prior) / 0.5) * (1 / (1 + math.exp(-z)) - y) / len(rows)
            for i in own:
                g[i] += error * ratio[i]
            g[3] += error
        for i in range(4):
            m[i], v[i] = 0.9 * m[i] + 0.1 * g[i], 0.999 * v[i] + 0.001 * g[i] ** 2
            move = 0.05 * (m[i] / (1 - 0.9**step)) / (math.sqrt(v[i] / (1 - 0.999**step)) + 1e-9)
            if i < 3:
                w[i] -= move
            else:
                b -= move
    assert got == pytest.approx([x * r for x, r in zip(w, ratio, strict=True)]) and bias == pytest.approx(b)


def caught(monkeypatch, module, name):
    """Rows of the sample that a model is fitted on."""
    seen, own = [], getattr(module, name)
    monkeypatch.setattr(module, name, lambda *args: seen.append(args) or own(*args))
    return seen


def test_language_sample_is_bounded_whatever_the_ids(spark, monkeypatch):
    rows = [(None, prose(i, 30), "en") for i in range(400)] + [(None, prose(3, 30), "en")] * 400
    frame = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    seen = caught(monkeypatch, langid, "fit")
    langid.learn(frame, 20)
    places = seen[0][0]["n"].sum()
    one = len(folded(prose(3, 30), langid.ORDER - 1)) - langid.ORDER + 1
    assert places < 60 * one


def test_toxicity_sample_is_bounded_for_a_repeated_id(spark, monkeypatch):
    rows = [(1, prose(i, 20)) for i in range(600)] + [(1, prose(5, 20))] * 300 + [(i, prose(i, 20)) for i in range(10, 60)]
    labels = [(1, 1), *[(i, i % 2) for i in range(10, 60)]]
    seen = caught(monkeypatch, toxicity, "fit")
    monkeypatch.setattr(toxicity, "CHI2", 0.0)
    toxicity.learn(spark.createDataFrame(rows, "doc_id long, text string"), spark.createDataFrame(labels, "doc_id long, toxic int"), 20)
    assert not seen or len(seen[0][0]) < 200


def test_bpe_remembers_so_many_bytes(monkeypatch):
    monkeypatch.setattr(bpe, "REMEMBERED", 4000)
    tokens = [bytes([b]) for b in range(256)] + [b"ab", b"abc"]
    own = bpe.Merges(tokens, r"\S+|\s+")
    for i in range(50):
        text = prose(i, 20) + " abcabc " + "x" * 3000
        ids = own.encode([text])[0]
        assert own.decode(ids) == text.encode()
        assert sum(len(k) + len(v) for k, v in own.known.items()) < 8000
        assert not any(len(k) > bpe.MANY for k in own.known)


def test_very_long_and_very_short_vectors_link(spark):
    rows = [(1, [1e-200, 2e-200]), (2, [2e-200, 4e-200]), (3, [1e200, 2e200]), (4, [1e200, -2e200]), (5, [0.0, 0.0]), (6, [1.0, float("inf")]), (7, [1e308, 1.9e308 / 2]), (8, [5e-324, 1e-323])]
    found = {r["vec_id"]: r for r in neardup.near_duplicates(spark.createDataFrame(rows, "vec_id long, embedding array<double>")).collect()}
    near = {i: {j for j, w in rows if j != i and i not in (5, 6) and j not in (5, 6) and cosine(dict(rows)[i], w) >= 0.9} for i, _ in rows}
    assert {i: r["n_links"] for i, r in found.items()} == {i: len(js) for i, js in near.items()}
    assert found[2]["component_id"] == found[3]["component_id"] == 1 and found[4]["component_id"] == 4


def cosine(a, b):
    a, b = ([x / max(map(abs, v)) for x in v] for v in (a, b))
    return sum(x * y for x, y in zip(a, b, strict=True)) / math.sqrt(sum(x * x for x in a) * sum(x * x for x in b))

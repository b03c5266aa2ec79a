"""Operator 9, language ID by interpolated Kneser-Ney character models.

Per language a model of order ``ORDER`` over folded letters (other characters
are one space). The highest order counts n-grams, the lower ones the distinct
letters to the left; each order has its own discount. Of every n-gram seen in
any language the interpolated log probability in each language stands in an
array sorted by the n-gram's hash, and so do the back-off weights of contexts;
scoring looks places up by binary search and goes to the next lower order only
where no language knows the n-gram. The language with the lowest cross-entropy
per letter wins (ties: first by name).

A model is fitted on a bounded sample: of the labelled documents that are not
held out, about ``DOCS_PER_LANGUAGE`` distinct texts of each language by a hash
of the text, and about ``BYTES_PER_LANGUAGE`` of them at most.
One in four of them only calibrates: the 99.5 % quantile of the cross-entropy
under their own language is the bound above which a prediction is rejected. A
language of which no text with a letter would remain is fitted on all its
sampled documents and has no bound.

Defined cases: null texts and texts without a letter are ``und`` with score 0;
so is every text if no language was learned. Null languages are not learned;
copies of a text count once in the sample, whatever their ids. An empty table
gives an empty one, very long texts are scored whole, and columns called like
the new ones, in any case, give way.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from quotepanel.llm.common import held_out, passed
from quotepanel.llm.letters import SPACE, gram_keys, gram_keys_at, letters
from quotepanel.llm.textbytes import Texts, slices

ORDER = 4
DOCS_PER_LANGUAGE = 4000
BYTES_PER_LANGUAGE = 64 << 20
CALIBRATION = 0.995


@dataclass
class Model:
    languages: list[str]
    keys: list[np.ndarray]  # by order from 1
    logp: list[np.ndarray]
    context: list[np.ndarray]  # by order from 2: contexts and their log back-off weights
    backoff: list[np.ndarray]
    unknown: np.ndarray  # log probability of a letter never seen
    bound: np.ndarray

    def place_scores(self, codes: np.ndarray) -> np.ndarray:
        """Log probability in each language of every code from place ORDER - 1 on."""
        n = len(codes) - ORDER + 1
        out = np.zeros((n, len(self.languages)), np.float32)
        open_ = np.arange(n)
        for order in range(ORDER, 0, -1):
            keys = gram_keys(codes, order) if order == ORDER else gram_keys_at(codes, open_ + ORDER - order, order)
            table = self.keys[order - 1]
            at = np.minimum(np.searchsorted(table, keys), len(table) - 1)
            found = table[at] == keys
            out[open_[found]] += self.logp[order - 1][at[found]]
            open_ = open_[~found]
            if not len(open_):
                break
            if order == 1:
                out[open_] += self.unknown
                break
            context = gram_keys_at(codes, open_ + ORDER - order, order - 1)
            table = self.context[order - 2]
            at = np.minimum(np.searchsorted(table, context), len(table) - 1)
            found = table[at] == context
            out[open_[found]] += self.backoff[order - 2][at[found]]
        return out

    def cross_entropy(self, texts: Texts) -> tuple[np.ndarray, np.ndarray]:
        """Nats per letter of each text in each language, and its number of letters."""
        codes, first = letters(texts, ORDER - 1)
        scores = self.place_scores(codes).astype(np.float64)
        total = np.concatenate([np.zeros((1, scores.shape[1])), np.cumsum(scores, axis=0)])
        a, b = first[:-1], first[1:] - ORDER + 1
        n = b - a
        n_letters = np.concatenate([[0], np.cumsum(codes != SPACE)])
        return -(total[b] - total[a]) / n[:, None], n_letters[first[1:]] - n_letters[first[:-1]]


def _count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(lang, gram, n) of the highest order, summed per slice."""
    for batch in batches:
        langs = batch.column(1).to_pylist()
        for part in slices(batch.column(0), 4 << 20):
            codes, first = letters(part, ORDER - 1)
            own = np.array(langs[part.first : part.first + len(part)], object)
            names, number = np.unique(own, return_inverse=True)
            for k, name in enumerate(names):
                inside = np.repeat(number == k, np.diff(first) - ORDER + 1)
                at = (np.arange(len(inside)) + np.repeat(np.arange(len(part)) * (ORDER - 1), np.diff(first) - ORDER + 1))[inside]
                keys = gram_keys(codes, ORDER)[at]
                _, one, n = np.unique(keys, return_index=True, return_counts=True)
                chars = codes[at[one][:, None] + np.arange(ORDER)].astype("<u4")
                raw = chars.tobytes().decode("utf-32-le")
                grams = [raw[i : i + ORDER] for i in range(0, len(raw), ORDER)]
                yield pa.RecordBatch.from_arrays([pa.array([name] * len(grams)), pa.array(grams), pa.array(n)], names=["lang", "gram", "n"])


def _discount(n: np.ndarray) -> float:
    once, twice = int((n == 1).sum()), int((n == 2).sum())
    return min(max(once / (once + 2 * twice), 0.1), 0.9) if once else 0.1


def fit(grams: pd.DataFrame) -> Model:
    """Model from counted n-grams (lang, gram, n)."""
    languages = sorted(grams["lang"].unique())
    codes = np.frombuffer("".join(grams["gram"]).encode("utf-32-le"), np.uint32).astype(np.uint64).reshape(-1, ORDER)
    lang = np.searchsorted(languages, grams["lang"])
    count = grams["n"].to_numpy()

    def hashes(c: np.ndarray) -> np.ndarray:
        m = c.shape[1]
        return gram_keys(c.ravel(), m)[::m] if len(c) else np.zeros(0, np.uint64)

    counted = [None] * ORDER  # by order: (lang, codes, n) with the counts of that order
    counted[ORDER - 1] = (lang, codes, count)
    for m in range(ORDER - 1, 0, -1):
        own, c, _ = counted[m]
        frame = pd.DataFrame({"lang": own, "key": hashes(c[:, 1:]), "at": np.arange(len(own))})
        grouped = frame.groupby(["lang", "key"], sort=False)["at"].agg(["first", "size"])
        at = grouped["first"].to_numpy()
        counted[m - 1] = (own[at], c[at, 1:], grouped["size"].to_numpy())
    keys, logp, contexts, backoffs = [], [], [], []
    n_lang = len(languages)
    letters_seen = len(np.unique(counted[0][1])) + 1
    lower_keys, lower_p = np.zeros(0, np.uint64), np.zeros((0, n_lang))
    unknown = np.zeros(n_lang)
    for m in range(1, ORDER + 1):
        own, c, n = counted[m - 1]
        discount = np.array([_discount(n[own == k]) for k in range(n_lang)])
        table, row = np.unique(hashes(c), return_inverse=True)
        one = np.zeros(len(table), np.int64)
        one[row] = np.arange(len(row))
        seen = np.zeros((len(table), n_lang))
        seen[row, own] = n
        held = np.maximum(seen - discount, 0)
        if m == 1:
            total = np.bincount(own, n, n_lang)
            types = np.bincount(own, minlength=n_lang)
            p = held / total + discount * types / total / letters_seen
            unknown = np.log(discount * types / total / letters_seen)
        else:
            context, of = np.unique(hashes(c[:, :-1]), return_inverse=True)
            total, types = np.zeros((len(context), n_lang)), np.zeros((len(context), n_lang))
            np.add.at(total, (of, own), n)
            np.add.at(types, (of, own), 1)
            gamma = np.where(total > 0, discount * types / np.maximum(total, 1), 1.0)
            at = of[one]
            below = lower_p[np.searchsorted(lower_keys, hashes(c[one, 1:]))]
            p = held / np.maximum(total[at], 1) + gamma[at] * below
            contexts.append(context)
            backoffs.append(np.log(gamma).astype(np.float32))
        keys.append(table)
        logp.append(np.log(p).astype(np.float32))
        lower_keys, lower_p = table, p
    return Model(languages, keys, logp, contexts, backoffs, unknown.astype(np.float32), np.full(n_lang, np.inf))


def learn(documents: DataFrame, docs_per_language: int = DOCS_PER_LANGUAGE) -> Model | None:
    """The model of ``documents`` (doc_id, text, lang); None without labelled texts."""
    labelled = documents.filter(~held_out() & F.col("lang").isNotNull() & F.col("text").isNotNull()).select("text", "lang")
    place = F.pmod(F.xxhash64(F.col("text"), F.lit("language sample")), F.lit(1 << 20)) / (1 << 20)
    calibrates = F.pmod(F.xxhash64(F.col("text"), F.lit("calibration")), F.lit(4)) == 0
    fits = F.when(~calibrates & F.col("text").rlike(r"\p{L}"), place)
    # One row per language.
    sizes = labelled.groupBy("lang").agg(
        F.count(F.lit(1)).alias("n"), F.sum(F.octet_length("text")).alias("bytes"), F.min(place).alias("first"), F.min(fits).alias("first_fits")
    ).collect()
    if not sizes:
        return None
    shares = {}
    for r in sizes:
        share = min(docs_per_language / r["n"], BYTES_PER_LANGUAGE / max(r["bytes"], 1))
        shares[r["lang"]] = max(share, r["first"] + 1 / (1 << 20))
    share = F.create_map(*[x for lang, part in shares.items() for x in (F.lit(lang), F.lit(part))])
    # Copies share a place; they meet before they leave their tasks.
    sample = labelled.filter(place < F.element_at(share, F.col("lang"))).distinct()
    unfitted = [r["lang"] for r in sizes if r["first_fits"] is None or r["first_fits"] >= shares[r["lang"]]]
    calibrates = calibrates & ~F.col("lang").isin(unfitted)
    counted = sample.filter(~calibrates).select("text", "lang").mapInArrow(_count, "lang string, gram string, n long")
    grams = counted.groupBy("lang", "gram").agg(F.sum("n").alias("n")).toPandas()  # of a bounded sample
    if grams.empty:
        return None
    model = fit(grams)
    own = F.element_at(F.create_map(*[x for i, lang in enumerate(model.languages) for x in (F.lit(lang), F.lit(i))]), F.col("lang"))
    scored = predicted(sample.filter(calibrates), model).filter(own.isNotNull() & (F.col("lang_pred") == F.col("lang")))
    bounds = scored.groupBy("lang").agg(F.percentile_approx("cross_entropy", CALIBRATION, 1000).alias("bound")).collect()
    for r in bounds:
        model.bound[model.languages.index(r["lang"])] = r["bound"]
    return model


def predicted(documents: DataFrame, model: Model | None, text: str = "text") -> DataFrame:
    """Every row of ``documents`` but its text, with lang_pred, score, cross_entropy and rejected.

    ``score`` is the posterior of the language with the log likelihood
    flattened to the root of the number of places. Columns of these names give way.
    """
    new = ("lang_pred", "score", "cross_entropy", "rejected")
    keep = passed(documents.columns, text, *new)
    rows = documents.select(*[f"`{c}`" for c in keep], f"`{text}`")
    shared = documents.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = shared.value
        for batch in batches:
            for part in slices(batch.column(len(keep))):
                n = len(part)
                best, score, least, rejected = np.full(n, "und", object), np.zeros(n), np.full(n, np.nan), np.ones(n, bool)
                if own is not None:
                    ce, n_letters = own.cross_entropy(part)
                    at = ce.argmin(axis=1)
                    some = n_letters > 0
                    weight = np.sqrt(np.diff(part.offsets).clip(1))
                    odds = np.exp(-(ce - ce.min(axis=1, keepdims=True)) * weight[:, None])
                    best[some] = np.array(own.languages, object)[at[some]]
                    least[some] = ce.min(axis=1)[some]
                    score[some] = 1 / odds.sum(axis=1)[some]
                    rejected = ~some | (least > own.bound[at])
                columns = [batch.column(i).slice(part.first, n) for i in range(len(keep))]
                arrays = [pa.array(best, pa.string()), pa.array(score), pa.array(least, from_pandas=True), pa.array(rejected)]
                yield pa.RecordBatch.from_arrays([*columns, *arrays], names=[*keep, *new])

    schema = rows.drop(text).schema.add("lang_pred", "string").add("score", "double").add("cross_entropy", "double").add("rejected", "boolean")
    return rows.mapInArrow(run, schema)

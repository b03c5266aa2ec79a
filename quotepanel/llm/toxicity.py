"""Operator 7, toxicity by a linear classifier on NB-scaled character n-grams.

A text's features are its distinct n-grams of folded letters (``ORDERS``),
hashed to ``SLOTS`` slots. Per slot the naive Bayes log-count ratio compares
the smoothed shares of toxic and other documents that hold it; slots whose
ratio is significant (chi-square over ``CHI2``) are features with the ratio
as value. A logistic regression with an L2 penalty weighs them, and the share
of toxic labels sets its prior.

It is fitted on a bounded sample: about ``PER_CLASS`` distinct texts of labelled
documents of either class and at most about ``SAMPLE_BYTES`` of them, by hashes
of the id and of the text, none of them held out. Scores never use labels,
lang, source or doc_id.

Defined cases: null and empty texts have no features and score the prior;
without labels of both classes every score is the share of toxic labels (0 if
there are none). Repeated labels of a document count once, as toxic if any
says so; null labels are not learned. An empty table gives an empty one, very
long texts are scored whole, and a column called ``score`` in any case gives way.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from quotepanel.llm.common import held_out, passed
from quotepanel.llm.letters import gram_keys, letters
from quotepanel.llm.textbytes import Texts, slices

ORDERS = (4, 5, 6)
SLOT_BITS = 22
SLOTS = 1 << SLOT_BITS
CHUNK_BITS = 16
PER_CLASS = 4000
SAMPLE_BYTES = 256 << 20
#: Under a one in a million chance for a slot that tells nothing, times as many slots.
CHI2 = 30.0
LEAST_DOCS = 5
PENALTY = 1e-3
STEPS = 400


@dataclass
class Model:
    slots: np.ndarray  # ascending
    weights: np.ndarray
    prior: float  # log odds


def features(texts: Texts, feature_of: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray]:
    """Distinct (text, slot) pairs; with ``feature_of`` only its features, as their numbers."""
    codes, first = letters(texts, 1)
    owner = np.repeat(np.arange(len(texts)), np.diff(first))
    found = []
    for n in ORDERS:
        slot = (gram_keys(codes, n) >> np.uint64(64 - SLOT_BITS)).astype(np.int64)
        if feature_of is not None:
            slot = feature_of[slot]
        at = np.flatnonzero((owner[: len(slot)] == owner[n - 1 :]) & (slot >= 0))
        found.append((owner[at] << SLOT_BITS) | slot[at])
    pairs = np.concatenate(found)
    del found, codes, owner
    # Sorted in place: np.unique may build a hash table of several times the pairs.
    pairs.sort()
    new = np.ones(len(pairs), bool)
    np.not_equal(pairs[1:], pairs[:-1], out=new[1:])
    pairs = pairs[new]
    return pairs >> SLOT_BITS, pairs & (SLOTS - 1)


def _counts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(chunk, slots, toxic, other): per task and chunk of slots, documents that hold each slot.

    Slices are added up in two arrays, so that a task holds these and the pairs
    of one slice, which take about a hundred times its bytes.
    """
    yes, no = np.zeros(SLOTS, np.int32), np.zeros(SLOTS, np.int32)
    for batch in batches:
        label = np.array(batch.column(1).to_pylist(), bool)
        for part in slices(batch.column(0)):
            text, slot = features(part)
            toxic = label[part.first + text]
            np.add.at(yes, slot[toxic], 1)
            np.add.at(no, slot[~toxic], 1)
    for chunk in range(SLOTS >> CHUNK_BITS):
        own = slice(chunk << CHUNK_BITS, (chunk + 1) << CHUNK_BITS)
        at = np.flatnonzero(yes[own] | no[own])
        if len(at):
            columns = [x.tobytes() for x in ((at + own.start).astype(np.int32), yes[own][at], no[own][at])]
            yield pa.RecordBatch.from_arrays(
                [pa.array([chunk], pa.int32()), *[pa.array([x], pa.binary()) for x in columns]], names=["chunk", "slots", "toxic", "other"]
            )


def _chosen(n_toxic: int, n_other: int):
    def run(rows: pd.DataFrame) -> pd.DataFrame:
        """Significant slots of a chunk with their log-count ratios."""
        base = int(rows["chunk"].iloc[0]) << CHUNK_BITS
        yes, no = np.zeros(1 << CHUNK_BITS), np.zeros(1 << CHUNK_BITS)
        for slots, toxic, other in zip(rows["slots"], rows["toxic"], rows["other"], strict=True):
            at = np.frombuffer(slots, np.int32) - base
            yes[at] += np.frombuffer(toxic, np.int32)
            no[at] += np.frombuffer(other, np.int32)
        n, total = n_toxic + n_other, yes + no
        with np.errstate(divide="ignore", invalid="ignore"):
            chi2 = n * (yes * (n_other - no) - no * (n_toxic - yes)) ** 2 / (n_toxic * n_other * total * (n - total))
        at = np.flatnonzero((chi2 > CHI2) & (total >= LEAST_DOCS))
        ratio = np.log((yes[at] + 1) / (n_toxic + 2)) - np.log((no[at] + 1) / (n_other + 2))
        return pd.DataFrame({"slot": base + at, "ratio": ratio})

    return run


def _held(slots):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = feature_table(slots.value)
        for batch in batches:
            label = batch.column(1)
            for part in slices(batch.column(0)):
                text, feature = features(part, table)
                first = np.searchsorted(text, np.arange(len(part) + 1))
                raw = [feature[first[i] : first[i + 1]].astype(np.int32).tobytes() for i in range(len(part))]
                yield pa.RecordBatch.from_arrays([label.slice(part.first, len(part)), pa.array(raw, pa.binary())], names=["toxic", "features"])

    return run


def feature_table(slots: np.ndarray) -> np.ndarray:
    table = np.full(SLOTS, -1, np.int32)
    table[slots] = np.arange(len(slots), dtype=np.int32)
    return table


def fit(rows: list[np.ndarray], toxic: np.ndarray, ratio: np.ndarray, prior: float) -> tuple[np.ndarray, float]:
    """Weights of the scaled features and the log odds of a text without any, for a true share ``prior``."""
    text = np.repeat(np.arange(len(rows)), [len(r) for r in rows])
    feature = np.concatenate(rows) if rows else np.zeros(0, np.int64)
    y = toxic.astype(float)
    share = y.mean()
    weight = np.where(toxic, prior / share, (1 - prior) / (1 - share))
    w, b = np.zeros(len(ratio)), float(np.log(prior / (1 - prior)))
    m, v = np.zeros(len(ratio) + 1), np.zeros(len(ratio) + 1)
    for step in range(1, STEPS + 1):
        z = np.bincount(text, (w * ratio)[feature], len(rows)) + b
        error = weight * (1 / (1 + np.exp(-np.clip(z, -30, 30))) - y) / len(rows)
        g = np.append(np.bincount(feature, error[text], len(ratio)) * ratio + PENALTY * w, error.sum())
        m, v = 0.9 * m + 0.1 * g, 0.999 * v + 0.001 * g * g
        move = 0.05 * (m / (1 - 0.9**step)) / (np.sqrt(v / (1 - 0.999**step)) + 1e-9)
        w, b = w - move[:-1], b - float(move[-1])
    return w * ratio, b


def learn(documents: DataFrame, labels: DataFrame, per_class: int = PER_CLASS) -> Model:
    """The model from ``documents`` (doc_id, text) and ``labels`` (doc_id, toxic)."""
    known = (
        labels.filter(~held_out() & F.col("toxic").isNotNull() & F.col("doc_id").isNotNull())
        .groupBy(F.col("doc_id").alias("labelled"))
        .agg((F.max("toxic") == 1).alias("toxic"))
    )
    sizes = {r["toxic"]: r["n"] for r in known.groupBy("toxic").agg(F.count(F.lit(1)).alias("n")).collect()}
    if len(sizes) < 2:
        return Model(np.zeros(0, np.int64), np.zeros(0), 30.0 if True in sizes else -30.0)
    prior = sizes[True] / (sizes[True] + sizes[False])
    share = F.when(F.col("toxic"), per_class / sizes[True]).otherwise(per_class / sizes[False])
    place = F.pmod(F.xxhash64(F.col("labelled"), F.lit("toxicity sample")), F.lit(1 << 20)) / (1 << 20)
    ids = known.filter(place < share)  # about twice per_class rows, whatever the input
    found = documents.select("doc_id", "text").join(F.broadcast(ids), F.col("doc_id") == F.col("labelled"))
    # An id may repeat, a third of all rows may have one: then only some of its texts are taken, copies once.
    size = found.agg(F.count(F.lit(1)).alias("n"), F.coalesce(F.sum(F.octet_length("text")), F.lit(0)).alias("bytes")).first()
    part = min(1.0, 4 * per_class / max(size["n"], 1), SAMPLE_BYTES / max(size["bytes"], 1))
    by_text = F.pmod(F.xxhash64(F.col("text"), F.lit("toxicity texts")), F.lit(1 << 20)) / (1 << 20)
    sample = found.filter(by_text < part).select("text", "toxic").distinct()
    counts = sample.mapInArrow(_counts, "chunk int, slots binary, toxic binary, other binary")
    taken = {r["toxic"]: r["n"] for r in ids.groupBy("toxic").agg(F.count(F.lit(1)).alias("n")).collect()}
    if len(taken) < 2:
        return Model(np.zeros(0, np.int64), np.zeros(0), float(np.log(prior / (1 - prior))))
    chosen = counts.groupBy("chunk").applyInPandas(_chosen(taken[True], taken[False]), "slot long, ratio double").toPandas().sort_values("slot")
    slots, ratio = chosen["slot"].to_numpy(), chosen["ratio"].to_numpy()
    shared = documents.sparkSession.sparkContext.broadcast(slots)
    rows = sample.mapInArrow(_held(shared), "toxic boolean, features binary").toPandas()  # of a bounded sample
    if rows["toxic"].nunique() < 2:
        return Model(np.zeros(0, np.int64), np.zeros(0), float(np.log(prior / (1 - prior))))
    weights, b = fit([np.frombuffer(x, np.int32) for x in rows["features"]], rows["toxic"].to_numpy(bool), ratio, prior)
    return Model(slots, weights, b)


def scored(documents: DataFrame, model: Model, text: str = "text") -> DataFrame:
    """Every row of ``documents`` but its text, with ``score``."""
    keep = passed(documents.columns, text, "score")
    rows = documents.select(*[f"`{c}`" for c in keep], f"`{text}`")
    shared = documents.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = shared.value
        table = feature_table(own.slots)
        for batch in batches:
            for part in slices(batch.column(len(keep))):
                owner, feature = features(part, table)
                z = np.bincount(owner, own.weights[feature] if len(feature) else None, len(part)) + own.prior
                columns = [batch.column(i).slice(part.first, len(part)) for i in range(len(keep))]
                yield pa.RecordBatch.from_arrays([*columns, pa.array(1 / (1 + np.exp(-np.clip(z, -30, 30))))], names=[*keep, "score"])

    return rows.mapInArrow(run, rows.drop(text).schema.add("score", "double"))

"""Registered queries against their SQL, and held-out accuracy of the trained models."""

import sys
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from quotepanel.llm.entries import ORACLES, QUERIES
from quotepanel.llm.graph import components
from tests.compare import connect, difference


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_sql(spark, sf, name):
    assert difference(QUERIES[name](spark, sf), connect(sf), ORACLES[name]) is None


def test_language_accuracy(spark):
    sf = "/root/testdata/sf0.01"
    docs = spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "lang")
    rows = QUERIES["op9_language_id"](spark, sf).filter("held_out").join(docs, "doc_id")
    n, right = rows.agg(F.count(F.lit(1)), F.sum((F.col("lang") == F.col("lang_pred")).cast("int"))).first()
    assert n > 100 and right >= 0.97 * n


def test_toxicity_accuracy(spark):
    sf = "/root/testdata/sf0.1"
    labels = spark.read.parquet(f"{sf}/labels.parquet").select("doc_id", "toxic")
    rows = QUERIES["op7_toxicity"](spark, sf).filter("held_out").join(labels, "doc_id")
    counts = {(r["toxic"], r["predicted"]): r["count"] for r in rows.groupBy("toxic", "predicted").count().collect()}
    assert counts[1, 1] >= 0.85 * (counts[1, 1] + counts.get((1, 0), 0))
    assert counts.get((0, 1), 0) <= 0.01 * counts[0, 0]


def test_quality_of_labelled(spark):
    """Of the labelled documents that pass the base rules most poor ones are rejected and few good ones."""
    sf = "/root/testdata/sf0.01"
    labels = spark.read.parquet(f"{sf}/labels.parquet").select("doc_id", "quality")
    rows = QUERIES["op4_quality_rules"](spark, sf).filter("NOT base_failed").join(labels, "doc_id")
    counts = {(r["quality"], r["kept"]): r["count"] for r in rows.groupBy("quality", "kept").count().collect()}
    assert counts[0, False] >= 0.8 * (counts[0, False] + counts.get((0, True), 0))
    assert counts.get((1, False), 0) <= 0.01 * counts[1, True]


def test_components(spark):
    edges = [(i, i + 1) for i in range(1, 60)] + [(100, 101), (101, 102), (200, 100), (300, 300)] + [(500, i) for i in range(400, 450)]
    got = {r["node"]: r["root"] for r in components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert got == {**{i: 1 for i in range(1, 61)}, **{i: 100 for i in (100, 101, 102, 200)}, **{i: 400 for i in [500, *range(400, 450)]}}
    assert components(spark.createDataFrame([], "a long, b long")).count() == 0


def test_pipeline(spark, sf):
    sys.path.insert(0, str(Path(__file__).resolve().parents[2]))
    import corpus_pipeline

    docs = spark.read.parquet(f"{sf}/documents.parquet")
    names, sizes = docs.columns, [docs.count()]
    for _, stage in corpus_pipeline.STAGES[:-1]:
        docs = corpus_pipeline.stored(stage(spark, docs, sf), "stage")
        assert docs.columns == names
        sizes.append(docs.count())
    assert sizes[0] > sizes[1] > sizes[2] >= sizes[3] > 0
    last = corpus_pipeline.run(spark, sf)
    assert last.count() == sizes[4] and last.filter("NOT round_trip").count() == 0

"""Ball-tree search against plain scoring of every document."""

import math
import re
from collections import Counter

import numpy as np

from quotepanel.llm import lexical
from tests.llm.conftest import prose

TERM = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")


def terms(text):
    return TERM.findall("".join(c.lower() if "A" <= c <= "Z" else c for c in text or ""))


def plain(documents, items, top=20):
    docs = [(d, Counter(t), len(t)) for d, t in ((d, terms(t)) for d, t in documents)]
    n_docs = sum(1 for _, _, n in docs if n)
    n_words = sum(n for _, _, n in docs)
    df = Counter(term for _, tf, _ in docs for term in tf)
    out = []
    for item, text in items:
        asked = Counter(terms(text))
        scores = []
        for doc, tf, n in docs:
            m = 75 + 25 * n * n_docs // n_words if n else 0
            score = sum(
                times * math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[t] + 1))) * (10**9 * tf[t] // (1000 * tf[t] + 12 * m))
                for t, times in asked.items()
                if t in tf
            )
            if score > 0:
                scores.append((-score, doc is None, doc or 0, doc))
        out += [(item, rank, s[3], -s[0]) for rank, s in enumerate(sorted(scores)[:top], 1)]
    return sorted(out, key=repr)


def result(documents, items, **more):
    return sorted((tuple(r) for r in lexical.ranked(documents, items, **more).select("item_id", "rank", "doc_id", "score").collect()), key=repr)


def pairs(frame, *names):
    return [tuple(r) for r in frame.select(*names).collect()]


def items_of(spark):
    rows = [(1, prose(1, 12)), (2, "FUCHS Word word, über-all 日本語 ΤΕΚΣΤ é"), (3, None), (4, ""), (5, "?!"), (6, "nowhere_to_be found"), (7, prose(5, 400)), (None, "two words"), (1, "two WORDS")]
    return spark.createDataFrame(rows, "item_id long, text string")


def test_hard_rows(spark, hard, clash):
    items = items_of(spark)
    expected = plain(pairs(hard, "doc_id", "text"), pairs(items, "item_id", "text"))
    assert expected and result(hard, items) == expected
    wide = items.selectExpr("*", "'x' AS doc_id", "'x' AS hashes", "'x' AS rank", "'x' AS n")
    assert result(clash.selectExpr("*", "'x' AS TERMS", "'x' AS tfs", "'x' AS item", "'x' AS item_id", "'x' AS score"), wide) == expected


def test_empty(spark, hard, empty):
    items = items_of(spark)
    assert result(empty, items) == [] and result(hard, items.limit(0)) == []


def many(spark, n=3000):
    """Documents of a few words, most scores shared by many of them."""
    return spark.createDataFrame([(i * 7 % n, prose(i % 600, 3 + i % 9)) for i in range(n)], "doc_id long, text string")


def test_ties_go_by_id(spark):
    documents, items = many(spark), spark.createDataFrame([(i, prose(i, 8)) for i in range(30)], "item_id long, text string")
    expected = plain(pairs(documents, "doc_id", "text"), pairs(items, "item_id", "text"))
    assert result(documents.repartition(5), items) == expected


def test_blocks_of_queries(spark):
    documents, items = many(spark, 400), spark.createDataFrame([(i, prose(i, 8)) for i in range(30)], "item_id long, text string")
    assert len(list(lexical.blocks(items, 40))) > 3
    assert result(documents, items, terms_at_once=40) == plain(pairs(documents, "doc_id", "text"), pairs(items, "item_id", "text"))


def test_small_trees(spark, hard, monkeypatch):
    """Trees of few entries, a document with more than a tree's share among them."""
    items = items_of(spark)
    monkeypatch.setattr(lexical, "ENTRIES", 50)
    assert result(hard, items) == plain(pairs(hard, "doc_id", "text"), pairs(items, "item_id", "text"))


def test_a_top_other_than_twenty(spark, hard):
    items = items_of(spark)
    assert result(hard, items, top=3) == plain(pairs(hard, "doc_id", "text"), pairs(items, "item_id", "text"), 3)


def sparse(seed, n, width):
    rng = np.random.default_rng(seed)
    sizes = rng.integers(0, 12, n)
    sizes[rng.integers(0, n)] = 0
    begin = np.concatenate([[0], np.cumsum(sizes)])
    column = np.concatenate([np.sort(rng.choice(width, s, replace=False)) for s in sizes]).astype(np.int64)
    return begin, column, rng.integers(1, 900_000, begin[-1]), rng


def test_no_document_exceeds_a_bound_above_it():
    for seed in range(6):
        begin, column, value, rng = sparse(seed, 300, 40)
        tree = lexical.grow(begin, column, value, 40, leaf=4, subspaces=(1, 7, 40)[seed % 3])
        dense = np.zeros((300, 40), np.int64)
        dense[np.repeat(np.arange(300), np.diff(begin)), column] = value
        for _ in range(20):
            asked = np.sort(rng.choice(40, 6, replace=False))
            weight = rng.integers(0, 12_000, 6)
            score = dense[:, asked] @ weight
            bound = lexical.bounds(tree, tree.rank[asked], weight)
            for low, high, most in zip(tree.low, tree.high, bound, strict=True):
                assert score[tree.order[low:high]].max() <= most
            rows, scores, _ = lexical.search(tree, asked, weight, np.arange(300), 1, 20)
            good = np.flatnonzero(score > 0)
            expected = good[np.lexsort((good, -score[good]))][:20]
            order = np.lexsort((rows, -scores))
            assert rows[order].tolist() == expected.tolist()


def test_subtrees_are_left_out():
    """Two far groups: a query of one does not open the other's leaves."""
    rng = np.random.default_rng(3)
    column = np.concatenate([np.sort(rng.choice(30, 6, replace=False)) + 30 * (i % 2) for i in range(400)]).astype(np.int64)
    begin = np.arange(0, 2401, 6)
    tree = lexical.grow(begin, column, rng.integers(400_000, 500_000, 2400), 60, leaf=10)
    _, _, opened = lexical.search(tree, np.array([1, 2, 3]), np.array([5, 5, 5]), np.arange(400), 1, 20)
    assert 0 < opened <= (len(tree.low) + 1) // 4


def test_partial_lists_are_cut_before_the_shuffle(spark):
    rows = spark.createDataFrame([(1, 1, 1, 5)], "item int, item_id long, doc_id long, score long")
    plan = lexical.best(rows, 20)._jdf.queryExecution().toString()
    assert "WindowGroupLimit" in plan

"""Operator 11, ranked lexical search on exact sparse ball trees.

A document is a sparse vector of integer term values, a query one of integer
term weights, and the score their inner product. Documents stay where they are:
each task builds ball trees over the vectors of its batches (at most ``DOCS``
documents and about ``ENTRIES`` entries each) and searches them for every query
of the block, best bound first.

A node has the centroid ``c`` of its vectors and a radius ``r`` around it in each of
``SUBSPACES`` groups of terms (neighbours by frequency), so that for every vector
``x`` below it ``q.x <= sum over groups of q.c + |q| r``. Radii are rounded up
before they are stored, bounds before they are compared, and a subtree is left
only if its bound is below a score that ``top`` documents have reached; at the
leaves scores are 64-bit integers. So nothing is missed, ties included.

The first search covers one document in ``SEED_SHARE`` by a hash; the score of its
``top``-th document is a floor that the second search, over all documents, starts
from. It changes how much is read, never what is found.

Only the terms of the queries have coordinates; no other can add to a score.
Queries are taken in blocks of about ``TERMS_AT_ONCE`` terms, against all
documents each. 64 bits stand for a term.

Defined cases: null and empty texts have no terms, count in neither N nor L and
are never found; an item without terms, or whose terms no document holds, finds
nothing; items that share an id are ranked one by one; repeated documents are
documents of their own; equal scores go by ``doc_id``, null last, and rows equal
in both are interchangeable; empty tables give no rows; texts of any length are
read whole; other columns are not read, whatever their names.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from heapq import heappop, heappush

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window, functions as F

from quotepanel.llm.common import union_all
from quotepanel.llm.textbytes import Texts, slices, word_hashes, words
from quotepanel.session import stored

TOP = 20
TERMS_AT_ONCE = 1 << 15
SEED_SHARE = 16
LEAF = 32
DOCS = 4096
ENTRIES = 1 << 20
SUBSPACES = 2048

# Fixed values of the scoring rule.
UNIT, STEP, SLOPE, BASE, SHARE = 1_000_000_000, 1000, 12, 100, 25

#: Term bytes in lower case (A-Z only), all other ASCII a space.
TERM_BYTES = np.full(256, 0x20, np.uint8)
for first, last in ((0x30, 0x39), (0x61, 0x7A), (0x80, 0xFF)):
    TERM_BYTES[first : last + 1] = np.arange(first, last + 1)
TERM_BYTES[0x41:0x5B] = np.arange(0x61, 0x7B)


def term_hashes(texts: Texts) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Hash and text of every term in order, and how many terms each text has."""
    texts = Texts(texts.first, TERM_BYTES[texts.data], texts.offsets)
    found = words(texts)
    return word_hashes(texts.data, found), found.doc, np.diff(found.first)


# Queries.


@dataclass
class Block:
    """Items of one block: ids, distinct term hashes in order, and per item its terms' numbers and counts."""

    ids: pa.Array
    vocabulary: np.ndarray
    terms: list[np.ndarray]
    counts: list[np.ndarray]


def hashed_items(items: DataFrame) -> DataFrame:
    """item_id and the hashes of its terms, repeats included."""
    rows = items.select("item_id", "text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch.column(1)):
                h, _, n = term_hashes(part)
                ends = np.cumsum(n)
                raw = [h[e - k : e].tobytes() for e, k in zip(ends, n, strict=True)]
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(part.first, len(part)), pa.array(raw, pa.binary())], names=["item_id", "hashes"])

    return rows.mapInArrow(run, rows.drop("text").schema.add("hashes", "binary"))


def blocks(items: DataFrame, terms_at_once: int = TERMS_AT_ONCE) -> Iterator[Block]:
    """The items, so many at a time that a block has about ``terms_at_once`` terms; one block in the driver at a time."""
    hashed = stored(hashed_items(items).filter(F.octet_length("hashes") > 0), "search-items")
    n_terms = hashed.agg(F.sum(F.octet_length("hashes").cast("long"))).first()[0] or 0
    n_blocks = -(-n_terms // (8 * terms_at_once))
    of_block = F.pmod(F.xxhash64("hashes", F.lit("block")), F.lit(n_blocks))
    for number in range(n_blocks):
        rows = (hashed.filter(of_block == number) if n_blocks > 1 else hashed).toArrow().combine_chunks()
        if not len(rows):
            continue
        per_item = [np.frombuffer(raw, np.uint64) for raw in rows["hashes"].to_pylist()]
        vocabulary = np.unique(np.concatenate(per_item))
        pairs = [np.unique(np.searchsorted(vocabulary, h), return_counts=True) for h in per_item]
        yield Block(pa.concat_arrays(rows["item_id"].chunks), vocabulary, [p[0] for p in pairs], [p[1] for p in pairs])


# Documents.


def counted(documents: DataFrame, vocabulary: np.ndarray) -> DataFrame:
    """doc_id, n (all its terms), and numbers and counts of the vocabulary's terms it holds."""
    rows = documents.select("doc_id", "text")
    shared = documents.sparkSession.sparkContext.broadcast(vocabulary)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = shared.value
        for batch in batches:
            for part in slices(batch.column(1)):
                h, doc, n = term_hashes(part)
                number = np.minimum(np.searchsorted(known, h), len(known) - 1)
                hit = known[number] == h
                pair, times = np.unique(doc[hit] * len(known) + number[hit], return_counts=True)
                cut = np.searchsorted(pair, np.arange(len(part) + 1) * len(known))
                number, times = (pair % len(known)).astype(np.int32), times.astype(np.int32)
                terms, tfs = ([x[cut[i] : cut[i + 1]].tobytes() for i in range(len(part))] for x in (number, times))
                ids = batch.column(0).slice(part.first, len(part))
                yield pa.RecordBatch.from_arrays(
                    [ids, pa.array(n, pa.int64()), pa.array(terms, pa.binary()), pa.array(tfs, pa.binary())], names=["doc_id", "n", "terms", "tfs"]
                )

    return rows.mapInArrow(run, rows.drop("text").schema.add("n", "long").add("terms", "binary").add("tfs", "binary"))


def _packed(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """All numbers of a binary column, and where each row's begin."""
    column = column.cast(pa.large_binary())
    _, offsets, data = column.buffers()
    offsets = np.frombuffer(offsets, np.int64)[column.offset : column.offset + len(column) + 1]
    raw = np.frombuffer(data, np.uint8)[offsets[0] : offsets[-1]] if data is not None else np.zeros(0, np.uint8)
    return raw.view(np.int32), (offsets - offsets[0]) // 4


def holders(vectors: DataFrame, n_terms: int) -> np.ndarray:
    """For each term the documents that hold it; one row per task and term is shuffled."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(n_terms, np.int64)
        for batch in batches:
            total += np.bincount(_packed(batch.column(0))[0], minlength=n_terms)
        held = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(held), pa.array(total[held])], names=["term", "df"])

    rows = vectors.select("terms").mapInArrow(run, "term long, df long").groupBy("term").agg(F.sum("df").alias("df")).collect()
    df = np.zeros(n_terms, np.int64)
    for row in rows:
        df[row["term"]] = row["df"]
    return df


def term_weights(df: np.ndarray, n_docs: int) -> np.ndarray:
    return np.floor(1000 * np.log((2 * n_docs + 2) / (2 * df + 1))).astype(np.int64)


# Ball trees.


@dataclass
class Tree:
    """A balanced binary tree; node ``k`` has children ``2k + 1`` and ``2k + 2`` and the documents ``low[k]`` to ``high[k]``."""

    order: np.ndarray  # document at each place
    begin: np.ndarray  # entries of each place
    column: np.ndarray
    value: np.ndarray  # int64
    low: np.ndarray
    high: np.ndarray
    centroid: np.ndarray  # nodes x columns
    radius: np.ndarray  # nodes x subspaces
    rank: np.ndarray  # the tree's number of each column
    group: np.ndarray  # subspace by that number


def _entries(begin: np.ndarray, order: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Entries of the rows in ``order``, and where each row's begin then."""
    size = (begin[1:] - begin[:-1])[order]
    new = np.concatenate([[0], np.cumsum(size)])
    return np.arange(new[-1]) + np.repeat(begin[:-1][order] - new[:-1], size), new


def _row_sums(x: np.ndarray, begin: np.ndarray) -> np.ndarray:
    total = np.concatenate([[0.0], np.cumsum(x)])
    return total[begin[1:]] - total[begin[:-1]]


def _dense(pivots: np.ndarray, begin: np.ndarray, column: np.ndarray, value: np.ndarray, width: int) -> np.ndarray:
    at, new = _entries(begin, pivots)
    out = np.zeros((len(pivots), width))
    out[np.repeat(np.arange(len(pivots)), np.diff(new)), column[at]] = value[at]
    return out


def grow(begin: np.ndarray, column: np.ndarray, value: np.ndarray, width: int, leaf: int = LEAF, subspaces: int = SUBSPACES) -> Tree:
    """The tree over sparse rows: each node is halved along the line through two far rows."""
    n = len(begin) - 1
    depth = max(0, int(np.ceil(np.log2(n / leaf))))
    # Columns by frequency, so that a subspace is a run of columns and a row's entries in it are a run too.
    rank = np.empty(width, np.int64)
    rank[np.argsort(np.bincount(column, minlength=width), kind="stable")] = np.arange(width)
    subspaces = min(subspaces, width)
    group = np.arange(width) * subspaces // width
    starts = np.searchsorted(group, np.arange(subspaces))
    row = np.repeat(np.arange(n), np.diff(begin))
    turn = np.lexsort((rank[column], row))
    column, value, order = rank[column][turn], value[turn], np.arange(n)
    edges, nodes = np.array([0, n]), []
    for level in range(depth + 1):
        count = len(edges) - 1
        node = np.repeat(np.arange(count), np.diff(edges))
        row = np.repeat(np.arange(n), np.diff(begin))
        of_entry = node[row]
        x = value.astype(float)
        centroid = np.bincount(of_entry * width + column, x, count * width).reshape(count, width) / np.diff(edges)[:, None]
        centroid = centroid.astype(np.float32)
        c = centroid.astype(float)
        square_c = np.add.reduceat(c * c, starts, axis=1)
        cross = x * c[of_entry, column]
        radius = _radii(row, node, np.diff(edges), group[column], x, cross, square_c)
        nodes.append((edges, centroid, np.nextafter(radius.astype(np.float32), np.float32(np.inf))))
        if level == depth:
            break
        norm = _row_sums(x * x, begin)
        far = _farthest(norm - 2 * _row_sums(cross, begin), edges)
        a = _dense(far, begin, column, x, width)
        to_a = norm - 2 * _row_sums(x * a[of_entry, column], begin)
        b = _dense(_farthest(to_a, edges), begin, column, x, width)
        to_b = norm - 2 * _row_sums(x * b[of_entry, column], begin)
        turn = np.lexsort((to_a - to_b, node))
        at, begin = _entries(begin, turn)
        order, column, value = order[turn], column[at], value[at]
        edges = np.unique(np.concatenate([edges, (edges[:-1] + edges[1:]) // 2]))
    low = np.concatenate([e[:-1] for e, _, _ in nodes])
    high = np.concatenate([e[1:] for e, _, _ in nodes])
    return Tree(order, begin, column, value, low, high, np.concatenate([c for _, c, _ in nodes]), np.concatenate([r for _, _, r in nodes]), rank, group)


def _radii(row, node, members, group, x, cross, square_c) -> np.ndarray:
    """Greatest distance of a node's rows from its centroid in each subspace, never too small."""
    new = np.ones(len(row), bool)
    new[1:] = (row[1:] != row[:-1]) | (group[1:] != group[:-1])
    run = np.flatnonzero(new)
    at, of_group = node[row[run]], group[run]
    square_x = np.add.reduceat(x * x, run) if len(run) else np.zeros(0)
    inner = np.add.reduceat(cross, run) if len(run) else np.zeros(0)
    base = square_c[at, of_group]
    # What rounding can have taken away is added again before the root.
    apart = np.maximum(base + square_x - 2 * inner, 0) + 1e-12 * 2 * (base + square_x)
    cell = at * square_c.shape[1] + of_group
    held = np.bincount(cell, minlength=square_c.size).reshape(square_c.shape)
    # A row without entries in a subspace is as far as the centroid is long.
    most = np.where(held < members[:, None], square_c * (1 + 1e-12), 0.0)
    np.maximum.at(most.reshape(-1), cell, apart)
    return np.sqrt(most)


def _farthest(distance: np.ndarray, edges: np.ndarray) -> np.ndarray:
    """Row of the greatest distance between each two edges."""
    most = np.maximum.reduceat(distance, edges[:-1])
    hit = np.flatnonzero(distance == np.repeat(most, np.diff(edges)))
    return hit[np.searchsorted(hit, edges[:-1])]


def bounds(tree: Tree, column: np.ndarray, weight: np.ndarray) -> np.ndarray:
    """For every node a number that no document below it exceeds, rounding included; columns by the tree's numbers."""
    q = weight.astype(float)
    groups, of_term = np.unique(tree.group[column], return_inverse=True)
    length = np.sqrt(np.bincount(of_term, q * q))
    inner = tree.centroid[:, column].astype(float) @ q + tree.radius[:, groups].astype(float) @ length
    return inner * (1 + 1e-9) + 1


def search(tree: Tree, column: np.ndarray, weight: np.ndarray, ids: np.ndarray, floor: int, top: int = TOP, dense: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray, int]:
    """Rows and scores of the ``top`` best rows of at least ``floor`` (1 or more), and how many leaves were opened.

    ``ids`` orders rows of equal score. ``dense`` is a scratch array of zeros.
    """
    dense = np.zeros(len(tree.rank), np.int64) if dense is None else dense
    column = tree.rank[column]
    dense[column] = weight
    bound = bounds(tree, column, weight)
    rows, scores, opened = np.zeros(0, np.int64), np.zeros(0, np.int64), 0
    inner_nodes = len(bound) // 2
    heap = [(-bound[0], 0)]
    while heap and -heap[0][0] >= floor:
        _, node = heappop(heap)
        if node < inner_nodes:
            for kid in (2 * node + 1, 2 * node + 2):
                if bound[kid] >= floor:
                    heappush(heap, (-bound[kid], kid))
            continue
        opened += 1
        first, last = tree.low[node], tree.high[node]
        begin = tree.begin[first : last + 1]
        part = slice(begin[0], begin[-1])
        total = np.concatenate([[0], np.cumsum(tree.value[part] * dense[tree.column[part]])])
        score = total[begin[1:] - begin[0]] - total[begin[:-1] - begin[0]]
        good = np.flatnonzero(score >= floor)
        if not len(good):
            continue
        rows, scores = np.concatenate([rows, tree.order[first + good]]), np.concatenate([scores, score[good]])
        if len(rows) >= top:
            best = np.lexsort((ids[rows], -scores))[:top]
            rows, scores = rows[best], scores[best]
            floor = max(floor, int(scores[-1]))
    dense[column] = 0
    return rows, scores, opened


@dataclass
class Plan:
    """What every task needs: the items as columns and weights, and the corpus totals."""

    ids: pa.Array
    terms: list[np.ndarray]
    weights: list[np.ndarray]
    n_terms: int
    n_docs: int
    n_words: int


def _subtrees(begin: np.ndarray) -> Iterator[tuple[int, int]]:
    """Ranges of rows that make one tree; a row with more entries than a tree's share stands alone."""
    at, n = 0, len(begin) - 1
    while at < n:
        end = int(np.searchsorted(begin, begin[at] + ENTRIES, "right")) - 1
        end = min(max(end, at + 1), at + DOCS, n)
        yield at, end
        at = end


def found(vectors: DataFrame, plan: Plan, floors: np.ndarray, top: int) -> DataFrame:
    """item (its number), item_id, doc_id, score: of each tree its ``top`` best documents per item, none below its floor."""
    shared = vectors.sparkSession.sparkContext.broadcast((plan, floors))
    id_type = vectors.schema["doc_id"].dataType
    item_type = vectors.sparkSession.createDataFrame(pa.table({"item_id": plan.ids.slice(0, 0)})).schema["item_id"].dataType

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own, floor = shared.value
        for batch in batches:
            term, begin = _packed(batch.column(2))
            tf = _packed(batch.column(3))[0].astype(np.int64)
            size = batch.column(1).to_numpy()
            m = BASE - SHARE + (SHARE * size * own.n_docs) // max(own.n_words, 1)
            value = (UNIT * tf) // (STEP * tf + SLOPE * np.repeat(m, np.diff(begin)))
            for first, last in _subtrees(begin):
                ids = batch.column(0).slice(first, last - first)
                entries = slice(begin[first], begin[last])
                known, column = np.unique(term[entries], return_inverse=True)
                if not len(known):
                    continue
                tree = grow(begin[first : last + 1] - begin[first], column, value[entries], len(known))
                # Places by id, null last: they order documents of equal score.
                turn = pa.compute.sort_indices(ids, null_placement="at_end").to_numpy()
                place = np.empty(len(ids), np.int64)
                place[turn] = np.arange(len(ids))
                dense = np.zeros(len(known), np.int64)
                items, rows, scores = [], [], []
                for i, (terms, weights) in enumerate(zip(own.terms, own.weights, strict=True)):
                    at = np.minimum(np.searchsorted(known, terms), len(known) - 1)
                    hit = known[at] == terms
                    if hit.any():
                        row, score, _ = search(tree, at[hit], weights[hit], place, int(floor[i]), top, dense)
                        items.append(np.full(len(row), i, np.int32))
                        rows.append(row)
                        scores.append(score)
                if items:
                    item, row = np.concatenate(items), np.concatenate(rows)
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(item), own.ids.take(pa.array(item)), ids.take(pa.array(row)), pa.array(np.concatenate(scores))],
                        names=["item", "item_id", "doc_id", "score"],
                    )

    schema = vectors.select("doc_id").schema
    schema = type(schema)().add("item", "integer").add("item_id", item_type).add("doc_id", id_type).add("score", "long")
    return vectors.select("doc_id", "n", "terms", "tfs").mapInArrow(run, schema)


def best(rows: DataFrame, top: int) -> DataFrame:
    """The ``top`` rows of each item with their rank; partial lists are cut before the shuffle."""
    in_order = Window.partitionBy("item").orderBy(F.desc("score"), F.asc_nulls_last("doc_id"))
    return rows.withColumn("rank", F.row_number().over(in_order)).filter(F.col("rank") <= top)


def ranked(documents: DataFrame, items: DataFrame, top: int = TOP, terms_at_once: int = TERMS_AT_ONCE) -> DataFrame:
    """The ``top`` highest-scoring documents of each item: item_id, rank, doc_id, score."""
    results = []
    for block in blocks(items, terms_at_once):
        vectors = stored(counted(documents, block.vocabulary), "search-vectors")
        totals = vectors.agg(F.count_if(F.col("n") > 0), F.coalesce(F.sum("n"), F.lit(0))).first()
        weight = term_weights(holders(vectors, len(block.vocabulary)), totals[0])
        weights = [weight[t] * c for t, c in zip(block.terms, block.counts, strict=True)]
        plan = Plan(block.ids, block.terms, weights, len(block.vocabulary), *totals)
        floors = np.ones(len(block.ids), np.int64)
        sample = vectors.filter(F.pmod(F.xxhash64("doc_id", "terms", "tfs"), F.lit(SEED_SHARE)) == 0)
        for row in best(found(sample, plan, floors, top), top).filter(F.col("rank") == top).select("item", "score").collect():
            floors[row["item"]] = row["score"]
        results.append(best(found(vectors, plan, floors, top), top).select("item_id", "rank", "doc_id", "score"))
    if not results:
        schema = type(items.schema)().add("item_id", items.schema["item_id"].dataType).add("rank", "integer")
        return items.sparkSession.createDataFrame([], schema.add("doc_id", documents.schema["doc_id"].dataType).add("score", "long"))
    return union_all(results)

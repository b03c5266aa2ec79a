"""Operator 8, embedding near-duplicates by a subspace pigeonhole join.

Unit vectors are rotated to their principal axes and cut into blocks of
coordinates, ``BLOCK`` each and ``BLOCKS`` at most. Cosine ``t`` is a squared
distance of ``2 - 2 t``; each block gets a part of it in proportion to its
variance, and two vectors that are that near are within the budget of at least
one block.

Vectors are dealt once, by hash, into chunks of about ``CHUNK`` distinct ones; a
chunk is one row of a written table. Tasks read pairs of chunks from that table, so what is
shuffled and written grows with the vectors and not with the pairs; nothing else
decides the size of a task. In each block a chunk's vectors lie in tiles around
centres. Two vectors within the block's radius are no farther apart along the
line between the centres of their tiles, which leaves few vectors to compare
with a tile. Candidates are verified there by the cosine of the given vectors in
double precision, and a pair counts in the first block whose budget holds it, so
no list of pairs is written: a task returns per vector its number of links and
one edge to a root.

Equal vectors are collapsed first and count as often as they occur. The
covariance behind the rotation is a sum over all vectors: one matrix per task,
added up cell by cell in Spark. Vectors are scaled by a power of two first,
which is exact and keeps very long and very short ones from over- or underflow.

Defined cases: vectors that are null, empty, zero or hold a null or non-finite
number link with nothing, and so do rows without an id; vectors of different
lengths never link; repeated ids share a component.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from contextlib import contextmanager

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.types import FloatType

from quotepanel.llm.graph import components, local_roots
from quotepanel.llm.workers import lean
from quotepanel.session import shared_folder, stored

THRESHOLD = 0.9
BLOCK = 16
BLOCKS = 8
#: Vectors of a chunk, and bytes of their numbers in memory where these are many.
CHUNK = 32_768
CHUNK_BYTES = 16 << 20
#: Chunks that a task reads of either side; fewer as long as there are not ``SIDES`` parts.
SIDE = 4
SIDES = 12
TILE = 64
WIDE = 2048
#: Covers the rounding of coordinates to single precision.
SLACK = 1e-6
#: Candidates that are verified at a time, and edges that a task holds.
MANY, PENDING = 1 << 15, 1 << 20


def _by_length(batches: Iterator[pa.RecordBatch], kind: type) -> Iterator[tuple[int, pa.RecordBatch, np.ndarray]]:
    """(length, rows of the batch, matrix of numbers) for each length of vectors."""
    for batch in batches:
        size = np.array(batch.column("size"))
        for d in np.unique(size):
            rows = batch if (size == d).all() else batch.take(pa.array(np.flatnonzero(size == d)))
            flat = rows.column("vector").flatten().to_numpy(zero_copy_only=False)
            yield int(d), rows, np.ascontiguousarray(flat, kind).reshape(-1, d)


def _scaled(x: np.ndarray) -> np.ndarray:
    """In double precision, the largest number of each vector between a half and one."""
    x = x.astype(np.float64)
    return np.ldexp(x, -np.frexp(np.abs(x).max(axis=1, keepdims=True))[1])


def _moments(kind: type):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total: dict[int, np.ndarray] = {}
        for d, _, x in _by_length(batches, kind):
            x = _unit(_scaled(x))
            x1 = np.hstack([x, np.ones((len(x), 1))])
            total[d] = total.get(d, 0) + x1.T @ x1
        for d, m in total.items():
            yield _batch(size=np.full(m.size, d, np.int32), cell=np.arange(m.size), moment=m.ravel())

    return run


def _unit(x: np.ndarray) -> np.ndarray:
    return x / np.linalg.norm(x, axis=1, keepdims=True)


class Blocks:
    """Rotation, blocks and budgets for vectors of one length."""

    def __init__(self, moment: np.ndarray, threshold: float, distinct: int):
        d, n = len(moment) - 1, moment[-1, -1]
        self.chunks = -(-distinct // max(1, min(CHUNK, CHUNK_BYTES // (8 * d))))
        mean = moment[-1, :-1] / n
        variance, axes = np.linalg.eigh(moment[:-1, :-1] / n - np.outer(mean, mean))
        order = np.argsort(-variance)
        self.axes, variance = axes[:, order], np.maximum(variance[order], 0)
        wide = max(BLOCK, -(-d // BLOCKS))
        self.cuts = [(i, min(i + wide, d)) for i in range(0, d, wide)]
        share = np.array([variance[a:b].sum() for a, b in self.cuts])
        share = np.maximum(share / max(share.sum(), 1e-300), 1e-3)
        self.budget = (2 - 2 * threshold) * share + SLACK


def _runs(*keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Order by the keys, and where in it each run of equal ones starts."""
    order = np.lexsort(keys)
    new = np.ones(len(order), bool)
    if len(order):
        new[1:] = np.any([k[order[1:]] != k[order[:-1]] for k in keys], axis=0)
    return order, np.flatnonzero(new)


def _collapsed(rows: pa.RecordBatch | pa.Table) -> tuple[np.ndarray, dict[str, np.ndarray]]:
    """A row of each class, and the classes: both hashes, least id and number of rows."""
    column = {c: np.array(rows.column(c)) for c in ("class", "more", "rep", "n")}
    order, start = _runs(column["class"], column["more"])
    some = order[start]
    rep, n = np.minimum.reduceat(column["rep"][order], start), np.add.reduceat(column["n"][order], start)
    return some, {"class": column["class"][some], "more": column["more"][some], "rep": rep, "n": n}


def _deal(blocks: dict[int, Blocks], kind: type):
    """Each vector once, to its chunk; equal ones of a batch as one."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for d, rows, x in _by_length(batches, kind):
            some, classes = _collapsed(rows)
            chunk = (classes["class"].astype(np.uint64) % np.uint64(blocks[d].chunks)).astype(np.int64)
            ends = pa.array(np.arange(len(some) + 1, dtype=np.int32) * (x.itemsize * d))
            raw = pa.Array.from_buffers(pa.binary(), len(some), [None, ends.buffers()[1], pa.py_buffer(x[some].tobytes())])
            yield _batch(size=np.full(len(some), d, np.int32), chunk=chunk, **classes, vector=raw)

    return run


def _batch(**columns) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([x if isinstance(x, pa.Array) else pa.array(x) for x in columns.values()], names=list(columns))


def _tiles(part: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Order of the vectors by their nearest centre, and where each tile starts. Rows come by hash, so the first are centres at random."""
    n = len(part)
    centre, nearest = part[: max(1, n // TILE)], np.zeros(n, np.int64)
    for last in (False, True):
        half = (centre * centre).sum(axis=1) / 2
        for i in range(0, n, 8192):
            nearest[i : i + 8192] = np.argmax(part[i : i + 8192] @ centre.T - half, axis=1)
        order, start = _runs(nearest)
        if not last:
            centre = _means(part[order], start)
    # A tile is 2 * TILE vectors at most.
    size = np.diff(start, append=n)
    pieces = -(-size // (2 * TILE))
    within = np.arange(pieces.sum()) - np.repeat(np.cumsum(pieces) - pieces, pieces)
    return order, np.repeat(start, pieces) + within * 2 * TILE


def _means(part: np.ndarray, start: np.ndarray) -> np.ndarray:
    return (np.add.reduceat(part, start, axis=0) / np.diff(start, append=len(part))[:, None]).astype(np.float32)


def _chunk(blocks: dict[int, Blocks], kind: type):
    """The rows of a chunk as one row of bytes."""

    def run(rows: pa.Table) -> pa.Table:
        some, classes = _collapsed(rows)
        d = rows.column("size")[0].as_py()
        raw = b"".join(rows.column("vector").take(pa.array(some)).to_pylist())
        u = (_unit(_scaled(np.frombuffer(raw, kind).reshape(-1, d))) @ blocks[d].axes).astype(np.float32)
        tiles = []
        for a, b in blocks[d].cuts:
            order, start = _tiles(u[:, a:b])
            tiles += [[len(start)], start, order]
        packed = [pa.array([x.tobytes()], pa.binary()) for x in (*classes.values(), np.concatenate(tiles).astype(np.int32))]
        return pa.Table.from_arrays(
            [pa.array([d], pa.int32()), pa.array([rows.column("chunk")[0].as_py()], pa.int64()), *packed[:4], pa.array([raw], pa.binary()), packed[4]],
            names=["size", "chunk", "class", "more", "rep", "n", "vectors", "tiles"],
        )

    return run


class Tiled:
    """The coordinates of a block by tiles."""

    def __init__(self, u: np.ndarray, order: np.ndarray, start: np.ndarray):
        self.order, self.start, self.size = order, start, np.diff(start, append=len(order))
        self.part = u[order]
        self.centre = _means(self.part, start)
        self.own = (self.part * np.repeat(self.centre, self.size, axis=0)).sum(axis=1)


class Vectors:
    """A chunk, unpacked."""

    def __init__(self, row: dict, own: Blocks, kind: type):
        # Copies, so that the batch can go.
        self.classes, self.rep, self.n = (np.frombuffer(row[c], np.int64).copy() for c in ("class", "rep", "n"))
        self.tiles, self.cuts = np.frombuffer(row["tiles"], np.int32).copy(), own.cuts
        raw = np.frombuffer(row["vectors"], kind).reshape(len(self.n), -1)
        # The square of a single number is a double one.
        self.x = raw.copy() if kind is np.float32 else _scaled(raw)
        self.norm, self.u = np.empty(len(raw)), np.empty(raw.shape, np.float32)
        for i in range(0, len(raw), 4096):
            some = slice(i, i + 4096)
            self.norm[some] = np.linalg.norm(self.x[some].astype(np.float64), axis=1)
            self.u[some] = _unit(_scaled(raw[some])) @ own.axes

    def tiled(self, block: int) -> Tiled:
        at, n = 0, len(self.n)
        for _ in range(block):
            at += 1 + self.tiles[at] + n
        mid = at + 1 + self.tiles[at]
        return Tiled(self.u[:, slice(*self.cuts[block])], self.tiles[mid : mid + n].astype(np.int64), self.tiles[at + 1 : mid].astype(np.int64))

    def doubles(self, some: np.ndarray) -> np.ndarray:
        return self.x[some].astype(np.float64, copy=False)


def _candidates(a: Tiled, b: Tiled, budget: float, within: bool) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Pairs of rows whose squared distance in the block is at most the budget, or hardly more; within a chunk each pair once."""
    k = a.part.shape[1]
    # Single products of vectors no longer than one are that far off at most.
    off = 4 * (k + 2) * float(np.finfo(np.float32).eps)
    gap = (a.centre * a.centre).sum(axis=1)[:, None] + (b.centre * b.centre).sum(axis=1) - 2 * (a.centre @ b.centre.T)
    most = np.sqrt(budget) * np.sqrt(np.maximum(gap, 0) + off) + 4 * off
    ends = np.append(a.start, len(a.order))
    for i in range(0, len(a.start), 16):
        # How far each tile reaches at least towards each of the others.
        j = min(i + 16, len(a.start))
        rows = slice(ends[i], ends[j])
        reach = a.own[rows, None] - a.part[rows] @ b.centre.T
        most[i:j] -= np.minimum.reduceat(reach, a.start[i:j] - ends[i], axis=0)
    most, turned = most.astype(np.float32), np.ascontiguousarray(b.part.T)
    # A product of a and b less half the square of b tells the distance for each a.
    square, half = (a.part * a.part).sum(axis=1), (b.part * b.part).sum(axis=1, keepdims=True) / -2
    as_left, as_right = np.hstack([a.part, np.ones_like(a.part[:, :1])]), np.hstack([b.part, half])
    least = ((square - budget - off) / 2).astype(np.float32)
    product, found, pending = np.empty(2 * TILE * WIDE, np.float32), [], 0
    for i in range(0, len(a.start), 8):
        along = a.centre[i : i + 8] @ turned
        for s in range(i, min(i + 8, len(a.start))):
            first, last = ends[s], ends[s + 1]
            base = first if within else 0
            near = base + np.flatnonzero((b.own - along[s - i] <= np.repeat(most[s], b.size))[base:])
            for w in range(0, len(near), WIDE):
                q = near[w : w + WIDE]
                nearness = np.matmul(as_left[first:last], as_right.take(q, axis=0).T, out=product[: (last - first) * len(q)].reshape(-1, len(q)))
                some = np.flatnonzero(nearness.max(axis=1) >= least[first:last])
                p, at = np.nonzero(nearness.take(some, axis=0) >= least[first + some, None])
                p, q = first + some[p], q[at]
                if within:
                    p, q = p[p < q], q[p < q]
                if len(p):
                    found.append((p, q))
                    pending += len(p)
                if pending > MANY:
                    yield _rows(a, b, found)
                    found, pending = [], 0
    if found:
        yield _rows(a, b, found)


def _rows(a: Tiled, b: Tiled, found: list) -> tuple[np.ndarray, np.ndarray]:
    return a.order[np.concatenate([p for p, _ in found])], b.order[np.concatenate([q for _, q in found])]


def _links(a: Vectors, b: Vectors, own: Blocks, threshold: float) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Pairs of vectors whose cosine is at least the threshold, each once."""
    for block, budget in enumerate(own.budget):
        left = a.tiled(block)
        for ps, qs in _candidates(left, left if a is b else b.tiled(block), budget, a is b):
            for c in range(0, len(ps), MANY):
                p, q = ps[c : c + MANY], qs[c : c + MANY]
                true = np.einsum("ij,ij->i", a.doubles(p), b.doubles(q)) / (a.norm[p] * b.norm[q]) >= threshold
                p, q = p[true], q[true]
                for earlier in range(block + 1):
                    lo, hi = own.cuts[earlier]
                    inside = ((a.u[p, lo:hi].astype(np.float64) - b.u[q, lo:hi]) ** 2).sum(axis=1) <= own.budget[earlier]
                    p, q = (p[inside], q[inside]) if earlier == block else (p[~inside], q[~inside])
                yield p, q


class Tally:
    """Links and roots of the vectors that a task has met."""

    def __init__(self):
        self.begins: dict[tuple, int] = {}
        self.classes, self.rep, self.links = (np.zeros(0, np.int64) for _ in range(3))
        self.edges: list[tuple[np.ndarray, np.ndarray]] = []
        self.pending = 0

    def place(self, key: tuple, chunk: Vectors) -> int:
        if key not in self.begins:
            self.begins[key] = len(self.links)
            self.classes, self.rep = np.append(self.classes, chunk.classes), np.append(self.rep, chunk.rep)
            self.links = np.append(self.links, np.zeros(len(chunk.n), np.int64))
        return self.begins[key]

    def add(self, p: np.ndarray, q: np.ndarray, p_weight: np.ndarray, q_weight: np.ndarray) -> None:
        np.add.at(self.links, p, q_weight)
        np.add.at(self.links, q, p_weight)
        self.edges.append((p, q))
        self.pending += len(p)
        if self.pending > PENDING:
            root = self.roots()
            some = np.flatnonzero(root != np.arange(len(root)))
            self.edges, self.pending = [(some, root[some])], 0

    def roots(self) -> np.ndarray:
        a, b = (np.concatenate([e[side] for e in self.edges] or [np.zeros(0, np.int64)]) for side in (0, 1))
        return local_roots(len(self.links), a, b)

    def batch(self) -> pa.RecordBatch:
        some = np.flatnonzero(self.links)
        return _batch(**{"class": self.classes[some], "links": self.links[some], "a": self.rep[some], "b": self.rep[self.roots()[some]]})


def _join(blocks: dict[int, Blocks], kind: type, threshold: float) -> Callable[[Iterator], Iterator]:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tally, held = Tally(), {}
        for batch in batches:
            for i in range(batch.num_rows):
                a = b = None
                pair = {}
                for side in ("left", "right"):
                    row = {c: batch.column(f"{side}_{c}")[i].as_buffer() for c in ("class", "rep", "n", "vectors", "tiles")}
                    pair[side] = (batch.column("left_size")[i].as_py(), batch.column(f"{side}_chunk")[i].as_py())
                    if pair[side] not in held:
                        held = {k: v for k, v in held.items() if k in pair.values()}
                        held[pair[side]] = Vectors(row, blocks[pair[side][0]], kind)
                a, b = held[pair["left"]], held[pair["right"]]
                at, to = tally.place(pair["left"], a), tally.place(pair["right"], b)
                for p, q in _links(a, b, blocks[pair["left"][0]], threshold):
                    tally.add(at + p, to + q, a.n[p], b.n[q])
        yield tally.batch()

    return lean(run)


def _classes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for row in batch.to_pylist():
            columns = {c: np.frombuffer(x, np.int64) for c, x in row.items()}
            for i in range(0, len(columns["own"]), 8192):
                yield _batch(**{c: x[i : i + 8192] for c, x in columns.items()})


@contextmanager
def _one_row_a_batch(spark: SparkSession) -> Iterator[None]:
    """A row is two chunks, so that more of them at once would only fill the memory of both sides."""
    key = "spark.sql.execution.arrow.maxRecordsPerBatch"
    before = spark.conf.get(key)
    spark.conf.set(key, "1")
    try:
        yield
    finally:
        spark.conf.set(key, before)


def near_duplicates(embeddings: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """vec_id, n_links, component_id, kept for each row of ``embeddings`` (vec_id, embedding)."""
    spark = embeddings.sparkSession
    vector = F.transform("embedding", lambda v: v.cast("double"))
    # NaN is the greatest of all numbers here.
    most = F.array_max(F.transform(vector, F.abs))
    whole = ~F.exists("embedding", lambda v: v.isNull())
    good = F.col("vec_id").isNotNull() & F.coalesce(whole & (most > 0) & (most < float("inf")) & ~F.isnan(most), F.lit(False))
    keyed = embeddings.select("vec_id", "embedding", F.when(good, F.xxhash64("embedding", F.lit("a"))).alias("class"), F.xxhash64(F.lit("b"), "embedding").alias("more"))
    rows = stored(keyed.select("vec_id", "class", "more", F.size("embedding").alias("length")), "vectors")
    lengths = rows.filter("class IS NOT NULL").groupBy("length").agg(F.approx_count_distinct("class").alias("n"))
    distinct = {r["length"]: max(1, r["n"]) for r in lengths.collect()}
    single = isinstance(embeddings.schema["embedding"].dataType.elementType, FloatType)
    kind = np.float32 if single else np.float64
    plain = keyed.filter(F.col("class").isNotNull()).select(
        "class", "more", F.col("vec_id").cast("long").alias("rep"), F.lit(1).cast("long").alias("n"), F.size("embedding").alias("size"), (F.col("embedding") if single else vector).alias("vector")
    )
    cells = plain.select("size", "vector").mapInArrow(_moments(kind), "size int, cell long, moment double").groupBy("size", "cell").agg(F.sum("moment").alias("moment"))
    moments: dict[int, np.ndarray] = {}
    for r in cells.collect():  # (length + 1) squared numbers for each length of vectors
        d = r["size"]
        moments.setdefault(d, np.zeros((d + 1, d + 1))).flat[r["cell"]] = r["moment"]
    blocks = {d: Blocks(m, threshold, distinct[d]) for d, m in moments.items()}
    # 128 bits of hash stand for a vector; the vector itself is shuffled and written once.
    dealt = plain.mapInArrow(lean(_deal(blocks, kind)), "size int, chunk long, class long, more long, rep long, n long, vector binary")
    names = ["size", "chunk", "class", "more", "rep", "n", "vectors", "tiles"]
    packed = dealt.groupBy("size", "chunk").applyInArrow(
        _chunk(blocks, kind), "size int, chunk long, class binary, more binary, rep binary, n binary, vectors binary, tiles binary"
    )
    path = shared_folder(spark, "vector-chunks")
    packed.write.option("maxRecordsPerFile", 1).option("parquet.enable.dictionary", "false").parquet(path)
    chunks = spark.read.schema(packed.schema).parquet(path)
    total = sum(b.chunks for b in blocks.values())
    parts = max(1, min(total, SIDES), -(-total // SIDE))
    left, right = (chunks.select(*[F.col(c).alias(f"{side}_{c}") for c in names if c != "more"]).coalesce(parts) for side in ("left", "right"))
    # Pairs of chunks are read from the table; no exchange holds them.
    pairs = left.join(right.hint("shuffle_replicate_nl"), (F.col("left_size") == F.col("right_size")) & (F.col("left_chunk") <= F.col("right_chunk")))
    with _one_row_a_batch(spark):
        found = stored(pairs.drop("right_size").mapInArrow(_join(blocks, kind, threshold), "class long, links long, a long, b long"), "vector-links")
    links = found.groupBy(F.col("class").alias("of")).agg(F.sum("links").alias("links"))
    copies = chunks.select(F.col("class").alias("own"), F.col("more").alias("own_more"), "rep", "n").mapInArrow(_classes, "own long, own_more long, rep long, n long")
    direct = rows.join(copies, (F.col("class") == F.col("own")) & (F.col("more") == F.col("own_more")), "left")
    roots = components(found.select("a", "b"))
    result = direct.join(links, F.col("class") == F.col("of"), "left").join(roots, F.col("rep") == F.col("node"), "left")
    component = F.coalesce("root", "rep", "vec_id")
    return result.select(
        "vec_id",
        (F.coalesce("n", F.lit(1)) - 1 + F.coalesce("links", F.lit(0))).cast("long").alias("n_links"),
        component.cast("long").alias("component_id"),
        F.coalesce(F.col("vec_id") == component, F.lit(True)).alias("kept"),
    )


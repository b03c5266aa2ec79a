"""Operator 10, byte-level BPE encoding and decoding.

A text is cut into pieces by the public pattern and each piece is merged by
itself. A segment tree over the byte positions of a piece holds, for each
position where a live token starts, the rank of the pair with its right
neighbour; an inner node holds the least (rank, position) below it, so its
root is the leftmost pair of lowest rank. A merge changes three leaves (the
pair itself, its left neighbour's pair, the right token that is gone) and the
logarithmically many nodes above them, until no pair has a rank.

Pieces of one tree size are merged together, one merge in each per step, as
rows of a matrix; a piece of over ``MANY`` bytes has a tree of its own. Pieces
met before come from a table that is emptied when it has ``REMEMBERED`` bytes,
which changes only the time.

Defined cases: null and empty texts have no ids; a piece that is a token is
that token; decoding the ids gives back the text's bytes; very long texts are
encoded whole, a text at a time; an empty table gives an empty one. Repeated
rows, null ids and extra columns pass as they are.
"""

from __future__ import annotations

import base64
import uuid
from collections.abc import Iterator
from functools import cached_property

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame

from quotepanel.llm.common import passed
from quotepanel.llm.textbytes import slices
from quotepanel.llm.workers import held, lean

#: Bytes beyond which a piece is merged alone.
MANY = 512
#: Cells of a matrix of trees.
CELLS = 1 << 18
#: Bytes of pieces and their ids that a worker remembers, and what a piece takes besides.
REMEMBERED = 32 << 20
ENTRY = 200
NONE = np.int64(1) << 62


def read_ranks(path: str) -> list[bytes]:
    """Tokens by rank from a file of lines ``base64 rank``."""
    with open(path, "rb") as lines:
        pairs = [line.split() for line in lines if line.strip()]
    tokens = [b""] * len(pairs)
    for token, rank in pairs:
        tokens[int(rank)] = base64.b64decode(token)
    return tokens


class Merges:
    """The ranks of a vocabulary, and texts encoded and decoded with them."""

    def __init__(self, tokens: list[bytes], pattern: str):
        self.tokens, self.split = tokens, regex.compile(pattern).findall
        self.rank = {token: i for i, token in enumerate(tokens)}
        self.byte = np.array([self.rank[bytes([b])] for b in range(256)], np.int64)
        left, right, merged = [], [], []
        for i, token in enumerate(tokens):
            for cut in range(1, len(token)):
                a, b = self.rank.get(token[:cut]), self.rank.get(token[cut:])
                if a is not None and b is not None:
                    left.append(a)
                    right.append(b)
                    merged.append(i)
        pair = (np.array(left, np.int64) << 32) | np.array(right, np.int64)
        order = np.argsort(pair)
        self.pair, self.merged = np.append(pair[order], NONE), np.append(np.array(merged, np.int64)[order], NONE)
        self.length = np.array([len(t) for t in tokens], np.int64)
        self.begin = np.cumsum(self.length) - self.length
        self.bytes = np.frombuffer(b"".join(tokens), np.uint8)
        self.known: dict[str, bytes] = {}
        self.held = 0

    @cached_property
    def rank_of_pair(self) -> dict[int, int]:
        return dict(zip(self.pair[:-1].tolist(), self.merged[:-1].tolist(), strict=True))

    def pair_rank(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        wanted = (a << 32) | b
        at = np.searchsorted(self.pair, wanted)
        return np.where(self.pair[at] == wanted, self.merged[at], NONE)

    def merge_rows(self, pieces: list[bytes], size: int) -> list[bytes]:
        """Ids of pieces of at most ``size`` bytes, a power of two, one tree per row."""
        n = len(pieces)
        length = np.array([len(p) for p in pieces])
        column = np.arange(size)
        here = column < length[:, None]
        token = np.zeros((n, size + 1), np.int64)
        token[:, :size][here] = self.byte[np.frombuffer(b"".join(pieces), np.uint8)]
        live = here.copy()
        after = np.tile(np.arange(1, size + 2), (n, 1))
        before = np.tile(np.arange(-1, size), (n, 1))
        tree = np.full((n, 2 * size), NONE, np.int64)
        paired = column + 1 < length[:, None]
        rank = np.full((n, size), NONE, np.int64)
        rank[paired] = self.pair_rank(token[:, :size][paired], token[:, 1:][paired])
        tree[:, size:] = np.where(rank < NONE, rank * size + column, NONE)
        width = size // 2
        while width:
            tree[:, width : 2 * width] = np.minimum(tree[:, 2 * width : 4 * width : 2], tree[:, 2 * width + 1 : 4 * width : 2])
            width //= 2

        def leaf(row, at, other):
            value = np.full(len(row), NONE, np.int64)
            ok = (at >= 0) & (other < length[row])
            found = self.pair_rank(token[row[ok], at[ok]], token[row[ok], other[ok]])
            value[ok] = np.where(found < NONE, found * size + at[ok], NONE)
            return value

        row = np.flatnonzero(tree[:, 1] < NONE)
        while len(row):
            least = tree[row, 1]
            at = least % size
            gone = after[row, at]
            then = after[row, gone]
            token[row, at] = least // size
            live[row, gone] = False
            after[row, at] = then
            inside = then <= size
            before[row[inside], then[inside]] = at[inside]
            back = before[row, at]
            tree[row, size + gone] = NONE
            tree[row, size + at] = leaf(row, at, np.minimum(then, size))
            has = back >= 0
            tree[row[has], size + back[has]] = leaf(row[has], back[has], at[has])
            back = np.where(has, back, at)
            for place in (gone, at, back):
                node = (size + place) >> 1
                while node[0]:
                    tree[row, node] = np.minimum(tree[row, 2 * node], tree[row, 2 * node + 1])
                    node >>= 1
            row = row[tree[row, 1] < NONE]
        ids = token[:, :size][live].astype("<u4").tobytes()
        ends = 4 * np.cumsum(live.sum(axis=1))
        return [ids[a:b] for a, b in zip([0, *ends[:-1].tolist()], ends.tolist(), strict=True)]

    def merge_long(self, piece: bytes) -> bytes:
        """Ids of one piece by the same tree in plain lists."""
        n, get = len(piece), self.rank_of_pair.get
        size = 1 << (n - 1).bit_length()
        token = self.byte[np.frombuffer(piece, np.uint8)].tolist()
        after, before = list(range(1, n + 1)), list(range(-1, n - 1))
        none = int(NONE)
        tree = [none] * (2 * size)

        def leaf(i: int) -> int:
            j = after[i]
            rank = get(token[i] << 32 | token[j]) if j < n else None
            return none if rank is None else rank * size + i

        for i in range(n):
            tree[size + i] = leaf(i)
        for node in range(size - 1, 0, -1):
            tree[node] = min(tree[2 * node], tree[2 * node + 1])

        def put(i: int, value: int) -> None:
            node = size + i
            tree[node] = value
            node >>= 1
            while node:
                a, b = tree[2 * node], tree[2 * node + 1]
                least = a if a < b else b
                if tree[node] == least:
                    break
                tree[node] = least
                node >>= 1

        while tree[1] < none:
            rank, i = divmod(tree[1], size)
            gone = after[i]
            token[i], token[gone] = rank, -1
            after[i] = then = after[gone]
            if then < n:
                before[then] = i
            put(gone, none)
            put(i, leaf(i))
            if before[i] >= 0:
                put(before[i], leaf(before[i]))
        return np.array([t for t in token if t >= 0], "<u4").tobytes()

    def learn(self, pieces: set[str]) -> None:
        """Put the ids of new pieces into the table."""
        by_size: dict[int, list[str]] = {}
        for piece in pieces:
            raw = piece.encode()
            whole = self.rank.get(raw)
            if whole is not None:
                self.known[piece] = whole.to_bytes(4, "little")
            elif len(raw) > MANY:
                self.known[piece] = self.merge_long(raw)
            else:
                by_size.setdefault(1 << (len(raw) - 1).bit_length(), []).append(piece)
        for size, own in by_size.items():
            step = max(1, CELLS // size)
            for i in range(0, len(own), step):
                some = own[i : i + step]
                self.known.update(zip(some, self.merge_rows([p.encode() for p in some], size), strict=True))

    def encode(self, texts: list[str]) -> list[bytes]:
        """Ids of each text as little-endian unsigned 32-bit integers."""
        cut = [self.split(text) for text in texts]
        new = set().union(*cut) - self.known.keys()
        if new:
            self.learn(new)
        ids = self.known.__getitem__
        out = [b"".join(map(ids, pieces)) for pieces in cut]
        # Long pieces hardly come again; of the others so many bytes stay.
        for piece in new:
            if len(piece) > MANY // 4:
                del self.known[piece]
            else:
                self.held += ENTRY + len(piece) + len(self.known[piece])
        if self.held > REMEMBERED:
            self.known.clear()
            self.held = 0
        return out

    def decode(self, ids: bytes) -> bytes:
        token = np.frombuffer(ids, "<u4").astype(np.int64)
        length = self.length[token]
        place = np.arange(int(length.sum())) + np.repeat(self.begin[token] - (np.cumsum(length) - length), length)
        return self.bytes[place].tobytes()


def tokenized(documents: DataFrame, tokens: list[bytes], pattern: str, text: str = "text") -> DataFrame:
    """Every row of ``documents`` but its text, with ids (binary, 4 bytes each) and decoded (binary).

    The vocabulary is a file of fixed size, so it is broadcast. Columns called
    ``ids`` or ``decoded``, in any case, give way to the new ones.
    """
    vocabulary, name = documents.sparkSession.sparkContext.broadcast((tokens, pattern)), uuid.uuid4().hex
    keep = passed(documents.columns, text, "ids", "decoded")
    rows = documents.select(*[f"`{c}`" for c in keep], f"`{text}`")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = held(name, lambda: Merges(*vocabulary.value))
        for batch in batches:
            for part in slices(batch.column(len(keep))):
                ids = own.encode([part.text(i).decode() for i in range(len(part))])
                decoded = [own.decode(x) for x in ids]
                columns = [batch.column(i).slice(part.first, len(part)) for i in range(len(keep))]
                yield pa.RecordBatch.from_arrays(
                    [*columns, pa.array(ids, pa.binary()), pa.array(decoded, pa.binary())], names=[*keep, "ids", "decoded"]
                )

    schema = rows.drop(text).schema.add("ids", "binary").add("decoded", "binary")
    return rows.mapInArrow(lean(run), schema)

"""Operator 13, Merkle manifest of a dataset as a persistent tree with path copying.

A row is a leaf: the SHA-256 of its fields. The leaves of a source stand by
``doc_id`` and, ``FAN`` at a time, become the digest of their run, until one
node, the subroot, is left; the subroots by source become the root likewise.

The tree is cut into aligned blocks of ``FAN ** LEVELS`` nodes. A task holds one
block as a persistent tree: a changed leaf makes a version of it that copies the
leaf's ancestors only and shares every other node. Above the block the version
goes on with the runs on the block's own path, which a pass from the root down
has brought to it, so no task and no driver sees more than a block.

Order comes from one range shuffle of the digests: a row's place is its index
in its sorted partition, less the first one of its source there, plus the rows
of that source in earlier partitions. A source may be any share of all rows.

Defined cases: a null field is ``-``; a null ``doc_id`` comes first and is never
tampered with; a null source is a source of its own and comes first; an empty
text is ``0:``; equal ids stand by leaf digest, and rows equal in all five
fields are leaves of their own with equal digests; a source with one leaf has
it as subroot; an empty table has no rows and no root. Texts of any length are
hashed whole inside Spark. Other columns are not read, whatever their names.
"""

from __future__ import annotations

from dataclasses import dataclass
from hashlib import sha256

import pandas as pd
from pyspark.sql import Column, DataFrame, Window, functions as F

from quotepanel.llm.common import lookup_join
from quotepanel.session import stored

FAN = 16
#: Levels of the tree inside one block, and the nodes of a block.
LEVELS = 3
BLOCK = FAN**LEVELS
#: Length of a digest as hex text.
HEX = 64

FIELDS = ("doc_id", "source", "lang", "n_chars", "text")
NODES = "key string, n long, idx long, digest string"
CHAIN = "chain array<struct<place:int,run:string>>, subroot string, root string"
RESULT = (
    "doc_id string, leaf string, subroot string, root string, proof_sha256 string, folded_root string, verified boolean, copied array<string>"
)


# Leaves.


def _field(value: Column) -> Column:
    value = value.cast("string")
    return F.coalesce(F.concat(F.octet_length(value).cast("string"), F.lit(":"), value), F.lit("-"))


def leaf_digest(**changed: Column) -> Column:
    return F.sha2(F.concat(*[_field(changed.get(name, F.col(name))) for name in FIELDS]).cast("binary"), 256)


def tampered() -> Column:
    """The rows whose text is lower-cased for the check."""
    return F.coalesce(F.crc32(F.col("doc_id").cast("string").cast("binary")) % 5 == 0, F.lit(False))


def lower_ascii(text: Column) -> Column:
    upper = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
    return F.translate(text, upper, upper.lower())


def source_key(source: Column) -> Column:
    """Text that sorts like the source, null before every string."""
    return F.when(source.isNull(), F.lit("0")).otherwise(F.concat(F.lit("1"), source))


def leaves(documents: DataFrame) -> DataFrame:
    """key, doc_id, leaf and, for rows that are tampered with, the digest after it."""
    changed = F.when(tampered(), leaf_digest(text=lower_ascii(F.col("text"))))
    return documents.select(*FIELDS).select(source_key(F.col("source")).alias("key"), "doc_id", leaf_digest().alias("leaf"), changed.alias("changed"))


# Places.


def placed(rows: DataFrame, order: list[str], purpose: str) -> DataFrame:
    """``rows`` with idx (place among the rows of a ``key`` in the order given) and n (rows of the key).

    Rows that are equal in all of ``order`` are told apart by a number, so that
    no range is larger than a partition, and no row changes its place when a
    task is run again.
    """
    written = stored(rows.withColumn("nth", F.monotonically_increasing_id()), f"{purpose}-rows")
    columns = ["key", *order, "nth"]
    ranged = written.repartitionByRange(*columns).sortWithinPartitions(*columns)
    at = F.monotonically_increasing_id()
    ranked = stored(ranged.select(*rows.columns, F.shiftright(at, 33).alias("part"), at.alias("at")), f"{purpose}-ranked")
    # One row per partition and key: as many as there are partitions and keys together.
    runs = ranked.groupBy("part", "key").agg(F.min("at").alias("first"), F.count(F.lit(1)).alias("rows"))
    whole = Window.partitionBy("key")
    earlier = whole.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    starts = runs.select(
        F.col("part").alias("_part"),
        F.col("key").alias("_key"),
        (F.coalesce(F.sum("rows").over(earlier), F.lit(0)) - F.col("first")).alias("shift"),
        F.sum("rows").over(whole).alias("n"),
    )
    starts = stored(starts, f"{purpose}-starts")
    joined = lookup_join(ranked, starts, (F.col("part") == F.col("_part")) & (F.col("key") == F.col("_key")), starts.count())
    return joined.select(*rows.columns, "n", (F.col("at") + F.col("shift")).alias("idx"))


# The persistent tree of one block. Digests are hex text as bytes.


@dataclass(frozen=True, slots=True)
class Node:
    digest: bytes
    kids: tuple[Node, ...] = ()


def digest_of(joined: bytes) -> bytes:
    return sha256(joined).hexdigest().encode()


def parent(kids: tuple[Node, ...]) -> Node:
    return Node(digest_of(b"".join(kid.digest for kid in kids)), kids)


def grow(digests: list[bytes], levels: int) -> Node:
    layer = [Node(d) for d in digests]
    for _ in range(levels):
        layer = [parent(tuple(layer[i : i + FAN])) for i in range(0, len(layer), FAN)]
    return layer[0]


def version(node: Node, levels: int, place: int, digest: bytes, copied: list[bytes]) -> Node:
    """The tree with one leaf replaced: new nodes on its path, bottom-up in ``copied``, all others shared."""
    if not levels:
        return Node(digest)
    below = FAN ** (levels - 1)
    at = place // below
    kid = version(node.kids[at], levels - 1, place % below, digest, copied)
    new = parent((*node.kids[:at], kid, *node.kids[at + 1 :]))
    copied.append(new.digest)
    return new


def runs_of(root: Node, levels: int) -> list[list[bytes]]:
    """For each level from the leaves up, its runs as joined digests."""
    layer, out = [root], []
    for _ in range(levels):
        out.append([b"".join(kid.digest for kid in node.kids) for node in layer])
        layer = [kid for node in layer for kid in node.kids]
    return out[::-1]


def path_of(runs: list[list[bytes]], place: int) -> list[tuple[int, bytes]]:
    """Place in its run, and the run, of each node from a leaf up."""
    return [(place // FAN**level % FAN, run[place // FAN ** (level + 1)]) for level, run in enumerate(runs)]


def siblings(path: list[tuple[int, bytes]]) -> bytes:
    return b"".join(run[: place * HEX] + run[(place + 1) * HEX :] for place, run in path)


def continued(digest: bytes, path: list[tuple[int, bytes]], copied: list[bytes]) -> bytes:
    """A version carried on above its block: the root's digest after ``digest`` came in."""
    for place, run in path:
        digest = digest_of(run[: place * HEX] + digest + run[(place + 1) * HEX :])
        copied.append(digest)
    return digest


def height(n: int) -> int:
    """Levels above ``n`` nodes until one is left."""
    levels = 0
    while n > 1:
        n, levels = -(-n // FAN), levels + 1
    return levels


def levels_in(n: int, tier: int) -> int:
    """Of a key with ``n`` leaves, the levels that lie in the blocks of a tier."""
    return max(0, min(LEVELS, height(n) - tier * LEVELS))


# Tiers of blocks.


def _block(tier_nodes: DataFrame):
    return tier_nodes.withColumn("block", F.floor(F.col("idx") / BLOCK).cast("long")).groupBy("key", "block")


def _roots(tier: int):
    def run(rows: pd.DataFrame) -> pd.DataFrame:
        rows = rows.sort_values("idx")
        n = int(rows["n"].iloc[0])
        root = grow([d.encode() for d in rows["digest"]], levels_in(n, tier))
        return pd.DataFrame({"key": [rows["key"].iloc[0]], "n": [n], "idx": [int(rows["block"].iloc[0])], "digest": [root.digest.decode()]})

    return run


def _chains(tier: int):
    def run(rows: pd.DataFrame, above: pd.DataFrame) -> pd.DataFrame:
        """The path above each node of a block, from the path above the block."""
        rows = rows.sort_values("idx")
        levels = levels_in(int(rows["n"].iloc[0]), tier)
        runs = runs_of(grow([d.encode() for d in rows["digest"]], levels), levels)
        upper = [(step["place"], step["run"]) for step in above["chain"].iloc[0]]
        chains = [[{"place": p, "run": r} for p, r in [*((p, r.decode()) for p, r in path_of(runs, i)), *upper]] for i in range(len(rows))]
        same = {name: above[name].iloc[0] for name in ("subroot", "root")}
        return pd.DataFrame({"key": rows["key"], "idx": rows["idx"], "chain": chains, **same})

    return run


def climbed(nodes: DataFrame, most: int, purpose: str) -> list[DataFrame]:
    """``nodes`` (key, n, idx, digest) and the tables of block roots above them; the last has one row per key."""
    tables = [nodes]
    for tier in range(max(1, -(-height(most) // LEVELS))):
        tables.append(stored(_block(tables[-1]).applyInPandas(_roots(tier), NODES), f"{purpose}-tier"))
    return tables


def descended(tables: list[DataFrame], top: DataFrame, last: int) -> DataFrame:
    """The chain above each node of table ``last`` from those above the roots (key, idx, chain, subroot, root)."""
    chains = top
    for tier in range(len(tables) - 2, last - 1, -1):
        above = chains.withColumnRenamed("idx", "block").groupBy("key", "block")
        chains = stored(_block(tables[tier]).cogroup(above).applyInPandas(_chains(tier), f"key string, idx long, {CHAIN}"), "manifest-chains")
    return chains


def _checked(rows: pd.DataFrame, above: pd.DataFrame) -> pd.DataFrame:
    """Proof and folded root of every leaf of a block; one version for each leaf that changed."""
    rows = rows.sort_values("idx")
    levels = levels_in(int(rows["n"].iloc[0]), 0)
    tree = grow([d.encode() for d in rows["leaf"]], levels)
    runs = runs_of(tree, levels)
    upper = [(step["place"], step["run"].encode()) for step in above["chain"].iloc[0]]
    upper_siblings = siblings(upper)
    subroot, root = above["subroot"].iloc[0], above["root"].iloc[0]
    same = continued(tree.digest, upper, [])
    proofs, folded, copies = [], [], []
    for place, (leaf, changed) in enumerate(zip(rows["leaf"], rows["changed"], strict=True)):
        proofs.append(sha256(siblings(path_of(runs, place)) + upper_siblings).hexdigest())
        copied: list[bytes] = []
        if isinstance(changed, str) and changed != leaf:
            new = version(tree, levels, place, changed.encode(), copied)
            folded.append(continued(new.digest, upper, copied).decode())
        else:  # this version shares every node
            folded.append(same.decode())
        copies.append([d.decode() for d in copied])
    out = {"doc_id": rows["doc_id"], "leaf": rows["leaf"], "subroot": subroot, "root": root, "proof_sha256": proofs, "folded_root": folded}
    return pd.DataFrame({**out, "verified": [f == root for f in folded], "copied": copies})


def manifest(documents: DataFrame) -> DataFrame:
    """Per row: doc_id, leaf, subroot, root, proof_sha256, folded_root, verified and copied.

    ``copied`` holds the digests of the nodes that the row's version copied,
    bottom-up; together with the untouched nodes they are that version's tree.
    """
    rows = stored(placed(leaves(documents), ["doc_id", "leaf"], "manifest"), "manifest-leaves")
    id_type = documents.schema["doc_id"].dataType
    most = rows.agg(F.max("n")).first()[0]
    if most is None:
        return documents.sparkSession.createDataFrame([], RESULT).withColumn("doc_id", F.col("doc_id").cast(id_type))
    tables = climbed(rows.select("key", "n", "idx", F.col("leaf").alias("digest")), most, "manifest")
    subroots = tables[-1].select(F.lit("").alias("key"), F.col("key").alias("source"), "digest")
    sources = stored(placed(subroots, ["source"], "manifest-sources"), "manifest-sources")
    above = climbed(sources.select("key", "n", "idx", "digest"), sources.count(), "manifest-sources")
    no_chain = F.array().cast("array<struct<place:int,run:string>>").alias("chain")
    root = above[-1].select("key", "idx", no_chain, F.lit("").alias("subroot"), F.col("digest").alias("root"))
    of_source = descended(above, root, 0).select(F.col("idx").alias("_idx"), "chain", "root")
    joined = lookup_join(sources, of_source, F.col("idx") == F.col("_idx"), sources.count())
    top = joined.select(F.col("source").alias("key"), F.lit(0).cast("long").alias("idx"), "chain", F.col("digest").alias("subroot"), "root")
    chains = descended(tables, top, 1).withColumnRenamed("idx", "block").groupBy("key", "block")
    # Ids travel as text: pandas would make floats of a column with nulls.
    named = rows.withColumn("doc_id", F.col("doc_id").cast("string"))
    return _block(named).cogroup(chains).applyInPandas(_checked, RESULT).withColumn("doc_id", F.col("doc_id").cast(id_type))

"""The persistent Merkle tree against a plain list-of-lists tree."""

from hashlib import sha256
from zlib import crc32

import pytest
from pyspark.sql import functions as F

from quotepanel.llm import manifest
from tests.llm.conftest import SCHEMA

FIELDS = ["doc_id", "source", "lang", "n_chars", "text"]


def hashed(text: str) -> str:
    return sha256(text.encode()).hexdigest()


def leaf(row, text):
    parts = [row.doc_id, row.source, row.lang, row.n_chars, text]
    return hashed("".join("-" if v is None else f"{len(str(v).encode())}:{v}" for v in parts))


def lowered(text):
    return None if text is None else "".join(c.lower() if "A" <= c <= "Z" else c for c in text)


def layers(digests):
    out = [digests]
    while len(out[-1]) > 1:
        out.append([hashed("".join(out[-1][i : i + 16])) for i in range(0, len(out[-1]), 16)])
    return out


def plain(rows):
    """(doc_id, leaf, subroot, root, proof, folded root) of every row, as the contract says it."""
    by_source: dict = {}
    for row in rows:
        by_source.setdefault((row.source is not None, (row.source or "").encode()), []).append(row)
    trees, placed = [], []
    for key in sorted(by_source):
        members = sorted(by_source[key], key=lambda r: (r.doc_id is not None, r.doc_id or 0, leaf(r, r.text)))
        placed.append(members)
        trees.append(layers([leaf(r, r.text) for r in members]))
    top = layers([t[-1][0] for t in trees])
    found = []
    for rank, (tree, members) in enumerate(zip(trees, placed)):
        for place, row in enumerate(members):
            hit = row.doc_id is not None and crc32(str(row.doc_id).encode()) % 5 == 0
            folded = leaf(row, lowered(row.text) if hit else row.text)
            proof = ""
            for steps, at in ((tree, place), (top, rank)):
                for layer in steps[:-1]:
                    first = at // 16 * 16
                    run = layer[first : first + 16]
                    proof += "".join(run[: at - first] + run[at - first + 1 :])
                    folded = hashed("".join([*run[: at - first], folded, *run[at - first + 1 :]]))
                    at //= 16
            found.append((row.doc_id, tree[0][place], tree[-1][0], top[-1][0], hashed(proof), folded, folded == top[-1][0]))
    return sorted(found, key=repr)


def result(frame):
    return sorted((tuple(r)[:7] for r in manifest.manifest(frame).collect()), key=repr)


def test_hard_rows(hard):
    assert result(hard) == plain(hard.collect())


def test_clashing_names(clash, hard):
    extra = "part at nth idx n key leaf changed digest block chain _part _key _idx shift KEY copied".split()
    wide = hard.select("*", *[F.lit("x").alias(name) for name in extra])
    assert result(wide) == plain(hard.collect())
    assert result(clash) == plain(hard.collect())


def test_empty(empty):
    assert result(empty) == []


@pytest.mark.parametrize("n", [1, 16, 17, 4096, 4097])
def test_sizes_of_one_source(spark, n):
    rows = spark.range(n).select(F.col("id").alias("doc_id"), F.concat(F.lit("Text "), "id").alias("text"), F.lit("en").alias("lang"), F.lit("a").alias("source"), F.lit(1).cast("long").alias("n_chars"))
    assert result(rows) == plain(rows.collect())


def test_many_sources_beside_a_hot_one(spark):
    """A third of all rows in one source, 300 small sources, repeated rows, and more than one block."""
    rows = spark.range(15_000).select(
        F.when(F.col("id") < 400, F.lit(None).cast("long")).otherwise(F.floor(F.col("id") / 2) * 2).alias("doc_id"),
        F.when(F.col("id") < 400, "same").otherwise(F.concat(F.lit("T "), "id")).alias("text"),
        F.lit(None).cast("string").alias("lang"),
        F.when(F.col("id") % 3 == 0, "hot").when(F.col("id") < 400, "hot").otherwise(F.concat(F.lit("s"), F.col("id") % 300)).alias("source"),
        F.lit(3).cast("long").alias("n_chars"),
    )
    assert result(rows) == plain(rows.collect())


def test_lookups_beyond_the_broadcast_size(spark, hard, monkeypatch):
    monkeypatch.setattr("quotepanel.llm.common.BROADCAST_ROWS", 0)
    assert result(hard) == plain(hard.collect())


def test_versions_share_what_they_do_not_copy():
    digests = [hashed(str(i)).encode() for i in range(300)]
    tree = manifest.grow(digests, 3)
    copied = []
    new = manifest.version(tree, 3, 137, b"f" * 64, copied)
    assert new == manifest.grow([*digests[:137], b"f" * 64, *digests[138:]], 3)
    assert tree == manifest.grow(digests, 3)  # the old version is as it was
    assert len(copied) == 3 and copied[-1] == new.digest
    shared = [a is b for a, b in zip(tree.kids[0].kids, new.kids[0].kids)]
    assert shared.count(False) == 1 and new.kids[1] is tree.kids[1]


def test_copied_nodes_lead_to_the_folded_root(spark):
    rows = spark.range(500).select(F.col("id").alias("doc_id"), F.lit("Ab").alias("text"), F.lit("en").alias("lang"), F.concat(F.lit("s"), F.col("id") % 20).alias("source"), F.lit(2).cast("long").alias("n_chars"))
    assert rows.schema.simpleString() and SCHEMA
    for row in manifest.manifest(rows).collect():
        assert row.verified == (not row.copied) and (row.verified or row.copied[-1] == row.folded_root)

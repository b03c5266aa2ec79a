"""Operator 3, n-gram Jaccard join by grouped prefixes.

A document is the set of its distinct ``k``-word shingles, as 64-bit hashes.
Sets are ordered by rarity: shingles that are in many documents come last, the
most common at the very end; the others by the frequency classes of their words
(powers of two), rarest first, then by hash. With ``n`` shingles and a
similarity of num/den, two similar documents share one of the first
``n - ceil(n num / den) + 1``, the prefix.

1. Equal sets are one class, and classes of equal size and prefix one group.
   Only groups are joined.
2. Common shingles: in each list of groups with one common shingle in the
   prefix, the group with the fewest rare shingles is the hub; every class of
   the list is verified against the hub, and every class of a group against
   the group's first. This is linear in the lists and settles most of a family
   of near copies.
3. All shingles: groups that share a prefix shingle and are not in one
   component yet meet, filtered by size, by the position of the shingle, and
   by the number and last position of all their shared ones. Pairs that stay
   are expanded to classes, filtered by their parity maps (a bit that differs
   takes a shingle that differs) and verified.

Pairs within one component need no look, since only components are asked for;
any pair across components that can be similar is verified, so no component
is lost. Verification compares the shingle sets of the two whole texts.

The list of common shingles holds those in over ``COMMON`` of the documents;
it has at most (mean set size) / ``COMMON`` entries, whatever the input, and
that of words, those over ``WORD_SHARE`` of all words, its inverse. They only
order the shingles: any order gives the same links. As a corpus grows, a
document's prefix keeps to shingles of its rarest words, so the lists of
documents that share one do not grow with it.

Defined cases: texts without a word (null, empty) have no shingles and link
with nothing; rows that repeat an id and rows with equal sets are linked; rows
without an id link with nothing and have no component.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window, functions as F

from quotepanel.llm.common import Scratch
from quotepanel.llm.graph import components
from quotepanel.llm.textbytes import LOWER, MULTIPLIER, Texts, mix, shingle_sets, slices, word_hashes, word_windows, words
from quotepanel.llm.workers import lean, release
from quotepanel.session import stored

COMMON = 0.002
LEAST_COMMON = 4
WORD_SHARE = 2e-5
#: Ids (8 bytes each) that may be broadcast to pick their texts; more are joined by shuffle.
BROADCAST_IDS = 500_000


class Counter:
    """Lossy counts of hashes: what has too small a share of all is dropped now and then."""

    def __init__(self, most: int):
        self.most, self.waiting, self.n_waiting = most, [], 0
        self.value, self.count = np.zeros(0, np.uint64), np.zeros(0, np.int64)

    def add(self, values: np.ndarray, least: float) -> None:
        self.waiting.append(values)
        self.n_waiting += len(values)
        if self.n_waiting > self.most // 2:
            self.fold(1)
            if len(self.value) > self.most:
                self.fold(least)

    def fold(self, least: float) -> None:
        if self.waiting:
            new, n = np.unique(np.concatenate(self.waiting), return_counts=True)
            self.waiting, self.n_waiting = [], 0
            at = np.searchsorted(self.value, new)
            known = np.append(self.value, np.uint64(0))[at] == new
            known &= at < len(self.value)
            self.count[at[known]] += n[known]
            new, n, at = new[~known], n[~known], at[~known]
            self.value, self.count = np.insert(self.value, at, new), np.insert(self.count, at, n)
        keep = self.count >= least
        self.value, self.count = self.value[keep], self.count[keep]


def _common(k: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Shingles in many documents, and frequent words, of this task: what is common overall is so in some task."""
        release()
        shingles, vocabulary, docs, n_words = Counter(1_000_000), Counter(1_000_000), 0, 0
        for batch in batches:
            docs += len(batch)
            for part in slices(batch.column(0)):
                shingles.add(shingle_sets(part, k)[0], COMMON * docs / 2)
                h = _lower_words(part)[0]
                n_words += len(h)
                vocabulary.add(h, WORD_SHARE * n_words / 2)
        shingles.fold(max(LEAST_COMMON, COMMON * docs / 2))
        vocabulary.fold(max(LEAST_COMMON, WORD_SHARE * n_words / 2))
        for kind, found in (("shingle", shingles), ("word", vocabulary)):
            own = pa.array([kind] * len(found.value), pa.string())
            yield pa.RecordBatch.from_arrays([own, pa.array(found.value.view(np.int64)), pa.array(found.count)], names=["kind", "value", "n"])
        yield pa.RecordBatch.from_arrays([pa.array(["words", "documents"]), pa.array([0, 0]), pa.array([n_words, docs])], names=["kind", "value", "n"])

    return run


def _lower_words(part: Texts):
    texts = Texts(part.first, LOWER[part.data], part.offsets)
    found = words(texts)
    return word_hashes(texts.data, found), found


def common_shingles(documents: DataFrame, k: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The common shingles, from the least common on, and the frequent words in order with their classes."""
    counted = documents.select("text").mapInArrow(lean(_common(k)), "kind string, value long, n long").groupBy("kind", "value").agg(F.sum("n").alias("n"))
    counted = stored(counted, "jaccard-counts")
    totals = {r["kind"]: r["n"] for r in counted.filter(F.col("kind").isin("words", "documents")).collect()}
    least = {"shingle": max(LEAST_COMMON, COMMON * totals.get("documents", 0) / 2), "word": max(LEAST_COMMON, WORD_SHARE * totals.get("words", 0) / 2)}
    often = reduce(Column.__or__, [(F.col("kind") == kind) & (F.col("n") >= n) for kind, n in least.items()])
    top = counted.filter(often).toPandas()  # bounded, see above
    shingles = top[top["kind"] == "shingle"].sort_values(["n", "value"])["value"].to_numpy(np.int64).view(np.uint64)
    found = top[top["kind"] == "word"]
    value, n = found["value"].to_numpy(np.int64).view(np.uint64), found["n"].to_numpy(np.int64)
    order = np.argsort(value)
    return shingles, value[order], 1 + np.floor(np.log2(n[order] / least["word"])).astype(np.int64)


def rarity(part: Texts, k: int, value: np.ndarray, known: np.ndarray, classes: np.ndarray) -> np.ndarray:
    """For each shingle the classes of its words added up: the more, the commoner."""
    if not len(known) or not len(value):
        return np.zeros(len(value), np.int64)
    h, found = _lower_words(part)
    at = np.minimum(np.searchsorted(known, h), len(known) - 1)
    own = np.where(known[at] == h, classes[at], 0)
    window, first = word_windows(h, found, k)
    if not len(window):
        return np.zeros(len(value), np.int64)
    total = sum(own[first + i] for i in range(k))
    one, index = np.unique(window, return_index=True)
    at = np.minimum(np.searchsorted(one, value), len(one) - 1)
    return np.where(one[at] == value, total[index[at]], 0)


def _prefixes(k: int, num: int, den: int, shared):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        release()
        common, known, classes = shared.value
        by_value = np.argsort(common)
        table = common[by_value]
        for batch in batches:
            for part in slices(batch.column(1)):
                value, first = shingle_sets(part, k)
                score = rarity(part, k, value, known, classes)
                if len(table) and len(value):
                    at = np.minimum(np.searchsorted(table, value), len(table) - 1)
                    rank = np.where(table[at] == value, by_value[at], -1)
                else:
                    rank = np.full(len(value), -1)
                size, rows = np.diff(first), []
                for i in range(len(part)):
                    own, r = value[first[i] : first[i + 1]], rank[first[i] : first[i + 1]]
                    n = len(own)
                    if not n:
                        rows.append((0, 0, 0, 0, 0, [], []))
                        continue
                    rare, classed = own[r < 0], score[first[i] : first[i + 1]][r < 0]
                    rare = rare[np.lexsort((rare, classed))]
                    length = n - -(-n * num // den) + 1
                    prefix = rare[:length]
                    if len(prefix) < length:
                        often = r >= 0
                        prefix = np.concatenate([prefix, own[often][np.argsort(r[often])][: length - len(prefix)]])
                    s = mix(own + np.uint64(n))
                    p = mix(prefix * MULTIPLIER + np.arange(len(prefix), dtype=np.uint64) + np.uint64(n))
                    signs = [x.sum(dtype=np.uint64).astype(np.int64) for x in (s, mix(s * MULTIPLIER), p, mix(p * MULTIPLIER))]
                    # Two bits or more per shingle, in a power of two of longs.
                    bits = 64 << max(0, (n - 1) // 32).bit_length()
                    odd = np.bincount((own >> np.uint64(32)).astype(np.int64) % bits, minlength=bits) & 1
                    rows.append((*map(int, signs), len(rare), prefix.view(np.int64), np.packbits(odd.astype(np.uint8)).view(np.int64)))
                columns = list(zip(*rows, strict=True))
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column(0).slice(part.first, len(part)),
                        pa.array(size),
                        *[pa.array(np.array(x, np.int64)) for x in columns[:5]],
                        *[pa.array([list(x) for x in own], pa.list_(pa.int64())) for own in columns[5:]],
                    ],
                    names=["doc_id", "n", "s1", "s2", "g1", "g2", "rare", "prefix", "parity"],
                )

    return run


def _sets(parts, k: int) -> Iterator[np.ndarray]:
    for part in parts:
        value, first = shingle_sets(part, k)
        for i in range(len(part)):
            yield value[first[i] : first[i + 1]]


def _close(a: np.ndarray, b: np.ndarray, num: int, den: int) -> bool:
    both = np.concatenate([a, b])
    both.sort()
    shared = int((both[1:] == both[:-1]).sum())
    return bool(len(a) and len(b)) and den * shared >= num * (len(a) + len(b) - shared)


def _similar(k: int, num: int, den: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        release()
        for batch in batches:
            for part in slices(batch.column(2)):
                rows = batch.slice(part.first, len(part))
                left, right = _sets([part], k), _sets(slices(rows.column(3)), k)
                keep = [_close(a, b, num, den) for a, b in zip(left, right, strict=True)]
                yield rows.select(["a", "b"]).filter(pa.array(keep))

    return run


def verified(pairs: DataFrame, documents: DataFrame, k: int, num: int, den: int, scratch: Scratch) -> DataFrame:
    """Those of ``pairs`` (a, b: document ids) whose whole texts are similar, as a written table."""
    pairs = scratch.stored(pairs, "pairs")
    ids = scratch.stored(pairs.select(F.explode(F.array("a", "b")).alias("id")).distinct(), "pair-ids")
    ids = F.broadcast(ids) if ids.count() <= BROADCAST_IDS else ids
    texts = scratch.stored(documents.select("doc_id", "text").join(ids, F.col("doc_id") == F.col("id"), "left_semi"), "pair-texts")
    left = texts.select(F.col("doc_id").alias("left_id"), F.col("text").alias("left_text"))
    right = texts.select(F.col("doc_id").alias("right_id"), F.col("text").alias("right_text"))
    both = pairs.join(left, F.col("a") == F.col("left_id")).join(right, F.col("b") == F.col("right_id"))
    return scratch.stored(both.select("a", "b", "left_text", "right_text").mapInArrow(lean(_similar(k, num, den)), "a long, b long"), "links")


def _reach(n_a: str, pos_a: str, n_b: str, pos_b: str, num: int, den: int, more: Column | int = 0) -> Column:
    """Whether the rest after the given positions leaves enough in common."""
    rest = F.least(F.col(n_a) - F.col(pos_a), F.col(n_b) - F.col(pos_b)) + more
    return rest * (num + den) >= num * (F.col(n_a) + F.col(n_b))


def _folded(own: str, other: str) -> Column:
    """A parity map, its halves laid over each other if it is longer than ``other``."""
    half = (F.size(own) / 2).cast("int")
    over = F.zip_with(F.slice(own, F.lit(1), half), F.slice(own, half + 1, half), lambda x, y: x.bitwiseXOR(y))
    return F.when(F.size(own) > F.size(other), over).otherwise(F.col(own))


def similar_components(documents: DataFrame, k: int, num: int, den: int) -> DataFrame:
    """doc_id, n_shingles, component_id for each row of ``documents`` (doc_id long, text), as a written table."""
    if 2 * num < den:
        raise ValueError("a similarity of one half or more is needed")
    documents, scratch = documents.select("doc_id", "text"), Scratch(documents.sparkSession)
    shared = documents.sparkSession.sparkContext.broadcast(common_shingles(documents, k))
    schema = "doc_id long, n long, s1 long, s2 long, g1 long, g2 long, rare long, prefix array<long>, parity array<long>"
    sets = scratch.stored(documents.mapInArrow(lean(_prefixes(k, num, den, shared)), schema), "prefixes")
    some = sets.filter("n > 0 AND doc_id IS NOT NULL")
    groups = scratch.stored(
        some.groupBy("n", "g1", "g2").agg(F.min("doc_id").alias("gid"), F.any_value("rare").alias("rare"), F.any_value("prefix").alias("prefix")), "groups"
    )
    classes = some.groupBy("n", "s1", "s2").agg(
        F.min("doc_id").alias("rep"), F.min("g1").alias("g1"), F.min("g2").alias("g2"), F.any_value("parity").alias("parity")
    )
    members = scratch.stored(classes.join(groups.select("n", "g1", "g2", "gid"), ["n", "g1", "g2"]).select("rep", "gid", "n", "s1", "s2", "parity"), "members")
    postings = groups.select("gid", "n", "rare", F.posexplode("prefix").alias("pos", "shingle"))

    # 2. Hubs of common shingles, and the first class of each group.
    often = postings.filter("pos >= rare")
    hub_key = (F.least("rare", F.lit(1 << 20)) * F.lit(1 << 40)) + F.pmod(F.xxhash64("gid"), F.lit(1 << 40))
    keyed = often.withColumn("key", hub_key)
    least = keyed.groupBy("shingle").agg(F.min("key").alias("least"), F.max("key").alias("most")).filter("least < most")
    hubs = keyed.join(least.select("shingle", F.col("least").alias("key")), ["shingle", "key"]).select(
        "shingle", F.col("gid").alias("hub"), F.col("n").alias("hub_n"), F.col("pos").alias("hub_pos")
    )
    to_hub = often.join(hubs, "shingle").filter("gid != hub").filter(_reach("n", "pos", "hub_n", "hub_pos", num, den)).select("gid", "hub").distinct()
    starts = members.join(to_hub, "gid").select(F.col("rep").alias("a"), F.col("hub").alias("b"))
    starts = starts.unionByName(members.filter("rep != gid").select(F.col("rep").alias("a"), F.col("gid").alias("b")))
    first_links = verified(starts.distinct(), documents, k, num, den, scratch)
    first = components(first_links)

    # 3. All pairs of groups across components.
    joined = members.join(first, F.col("rep") == F.col("node"), "left").select("rep", "gid", "n", "parity", F.coalesce("root", "rep").alias("part"))
    parts = scratch.stored(joined, "parts")
    # A group is its own part, but for the few that a hub has linked.
    moved = parts.filter("part != gid").select("gid").distinct()
    moved = parts.join(moved, "gid", "left_semi").select(F.col("gid").alias("of"), F.col("part").alias("moved_to")).distinct()
    moved = scratch.stored(moved, "moved-groups")
    moved = F.broadcast(moved) if moved.count() <= BROADCAST_IDS else moved
    in_parts = groups.select("gid", "n", "prefix").join(moved, F.col("gid") == F.col("of"), "left")
    # One shuffle of the postings: the part only where it is another, size and position in one number.
    placed = in_parts.select("gid", F.nullif("moved_to", "gid").alias("moved_to"), "n", F.posexplode("prefix").alias("pos", "shingle"))
    packed = placed.select("shingle", "gid", "moved_to", (F.shiftleft("n", 32) + F.col("pos")).alias("n_pos"))
    part, of_shingle = F.coalesce("moved_to", "gid"), Window.partitionBy("shingle")
    spread = packed.withColumns({"low": F.min(part).over(of_shingle), "high": F.max(part).over(of_shingle)}).filter("low < high")
    n, pos = F.shiftright("n_pos", 32), F.col("n_pos").bitwiseAND(F.lit((1 << 32) - 1))
    lists = scratch.stored(spread.select("shingle", "gid", part.alias("part"), n.alias("n"), pos.alias("pos")), "lists")
    one = lists.select("shingle", *[F.col(c).alias(f"{c}_a") for c in ("gid", "part", "n", "pos")])
    two = lists.select("shingle", *[F.col(c).alias(f"{c}_b") for c in ("gid", "part", "n", "pos")])
    close = (F.col("n_a") * den >= F.col("n_b") * num) & (F.col("n_b") * den >= F.col("n_a") * num)
    met = (
        one.join(two, "shingle")
        .filter((F.col("part_a") < F.col("part_b")) & close & _reach("n_a", "pos_a", "n_b", "pos_b", num, den))
        .groupBy("gid_a", "part_a", "n_a", "gid_b", "part_b", "n_b")
        .agg(F.count(F.lit(1)).alias("shared"), F.max("pos_a").alias("pos_a"), F.max("pos_b").alias("pos_b"))
        .filter(_reach("n_a", "pos_a", "n_b", "pos_b", num, den, F.col("shared") - 1))
    )
    met = met.select("gid_a", "part_a", "gid_b", "part_b")
    left = parts.select(*[F.col(c).alias(f"{c}_a") for c in ("gid", "part", "rep", "n", "parity")])
    right = parts.select(*[F.col(c).alias(f"{c}_b") for c in ("gid", "part", "rep", "n", "parity")])
    # Sizes within a factor of two give maps within one; the longer is folded.
    map_a, map_b = _folded("parity_a", "parity_b"), _folded("parity_b", "parity_a")
    differ = F.aggregate(F.zip_with(map_a, map_b, lambda x, y: F.bit_count(x.bitwiseXOR(y))), F.lit(0), lambda s, x: s + x)
    pairs = (
        met.join(left, ["gid_a", "part_a"])
        .join(right, ["gid_b", "part_b"])
        .filter((F.col("n_a") + F.col("n_b") - differ) * (num + den) >= 2 * num * (F.col("n_a") + F.col("n_b")))
        .select(F.col("rep_a").alias("a"), F.col("rep_b").alias("b"))
    )
    links = verified(pairs, documents, k, num, den, scratch).unionByName(first_links)

    roots = members.join(components(links), F.col("rep") == F.col("node"), "left").select(
        F.col("n").alias("_n"), F.col("s1").alias("_s1"), F.col("s2").alias("_s2"), F.coalesce("root", "rep").alias("component_id")
    )
    same = (F.col("n") == F.col("_n")) & (F.col("s1") == F.col("_s1")) & (F.col("s2") == F.col("_s2"))
    found = sets.select("doc_id", "n", "s1", "s2").join(roots, same & F.col("doc_id").isNotNull(), "left")
    result = found.select("doc_id", F.col("n").alias("n_shingles"), F.coalesce("component_id", "doc_id").alias("component_id"))
    result = stored(result, "document-components")
    scratch.clear()
    return result


def one_per_group(documents: DataFrame, k: int, num: int, den: int) -> DataFrame:
    """One row of each component of ``documents``, with all columns: that of least id, ties by a hash of the text.

    A document is its id and text, told by two 64-bit hashes of both: texts
    under one id are judged each by itself, and of rows that repeat both one
    stays. Rows without an id and texts without a word all stay. Columns may
    have any names, texts any length; an empty table gives an empty one.
    """
    columns = documents.columns
    sign = F.when(F.col("doc_id").isNotNull(), F.xxhash64("doc_id", "text"))
    other = F.when(F.col("doc_id").isNotNull(), F.xxhash64(F.lit("second"), "text", "doc_id"))
    found = similar_components(documents.select(sign.alias("doc_id"), "text"), k, num, den).filter("n_shingles > 0 AND doc_id IS NOT NULL")
    found = found.select(F.col("doc_id").alias("sign"), "component_id").distinct()
    keys = ["id", "sign", "other"]
    named = documents.select(F.col("doc_id").alias("id"), sign.alias("sign"), other.alias("other")).filter("id IS NOT NULL")
    counted = named.groupBy(*keys).agg(F.count(F.lit(1)).alias("n"))
    signed = stored(counted.join(found, "sign"), "signed")
    first = stored(signed.groupBy("component_id").agg(F.min(F.struct(*keys, "n")).alias("first")).select("first.*"), "first")
    gone = stored(signed.select(*keys).join(first, keys, "left_anti"), "gone")
    again = stored(first.filter("n > 1").select(*keys), "again")
    rows = documents.select(F.struct(*[F.col(f"`{c}`") for c in columns]).alias("row"), F.col("doc_id").alias("own_id"), sign.alias("own_sign"), other.alias("own_other"))

    def match(rows: DataFrame, keys: DataFrame, how: str) -> DataFrame:
        keys = F.broadcast(keys) if keys.count() <= BROADCAST_IDS else keys
        same = (F.col("own_id") == F.col("id")) & (F.col("own_sign") == F.col("sign")) & (F.col("own_other") == F.col("other"))
        return rows.join(keys, same, how)

    kept = match(rows, gone, "left_anti")
    if not again.isEmpty():
        pick = F.min_by("row", F.xxhash64(F.to_json("row"))).alias("row")
        one = match(rows, again, "left_semi").groupBy("own_id", "own_sign", "own_other").agg(pick)
        kept = match(kept, again, "left_anti").select("row").unionByName(one.select("row"))
    return kept.select(*[F.col(f"row.`{c}`").alias(c) for c in columns])

"""Operator 2, mixing sources to target weights (DataFrame functions only).

Every document has a place in [0, 16^18) from the md5 of its id and that of its text. Tokens are
summed by source and hash bucket (the first three hex digits of the place);
the running sum finds the bucket in which a source's budget runs out. Only
that bucket is refined, by the next three digits and so on to the last three,
so the thresholds are nested and no document is ever sorted. A document is in
the mix if its place lies below its source's threshold.

A source of size S with target t is taken ``floor(t / S)`` times as a whole and
once more below the threshold of what is left. Sources weigh by their order
(code points, null last); targets that pass ``limit`` times a source's size
stop there and the excess goes to the others by weight.

Defined cases: null text has size 0; documents of size 0 are taken 0 words; a
null id is an id like any other; a null source is a source; an empty table gives
an empty mix. Rows that share an id part by their texts; rows that repeat both
share a place and go in or out together, in if that is nearer.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from quotepanel.llm.common import WORD, lookup_join
from quotepanel.session import stored

WEIGHTS = (5, 2, 1)
SHARE = 1.5
LIMIT = 2
DIGITS, LEVELS = 3, 3
PLACED_BY = ("doc_id", "text")


def word_count(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def _place(*parts: Column) -> Column:
    return F.concat(*[F.substring(F.md5(F.coalesce(x.cast("string"), F.lit("")).cast("binary")), 1, DIGITS * LEVELS) for x in parts])


def _key(source: Column) -> Column:
    """Non-null key of a source; null comes after every string."""
    return F.when(source.isNull(), F.lit("1")).otherwise(F.concat(F.lit("0"), source))


def targets(sized: DataFrame, weights=WEIGHTS, share: float = SHARE, limit: int = LIMIT) -> DataFrame:
    """key, source_size, target from rows (key, size); one row per source."""
    total = sized.groupBy("key").agg(F.sum("size").alias("source_size"))
    in_order = Window.orderBy("key")
    weight = F.element_at(F.array(*[F.lit(float(w)) for w in weights]), (F.row_number().over(in_order) - 1) % len(weights) + 1)
    by_fill = Window.orderBy("fill", "key")
    before = by_fill.rowsBetween(Window.unboundedPreceding, -1)
    after = by_fill.rowsBetween(0, Window.unboundedFollowing)
    everything = Window.partitionBy()
    filled = (
        total.withColumn("weight", weight)
        .withColumn("cap", F.col("source_size").cast("double") * limit)
        .withColumn("fill", F.col("cap") / F.col("weight"))
        .withColumn("want", F.sum("source_size").over(everything).cast("double") * share)
        .withColumn("left_over", F.col("want") - F.coalesce(F.sum("cap").over(before), F.lit(0.0)))
        .withColumn("weights", F.sum("weight").over(after))
        .withColumn("open", F.col("left_over") * F.col("weight") <= F.col("cap") * F.col("weights"))
        .withColumn("level", F.first(F.when(F.col("open"), F.col("left_over") / F.col("weights")), ignorenulls=True).over(by_fill.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)))
    )
    return filled.select("key", "source_size", F.coalesce(F.least("cap", F.col("weight") * F.col("level")), F.col("cap")).alias("target"))


def thresholds(sized: DataFrame, goal: DataFrame, levels: int = LEVELS * len(PLACED_BY)) -> DataFrame:
    """Adds to ``goal``: whole (times a source goes in whole), edge and edge_in (places below ``edge`` go in once more)."""
    whole = F.when(F.col("source_size") > 0, F.floor(F.col("target") / F.col("source_size"))).otherwise(F.lit(0)).cast("long")
    n_sources = goal.count()
    cut = goal.withColumn("whole", whole).withColumn("budget", F.col("target") - F.col("whole") * F.col("source_size")).withColumn("edge", F.lit(""))
    for level in range(levels):
        cut = stored(cut, "mixing-edges") if level == LEVELS else cut  # a level names the one before it thrice
        digits = F.substring("place", level * DIGITS + 1, DIGITS)
        inside = lookup_join(sized, cut.select(F.col("key").alias("_key"), F.col("edge").alias("_edge")), F.col("key") == F.col("_key"), n_sources)
        inside = inside.filter(F.substring("place", 1, level * DIGITS) == F.col("_edge")) if level else inside
        by_bucket = inside.groupBy("key", digits.alias("bucket")).agg(F.sum("size").alias("n"))
        running = Window.partitionBy("key").orderBy("bucket")
        steps = by_bucket.withColumn("upto", F.sum("n").over(running))
        budget = cut.select(F.col("key").alias("_key"), "budget")
        crossed = (
            steps.join(budget, F.col("key") == F.col("_key"))
            .filter(F.col("upto") > F.col("budget"))
            .groupBy("key")
            .agg(F.min_by(F.struct("bucket", "n", "upto"), "bucket").alias("at"))
            .select(F.col("key").alias("_key"), "at")
        )
        cut = (
            cut.join(crossed, F.col("key") == F.col("_key"), "left")
            .withColumn("budget", F.col("budget") - F.coalesce(F.col("at.upto") - F.col("at.n"), F.lit(0)))
            .withColumn("edge", F.concat("edge", F.coalesce(F.col("at.bucket"), F.lit(""))))
            .withColumn("last", F.col("at.n"))
            .drop("_key", "at")
        )
    return cut.select("key", "source_size", "target", "whole", "edge", F.coalesce(F.col("budget") * 2 >= F.col("last"), F.lit(False)).alias("edge_in"))


def keyed(documents: DataFrame, *keep: Column) -> DataFrame:
    place = _place(*[F.col(c) for c in PLACED_BY])
    return documents.select(*keep, _key(F.col("source")).alias("key"), word_count(F.col("text")).alias("size"), place.alias("place"))


def cuts(sized: DataFrame, weights=WEIGHTS, share: float = SHARE, limit: int = LIMIT) -> DataFrame:
    goal = stored(targets(sized, weights, share, limit), "mixing-targets")
    return stored(thresholds(sized, goal), "mixing-cuts")


def _times(rows: DataFrame, cut: DataFrame) -> DataFrame:
    """``rows`` with source_size, target and times (how often the mix takes the row)."""
    columns = [F.col("key").alias("_key"), "source_size", "target", "whole", "edge", "edge_in"]
    joined = lookup_join(rows, cut.select(*columns), F.col("key") == F.col("_key"), cut.count())
    below = (F.col("place") < F.col("edge")) | (F.col("edge_in") & (F.col("place") == F.col("edge")))
    times = F.when(F.col("size") > 0, F.col("whole") + below.cast("long")).otherwise(F.lit(0).cast("long"))
    return joined.withColumn("times", times)


def mixture(documents: DataFrame, weights=WEIGHTS, share: float = SHARE, limit: int = LIMIT) -> DataFrame:
    """doc_id, size, source_size, target, taken for each document; sizes are counted once and written."""
    sized = stored(keyed(documents, F.col("doc_id")), "mixing-sizes")
    taken = _times(sized, cuts(sized, weights, share, limit))
    return taken.select("doc_id", "size", "source_size", "target", (F.col("size") * F.col("times")).alias("taken"))


def mixed(documents: DataFrame, weights=WEIGHTS, share: float = SHARE, limit: int = LIMIT) -> DataFrame:
    """The documents of the mix, those taken twice as two rows; all columns stay."""
    sized = stored(keyed(documents), "mixing-sizes")
    whole_row = F.struct(*[F.col(f"`{c}`") for c in documents.columns]).alias("row")
    rows = _times(keyed(documents, whole_row), cuts(sized, weights, share, limit))
    copies = F.explode(F.sequence(F.lit(1), F.col("times").cast("int")))
    return rows.filter(F.col("times") > 0).select("row", copies.alias("copy")).select("row.*")

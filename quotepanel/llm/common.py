"""Small helpers that several operators share."""

from __future__ import annotations

from collections.abc import Callable, Iterator
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from quotepanel.session import shared_folder

#: A word is a run of bytes other than these six.
WORD = r"[^\x20\x09-\x0D]+"
SEPARATORS = (0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D)

#: A lookup table of at most this many rows may be broadcast; a larger one is joined by shuffle.
BROADCAST_ROWS = 20_000


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def passed(columns: list[str], *taken: str) -> list[str]:
    """The columns that pass through: all but those that the operator reads or makes; names differ in more than case."""
    names = {name.lower() for name in taken}
    return [c for c in columns if c.lower() not in names]


def as_row(columns: list[str]) -> Column:
    """Columns as one struct ``row``, so that none of them can clash with what an operator names."""
    return F.struct(*[F.col(f"`{c}`") for c in columns]).alias("row")


def unpacked(columns: list[str]) -> list[Column]:
    return [F.col(f"row.`{c}`").alias(c) for c in columns]


def held_out() -> Column:
    """True for the rows that no model may learn from."""
    return F.coalesce(F.crc32(F.col("doc_id").cast("string").cast("binary")) % 4 == 2, F.lit(False))


class Scratch:
    """Written tables of one operator that go once its result is written."""

    def __init__(self, spark: SparkSession):
        self.spark, self.folders = spark, []

    def stored(self, rows: DataFrame, purpose: str) -> DataFrame:
        path = shared_folder(self.spark, purpose)
        self.folders.append(path)
        rows.write.parquet(path)
        return self.spark.read.schema(rows.schema).parquet(path)

    def clear(self) -> None:
        context = self.spark.sparkContext
        for path in self.folders:
            folder = context._jvm.org.apache.hadoop.fs.Path(path)
            folder.getFileSystem(context._jsc.hadoopConfiguration()).delete(folder, True)
        self.folders = []


def lookup_join(rows: DataFrame, lookup: DataFrame, on: Column, size: int) -> DataFrame:
    """Left join to a stored table of ``size`` rows, broadcast only if that is few."""
    return rows.join(F.broadcast(lookup) if size <= BROADCAST_ROWS else lookup, on, "left")


def map_batches(rows: DataFrame, run: Callable[[Iterator], Iterator], schema: str) -> DataFrame:
    return rows.mapInArrow(run, schema)


def union_all(frames: list[DataFrame]) -> DataFrame:
    return reduce(DataFrame.unionByName, frames)

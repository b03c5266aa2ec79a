"""Operator 6, sharding by a permutation-filled lookup table (DataFrame functions only).

A table of ``slots`` places, a prime number, is filled once: the shards take
turns, and in its turn a shard claims the first free slot of its own
preference order, ``(offset + j skip) mod slots``, where offset and skip come
from a hash of its name. So every shard gets as many slots as any other, give
or take one, and a shard that joins or leaves moves few others. The table has
a fixed size, whatever the input, and is broadcast: a row's shard is one
lookup by the hash of its key.

A key with a third of all rows is in one shard by the nature of placement by
key; ``place`` takes any columns as key, so a salted key spreads it. Nothing
is shuffled.

Defined cases: a null key is a key of its own, rows with equal keys get the
same shard, an empty table stays empty. Columns called ``slot`` or ``shard``
give way to the new ones. Names of shards must differ; their order is that of
the turns.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from quotepanel.llm.common import lookup_join
from quotepanel.session import stored

SLOTS = 4099
SHARDS = 32


def hash_of(text: Column) -> Column:
    """48 bits of a text's md5."""
    return F.conv(F.substring(F.md5(F.coalesce(text, F.lit("")).cast("binary")), 1, 12), 16, 10).cast("long")


def shard_names(n: int = SHARDS) -> list[str]:
    return [f"shard-{i:05d}" for i in range(n)]


def lookup_table(spark: SparkSession, names: Sequence[str], slots: int = SLOTS) -> DataFrame:
    """slot, shard (index into ``names``): ``slots`` rows, made by one expression."""
    if len(set(names)) != len(names) or not 0 < len(names) <= slots:
        raise ValueError("different names are needed, at most one per slot")
    if slots < 3 or any(slots % d == 0 for d in range(2, int(slots**0.5) + 1)):
        raise ValueError("the number of slots must be a prime over 2")
    n = len(names)
    preference = F.array(
        *[
            F.struct(
                (hash_of(F.lit(f"{name} offset")) % slots).cast("int").alias("offset"), (hash_of(F.lit(f"{name} skip")) % (slots - 1) + 1).cast("int").alias("skip")
            )
            for name in names
        ]
    )
    one = spark.range(1).select(preference.alias("preference"))

    def claim(state: Column, turn: Column) -> Column:
        shard = (turn % n).cast("int")
        own = F.get("preference", shard)

        def slot(j: Column) -> Column:
            return ((own.offset + j.cast("long") * own.skip) % slots).cast("int")

        tries = F.sequence(F.get(state.tried, shard), F.lit(slots - 1))
        at = F.get(F.filter(tries, lambda j: F.get(state.filled, slot(j)) < 0), F.lit(0))

        def put(array: Column, place: Column, value: Column) -> Column:
            return F.concat(F.slice(array, F.lit(1), place), F.array(value), F.slice(array, place + 2, F.size(array)))

        # One struct holds what the claim needs, so that it is found once.
        found = F.array(F.struct(at.alias("at"), slot(at).alias("slot")))
        return F.get(
            F.transform(found, lambda f: F.struct(put(state.filled, f.slot, shard).alias("filled"), put(state.tried, shard, f.at + 1).alias("tried"))), F.lit(0)
        )

    start = F.struct(F.array_repeat(F.lit(-1), slots).alias("filled"), F.array_repeat(F.lit(0), n).alias("tried"))
    filled = F.aggregate(F.sequence(F.lit(0), F.lit(slots - 1)), start, claim, lambda state: state.filled)
    return one.select(F.posexplode(filled).alias("slot", "shard"))


def place(rows: DataFrame, key: Column, names: Sequence[str], slots: int = SLOTS) -> DataFrame:
    """``rows`` with slot and shard (long)."""
    table = stored(lookup_table(rows.sparkSession, names, slots), "shard-table")
    table = table.select(F.col("slot").cast("long").alias("_slot"), F.col("shard").cast("long").alias("shard"))
    own = F.struct(*[F.col(f"`{c}`") for c in rows.columns]).alias("row")
    keyed = rows.select(own, (hash_of(key.cast("string")) % slots).alias("slot"))
    placed = lookup_join(keyed, table, F.col("slot") == F.col("_slot"), slots)
    kept = [F.col(f"row.`{c}`") for c in rows.columns if c.lower() not in ("slot", "shard")]
    return placed.select(*kept, "slot", "shard")

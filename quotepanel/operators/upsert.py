"""Keyed upsert: replace matched rows whole, insert the rest, never delete."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from quotepanel.operators.quality import unique_key
from quotepanel.schemas import KEYS


class DuplicateKeys(ValueError):
    """The source of an upsert has more than one row for a key."""


def upsert(target: DataFrame, source: DataFrame, keys: list[str] = KEYS) -> DataFrame:
    """Rows of ``source`` plus the rows of ``target`` without a match in it."""
    kept = target.join(source.select(*keys), keys, "left_anti")
    return source.select(*target.columns).unionByName(kept.select(*target.columns))


def upsert_once(target: DataFrame, source: DataFrame, keys: list[str] = KEYS) -> DataFrame:
    """As ``upsert`` for fixed-width columns and keys that are not null, with ``source`` evaluated once and no join.

    One keyed aggregate over both: values of fixed width stay in its hash map.
    """
    others = [c for c in target.columns if c not in keys]
    new = F.col("_source")
    rows = target.withColumn("_source", F.lit(False)).unionByName(source.select(*target.columns).withColumn("_source", F.lit(True)))
    found = rows.groupBy(*keys).agg(F.max(new).alias("_any"), *[x for c in others for x in (F.max(F.when(new, F.col(c))).alias(f"_new_{c}"), F.max(c).alias(f"_old_{c}"))])
    chosen = {c: F.when(F.col("_any"), F.col(f"_new_{c}")).otherwise(F.col(f"_old_{c}")).alias(c) for c in others}
    return found.select(*[chosen.get(c, F.col(c)) for c in target.columns])


def guard_unique(source: DataFrame, keys: list[str] = KEYS) -> DataFrame:
    """``source`` itself, after a check that its keys are unique."""
    if not unique_key(source, keys).isEmpty():
        raise DuplicateKeys(f"upsert source has duplicate {keys}")
    return source


def guarded_upsert(target: DataFrame, source: DataFrame, keys: list[str] = KEYS) -> DataFrame:
    return upsert(target, guard_unique(source, keys), keys)


def upsert_newest(target: DataFrame, source: DataFrame, by: str, keys: list[str] = KEYS) -> DataFrame:
    """As ``upsert``, but a matched row stays if its ``by`` is later than the source's."""
    others = [c for c in target.columns if c not in (*keys, by)]
    rows = target.withColumn("_source", F.lit(False)).unionByName(source.select(*target.columns).withColumn("_source", F.lit(True)))
    newest = rows.groupBy(*keys).agg(F.max(F.struct(by, "_source", *others)).alias("newest"))
    return newest.select(*[F.col(c) if c in keys else F.col(f"newest.{c}") for c in target.columns])

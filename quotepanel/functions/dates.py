"""Date bounds that also prune folders.

Stored layers carry a ``bucket`` partition column: the year, month or day of
the row as digits. A bound on ``result_date`` alone would open every file; the
matching bound on ``bucket`` drops whole folders, also when the date is a
scalar subquery.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

BUCKET = "bucket"


def _bucket_of(day: Column) -> Column:
    # The stored text is a prefix of yyyyMMdd, whatever its grain.
    return F.left(F.date_format(day, "yyyyMMdd"), F.length(BUCKET))


def since(panel: DataFrame, day: Column) -> DataFrame:
    bounded = panel.filter(F.col("result_date") >= day)
    return bounded.filter(F.col(BUCKET) >= _bucket_of(day)) if BUCKET in panel.columns else bounded


def before(panel: DataFrame, day: Column) -> DataFrame:
    bounded = panel.filter(F.col("result_date") < day)
    return bounded.filter(F.col(BUCKET) <= _bucket_of(day)) if BUCKET in panel.columns else bounded


def until(panel: DataFrame, day: Column) -> DataFrame:
    bounded = panel.filter(F.col("result_date") <= day)
    return bounded.filter(F.col(BUCKET) <= _bucket_of(day)) if BUCKET in panel.columns else bounded


def after(panel: DataFrame, day: Column) -> DataFrame:
    bounded = panel.filter(F.col("result_date") > day)
    return bounded.filter(F.col(BUCKET) >= _bucket_of(day)) if BUCKET in panel.columns else bounded


def on(panel: DataFrame, day: Column) -> DataFrame:
    bounded = panel.filter(F.col("result_date") == day)
    return bounded.filter(F.col(BUCKET) == _bucket_of(day)) if BUCKET in panel.columns else bounded

"""What is kept beside each date bucket, so that loads and look-ups need not read the panel.

A frame of the mart reaches four rows back and a change four rows on, so the
first and last four quotes of a code stand for a whole bucket to any change
outside it.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from quotepanel.functions.dates import BUCKET
from quotepanel.operators.mart import MA_ROWS
from quotepanel.schemas import CODES, DATES, KEYS

EDGE = MA_ROWS - 1


def code_states(staging: DataFrame, bucket: Column) -> DataFrame:
    """One row per bucket and code; its quotes are at most one per calendar day of the bucket."""
    quotes = F.array_sort(F.collect_list(F.struct("result_date", "rate", "updated_at")))
    grouped = staging.groupBy(bucket.alias(BUCKET), "cur_unit").agg(
        F.max("cur_nm").alias("cur_nm"), F.count(F.lit(1)).alias("rows"), quotes.alias("quotes")
    )
    day = F.transform("quotes", lambda q: q["result_date"])
    # A date that stands there again, counted once however often it does.
    again = F.filter(day, lambda d, i: (i > 0) & d.eqNullSafe(F.get(day, i - 1)))
    few = F.size("quotes") <= 2 * EDGE
    ends = F.concat(F.slice("quotes", 1, EDGE), F.slice("quotes", -EDGE, EDGE))
    return grouped.select(
        BUCKET,
        "cur_unit",
        "cur_nm",
        "rows",
        F.size(F.array_distinct(again)).cast("long").alias("repeated"),
        F.when(few, F.col("quotes")).otherwise(ends).cast(CODES["quotes"].dataType).alias("quotes"),
    )


def date_states(mart: DataFrame) -> DataFrame:
    """One row per date: rows, codes that stand there more than once, last update."""
    by_key = mart.groupBy(*KEYS).agg(F.count(F.lit(1)).alias("rows"), F.max("updated_at").alias("updated_at"))
    by_date = by_key.groupBy("result_date").agg(
        F.sum("rows").alias("rows"), F.count_if(F.col("rows") > 1).alias("repeated"), F.max("updated_at").alias("updated_at")
    )
    return by_date.select(*DATES.names)


def edges(states: DataFrame) -> DataFrame:
    """The kept quotes as panel rows."""
    return states.select("cur_unit", F.explode("quotes").alias("quote")).select("quote.result_date", "cur_unit", "quote.rate", "quote.updated_at")


def names_of(states: DataFrame) -> DataFrame:
    """The name dimension: lexically greatest name per code."""
    return states.groupBy("cur_unit").agg(F.max("cur_nm").alias("cur_nm"))

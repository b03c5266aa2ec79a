"""STAGING -> MART: previous value, percent change, five-row moving average.

The windows partition by code. STAGING is unique on (date, code), so one code
has at most one row per calendar day: a few ten thousand rows for a century,
however many copies of a quote were landed. No code can outgrow one task.
"""

from __future__ import annotations

from collections.abc import Callable
from datetime import date

from pyspark.sql import Column, DataFrame, Window, WindowSpec, functions as F

from quotepanel.functions.dates import after, before, since, until
from quotepanel.operators.staging import stamp
from quotepanel.operators.upsert import upsert
from quotepanel.schemas import KEYS

# Moving-average length and rounding digits.
MA_ROWS = 5
DIGITS = 4

# Four rows of a weekday panel and some closed days, before and after a
# change; fewer are looked up.
LOOKBACK_DAYS = 14


def _by_code() -> WindowSpec:
    return Window.partitionBy("cur_unit").orderBy("result_date")


def _last_rows() -> WindowSpec:
    return _by_code().rowsBetween(-(MA_ROWS - 1), Window.currentRow)


def prev_rate(panel: DataFrame) -> DataFrame:
    """Rate of the previous row of the code, whatever the gap in days."""
    return panel.withColumn("prev_rate", F.lag("rate").over(_by_code()))


def _change(rate: Column, prev: Column) -> Column:
    return F.round(F.try_divide(rate - prev, prev) * 100, DIGITS)


def change_pct(panel: DataFrame) -> DataFrame:
    return prev_rate(panel).withColumn("change_pct", _change(F.col("rate"), F.col("prev_rate")))


def moving_average(panel: DataFrame) -> DataFrame:
    """Average of the last five rows; the first four average what exists."""
    return panel.withColumn("ma_5", F.round(F.avg("rate").over(_last_rows()), DIGITS))


def _windowed(panel: DataFrame, **extra: Column) -> DataFrame:
    # lag and avg share one sort and one exchange; the change is projected
    # from the finished lag so that it is not evaluated twice.
    return panel.withColumns(
        {
            "prev_rate": F.lag("rate").over(_by_code()),
            "ma_5": F.round(F.avg("rate").over(_last_rows()), DIGITS),
            **extra,
        }
    ).withColumn("change_pct", _change(F.col("rate"), F.col("prev_rate")))


def mart_daily(staging: DataFrame, run_ts=None) -> DataFrame:
    """Full recompute of the mart from the whole staging panel."""
    out = _windowed(staging.select(*KEYS, "rate"))
    return stamp(out.select(*KEYS, "rate", "prev_rate", "change_pct", "ma_5"), run_ts)


def rows_around(staging: DataFrame, first: date | Column, last: date | Column, days: int) -> DataFrame:
    """Staging rows from ``days`` before ``first`` to ``days`` after ``last``."""
    return until(since(staging, F.date_sub(F.lit(first), days)), F.date_add(F.lit(last), days))


def short_codes(near: DataFrame, changed: DataFrame, side: Column) -> DataFrame:
    """Changed codes with fewer rows on one ``side`` of the change than a frame reaches."""
    full = near.filter(side).groupBy("cur_unit").count().filter(F.col("count") >= MA_ROWS - 1)
    return changed.select("cur_unit").distinct().join(full, "cur_unit", "left_anti")


def short_before(near: DataFrame, changed: DataFrame, first: date | Column) -> DataFrame:
    return short_codes(near, changed, F.col("result_date") < F.lit(first))


def short_after(near: DataFrame, changed: DataFrame, last: date | Column) -> DataFrame:
    return short_codes(near, changed, F.col("result_date") > F.lit(last))


def _nearest(rows: DataFrame, codes: DataFrame, order: Column) -> DataFrame:
    """The first four rows per given code."""
    by_code = Window.partitionBy("cur_unit").orderBy(order)
    nth = rows.join(codes, "cur_unit", "left_semi").withColumn("_nth", F.row_number().over(by_code))
    return nth.filter(F.col("_nth") < MA_ROWS).drop("_nth")


def older_rows(staging: DataFrame, codes: DataFrame, first: date | Column, days: int) -> DataFrame:
    """The last four rows per given code from before ``rows_around``."""
    return _nearest(before(staging, F.date_sub(F.lit(first), days)), codes, F.desc("result_date"))


def newer_rows(staging: DataFrame, codes: DataFrame, last: date | Column, days: int) -> DataFrame:
    """The first four rows per given code from after ``rows_around``."""
    return _nearest(after(staging, F.date_add(F.lit(last), days)), codes, F.asc("result_date"))


def affected_rows(panel: DataFrame, changed: DataFrame, run_ts=None, hit: Column | None = None) -> DataFrame:
    """Mart rows that a change of ``changed`` keys alters.

    A changed key alters its own row and the next four rows of its code.
    ``panel`` must hold, for each changed code, every row from the first
    change to the last and four rows before and after. Where a column of the panel tells its
    changed rows, ``hit`` saves the join that finds them.
    """
    flagged = panel.join(changed.select("cur_unit"), "cur_unit", "left_semi")
    if hit is None:
        hits = changed.select(*KEYS).distinct().withColumn("_hit", F.lit(True))
        flagged = flagged.join(hits, KEYS, "left")
    else:
        flagged = flagged.withColumn("_hit", hit)
    flagged = flagged.select(*KEYS, "rate", "_hit")
    out = _windowed(flagged, _near=F.max("_hit").over(_last_rows())).filter("_near")
    return stamp(out.select(*KEYS, "rate", "prev_rate", "change_pct", "ma_5"), run_ts)


def recompute(staging: DataFrame, changed: DataFrame, run_ts=None, lookback_days: int = LOOKBACK_DAYS) -> DataFrame:
    """Affected mart rows, reading history only around the change.

    Rows further away are needed only for codes with fewer than four rows on
    that side of it, and then only the nearest four.
    """
    first, last = changed.agg(F.min("result_date")).scalar(), changed.agg(F.max("result_date")).scalar()
    near = rows_around(staging, first, last, lookback_days)
    older = older_rows(staging, short_before(near, changed, first), first, lookback_days)
    newer = newer_rows(staging, short_after(near, changed, last), last, lookback_days)
    columns = [*KEYS, "rate"]
    panel = near.select(columns).unionByName(older.select(columns)).unionByName(newer.select(columns))
    return affected_rows(panel, changed, run_ts)


def reach(near: DataFrame, changed: DataFrame, first: date | Column, last: date | Column) -> DataFrame:
    """Changed codes with the sides on which ``near`` has fewer rows than a frame reaches; none if all have enough."""
    around = near.groupBy("cur_unit").agg(
        F.count_if(F.col("result_date") < F.lit(first)).alias("older"), F.count_if(F.col("result_date") > F.lit(last)).alias("newer")
    )
    counts = changed.select("cur_unit").distinct().join(around, "cur_unit", "left")
    short = [(F.coalesce(side, F.lit(0)) < MA_ROWS - 1).alias(f"short_{side}") for side in ("older", "newer")]
    return counts.select("cur_unit", *short).filter("short_older OR short_newer")


def nearest_rows(rows: DataFrame, codes: DataFrame, newer: bool) -> DataFrame:
    """The four newest rows (or, if ``newer``, the four oldest) per given code."""
    return _nearest(rows, codes, F.asc("result_date") if newer else F.desc("result_date"))


def affected_near(whole: DataFrame, edges: DataFrame, changed: DataFrame, hit: Column, run_ts=None) -> DataFrame:
    """Affected mart rows from the changed buckets as wholes and the kept edges of the buckets around them.

    ``hit`` tells the changed rows of ``whole``. Of a bucket that is not whole
    the rows next to its neighbours are there, so every frame that reaches a
    changed row is complete.
    """
    columns = [*KEYS, "rate", "_hit"]
    panel = whole.withColumn("_hit", hit).select(columns).unionByName(edges.withColumn("_hit", F.lit(False)).select(columns))
    return affected_rows(panel, changed, run_ts, F.col("_hit"))


def mart_incremental(
    staging: DataFrame,
    changed: DataFrame,
    mart: DataFrame,
    run_ts=None,
    store: Callable[[DataFrame], DataFrame] = lambda rows: rows,
) -> DataFrame:
    """``mart`` with the affected rows replaced; equals ``mart_daily(staging)``.

    The upsert uses the affected rows twice. ``store`` may write them to a
    table and read them back, so that they are computed once.
    """
    return upsert(mart, store(recompute(staging, changed, run_ts)))

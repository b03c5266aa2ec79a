"""KPI cards, series, period returns and the period summary."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window, functions as F

from quotepanel.functions.numeric import pct_over, settled
from quotepanel.functions.text import delta_text, digits, fmt_num, fmt_pct, label
from quotepanel.operators.period import DEFAULT_CODES, DEFAULT_PERIOD, period, select, snapshot

# Fixed values.
RANK_ROWS = 4
FLAT_POSITION = 50.0


def kpi(
    mart: DataFrame, selected: list[str] | None = None, k: int | None = None, defaults: list[str] = DEFAULT_CODES
) -> DataFrame:
    """Latest values of the active codes, or the first ``k`` of them, with distance to ``ma_5``."""
    return select(snapshot(mart), selected, defaults, first=k, among=mart).select(
        "cur_unit",
        "rate",
        "prev_rate",
        (F.col("rate") - F.col("prev_rate")).alias("diff"),
        "change_pct",
        "ma_5",
        pct_over(F.col("rate"), F.col("ma_5")).alias("disparity"),
    )


def kpi_cards(
    panel: DataFrame, selected: list[str] | None = None, k: int | None = None, defaults: list[str] = DEFAULT_CODES
) -> DataFrame:
    """The same as display text; ``panel`` is the enriched mart."""
    rate, ma, dec = F.col("rate"), F.col("ma_5"), digits(F.col("rate"))
    return select(snapshot(panel), selected, defaults, first=k, among=panel).select(
        label(F.col("cur_unit"), F.col("cur_nm")).alias("label"),
        fmt_num(rate, dec).alias("rate_text"),
        delta_text(rate, F.col("prev_rate"), F.col("change_pct"), dec).alias("delta_text"),
        fmt_num(ma, dec).alias("ma_text"),
        fmt_pct(pct_over(rate, ma)).alias("disparity_text"),
    )


def series(
    mart: DataFrame,
    selected: list[str] | None = None,
    n: int | None = DEFAULT_PERIOD,
    normalise: bool = False,
    defaults: list[str] = DEFAULT_CODES,
) -> DataFrame:
    """Rate and moving average per date; normalised, first rate in period = 100."""
    # The selection comes first so that the window sees the chosen codes only.
    chosen = period(select(mart, selected, defaults), n, among=mart)
    rate, ma = F.col("rate"), F.col("ma_5")
    if not normalise:
        return chosen.select("result_date", "cur_unit", rate.alias("y"), ma.alias("y_ma"))
    start = Window.partitionBy("cur_unit").orderBy("result_date").rowsBetween(Window.unboundedPreceding, 0)
    based = chosen.withColumn("base", F.first("rate").over(start))
    base = F.col("base")
    return based.select(
        "result_date",
        "cur_unit",
        F.when(base == 0, rate).otherwise(F.try_divide(rate, base) * 100).alias("y"),
        F.when(base == 0, ma).otherwise(F.try_divide(ma, base) * 100).alias("y_ma"),
    )


def returns(mart: DataFrame, n: int | None = DEFAULT_PERIOD) -> DataFrame:
    """Last over first rate in the period per code; codes starting at 0 are skipped."""
    ends = (
        period(mart, n)
        .groupBy("cur_unit")
        .agg(
            F.min_by("rate", "result_date").alias("first"),
            F.max_by("rate", "result_date").alias("last"),
        )
        .filter(F.col("first") != 0)
    )
    return ends.select("cur_unit", F.bround(pct_over(F.col("last"), F.col("first")), 2).alias("return_pct"))


def top_bottom(ranked: DataFrame, k: int = RANK_ROWS) -> DataFrame:
    """Best and worst ``k`` of a ranking, each row once; ties go by code."""
    best = ranked.orderBy(F.desc("return_pct"), F.asc("cur_unit")).limit(k)
    worst = ranked.orderBy(F.asc("return_pct"), F.desc("cur_unit")).limit(k)
    return best.union(worst).distinct()


def summary(
    mart: DataFrame,
    selected: list[str] | None = None,
    n: int | None = DEFAULT_PERIOD,
    defaults: list[str] = DEFAULT_CODES,
) -> DataFrame:
    """Level, spread and position in range per active code."""
    return summarise(period(select(mart, selected, defaults), n, among=mart))


def summarise(rows: DataFrame) -> DataFrame:
    """``summary`` of every code in ``rows``, in one aggregate."""
    stats = rows.groupBy("cur_unit").agg(
        F.max_by("rate", "result_date").alias("last"),
        F.max("rate").alias("high"),
        F.min("rate").alias("low"),
        F.bround(settled(F.avg("rate")), 4).alias("mean"),
        F.bround(settled(F.stddev_samp("rate")), 4).alias("stddev"),
    )
    last, high, low = F.col("last"), F.col("high"), F.col("low")
    position = F.when(high == low, FLAT_POSITION).otherwise(F.try_divide(last - low, high - low) * 100)
    return stats.select(
        "cur_unit",
        "last",
        "high",
        "low",
        "mean",
        "stddev",
        F.bround(pct_over(high, low), 2).alias("range_pct"),
        F.bround(position, 1).alias("position"),
    )

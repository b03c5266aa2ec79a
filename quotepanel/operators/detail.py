"""Cross rates, disparity signals, direction streaks and the change heatmap."""

from __future__ import annotations

from datetime import date

from pyspark.sql import Column, DataFrame, Window, functions as F

from quotepanel.functions.numeric import pct_over, per_unit, plain_code
from quotepanel.functions.text import digits, fmt_num, fmt_pct, iso_date, label
from quotepanel.operators.period import (
    DEFAULT_CODES,
    DEFAULT_PERIOD,
    active_codes,
    period,
    recent_dates,
    select,
    snapshot,
)

# Fixed values.
DEFAULT_BASE = "USD"
HOT, COLD = 0.35, -0.35
HEATMAP_DATES = 30


def _base_code(mart: DataFrame, base: str | None) -> Column:
    if base is not None:
        return F.lit(base)
    preferred = F.max(F.when(F.col("cur_unit") == DEFAULT_BASE, F.col("cur_unit")))
    return mart.agg(F.coalesce(preferred, F.min("cur_unit"))).scalar()


def _cross(joined: DataFrame) -> DataFrame:
    def ratio(top: str, bottom: str) -> Column:
        return F.try_divide(per_unit(F.col(top), F.col("base")), per_unit(F.col(bottom), F.col("quote")))

    crossed = joined.filter(F.col("rate") != 0).withColumns(
        {"cross": ratio("base_rate", "rate"), "cross_prev": ratio("base_prev", "prev_rate")}
    )
    return crossed.select(
        "result_date",
        "base",
        "quote",
        "cross",
        "cross_prev",
        pct_over(F.col("cross"), F.col("cross_prev")).alias("change_pct"),
    )


def cross(mart: DataFrame, base: str | None = None, latest_only: bool = True) -> DataFrame:
    """One base code against every other code quoted on the same date.

    The base side has one row per date; Spark broadcasts it while it is small.
    The output has at most one row per panel row.
    """
    rows = snapshot(mart) if latest_only else mart
    code = _base_code(mart, base)
    bases = rows.filter(F.col("cur_unit") == code).select(
        "result_date",
        F.col("cur_unit").alias("base"),
        F.col("rate").alias("base_rate"),
        F.col("prev_rate").alias("base_prev"),
    )
    quotes = rows.select("result_date", F.col("cur_unit").alias("quote"), "rate", "prev_rate")
    joined = quotes.join(bases, "result_date").filter(F.col("base") != F.col("quote"))
    return _cross(joined)


def cross_pairs(mart: DataFrame, pairs: list[tuple[str, str]], latest_only: bool = False) -> DataFrame:
    """Requested (base, quote) pairs on the same date.

    Each panel row meets only the pairs that ask for its code; how the lists
    are joined is left to Spark.
    """
    rows = snapshot(mart) if latest_only else mart
    wanted = sorted({(b, q) for b, q in pairs if b != q})
    base_codes = sorted({b for b, _ in wanted})
    asked = mart.sparkSession.createDataFrame(wanted, "base string, quote string")
    bases = rows.filter(F.col("cur_unit").isin(base_codes)).select(
        "result_date",
        F.col("cur_unit").alias("base"),
        F.col("rate").alias("base_rate"),
        F.col("prev_rate").alias("base_prev"),
    )
    quotes = rows.filter(F.col("cur_unit").isin(sorted({q for _, q in wanted}))).select(
        "result_date", F.col("cur_unit").alias("quote"), "rate", "prev_rate"
    )
    return _cross(quotes.join(asked, "quote").join(bases, ["result_date", "base"]))


def cross_text(crossed: DataFrame) -> DataFrame:
    """``1 USD = 140.0000 JPY`` and the change on the previous value."""
    return crossed.select(
        "result_date",
        F.concat(
            F.lit("1 "), plain_code(F.col("base")), F.lit(" = "),
            fmt_num(F.col("cross"), 4), F.lit(" "), plain_code(F.col("quote")),
        ).alias("text"),
        fmt_pct(F.col("change_pct")).alias("change_text"),
    )


def _signal(disparity: Column, hot: float, cold: float) -> Column:
    return (
        F.when(disparity.isNull(), "insufficient")
        .when(disparity > hot, "hot")
        .when(disparity < cold, "cold")
        .otherwise("neutral")
    )


def signals(
    mart: DataFrame,
    selected: list[str] | None = None,
    hot: float = HOT,
    cold: float = COLD,
    defaults: list[str] = DEFAULT_CODES,
) -> DataFrame:
    """Distance of the latest rate from its moving average, with its band."""
    return signals_of(select(snapshot(mart), selected, defaults, among=mart), hot, cold)


def signals_of(latest_rows: DataFrame, hot: float = HOT, cold: float = COLD) -> DataFrame:
    disparity = pct_over(F.col("rate"), F.col("ma_5"))
    return latest_rows.select(
        "cur_unit", "rate", "ma_5", disparity.alias("disparity"), _signal(disparity, hot, cold).alias("signal")
    )


def streak(
    mart: DataFrame,
    selected: list[str] | None = None,
    n: int | None = DEFAULT_PERIOD,
    defaults: list[str] = DEFAULT_CODES,
) -> DataFrame:
    """Signed length of the latest run of rises or falls per active code."""
    return streak_of(period(select(mart, selected, defaults), n, among=mart))


def streak_of(rows: DataFrame) -> DataFrame:
    """Streak of every code in ``rows``.

    Read from the newest row back, flat moves before the first real one are
    skipped; after it, a flat or opposite move ends the streak. All three
    windows share one newest-first sort of one code's dated rows.
    """
    newest_first = Window.partitionBy("cur_unit").orderBy(F.desc("result_date"))
    so_far = newest_first.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    sign = F.col("sign")
    marked = (
        rows.select("cur_unit", "result_date", "rate")
        .withColumn("sign", F.signum(F.col("rate") - F.lead("rate").over(newest_first)).cast("int"))
        .withColumn("direction", F.first(F.when(sign != 0, sign), ignorenulls=True).over(so_far))
        .withColumn("ended", F.max(sign != F.col("direction")).over(so_far))
    )
    running = F.col("direction").isNotNull() & ~F.coalesce("ended", F.lit(False))
    return marked.groupBy("cur_unit").agg(
        F.coalesce(F.sum(F.when(running, sign)), F.lit(0)).cast("long").alias("streak")
    )


def signal_table(
    panel: DataFrame,
    selected: list[str] | None = None,
    n: int | None = DEFAULT_PERIOD,
    defaults: list[str] = DEFAULT_CODES,
) -> DataFrame:
    """Signals and streaks of the active codes as display text."""
    rate, ma, dec = F.col("rate"), F.col("ma_5"), digits(F.col("rate"))
    disparity = pct_over(rate, ma)
    days = F.concat(F.abs("streak"), F.lit(" days"))
    latest_rows = select(snapshot(panel), selected, defaults, among=panel)
    return latest_rows.join(streak(panel, selected, n, defaults), "cur_unit", "left").select(
        label(F.col("cur_unit"), F.col("cur_nm")).alias("label"),
        fmt_num(rate, dec).alias("rate_text"),
        fmt_num(ma, dec).alias("ma_text"),
        fmt_pct(disparity).alias("disparity_text"),
        _signal(disparity, HOT, COLD).alias("signal"),
        F.when(F.col("streak") > 0, F.concat(F.lit("up "), days))
        .when(F.col("streak") < 0, F.concat(F.lit("down "), days))
        .otherwise("-")
        .alias("streak_text"),
    )


def heatmap(
    mart: DataFrame,
    selected: list[str] | None = None,
    days: int = HEATMAP_DATES,
    defaults: list[str] = DEFAULT_CODES,
) -> DataFrame:
    """Change per active code on the last ``days`` dates, long form."""
    return period(select(mart, selected, defaults), days, among=mart).select("result_date", "cur_unit", "change_pct")


def heatmap_wide(
    mart: DataFrame,
    selected: list[str] | None = None,
    days: int = HEATMAP_DATES,
    columns: list[str] | None = None,
    defaults: list[str] = DEFAULT_CODES,
) -> DataFrame:
    """One row per active code and one ``yyyy-MM-dd`` column per date.

    The date columns may be passed; otherwise at most ``days`` dates are
    looked up. Codes without data keep a row of NULLs.
    """
    if columns is None:
        columns = [str(row["result_date"]) for row in recent_dates(mart, days).orderBy("result_date").collect()]
    chosen = select(mart, selected, defaults).filter(
        F.col("result_date").isin([date.fromisoformat(c) for c in columns])
    )
    wide = (
        chosen.withColumn("day", iso_date(F.col("result_date")))
        .groupBy("cur_unit")
        .pivot("day", columns)
        .agg(F.first("change_pct"))
    )
    return active_codes(mart, selected, defaults).join(wide, "cur_unit", "left").drop("ordinal")


def heatmap_labels(wide: DataFrame) -> DataFrame:
    """Date columns renamed ``MM/dd``, for display of under a year of dates."""
    return wide.withColumnsRenamed({c: f"{c[5:7]}/{c[8:10]}" for c in wide.columns if c != "cur_unit"})

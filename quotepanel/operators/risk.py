"""Move alerts, annualised volatility and change correlation."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from quotepanel.functions.numeric import settled
from quotepanel.functions.text import digits, fmt_num, fmt_pct, iso_date, label
from quotepanel.operators.period import DEFAULT_CODES, DEFAULT_PERIOD, code_list, period, select, snapshot

# Fixed values.
ALERT_THRESHOLD = 0.5
ALERT_ROWS = 40
SEVERE_FACTOR, WARNING_FACTOR = 2, 1.4
YEAR_ROWS = 250
HIGH_VOLATILITY, MID_VOLATILITY = 9, 6


def _alert_rows(mart: DataFrame, n: int | None, threshold: float, limit: int | None) -> DataFrame:
    move = F.abs("change_pct")
    grade = (
        F.when(move >= threshold * SEVERE_FACTOR, "severe")
        .when(move >= threshold * WARNING_FACTOR, "warning")
        .otherwise("caution")
    )
    graded = period(mart, n).filter(move >= threshold).withColumn("grade", grade)
    if limit is None:
        return graded
    return graded.orderBy(F.desc("result_date"), move.desc(), F.asc("cur_unit")).limit(limit)


def alerts(
    mart: DataFrame,
    n: int | None = DEFAULT_PERIOD,
    threshold: float = ALERT_THRESHOLD,
    limit: int | None = ALERT_ROWS,
) -> DataFrame:
    """Largest moves of any code in the period, newest date first; all without a limit."""
    return _alert_rows(mart, n, threshold, limit).select("result_date", "cur_unit", "rate", "change_pct", "grade")


def alert_table(
    panel: DataFrame, n: int | None = DEFAULT_PERIOD, threshold: float = ALERT_THRESHOLD, limit: int | None = ALERT_ROWS
) -> DataFrame:
    """Alerts of the enriched panel as display text, all without a limit; digits follow the latest rate."""
    shown = _alert_rows(panel, n, threshold, limit)
    alerted = shown.select("cur_unit").distinct()
    decimals = (
        snapshot(panel.select("result_date", "cur_unit", "rate"))
        .join(alerted, "cur_unit", "left_semi")
        .select("cur_unit", digits(F.col("rate")).alias("dec"))
    )
    return shown.join(decimals, "cur_unit", "left").select(
        iso_date(F.col("result_date")).alias("date_text"),
        label(F.col("cur_unit"), F.col("cur_nm")).alias("label"),
        fmt_num(F.col("rate"), F.coalesce("dec", F.lit(2))).alias("rate_text"),
        fmt_pct(F.col("change_pct")).alias("change_text"),
        "grade",
    )


def volatility(
    mart: DataFrame,
    selected: list[str] | None = None,
    n: int | None = DEFAULT_PERIOD,
    days: int = YEAR_ROWS,
    defaults: list[str] = DEFAULT_CODES,
) -> DataFrame:
    """Annualised deviation of the daily change per active code."""
    return volatility_of(period(select(mart, selected, defaults), n, among=mart), days)


def volatility_of(rows: DataFrame, days: int = YEAR_ROWS) -> DataFrame:
    """Volatility of every code in ``rows`` with at least two changes."""
    spread = (
        rows.groupBy("cur_unit")
        .agg(F.count("change_pct").alias("n"), (F.stddev_samp("change_pct") * days**0.5).alias("annual"))
        .filter(F.col("n") >= 2)
    )
    annual = F.col("annual")
    band = F.when(annual > HIGH_VOLATILITY, "high").when(annual > MID_VOLATILITY, "mid").otherwise("low")
    return spread.select("cur_unit", F.bround(settled(annual), 1).alias("vol"), band.alias("band"))


def change_matrix(
    mart: DataFrame,
    selected: list[str] | None = None,
    n: int | None = DEFAULT_PERIOD,
    k: int | None = None,
    defaults: list[str] = DEFAULT_CODES,
) -> DataFrame:
    """One row per date, one column of changes per code; ``k`` cuts the selection."""
    chosen = code_list(mart, selected, defaults, first=k)
    rows = period(mart.filter(F.col("cur_unit").isin(chosen)), n, among=mart)
    return rows.groupBy("result_date").pivot("cur_unit", chosen).agg(F.first("change_pct"))


def _pairs(rows: DataFrame, members: str) -> DataFrame:
    """Every pair ``a`` <= ``b`` of each row's sorted array, made inside the task."""
    first = rows.select(F.posexplode(members).alias("i", "a"), members)
    return first.select("a", F.explode(F.slice(members, F.col("i") + 1, F.size(members))).alias("b"))


def co_moments(rows: DataFrame) -> DataFrame:
    """Number of common dates, covariance and variances for each pair of codes a <= b that share one.

    Each date is one array of its changes, at most one per code; the pairs of a
    date are merged by a single keyed aggregate, which combines on the map side.
    """
    moved = rows.filter(F.col("change_pct").isNotNull()).groupBy("result_date")
    days = moved.agg(F.array_sort(F.collect_list(F.struct("cur_unit", "change_pct"))).alias("moves"))
    x, y = F.col("a.change_pct"), F.col("b.change_pct")
    by_pair = _pairs(days, "moves").groupBy(F.col("a.cur_unit").alias("code_a"), F.col("b.cur_unit").alias("code_b"))
    return by_pair.agg(
        F.count(F.lit(1)).alias("n"), F.covar_pop(x, y).alias("covar"), F.var_pop(x).alias("var_a"), F.var_pop(y).alias("var_b")
    )


def correlation(
    mart: DataFrame,
    selected: list[str] | None = None,
    n: int | None = DEFAULT_PERIOD,
    k: int | None = None,
    defaults: list[str] = DEFAULT_CODES,
) -> DataFrame:
    """Pearson correlation of daily changes, one row per pair a <= b.

    Pairs without a common date, or with a constant series, have NULL. The plan
    is the same for any number of codes.
    """
    chosen = code_list(mart, selected, defaults, first=k)
    rows = period(mart.filter(F.col("cur_unit").isin(chosen)), n, among=mart)
    # A constant series has no correlation, not even with itself.
    same = F.col("code_a") == F.col("code_b")
    spread = F.when(same, F.col("var_a")).otherwise(F.sqrt(F.col("var_a") * F.col("var_b")))
    value = F.try_divide(F.when(same, F.col("var_a")).otherwise(F.col("covar")), spread)
    found = co_moments(rows).select("code_a", "code_b", "n", value.alias("corr"))
    listed = mart.sparkSession.createDataFrame([(sorted(chosen),)], "codes array<string>")
    wanted = _pairs(listed, "codes").select(F.col("a").alias("code_a"), F.col("b").alias("code_b"))
    joined = wanted.join(found, ["code_a", "code_b"], "left")
    return joined.select("code_a", "code_b", F.coalesce("n", F.lit(0).cast("long")).alias("n"), "corr")


def correlation_matrix(
    mart: DataFrame,
    selected: list[str] | None = None,
    n: int | None = DEFAULT_PERIOD,
    k: int | None = None,
    defaults: list[str] = DEFAULT_CODES,
) -> DataFrame:
    """Square form: one row and one column per code, in selection order."""
    chosen = code_list(mart, selected, defaults, first=k)
    pairs = correlation(mart, chosen, n, k)
    both = F.array(
        F.struct(F.col("code_a").alias("cur_unit"), F.col("code_b").alias("other"), "corr"),
        F.struct(F.col("code_b").alias("cur_unit"), F.col("code_a").alias("other"), "corr"),
    )
    return pairs.select(F.inline(both)).groupBy("cur_unit").pivot("other", chosen).agg(F.first("corr"))

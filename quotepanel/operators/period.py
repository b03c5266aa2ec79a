"""Dates, period, selection, snapshot.

One-row lookups (latest date, period start) are scalar subqueries: the value
becomes a plain filter that Spark pushes below joins and aggregates into the
scan, with no join at all.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from quotepanel.functions.dates import on, since

# Rows per period choice, default period and default codes.
PERIODS = {"1w": 5, "1m": 22, "3m": 66, "1y": 250, "all": None}
DEFAULT_PERIOD = 66
DEFAULT_CODES = ["USD", "EUR", "JPY(100)", "CNH"]
FALLBACK_CODES = 4


def codes(panel: DataFrame) -> DataFrame:
    return panel.select("cur_unit").distinct()


def dates(panel: DataFrame) -> DataFrame:
    return panel.select("result_date").distinct()


def latest(panel: DataFrame) -> DataFrame:
    return panel.agg(F.max("result_date").alias("result_date"))


def recent_dates(panel: DataFrame, n: int) -> DataFrame:
    """The last ``n`` distinct dates over all codes."""
    return dates(panel).orderBy(F.desc("result_date")).limit(n)


def period(panel: DataFrame, n: int | None = DEFAULT_PERIOD, among: DataFrame | None = None) -> DataFrame:
    """Rows on the last ``n`` distinct dates of ``among`` (default: the panel).

    Those dates are exactly the ones from the n-th newest on, so one date
    bound replaces a join with the date list.
    """
    if n is None:
        return panel
    start = recent_dates(panel if among is None else among, n).agg(F.min("result_date")).scalar()
    return since(panel, start)


def snapshot(panel: DataFrame) -> DataFrame:
    """Rows of the latest date; codes not quoted on it are absent."""
    return on(panel, panel.agg(F.max("result_date")).scalar())


def active_codes(panel: DataFrame, selected: list[str] | None = None, defaults: list[str] = DEFAULT_CODES) -> DataFrame:
    """Selection as (``ordinal``, ``cur_unit``), at most a handful of rows.

    An empty selection falls back to the defaults that exist, in their order,
    else to the first four codes.
    """
    if selected:
        return panel.sparkSession.createDataFrame(list(enumerate(selected)), "ordinal int, cur_unit string")
    known = codes(panel)
    first = (
        known.orderBy("cur_unit").limit(FALLBACK_CODES).agg(F.sort_array(F.collect_list("cur_unit")).alias("first"))
    )
    found = known.filter(F.col("cur_unit").isin(defaults)).agg(F.collect_set("cur_unit").alias("found"))
    wanted = F.filter(F.array(*[F.lit(c) for c in defaults]), lambda c: F.array_contains("found", c))
    choice = F.when(F.size("found") > 0, wanted).otherwise(first.scalar())
    return found.select(F.posexplode(choice).alias("ordinal", "cur_unit"))


def select(
    panel: DataFrame,
    selected: list[str] | None = None,
    defaults: list[str] = DEFAULT_CODES,
    first: int | None = None,
    among: DataFrame | None = None,
) -> DataFrame:
    """Rows of the (first ``first``) selected or default codes.

    A given list becomes an IN filter, which reaches the scan. The defaults
    are looked up in ``among`` (default: the panel).
    """
    if selected:
        return panel.filter(F.col("cur_unit").isin(selected[:first]))
    active = active_codes(panel if among is None else among, None, defaults)
    if first is not None:
        active = active.filter(F.col("ordinal") < first)
    # At most max(len(defaults), 4) rows by construction.
    return panel.join(F.broadcast(active), "cur_unit", "left_semi")


def code_list(
    panel: DataFrame, selected: list[str] | None = None, defaults: list[str] = DEFAULT_CODES, first: int | None = None
) -> list[str]:
    """Selected or default codes as a list, for pivot columns."""
    if selected:
        return selected[:first]
    rows = active_codes(panel, None, defaults).orderBy("ordinal").collect()
    return [row["cur_unit"] for row in rows][:first]


def reindex(panel: DataFrame, selected: list[str], fill: dict[str, Column] | None = None) -> DataFrame:
    """One or more rows per listed code: missing codes stay, with NULLs or ``fill``."""
    wanted = active_codes(panel, selected)
    out = wanted.join(panel.filter(F.col("cur_unit").isin(selected)), "cur_unit", "left")
    for name, value in (fill or {}).items():
        out = out.withColumn(name, F.coalesce(name, value))
    return out

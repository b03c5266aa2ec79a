"""Completeness, load history, missing weekdays, freshness, latest rows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from quotepanel.functions.text import age_text, label

# Fixed values.
HISTORY_DATES = 20
LATEST_ROWS = 60
SATURDAY = 5


# Each takes the rows per date and the codes from tables that are kept, if there
# are any; without them it counts the panel.


def _expected(codes: DataFrame) -> Column:
    """Number of codes ever seen, as a scalar."""
    return codes.select("cur_unit").distinct().agg(F.count("cur_unit")).scalar()


def per_date(panel: DataFrame) -> DataFrame:
    return panel.groupBy("result_date").agg(F.count("*").alias("rows"))


def completeness(panel: DataFrame, dates: DataFrame | None = None, codes: DataFrame | None = None) -> DataFrame:
    """Rows of the latest date against the number of codes ever seen."""
    return (
        (per_date(panel) if dates is None else dates)
        .agg(F.max("result_date").alias("latest_date"), F.max_by("rows", "result_date").alias("rows"))
        .withColumn("expected", _expected(panel if codes is None else codes))
        .withColumn("shortfall", F.greatest(F.col("expected") - F.col("rows"), F.lit(0)))
    )


def history(
    panel: DataFrame, days: int | None = HISTORY_DATES, dates: DataFrame | None = None, codes: DataFrame | None = None
) -> DataFrame:
    """Rows per date on the last ``days`` dates (all for None), with a load status."""
    counts = per_date(panel) if dates is None else dates.select("result_date", "rows")
    if days is not None:
        counts = counts.orderBy(F.desc("result_date")).limit(days)
    counts = counts.withColumn("expected", _expected(panel if codes is None else codes))
    status = (
        F.when(F.col("rows") == F.col("expected"), "complete").when(F.col("rows") == 0, "empty").otherwise("partial")
    )
    return counts.select("result_date", "rows", status.alias("status"))


def missing_weekdays(panel: DataFrame) -> DataFrame:
    """Mondays to Fridays between first and latest date without any row; a frame of dates will do."""
    days = panel.agg(F.min("result_date").alias("start"), F.max("result_date").alias("end")).select(
        F.explode(F.sequence("start", "end")).alias("result_date")
    )
    return days.filter(F.weekday("result_date") < SATURDAY).join(
        panel.select("result_date").distinct(), "result_date", "left_anti"
    )


def ops(mart: DataFrame, dates: DataFrame | None = None, codes: DataFrame | None = None) -> DataFrame:
    """One row: completeness, missing weekdays and pipeline status.

    The panel is aggregated to one row per date first. All its dates lie
    between first and latest, so the weekdays found need only be counted.
    """
    if dates is None:
        dates = mart.groupBy("result_date").agg(F.count("*").alias("rows"), F.max("updated_at").alias("updated_at"))
    totals = dates.agg(
        F.min("result_date").alias("first_date"),
        F.max("result_date").alias("latest_date"),
        F.max_by("rows", "result_date").alias("rows"),
        F.count_if(F.weekday("result_date") < SATURDAY).alias("found"),
        F.max("updated_at").alias("last_updated"),
    )
    weekdays = F.size(F.filter(F.sequence("first_date", "latest_date"), lambda d: F.weekday(d) < SATURDAY))
    return totals.withColumn("expected", _expected(mart if codes is None else codes)).select(
        "latest_date",
        "rows",
        "expected",
        F.greatest(F.col("expected") - F.col("rows"), F.lit(0)).alias("shortfall"),
        (weekdays - F.col("found")).alias("missing_days"),
        "last_updated",
        F.when(F.col("last_updated").isNotNull(), "ok").otherwise("unknown").alias("status"),
    )


def freshness(mart: DataFrame, as_of) -> DataFrame:
    """Last update and its age at the zone-less time ``as_of``."""
    return mart.agg(F.max("updated_at").alias("last_updated")).withColumn(
        "age_text", age_text(F.col("last_updated"), F.lit(as_of).cast("timestamp_ntz"))
    )


def latest_rows(panel: DataFrame, n: int | None = LATEST_ROWS) -> DataFrame:
    """Newest ``n`` rows (all for None) of the enriched panel, newest first, under presentation names."""
    newest = panel.orderBy(F.desc("result_date"), F.asc("cur_unit"))
    return (
        (newest if n is None else newest.limit(n))
        .select(
            "result_date",
            label(F.col("cur_unit"), F.col("cur_nm")).alias("cur_unit"),
            "rate",
            "prev_rate",
            "change_pct",
            "ma_5",
        )
        .withColumnsRenamed(
            {
                "result_date": "quote_date",
                "cur_unit": "instrument",
                "rate": "base_rate",
                "prev_rate": "previous_rate",
                "ma_5": "moving_average_5",
            }
        )
    )

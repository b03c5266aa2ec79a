"""Quality, completeness and maintenance queries."""

from __future__ import annotations

from datetime import date

from pyspark.sql import functions as F

from quotepanel.operators import ops, quality
from quotepanel.operators.mart import mart_daily, mart_incremental
from quotepanel.operators.upsert import DuplicateKeys, guard_unique, upsert
from quotepanel.plans import panels, sql
from quotepanel.plans.daily import backfill as backfill_frames
from quotepanel.plans.entries.analytics import E_MART, N_MART, nation_mart, nation_panel
from quotepanel.plans.entries.ingest import MART_COLUMNS, MART_SQL, RUN_TS, staging
from quotepanel.plans.registry import query
from quotepanel.schemas import KEYS
from quotepanel.session import stored

AS_OF = "2024-01-31 05:00:00"


def _stamped_mart(spark, sf_dir):
    """Event mart stamped with the time of the event behind each rate."""
    panel = panels.events_panel(spark, sf_dir)
    return mart_daily(panel).drop("updated_at").join(panel.select(*KEYS, "updated_at"), KEYS)


@query(
    "freshness_age",
    sql.with_(sql.EVENTS)
    + f""", age AS (SELECT max(updated_at) AS last_updated,
  greatest(epoch(TIMESTAMP '{AS_OF}') - epoch(max(updated_at)), 0) AS secs FROM e)
SELECT last_updated, CASE WHEN last_updated IS NULL THEN 'unknown'
  WHEN secs < 3600 THEN CAST(floor(secs / 60) AS BIGINT) || ' minutes ago'
  WHEN secs < 86400 THEN CAST(floor(secs / 3600) AS BIGINT) || ' hours ago'
  ELSE CAST(floor(secs / 86400) AS BIGINT) || ' days ago' END AS age_text
FROM age""",
)
def freshness_age(spark, sf_dir):
    return ops.freshness(panels.events_panel(spark, sf_dir), AS_OF)


@query(
    "latest_completeness",
    sql.with_(sql.SUPPLIERS)
    + """ SELECT max(result_date) AS latest_date,
  count(*) FILTER (result_date = (SELECT max(result_date) FROM s)) AS rows,
  count(DISTINCT cur_unit) AS expected,
  greatest(count(DISTINCT cur_unit) - count(*) FILTER (result_date = (SELECT max(result_date) FROM s)), 0) AS shortfall
FROM s""",
)
def latest_completeness(spark, sf_dir):
    return ops.completeness(panels.suppliers_panel(spark, sf_dir))


@query(
    "load_history",
    sql.with_(sql.SUPPLIERS)
    + """ SELECT result_date, count(*) AS rows,
  CASE WHEN count(*) = (SELECT count(DISTINCT cur_unit) FROM s) THEN 'complete' ELSE 'partial' END AS status
FROM s GROUP BY result_date ORDER BY result_date DESC LIMIT 20""",
)
def load_history(spark, sf_dir):
    return ops.history(panels.suppliers_panel(spark, sf_dir))


MISSING = """
missing AS (
  SELECT CAST(d AS DATE) AS result_date
  FROM (SELECT unnest(generate_series((SELECT min(result_date) FROM n), (SELECT max(result_date) FROM n), INTERVAL 1 DAY)) AS d)
  WHERE isodow(d) < 6 AND CAST(d AS DATE) NOT IN (SELECT result_date FROM n)
)"""


@query("missing_weekdays", sql.with_(sql.NATIONS, MISSING) + " SELECT * FROM missing")
def missing_weekdays(spark, sf_dir):
    return ops.missing_weekdays(nation_panel(spark, sf_dir))


@query(
    "ops_summary",
    sql.with_(sql.EVENTS, MISSING.replace("FROM n)", "FROM e)"))
    + """ SELECT max(result_date) AS latest_date,
  count(*) FILTER (result_date = (SELECT max(result_date) FROM e)) AS rows,
  count(DISTINCT cur_unit) AS expected,
  greatest(count(DISTINCT cur_unit) - count(*) FILTER (result_date = (SELECT max(result_date) FROM e)), 0) AS shortfall,
  (SELECT count(*) FROM missing) AS missing_days, max(updated_at) AS last_updated, 'ok' AS status
FROM e""",
)
def ops_summary(spark, sf_dir):
    return ops.ops(_stamped_mart(spark, sf_dir))


# Quality, on a panel with planted violations


def _broken_panel(spark, sf_dir):
    """N without the rates of even months, and with every key of 1995 twice."""
    panel = nation_panel(spark, sf_dir).select(*KEYS, "rate")
    nulled = panel.withColumn("rate", F.when(F.month("result_date").isin(1, 3, 5, 7, 9, 11), F.col("rate")))
    return nulled.unionByName(panel.filter(F.year("result_date") == 1995))


BROKEN = """
broken AS (
  SELECT result_date, cur_unit, CASE WHEN month(result_date) IN (1, 3, 5, 7, 9, 11) THEN rate END AS rate FROM n
  UNION ALL
  SELECT result_date, cur_unit, rate FROM n WHERE year(result_date) = 1995
)"""


@query(
    "dq_not_null",
    sql.with_(sql.NATIONS, BROKEN)
    + " SELECT 'not_null_rate' AS rule, result_date, cur_unit FROM broken WHERE rate IS NULL",
)
def dq_not_null(spark, sf_dir):
    return quality.not_null(_broken_panel(spark, sf_dir), [*KEYS, "rate"])


@query(
    "dq_unique_key",
    sql.with_(sql.NATIONS, BROKEN)
    + " SELECT result_date, cur_unit, count(*) AS rows FROM broken GROUP BY result_date, cur_unit HAVING count(*) > 1",
)
def dq_unique_key(spark, sf_dir):
    return quality.unique_key(_broken_panel(spark, sf_dir))


@query(
    "dq_stale",
    sql.with_(sql.NATIONS)
    + """, latest AS (SELECT max(result_date) AS d FROM n)
SELECT 'over' AS age, d AS latest_result_date FROM latest WHERE d < DATE '2100-01-01' - 4
UNION ALL SELECT 'on time' AS age, d FROM latest WHERE d < DATE '1990-01-01' - 4""",
)
def dq_stale(spark, sf_dir):
    panel = nation_panel(spark, sf_dir)
    late = quality.stale(panel, date(2100, 1, 1)).select(F.lit("over").alias("age"), "latest_result_date")
    fresh = quality.stale(panel, date(1990, 1, 1)).select(F.lit("on time").alias("age"), "latest_result_date")
    return late.unionByName(fresh)


@query(
    "dq_report",
    sql.with_(sql.NATIONS, BROKEN, sql.mart("n"))
    + """ SELECT 'staging_not_null' AS rule, count(*) AS failures FROM broken WHERE rate IS NULL
UNION ALL SELECT 'staging_unique_key', count(*) FROM
  (SELECT 1 FROM broken GROUP BY result_date, cur_unit HAVING count(*) > 1)
UNION ALL SELECT 'mart_not_null', count(*) FROM m WHERE rate IS NULL
UNION ALL SELECT 'mart_unique_key', count(*) FROM (SELECT 1 FROM m GROUP BY result_date, cur_unit HAVING count(*) > 1)
UNION ALL SELECT 'mart_stale', (coalesce(max(result_date) < DATE '2100-01-01' - INTERVAL 4 DAY, true))::BIGINT FROM m""",
)
def dq_report(spark, sf_dir):
    broken, mart = _broken_panel(spark, sf_dir), nation_mart(spark, sf_dir)
    columns = [*KEYS, "rate"]
    return quality.report(
        {
            "staging_not_null": quality.not_null(broken, columns),
            "staging_unique_key": quality.unique_key(broken),
            "mart_not_null": quality.not_null(mart, columns),
            "mart_unique_key": quality.unique_key(mart),
            "mart_stale": quality.stale(mart, date(2100, 1, 1)),
        }
    )


@query(
    "empty_panel",
    sql.with_(sql.SUPPLIERS)
    + """ SELECT 'all' AS rows, count(*) = 0 AS is_empty FROM s
UNION ALL SELECT 'after the end', count(*) = 0 FROM s WHERE result_date > DATE '2100-01-01'""",
)
def empty_panel(spark, sf_dir):
    panel = panels.suppliers_panel(spark, sf_dir)
    later = panel.filter(F.col("result_date") > date(2100, 1, 1))
    found = [quality.emptiness(rows).select(F.lit(name).alias("rows"), "is_empty") for name, rows in (("all", panel), ("after the end", later))]
    return found[0].unionByName(found[1])


# Upsert and incremental maintenance

SPLIT, OVERLAP = date(2024, 1, 20), date(2024, 1, 15)

HALVES = """
target AS (SELECT result_date, cur_unit, cur_nm, rate FROM e WHERE result_date <= DATE '2024-01-20'),
source AS (SELECT result_date, cur_unit, cur_nm, rate + 1 AS rate FROM e WHERE result_date >= DATE '2024-01-15'),
merged AS (
  SELECT * FROM source
  UNION ALL
  SELECT * FROM target t WHERE NOT EXISTS
    (SELECT 1 FROM source s WHERE s.result_date = t.result_date AND s.cur_unit = t.cur_unit)
)"""


def _halves(spark, sf_dir):
    panel = panels.events_panel(spark, sf_dir).drop("updated_at")
    target = panel.filter(F.col("result_date") <= SPLIT)
    source = panel.filter(F.col("result_date") >= OVERLAP).withColumn("rate", F.col("rate") + 1)
    return target, source


@query("upsert_rows", sql.with_(sql.EVENTS, HALVES) + " SELECT * FROM merged")
def upsert_rows(spark, sf_dir):
    return upsert(*_halves(spark, sf_dir))


@query("upsert_idempotent", sql.with_(sql.EVENTS, HALVES) + " SELECT * FROM merged")
def upsert_idempotent(spark, sf_dir):
    target, source = _halves(spark, sf_dir)
    return upsert(upsert(target, source), source)


@query(
    "upsert_guard",
    sql.with_(sql.EVENTS, HALVES)
    + """ SELECT 'rejected' AS outcome, result_date, cur_unit, count(*) AS rows
FROM (SELECT * FROM target UNION ALL SELECT * FROM source) GROUP BY result_date, cur_unit HAVING count(*) > 1""",
)
def upsert_guard(spark, sf_dir):
    target, source = _halves(spark, sf_dir)
    doubled = target.unionByName(source)
    try:
        guard_unique(doubled)
        outcome = "accepted"
    except DuplicateKeys:
        outcome = "rejected"
    return quality.unique_key(doubled).select(F.lit(outcome).alias("outcome"), *KEYS, "rows")


CORRECTED = """
fixed AS (SELECT result_date, cur_unit, CASE WHEN result_date = DATE '1998-03-02' THEN rate * 2 ELSE rate END AS rate FROM s)"""


@query("mart_incremental", sql.with_(sql.SUPPLIERS, CORRECTED, sql.mart("fixed")) + " " + MART_SQL)
def mart_incremental_query(spark, sf_dir):
    """Every rate of one mid-history date is corrected; the check recomputes all.

    STAGING and the mart of before are tables, as between two daily runs.
    """
    panel = stored(panels.suppliers_panel(spark, sf_dir), "incremental-staging")
    before = stored(mart_daily(panel, RUN_TS), "incremental-mart")
    on_day = F.col("result_date") == date(1998, 3, 2)
    corrected = panel.withColumn("rate", F.when(on_day, F.col("rate") * 2).otherwise(F.col("rate")))
    after = mart_incremental(
        corrected, corrected.filter(on_day), before, RUN_TS, lambda rows: stored(rows, "incremental-rows")
    )
    return after.select(*MART_COLUMNS)


@query(
    "backfill_range",
    sql.with_(sql.EVENTS_RAW, sql.staged(), sql.mart("stg")) + " " + MART_SQL,
)
def backfill_range(spark, sf_dir):
    """The layers hold all but 12 days; the backfill brings those and re-runs others."""
    raw = panels.events_raw(spark, sf_dir)
    known = staging(spark, sf_dir).filter(~F.col("result_date").between(date(2024, 1, 8), date(2024, 1, 19)))
    known = stored(known, "backfill-staging")
    _, mart = backfill_frames(
        raw,
        known,
        stored(mart_daily(known, RUN_TS), "backfill-mart"),
        date(2024, 1, 5),
        date(2024, 1, 22),
        RUN_TS,
        lambda rows: stored(rows, "backfill-rows"),
    )
    return mart.select(*MART_COLUMNS)

"""Period, selection, overview, detail and risk queries."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, SparkSession, functions as F

from quotepanel.operators import detail, names, ops, overview, period as periods, risk
from quotepanel.operators.mart import mart_daily
from quotepanel.plans import panels, sql
from quotepanel.plans.entries.ingest import MART_COLUMNS, MART_SQL, supplier_mart
from quotepanel.plans.registry import query
from quotepanel.schemas import KEYS
from quotepanel.sources.export import export_frame

EVENT_CODES = ["view", "click", "purchase", "signup", "error"]
# The driver's events have these dates at every scale; a view needs its columns named.
EVENT_DATES = [f"2024-01-{day:02d}" for day in range(1, 31)]
CHOSEN = ["NATION_7", "NATION_3", "NATION_11", "NATION_19", "NATION_0"]


def nation_panel(spark: SparkSession, sf_dir: str) -> DataFrame:
    return panels.nations_panel(spark, sf_dir)


def nation_mart(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mart_daily(nation_panel(spark, sf_dir)).select(*MART_COLUMNS)


def named_nation_mart(spark: SparkSession, sf_dir: str) -> DataFrame:
    panel = nation_panel(spark, sf_dir)
    return names.enrich(mart_daily(panel).select(*MART_COLUMNS), panel)


def event_mart(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mart_daily(panels.events_panel(spark, sf_dir)).select(*MART_COLUMNS)


def named_event_mart(spark: SparkSession, sf_dir: str) -> DataFrame:
    panel = panels.events_panel(spark, sf_dir)
    return names.enrich(mart_daily(panel).select(*MART_COLUMNS), panel)


def units_mart(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mart_daily(panels.units_panel(spark, sf_dir)).select(*MART_COLUMNS)


N_MART = sql.with_(sql.NATIONS, sql.mart("n"))

def _named(panel_sql: str, panel: str) -> str:
    names_sql = f"(SELECT cur_unit, max(cur_nm) AS cur_nm FROM {panel} GROUP BY cur_unit)"
    return sql.with_(
        panel_sql,
        sql.mart(panel, "plain"),
        f" m AS (SELECT plain.*, cur_nm FROM plain LEFT JOIN {names_sql} USING (cur_unit))",
    )


N_NAMED = _named(sql.NATIONS, "n")
E_NAMED = _named(sql.EVENTS, "e")
E_MART = sql.with_(sql.EVENTS, sql.mart("e"))
U_MART = sql.with_(sql.EVENTS, sql.UNITS, sql.mart("u"))
CHOSEN_SQL = ", ".join(f"'{c}'" for c in CHOSEN)
FIRST_CODES = "(SELECT DISTINCT cur_unit FROM m ORDER BY cur_unit LIMIT 4)"


# Dates and selection


@query("code_list", sql.with_(sql.SUPPLIERS) + " SELECT DISTINCT cur_unit FROM s")
def code_list(spark, sf_dir):
    return periods.codes(panels.suppliers_panel(spark, sf_dir))


@query("date_list", sql.with_(sql.SUPPLIERS) + " SELECT DISTINCT result_date FROM s")
def date_list(spark, sf_dir):
    return periods.dates(panels.suppliers_panel(spark, sf_dir))


@query("latest_date", sql.with_(sql.SUPPLIERS) + " SELECT max(result_date) AS result_date FROM s")
def latest_date(spark, sf_dir):
    return periods.latest(panels.suppliers_panel(spark, sf_dir))


@query(
    "recent_dates",
    sql.with_(sql.NATIONS) + " SELECT DISTINCT result_date FROM n ORDER BY result_date DESC LIMIT 66",
)
def recent_dates(spark, sf_dir):
    return periods.recent_dates(nation_panel(spark, sf_dir), 66)


@query("period_filter", sql.with_(sql.NATIONS, sql.mart("n"), sql.period("m", 66)) + " SELECT * FROM p")
def period_filter(spark, sf_dir):
    return periods.period(nation_mart(spark, sf_dir))


@query(
    "period_choices",
    sql.with_(sql.NATIONS)
    + " UNION ALL ".join(
        f" SELECT '{choice}' AS choice, min(result_date) AS first_date, count(*) AS rows FROM n WHERE result_date IN "
        f"(SELECT DISTINCT result_date FROM n ORDER BY result_date DESC{f' LIMIT {n}' if n else ''})"
        for choice, n in periods.PERIODS.items()
    ),
)
def period_choices(spark, sf_dir):
    """Start and size of each period on offer."""
    panel = nation_panel(spark, sf_dir)
    sizes = [
        periods.period(panel, n)
        .agg(F.min("result_date").alias("first_date"), F.count("*").alias("rows"))
        .select(F.lit(choice).alias("choice"), "first_date", "rows")
        for choice, n in periods.PERIODS.items()
    ]
    return reduce(DataFrame.unionByName, sizes)


@query(
    "select_codes",
    N_MART + f" SELECT 'default' AS choice, * FROM m WHERE cur_unit IN {FIRST_CODES}"
    f" UNION ALL SELECT 'chosen' AS choice, * FROM m WHERE cur_unit IN ({CHOSEN_SQL})"
    " UNION ALL SELECT 'preferred' AS choice, * FROM m WHERE cur_unit IN ('NATION_5', 'NATION_9')",
)
def select_codes(spark, sf_dir):
    mart = nation_mart(spark, sf_dir)
    choices = {
        "default": periods.select(mart),
        "chosen": periods.select(mart, CHOSEN),
        "preferred": periods.select(mart, None, ["NATION_9", "NOT_A_NATION", "NATION_5"]),
    }
    frames = [rows.select(F.lit(name).alias("choice"), *MART_COLUMNS) for name, rows in choices.items()]
    return frames[0].unionByName(frames[1]).unionByName(frames[2])


@query("latest_snapshot", sql.with_(sql.SUPPLIERS, sql.mart("s"), sql.snapshot("m")) + " SELECT * FROM latest")
def latest_snapshot(spark, sf_dir):
    return periods.snapshot(supplier_mart(spark, sf_dir))


@query(
    "reindex_codes",
    sql.with_(sql.NATIONS, sql.mart("n"), sql.snapshot("m"))
    + ", keys(ordinal, cur_unit) AS (VALUES "
    + ", ".join(f"({i}, '{c}')" for i, c in enumerate([*CHOSEN, "NOT_A_NATION"]))
    + ") SELECT ordinal, cur_unit, result_date, coalesce(rate, 0.0) AS rate, change_pct "
    "FROM keys LEFT JOIN latest USING (cur_unit)",
)
def reindex_codes(spark, sf_dir):
    rows = periods.snapshot(nation_mart(spark, sf_dir)).select(*KEYS, "rate", "change_pct")
    return periods.reindex(rows, [*CHOSEN, "NOT_A_NATION"], {"rate": F.lit(0.0)})


# Overview


@query(
    "kpi_snapshot",
    sql.with_(sql.EVENTS, sql.UNITS, sql.mart("u"), sql.snapshot("m"))
    + f""" SELECT cur_unit, rate, prev_rate, rate - prev_rate AS diff, change_pct, ma_5,
       (rate / nullif(ma_5, 0) - 1) * 100 AS disparity
FROM latest WHERE cur_unit IN {FIRST_CODES}""",
)
def kpi_snapshot(spark, sf_dir):
    return overview.kpi(units_mart(spark, sf_dir), k=4)


@query(
    "kpi_cards",
    E_NAMED
    + ","
    + sql.snapshot("m")
    + f""" SELECT {sql.label('cur_unit', 'cur_nm')} AS label, {sql.fmt_num('rate', sql.digits('rate'))} AS rate_text,
       {sql.fmt_delta('rate', 'prev_rate', 'change_pct', sql.digits('rate'))} AS delta_text,
       {sql.fmt_num('ma_5', sql.digits('rate'))} AS ma_text,
       {sql.fmt_pct('(rate / nullif(ma_5, 0) - 1) * 100')} AS disparity_text
FROM latest WHERE cur_unit IN {FIRST_CODES}""",
)
def kpi_cards(spark, sf_dir):
    return overview.kpi_cards(named_event_mart(spark, sf_dir), k=4)


@query(
    "rate_series",
    sql.with_(sql.NATIONS, sql.mart("n"), sql.period("m", 250))
    + f" SELECT result_date, cur_unit, rate AS y, ma_5 AS y_ma FROM p WHERE cur_unit IN ({CHOSEN_SQL})",
)
def rate_series(spark, sf_dir):
    return overview.series(nation_mart(spark, sf_dir), CHOSEN, 250)


@query(
    "normalised_series",
    sql.with_(sql.NATIONS, sql.mart("n"), sql.period("m", 250))
    + f""",
based AS (
  SELECT *, first_value(rate) OVER (PARTITION BY cur_unit ORDER BY result_date) AS base
  FROM p WHERE cur_unit IN ({CHOSEN_SQL})
)
SELECT result_date, cur_unit, CASE WHEN base = 0 THEN rate ELSE rate / base * 100 END AS y,
       CASE WHEN base = 0 THEN ma_5 ELSE ma_5 / base * 100 END AS y_ma
FROM based""",
)
def normalised_series(spark, sf_dir):
    return overview.series(nation_mart(spark, sf_dir), CHOSEN, 250, normalise=True)


RANKED = """
ranked AS (
  SELECT cur_unit, round_even((last / first - 1) * 100, 2) AS return_pct
  FROM (SELECT cur_unit, arg_min(rate, result_date) AS first, arg_max(rate, result_date) AS last
        FROM p GROUP BY cur_unit)
  WHERE first <> 0
)"""


@query(
    "return_ranking",
    sql.with_(sql.SUPPLIERS, sql.period("s", 250), RANKED) + " SELECT * FROM ranked",
)
def return_ranking(spark, sf_dir):
    return overview.returns(panels.suppliers_panel(spark, sf_dir), 250)


@query(
    "return_display",
    N_NAMED
    + ","
    + sql.period("m", 250)
    + ","
    + RANKED.replace("ranked AS", "unnamed AS", 1)
    + f" SELECT {sql.label('cur_unit', 'cur_nm')} AS cur_unit, return_pct FROM unnamed JOIN (SELECT DISTINCT cur_unit, cur_nm FROM m) USING (cur_unit)"
    + " ORDER BY return_pct DESC, cur_unit",
)
def return_display(spark, sf_dir):
    """The ranking with names, best first."""
    panel = named_nation_mart(spark, sf_dir)
    return names.display(overview.returns(panel, 250), panel, F.desc("return_pct"))


@query(
    "return_top_bottom",
    sql.with_(sql.NATIONS, sql.period("n", 66), RANKED)
    + " (SELECT * FROM ranked ORDER BY return_pct DESC, cur_unit LIMIT 4)"
    " UNION (SELECT * FROM ranked ORDER BY return_pct, cur_unit DESC LIMIT 4)",
)
def return_top_bottom(spark, sf_dir):
    return overview.top_bottom(overview.returns(nation_panel(spark, sf_dir)))


SUMMARY = """
SELECT cur_unit, last, high, low, mean, stddev, round_even((high / nullif(low, 0) - 1) * 100, 2) AS range_pct,
       round_even(CASE WHEN high = low THEN 50.0 ELSE (last - low) / (high - low) * 100 END, 1) AS position
FROM (
  SELECT cur_unit, arg_max(rate, result_date) AS last, max(rate) AS high, min(rate) AS low,
         round_even(round(avg(rate), 9), 4) AS mean, round_even(round(stddev_samp(rate), 9), 4) AS stddev
  FROM {source} GROUP BY cur_unit
)"""


@query("period_summary", sql.with_(sql.SUPPLIERS, sql.period("s", 250)) + SUMMARY.format(source="p"))
def period_summary(spark, sf_dir):
    """All codes over the last 250 quote dates."""
    return overview.summarise(periods.period(panels.suppliers_panel(spark, sf_dir), 250))


@query("summary_all_time", sql.with_(sql.NATIONS) + SUMMARY.format(source="n"))
def summary_all_time(spark, sf_dir):
    return overview.summarise(nation_panel(spark, sf_dir))


@query(
    "summary_selected",
    sql.with_(sql.NATIONS, sql.period("n", 66))
    + SUMMARY.format(source=f"(SELECT * FROM p WHERE cur_unit IN ({CHOSEN_SQL}))"),
)
def summary_selected(spark, sf_dir):
    return overview.summary(nation_panel(spark, sf_dir), CHOSEN)


@query(
    "period_summary_display",
    sql.with_(sql.NATIONS, sql.period("n", 66), "shown AS (" + SUMMARY.format(source="p") + ")")
    + f""" SELECT {sql.label('cur_unit', 'cur_nm')} AS cur_unit, shown.* EXCLUDE (cur_unit)
FROM shown LEFT JOIN (SELECT cur_unit, max(cur_nm) AS cur_nm FROM n GROUP BY cur_unit) USING (cur_unit)""",
)
def period_summary_display(spark, sf_dir):
    panel = nation_panel(spark, sf_dir)
    return names.display(overview.summarise(periods.period(panel, 66)), panel)


# Detail


def _cross_sql(rows: str, joined: str) -> str:
    def unit(code: str) -> str:
        return f"CASE WHEN contains({code}, '(100)') THEN 100 ELSE 1 END"

    return f""",
crossed AS (
  SELECT q.result_date, b.cur_unit AS base, q.cur_unit AS quote,
         (b.rate / {unit('b.cur_unit')}) / (q.rate / {unit('q.cur_unit')}) AS cross,
         (b.prev_rate / {unit('b.cur_unit')}) / nullif(q.prev_rate / {unit('q.cur_unit')}, 0) AS cross_prev
  FROM {rows} q JOIN {rows} b ON q.result_date = b.result_date AND {joined}
  WHERE q.rate <> 0
)
SELECT result_date, base, quote, "cross", cross_prev, ("cross" / nullif(cross_prev, 0) - 1) * 100 AS change_pct
FROM crossed"""


@query(
    "cross_rates_latest",
    U_MART
    + ","
    + sql.snapshot("m")
    + _cross_sql("latest", "b.cur_unit = 'purchase(100)' AND q.cur_unit <> b.cur_unit").replace(" AS cross,", ' AS "cross",'),
)
def cross_rates_latest(spark, sf_dir):
    return detail.cross(units_mart(spark, sf_dir), "purchase(100)")


@query(
    "cross_rates_history",
    sql.with_(sql.SUPPLIERS, sql.mart("s"))
    + _cross_sql(
        "m", "b.cur_unit = (SELECT min(cur_unit) FROM m) AND q.cur_unit <> b.cur_unit"
    ).replace(" AS cross,", ' AS "cross",'),
)
def cross_rates_history(spark, sf_dir):
    """The default base, here the first code, against all codes on all dates."""
    return detail.cross(supplier_mart(spark, sf_dir), latest_only=False)


PAIRS = [("view", "purchase(100)"), ("purchase(100)", "click"), ("error", "signup"), ("click", "view"), ("view", "click")]


@query(
    "cross_rates_pairs",
    U_MART
    + _cross_sql(
        "m", "(b.cur_unit, q.cur_unit) IN (" + ", ".join(f"('{b}', '{q}')" for b, q in PAIRS) + ")"
    ).replace(" AS cross,", ' AS "cross",'),
)
def cross_rates_pairs(spark, sf_dir):
    return detail.cross_pairs(units_mart(spark, sf_dir), PAIRS)


@query(
    "cross_rates_text",
    "WITH c AS ("
    + (U_MART + _cross_sql("m", "b.cur_unit = 'click' AND q.cur_unit <> b.cur_unit")).replace(" AS cross,", ' AS "cross",')
    + """)
SELECT result_date, '1 ' || replace(base, '(100)', '') || ' = ' || format('{:,.4f}', "cross") || ' '
       || replace(quote, '(100)', '') AS text,
       CASE WHEN change_pct IS NULL THEN '-' ELSE format('{:+.2f}%', change_pct) END AS change_text
FROM c""",
)
def cross_rates_text(spark, sf_dir):
    return detail.cross_text(detail.cross(units_mart(spark, sf_dir), "click", latest_only=False))


SIGNAL = """CASE WHEN disparity IS NULL THEN 'insufficient' WHEN disparity > 0.35 THEN 'hot'
            WHEN disparity < -0.35 THEN 'cold' ELSE 'neutral' END"""


@query(
    "disparity_signal",
    sql.with_(sql.SUPPLIERS, sql.mart("s"), sql.snapshot("m"))
    + f""" SELECT *, {SIGNAL} AS signal
FROM (SELECT cur_unit, rate, ma_5, (rate / nullif(ma_5, 0) - 1) * 100 AS disparity FROM latest)""",
)
def disparity_signal(spark, sf_dir):
    return detail.signals_of(periods.snapshot(supplier_mart(spark, sf_dir)))


STREAK = """
moves AS (
  SELECT cur_unit, result_date, CAST(sign(rate - lag(rate) OVER (PARTITION BY cur_unit ORDER BY result_date)) AS INTEGER) AS s
  FROM {source}
),
newest AS (
  SELECT cur_unit, max(result_date) AS z, arg_max(s, result_date) AS d FROM moves WHERE s <> 0 GROUP BY cur_unit
),
breaks AS (
  SELECT cur_unit, max(result_date) AS b FROM moves JOIN newest USING (cur_unit)
  WHERE result_date < z AND s <> d GROUP BY cur_unit
),
runs AS (
  SELECT cur_unit, any_value(d) * count(*) AS streak
  FROM moves JOIN newest USING (cur_unit) LEFT JOIN breaks USING (cur_unit)
  WHERE s IS NOT NULL AND result_date <= z AND (b IS NULL OR result_date > b) GROUP BY cur_unit
),
streaks AS (
  SELECT cur_unit, CAST(coalesce(streak, 0) AS BIGINT) AS streak
  FROM (SELECT DISTINCT cur_unit FROM {source}) LEFT JOIN runs USING (cur_unit)
)"""


@query(
    "direction_streak",
    sql.with_(sql.SUPPLIERS, sql.period("s", 250), STREAK.format(source="p")) + " SELECT * FROM streaks",
)
def direction_streak(spark, sf_dir):
    return detail.streak_of(periods.period(panels.suppliers_panel(spark, sf_dir), 250))


@query(
    "direction_streak_rounded",
    sql.with_(
        sql.NATIONS,
        " coarse AS (SELECT result_date, cur_unit, floor(rate / 100000) AS rate FROM n)",
        STREAK.format(source="coarse"),
    )
    + " SELECT * FROM streaks",
)
def direction_streak_rounded(spark, sf_dir):
    """Rates in whole 100,000s, so that flat moves occur."""
    panel = nation_panel(spark, sf_dir).withColumn("rate", F.floor(F.col("rate") / 100000))
    return detail.streak_of(panel)


@query(
    "signal_table",
    E_NAMED
    + ","
    + sql.snapshot("m")
    + ","
    + sql.period("m", 66)
    + ","
    + STREAK.format(source="p")
    + f""" SELECT {sql.label('cur_unit', 'cur_nm')} AS label, {sql.fmt_num('rate', sql.digits('rate'))} AS rate_text,
       {sql.fmt_num('ma_5', sql.digits('rate'))} AS ma_text, {sql.fmt_pct('disparity')} AS disparity_text,
       {SIGNAL} AS signal,
       CASE WHEN streak > 0 THEN 'up ' || abs(streak) || ' days' WHEN streak < 0 THEN 'down ' || abs(streak) || ' days'
            ELSE '-' END AS streak_text
FROM (SELECT *, (rate / nullif(ma_5, 0) - 1) * 100 AS disparity FROM latest)
LEFT JOIN streaks USING (cur_unit) WHERE cur_unit IN {FIRST_CODES}""",
)
def signal_table(spark, sf_dir):
    return detail.signal_table(named_event_mart(spark, sf_dir))


@query(
    "heatmap_long",
    sql.with_(sql.NATIONS, sql.mart("n"), sql.period("m", 30))
    + f" SELECT result_date, cur_unit, change_pct FROM p WHERE cur_unit IN ({CHOSEN_SQL})",
)
def heatmap_long(spark, sf_dir):
    return detail.heatmap(nation_mart(spark, sf_dir), CHOSEN)


def _heatmap_columns(name: str, short: bool = False) -> str:
    shown = {d: f"{d[5:7]}/{d[8:]}" if short else d for d in EVENT_DATES}
    return f" SELECT {name} AS cur_unit, " + ", ".join(
        f"max(change_pct) FILTER (result_date = DATE '{d}') AS \"{column}\"" for d, column in shown.items()
    )


@query(
    "heatmap_wide",
    sql.with_(sql.EVENTS, sql.mart("e"), sql.period("m", 30)) + _heatmap_columns("cur_unit") + " FROM p GROUP BY cur_unit",
)
def heatmap_wide(spark, sf_dir):
    return detail.heatmap_wide(event_mart(spark, sf_dir), EVENT_CODES)


@query(
    "heatmap_display",
    E_NAMED
    + ","
    + sql.period("m", 30)
    + _heatmap_columns(sql.label("cur_unit", "cur_nm"), short=True)
    + " FROM p GROUP BY cur_unit, cur_nm",
)
def heatmap_display(spark, sf_dir):
    """Labelled rows and month/day columns."""
    panel = named_event_mart(spark, sf_dir)
    return detail.heatmap_labels(names.display(detail.heatmap_wide(panel, EVENT_CODES), panel))


# Risk

MOVE_ALERTS = """
shown AS (
  SELECT *, CASE WHEN abs(change_pct) >= 1.0 THEN 'severe' WHEN abs(change_pct) >= 0.7 THEN 'warning'
            ELSE 'caution' END AS grade
  FROM p WHERE abs(change_pct) >= 0.5
  ORDER BY result_date DESC, abs(change_pct) DESC, cur_unit LIMIT 40
)"""


@query(
    "move_alerts",
    sql.with_(sql.SUPPLIERS, sql.mart("s"), sql.period("m", 66), MOVE_ALERTS)
    + " SELECT result_date, cur_unit, rate, change_pct, grade FROM shown",
)
def move_alerts(spark, sf_dir):
    return risk.alerts(supplier_mart(spark, sf_dir))


@query(
    "move_alerts_graded",
    sql.with_(
        sql.NATIONS,
        " level AS (SELECT result_date, cur_unit, rate + 50000000 AS rate FROM n)",
        sql.mart("level"),
        sql.period("m", 250),
        MOVE_ALERTS.replace("LIMIT 40", ""),
    )
    + " SELECT result_date, cur_unit, rate, change_pct, grade FROM shown",
)
def move_alerts_graded(spark, sf_dir):
    """A raised level keeps moves small, so that all grades occur."""
    panel = nation_panel(spark, sf_dir).withColumn("rate", F.col("rate") + 50000000)
    mart = mart_daily(panel).select(*MART_COLUMNS)
    return risk.alerts(mart, 250, limit=None)


@query(
    "alert_table",
    N_NAMED
    + ","
    + sql.period("m", 66)
    + ","
    + sql.snapshot("m")
    + ","
    + MOVE_ALERTS
    + f""" SELECT strftime(shown.result_date, '%Y-%m-%d') AS date_text, {sql.label('shown.cur_unit', 'shown.cur_nm')} AS label,
       {sql.fmt_num('shown.rate', sql.digits('latest.rate'))} AS rate_text,
       {sql.fmt_pct('shown.change_pct')} AS change_text, grade
FROM shown LEFT JOIN latest ON shown.cur_unit = latest.cur_unit""",
)
def alert_table(spark, sf_dir):
    return risk.alert_table(named_nation_mart(spark, sf_dir))


VOLATILITY = """
SELECT cur_unit, round_even(round(annual, 9), 1) AS vol,
       CASE WHEN annual > 9 THEN 'high' WHEN annual > 6 THEN 'mid' ELSE 'low' END AS band
FROM (SELECT cur_unit, count(change_pct) AS k, stddev_samp(change_pct) * sqrt(250) AS annual FROM p GROUP BY cur_unit)
WHERE k >= 2"""


@query("annualised_volatility", sql.with_(sql.SUPPLIERS, sql.mart("s"), sql.period("m", 250)) + VOLATILITY)
def annualised_volatility(spark, sf_dir):
    return risk.volatility_of(periods.period(supplier_mart(spark, sf_dir), 250))


@query(
    "volatility_display",
    N_NAMED
    + ","
    + sql.period("m", 250)
    + ", v AS ("
    + VOLATILITY
    + f") SELECT {sql.label('cur_unit', 'cur_nm')} AS cur_unit, vol, band FROM v JOIN (SELECT DISTINCT cur_unit, cur_nm FROM m) USING (cur_unit)"
    + " ORDER BY vol DESC, cur_unit",
)
def volatility_display(spark, sf_dir):
    """Volatilities with names, highest first."""
    panel = named_nation_mart(spark, sf_dir)
    return names.display(risk.volatility_of(periods.period(panel, 250)), panel, F.desc("vol"))


@query(
    "change_matrix",
    E_MART
    + " SELECT result_date, "
    + ", ".join(f"max(change_pct) FILTER (cur_unit = '{c}') AS {c}" for c in EVENT_CODES)
    + " FROM m GROUP BY result_date",
)
def change_matrix(spark, sf_dir):
    return risk.change_matrix(event_mart(spark, sf_dir), EVENT_CODES, None, k=7)


def _correlation_sql(source: str) -> str:
    return f""",
moves AS (
  SELECT a.cur_unit AS code_a, b.cur_unit AS code_b, a.change_pct AS x, b.change_pct AS y
  FROM {source} a JOIN {source} b ON a.result_date = b.result_date AND a.cur_unit <= b.cur_unit
  WHERE a.change_pct IS NOT NULL AND b.change_pct IS NOT NULL
),
pairs AS (
  SELECT code_a, code_b, count(*) AS n,
         round(covar_pop(x, y) / nullif(sqrt(var_pop(x) * var_pop(y)), 0), 6) + 0.0 AS corr
  FROM moves GROUP BY code_a, code_b
)"""


def _rounded(pairs: DataFrame) -> DataFrame:
    # The engines add up in different orders, and sign a zero differently.
    return pairs.withColumn("corr", F.round("corr", 6) + F.lit(0.0))


SEVEN = [f"NATION_{i}" for i in range(7)]


@query(
    "change_correlation",
    N_MART
    + _correlation_sql("(SELECT * FROM m WHERE cur_unit IN (" + ", ".join(f"'{c}'" for c in SEVEN) + "))")
    + ", codes(code) AS (VALUES "
    + ", ".join(f"('{c}')" for c in SEVEN)
    + """)
SELECT a.code AS code_a, b.code AS code_b, coalesce(n, 0) AS n, corr
FROM codes a JOIN codes b ON a.code <= b.code LEFT JOIN pairs ON code_a = a.code AND code_b = b.code""",
)
def change_correlation(spark, sf_dir):
    return _rounded(risk.correlation(nation_mart(spark, sf_dir), SEVEN, None, k=7))


@query(
    "correlation_all_pairs",
    N_MART
    + _correlation_sql("m")
    + """, codes AS (SELECT DISTINCT cur_unit AS code FROM m)
SELECT a.code AS code_a, b.code AS code_b, coalesce(n, 0) AS n, corr
FROM codes a JOIN codes b ON a.code <= b.code LEFT JOIN pairs ON code_a = a.code AND code_b = b.code""",
)
def correlation_all_pairs(spark, sf_dir):
    """Every code against every other; the list of codes is the only thing collected."""
    mart = nation_mart(spark, sf_dir)
    listed = [row["cur_unit"] for row in periods.codes(mart).orderBy("cur_unit").collect()]
    return _rounded(risk.correlation(mart, listed, None))


@query(
    "correlation_display",
    N_MART
    + _correlation_sql("(SELECT * FROM m WHERE cur_unit IN (" + ", ".join(f"'{c}'" for c in SEVEN) + "))")
    + f""", named AS (SELECT cur_unit, max(cur_nm) AS cur_nm FROM n GROUP BY cur_unit)
SELECT {sql.label('code_a', 'a.cur_nm')} AS code_a, {sql.label('code_b', 'b.cur_nm')} AS code_b, n, corr
FROM pairs JOIN named a ON code_a = a.cur_unit JOIN named b ON code_b = b.cur_unit""",
)
def correlation_display(spark, sf_dir):
    """Pairs under the labels that the axes of the matrix show."""
    panel = nation_panel(spark, sf_dir)
    pairs = _rounded(risk.correlation(mart_daily(panel).select(*MART_COLUMNS), SEVEN, None)).filter("n > 0")
    return names.display_pairs(pairs, panel)


@query(
    "correlation_matrix",
    E_MART
    + _correlation_sql("m")
    + ", mirrored AS (SELECT * FROM pairs UNION SELECT code_b, code_a, n, corr FROM pairs) SELECT code_a AS cur_unit, "
    + ", ".join(f"max(corr) FILTER (code_b = '{c}') AS {c}" for c in EVENT_CODES)
    + " FROM mirrored GROUP BY code_a",
)
def correlation_matrix(spark, sf_dir):
    square = risk.correlation_matrix(event_mart(spark, sf_dir), EVENT_CODES, None, k=7)
    return square.withColumns({c: F.round(c, 6) + F.lit(0.0) for c in EVENT_CODES})


# Latest rows and export


@query(
    "latest_rows",
    N_NAMED
    + f""" SELECT result_date AS quote_date, {sql.label('cur_unit', 'cur_nm')} AS instrument, rate AS base_rate,
       prev_rate AS previous_rate, change_pct, ma_5 AS moving_average_5
FROM m ORDER BY result_date DESC, cur_unit LIMIT 60""",
)
def latest_rows(spark, sf_dir):
    return ops.latest_rows(named_nation_mart(spark, sf_dir))


@query(
    "export_panel",
    N_NAMED
    + ","
    + sql.period("m", 66)
    + f" SELECT result_date, {sql.label('cur_unit', 'cur_nm')} AS cur_unit, rate, prev_rate, change_pct, ma_5, cur_nm FROM p",
)
def export_panel(spark, sf_dir):
    return export_frame(named_nation_mart(spark, sf_dir))

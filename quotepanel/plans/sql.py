"""SQL text shared by the checks: panels, mart and period as WITH clauses."""

from __future__ import annotations

from quotepanel.plans.panels import FAILED_BELOW

EVENTS = """
e AS (
  SELECT CAST(ts AS DATE) AS result_date, event_type AS cur_unit, upper(event_type) AS cur_nm,
         value AS rate, ts AS updated_at
  FROM events
  QUALIFY row_number() OVER (PARTITION BY CAST(ts AS DATE), event_type ORDER BY ts DESC, event_id DESC) = 1
)"""

UNITS = """
u AS (
  SELECT result_date, CASE WHEN cur_unit = 'purchase' THEN 'purchase(100)' ELSE cur_unit END AS cur_unit, cur_nm, rate
  FROM e
)"""

SUPPLIERS = """
s AS (
  SELECT CAST(l_shipdate AS DATE) AS result_date, CAST(l_suppkey AS VARCHAR) AS cur_unit, l_extendedprice AS rate
  FROM lineitem
  QUALIFY row_number() OVER (PARTITION BY CAST(l_shipdate AS DATE), l_suppkey
                             ORDER BY l_orderkey DESC, l_linenumber DESC, l_extendedprice DESC) = 1
)"""

NATIONS = """
n AS (
  SELECT CAST(o_orderdate AS DATE) AS result_date, n_name AS cur_unit, r_name AS cur_nm, o_totalprice AS rate
  FROM orders
  JOIN customer ON o_custkey = c_custkey
  JOIN nation ON c_nationkey = n_nationkey
  JOIN region ON n_regionkey = r_regionkey
  QUALIFY row_number() OVER (PARTITION BY CAST(o_orderdate AS DATE), n_name ORDER BY o_orderkey DESC) = 1
)"""

PAYLOAD = f"""
payload AS (
  SELECT event_id, ts, user_id, strftime(ts, '%Y%m%d') AS search_date,
         CASE WHEN value < {FAILED_BELOW} THEN 2 ELSE 1 END AS result,
         event_type AS cur_unit, upper(event_type) AS cur_nm, format('{{:,.2f}}', value * 1000) AS deal_bas_r
  FROM events
)"""

EVENTS_RAW = (
    PAYLOAD
    + """,
e_raw AS (
  SELECT json_object('result', result, 'cur_unit', cur_unit, 'cur_nm', cur_nm, 'deal_bas_r', deal_bas_r) AS raw_data,
         event_id AS pos, 'exchange_rate_' || search_date || '.json' AS file_name, ts AS loaded_at
  FROM payload
)"""
)


def staged(raw: str = "e_raw", name: str = "stg") -> str:
    """RAW -> STAGING, newest load per key."""
    return f"""
{name} AS (
  SELECT CAST(strptime(regexp_extract(file_name, '[0-9]{{8}}'), '%Y%m%d') AS DATE) AS result_date,
         json_extract_string(raw_data, '$.cur_unit') AS cur_unit,
         json_extract_string(raw_data, '$.cur_nm') AS cur_nm,
         CAST(replace(json_extract_string(raw_data, '$.deal_bas_r'), ',', '') AS DOUBLE) AS rate
  FROM {raw}
  WHERE json_extract_string(raw_data, '$.result') = '1'
  QUALIFY row_number() OVER (
    PARTITION BY regexp_extract(file_name, '[0-9]{{8}}'), json_extract_string(raw_data, '$.cur_unit')
    ORDER BY loaded_at DESC, file_name DESC, pos DESC) = 1
)"""


# STAGING of a landing whose rows share one load time: the last line of a key wins.
LANDED = (
    PAYLOAD
    + """,
stg AS (
  SELECT CAST(strptime(search_date, '%Y%m%d') AS DATE) AS result_date, cur_unit, cur_nm,
         CAST(replace(arg_max(deal_bas_r, event_id), ',', '') AS DOUBLE) AS rate
  FROM payload WHERE result = 1
  GROUP BY search_date, cur_unit, cur_nm
)"""
)


def mart(panel: str, name: str = "m", keep: str = "") -> str:
    """Panel -> mart; ``keep`` names further panel columns."""
    extra = f", {keep}" if keep else ""
    return f"""
{name}_w AS (
  SELECT result_date, cur_unit, rate{extra},
         lag(rate) OVER (PARTITION BY cur_unit ORDER BY result_date) AS prev_rate,
         round(avg(rate) OVER (PARTITION BY cur_unit ORDER BY result_date
                               ROWS BETWEEN 4 PRECEDING AND CURRENT ROW), 4) AS ma_5
  FROM {panel}
),
{name} AS (
  SELECT result_date, cur_unit, rate, prev_rate,
         round((rate - prev_rate) / nullif(prev_rate, 0) * 100, 4) AS change_pct, ma_5{extra}
  FROM {name}_w
)"""


def period(source: str, n: int, name: str = "p") -> str:
    """Rows on the last n distinct dates of the source."""
    return f"""
{name} AS (
  SELECT * FROM {source}
  WHERE result_date IN (SELECT DISTINCT result_date FROM {source} ORDER BY result_date DESC LIMIT {n})
)"""


def snapshot(source: str, name: str = "latest") -> str:
    return f"""
{name} AS (SELECT * FROM {source} WHERE result_date = (SELECT max(result_date) FROM {source}))"""


def digits(rate: str) -> str:
    return f"CASE WHEN {rate} IS NULL THEN 2 WHEN {rate} < 10 THEN 4 WHEN {rate} < 100 THEN 3 ELSE 2 END"


def fmt_num(x: str, dec: str) -> str:
    return (
        f"(CASE WHEN {x} IS NULL THEN '-' WHEN ({dec}) = 4 THEN format('{{:,.4f}}', {x}) "
        f"WHEN ({dec}) = 3 THEN format('{{:,.3f}}', {x}) ELSE format('{{:,.2f}}', {x}) END)"
    )


def fmt_pct(x: str) -> str:
    return f"(CASE WHEN {x} IS NULL THEN '-' ELSE format('{{:+.2f}}%', {x}) END)"


def fmt_delta(rate: str, prev: str, change: str, dec: str) -> str:
    diff = fmt_num(f"({rate} - {prev})", dec)
    signed = f"CASE WHEN {diff} LIKE '-%' THEN {diff} ELSE '+' || {diff} END"
    return f"CASE WHEN {prev} IS NOT NULL THEN ({signed}) || ' (' || {fmt_pct(change)} || ')' END"


def label(code: str, name: str) -> str:
    return f"CASE WHEN coalesce({name}, '') <> '' THEN {code} || '(' || {name} || ')' ELSE {code} END"


def with_(*parts: str) -> str:
    return "WITH " + ",".join(parts)

"""Parsing, staging and mart building."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from quotepanel.functions import numeric, text
from quotepanel.operators import mart as mart_ops, names, staging as staging_ops
from quotepanel.plans import panels, sql
from quotepanel.plans.registry import query
from quotepanel.schemas import KEYS

MART_COLUMNS = [*KEYS, "rate", "prev_rate", "change_pct", "ma_5"]
MART_SQL = "SELECT result_date, cur_unit, rate, prev_rate, change_pct, ma_5 FROM m"
RUN_TS = "2024-02-01 09:30:00"


def supplier_mart(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mart_ops.mart_daily(panels.suppliers_panel(spark, sf_dir)).select(*MART_COLUMNS)


def staging(spark: SparkSession, sf_dir: str) -> DataFrame:
    return staging_ops.staging(panels.events_raw(spark, sf_dir), RUN_TS).drop("loaded_at")


@query(
    "variant_extract",
    sql.with_(sql.EVENTS_RAW)
    + """
SELECT r.pos AS event_id, json_extract_string(raw_data, '$.cur_unit') AS cur_unit,
       json_extract_string(raw_data, '$.result') AS result, json_extract_string(raw_data, '$.deal_bas_r') AS deal_bas_r,
       json_extract_string(raw_data, '$.nothing') AS nothing, json_extract_string(events.props, '$.k') AS k
FROM e_raw r JOIN events ON events.event_id = r.pos""",
)
def variant_extract(spark, sf_dir):
    fields = {f: f"$.{f}" for f in ("cur_unit", "result", "deal_bas_r", "nothing")}
    quotes = staging_ops.extract(panels.events_raw(spark, sf_dir), fields)
    props = panels.table(spark, sf_dir, "events").select("event_id", F.parse_json("props").alias("props"))
    return (
        quotes.withColumnRenamed("pos", "event_id")
        .select("event_id", *fields)
        .join(staging_ops.extract(props, {"k": "$.k"}, "props").drop("props"), "event_id")
    )


@query(
    "file_date_parse",
    sql.with_(sql.EVENTS_RAW)
    + """
SELECT pos AS event_id, regexp_extract(file_name, '[0-9]{8}') AS stamp,
       CAST(strptime(regexp_extract(file_name, '[0-9]{8}'), '%Y%m%d') AS DATE) AS result_date,
       nullif(regexp_extract(file_name, '[0-9]{9}'), '') AS no_match
FROM e_raw""",
)
def file_date_parse(spark, sf_dir):
    name = F.col("file_name")
    return panels.events_raw(spark, sf_dir).select(
        F.col("pos").alias("event_id"),
        numeric.file_stamp(name).alias("stamp"),
        numeric.file_date(name).alias("result_date"),
        F.regexp_substr(name, F.lit("[0-9]{9}")).alias("no_match"),
    )


@query(
    "parse_amount",
    sql.with_(sql.PAYLOAD)
    + " SELECT event_id, deal_bas_r, CAST(replace(deal_bas_r, ',', '') AS DOUBLE) AS rate FROM payload",
)
def parse_amount(spark, sf_dir):
    raw = staging_ops.extract(panels.events_raw(spark, sf_dir), {"deal_bas_r": "$.deal_bas_r"})
    return raw.select(
        F.col("pos").alias("event_id"), "deal_bas_r", numeric.amount(F.col("deal_bas_r")).alias("rate")
    )


@query(
    "run_stamp",
    sql.with_(sql.EVENTS)
    + f" SELECT result_date, cur_unit, rate, TIMESTAMP '{RUN_TS}' AS updated_at, true AS is_utc_now FROM e",
)
def run_stamp(spark, sf_dir):
    panel = panels.events_panel(spark, sf_dir).select(*KEYS, "rate")
    now = staging_ops.stamp(panel).withColumn(
        "is_utc_now", F.abs(F.unix_seconds(F.col("updated_at").cast("timestamp")) - F.unix_seconds(F.now())) < 600
    )
    return staging_ops.stamp(now.drop("updated_at"), RUN_TS)


@query(
    "valid_rows",
    sql.with_(sql.EVENTS_RAW)
    + """
SELECT pos, file_name, loaded_at, json_extract_string(raw_data, '$.cur_unit') AS cur_unit
FROM e_raw WHERE json_extract_string(raw_data, '$.result') = '1'""",
)
def valid_rows(spark, sf_dir):
    good = staging_ops.valid_rows(panels.events_raw(spark, sf_dir))
    return staging_ops.extract(good, {"cur_unit": "$.cur_unit"}).select("pos", "file_name", "loaded_at", "cur_unit")


@query(
    "dedupe_latest",
    sql.with_(sql.EVENTS_RAW)
    + """
SELECT regexp_extract(file_name, '[0-9]{8}') AS stamp, json_extract_string(raw_data, '$.cur_unit') AS cur_unit,
       json_extract_string(raw_data, '$.cur_nm') AS cur_nm, json_extract_string(raw_data, '$.deal_bas_r') AS deal_bas_r,
       loaded_at, file_name
FROM e_raw
QUALIFY row_number() OVER (
  PARTITION BY regexp_extract(file_name, '[0-9]{8}'), json_extract_string(raw_data, '$.cur_unit')
  ORDER BY loaded_at DESC, file_name DESC, pos DESC) = 1""",
)
def dedupe_latest(spark, sf_dir):
    return staging_ops.dedupe_latest(panels.events_raw(spark, sf_dir))


@query(
    "staging",
    sql.with_(sql.EVENTS_RAW, sql.staged())
    + f" SELECT result_date, cur_unit, cur_nm, rate, TIMESTAMP '{RUN_TS}' AS updated_at FROM stg",
)
def staging_query(spark, sf_dir):
    return staging(spark, sf_dir)


@query(
    "staging_quarantine",
    sql.with_(sql.PAYLOAD)
    + """,
raw AS (
  SELECT *, CASE WHEN cur_unit = 'error' THEN 'n/a' ELSE deal_bas_r END AS quoted,
         'exchange_rate_' || search_date || '.json' AS file_name
  FROM payload WHERE result = 1
  QUALIFY row_number() OVER (PARTITION BY search_date, cur_unit ORDER BY ts DESC, event_id DESC) = 1
)
SELECT CASE WHEN quoted = 'n/a' THEN 'rejected' ELSE 'good' END AS outcome, search_date AS stamp, cur_unit,
       CASE WHEN quoted <> 'n/a' THEN CAST(replace(quoted, ',', '') AS DOUBLE) END AS rate,
       CASE WHEN quoted = 'n/a' THEN quoted END AS deal_bas_r
FROM raw""",
)
def staging_quarantine(spark, sf_dir):
    """Quotes of code ``error`` carry text that is no number."""
    raw = panels.events_raw(spark, sf_dir)
    fields = staging_ops.extract(raw, {f: f"$.{f}" for f in ("result", "cur_unit", "cur_nm", "deal_bas_r")})
    quoted = F.when(F.col("cur_unit") == "error", "n/a").otherwise(F.col("deal_bas_r"))
    broken = fields.withColumn("deal_bas_r", quoted).select(
        F.to_variant_object(F.struct("result", "cur_unit", "cur_nm", "deal_bas_r")).alias("raw_data"),
        "pos", "file_name", "loaded_at",
    )
    good, rejected = staging_ops.staging_quarantine(broken, RUN_TS)
    accepted = good.select(
        F.lit("good").alias("outcome"),
        F.date_format("result_date", "yyyyMMdd").alias("stamp"),
        "cur_unit",
        "rate",
        F.lit(None).cast("string").alias("deal_bas_r"),
    )
    return accepted.unionByName(
        rejected.select(
            F.lit("rejected").alias("outcome"), "stamp", "cur_unit", F.lit(None).cast("double").alias("rate"), "deal_bas_r"
        )
    )


@query("ingest_to_mart", sql.with_(sql.EVENTS_RAW, sql.staged(), sql.mart("stg")) + " " + MART_SQL)
def ingest_to_mart(spark, sf_dir):
    """RAW to mart in one plan."""
    return mart_ops.mart_daily(staging(spark, sf_dir)).select(*MART_COLUMNS)


@query("prev_rate", sql.with_(sql.NATIONS, sql.mart("n")) + " SELECT result_date, cur_unit, rate, prev_rate FROM m")
def prev_rate(spark, sf_dir):
    panel = panels.nations_panel(spark, sf_dir).select(*KEYS, "rate")
    return mart_ops.prev_rate(panel)


@query(
    "change_pct", sql.with_(sql.NATIONS, sql.mart("n")) + " SELECT result_date, cur_unit, rate, prev_rate, change_pct FROM m"
)
def change_pct(spark, sf_dir):
    return mart_ops.change_pct(panels.nations_panel(spark, sf_dir).select(*KEYS, "rate"))


@query("moving_average", sql.with_(sql.NATIONS, sql.mart("n")) + " SELECT result_date, cur_unit, rate, ma_5 FROM m")
def moving_average(spark, sf_dir):
    return mart_ops.moving_average(panels.nations_panel(spark, sf_dir).select(*KEYS, "rate"))


@query("mart_daily", sql.with_(sql.SUPPLIERS, sql.mart("s")) + " " + MART_SQL)
def mart_daily(spark, sf_dir):
    return supplier_mart(spark, sf_dir)


@query(
    "labels",
    "SELECT CAST(s_suppkey AS VARCHAR) AS cur_unit, "
    + sql.label("CAST(s_suppkey AS VARCHAR)", "CASE WHEN s_acctbal >= 0 THEN s_name END")
    + " AS label FROM supplier",
)
def labels(spark, sf_dir):
    """Suppliers in debt count as unnamed."""
    suppliers = panels.table(spark, sf_dir, "supplier").select(
        F.col("s_suppkey").cast("string").alias("cur_unit"),
        F.when(F.col("s_acctbal") >= 0, F.col("s_name")).alias("cur_nm"),
    )
    return suppliers.select("cur_unit", text.label(F.col("cur_unit"), F.col("cur_nm")).alias("label"))


@query("display_digits", f"SELECT event_id, {sql.digits('value')} AS dec FROM events")
def display_digits(spark, sf_dir):
    return panels.table(spark, sf_dir, "events").select("event_id", text.digits(F.col("value")).alias("dec"))


@query(
    "format_rate",
    f"SELECT event_id, {sql.fmt_num('value * 37', sql.digits('value * 37'))} AS rate_text, "
    "CASE WHEN value >= 100 THEN '-' ELSE format('{:,.2f}', value) END AS capped_text FROM events",
)
def format_rate(spark, sf_dir):
    value = F.col("value")
    rate = value * 37
    return panels.table(spark, sf_dir, "events").select(
        "event_id",
        text.fmt_num(rate, text.digits(rate)).alias("rate_text"),
        text.fmt_num(F.when(value < 100, value)).alias("capped_text"),
    )


@query(
    "format_pct",
    sql.with_(sql.SUPPLIERS, sql.mart("s"))
    + f" SELECT result_date, cur_unit, {sql.fmt_pct('change_pct')} AS change_text FROM m",
)
def format_pct(spark, sf_dir):
    return supplier_mart(spark, sf_dir).select(*KEYS, text.fmt_pct(F.col("change_pct")).alias("change_text"))


@query(
    "date_text",
    sql.with_(sql.SUPPLIERS)
    + " SELECT result_date, cur_unit, strftime(result_date, '%Y-%m-%d') AS iso, strftime(result_date, '%m/%d') AS short FROM s",
)
def date_text(spark, sf_dir):
    day = F.col("result_date")
    return panels.suppliers_panel(spark, sf_dir).select(
        *KEYS, text.iso_date(day).alias("iso"), text.month_day(day).alias("short")
    )


@query(
    "name_dim",
    sql.with_(sql.NATIONS) + " SELECT cur_unit, max(cur_nm) AS cur_nm FROM n GROUP BY cur_unit",
)
def name_dim(spark, sf_dir):
    return names.name_dim(panels.nations_panel(spark, sf_dir))


@query(
    "enrich_names",
    sql.with_(sql.SUPPLIERS, sql.mart("s"))
    + """
SELECT m.*, s_name AS cur_nm FROM m
LEFT JOIN (SELECT * FROM supplier WHERE s_acctbal >= 0) ON m.cur_unit = CAST(s_suppkey AS VARCHAR)""",
)
def enrich_names(spark, sf_dir):
    known = panels.table(spark, sf_dir, "supplier").filter("s_acctbal >= 0")
    dimension = known.select(F.col("s_suppkey").cast("string").alias("cur_unit"), F.col("s_name").alias("cur_nm"))
    return names.enrich(supplier_mart(spark, sf_dir), dimension)

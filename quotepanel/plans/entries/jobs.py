"""Queries that read or write files: landing, layers, loads and the stream.

Each works in a new folder of the shared location the session names. The
landed files hold every event, so the work grows with the tables.
"""

from __future__ import annotations

from datetime import timedelta

from py4j.protocol import Py4JJavaError
from pyspark.errors import PySparkException
from pyspark.sql import DataFrame, SparkSession, functions as F

from quotepanel.plans import panels, sql
from quotepanel.plans.daily import rebuild, run_load
from quotepanel.plans.entries.analytics import named_nation_mart, N_NAMED
from quotepanel.plans.entries.ingest import MART_COLUMNS, MART_SQL, RUN_TS
from quotepanel.plans.registry import query
from quotepanel.plans.stored import StoredPanel
from quotepanel.session import shared_folder
from quotepanel.sources.export import export_panel
from quotepanel.sources.landing import (
    append_new,
    read_landing,
    read_landing_variant,
    write_landing,
    write_landing_arrays,
)
from quotepanel.sources.layers import Layers, create_layers, scan_mart
from quotepanel.streaming.ingest import stream_ingest as start_stream

LANDED_MART = sql.with_(sql.LANDED, sql.mart("stg"))
PER_FILE = "'exchange_rate_' || search_date || '.json' AS file_name, count(*) AS rows"
MIDDLE = "20240116"


def _landed(spark: SparkSession, rows: DataFrame, purpose: str) -> str:
    path = shared_folder(spark, purpose)
    write_landing(rows, path, "event_id")
    return path


def _loaded(spark: SparkSession, sf_dir: str, purpose: str) -> tuple[Layers, str]:
    """Layers after one load of all events, and their landing folder."""
    landing = _landed(spark, panels.events_landing(spark, sf_dir), f"{purpose}-landing")
    layers = create_layers(spark, shared_folder(spark, purpose))
    run_load(layers, landing, RUN_TS, multi_line=False)
    return layers, landing


def _per_file(raw: DataFrame) -> DataFrame:
    return raw.groupBy("file_name").agg(F.count("*").alias("rows"))


@query(
    "landing_scan",
    sql.with_(sql.PAYLOAD)
    + f""" SELECT CAST(result AS VARCHAR) AS result, cur_unit, cur_nm, deal_bas_r,
       'exchange_rate_' || search_date || '.json' AS file_name, TIMESTAMP '{RUN_TS}' AS loaded_at,
       true AS has_lineage FROM payload""",
)
def landing_scan(spark, sf_dir):
    """Arrays of up to 500 quotes per line, gzip files, declared schema."""
    path = shared_folder(spark, "landing-scan")
    write_landing_arrays(panels.event_chunks(spark, sf_dir), path, "chunk")
    landed = read_landing(spark, path, RUN_TS, multi_line=False)
    lineage = (F.col("file_size") > 0) & F.col("file_mtime").isNotNull() & F.col("file_path").contains("/search_date=")
    return landed.withColumn("has_lineage", lineage).drop("file_path", "file_size", "file_mtime")


@query(
    "landing_variant_scan",
    sql.with_(sql.PAYLOAD)
    + f""" SELECT CAST(result AS VARCHAR) AS result, cur_unit, deal_bas_r, user_id,
       'exchange_rate_' || search_date || '.json' AS file_name, TIMESTAMP '{RUN_TS}' AS loaded_at FROM payload""",
)
def landing_variant_scan(spark, sf_dir):
    """The same files as VARIANT: a field the pipeline does not know is kept."""
    path = shared_folder(spark, "landing-variant")
    write_landing_arrays(panels.event_chunks(spark, sf_dir), path, "chunk")
    raw = read_landing_variant(spark, path, RUN_TS, multi_line=False)
    return raw.select(
        *[F.variant_get("raw_data", f"$.{c}", "string").alias(c) for c in ("result", "cur_unit", "deal_bas_r")],
        F.variant_get("raw_data", "$.user_id", "bigint").alias("user_id"),
        "file_name",
        "loaded_at",
    )


@query(
    "landing_write",
    sql.with_(sql.PAYLOAD)
    + " SELECT CAST(result AS VARCHAR) AS result, cur_unit, cur_nm, deal_bas_r, search_date FROM payload",
)
def landing_write(spark, sf_dir):
    path = _landed(spark, panels.events_landing(spark, sf_dir), "landing-write")
    landed = read_landing(spark, path, RUN_TS, multi_line=False)
    stamp = F.regexp_substr("file_name", F.lit("[0-9]{8}")).alias("search_date")
    return landed.select("result", "cur_unit", "cur_nm", "deal_bas_r", stamp)


@query(
    "landing_failfast",
    sql.with_(sql.PAYLOAD)
    + f" SELECT {PER_FILE}, 'aborted' AS second_load FROM payload GROUP BY search_date",
)
def landing_failfast(spark, sf_dir):
    """After a good load, files without a closing brace abort the next one whole."""
    layers, landing = _loaded(spark, sf_dir, "failfast")
    good = F.to_json(F.struct("result", "cur_unit", "cur_nm", "deal_bas_r"))
    broken = panels.events_landing(spark, sf_dir).select("search_date", F.regexp_replace(good, "}$", "").alias("value"))
    broken.write.mode("append").partitionBy("search_date").text(landing)
    try:
        run_load(layers, landing, RUN_TS, multi_line=False)
        outcome = "loaded"
    except (PySparkException, Py4JJavaError):
        outcome = "aborted"
    return _per_file(layers.raw()).withColumn("second_load", F.lit(outcome))


@query("raw_append", sql.with_(sql.PAYLOAD) + f" SELECT {PER_FILE} FROM payload GROUP BY search_date")
def raw_append(spark, sf_dir):
    """Two appends, the second of them repeated under its run id."""
    path = _landed(spark, panels.events_landing(spark, sf_dir), "raw-landing")
    layers = create_layers(spark, shared_folder(spark, "raw"))
    landed = read_landing_variant(spark, path, RUN_TS, multi_line=False)
    early = F.regexp_substr("file_name", F.lit("[0-9]{8}")) < MIDDLE
    layers.append_raw(landed.filter(early), "first")
    layers.append_raw(landed.filter(~early), "second")
    layers.append_raw(landed.filter(~early), "second")
    return _per_file(layers.raw())


@query(
    "load_ledger",
    sql.with_(sql.PAYLOAD)
    + f" SELECT {PER_FILE}, search_date >= '{MIDDLE}' AS second_load FROM payload GROUP BY search_date",
)
def load_ledger(spark, sf_dir):
    """Files of the first load are skipped by the second, all by the third."""
    rows = panels.events_landing(spark, sf_dir)
    landing = _landed(spark, rows.filter(F.col("search_date") < MIDDLE), "ledger-landing")
    layers = create_layers(spark, shared_folder(spark, "ledger"), stale_days=None)
    run_load(layers, landing, RUN_TS, run_id="first", multi_line=False)
    write_landing(rows.filter(F.col("search_date") >= MIDDLE), landing, "event_id")
    run_load(layers, landing, RUN_TS, run_id="second", multi_line=False)
    run_load(layers, landing, RUN_TS, run_id="third", multi_line=False)
    second = _per_file(layers.raw("second")).select("file_name", F.lit(True).alias("second_load"))
    return (
        _per_file(layers.raw()).join(second, "file_name", "left").withColumn("second_load", F.coalesce("second_load", F.lit(False)))
    )


@query(
    "append_new",
    sql.with_(sql.PAYLOAD) + f" SELECT {PER_FILE} FROM payload WHERE search_date >= '{MIDDLE}' GROUP BY search_date",
)
def append_new_query(spark, sf_dir):
    """The ledger as a plain anti join over landed rows."""
    path = _landed(spark, panels.events_landing(spark, sf_dir), "append-landing")
    landed = read_landing(spark, path, RUN_TS, multi_line=False)
    early = F.regexp_substr("file_name", F.lit("[0-9]{8}")) < MIDDLE
    ledger = landed.filter(early).select("file_path", "file_mtime", "file_size").distinct()
    return _per_file(append_new(landed, ledger))


@query(
    "empty_day_skip",
    sql.with_(sql.LANDED, sql.mart("stg"))
    + """ SELECT 'skipped' AS status, (SELECT count(*) FROM payload) AS raw_rows, (SELECT count(*) FROM stg) AS staging_rows,
       (SELECT count(*) FROM m) AS mart_rows""",
)
def empty_day_skip(spark, sf_dir):
    """A landing of empty arrays, one per event date, changes no layer."""
    layers, _ = _loaded(spark, sf_dir, "empty-day")
    closed = shared_folder(spark, "empty-day-closed")
    days = panels.events_landing(spark, sf_dir).select("search_date").distinct()
    days.withColumn("value", F.lit("[]")).write.partitionBy("search_date").text(closed)
    result = run_load(layers, closed, RUN_TS, multi_line=False)

    def rows(frame: DataFrame):
        return frame.agg(F.count("*")).scalar()

    return layers.raw().agg(F.count("*").alias("raw_rows")).select(
        F.lit(result.status).alias("status"),
        "raw_rows",
        rows(layers.read("staging")).alias("staging_rows"),
        rows(layers.read("mart")).alias("mart_rows"),
    )


@query(
    "layer_tables",
    LANDED_MART
    + """ SELECT 'raw' AS layer, count(*) AS rows FROM payload
UNION ALL SELECT 'staging', count(*) FROM stg UNION ALL SELECT 'mart', count(*) FROM m""",
)
def layer_tables(spark, sf_dir):
    layers, _ = _loaded(spark, sf_dir, "tables")
    tables = layers.publish(layers.root.rsplit("-", 1)[1] + "_")
    counts = [
        spark.table(table).agg(F.count("*").alias("rows")).select(F.lit(layer).alias("layer"), "rows")
        for layer, table in tables.items()
    ]
    return counts[0].unionByName(counts[1]).unionByName(counts[2])


@query("mart_scan", LANDED_MART + " SELECT result_date, cur_unit, change_pct FROM m")
def mart_scan(spark, sf_dir):
    layers, _ = _loaded(spark, sf_dir, "scan")
    return scan_mart(layers, ["result_date", "cur_unit", "change_pct"])


@query(
    "stored_panel",
    LANDED_MART
    + """ SELECT m.*, cur_nm FROM m
LEFT JOIN (SELECT cur_unit, max(cur_nm) AS cur_nm FROM stg GROUP BY cur_unit) USING (cur_unit)""",
)
def stored_panel(spark, sf_dir):
    """The enriched panel from the stored layers in one call."""
    layers, _ = _loaded(spark, sf_dir, "stored-panel")
    return StoredPanel(layers).enriched().select(*MART_COLUMNS, "cur_nm")


@query("stored_period", LANDED_MART + "," + sql.period("m", 22) + " " + MART_SQL.replace("FROM m", "FROM p"))
def stored_period(spark, sf_dir):
    """The period's start comes from the kept dates."""
    layers, _ = _loaded(spark, sf_dir, "stored-period")
    return StoredPanel(layers).period(22).select(*MART_COLUMNS)


@query(
    "stored_history",
    LANDED_MART
    + """ SELECT result_date, count(*) AS rows,
  CASE WHEN count(*) = (SELECT count(DISTINCT cur_unit) FROM m) THEN 'complete' ELSE 'partial' END AS status
FROM m GROUP BY result_date""",
)
def stored_history(spark, sf_dir):
    """All dates of the load history, after the newer half was loaded before the older."""
    rows = panels.events_landing(spark, sf_dir)
    landing = _landed(spark, rows.filter(F.col("search_date") >= MIDDLE), "stored-history-landing")
    layers = create_layers(spark, shared_folder(spark, "stored-history"), stale_days=None)
    run_load(layers, landing, RUN_TS, multi_line=False)
    write_landing(rows.filter(F.col("search_date") < MIDDLE), landing, "event_id")
    run_load(layers, landing, RUN_TS, multi_line=False)
    return StoredPanel(layers).history(None)


@query(
    "stored_ops",
    LANDED_MART
    + """ SELECT max(result_date) AS latest_date,
  count(*) FILTER (result_date = (SELECT max(result_date) FROM m)) AS rows,
  count(DISTINCT cur_unit) AS expected,
  greatest(count(DISTINCT cur_unit) - count(*) FILTER (result_date = (SELECT max(result_date) FROM m)), 0) AS shortfall,
  (SELECT count(*) FROM (SELECT CAST(unnest(generate_series(min(result_date), max(result_date), INTERVAL 1 DAY)) AS DATE) AS d FROM m)
   WHERE isodow(d) < 6 AND d NOT IN (SELECT result_date FROM m)) AS missing_days,
  'ok' AS status
FROM m""",
)
def stored_ops(spark, sf_dir):
    layers, _ = _loaded(spark, sf_dir, "stored-ops")
    return StoredPanel(layers).ops().drop("last_updated").withColumn("missing_days", F.col("missing_days").cast("long"))


@query("backfill_job", LANDED_MART + " " + MART_SQL)
def backfill_job(spark, sf_dir):
    """The middle third of the events' dates is loaded first; two backfills that overlap it add the rest."""
    events = panels.events_panel(spark, sf_dir)
    first, last = events.agg(F.min("result_date"), F.max("result_date")).first()
    landing = _landed(spark, panels.events_landing(spark, sf_dir), "backfill-landing")
    layers = create_layers(spark, shared_folder(spark, "backfill"), stale_days=None)
    third, days = (last - first) / 3, timedelta(days=3)
    for start, end in [(first + third, last - third), (first, first + third + days), (last - third - days, last)]:
        run_load(layers, landing, RUN_TS, start, end, multi_line=False)
    return layers.read("mart").select(*MART_COLUMNS)


@query(
    "export_files",
    N_NAMED
    + ","
    + sql.period("m", 250)
    + f" SELECT result_date, {sql.label('cur_unit', 'cur_nm')} AS cur_unit, rate, prev_rate, change_pct, ma_5, cur_nm FROM p",
)
def export_files(spark, sf_dir):
    """The CSV files, read back."""
    path = shared_folder(spark, "export")
    panel = named_nation_mart(spark, sf_dir)
    export_panel(panel, path, n=250)
    return spark.read.schema(panel.schema).option("header", True).csv(path)


@query("rebuild", LANDED_MART + " " + MART_SQL)
def rebuild_job(spark, sf_dir):
    """The newer half is landed first; the full recompute follows load times and lines, not the order of runs."""
    rows = panels.events_landing(spark, sf_dir)
    landing = _landed(spark, rows.filter(F.col("search_date") >= MIDDLE), "rebuild-landing")
    layers = create_layers(spark, shared_folder(spark, "rebuild"), stale_days=None)
    run_load(layers, landing, RUN_TS, multi_line=False)
    write_landing(rows.filter(F.col("search_date") < MIDDLE), landing, "event_id")
    run_load(layers, landing, RUN_TS, multi_line=False)
    rebuild(layers, RUN_TS)
    return layers.read("mart").select(*MART_COLUMNS)


@query("stream_ingest", LANDED_MART + " " + MART_SQL)
def stream_ingest(spark, sf_dir):
    """Two rounds of the stream; the second finds only the files added since."""
    rows = panels.events_landing(spark, sf_dir)
    landing = _landed(spark, rows.filter(F.col("search_date") < MIDDLE), "stream-landing")
    layers = create_layers(spark, shared_folder(spark, "stream"), stale_days=None)
    checkpoint = layers.path("checkpoint")
    start_stream(layers, landing, checkpoint, RUN_TS, multi_line=False).awaitTermination()
    write_landing(rows.filter(F.col("search_date") >= MIDDLE), landing, "event_id")
    start_stream(layers, landing, checkpoint, RUN_TS, multi_line=False).awaitTermination()
    return layers.read("mart").select(*MART_COLUMNS)

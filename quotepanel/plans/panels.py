"""Quote panels derived from the star-schema and event tables.

E: one code per event type; S: one per supplier; N: one per nation. Each takes
the newest stored value per (date, code); nothing is averaged. The keyed
``max`` combines on the map side, so a supplier or event type with a third of
all rows still shuffles at most one row per date from each map task.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from quotepanel.functions.text import fmt_num

# Events below this value stand for failed responses (result 2).
FAILED_BELOW = 5


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _newest(rows: DataFrame, code: str, order: list[str]) -> DataFrame:
    picked = F.max(F.struct(*order, "rate")).alias("newest")
    return rows.groupBy("result_date", code).agg(picked)


def events_panel(spark: SparkSession, sf_dir: str) -> DataFrame:
    """E, with ``updated_at`` = time of the picked event."""
    rows = table(spark, sf_dir, "events").select(
        F.to_date("ts").alias("result_date"),
        F.col("event_type").alias("cur_unit"),
        "ts",
        "event_id",
        F.col("value").alias("rate"),
    )
    return _newest(rows, "cur_unit", ["ts", "event_id"]).select(
        "result_date",
        "cur_unit",
        F.upper("cur_unit").alias("cur_nm"),
        "newest.rate",
        F.col("newest.ts").cast("timestamp_ntz").alias("updated_at"),
    )


def units_panel(spark: SparkSession, sf_dir: str) -> DataFrame:
    """E with ``purchase`` quoted per 100 units."""
    code = F.when(F.col("cur_unit") == "purchase", "purchase(100)").otherwise(F.col("cur_unit"))
    return events_panel(spark, sf_dir).withColumn("cur_unit", code)


def suppliers_panel(spark: SparkSession, sf_dir: str) -> DataFrame:
    """S, unnamed."""
    rows = table(spark, sf_dir, "lineitem").select(
        F.to_date("l_shipdate").alias("result_date"),
        "l_suppkey",
        "l_orderkey",
        "l_linenumber",
        F.col("l_extendedprice").alias("rate"),
    )
    # Grouped by the number, which sorts and shuffles cheaper than its text.
    newest = _newest(rows, "l_suppkey", ["l_orderkey", "l_linenumber"])
    return newest.select("result_date", F.col("l_suppkey").cast("string").alias("cur_unit"), "newest.rate")


def supplier_names(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "supplier").select(
        F.col("s_suppkey").cast("string").alias("cur_unit"), F.col("s_name").alias("cur_nm")
    )


def nations_panel(spark: SparkSession, sf_dir: str) -> DataFrame:
    """N, named by region.

    Nations and regions are small enough by their files for Spark to broadcast
    them. A customer with very many orders is split by the adaptive skew join;
    above the join the keyed ``max`` combines on the map side again.
    """
    nations = table(spark, sf_dir, "nation").join(
        table(spark, sf_dir, "region"), F.col("n_regionkey") == F.col("r_regionkey")
    )
    customers = table(spark, sf_dir, "customer").join(nations, F.col("c_nationkey") == F.col("n_nationkey"))
    rows = (
        table(spark, sf_dir, "orders")
        .join(customers, F.col("o_custkey") == F.col("c_custkey"))
        .select(
            F.to_date("o_orderdate").alias("result_date"),
            F.col("n_name").alias("cur_unit"),
            "o_orderkey",
            F.col("o_totalprice").alias("rate"),
            F.col("r_name").alias("cur_nm"),
        )
    )
    picked = F.max(F.struct("o_orderkey", "rate", "cur_nm")).alias("newest")
    return rows.groupBy("result_date", "cur_unit").agg(picked).select(
        "result_date", "cur_unit", "newest.cur_nm", "newest.rate"
    )


def _payload(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = table(spark, sf_dir, "events")
    return events.select(
        "event_id",
        "ts",
        "user_id",
        F.date_format("ts", "yyyyMMdd").alias("search_date"),
        F.when(F.col("value") < FAILED_BELOW, 2).otherwise(1).alias("result"),
        F.col("event_type").alias("cur_unit"),
        F.upper("event_type").alias("cur_nm"),
        fmt_num(F.col("value") * 1000, 2).alias("deal_bas_r"),
    )


def events_raw(spark: SparkSession, sf_dir: str) -> DataFrame:
    """E_raw: one RAW row per event, loaded at the event's time."""
    payload = F.struct("result", "cur_unit", "cur_nm", "deal_bas_r")
    return _payload(spark, sf_dir).select(
        F.to_variant_object(payload).alias("raw_data"),
        F.col("event_id").alias("pos"),
        F.format_string("exchange_rate_%s.json", "search_date").alias("file_name"),
        F.lit("").alias("file_path"),
        F.lit(0).cast("long").alias("block"),
        F.lit(0).cast("long").alias("line"),
        F.col("ts").cast("timestamp_ntz").alias("loaded_at"),
    )


def events_landing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Landing rows, one per event, with ``user_id`` as a field the pipeline does not know and ``event_id`` as their order."""
    return _payload(spark, sf_dir).select(
        "search_date", "result", "cur_unit", "cur_nm", "deal_bas_r", "user_id", "event_id"
    )


def event_chunks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``events_landing`` with a chunk number that bounds rows per landed line."""
    return _payload(spark, sf_dir).select(
        "search_date",
        "result",
        "cur_unit",
        "cur_nm",
        "deal_bas_r",
        "user_id",
        F.floor(F.col("event_id") / 500).alias("chunk"),
    )

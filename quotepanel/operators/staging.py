"""RAW -> STAGING: path extraction, valid rows, latest load per key, casts."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from quotepanel.functions.numeric import amount, file_stamp, stamp_date, try_amount, try_stamp_date

# Fixed value: the response code of a good quote.
VALID_RESULT = "1"

# Rows of one landing file stand in the order of block, line and position.
ROW_ORDER = ["loaded_at", "file_name", "file_path", "block", "line", "pos"]


def extract(df: DataFrame, paths: dict[str, str], column: str = "raw_data") -> DataFrame:
    """Add one string column per ``{name: '$.path'}`` of a VARIANT column."""
    return df.withColumns({name: F.variant_get(column, path, "string") for name, path in paths.items()})


def valid_rows(raw: DataFrame) -> DataFrame:
    """Rows whose ``result`` is 1 as number or text; a missing one is dropped."""
    return raw.filter(F.variant_get("raw_data", "$.result", "string") == VALID_RESULT)


def dedupe_latest(raw: DataFrame) -> DataFrame:
    """Newest load per (file date, code); within one load the later row of the later file.

    A keyed ``max`` over one struct combines on the map side, so however many
    copies one key has, at most one row per map task is shuffled for it.
    """
    newest = F.struct(
        *[c for c in ROW_ORDER if c in raw.columns],
        F.variant_get("raw_data", "$.cur_nm", "string").alias("cur_nm"),
        F.variant_get("raw_data", "$.deal_bas_r", "string").alias("deal_bas_r"),
    )
    return (
        raw.groupBy(
            file_stamp(F.col("file_name")).alias("stamp"),
            F.variant_get("raw_data", "$.cur_unit", "string").alias("cur_unit"),
        )
        .agg(F.max(newest).alias("newest"))
        .select("stamp", "cur_unit", "newest.cur_nm", "newest.deal_bas_r", "newest.loaded_at", "newest.file_name")
    )


def utc_now() -> Column:
    """Current time as UTC without zone, whatever the session zone is."""
    return F.convert_timezone(
        F.current_timezone(), F.lit("UTC"), F.current_timestamp().cast("timestamp_ntz")
    )


def stamp(df: DataFrame, run_ts=None) -> DataFrame:
    """Add ``updated_at``: the given zone-less run time, or now in UTC."""
    at = utc_now() if run_ts is None else F.lit(run_ts).cast("timestamp_ntz")
    return df.withColumn("updated_at", at)


def staging(raw: DataFrame, run_ts=None) -> DataFrame:
    """Typed staging rows; a bad date or amount fails the query."""
    typed = dedupe_latest(valid_rows(raw)).select(
        stamp_date(F.col("stamp")).alias("result_date"),
        "cur_unit",
        "cur_nm",
        amount(F.col("deal_bas_r")).alias("rate"),
        "loaded_at",
    )
    return stamp(typed, run_ts)


def staging_quarantine(raw: DataFrame, run_ts=None) -> tuple[DataFrame, DataFrame]:
    """As ``staging``, but rows that do not parse come back as a second frame."""
    parsed = dedupe_latest(valid_rows(raw)).withColumns(
        {
            "result_date": try_stamp_date(F.col("stamp")),
            "rate": try_amount(F.col("deal_bas_r")),
        }
    )
    bad = (F.col("stamp").isNotNull() & F.col("result_date").isNull()) | (
        F.col("deal_bas_r").isNotNull() & F.col("rate").isNull()
    )
    good = parsed.filter(~bad).select("result_date", "cur_unit", "cur_nm", "rate", "loaded_at")
    rejected = parsed.filter(bad).select("file_name", "stamp", "cur_unit", "deal_bas_r")
    return stamp(good, run_ts), rejected

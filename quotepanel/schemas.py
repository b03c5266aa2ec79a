"""Declared schemas of the landing, RAW, STAGING and MART layers."""

from pyspark.sql import types as T

KEYS = ["result_date", "cur_unit"]

# Payload fields the pipeline reads; the landing files may carry more.
PAYLOAD_FIELDS = ["result", "cur_unit", "cur_nm", "deal_bas_r"]

LANDING = T.StructType([T.StructField(name, T.StringType()) for name in PAYLOAD_FIELDS])

RAW = T.StructType(
    [
        T.StructField("raw_data", T.VariantType()),
        T.StructField("pos", T.IntegerType()),
        T.StructField("file_name", T.StringType()),
        T.StructField("file_path", T.StringType()),
        T.StructField("block", T.LongType()),
        T.StructField("line", T.LongType()),
        T.StructField("loaded_at", T.TimestampNTZType()),
    ]
)

STAGING = T.StructType(
    [
        T.StructField("result_date", T.DateType()),
        T.StructField("cur_unit", T.StringType()),
        T.StructField("cur_nm", T.StringType()),
        T.StructField("rate", T.DoubleType()),
        T.StructField("loaded_at", T.TimestampNTZType()),
        T.StructField("updated_at", T.TimestampNTZType()),
    ]
)

MART = T.StructType(
    [
        T.StructField("result_date", T.DateType()),
        T.StructField("cur_unit", T.StringType()),
        T.StructField("rate", T.DoubleType()),
        T.StructField("prev_rate", T.DoubleType()),
        T.StructField("change_pct", T.DoubleType()),
        T.StructField("ma_5", T.DoubleType()),
        T.StructField("updated_at", T.TimestampNTZType()),
    ]
)

# Kept beside each STAGING bucket: its codes with their name, rows, repeated
# dates, and the first and last four quotes.
CODES = T.StructType(
    [
        T.StructField("cur_unit", T.StringType()),
        T.StructField("cur_nm", T.StringType()),
        T.StructField("rows", T.LongType()),
        T.StructField("repeated", T.LongType()),
        T.StructField(
            "quotes",
            T.ArrayType(
                T.StructType(
                    [
                        T.StructField("result_date", T.DateType()),
                        T.StructField("rate", T.DoubleType()),
                        T.StructField("updated_at", T.TimestampNTZType()),
                    ]
                )
            ),
        ),
    ]
)

# Kept beside each MART bucket: its dates with their rows, repeated codes and last update.
DATES = T.StructType(
    [
        T.StructField("result_date", T.DateType()),
        T.StructField("rows", T.LongType()),
        T.StructField("repeated", T.LongType()),
        T.StructField("updated_at", T.TimestampNTZType()),
    ]
)

LEDGER = T.StructType(
    [
        T.StructField("path", T.StringType()),
        T.StructField("mtime", T.TimestampType()),
        T.StructField("size", T.LongType()),
        T.StructField("run_id", T.StringType()),
        T.StructField("gen", T.IntegerType()),
    ]
)

# Folders that were not current at ``seen``.
TRASH = T.StructType(
    [
        T.StructField("path", T.StringType()),
        T.StructField("seen", T.TimestampType()),
        T.StructField("gen", T.IntegerType()),
    ]
)

# One row per (layer, bucket) a run replaced; the highest seq is current.
COMMITS = T.StructType(
    [
        T.StructField("layer", T.StringType()),
        T.StructField("bucket", T.StringType()),
        T.StructField("snapshot", T.StringType()),
        T.StructField("run_id", T.StringType()),
        T.StructField("seq", T.LongType()),
        T.StructField("gen", T.IntegerType()),
    ]
)

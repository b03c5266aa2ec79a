"""Landed JSON files: one per search date, an array of one object per code.

All files of a folder tree are read, compressed ones by their extension. Files
with one array or object per line are split over tasks. A file that holds its
array over several lines is read whole (``multi_line``), one task per file,
unless it is large: then it is cut at the ends of its objects
(``read_landing_split``). Compressed files have no cuts and are always one task.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from quotepanel.schemas import LANDING, PAYLOAD_FIELDS

# Fixed value: landing file name of one search date.
FILE_NAME = "exchange_rate_%s.json"


def _reader(spark: SparkSession, multi_line: bool, mode: str):
    return spark.read.option("multiLine", multi_line).option("mode", mode).option("recursiveFileLookup", True)


def _landed_name() -> Column:
    # Folders written by write_landing carry the date, plain files their name.
    folder_date = F.regexp_extract("_metadata.file_path", "search_date=([0-9]{8})/", 1)
    return F.when(folder_date != "", F.format_string(FILE_NAME, folder_date)).otherwise(F.col("_metadata.file_name"))


def _lineage() -> list[Column]:
    """The file as it is, and the block of it that a line stands in."""
    return [F.col("_metadata.file_path").alias("file_path"), F.col("_metadata.file_block_start").alias("block")]


def numbered(documents: DataFrame) -> DataFrame:
    """Documents as read, with the order of the lines of a block."""
    return documents.withColumn("line", F.monotonically_increasing_id())


def _load_time(loaded_at) -> Column:
    from quotepanel.operators.staging import utc_now

    return utc_now() if loaded_at is None else F.lit(loaded_at).cast("timestamp_ntz")


def read_landing(
    spark: SparkSession, paths: str | list[str], loaded_at=None, mode: str = "FAILFAST", multi_line: bool = True
) -> DataFrame:
    """Payload fields as strings, one row per array element, with lineage.

    ``[]`` gives no row; in FAILFAST mode a malformed file fails the query.
    """
    landed = _reader(spark, multi_line, mode).schema(LANDING).json(paths)
    return landed.select(
        *PAYLOAD_FIELDS,
        _landed_name().alias("file_name"),
        F.col("_metadata.file_path").alias("file_path"),
        F.col("_metadata.file_modification_time").alias("file_mtime"),
        F.col("_metadata.file_size").alias("file_size"),
        _load_time(loaded_at).alias("loaded_at"),
    )


def elements(documents: DataFrame, loaded_at=None) -> DataFrame:
    """RAW rows of a frame with one VARIANT document per file or line."""
    array = F.try_variant_get("document", "$", "array<variant>")
    # One column of lineage is fixed before the generator: file metadata is
    # a property of the scan, not of the exploded rows.
    lineage = ["file_name", "file_path", "block", "line"]
    named = documents.select("document", *lineage)
    return named.select(
        F.posexplode(F.coalesce(array, F.array("document"))).alias("pos", "raw_data"), *lineage
    ).select("raw_data", "pos", *lineage, _load_time(loaded_at).alias("loaded_at"))


def read_landing_variant(
    spark: SparkSession,
    paths: str | list[str],
    loaded_at=None,
    mode: str = "FAILFAST",
    multi_line: bool = True,
    files: DataFrame | None = None,
) -> DataFrame:
    """Array elements as VARIANT, unknown fields kept; the RAW schema.

    ``files`` (a column ``path``) keeps only the elements of those files.
    """
    documents = _reader(spark, multi_line, mode).option("singleVariantColumn", "document").json(paths)
    documents = numbered(documents.select("document", _landed_name().alias("file_name"), *_lineage()))
    if files is not None:
        documents = documents.join(files.select(F.col("path").alias("file_path")), "file_path", "left_semi")
    return elements(documents, loaded_at)


# Record boundaries of a large array.

# What may stand between two closing braces of an array of flat objects.
OPENING, NEXT, CLOSING, EMPTY = r"(?s)^\s*\[\s*\{.*", r"(?s)^\s*,\s*\{.*", r"^\s*\]\s*$", r"^\s*\[\s*\]\s*$"


def _cuts(spark: SparkSession, paths: str | list[str]) -> DataFrame:
    """The text up to each closing brace, whichever task reads it, and what it can be in an array of flat objects."""
    text = spark.read.option("recursiveFileLookup", True).option("lineSep", "}").text(paths)
    rows = numbered(text.select("value", _landed_name().alias("file_name"), *_lineage()))
    candidate = F.try_parse_json(F.concat(F.regexp_extract("value", r"(?s)^\s*[\[,]\s*(\{.*)$", 1), F.lit("}")))
    rows = rows.withColumn("document", candidate)
    known = F.col("document").isNotNull()
    kind = (
        F.when(F.col("value").rlike(OPENING) & known, "opening")
        .when(F.col("value").rlike(NEXT) & known, "next")
        .when(F.col("value").rlike(CLOSING), "closing")
        .when(F.col("value").rlike(EMPTY), "empty")
    )
    return rows.withColumn("kind", kind)


def flat_files(cuts: DataFrame) -> DataFrame:
    """The files that are one array of objects without objects or braces inside, by every piece of their text."""
    place = F.struct("block", "line")
    by_file = cuts.groupBy("file_path").agg(
        F.count(F.lit(1)).alias("pieces"),
        F.count("kind").alias("good"),
        F.count_if(F.col("kind") == "opening").alias("openings"),
        F.count_if(F.col("kind") == "closing").alias("closings"),
        F.min_by("kind", place).alias("first"),
        F.max_by("kind", place).alias("last"),
    )
    whole = (F.col("first") == "opening") & (F.col("last") == "closing") & (F.col("openings") == 1) & (F.col("closings") == 1)
    empty = (F.col("pieces") == 1) & (F.col("first") == "empty")
    return by_file.filter((F.col("pieces") == F.col("good")) & (whole | empty)).select("file_path")


def read_landing_split(
    spark: SparkSession, paths: str | list[str], loaded_at=None, files: DataFrame | None = None
) -> DataFrame:
    """``read_landing_variant`` for large multi-line arrays: a file is read by as many tasks as it has splits.

    An array of flat objects parts at its closing braces. If every piece of a
    file is such an object, the cuts were right: a brace inside a text or an
    inner object leaves a piece that does not parse. Any other file is read
    whole, malformed ones with their error.
    """
    cuts = _cuts(spark, paths)
    if files is not None:
        cuts = cuts.join(files.select(F.col("path").alias("file_path")), "file_path", "left_semi")
    flat = flat_files(cuts)
    rows = cuts.filter(F.col("kind").isin("opening", "next")).join(flat, "file_path", "left_semi")
    lineage = ["file_name", "file_path", "block", "line"]
    split = rows.select(F.col("document").alias("raw_data"), F.lit(0).alias("pos"), *lineage, _load_time(loaded_at).alias("loaded_at"))
    others = cuts.select("file_path").distinct().join(flat, "file_path", "left_anti").select(F.col("file_path").alias("path"))
    return split.unionByName(read_landing_variant(spark, paths, loaded_at, files=others))


def stream_landing(spark: SparkSession, path: str, max_files: int | None = None, multi_line: bool = True) -> DataFrame:
    """Streaming counterpart: one VARIANT document per new file or line."""
    reader = (
        spark.readStream.option("multiLine", multi_line)
        .option("mode", "FAILFAST")
        .option("recursiveFileLookup", True)
        .option("singleVariantColumn", "document")
    )
    if max_files is not None:
        reader = reader.option("maxFilesPerTrigger", max_files)
    return reader.json(path).select("document", _landed_name().alias("file_name"), *_lineage())


def list_files(spark: SparkSession, path: str) -> DataFrame:
    """Path, modification time and size of the landed files; contents unread."""
    return (
        spark.read.format("binaryFile")
        .option("recursiveFileLookup", True)
        .load(path)
        .select(F.col("_metadata.file_path").alias("path"), F.col("modificationTime").alias("mtime"), F.col("length").alias("size"))
    )


def folders_of(files: DataFrame) -> list[str]:
    """Folders that hold ``files``, none inside another: one per date, however many files a date has."""
    folder = F.regexp_extract("path", "^(.*)/[^/]*$", 1).alias("folder")
    found = sorted(row["folder"] for row in files.select(folder).distinct().collect())
    outer: list[str] = []
    for path in found:
        if not outer or not path.startswith(outer[-1] + "/"):
            outer.append(path)
    return outer


def rewritten_files(listing: DataFrame, ledger: DataFrame) -> DataFrame:
    """Files that were loaded before and have changed since."""
    return new_files(listing, ledger).join(ledger.select("path").distinct(), "path", "left_semi")


def new_files(listing: DataFrame, ledger: DataFrame) -> DataFrame:
    """Files not loaded yet; a rewritten file counts as new."""
    return listing.join(ledger, ["path", "mtime", "size"], "left_anti")


def append_new(landed: DataFrame, ledger: DataFrame) -> DataFrame:
    """Rows of ``read_landing`` from files the ledger does not hold."""
    return landed.join(ledger, ["file_path", "file_mtime", "file_size"], "left_anti")


def write_landing(df: DataFrame, path: str, order: str | None = None) -> None:
    """Payload rows to one folder per ``search_date`` (yyyyMMdd text), one object per line.

    With ``order``, the lines of a date and its files by name follow that
    column, which is not written itself.
    """
    if order is None:
        # Rebalancing gives each date few files and splits a date that is large.
        rows = df.hint("rebalance", "search_date")
    else:
        rows = df.repartitionByRange("search_date", order).sortWithinPartitions("search_date", order).drop(order)
    rows.write.mode("append").partitionBy("search_date").json(path)


def write_landing_arrays(df: DataFrame, path: str, chunk: str) -> None:
    """As ``write_landing`` with one array per line, one line per ``chunk`` of a date.

    The ``chunk`` column must bound the rows of one line.
    """
    payload = F.collect_list(F.struct(*[c for c in df.columns if c not in ("search_date", chunk)]))
    lines = df.groupBy("search_date", chunk).agg(F.to_json(payload).alias("value"))
    lines.select("search_date", "value").write.mode("append").partitionBy("search_date").option(
        "compression", "gzip"
    ).text(path)

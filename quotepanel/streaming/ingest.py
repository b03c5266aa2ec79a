"""File stream over the landing folder into the three layers."""

from __future__ import annotations

from datetime import date

from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.streaming import StreamingQuery

from quotepanel.plans.daily import apply_load, landed_rows, new_attempt
from quotepanel.sources.landing import elements, list_files, numbered, rewritten_files, stream_landing
from quotepanel.sources.layers import Layers


def _ticks(spark: SparkSession, like: DataFrame) -> DataFrame:
    """Rows without a document: a batch comes about although no file is new."""
    nothing = [F.lit(None).cast(field.dataType).alias(field.name) for field in like.schema]
    return spark.readStream.format("rate").load().select(*nothing)


def stream_ingest(
    layers: Layers,
    landing: str,
    checkpoint: str,
    run_ts=None,
    max_files: int | None = None,
    multi_line: bool = True,
    stream_id: str | None = None,
    as_of: date | None = None,
) -> StreamingQuery:
    """Load every file not seen yet and every file rewritten since, batch by batch, then stop.

    A batch is one run of the daily load, named after the stream and its batch
    id, so one that is replayed after a failure is recognised and changes
    nothing. The stream's own id lives in its checkpoint: a new checkpoint or
    a second stream is another stream, whose batches are all loaded. The
    windows of the mart run inside the batch.

    A file stream does not see a file rewritten in place. So each batch also
    compares the folder with the ledger, which holds path, time and size of
    all files loaded, and loads those that differ as a run of its own; ticks
    make a batch where no file is new. The listing is taken before anything is
    read: a file that changes later differs from its ledger row next time.
    """

    def load(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        stream = stream_id or spark.sparkContext.getLocalProperty("sql.streaming.queryId")
        if not stream:
            raise RuntimeError("the stream has no id; pass stream_id")
        run_id = f"stream-{stream}-{batch_id:09d}"
        attempt = new_attempt(run_id)
        listing = layers.stage("listing", list_files(spark, landing), attempt)
        changed = layers.stage("rewritten", rewritten_files(listing, layers.ledger()), attempt)
        documents = batch.filter("file_path IS NOT NULL")
        seen = layers.stage("seen", documents.select(F.col("file_path").alias("path")).distinct(), attempt)
        if not seen.isEmpty():
            apply_load(layers, elements(numbered(documents), run_ts), run_id, run_ts, as_of)
            layers.append_ledger(listing.join(seen, "path", "left_semi"), run_id)
        again = landed_rows(layers, changed, run_ts, multi_line)
        if again is not None:
            apply_load(layers, again, f"{run_id}-rewritten", run_ts, as_of)
            layers.append_ledger(changed, f"{run_id}-rewritten")

    documents = stream_landing(layers.spark, landing, max_files, multi_line)
    return (
        documents.unionByName(_ticks(layers.spark, documents))
        .writeStream.foreachBatch(load)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )

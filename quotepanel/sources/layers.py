"""RAW, STAGING and MART as Parquet folders with dated snapshots.

A run writes the date buckets it touches to new ``bucket=/snapshot=`` folders
and then appends one commit that makes them current, for all layers at once.
Nothing is overwritten in place: a run that dies before its commit leaves the
tables as they were, and a re-run writes under a new name. One run writes at
a time.

Beside STAGING and MART two small layers are committed with the same snapshots:
``codes`` (per bucket and code: name, rows, first and last four quotes) and
``dates`` (per date: rows, last update). Loads and look-ups read those.
"""

from __future__ import annotations

from collections.abc import Iterable
from dataclasses import dataclass
from datetime import date, datetime, timedelta, timezone

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, Observation, SparkSession, Window, functions as F
from pyspark.sql.types import StringType, StructField, StructType

from quotepanel.functions.dates import BUCKET
from quotepanel.operators.quality import STALE_DAYS, null_count
from quotepanel.operators.state import code_states, date_states
from quotepanel.schemas import CODES, COMMITS, DATES, KEYS, LEDGER, MART, RAW, STAGING, TRASH

GRAINS = ("yyyy", "yyyyMM", "yyyyMMdd")
SCHEMAS = {"staging": STAGING, "mart": MART, "codes": CODES, "dates": DATES}

LOGS = {"commits": COMMITS, "ledger": LEDGER, "trash": TRASH}

# Columns that must not be null, counted while a snapshot is written.
CHECKED = {"staging": [*KEYS, "rate"], "mart": [*KEYS, "rate"]}

# Catalog names of the layers.
TABLES = {
    "raw": "raw.exchange_rate_raw",
    "staging": "staging.exchange_rate_stg",
    "mart": "mart.exchange_rate_daily",
}


# Partitions of one catalog statement.
PARTITIONS_AT_ONCE = 500

# Column of the logs, and the layer of commit rows that only name a run.
GENERATION = "gen"
RUN = "run"


class ConcurrentRun(RuntimeError):
    """Two runs wrote at a time; this one is not visible and may be repeated."""


@dataclass(frozen=True)
class State:
    current: dict[str, dict[str, str]]  # layer -> bucket -> snapshot
    seq: int
    committed: bool  # by the run that asked


class Layers:
    """The layers under one folder.

    ``grain`` is the date text of a bucket and fixed for the life of the
    folder: ``yyyyMM`` suits small panels, whose days are tiny; ``yyyyMMdd``
    large ones, where a daily load should not rewrite its whole month. A mart
    whose latest date is more than ``stale_days`` before a run's day fails its
    gate; None turns that off, for histories and part loads.
    """

    def __init__(self, spark: SparkSession, root: str, grain: str = "yyyyMM", stale_days: int | None = STALE_DAYS):
        if grain not in GRAINS:
            raise ValueError(f"grain must be one of {GRAINS}")
        self.spark = spark
        self.root = root.rstrip("/")
        self.grain = grain
        self.stale_days = stale_days

    def path(self, name: str) -> str:
        return f"{self.root}/{name}"

    def create(self) -> Layers:
        """Create the append-only tables if absent."""
        for name, schema in LOGS.items():
            if not self._glob(f"{name}/{GENERATION}=*"):
                empty = StructType([f for f in schema if f.name != GENERATION])
                self.spark.createDataFrame([], empty).write.mode("append").parquet(f"{self.path(name)}/{GENERATION}=0")
        return self

    # RAW: append-only, one folder per run, so that a repeated run replaces
    # its own rows and no others.

    def append_raw(self, landed: DataFrame, run_id: str) -> DataFrame:
        (
            landed.withColumn("load", F.lit(run_id))
            .write.mode("overwrite")
            .option("partitionOverwriteMode", "dynamic")
            .partitionBy("load")
            .parquet(self.path("raw"))
        )
        return self.raw(run_id)

    def raw(self, run_id: str | None = None) -> DataFrame:
        path = self.path("raw") if run_id is None else f"{self.path('raw')}/load={run_id}"
        try:
            return self.spark.read.schema(RAW).parquet(path).select(*RAW.names)
        except AnalysisException as missing:
            # A load without rows writes no folder.
            if missing.getCondition() != "PATH_NOT_FOUND":
                raise
            return self.spark.createDataFrame([], RAW)

    # Logs: rows are appended to the newest generation; compaction writes the
    # next one, and older ones are no longer read.

    def _generation(self, name: str) -> int:
        return max((int(path.rsplit("=", 1)[1]) for path in self._glob(f"{name}/{GENERATION}=*")), default=0)

    def _append(self, name: str, rows: DataFrame, generation: int) -> None:
        rows.write.mode("append").parquet(f"{self.path(name)}/{GENERATION}={generation}")

    def _newest(self, name: str, schema) -> DataFrame:
        rows = self.spark.read.schema(schema).option("basePath", self.path(name))
        return rows.parquet(f"{self.path(name)}/{GENERATION}={self._generation(name)}")

    def ledger(self) -> DataFrame:
        return self._newest("ledger", LEDGER).drop(GENERATION)

    def append_ledger(self, files: DataFrame, run_id: str) -> None:
        rows = files.withColumn("run_id", F.lit(run_id)).select(*[c for c in LEDGER.names if c != GENERATION])
        self._append("ledger", rows, self._generation("ledger"))

    def compact(self) -> None:
        """Commits and ledger as a new generation of few files; run it between loads."""
        newest = Window.partitionBy("layer", BUCKET).orderBy(F.desc("seq"))
        commits = self.commits()
        current = commits.withColumn("nth", F.row_number().over(newest)).filter("nth = 1").drop("nth")
        # One more row per run, so that a repeated run is still recognised.
        runs = commits.groupBy("run_id").agg(F.max("seq").alias("seq"), F.max_by("snapshot", "seq").alias("snapshot"))
        known = runs.select(F.lit(RUN).alias("layer"), F.col("run_id").alias(BUCKET), "snapshot", "run_id", "seq")
        rows = current.filter(F.col("layer") != RUN).unionByName(known)
        self._append("commits", rows.coalesce(1), self._generation("commits") + 1)
        files = self.ledger().dropDuplicates(["path", "mtime", "size"])
        self._append("ledger", files, self._generation("ledger") + 1)

    # STAGING and MART.

    def commits(self) -> DataFrame:
        """The commits that count: of two with one number the earlier file."""
        written = self._newest("commits", COMMITS).drop(GENERATION)
        timed = written.select("*", F.struct("_metadata.file_modification_time", "snapshot").alias("at"))
        first = F.min("at").over(Window.partitionBy("seq"))
        return timed.withColumn("first", first).filter(F.col("at") == F.col("first")).drop("at", "first")

    def state(self, run_id: str = "") -> State:
        """What is current, in one look at the commits.

        Collects one row per layer and date bucket.
        """
        rows = (
            self.commits()
            .groupBy("layer", BUCKET)
            .agg(
                F.max_by("snapshot", "seq").alias("snapshot"),
                F.max("seq").alias("seq"),
                F.max(F.col("run_id") == run_id).alias("ours"),
            )
            .collect()
        )
        current = {layer: {r[BUCKET]: r["snapshot"] for r in rows if r["layer"] == layer} for layer in SCHEMAS}
        return State(current, max((r["seq"] for r in rows), default=0), any(r["ours"] for r in rows))

    def folders(
        self,
        layer: str,
        buckets: Iterable[str] | None = None,
        since: date | None = None,
        until: date | None = None,
        pending: dict[str, str] | None = None,
        state: State | None = None,
    ) -> dict[str, str]:
        """Bucket and snapshot of the folders that ``read`` opens."""
        chosen = (state or self.state()).current[layer] | (pending or {})
        if buckets is not None:
            chosen = {b: chosen[b] for b in buckets if b in chosen}
        if since is not None:
            chosen = {b: s for b, s in chosen.items() if b >= f"{since:%Y%m%d}"[: len(b)]}
        if until is not None:
            chosen = {b: s for b, s in chosen.items() if b <= f"{until:%Y%m%d}"[: len(b)]}
        return chosen

    def read(
        self,
        layer: str,
        buckets: Iterable[str] | None = None,
        since: date | None = None,
        until: date | None = None,
        pending: dict[str, str] | None = None,
        state: State | None = None,
    ) -> DataFrame:
        """The layer as of ``state`` (default: now), with its ``bucket`` column.

        ``buckets``, ``since`` and ``until`` choose the folders to read, not
        the rows; ``pending`` shows snapshots a run has not committed yet.
        """
        chosen = self.folders(layer, buckets, since, until, pending, state)
        schema = StructType([*SCHEMAS[layer], StructField(BUCKET, StringType())])
        if not chosen:
            return self.spark.createDataFrame([], schema)
        folders = [self._folder(layer, b, s) for b, s in sorted(chosen.items())]
        return (
            self.spark.read.schema(schema)
            .option("basePath", self.path(layer))
            .parquet(*folders)
            .select(*schema.names)
        )

    def _folder(self, layer: str, bucket: str, snapshot: str) -> str:
        return f"{self.path(layer)}/{BUCKET}={bucket}/snapshot={snapshot}"

    def bucket(self) -> Column:
        return F.date_format("result_date", self.grain)

    def write_snapshot(self, layer: str, rows: DataFrame, snapshot: str) -> dict[str, int]:
        """Write whole buckets under a new snapshot name, not yet visible.

        Returns what passed by: ``rows``, ``nulls`` in the checked columns and,
        for the kept layers, ``repeated`` keys. The counts belong to the stage
        that writes, so a task that runs twice counts once.
        """
        bucket = F.col(BUCKET) if BUCKET in rows.columns else self.bucket().alias(BUCKET)
        columns = SCHEMAS[layer].names
        order = [c for c in ("cur_unit", "result_date") if c in columns]
        seen = Observation()
        counts = {"rows": F.count(F.lit(1))}
        if layer in CHECKED:
            counts["nulls"] = null_count(CHECKED[layer])
        if "repeated" in columns:
            counts["repeated"] = F.coalesce(F.sum("repeated"), F.lit(0))
        (
            rows.select(*columns, bucket, F.lit(snapshot).alias("snapshot"))
            # Few files per bucket, a large bucket over many tasks, and codes
            # together so that a selection skips row groups.
            .hint("rebalance", BUCKET)
            .observe(seen, *[count.alias(name) for name, count in counts.items()])
            .sortWithinPartitions(BUCKET, "snapshot", *order)
            .write.mode("append")
            .partitionBy(BUCKET, "snapshot")
            .parquet(self.path(layer))
        )
        return seen.get

    def keep_codes(self, snapshot: str) -> int:
        """Write the ``codes`` of a STAGING snapshot; returns its repeated keys."""
        states = code_states(self.read_snapshot("staging", snapshot), self.bucket())
        return self.write_snapshot("codes", states, snapshot)["repeated"]

    def keep_dates(self, snapshot: str) -> int:
        """Write the ``dates`` of a MART snapshot; returns its repeated keys."""
        return self.write_snapshot("dates", date_states(self.read_snapshot("mart", snapshot)), snapshot)["repeated"]

    def newest(self, layer: str, pending: dict[str, str] | None = None, state: State | None = None) -> DataFrame:
        """The newest bucket of a layer: it holds the latest date, since rows are never deleted."""
        known = self.folders(layer, pending=pending, state=state)
        return self.read(layer, [max(known)] if known else [], pending=pending, state=state)

    def read_snapshot(self, layer: str, snapshot: str) -> DataFrame:
        """All buckets of one snapshot, committed or not."""
        try:
            return (
                self.spark.read.schema(SCHEMAS[layer])
                .parquet(f"{self.path(layer)}/{BUCKET}=*/snapshot={snapshot}")
                .select(*SCHEMAS[layer].names)
            )
        except AnalysisException as missing:
            # A snapshot without rows writes no folder.
            if missing.getCondition() != "PATH_NOT_FOUND":
                raise
            return self.spark.createDataFrame([], SCHEMAS[layer])

    def bucket_ranges(self, rows: DataFrame) -> dict[str, tuple[date, date]]:
        """First and last date with rows per bucket; at most one entry per calendar day."""
        return {bucket: (first, last) for bucket, (first, last, _) in self.bucket_facts(rows).items()}

    def bucket_facts(self, rows: DataFrame) -> dict[str, tuple[date, date, int]]:
        """As ``bucket_ranges``, with the number of repeated keys."""
        by_key = rows.groupBy(*KEYS).agg(F.count(F.lit(1)).alias("rows"))
        facts = by_key.groupBy(self.bucket().alias(BUCKET)).agg(
            F.min("result_date").alias("first"), F.max("result_date").alias("last"), F.count_if(F.col("rows") > 1).alias("repeated")
        )
        return {row[BUCKET]: (row["first"], row["last"], row["repeated"]) for row in facts.collect()}

    def buckets_of(self, layer: str, snapshot: str) -> list[str]:
        """The buckets a snapshot has written."""
        folders = self._glob(f"{layer}/{BUCKET}=*/snapshot={snapshot}")
        return sorted(path.split(f"{BUCKET}=")[1].split("/")[0] for path in folders)

    def superseded(self) -> DataFrame:
        """Snapshot folders no longer current, to be deleted once no one reads them."""
        newest = Window.partitionBy("layer", BUCKET).orderBy(F.desc("seq"))
        old = self.commits().filter(F.col("layer") != RUN).withColumn("nth", F.row_number().over(newest)).filter("nth > 1")
        folder = F.concat_ws("/", F.lit(self.root), "layer", F.concat(F.lit(f"{BUCKET}="), BUCKET))
        return old.select("layer", BUCKET, F.concat(folder, F.lit("/snapshot="), "snapshot").alias("path"))

    # Retention.

    def _files(self):
        context = self.spark.sparkContext
        root = context._jvm.org.apache.hadoop.fs.Path(self.root)
        return root.getFileSystem(context._jsc.hadoopConfiguration()), context._jvm.org.apache.hadoop.fs.Path

    def _glob(self, pattern: str) -> list[str]:
        """Folders under the root; one entry per bucket and snapshot at most."""
        files, path = self._files()
        found = files.globStatus(path(self.path(pattern))) or []
        return [status.getPath().toString() for status in found]

    def unreferenced(self) -> list[str]:
        """Folders that no one who asks now would read: snapshots that are not current, work, old log generations."""
        current = self.state().current
        kept = {f"{layer}/{BUCKET}={b}/snapshot={s}" for layer, buckets in current.items() for b, s in buckets.items()}
        found = []
        for layer in SCHEMAS:
            for path in self._glob(f"{layer}/{BUCKET}=*/snapshot=*"):
                if "/".join(path.rsplit("/", 3)[1:]) not in kept:
                    found.append(path)
        found += self._glob("work/*")
        for name in LOGS:
            newest = self._generation(name)
            found += [path for path in self._glob(f"{name}/{GENERATION}=*") if int(path.rsplit("=", 1)[1]) < newest]
        return sorted(found)

    def expire(self, grace: timedelta, now: datetime | None = None) -> list[str]:
        """Delete what has been unreferenced for ``grace``, and note what is unreferenced now.

        A folder is deleted by the first call that finds it still unreferenced
        ``grace`` after an earlier call noted it. So whoever opened it while it
        was current has that long to finish, as has a run that has not
        committed yet; ``grace`` must exceed the longest of either. Returns the
        deleted folders. Run it between loads, like ``compact``.
        """
        now = now or datetime.now(timezone.utc)
        found = self.unreferenced()
        rows = self._newest("trash", TRASH).select("path", F.col("seen").cast("long").alias("seen")).collect()
        noted = {row["path"]: row["seen"] for row in rows}
        files, path = self._files()
        gone = [f for f in found if f in noted and noted[f] <= (now - grace).timestamp()]
        for folder in gone:
            files.delete(path(folder), True)
        # What was used again since is forgotten; the rest keeps its first time.
        left = [(f, datetime.fromtimestamp(noted.get(f, now.timestamp()), timezone.utc)) for f in found if f not in gone]
        schema = StructType([f for f in TRASH if f.name != GENERATION])
        self._append("trash", self.spark.createDataFrame(left, schema).coalesce(1), self._generation("trash") + 1)
        return gone

    def commit(self, run_id: str, snapshot: str, buckets: dict[str, Iterable[str]], state: State) -> None:
        """Make a snapshot current: one file, all layers at once.

        Refused if another run has committed since ``state`` was read.
        """
        seq = state.seq + 1
        rows = [(layer, bucket, snapshot, run_id, seq) for layer, bs in buckets.items() for bucket in bs]
        schema = StructType([f for f in COMMITS if f.name != GENERATION])
        newest = self._newest("commits", COMMITS).agg(F.max("seq")).first()[0] or 0
        if newest != state.seq:
            raise ConcurrentRun(f"another run committed before {run_id}")
        self._append("commits", self.spark.createDataFrame(rows, schema).coalesce(1), self._generation("commits"))
        if self.commits().filter((F.col("seq") == seq) & (F.col("snapshot") == snapshot)).isEmpty():
            raise ConcurrentRun(f"another run committed together with {run_id}")

    def stage(self, name: str, rows: DataFrame, attempt: str) -> DataFrame:
        """Write an intermediate result of a run and read it back.

        Later steps start from the written files, so a lost executor costs a
        task and not the whole chain before it.
        """
        path = f"{self.path('work')}/{attempt}/{name}"
        rows.write.parquet(path)
        return self.spark.read.schema(rows.schema).parquet(path)

    # Catalog.

    def publish(self, prefix: str = "") -> dict[str, str]:
        """Databases and tables over the current state, for SQL users."""
        tables = {layer: prefix + table for layer, table in TABLES.items()}
        current = self.state().current
        for layer, table in tables.items():
            database = table.split(".")[0]
            self.spark.sql(f"CREATE DATABASE IF NOT EXISTS {database} LOCATION '{self.path('databases')}/{database}'")
            if layer == "raw":
                fields, partition = RAW, "load"
            else:
                fields, partition = SCHEMAS[layer], BUCKET
            columns = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in fields)
            # External tables: dropping one leaves its files.
            self.spark.sql(f"DROP TABLE IF EXISTS {table}")
            self.spark.sql(
                f"CREATE TABLE {table} ({columns}, {partition} string) "
                f"USING parquet PARTITIONED BY ({partition}) LOCATION '{self.path(layer)}'"
            )
            if layer == "raw":
                self.spark.sql(f"MSCK REPAIR TABLE {table}")
                continue
            specs = [f"PARTITION ({BUCKET}='{b}') LOCATION '{self._folder(layer, b, s)}'" for b, s in sorted(current[layer].items())]
            for i in range(0, len(specs), PARTITIONS_AT_ONCE):
                self.spark.sql(f"ALTER TABLE {table} ADD {' '.join(specs[i : i + PARTITIONS_AT_ONCE])}")
            self.spark.catalog.refreshTable(table)
        return tables


def create_layers(spark: SparkSession, root: str, grain: str = "yyyyMM", stale_days: int | None = STALE_DAYS) -> Layers:
    return Layers(spark, root, grain, stale_days).create()


def scan_mart(layers: Layers, columns: list[str]) -> DataFrame:
    """Chosen mart columns; no other column is read."""
    return layers.read("mart").select(*columns)

"""Session defaults and the shared folder for written tables."""

from __future__ import annotations

import atexit
import shutil
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


# Temporary folders of local sessions by application, and folders that go with their driver.
_local_roots: dict[str, str] = {}
_removed_at_end: set[str] = set()


def local_session(cpus: int | str = "*", name: str = "quotepanel", memory: str = "8g") -> SparkSession:
    """Local session for tests and the bench; a cluster brings its own."""
    partitions = "8" if cpus == "*" else str(cpus)
    return (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName(name)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", memory)
        .config("spark.sql.shuffle.partitions", partitions)
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .getOrCreate()
    )


def shared_folder(spark: SparkSession, purpose: str) -> str:
    """A new folder under ``spark.checkpoint.dir``, which every executor sees.

    All folders of an application are in one, which goes when its driver ends.
    A cluster must name the shared folder; a local session without one gets a
    temporary folder of its own.
    """
    context = spark.sparkContext
    root = spark.conf.get("spark.checkpoint.dir", None) or _local_roots.get(context.applicationId)
    if not root:
        if context.master != "local" and not context.master.startswith("local["):
            raise ValueError("set spark.checkpoint.dir to a folder all executors share")
        root = _local_roots[context.applicationId] = tempfile.mkdtemp(prefix="quotepanel-")
        atexit.register(shutil.rmtree, root, ignore_errors=True)
    own = f"{root.rstrip('/')}/quotepanel/{context.applicationId}"
    if own not in _removed_at_end:
        _removed_at_end.add(own)
        folder = context._jvm.org.apache.hadoop.fs.Path(own)
        files = folder.getFileSystem(context._jsc.hadoopConfiguration())
        files.mkdirs(folder)
        files.deleteOnExit(folder)
    return f"{own}/{purpose}-{uuid.uuid4().hex[:12]}"


def stored(rows: DataFrame, purpose: str) -> DataFrame:
    """``rows`` as a table in the shared folder: computed once, lineage cut."""
    path = shared_folder(rows.sparkSession, purpose)
    rows.write.parquet(path)
    return rows.sparkSession.read.schema(rows.schema).parquet(path)

"""Session settings and the shared scratch folder."""

from __future__ import annotations

import shutil
import tempfile
import uuid
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession

from linkwatch.sources import files

# Runtime settings every job relies on.  UTC makes day windows start at UTC
# midnight; AQE splits skewed join partitions and coalesces small ones.
RUNTIME_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # percentile buffers are small until a group is large; allow more of them
    # per task before the object-hash aggregate falls back to sorting
    "spark.sql.objectHashAggregate.sortBased.fallbackThreshold": "4096",
    # inferring filters from long CASE cascades takes the optimizer exponential
    # time; the jobs state the filters they want on every side themselves
    "spark.sql.constraintPropagation.enabled": "false",
}

_CHECKPOINT_CONF = "spark.checkpoint.dir"
_local_folders: dict[str, str] = {}


def configure(spark: SparkSession) -> SparkSession:
    for key, value in RUNTIME_CONF.items():
        spark.conf.set(key, value)
    return spark


# Settings only a new session takes: recording a Python call site for every
# column expression is a round trip each, and rule tables have hundreds.
STARTUP_CONF = {"spark.python.sql.dataFrameDebugging.enabled": "false"}


def build_session(app: str = "linkwatch", master: str | None = None, **conf: str) -> SparkSession:
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    for key, value in {**STARTUP_CONF, **RUNTIME_CONF, **conf}.items():
        builder = builder.config(key, value)
    return configure(builder.getOrCreate())


def ship_package(spark: SparkSession) -> None:
    """Send this package to the executors, where it is not installed on them.

    Python workers need it for stateful processors and per-batch functions.
    """
    root = Path(__file__).resolve().parent
    # the driver serves this copy to executors as long as the application runs
    folder = tempfile.mkdtemp(prefix="spark-", dir="/tmp")
    archive = shutil.make_archive(f"{folder}/{root.name}", "zip", root.parent, root.name)
    spark.sparkContext.addPyFile(archive)


def shared_dir(spark: SparkSession) -> str:
    """The folder for checkpoints and staged tables.

    A cluster names it in ``spark.checkpoint.dir``.  Only a local master may
    fall back to a temporary folder, because there every task sees it.
    """
    named = spark.sparkContext.getConf().get(_CHECKPOINT_CONF) or spark.conf.get(
        _CHECKPOINT_CONF, None
    )
    if named:
        return named.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError(f"set {_CHECKPOINT_CONF} to a folder all executors can reach")
    app = spark.sparkContext.applicationId
    if app not in _local_folders:
        _local_folders[app] = tempfile.mkdtemp(prefix="spark-", dir="/tmp")
    return _local_folders[app]


_handed_out: list[str] = []


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh path under the shared folder."""
    path = f"{shared_dir(spark)}/{name}-{uuid.uuid4().hex}"
    _handed_out.append(path)
    return path


def landed(frame: DataFrame, name: str) -> DataFrame:
    """Write a frame below the shared folder and read it back.

    What is read later survives lost executors and is not computed again.
    """
    spark = frame.sparkSession
    path = scratch_path(spark, name)
    frame.write.parquet(path)
    return spark.read.schema(frame.schema).parquet(path)


def release_scratch(spark: SparkSession) -> int:
    """Delete what this process put under the shared folder; returns the number of paths.

    Results are lazy and may still read there: write or collect them first.
    """
    paths, _handed_out[:] = list(_handed_out), []
    for path in paths:
        files.delete(spark, path)
    return len(paths)

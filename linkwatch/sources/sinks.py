"""Replay-safe sinks.

Keyed upserts are kept as a log: every micro-batch writes its own partition
``batch_id=N`` and a rerun of the batch overwrites exactly that partition.
Readers resolve the log per key with an aggregate; ``compact`` rewrites it.
Nothing is read back while a stream writes, and nothing passes the driver.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from linkwatch.operators import exports as X
from linkwatch.operators.validate import computed_once
from linkwatch.sources import files

METRIC_KEYS = (
    "window_start",
    "window_end",
    "window_size_seconds",
    "agent_id",
    "target_id",
    "measurement_type",
)
REJECT_KEYS = ("source_topic", "source_partition", "source_offset")
BATCH = "source_batch_id"


def guarded(batch: DataFrame, largest: int | None) -> int | None:
    """Refuse a batch above the limit; the count stops one row past it."""
    if largest is None:
        return None
    rows = batch.limit(largest + 1).count()
    if rows > largest:
        raise RuntimeError("micro-batch output exceeded the configured number of rows")
    return rows


def append_batch(batch: DataFrame, path: str, batch_id: int) -> None:
    batch.write.mode("overwrite").parquet(f"{path}/{BATCH}={batch_id}")


def record_batch(spark: SparkSession, path: str, query: str, batch_id: int, rows: int) -> None:
    """Ledger row, written after the data; a replay overwrites it."""
    row = spark.range(1).select(
        F.lit(query).alias("query_name"),
        F.lit(batch_id).cast("bigint").alias("batch_id"),
        F.lit(rows).cast("bigint").alias("output_rows"),
        F.current_timestamp().alias("completed_at"),
    )
    row.write.mode("overwrite").parquet(f"{path}/query={query}/batch={batch_id}")


def read_ledger(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.parquet(path).select("query_name", "batch_id", "output_rows", "completed_at")


def resolve_last(log: DataFrame, keys: Sequence[str], version: str = BATCH) -> DataFrame:
    """Last writer wins, per key."""
    rest = [c for c in log.columns if c not in keys]
    return (
        log.groupBy(*keys)
        .agg(F.max_by(F.struct(*rest), F.col(version)).alias("row"))
        .select(*keys, "row.*")
    )


def resolve_first_seen(
    log: DataFrame,
    keys: Sequence[str] = REJECT_KEYS,
    failed_at: str = "failed_at",
    version: str = BATCH,
) -> DataFrame:
    """First failure time kept; errors, last time and batch from the last writer."""
    rest = [c for c in log.columns if c not in (*keys, failed_at)]
    return (
        log.groupBy(*keys)
        .agg(
            F.max_by(F.struct(*rest, F.col(failed_at).alias("last_failed_at")), F.col(version))
            .alias("row"),
            F.min_by(F.col(failed_at), F.col(version)).alias("first_failed_at"),
        )
        .select(*keys, "row.*", "first_failed_at")
    )


def upsert(
    existing: DataFrame | None, batch: DataFrame, keys: Sequence[str], version: str = BATCH
) -> DataFrame:
    """Table after a last-writer-wins merge, for targets rewritten as a whole.

    Within the batch the row of the largest ``version`` of a key is the last.
    """
    fresh = resolve_last(batch, keys, version).select(*batch.columns)
    if existing is None:
        return fresh
    return existing.join(fresh.select(*keys), list(keys), "left_anti").unionByName(fresh)


def compact(log: DataFrame, keys: Sequence[str], path: str) -> None:
    """Resolved copy of an upsert log under a new path, as its first batch."""
    resolve_last(log, keys).drop(BATCH).write.mode("overwrite").parquet(f"{path}/{BATCH}=-1")


def metrics_writer(path: str, ledger: str, largest: int | None = None, query: str = "window-metrics"):
    return _writer(path, ledger, largest, query)


def rejects_writer(path: str, ledger: str, largest: int | None = None, query: str = "invalid-measurements"):
    return _writer(path, ledger, largest, query)


def _writer(path: str, ledger: str, largest: int | None, query: str):
    def write(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        batch = batch.persist()
        try:
            rows = guarded(batch, largest)
            append_batch(batch, path, batch_id)
            record_batch(spark, ledger, query, batch_id, batch.count() if rows is None else rows)
        finally:
            batch.unpersist()

    return write


def replace_range(
    rows: DataFrame, path: str, first: dt.date, last: dt.date, column: str = "date_utc"
) -> None:
    """Replace the partitions of an inclusive day range.

    The new rows are written to a staging directory first.  Then the range's
    partitions are moved aside and the staged ones moved in, so a day that became
    empty is cleared.  If a move fails, what was published comes back.
    """
    spark = rows.sparkSession
    staged = files.sibling(path, "staging")
    inside = rows.where(F.col(column).between(F.lit(first), F.lit(last)))
    # several tasks may write one day; small ones are merged when the plan runs
    inside.hint("rebalance", column).write.mode("overwrite").partitionBy(column).parquet(staged)
    days = [
        f"{column}={(first + dt.timedelta(days=n)).isoformat()}"
        for n in range((last - first).days + 1)
    ]
    aside, new, moved, placed = files.sibling(path, "aside"), set(files.children(spark, staged)), [], []
    try:
        for name in days:
            if files.exists(spark, f"{path}/{name}"):
                files.move(spark, f"{path}/{name}", f"{aside}/{name}")
                moved.append(name)
        for name in days:
            if name in new:
                files.move(spark, f"{staged}/{name}", f"{path}/{name}")
                placed.append(name)
    except BaseException:
        for name in placed:
            files.delete(spark, f"{path}/{name}")
        for name in moved:
            files.move(spark, f"{aside}/{name}", f"{path}/{name}")
        raise
    finally:
        files.delete(spark, staged)
        files.delete(spark, aside)


def replace_snapshot(rows: DataFrame, path: str) -> None:
    """Replace a whole table; readers see the old one until the new is complete."""
    spark = rows.sparkSession
    staged = files.sibling(path, "staging")
    rows.write.mode("overwrite").parquet(staged)
    files.swap(spark, staged, path)


# --- CSV extracts -----------------------------------------------------------------


def write_csv(datasets: dict[str, DataFrame], folder: str) -> None:
    """Write the four extracts below a fresh folder."""
    if set(datasets) != set(X.DATASETS):
        raise ValueError(f"an export holds exactly {sorted(X.DATASETS)}")
    for name, rows in datasets.items():
        if tuple(rows.columns) != X.DATASETS[name]:
            raise ValueError(f"{name} has unexpected columns")
    for name, rows in datasets.items():
        rows.write.mode("overwrite").csv(
            f"{folder}/{name}", header=True, nullValue="", emptyValue="", lineSep="\n",
            encoding="UTF-8",
        )


def publish_csv(datasets: dict[str, DataFrame], out: str) -> None:
    """Write the four extracts aside and put them in place together.

    For readers that open fixed names; ``versions.publish_folders`` with
    ``write_csv`` moves nothing.
    """
    if not datasets:
        raise ValueError(f"an export holds exactly {sorted(X.DATASETS)}")
    spark = next(iter(datasets.values())).sparkSession
    staged = files.sibling(out, "staging")
    try:
        write_csv(datasets, staged)
        files.swap(spark, staged, out)
    finally:
        files.delete(spark, staged)


def csv_lines(spark: SparkSession, out: str, name: str) -> DataFrame:
    """Data lines of an extract, each marked when it has another width."""
    columns = X.DATASETS[name]
    schema = ", ".join([f"{c} string" for c in columns] + ["_bad string"])
    lines = spark.read.text(f"{out}/{name}").where(F.col("value") != ",".join(columns))
    parsed = F.from_csv("value", schema, {"columnNameOfCorruptRecord": "_bad"})
    return computed_once(lines, "row", parsed).select(
        "value", F.col("row._bad").isNotNull().alias("bad")
    )


def verify_csv(spark: SparkSession, out: str) -> DataFrame:
    """(dataset, row_count, problem) for each extract; a sound one has no problem."""
    present = {n for n in files.children(spark, out) if not n.startswith((".", "_"))}
    unexpected = sorted(present - set(X.DATASETS))
    if unexpected or set(X.DATASETS) - present:
        missing = sorted(set(X.DATASETS) - present)
        raise ValueError(f"missing extracts {missing}, unexpected extracts {unexpected}")
    result = None
    for name in sorted(X.DATASETS):
        header = spark.read.csv(f"{out}/{name}", header=True).columns
        counted = csv_lines(spark, out, name).agg(
            F.count(F.lit(1)).alias("row_count"), F.count(F.when(F.col("bad"), 1)).alias("bad")
        )
        n = F.col("row_count")
        problem = F.when(F.lit(tuple(header) != X.DATASETS[name]), F.lit("unexpected header")).when(
            F.col("bad") > 0, F.lit("line of another width")
        )
        if name in X.MINIMUM_ROWS:
            problem = problem.when(n < X.MINIMUM_ROWS[name], F.lit("too few rows"))
        if name in X.EXACT_ROWS:
            problem = problem.when(n != X.EXACT_ROWS[name], F.lit("unexpected row count"))
        part = counted.select(F.lit(name).alias("dataset"), "row_count", problem.alias("problem"))
        result = part if result is None else result.unionByName(part)
    return result

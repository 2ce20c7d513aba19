"""Published tables as numbered versions: what readers see changes in one step.

Below a table's folder, ``data/<name>`` folders are written once by Spark jobs
and never moved.  A version is a small file ``_versions/<number>.json`` that
names the folders it consists of, one per partition and not per file; the
greatest complete one is current.  A version file is created whole or not at
all where the store does that, and a broken one is passed over, so a writer that
stops at any point leaves the old version in place.  What such a writer left
behind is never read, and ``expire`` removes it.

A table has one writer at a time.  Two that begin from one version cannot both
publish: the second finds the number taken and fails.

Tables that change together are a release: a folder above theirs whose own
versions name a version of each table, so all of them change in one step.
"""

from __future__ import annotations

import datetime as dt
import json
import uuid
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from linkwatch.sources import files

WHOLE = "whole"  # the one part of a table that is replaced as a whole
PART = "published_part"


@dataclass(frozen=True)
class Version:
    """Parts by name with their folders, relative to the table; 0 is before the first."""

    number: int = 0
    parts: dict[str, str] = field(default_factory=dict)
    schema: dict | None = None


def _file(path: str, number: int) -> str:
    return f"{path}/_versions/{number:012d}.json"


def _numbers(spark: SparkSession, path: str) -> list[int]:
    names = (n.split(".") for n in files.children(spark, f"{path}/_versions"))
    return sorted(int(n[0]) for n in names if n[-1] == "json" and n[0].isdigit())


def load(spark: SparkSession, path: str, number: int) -> Version | None:
    """A version by number; None where its file is missing or was not finished."""
    try:
        found = json.loads(files.read_text(spark, _file(path, number)))
    except (FileNotFoundError, ValueError):
        return None
    return Version(number, found["parts"], found["schema"])


def current(spark: SparkSession, path: str) -> Version:
    for number in reversed(_numbers(spark, path)):
        found = load(spark, path, number)
        if found:
            return found
    return Version()


def publish(
    spark: SparkSession,
    path: str,
    base: Version,
    parts: dict[str, str],
    schema: dict | None = None,
    *,
    pass_over: bool = False,
) -> Version:
    """Make these parts the current version, unless another followed ``base`` meanwhile.

    ``pass_over`` leaves out what followed: a table of a release goes on from the
    version that was released, and the release itself finds other writers.
    """
    taken = _numbers(spark, path)
    if not pass_over and any(load(spark, path, n) for n in taken if n > base.number):
        raise FileExistsError(f"{path} has a version after {base.number}")
    number = max([base.number, *taken]) + 1
    text = json.dumps({"parts": parts, "schema": schema}, sort_keys=True)
    files.create_text(spark, _file(path, number), text)
    return Version(number, parts, schema)


def _fresh() -> str:
    return f"data/{uuid.uuid4().hex}"


def publish_range(
    rows: DataFrame,
    path: str,
    first: dt.date | None = None,
    last: dt.date | None = None,
    column: str = "date_utc",
    *,
    base: Version | None = None,
) -> Version:
    """Replace the days of an inclusive range; without bounds, all there are.

    Days of the range without rows are gone afterwards.  Rows outside the range
    or without a day are not taken.  An empty table keeps its columns.
    """
    spark = rows.sparkSession
    if PART in rows.columns:
        raise ValueError(f"{PART} is the name of a folder level")
    start = base or current(spark, path)
    inside = rows.where(F.col(column).isNotNull())
    if first is not None:
        inside = inside.where(F.col(column) >= F.lit(first))
    if last is not None:
        inside = inside.where(F.col(column) <= F.lit(last))
    folder = _fresh()
    # several tasks may write one day; small ones are merged when the plan runs
    named = inside.withColumn(PART, F.date_format(column, "yyyy-MM-dd")).hint("rebalance", PART)
    named.write.partitionBy(PART).parquet(f"{path}/{folder}")
    written = [n for n in files.children(spark, f"{path}/{folder}") if n.startswith(f"{PART}=")]
    low = first.isoformat() if first else ""
    high = last.isoformat() if last else "~"
    parts = {day: at for day, at in start.parts.items() if not low <= day <= high}
    parts |= {n.removeprefix(f"{PART}="): f"{folder}/{n}" for n in written}
    schema = rows.schema.jsonValue()
    return publish(spark, path, start, parts, schema, pass_over=base is not None)


def publish_table(rows: DataFrame, path: str, *, base: Version | None = None) -> Version:
    """Replace a whole table."""
    spark = rows.sparkSession
    start, folder = base or current(spark, path), _fresh()
    rows.write.parquet(f"{path}/{folder}")
    schema = rows.schema.jsonValue()
    return publish(spark, path, start, {WHOLE: folder}, schema, pass_over=base is not None)


def publish_folders(spark: SparkSession, path: str, write) -> Version:
    """Replace a bundle: ``write`` fills a fresh folder, which is published when it returns."""
    base, folder = current(spark, path), _fresh()
    write(f"{path}/{folder}")
    return publish(spark, path, base, {WHOLE: folder})


def bundle_folder(spark: SparkSession, path: str) -> str:
    """The folder of the current bundle."""
    found = current(spark, path)
    if WHOLE not in found.parts:
        raise FileNotFoundError(f"{path} has no published bundle")
    return f"{path}/{found.parts[WHOLE]}"


def read_table(
    spark: SparkSession,
    path: str,
    first: dt.date | None = None,
    last: dt.date | None = None,
    *,
    version: Version | None = None,
) -> DataFrame:
    """The current version, or an earlier one; a range opens the folders of its days alone."""
    found = version or current(spark, path)
    if found.schema is None:
        raise FileNotFoundError(f"{path} has no published table")
    schema = StructType.fromJson(found.schema)
    low = first.isoformat() if first else ""
    high = last.isoformat() if last else "~"
    names = [n for n in sorted(found.parts) if n == WHOLE or low <= n <= high]
    if not names:
        return spark.createDataFrame([], schema)
    return spark.read.schema(schema).parquet(*(f"{path}/{found.parts[n]}" for n in names))


def release(spark: SparkSession, root: str, base: Version, tables: dict[str, Version]) -> Version:
    """Make these versions of the tables below ``root`` current together."""
    return publish(spark, root, base, {name: str(v.number) for name, v in tables.items()})


def released(spark: SparkSession, root: str, name: str, at: Version | None = None) -> Version:
    """The version of a table in the current release, or in an earlier one."""
    number = (at or current(spark, root)).parts.get(name)
    found = load(spark, f"{root}/{name}", int(number)) if number else None
    return found or Version()


def expire(
    spark: SparkSession, path: str, keep: int = 2, named: set[int] | None = None
) -> int:
    """Delete all but the last ``keep`` complete versions and every folder none of them names.

    ``named`` gives the versions to keep by number instead.  Readers that began
    with an older version must have ended, and no writer may be at work.  Version
    files go first, so that none names a missing folder.  Returns the number of
    folders deleted.
    """
    if keep < 1:
        raise ValueError("the current version is always kept")
    numbers = _numbers(spark, path)
    kept: list[Version] = []
    for number in reversed(numbers):
        wanted = len(kept) < keep if named is None else number in named
        found = load(spark, path, number) if wanted else None
        if found:
            kept.append(found)
    if not kept:
        return 0
    for number in set(numbers) - {v.number for v in kept}:
        files.delete(spark, _file(path, number))
    used = {at.split("/")[1] for v in kept for at in v.parts.values() if "/" in at}
    gone = [n for n in files.children(spark, f"{path}/data") if n not in used]
    for name in gone:
        files.delete(spark, f"{path}/data/{name}")
    return len(gone)


def expire_release(spark: SparkSession, root: str, keep: int = 2) -> int:
    """The same for a release and its tables: what its last releases name stays."""
    expire(spark, root, keep)
    kept: dict[str, set[int]] = {}
    for number in _numbers(spark, root):
        for name, at in load(spark, root, number).parts.items():
            kept.setdefault(name, set()).add(int(at))
    return sum(expire(spark, f"{root}/{name}", named=v) for name, v in kept.items())

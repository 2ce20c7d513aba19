"""Helpers the operators of this folder share."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from linkwatch.session import scratch_path

# ASCII white space, as SQL text and as a regular expression class.
SPACE_CHARS = " \t\n\x0b\x0c\r"
SPACE_CLASS = r"[\x20\x09-\x0D]"


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder.rstrip('/')}/{name}.parquet")


# Removes the shuffle files of a query that has ended; what is written needs them no more.
_CLEAN_UP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def landed(frame: DataFrame, name: str) -> DataFrame:
    """Write a frame into the shared folder and read it back.

    This cuts the lineage: what is read later survives lost executors and is
    never computed a second time.  The shuffle files of the write are given
    back at once.
    """
    spark = frame.sparkSession
    path = scratch_path(spark, name)
    before = spark.conf.get(_CLEAN_UP)
    spark.conf.set(_CLEAN_UP, "true")
    try:
        frame.write.parquet(path)
    finally:
        spark.conf.set(_CLEAN_UP, before)
    return spark.read.schema(frame.schema).parquet(path)


def fresh(columns: list[str], name: str) -> str:
    """A column name that is not taken."""
    taken = {c.lower() for c in columns}
    while name.lower() in taken:
        name += "_"
    return name

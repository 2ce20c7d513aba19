"""Batch table readers."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def jdbc_table(spark: SparkSession, url: str, name: str, **options: str) -> DataFrame:
    """The same scan from a database, where its driver is on the class path."""
    return spark.read.format("jdbc").options(url=url, dbtable=name, **options).load()


def zone_free_to_utc(df: DataFrame, *columns: str) -> DataFrame:
    """Watermarks need TIMESTAMP; zone-free columns are taken as UTC."""
    return df.withColumns({c: F.col(c).cast("timestamp") for c in columns})

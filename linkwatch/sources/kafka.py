"""Kafka-shaped frames: stream source, batch source and sink."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from linkwatch.schemas import KAFKA_SCHEMA, RAW_TOPICS


def kafka_options(
    servers: str,
    topics: Iterable[str] = RAW_TOPICS,
    *,
    starting_offsets: str = "earliest",
    fail_on_data_loss: bool = True,
    group_prefix: str = "linkwatch",
) -> dict[str, str]:
    return {
        "kafka.bootstrap.servers": servers,
        "subscribe": ",".join(topics),
        "startingOffsets": starting_offsets,
        "failOnDataLoss": str(fail_on_data_loss).lower(),
        "groupIdPrefix": group_prefix,
    }


def kafka_source(spark: SparkSession, options: dict[str, str]) -> DataFrame:
    """Streaming read; needs the Kafka connector on the class path."""
    return spark.readStream.format("kafka").options(**options).load()


def file_source(spark: SparkSession, path: str, files_per_trigger: int | None = None) -> DataFrame:
    """Streaming read of landed records that have the Kafka columns."""
    reader = spark.readStream.schema(KAFKA_SCHEMA)
    if files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", files_per_trigger)
    return reader.parquet(path)


def kafka_sink_options(servers: str) -> dict[str, str]:
    return {
        "kafka.bootstrap.servers": servers,
        "kafka.acks": "all",
        "kafka.enable.idempotence": "true",
        "kafka.compression.type": "zstd",
    }


def keyed_json(df: DataFrame, topic: str, key: str | None, columns: Iterable[str]) -> DataFrame:
    """Kafka sink rows: compact JSON with its keys in sorted order."""
    body = F.to_json(F.struct(*[F.col(c) for c in sorted(columns)]), {"ignoreNullFields": "false"})
    key_column = F.col(key).cast("string") if key else F.lit(None).cast("string")
    return df.select(
        F.lit(topic).alias("topic"), key_column.alias("key"), body.alias("value")
    )

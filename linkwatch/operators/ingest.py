"""From checked records to typed tables, dead letters and failure ledgers."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from linkwatch import schemas as S
from linkwatch.functions.ids import uuid5
from linkwatch.functions.temporal import clock, utc_text
from linkwatch.operators.validate import instant
from linkwatch.sources.kafka import keyed_json

COORDINATES = ("source_topic", "source_partition", "source_offset")


def route(event_type: Column | str = "event_type") -> Column:
    """Topic of an event type; an unknown type has none."""
    source = F.col(event_type) if isinstance(event_type, str) else event_type
    result = F.when(F.lit(False), F.lit(None).cast("string"))
    for known, topic in S.TOPICS.items():
        result = result.when(source == known, F.lit(topic))
    return result


def check_references(checked: DataFrame, agents: DataFrame, endpoints: DataFrame) -> DataFrame:
    """Add an error for rows whose agent or endpoint is not known and enabled.

    Like the contract, references are looked at only where the record itself is
    sound.  No side is forced to be broadcast: the planner does it where the
    registry is below the broadcast threshold and otherwise joins by key, and
    AQE splits a hot agent.
    """
    known_agents = agents.where("enabled").select(
        F.col("agent_id").alias("_agent"), F.lit(True).alias("_agent_known")
    )
    known_endpoints = endpoints.where("enabled").select(
        F.col("endpoint_id").alias("_endpoint"), F.lit(True).alias("_endpoint_known")
    )
    endpoint = F.coalesce(F.col("event.target_id"), F.col("event.endpoint_id"))
    joined = checked.join(
        known_agents, F.col("event.agent_id") == F.col("_agent"), "left"
    ).join(known_endpoints, endpoint == F.col("_endpoint"), "left")
    sound = F.size("validation_errors") == 0
    reference = F.when(
        sound & F.col("_agent_known").isNull(), F.array(F.lit("unrecognized:agent_id"))
    ).when(
        sound & endpoint.isNotNull() & F.col("_endpoint_known").isNull(),
        F.array(F.lit("unrecognized:endpoint")),
    )
    return joined.withColumn(
        "validation_errors", F.coalesce(reference, F.col("validation_errors"))
    ).drop("_agent", "_agent_known", "_endpoint", "_endpoint_known")


def collapse_redeliveries(records: DataFrame) -> DataFrame:
    """One row per source coordinate, with how often it was delivered.

    A coordinate names one record of the log, so its copies are equal.  The
    grouping combines before the shuffle: a storm of copies of one record
    leaves one row per task.
    """
    rest = [c for c in records.columns if c not in COORDINATES]
    kept = F.min_by(F.struct(*rest), F.col("kafka_timestamp")).alias("kept")
    return (
        records.groupBy(*COORDINATES)
        .agg(kept, F.count(F.lit(1)).alias("deliveries"))
        .select(*COORDINATES, "kept.*", "deliveries")
    )


def first_arrivals(records: DataFrame, id_column: str = "event_id") -> DataFrame:
    """Coordinates of the first record of every event id.

    A minimum per id, not a window, so a repeated id never gathers in one task.
    """
    order = F.struct("kafka_timestamp", *COORDINATES)
    return (
        records.groupBy(F.col(id_column).alias("event_id"))
        .agg(F.min(order).alias("first"))
        .select("event_id", *[F.col(f"first.{c}").alias(c) for c in COORDINATES])
    )


def dedup_events(incoming: DataFrame, existing: DataFrame | None = None) -> DataFrame:
    """Mark which rows a log unique on event id and on coordinates would take.

    ``incoming`` holds each coordinate once (see ``collapse_redeliveries``).
    ``existing`` holds the log's ``event_id`` and coordinates.  It is consulted
    for the winners only; the mark goes back by coordinates, so no join key is
    hot and the collapsed rows keep their partitioning.
    """
    winners = first_arrivals(incoming)
    if existing is not None:
        winners = winners.join(existing.select("event_id"), "event_id", "left_anti").join(
            existing.select(*COORDINATES), list(COORDINATES), "left_anti"
        )
    marks = winners.select(*COORDINATES, F.lit(True).alias("_first"))
    return (
        incoming.join(marks, list(COORDINATES), "left")
        .withColumn("inserted", F.coalesce("_first", F.lit(False)))
        .drop("_first")
    )


def classify_outcome(checked: DataFrame, existing: DataFrame | None = None) -> DataFrame:
    """One row per coordinate: valid, duplicate or dead_lettered.

    Redeliveries beyond the first of an accepted record count as duplicates;
    ``deliveries`` keeps their number.
    """
    rows = collapse_redeliveries(
        checked.select(
            *COORDINATES,
            "kafka_timestamp",
            F.col("event.event_id").alias("event_id"),
            F.col("event.agent_id").alias("agent_id"),
            (F.size("validation_errors") == 0).alias("sound"),
        )
        # always true; keeps the count in every branch below, so that they read
        # one shuffle instead of decoding the records again
    ).where(F.col("deliveries") > 0)
    marked = dedup_events(rows.where("sound"), existing)
    sound = marked.withColumn(
        "outcome", F.when(F.col("inserted"), F.lit("valid")).otherwise(F.lit("duplicate"))
    ).drop("inserted")
    failed = rows.where(~F.col("sound")).withColumn("outcome", F.lit("dead_lettered"))
    return sound.unionByName(failed).drop("sound")


def outcome_counts(outcomes: DataFrame) -> DataFrame:
    """Processed deliveries per outcome."""
    extra = F.when(F.col("outcome") == "valid", F.col("deliveries") - 1).otherwise(F.lit(0))
    counted = outcomes.select(
        F.explode(
            F.array(
                F.struct(F.col("outcome"), (F.col("deliveries") - extra).alias("n")),
                F.struct(F.lit("duplicate").alias("outcome"), extra.alias("n")),
            )
        ).alias("part")
    )
    return (
        counted.groupBy(F.col("part.outcome").alias("outcome"))
        .agg(F.sum("part.n").alias("records"))
        .where("records > 0")
    )


def inserted_events(checked: DataFrame, existing: DataFrame | None = None) -> DataFrame:
    """Sound records the log takes, with their payload."""
    sound = collapse_redeliveries(checked.where(F.size("validation_errors") == 0))
    rows = sound.withColumn("event_id", F.col("event.event_id"))
    return dedup_events(rows, existing).where("inserted").drop("inserted", "deliveries")


def fan_out(inserted: DataFrame) -> dict[str, DataFrame]:
    """The typed tables, each a filter and projection of the accepted rows."""
    tables = {}
    for event_type, fields in S.TYPED_FIELDS.items():
        if event_type == S.INCIDENT:
            continue
        columns = [F.col(f"event.{f.name}").alias(f.name) for f in fields]
        tables[event_type] = inserted.where(F.col("event.event_type") == event_type).select(
            "event_id",
            F.col("event.agent_id").alias("agent_id"),
            instant("event_time").alias("event_time"),
            *columns,
        )
    return tables


def raw_event_log(inserted: DataFrame) -> DataFrame:
    envelope = (
        "event_type", "schema_version", "agent_id", "agent_role", "sequence_number",
        "correlation_id", "source_version",
    )
    return inserted.select(
        "event_id",
        *[F.col(f"event.{c}").alias(c) for c in envelope],
        instant("event_time").alias("event_time"),
        instant("published_time").alias("published_time"),
        *COORDINATES,
        F.col("original_payload").cast("string").alias("payload"),
        F.lit("valid").alias("quality_status"),
        F.col("kafka_timestamp").alias("received_at"),
    )


def republished(checked: DataFrame) -> DataFrame:
    """Sound measurements, duplicates included, as canonical JSON keyed by agent."""
    sound = checked.where(
        (F.size("validation_errors") == 0) & (F.col("event.event_type") == S.MEASUREMENT)
    )
    names = [f.name for f in S.measurement_schema().fields if f.name != S.CORRUPT]
    flat = sound.select(*[F.col(f"event.{n}").alias(n) for n in names])
    return keyed_json(flat, S.VALID_TOPIC, "agent_id", names)


def dead_letters(
    checked: DataFrame, now=None, prefix: str = "linkwatch-dead-letter", keep: Sequence[str] = ()
) -> DataFrame:
    """Dead-letter records; the id follows from the coordinates, so a replay repeats it.

    ``keep`` names further columns of the input to carry along.
    """
    at = F.current_timestamp() if now is None else clock(now)
    name = F.concat_ws(":", F.lit(prefix), *COORDINATES)
    return checked.where(F.size("validation_errors") > 0).select(
        uuid5(name).alias("dead_letter_id"),
        utc_text(at).alias("failed_time"),
        *COORDINATES,
        F.lit("EventValidationError").alias("error_class"),
        F.concat(
            F.lit("event validation failed: "), F.element_at("validation_errors", 1)
        ).alias("error_message"),
        "validation_errors",
        F.col("original_payload").cast("string").alias("original_payload"),
        "source_key",
        *keep,
    )


# The fields of a published dead letter.
DEAD_LETTER_FIELDS = (
    "dead_letter_id",
    "failed_time",
    *COORDINATES,
    "error_class",
    "error_message",
    "validation_errors",
    "original_payload",
)


def dead_letter_messages(letters: DataFrame) -> DataFrame:
    return keyed_json(letters, S.DEAD_LETTER_TOPIC, "source_key", DEAD_LETTER_FIELDS)


def merge_failures(existing: DataFrame | None, new: DataFrame) -> DataFrame:
    """Upsert by coordinates: attempts add up, first time kept, last error wins.

    Both sides carry ``attempt_count, first_failed_at, last_failed_at`` and the
    error columns; a fresh failure has an attempt count of one.
    """
    both = new if existing is None else existing.unionByName(new)
    latest = F.max_by(
        F.struct("source_key", "original_payload", "error_class", "error_message",
                 "validation_errors"),
        F.col("last_failed_at"),
    )
    return (
        both.groupBy(*COORDINATES)
        .agg(
            latest.alias("latest"),
            F.sum("attempt_count").alias("attempt_count"),
            F.min("first_failed_at").alias("first_failed_at"),
            F.max("last_failed_at").alias("last_failed_at"),
            F.max("dead_letter_published_at").alias("dead_letter_published_at"),
        )
        .select(
            *COORDINATES,
            "latest.*",
            "attempt_count",
            "first_failed_at",
            "last_failed_at",
            "dead_letter_published_at",
        )
    )


def fresh_failures(letters: DataFrame, failed_at: Column) -> DataFrame:
    return letters.select(
        *COORDINATES,
        "source_key",
        "original_payload",
        "error_class",
        "error_message",
        "validation_errors",
        F.lit(1).cast("bigint").alias("attempt_count"),
        failed_at.alias("first_failed_at"),
        failed_at.alias("last_failed_at"),
        F.lit(None).cast("timestamp").alias("dead_letter_published_at"),
    )


def mark_published(failures: DataFrame, published: DataFrame) -> DataFrame:
    """Set the publication time from (coordinates, published_at) rows."""
    stamps = published.groupBy(*COORDINATES).agg(F.max("published_at").alias("_at"))
    return (
        failures.join(stamps, list(COORDINATES), "left")
        .withColumn(
            "dead_letter_published_at", F.coalesce("_at", F.col("dead_letter_published_at"))
        )
        .drop("_at")
    )

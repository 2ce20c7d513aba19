"""Reporting views; the clock is always an argument."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from linkwatch.functions.numeric import at_least_zero, ratio
from linkwatch.functions.temporal import clock, seconds_between
from linkwatch.operators.daily import GRAIN

LIVE_COLUMNS = (
    "event_time",
    "agent_id",
    "target_id",
    "measurement_type",
    "success",
    "latency_ms",
    "packet_loss_pct",
    "jitter_ms",
)


def daily_reliability(fact: DataFrame) -> DataFrame:
    return fact.select(
        *GRAIN,
        "total_count",
        "success_count",
        "failure_count",
        ratio("success_count", "total_count", 100.0).alias("success_rate_pct"),
        "latency_count",
        "latency_sum_ms",
        ratio("latency_sum_ms", "latency_count").alias("mean_latency_ms"),
        "packet_loss_count",
        "packet_loss_sum_pct",
        ratio("packet_loss_sum_pct", "packet_loss_count").alias("mean_packet_loss_pct"),
    )


def incident_summary(
    incidents: DataFrame, agent_bridge: DataFrame, endpoint_bridge: DataFrame
) -> DataFrame:
    """Counts come from each bridge on its own; joining both would multiply rows."""

    def size_of(rows: DataFrame, name: str) -> DataFrame:
        return rows.groupBy("incident_id").agg(F.count(F.lit(1)).alias(name))

    agents = size_of(agent_bridge, "affected_agent_count")
    endpoints = size_of(endpoint_bridge, "affected_endpoint_count")
    return (
        incidents.join(agents, "incident_id", "left")
        .join(endpoints, "incident_id", "left")
        .withColumns(
            {
                c: F.coalesce(c, F.lit(0).cast("bigint"))
                for c in ("affected_agent_count", "affected_endpoint_count")
            }
        )
    )


def last_heartbeat(heartbeats: DataFrame) -> DataFrame:
    """Newest heartbeat per agent, ties by event id; an aggregate, so a chatty
    agent is reduced in the tasks that read it."""
    newest = F.max_by(
        F.struct("event_time", "local_queue_depth", "collection_errors"),
        F.struct("event_time", "event_id"),
    )
    return heartbeats.groupBy("agent_id").agg(newest.alias("h"))


def agent_status(agents: DataFrame, heartbeats: DataFrame, now) -> DataFrame:
    joined = agents.join(last_heartbeat(heartbeats), "agent_id", "left")
    at = F.col("h.event_time")
    return joined.select(
        "agent_id",
        "agent_role",
        "display_name",
        "enabled",
        at.alias("last_heartbeat_at"),
        at_least_zero(seconds_between(clock(now), at)).alias("heartbeat_age_seconds"),
        F.col("h.local_queue_depth").alias("local_queue_depth"),
        F.when(F.col("h.collection_errors").isNull(), F.lit(0))
        .otherwise(F.size("h.collection_errors"))
        .cast("int")
        .alias("collection_error_count"),
    )


def pipeline_status(
    raw_log: DataFrame,
    failures: DataFrame,
    stream_failures: DataFrame,
    batches: DataFrame,
    incidents: DataFrame,
    state_events: DataFrame,
    acknowledged: DataFrame,
    now,
) -> DataFrame:
    """One row of scalars; each table is reduced on its own and the seven tiny
    results are folded by a union."""
    at = clock(now)
    none_t, none_n = F.lit(None).cast("timestamp"), F.lit(None).cast("bigint")
    names = ("received", "batch", "letters", "stream", "active", "publish")

    def part(df: DataFrame, name: str, value: Column) -> DataFrame:
        reduced = df.agg(value.alias("x"))
        columns = []
        for n in names:
            blank = none_t if n in ("received", "batch") else none_n
            columns.append((F.col("x") if n == name else blank).alias(n))
        return reduced.select(*columns)

    count = F.count(F.lit(1))
    unpublished = state_events.join(acknowledged.select("event_id"), "event_id", "left_anti")
    parts = [
        part(raw_log, "received", F.max("received_at")),
        part(batches, "batch", F.max("completed_at")),
        part(failures.where(F.col("dead_letter_published_at").isNull()), "letters", count),
        part(stream_failures, "stream", count),
        part(incidents.where(F.col("status") != "resolved"), "active", count),
        part(unpublished, "publish", count),
    ]
    merged = parts[0]
    for p in parts[1:]:
        merged = merged.unionByName(p)
    row = merged.agg(*[F.max(n).alias(n) for n in names])
    return row.select(
        at.alias("observed_at"),
        F.col("received").alias("last_raw_event_received_at"),
        at_least_zero(seconds_between(at, "received")).alias("raw_event_age_seconds"),
        F.col("letters").alias("pending_dead_letter_count"),
        F.col("stream").alias("stream_processing_failure_count"),
        F.col("batch").alias("last_stream_batch_completed_at"),
        F.col("active").alias("active_incident_count"),
        F.col("publish").alias("pending_incident_publication_count"),
    )


def live_measurements(measurements: DataFrame) -> DataFrame:
    return measurements.select(*LIVE_COLUMNS)


def workflow_status(runs: DataFrame, now) -> DataFrame:
    end = F.coalesce(F.col("completed_at"), clock(now))
    return runs.withColumn("duration_seconds", seconds_between(end, "started_at"))

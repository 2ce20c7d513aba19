"""Star schema: daily reliability facts, incident facts, bridges, dimensions."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from linkwatch.functions.numeric import count_true, exact_sum
from linkwatch.functions.temporal import in_days, utc_date

GRAIN = ("date_utc", "agent_id", "endpoint_id", "source_kind", "probe_type")
MEASURES = (
    "total_count",
    "success_count",
    "failure_count",
    "latency_sum_ms",
    "latency_count",
    "packet_loss_sum_pct",
    "packet_loss_count",
)
INCIDENT_FACT = (
    "incident_id",
    "start_time",
    "end_time",
    "status",
    "incident_type",
    "severity",
    "confidence_score",
    "duration_ms",
    "rule_version",
    "state_revision",
)


def probe_rows(
    measurements: DataFrame,
    checks: DataFrame,
    first: dt.date | None = None,
    last: dt.date | None = None,
) -> DataFrame:
    """Measurements and checks under one layout; the day range reaches the scans."""
    if first is not None and last is not None:
        measurements = measurements.where(in_days("event_time", first, last))
        checks = checks.where(in_days("event_time", first, last))
    date = utc_date("event_time").alias("date_utc")
    probes = measurements.select(
        date,
        "agent_id",
        F.col("target_id").alias("endpoint_id"),
        F.lit("network_measurement").alias("source_kind"),
        F.col("measurement_type").alias("probe_type"),
        "success",
        "latency_ms",
        "packet_loss_pct",
    )
    services = checks.select(
        date,
        "agent_id",
        "endpoint_id",
        F.lit("service_check").alias("source_kind"),
        F.col("check_type").alias("probe_type"),
        "success",
        F.col("total_duration_ms").alias("latency_ms"),
        F.lit(None).cast("double").alias("packet_loss_pct"),
    )
    return probes.unionByName(services)


def daily_fact(
    measurements: DataFrame,
    checks: DataFrame,
    first: dt.date | None = None,
    last: dt.date | None = None,
) -> DataFrame:
    """Mergeable counts and sums per grain, combined before the one shuffle."""
    rows = probe_rows(measurements, checks, first, last)
    return rows.groupBy(*GRAIN).agg(
        F.count(F.lit(1)).alias("total_count"),
        count_true(F.col("success")).alias("success_count"),
        count_true(~F.col("success")).alias("failure_count"),
        exact_sum("latency_ms").alias("latency_sum_ms"),
        F.count("latency_ms").alias("latency_count"),
        exact_sum("packet_loss_pct").alias("packet_loss_sum_pct"),
        F.count("packet_loss_pct").alias("packet_loss_count"),
    )


def date_bounds(*dates: DataFrame) -> DataFrame:
    """Smallest and largest ``date_utc`` over several tables, one row."""
    parts = [d.agg(F.min("date_utc").alias("lo"), F.max("date_utc").alias("hi")) for d in dates]
    merged = parts[0]
    for part in parts[1:]:
        merged = merged.unionByName(part)
    return merged.agg(F.min("lo").alias("from_date"), F.max("hi").alias("through_date"))


def event_dates(events: DataFrame) -> DataFrame:
    return events.select(utc_date("event_time").alias("date_utc"))


def date_spine(bounds: DataFrame) -> DataFrame:
    """One row per day of the bounds; nothing when there are none."""
    days = F.sequence("from_date", "through_date", F.expr("INTERVAL 1 DAY"))
    return bounds.where(F.col("from_date").isNotNull()).select(
        F.explode(days).alias("date_utc")
    )


def previous_utc_day(now: dt.datetime) -> tuple[dt.date, dt.date]:
    day = now.astimezone(dt.timezone.utc).date() - dt.timedelta(days=1)
    return day, day


def checked_range(first: dt.date, last: dt.date, longest: int | None = None) -> None:
    if first > last:
        raise ValueError("the first day must not follow the last")
    if longest is not None and (last - first).days + 1 > longest:
        raise ValueError(f"a range holds at most {longest} days")


def scd1(dimension: DataFrame | None, source: DataFrame, key: str, columns) -> DataFrame:
    """Overwrite known members, add new ones, keep members the source dropped."""
    fresh = source.select(key, *columns)
    if dimension is None:
        return fresh
    kept = dimension.select(key, *columns).join(fresh.select(key), key, "left_anti")
    return kept.unionByName(fresh)


def probe_kinds(measurements: DataFrame, checks: DataFrame) -> DataFrame:
    probes = measurements.select(
        F.lit("network_measurement").alias("source_kind"),
        F.col("measurement_type").alias("probe_type"),
    )
    services = checks.select(
        F.lit("service_check").alias("source_kind"), F.col("check_type").alias("probe_type")
    )
    return probes.unionByName(services).distinct()


def insert_absent(dimension: DataFrame | None, rows: DataFrame, keys) -> DataFrame:
    if dimension is None:
        return rows
    return dimension.unionByName(rows.join(dimension.select(*keys), list(keys), "left_anti"))


def incident_fact(incidents: DataFrame) -> DataFrame:
    return incidents.select(*INCIDENT_FACT)


def bridge(incidents: DataFrame, members: str, member: str) -> DataFrame:
    """Distinct (incident, member) pairs of an array column.

    Duplicates can only meet inside one array when incidents are unique, so
    they are removed there and the rows need no shuffle.
    """
    return incidents.select(
        "incident_id", F.explode(F.array_distinct(members)).alias(member)
    )


def surrogate(*columns: Column | str) -> Column:
    """A repeatable row id out of business columns."""
    return F.xxhash64(*columns)

"""Incident lifecycle over a whole history of evaluations.

States come from ``history``, which cuts a key's history into blocks of a day
and scans them in parallel.  Only keys and ticks travel there; what a finding
says is joined to its transitions at the end, by key and tick.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from linkwatch import schemas as S
from linkwatch.functions.ids import uuid5
from linkwatch.functions.temporal import TickSpan, iso_text, millis_between, timestamp_of
from linkwatch.operators.history import Automaton, evaluations
from linkwatch.operators.snapshot import cadence_of
from linkwatch.session import landed

ID_PREFIX = "linkwatch-incident"
STATE_PREFIX = "linkwatch-incident-state"
CLASSIFIER_ID = "linkwatch-classifier-01"

DAY_US = 86_400_000_000
_KEY = ("site_id", "incident_key")
FINDING_BODY = (
    "incident_type",
    "severity",
    "confidence_score",
    "affected_agents",
    "affected_endpoints",
    "evidence",
    "peak_latency_ms",
    "maximum_packet_loss_pct",
    "summary",
    "recommended_action",
)


def misses_to_resolve(cfg: S.Thresholds) -> int:
    """The first miss only starts recovery, so resolving takes at least two."""
    return max(2, cfg.resolve_observations)


def hits_to_open(cfg: S.Thresholds) -> int:
    """The first hit only makes a candidate, so opening takes at least two."""
    return max(2, cfg.open_observations)


def incident_id(site: Column, key: Column, start: Column, prefix: str = ID_PREFIX) -> Column:
    name = F.concat_ws(
        ":", F.lit(prefix), F.when(site != "", site), key, iso_text(start)
    )
    return uuid5(name)


def lifecycle(
    findings: DataFrame, span: TickSpan, cfg: S.Thresholds, prefix: str = ID_PREFIX
) -> DataFrame:
    """Every state transition of every incident up to the last tick."""
    step = cadence_of(cfg).step_us
    automaton = Automaton(hits_to_open(cfg), misses_to_resolve(cfg))
    found = landed(
        findings.select(
            *_KEY,
            (F.col("tick_us") / F.lit(step)).cast("bigint").alias("hit"),
            F.struct(*FINDING_BODY).alias("finding"),
        ),
        "findings",
    )
    states = evaluations(
        found.select(*_KEY, F.col("hit").alias("tick")),
        automaton,
        max(DAY_US // step, automaton.to_resolve),
    )
    states = states.where(F.col("tick") <= F.floor(span.last / F.lit(step)))
    at, start = (timestamp_of(F.col(c) * F.lit(step)) for c in ("tick", "start"))
    return states.join(found, [*_KEY, "hit"]).select(
        incident_id(F.col("site_id"), F.col("incident_key"), start, prefix).alias("incident_id"),
        *_KEY,
        at.alias("observed_at"),
        start.alias("start_time"),
        F.when(F.col("status") == "resolved", at).alias("end_time"),
        "status",
        F.col("revision").alias("state_revision"),
        F.col("positives").alias("positive_observations"),
        F.col("miss").alias("recovery_observations"),
        "finding.*",
    )


def incident_state(transitions: DataFrame) -> DataFrame:
    """Current row per incident; peaks are the largest seen, the rest the latest.

    Long incidents combine map-side: the aggregate keeps one row per incident
    and task.
    """
    fixed = ("site_id", "incident_key", "start_time")
    peaks = ("peak_latency_ms", "maximum_packet_loss_pct")
    moving = [c for c in transitions.columns if c not in (*fixed, *peaks, "incident_id")]
    return (
        transitions.groupBy("incident_id")
        .agg(
            F.max_by(F.struct(*fixed, *moving), F.col("state_revision")).alias("now"),
            *[F.max(p).alias(p) for p in peaks],
        )
        .select("incident_id", "now.*", *peaks)
        .withColumnRenamed("observed_at", "last_observed_at")
        .withColumn("duration_ms", duration_ms(F.col("last_observed_at")))
        .withColumn("rule_version", F.lit(S.RULE_VERSION))
    )


def duration_ms(at: Column) -> Column:
    return F.greatest(F.lit(0.0), millis_between(at, F.col("start_time")))


def incident_events(transitions: DataFrame, prefix: str = STATE_PREFIX) -> DataFrame:
    """The published incident event of every transition."""
    event_id = uuid5(F.concat_ws(":", F.lit(prefix), F.col("incident_id"), "state_revision"))
    return transitions.select(
        event_id.alias("event_id"),
        F.lit(S.INCIDENT).alias("event_type"),
        F.lit(1).alias("schema_version"),
        F.lit(CLASSIFIER_ID).alias("agent_id"),
        F.lit("system_classifier").alias("agent_role"),
        F.col("observed_at").alias("event_time"),
        F.col("observed_at").alias("published_time"),
        F.col("state_revision").alias("sequence_number"),
        F.col("incident_id").alias("correlation_id"),
        F.lit(S.RULE_VERSION).alias("source_version"),
        "incident_id",
        "incident_type",
        "start_time",
        "end_time",
        "status",
        "severity",
        "confidence_score",
        "affected_agents",
        "affected_endpoints",
        "evidence",
        F.lit(S.RULE_VERSION).alias("rule_version"),
        "peak_latency_ms",
        "maximum_packet_loss_pct",
        duration_ms(F.col("observed_at")).alias("duration_ms"),
        F.concat(F.lit("Probable classification: "), F.col("summary")).alias("summary"),
        "recommended_action",
    )


def state_log(events: DataFrame) -> DataFrame:
    """Outbox rows: one JSON payload per transition."""
    times = ("event_time", "published_time", "start_time", "end_time")
    body = F.struct(
        *[
            (F.date_format(c, "yyyy-MM-dd'T'HH:mm:ss.SSSSSS'Z'") if c in times else F.col(c)).alias(c)
            for c in sorted(events.columns)
        ]
    )
    return events.select(
        "event_id",
        "incident_id",
        F.col("sequence_number").alias("state_revision"),
        "status",
        "event_time",
        F.to_json(body, {"ignoreNullFields": "false"}).alias("payload"),
    )


def append_absent(log: DataFrame | None, new: DataFrame, key: str = "event_id") -> DataFrame:
    """Rows of ``new`` whose key the log does not hold yet, once each."""
    fresh = new.dropDuplicates([key])
    return fresh if log is None else fresh.join(log.select(key), key, "left_anti")


def pending(log: DataFrame, acknowledged: DataFrame, limit: int = 100) -> DataFrame:
    """Oldest unpublished state events, a bounded batch at a time."""
    return (
        log.join(acknowledged.select("event_id"), "event_id", "left_anti")
        .orderBy("event_time", "incident_id", "state_revision")
        .limit(limit)
    )


def active(incidents: DataFrame) -> DataFrame:
    return incidents.where(F.col("status") != "resolved").orderBy("start_time", "incident_key")

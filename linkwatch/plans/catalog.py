"""Registered queries: each operator over the given tables, and its oracle."""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable
from contextlib import contextmanager
from functools import wraps

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from linkwatch import schemas as S
from linkwatch.functions.ids import pseudonym, protect
from linkwatch.functions.probes import (
    http_error_class,
    http_success,
    megabits,
    ping_fields,
    utilization,
    wifi_fields,
)
from linkwatch.functions.temporal import Cadence, TickSpan, timestamp_of
from linkwatch.operators import daily as D
from linkwatch.operators import exports as X
from linkwatch.operators import ingest as I
from linkwatch.operators import lifecycle as L
from linkwatch.operators import quality as Q
from linkwatch.operators import rules as R
from linkwatch.operators import serving as P
from linkwatch.operators import slo as K
from linkwatch.operators import snapshot as N
from linkwatch.operators import validate as V
from linkwatch.operators import views as W
from linkwatch.operators.windows import window_metrics
from linkwatch.plans import oracle as O
from linkwatch.plans.oracle import day, ts
from linkwatch.session import configure, landed, scratch_path
from linkwatch.sources import sinks, versions
from linkwatch.sources.tables import table
from linkwatch.sources.telemetry import Telemetry

UTC = dt.timezone.utc
NOW = dt.datetime(2024, 1, 31, tzinfo=UTC)
NOW_SQL = "TIMESTAMP '2024-01-31 00:00:00'"
FIRST, LAST = dt.date(2024, 1, 5), dt.date(2024, 1, 20)
RANGE_SQL = "DATE '2024-01-05' AND DATE '2024-01-20'"

# The test events are minutes apart, so the classifier looks back hours.
CFG = S.Thresholds(
    lookback_seconds=6 * 3600, interval_seconds=3600, heartbeat_stale_seconds=12 * 3600
)
RULE_PAIRS = 40
SLO_CADENCE = Cadence(6 * 3600, 900)
SLO_SQL = {"look": 6 * 3600, "step": 900}

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}


def portable(df: DataFrame) -> DataFrame:
    """Times, dates and lists as text, so that two engines' clients agree."""
    columns = []
    for f in df.schema.fields:
        c = F.col(f"`{f.name}`")
        if isinstance(f.dataType, (T.TimestampType, T.TimestampNTZType)):
            c = F.date_format(c, "yyyy-MM-dd HH:mm:ss.SSSSSS")
        elif isinstance(f.dataType, T.DateType):
            c = F.date_format(c, "yyyy-MM-dd")
        elif isinstance(f.dataType, T.ArrayType) and isinstance(f.dataType.elementType, T.StringType):
            c = F.array_join(c, ",")
        columns.append(c.alias(f.name))
    return df.select(*columns)


def query(name: str, sql: str | None = None, pairs: int | None = None, extra=None):
    def register(fn: Query) -> Query:
        @wraps(fn)
        def run(spark: SparkSession, folder: str) -> DataFrame:
            return portable(fn(configure(spark), folder))

        QUERIES[name] = run
        if sql is not None:
            ORACLES[name] = O.sql(sql, cfg=CFG, pairs=pairs, extra=extra)
        return run

    return register


# --- records -------------------------------------------------------------------


def _measurement_records(t: Telemetry) -> DataFrame:
    return t.kafka.where(F.col("topic") == S.TOPICS[S.MEASUREMENT])


_VALID = ("source_topic", "source_partition", "source_offset", "event_id", "agent_id",
          "agent_role", "event_time", "sequence_number", "measurement_type", "target_id",
          "success", "latency_ms", "packet_loss_pct", "jitter_ms", "signal_dbm", "connected",
          "ingestion_latency_ms")


@query(
    "parse_split_valid",
    f"""SELECT source_topic, source_partition, source_offset, event_id, agent_id, agent_role,
  {ts('event_time')} AS event_time, sequence_number, measurement_type, target_id, success, latency_ms,
  packet_loss_pct, jitter_ms, signal_dbm, connected, ingestion_latency_ms FROM valid_stream""",
)
def parse_split_valid(spark, folder):
    valid, _ = V.split(_measurement_records(Telemetry(spark, folder)), now="kafka_timestamp")
    return valid.select(*_VALID)


@query(
    "parse_split_rejects",
    """SELECT source_topic, source_partition, source_offset, source_key, errors AS validation_errors
FROM stream_checked WHERE errors <> ''""",
)
def parse_split_rejects(spark, folder):
    _, invalid = V.split(_measurement_records(Telemetry(spark, folder)), now=NOW)
    return invalid.select(
        "source_topic", "source_partition", "source_offset", "source_key", "validation_errors"
    )


@query(
    "reject_reasons",
    """SELECT reason, COUNT(*) AS records FROM
  (SELECT unnest(string_split(errors, ',')) AS reason FROM stream_checked WHERE errors <> '') GROUP BY reason""",
)
def reject_reasons(spark, folder):
    _, invalid = V.split(_measurement_records(Telemetry(spark, folder)), now=NOW)
    return (
        invalid.select(F.explode("validation_errors").alias("reason"))
        .groupBy("reason")
        .agg(F.count(F.lit(1)).alias("records"))
    )


@query(
    "mapping_violations",
    f"""SELECT source_partition, source_offset, CASE
    WHEN truncated THEN 'malformed_json'
    WHEN event_type IS NULL THEN 'missing:event_type'
      || CASE WHEN target_id IS NULL THEN ',missing:target_id' ELSE '' END
    WHEN target_id IS NULL THEN 'missing:target_id'
    ELSE concat_ws(',',
      CASE WHEN event_type = 'network.unknown' THEN 'unsupported:event_type' END,
      CASE WHEN schema_version <> 1 THEN 'unsupported:schema_version' END,
      CASE WHEN agent_role = 'rooftop_sensor' THEN 'invalid:agent_role' END,
      CASE WHEN packet_loss_pct > 100 THEN 'range:packet_loss_pct' END,
      CASE WHEN sequence_number < 0 THEN 'invalid:sequence_number' END,
      CASE WHEN event_id = 'not-a-uuid' THEN 'invalid:event_id' END,
      CASE WHEN c = 15 THEN 'not_utc:event_time' END) END AS validation_errors
FROM records WHERE truth = '{S.MEASUREMENT}'""",
)
def mapping_violations(spark, folder):
    records = _measurement_records(Telemetry(spark, folder))
    return records.select(
        F.col("partition").alias("source_partition"),
        F.col("offset").alias("source_offset"),
        V.mapping_errors(F.col("value").cast("string")).alias("validation_errors"),
    )


@query(
    "contract_violations",
    """SELECT source_topic, source_partition, source_offset, errors AS validation_errors
FROM contract WHERE errors <> ''""",
)
def contract_violations(spark, folder):
    checked = V.checked_contract(Telemetry(spark, folder).kafka)
    return checked.where(F.size("validation_errors") > 0).select(
        "source_topic", "source_partition", "source_offset", "validation_errors"
    )


def _referenced(t: Telemetry) -> DataFrame:
    return I.check_references(V.checked_contract(t.kafka), t.agents, t.endpoints)


@query(
    "referential_rejects",
    """SELECT source_topic, source_partition, source_offset, agent_id,
  coalesce(target_id, endpoint_id) AS endpoint_id, errors AS reason
FROM referenced WHERE errors LIKE 'unrecognized%'""",
)
def referential_rejects(spark, folder):
    rows = _referenced(Telemetry(spark, folder))
    reason = F.element_at("validation_errors", 1)
    return rows.where(F.size("validation_errors") > 0).where(
        reason.startswith("unrecognized")
    ).select(
        "source_topic",
        "source_partition",
        "source_offset",
        F.col("event.agent_id").alias("agent_id"),
        F.coalesce("event.target_id", "event.endpoint_id").alias("endpoint_id"),
        reason.alias("reason"),
    )


@query(
    "topic_routing",
    f"""SELECT event_type, source_topic AS topic, COUNT(*) AS records FROM records
WHERE event_type LIKE 'network.%' AND event_type <> 'network.unknown' GROUP BY event_type, source_topic
UNION ALL SELECT event_type, NULL, COUNT(*) FROM records WHERE event_type = 'network.unknown' GROUP BY event_type""",
)
def topic_routing(spark, folder):
    parsed = V.parse(Telemetry(spark, folder).kafka, S.contract_schema())
    rows = parsed.select(F.col("event.event_type").alias("event_type")).where(
        F.col("event_type").isNotNull()
    )
    return rows.groupBy("event_type", I.route().alias("topic")).agg(
        F.count(F.lit(1)).alias("records")
    )


@query(
    "processing_outcomes",
    """SELECT source_topic, source_partition, source_offset, event_id, outcome FROM outcomes""",
)
def processing_outcomes(spark, folder):
    outcomes = I.classify_outcome(_referenced(Telemetry(spark, folder)))
    return outcomes.select(
        "source_topic", "source_partition", "source_offset", "event_id", "outcome"
    )


@query(
    "outcome_totals",
    "SELECT outcome, COUNT(*) AS records FROM outcomes GROUP BY outcome",
)
def outcome_totals(spark, folder):
    return I.outcome_counts(I.classify_outcome(_referenced(Telemetry(spark, folder))))


@query(
    "dedup_raw_events",
    f"""SELECT event_id, event_type, agent_id, {ts('event_time')} AS event_time, sequence_number,
  source_topic, source_partition, source_offset, {ts('kafka_timestamp')} AS received_at
FROM outcomes WHERE outcome = 'valid'""",
)
def dedup_raw_events(spark, folder):
    log = I.raw_event_log(I.inserted_events(_referenced(Telemetry(spark, folder))))
    return log.select(
        "event_id", "event_type", "agent_id", "event_time", "sequence_number", "source_topic",
        "source_partition", "source_offset", "received_at",
    )


@query(
    "dedup_against_log",
    """SELECT source_topic, source_partition, source_offset, event_id,
  outcome = 'valid' AND source_offset % 4 <> 0 AS inserted
FROM outcomes WHERE outcome <> 'dead_lettered'""",
)
def dedup_against_log(spark, folder):
    """A second delivery of everything against a log that took a quarter of it."""
    checked = _referenced(Telemetry(spark, folder)).where(F.size("validation_errors") == 0)
    rows = I.collapse_redeliveries(
        checked.select(
            *I.COORDINATES, "kafka_timestamp", F.col("event.event_id").alias("event_id")
        )
    )
    log = I.first_arrivals(rows).where(F.col("source_offset") % 4 == 0)
    return I.dedup_events(rows, log).select(*I.COORDINATES, "event_id", "inserted")


@query(
    "typed_fanout_counts",
    f"""SELECT truth AS event_type, COUNT(*) AS row_count, COUNT(DISTINCT agent_id) AS agent_count,
  {ts('MIN(event_time)')} AS first_event, {ts('MAX(event_time)')} AS last_event
FROM outcomes WHERE outcome = 'valid' GROUP BY truth""",
)
def typed_fanout_counts(spark, folder):
    tables = I.fan_out(I.inserted_events(_referenced(Telemetry(spark, folder))))
    result = None
    for event_type, rows in tables.items():
        part = rows.agg(
            F.count(F.lit(1)).alias("row_count"),
            F.countDistinct("agent_id").alias("agent_count"),
            F.min("event_time").alias("first_event"),
            F.max("event_time").alias("last_event"),
        ).select(F.lit(event_type).alias("event_type"), "*")
        result = part if result is None else result.unionByName(part)
    return result


@query(
    "valid_republished",
    f"""SELECT agent_id AS key, event_id, latency_ms, target_id, success, '{S.VALID_TOPIC}' AS topic
FROM referenced WHERE errors = '' AND truth = '{S.MEASUREMENT}'""",
)
def valid_republished(spark, folder):
    """Canonical JSON read back, so the payload itself is what is compared."""
    sent = I.republished(_referenced(Telemetry(spark, folder)))
    body = F.from_json(
        "value", "event_id string, latency_ms double, target_id string, success boolean"
    )
    return sent.select("topic", "key", body.alias("b")).select("topic", "key", "b.*")


_LETTER_ID = O.uuid5(
    "'linkwatch-dead-letter:' || source_topic || ':' || CAST(source_partition AS VARCHAR) || ':' "
    "|| CAST(source_offset AS VARCHAR)"
)


@query(
    "dead_letters",
    f"""SELECT {_LETTER_ID} AS dead_letter_id, '2024-01-31T00:00:00Z' AS failed_time, source_topic, source_partition,
  source_offset, 'EventValidationError' AS error_class,
  'event validation failed: ' || string_split(errors, ',')[1] AS error_message, errors AS validation_errors, source_key
FROM referenced WHERE errors <> ''""",
)
def dead_letters(spark, folder):
    return I.dead_letters(_referenced(Telemetry(spark, folder)), now=NOW).drop("original_payload")


def _failure_ledger(t: Telemetry) -> DataFrame:
    """First attempts, and a second one an hour later at even offsets."""
    letters = landed(
        I.dead_letters(_referenced(t), now=NOW, keep=("kafka_timestamp",)), "dead-letters"
    )
    first = I.fresh_failures(letters, F.col("kafka_timestamp"))
    again = I.fresh_failures(
        letters.where(F.col("source_offset") % 2 == 0).withColumn(
            "error_message", F.concat(F.lit("retried: "), F.col("error_message"))
        ),
        F.col("kafka_timestamp") + F.expr("INTERVAL 1 HOUR"),
    )
    merged = I.merge_failures(first, again)
    sent = letters.where(F.col("source_offset") % 3 == 0).select(
        *I.COORDINATES, F.lit(NOW).alias("published_at")
    )
    return I.mark_published(merged, sent)


@query(
    "failure_ledger",
    f"""SELECT source_topic, source_partition, source_offset, source_key,
  CASE WHEN source_offset % 2 = 0 THEN 'retried: ' ELSE '' END || 'event validation failed: '
    || string_split(errors, ',')[1] AS error_message,
  CAST(CASE WHEN source_offset % 2 = 0 THEN 2 ELSE 1 END AS BIGINT) AS attempt_count,
  {ts('kafka_timestamp')} AS first_failed_at,
  {ts("kafka_timestamp + CASE WHEN source_offset % 2 = 0 THEN INTERVAL 1 HOUR ELSE INTERVAL 0 HOUR END")} AS last_failed_at,
  CASE WHEN source_offset % 3 = 0 THEN {ts(NOW_SQL)} END AS dead_letter_published_at
FROM referenced WHERE errors <> ''""",
)
def failure_ledger(spark, folder):
    return _failure_ledger(Telemetry(spark, folder)).drop(
        "original_payload", "validation_errors", "error_class"
    )


# --- window metrics -------------------------------------------------------------

_METRICS_SQL = f"""SELECT {ts('window_start')} AS window_start, {ts('window_end')} AS window_end,
  window_size_seconds, agent_id, target_id, measurement_type, event_count, success_count, failure_count,
  success_rate_pct, latency_min_ms, latency_max_ms, latency_mean_ms, latency_stddev_ms, latency_p50_ms,
  latency_p95_ms, latency_p99_ms, jitter_mean_ms, packet_loss_mean_pct, ingestion_latency_mean_ms
FROM window_metrics"""


def _valid_rows(t: Telemetry) -> DataFrame:
    valid, _ = V.split(_measurement_records(t), now="kafka_timestamp")
    return valid


def _shown_metrics(metrics: DataFrame) -> DataFrame:
    return metrics.drop("calculated_at").withColumn(
        "latency_stddev_ms", F.round("latency_stddev_ms", 6)
    )


def _metrics_query(name: str, sizes: dict[str, int], where: str) -> None:
    @query(name, f"{_METRICS_SQL}{where}")
    def run(spark, folder):
        return _shown_metrics(window_metrics(_valid_rows(Telemetry(spark, folder)), sizes=sizes))


for _label, (_duration, _seconds) in {
    "1m": ("1 minute", 60),
    "5m": ("5 minutes", 300),
    "15m": ("15 minutes", 900),
    "1d": ("1 day", 86_400),
}.items():
    _metrics_query(
        f"window_metrics_{_label}",
        {_duration: _seconds},
        f" WHERE window_size_seconds = {_seconds}",
    )
_metrics_query("window_metrics_all", S.WINDOW_SIZES, "")


@query(
    "window_metrics_dedup",
    f"""SELECT {day('w')} AS date_utc, agent_id, target_id, measurement_type, COUNT(*) AS event_count,
  COUNT(*) FILTER (WHERE success) AS success_count
FROM (SELECT DISTINCT ON (event_id) *, date_trunc('day', event_time) AS w FROM valid_stream ORDER BY event_id)
GROUP BY w, agent_id, target_id, measurement_type""",
)
def window_metrics_dedup(spark, folder):
    rows = window_metrics(
        _valid_rows(Telemetry(spark, folder)), sizes={"1 day": 86_400}, dedup=True
    )
    return rows.select(
        F.to_date("window_start").alias("date_utc"),
        "agent_id",
        "target_id",
        "measurement_type",
        "event_count",
        "success_count",
    )


# --- snapshot, rules, lifecycle ---------------------------------------------------


def _cadence() -> Cadence:
    return N.cadence_of(CFG)


def _span(t: Telemetry) -> TickSpan:
    return TickSpan.covering(t.base, "event_time", _cadence())


def _summaries(t: Telemetry) -> DataFrame:
    return N.summaries(N.observations(t.measurements, t.checks), t.agents, _cadence())


def _findings(t: Telemetry) -> DataFrame:
    latest = N.heartbeat_latest(t.heartbeats, t.agents, _span(t), _cadence())
    return R.classify(_summaries(t), latest, CFG)


def _transitions(t: Telemetry) -> DataFrame:
    return L.lifecycle(_findings(t), _span(t), CFG)


def _stored_transitions(t: Telemetry) -> DataFrame:
    """Transitions computed once, for queries that read them several times."""
    return landed(_transitions(t), "transitions")


def _rules(spark, folder) -> Telemetry:
    return Telemetry(spark, folder, RULE_PAIRS)


@query(
    "measurement_summary",
    f"""SELECT site_id, {ts('tick')} AS observed_at, agent_id, agent_role, endpoint_id AS target_id,
  probe_type AS measurement_type, sample_count, success_rate_pct, peak_latency_ms, mean_packet_loss_pct,
  weakest_signal_dbm, connected_rate_pct
FROM summaries WHERE probe_type NOT IN ('dns','http')""",
    RULE_PAIRS,
)
def measurement_summary(spark, folder):
    t = _rules(spark, folder)
    return N.measurement_summary(t.measurements, t.agents, _cadence())


@query(
    "service_summary",
    f"""SELECT site_id, {ts('tick')} AS observed_at, agent_id, agent_role, endpoint_id, probe_type AS check_type,
  sample_count, success_rate_pct FROM summaries WHERE probe_type IN ('dns','http')""",
    RULE_PAIRS,
)
def service_summary(spark, folder):
    t = _rules(spark, folder)
    return N.service_summary(t.checks, t.agents, _cadence())


@query(
    "heartbeat_latest",
    f"""SELECT site_id, {ts('tick')} AS observed_at, agent_id, agent_role, {ts('last_event_time')} AS last_event_time
FROM latest_heartbeats""",
    RULE_PAIRS,
)
def heartbeat_latest(spark, folder):
    t = _rules(spark, folder)
    rows = N.heartbeat_latest(t.heartbeats, t.agents, _span(t), _cadence())
    return rows.select(
        "site_id",
        timestamp_of("tick_us").alias("observed_at"),
        "agent_id",
        "agent_role",
        "last_event_time",
    )


@query(
    "findings",
    f"""SELECT site_id, {ts('tick')} AS observed_at, incident_key, incident_type, severity, confidence_score,
  agents AS affected_agents, endpoints AS affected_endpoints, evidence_rows, peak_latency_ms,
  maximum_packet_loss_pct, summary FROM findings""",
    RULE_PAIRS,
)
def findings(spark, folder):
    rows = _findings(_rules(spark, folder))
    return rows.select(
        "site_id",
        timestamp_of("tick_us").alias("observed_at"),
        "incident_key",
        "incident_type",
        "severity",
        "confidence_score",
        "affected_agents",
        "affected_endpoints",
        F.size("evidence").cast("bigint").alias("evidence_rows"),
        "peak_latency_ms",
        "maximum_packet_loss_pct",
        "summary",
    )


_TRANSITION_COLUMNS = (
    "incident_id", "site_id", "incident_key", "observed_at", "start_time", "end_time", "status",
    "state_revision", "positive_observations", "recovery_observations", "severity",
    "incident_type", "affected_agents", "affected_endpoints", "peak_latency_ms",
    "maximum_packet_loss_pct",
)
_TRANSITIONS_SQL = f"""SELECT incident_id, site_id, incident_key, {ts('observed_at')} AS observed_at,
  {ts('start_time')} AS start_time, {ts('end_time')} AS end_time, status, state_revision, positive_observations,
  recovery_observations, severity, incident_type, agents AS affected_agents, endpoints AS affected_endpoints,
  peak_latency_ms, maximum_packet_loss_pct FROM transitions"""


@query("incident_transitions", _TRANSITIONS_SQL, RULE_PAIRS)
def incident_transitions(spark, folder):
    return _transitions(_rules(spark, folder)).select(*_TRANSITION_COLUMNS)


def _incidents(t: Telemetry, transitions: DataFrame | None = None) -> DataFrame:
    return L.incident_state(_transitions(t) if transitions is None else transitions)


@query(
    "incidents_current",
    f"""SELECT incident_id, site_id, incident_key, incident_type, {ts('start_time')} AS start_time,
  {ts('end_time')} AS end_time, status, severity, agents AS affected_agents, endpoints AS affected_endpoints,
  peak_latency_ms, maximum_packet_loss_pct, state_revision, {ts('last_observed_at')} AS last_observed_at, duration_ms
FROM incidents""",
    RULE_PAIRS,
)
def incidents_current(spark, folder):
    return _incidents(_rules(spark, folder)).select(
        "incident_id", "site_id", "incident_key", "incident_type", "start_time", "end_time",
        "status", "severity", "affected_agents", "affected_endpoints", "peak_latency_ms",
        "maximum_packet_loss_pct", "state_revision", "last_observed_at", "duration_ms",
    )


@query(
    "active_incidents",
    f"""SELECT incident_id, incident_key, {ts('start_time')} AS start_time, status FROM incidents
WHERE status <> 'resolved'""",
    RULE_PAIRS,
)
def active_incidents(spark, folder):
    return L.active(_incidents(_rules(spark, folder))).select(
        "incident_id", "incident_key", "start_time", "status"
    )


@query(
    "active_incidents_at_noon",
    f"""SELECT d AS day_no, incident_id, incident_key, {ts('start_time')} AS start_time, status FROM (
  SELECT d, incident_id, incident_key, start_time, status,
    row_number() OVER (PARTITION BY d, incident_id ORDER BY state_revision DESC) AS n
  FROM transitions, (SELECT unnest([2, 3, 5, 13, 24]) AS d)
  WHERE observed_at <= TIMESTAMP '{FIRST} 12:00:00' + to_days(CAST(d - 1 AS INTEGER)))
WHERE n = 1 AND status <> 'resolved'""",
    RULE_PAIRS,
)
def active_incidents_at_noon(spark, folder):
    """What was active at noon of some days, from the transitions up to then."""
    days = F.array(*[F.lit(d).cast("bigint") for d in (2, 3, 5, 13, 24)])
    noon = F.unix_micros(F.lit(f"{FIRST} 12:00:00").cast("timestamp")) + (
        F.col("day_no") - 1
    ) * F.lit(86_400_000_000)
    moves = _transitions(_rules(spark, folder)).select("*", F.explode(days).alias("day_no"))
    moves = moves.where(F.unix_micros("observed_at") <= noon)
    # an incident of each day's view is told apart by the day in its id
    seen = F.concat_ws("@", "incident_id", "day_no")
    now = L.active(L.incident_state(moves.withColumn("incident_id", seen)))
    return now.select(
        "day_no",
        F.substring_index("incident_id", "@", 1).alias("incident_id"),
        "incident_key",
        "start_time",
        "status",
    )


def _state_log(t: Telemetry, transitions: DataFrame | None = None) -> DataFrame:
    return L.state_log(L.incident_events(_transitions(t) if transitions is None else transitions))


def _acks(log: DataFrame) -> DataFrame:
    """First revisions count as published."""
    return log.where(F.col("state_revision") == 1).select("event_id")


@query(
    "incident_events",
    f"""SELECT l.event_id, t.incident_id, t.state_revision AS sequence_number, t.status,
  {ts('t.observed_at')} AS event_time, (epoch_us(t.observed_at) - epoch_us(t.start_time)) / 1000.0 AS duration_ms,
  '1.0.0' AS rule_version, 'system_classifier' AS agent_role
FROM transitions t JOIN state_log l ON l.incident_id = t.incident_id AND l.state_revision = t.state_revision""",
    RULE_PAIRS,
)
def incident_events(spark, folder):
    return L.incident_events(_transitions(_rules(spark, folder))).select(
        "event_id", "incident_id", "sequence_number", "status", "event_time", "duration_ms",
        "rule_version", "agent_role",
    )


@query(
    "pending_publications",
    f"""SELECT event_id, incident_id, state_revision, status, {ts('event_time')} AS event_time FROM (
  SELECT * FROM state_log WHERE event_id NOT IN (SELECT event_id FROM acks)
  ORDER BY event_time, incident_id, state_revision LIMIT 100)""",
    RULE_PAIRS,
)
def pending_publications(spark, folder):
    log = _state_log(_rules(spark, folder))
    return L.pending(log, _acks(log)).drop("payload")


@query(
    "lifecycle_states",
    "SELECT incident_id, string_agg(status, ',' ORDER BY state_revision) AS states FROM transitions GROUP BY incident_id",
    RULE_PAIRS,
)
def lifecycle_states(spark, folder):
    return Q.observed_states(_state_log(_rules(spark, folder)))


# --- star schema --------------------------------------------------------------------


def _fact(t: Telemetry) -> DataFrame:
    return D.daily_fact(t.measurements, t.checks)


def _view(t: Telemetry) -> DataFrame:
    return W.daily_reliability(_fact(t))


_VIEW_COLUMNS = f"""{day('date_utc')} AS date_utc, agent_id, endpoint_id, source_kind, probe_type, total_count,
  success_count, failure_count, success_rate_pct, latency_count, latency_sum_ms, mean_latency_ms,
  packet_loss_count, packet_loss_sum_pct, mean_packet_loss_pct"""


@query("daily_reliability", f"SELECT {_VIEW_COLUMNS} FROM daily_view")
def daily_reliability(spark, folder):
    return _view(Telemetry(spark, folder))


@query(
    "daily_fact_range",
    f"""SELECT {day('date_utc')} AS date_utc, agent_id, endpoint_id, source_kind, probe_type, total_count,
  success_count, failure_count, latency_sum_ms, latency_count, packet_loss_sum_pct, packet_loss_count
FROM daily_fact WHERE date_utc BETWEEN {RANGE_SQL}""",
)
def daily_fact_range(spark, folder):
    t = Telemetry(spark, folder)
    return D.daily_fact(t.measurements, t.checks, FIRST, LAST)


@query(
    "date_bounds",
    f"""SELECT {day('MIN(date_utc)')} AS from_date, {day('MAX(date_utc)')} AS through_date FROM probe_rows""",
)
def date_bounds(spark, folder):
    t = Telemetry(spark, folder)
    return D.date_bounds(D.event_dates(t.measurements), D.event_dates(t.checks), _fact(t))


@query(
    "date_spine",
    f"""SELECT {day('d')} AS date_utc FROM (SELECT unnest(generate_series(CAST(MIN(date_utc) AS TIMESTAMP),
  CAST(MAX(date_utc) AS TIMESTAMP), INTERVAL 1 DAY)) AS d FROM probe_rows)""",
)
def date_spine(spark, folder):
    t = Telemetry(spark, folder)
    return D.date_spine(D.date_bounds(D.event_dates(t.measurements), D.event_dates(t.checks)))


@query("dim_probe", "SELECT DISTINCT source_kind, probe_type FROM probe_rows")
def dim_probe(spark, folder):
    t = Telemetry(spark, folder)
    kinds = D.probe_kinds(t.measurements, t.checks)
    known = kinds.where(F.col("source_kind") == "service_check")
    return D.insert_absent(known, kinds, ("source_kind", "probe_type"))


@query(
    "dim_agent_scd1",
    """SELECT agent_id, agent_role, display_name FROM agents
UNION ALL SELECT agent_id || '-old', agent_role, 'retired' FROM agents WHERE NOT enabled""",
)
def dim_agent_scd1(spark, folder):
    """A dimension with outdated names and members the source no longer has."""
    agents = Telemetry(spark, folder).agents
    outdated = agents.where("enabled").withColumn("display_name", F.lit("outdated"))
    dropped = agents.where("not enabled").select(
        F.concat("agent_id", F.lit("-old")).alias("agent_id"),
        "agent_role",
        F.lit("retired").alias("display_name"),
    )
    columns = ("agent_role", "display_name")
    stored = outdated.select("agent_id", *columns).unionByName(dropped)
    return D.scd1(stored, agents, "agent_id", columns)


@query(
    "fact_incident",
    f"""SELECT incident_id, {ts('start_time')} AS start_time, {ts('end_time')} AS end_time, status, incident_type,
  severity, duration_ms, '1.0.0' AS rule_version, state_revision FROM incidents""",
    RULE_PAIRS,
)
def fact_incident(spark, folder):
    return D.incident_fact(_incidents(_rules(spark, folder))).drop("confidence_score")


@query("bridge_incident_agent", "SELECT incident_id, agent_id FROM bridge_agents", RULE_PAIRS)
def bridge_incident_agent(spark, folder):
    return D.bridge(_incidents(_rules(spark, folder)), "affected_agents", "agent_id")


@query("bridge_incident_endpoint", "SELECT incident_id, endpoint_id FROM bridge_endpoints", RULE_PAIRS)
def bridge_incident_endpoint(spark, folder):
    return D.bridge(_incidents(_rules(spark, folder)), "affected_endpoints", "endpoint_id")


# --- views ----------------------------------------------------------------------------


def _incident_view(t: Telemetry, transitions: DataFrame | None = None) -> DataFrame:
    incidents = landed(_incidents(t, transitions), "incidents")
    return W.incident_summary(
        D.incident_fact(incidents),
        D.bridge(incidents, "affected_agents", "agent_id"),
        D.bridge(incidents, "affected_endpoints", "endpoint_id"),
    )


@query(
    "incident_summary",
    f"""SELECT incident_id, {ts('start_time')} AS start_time, {ts('end_time')} AS end_time, status, incident_type,
  severity, duration_ms, state_revision, affected_agent_count, affected_endpoint_count FROM incident_view""",
    RULE_PAIRS,
)
def incident_summary(spark, folder):
    view = P.current_incidents(_incident_view(_rules(spark, folder)))
    return view.drop("confidence_score", "rule_version")


@query(
    "agent_status",
    f"""SELECT a.agent_id, a.agent_role, a.display_name, a.enabled, {ts('h.event_time')} AS last_heartbeat_at,
  CASE WHEN h.event_time IS NOT NULL THEN greatest(0, (epoch_us({NOW_SQL}) - epoch_us(h.event_time)) / 1e6) END
    AS heartbeat_age_seconds, h.local_queue_depth, CAST(coalesce(h.n_errors, 0) AS INTEGER) AS collection_error_count
FROM agents a LEFT JOIN (SELECT * FROM heartbeats
  QUALIFY row_number() OVER (PARTITION BY agent_id ORDER BY event_time DESC, event_id DESC) = 1) h
  ON h.agent_id = a.agent_id""",
)
def agent_status(spark, folder):
    t = Telemetry(spark, folder)
    return P.agent_freshness(W.agent_status(t.agents, t.heartbeats, NOW))


_BATCHES_SQL = "SELECT CAST(MAX(event_time) AS TIMESTAMP) AS completed_at FROM base"


def _ingest_status(t: Telemetry, transitions: DataFrame | None = None) -> DataFrame:
    if transitions is None:
        transitions = _stored_transitions(t)
    log = _state_log(t, transitions)
    batches = t.base.groupBy(F.to_date("event_time").alias("d")).agg(
        F.max("event_time").alias("completed_at")
    )
    failures = _failure_ledger(t)
    _, stream = V.split(_measurement_records(t), now=NOW)
    return W.pipeline_status(
        t.raw_log, failures, stream, batches, _incidents(t, transitions), log, _acks(log), NOW
    )


_STATUS_PARTS = {
    "status_row": f"""
  SELECT {NOW_SQL} AS observed_at, (SELECT MAX(received_at) FROM raw_log) AS last_raw,
    (SELECT COUNT(*) FROM referenced WHERE errors <> '' AND source_offset % 3 <> 0) AS letters,
    (SELECT COUNT(*) FROM stream_checked WHERE errors <> '') AS stream,
    (SELECT MAX(event_time) FROM base) AS last_batch,
    (SELECT COUNT(*) FROM incidents WHERE status <> 'resolved') AS active,
    (SELECT COUNT(*) FROM state_log WHERE event_id NOT IN (SELECT event_id FROM acks)) AS waiting"""
}


@query(
    "ingest_status",
    f"""SELECT {ts('observed_at')} AS observed_at, {ts('last_raw')} AS last_raw_event_received_at,
  greatest(0, (epoch_us(observed_at) - epoch_us(last_raw)) / 1e6) AS raw_event_age_seconds,
  letters AS pending_dead_letter_count, stream AS stream_processing_failure_count,
  {ts('last_batch')} AS last_stream_batch_completed_at, active AS active_incident_count,
  waiting AS pending_incident_publication_count FROM status_row""",
    RULE_PAIRS,
    _STATUS_PARTS,
)
def ingest_status(spark, folder):
    return _ingest_status(_rules(spark, folder))


_START, _END = dt.datetime(2024, 1, 8, tzinfo=UTC), dt.datetime(2024, 1, 22, tzinfo=UTC)
_LIVE = "event_time BETWEEN TIMESTAMP '2024-01-08' AND TIMESTAMP '2024-01-22'"
_METRIC = "agent_id || ' / ' || target_id || ' / ' || measurement_type AS metric"


@query(
    "daily_success_series",
    f"""SELECT {day('date_utc')} AS time, success_rate_pct AS value, agent_id AS metric FROM daily_view
WHERE date_utc BETWEEN {RANGE_SQL}""",
)
def daily_success_series(spark, folder):
    return P.daily_success_series(_view(Telemetry(spark, folder)), FIRST, LAST)


@query(
    "live_latency_series",
    f"""SELECT {ts('event_time')} AS time, latency_ms AS value, {_METRIC} FROM measurements
WHERE {_LIVE} AND latency_ms IS NOT NULL""",
)
def live_latency_series(spark, folder):
    return P.live_latency_series(Telemetry(spark, folder).measurements, _START, _END)


@query(
    "live_loss_series",
    f"""SELECT {ts('event_time')} AS time, packet_loss_pct AS value, {_METRIC} FROM measurements
WHERE {_LIVE} AND measurement_type IN ('router_ping','external_ping')""",
)
def live_loss_series(spark, folder):
    return P.live_loss_series(Telemetry(spark, folder).measurements, _START, _END)


@query(
    "live_success_series",
    f"""SELECT {ts('event_time')} AS time, CAST(CASE WHEN success THEN 100 ELSE 0 END AS DOUBLE) AS value, {_METRIC}
FROM measurements WHERE {_LIVE}""",
)
def live_success_series(spark, folder):
    return P.live_success_series(Telemetry(spark, folder).measurements, _START, _END)


@query(
    "latest_readings",
    f"""SELECT {ts('event_time')} AS event_time, agent_id, target_id, measurement_type, success, latency_ms,
  packet_loss_pct, jitter_ms FROM (SELECT * FROM measurements WHERE {_LIVE}
  ORDER BY event_time DESC, agent_id, target_id, measurement_type LIMIT 100)""",
)
def latest_readings(spark, folder):
    return P.latest_readings(Telemetry(spark, folder).measurements, _START, _END)


# --- gates, reconciliation, ledgers ----------------------------------------------------


def _snapshot(t: Telemetry, failures: DataFrame) -> DataFrame:
    return Q.source_snapshot(
        t.measurements, t.checks, t.raw_log, t.heartbeats, failures, FIRST, LAST
    )


_SNAPSHOT_PARTS = {
    "probe_times": """
  SELECT event_time FROM measurements UNION ALL SELECT event_time FROM checks""",
    "failed": """
  SELECT source_topic, kafka_timestamp + CASE WHEN source_offset % 2 = 0 THEN INTERVAL 1 HOUR
    ELSE INTERVAL 0 HOUR END AS last_failed_at FROM referenced WHERE errors <> ''""",
    "snapshot": f"""
  SELECT (SELECT COUNT(*) FROM probe_times WHERE CAST(event_time AS DATE) BETWEEN {RANGE_SQL}) AS observation_count,
    (SELECT COUNT(*) FROM raw_log WHERE event_type IN ('{S.MEASUREMENT}','{S.SERVICE_CHECK}')
      AND CAST(event_time AS DATE) BETWEEN {RANGE_SQL}) AS relevant_raw_count,
    (SELECT COUNT(*) FROM heartbeats WHERE CAST(event_time AS DATE) BETWEEN {RANGE_SQL}) AS heartbeat_count,
    (SELECT COUNT(*) FROM failed WHERE source_topic IN ('{S.TOPICS[S.MEASUREMENT]}','{S.TOPICS[S.SERVICE_CHECK]}')
      AND CAST(last_failed_at AS DATE) BETWEEN {RANGE_SQL}) AS invalid_count,
    (SELECT MAX(event_time) FROM probe_times WHERE CAST(event_time AS DATE) BETWEEN {RANGE_SQL}) AS latest_observation_at,
    (SELECT MAX(event_time) FROM heartbeats WHERE CAST(event_time AS DATE) BETWEEN {RANGE_SQL}) AS latest_heartbeat_at,
    (SELECT MAX(greatest(0, (epoch_us(received_at) - epoch_us(event_time)) / 1e6)) FROM raw_log
      WHERE event_type IN ('{S.MEASUREMENT}','{S.SERVICE_CHECK}')
      AND CAST(event_time AS DATE) BETWEEN {RANGE_SQL}) AS maximum_ingestion_delay_seconds""",
}


@query(
    "source_snapshot",
    f"""SELECT observation_count, relevant_raw_count, heartbeat_count, invalid_count,
  {ts('latest_observation_at')} AS latest_observation_at, {ts('latest_heartbeat_at')} AS latest_heartbeat_at,
  maximum_ingestion_delay_seconds FROM snapshot""",
    extra=_SNAPSHOT_PARTS,
)
def source_snapshot(spark, folder):
    t = Telemetry(spark, folder)
    return _snapshot(t, _failure_ledger(t))


@query(
    "source_status",
    f"""SELECT day_no, observation_count, status AS source_status,
  status IN ('healthy','delayed','legitimately_empty') AS may_refresh FROM (
  SELECT *, CASE WHEN invalid_count > 0 THEN 'invalid'
    WHEN observation_count = 0 AND (relevant_raw_count > 0 OR heartbeat_count > 0) THEN 'missing'
    WHEN observation_count = 0 THEN 'legitimately_empty'
    WHEN epoch_us(hb) - epoch_us(ob) > 900 * 1000000 THEN 'stale'
    WHEN delay > 90 THEN 'delayed' ELSE 'healthy' END AS status
  FROM (SELECT day(event_time) AS day_no,
      COUNT(*) FILTER (WHERE kind NOT IN ('heartbeat','speed_test')) AS observation_count,
      COUNT(*) FILTER (WHERE kind NOT IN ('heartbeat','speed_test')) AS relevant_raw_count,
      COUNT(*) FILTER (WHERE kind = 'heartbeat') AS heartbeat_count,
      COUNT(*) FILTER (WHERE k = 99 AND v > 50) AS invalid_count,
      MAX(event_time) FILTER (WHERE kind NOT IN ('heartbeat','speed_test')) AS ob,
      MAX(event_time) FILTER (WHERE kind = 'heartbeat') AS hb,
      CAST(MAX(k) FILTER (WHERE kind NOT IN ('heartbeat','speed_test')) AS DOUBLE) AS delay
    FROM base GROUP BY 1))""",
)
def source_status(spark, folder):
    """The gate over one snapshot row per day of the month."""
    base = Telemetry(spark, folder).base
    probe = ~F.col("kind").isin("heartbeat", "speed_test")
    heartbeat = F.col("kind") == "heartbeat"
    count = lambda c: F.count(F.when(c, 1))
    snapshots = base.groupBy(F.dayofmonth("event_time").alias("day_no")).agg(
        count(probe).alias("observation_count"),
        count(probe).alias("relevant_raw_count"),
        count(heartbeat).alias("heartbeat_count"),
        count((F.col("k") == 99) & (F.col("v") > 50)).alias("invalid_count"),
        F.max(F.when(probe, F.col("event_time"))).alias("latest_observation_at"),
        F.max(F.when(heartbeat, F.col("event_time"))).alias("latest_heartbeat_at"),
        F.max(F.when(probe, F.col("k"))).cast("double").alias("maximum_ingestion_delay_seconds"),
    )
    rows = Q.source_status(snapshots, stale_s=900, delay_s=90)
    return rows.select(
        F.col("day_no").cast("bigint").alias("day_no"),
        "observation_count",
        "source_status",
        "may_refresh",
    )


@query(
    "reconcile_daily",
    """SELECT COUNT(*) AS source_rows, COUNT(*) FILTER (WHERE day(date_utc) <> 7) + 1 AS fact_rows,
  COUNT(*) FILTER (WHERE day(date_utc) = 7) + COUNT(*) FILTER (WHERE day(date_utc) = 11 AND latency_count > 0) + 1
    AS mismatch_rows FROM daily_fact""",
)
def reconcile_daily(spark, folder):
    """Against a stored fact with one day missing, one day's sums off by a
    thousandth and one row nobody produced."""
    fact = _fact(Telemetry(spark, folder))
    dom = F.dayofmonth("date_utc")
    stored = fact.where(dom != 7).withColumn(
        "latency_sum_ms",
        F.when(dom == 11, F.col("latency_sum_ms") + 0.001).otherwise(F.col("latency_sum_ms")),
    )
    stray = fact.agg(*[F.max(c).alias(c) for c in fact.columns]).withColumn(
        "agent_id", F.lit("nobody")
    )
    return Q.reconcile_daily(fact, stored.unionByName(stray.select(*stored.columns)))


@query(
    "reconcile_incidents",
    """SELECT COUNT(*) AS source_rows, COUNT(*) FILTER (WHERE incident_type <> 'dns_failure') AS fact_rows,
  COUNT(*) FILTER (WHERE incident_type IN ('dns_failure','wifi_outage')) AS mismatch_rows FROM incidents""",
    RULE_PAIRS,
)
def reconcile_incidents(spark, folder):
    """Against a fact without the DNS failures and sources that repeat an agent."""
    incidents = _incidents(_rules(spark, folder))
    kind = F.col("incident_type")
    doubled = incidents.withColumn(
        "affected_agents",
        F.when(
            kind == "wifi_outage", F.concat("affected_agents", F.slice("affected_agents", 1, 1))
        ).otherwise(F.col("affected_agents")),
    )
    stored = incidents.where(kind != "dns_failure")
    return Q.reconcile_incidents(
        doubled,
        D.incident_fact(stored),
        D.bridge(stored, "affected_agents", "agent_id"),
        D.bridge(stored, "affected_endpoints", "endpoint_id"),
    )


def _job_runs(t: Telemetry) -> DataFrame:
    """One run per day that has facts, out of the events themselves."""
    days = D.event_dates(t.base).groupBy("date_utc").agg(F.count(F.lit(1)).alias("daily_rows"))
    return days.select(
        F.dayofmonth("date_utc").cast("bigint").alias("run_id"),
        F.lit(FIRST).alias("from_date"),
        F.col("date_utc").alias("through_date"),
        F.lit(False).alias("is_all"),
        "daily_rows",
    )


@query(
    "reporting_validation",
    f"""SELECT COUNT(*) AS reporting_rows, CAST(0 AS BIGINT) AS duplicate_rows, CAST(0 AS BIGINT) AS invalid_rows,
  (SELECT COUNT(*) > 0 FROM base WHERE CAST(event_time AS DATE) = DATE '2024-01-20') AS run_matches
FROM daily_view WHERE date_utc BETWEEN {RANGE_SQL}""",
)
def reporting_validation(spark, folder):
    t = Telemetry(spark, folder)
    return Q.validate_reporting(_view(t), _job_runs(t), FIRST, LAST, run_id=20)


def _ledger_events(t: Telemetry) -> DataFrame:
    """Start and finish events of a daily run; every third day fails first."""
    days = D.event_dates(t.base).groupBy("date_utc").agg(F.count(F.lit(1)).alias("n"))
    dom = F.dayofmonth("date_utc")
    none = F.lit(None)

    def event(df, seq: int, kind: str, success: bool | None = None):
        failed = kind == "failed"
        return df.select(
            Q.run_key("daily", F.col("date_utc"), F.col("date_utc")).alias("run_key"),
            F.lit(seq).alias("seq"),
            F.lit(kind).alias("event"),
            (F.col("date_utc").cast("timestamp") + F.expr(f"INTERVAL {seq} HOUR")).alias("at"),
            F.col("date_utc").alias("from_date"),
            F.col("date_utc").alias("through_date"),
            F.lit("healthy").alias("source_status"),
            F.col("n").alias("source_observation_count"),
            (dom.cast("bigint") if kind == "success" else none.cast("bigint")).alias(
                "analytics_run_id"
            ),
            (F.lit(0) if kind == "success" else none).cast("bigint").alias("daily_mismatch_rows"),
            (F.lit(0) if kind == "success" else none).cast("bigint").alias(
                "incident_mismatch_rows"
            ),
            (F.lit("refresh") if failed else none.cast("string")).alias("failed_task_id"),
            (F.lit("RuntimeError") if failed else none.cast("string")).alias("error_type"),
        )

    third = days.where(dom % 3 == 0)
    finished = days.where(dom % 5 != 0)
    parts = [
        event(third, 1, "start"),
        event(third, 2, "failed"),
        event(days, 3, "start"),
        event(finished.where(dom % 7 != 0), 4, "success"),
        event(finished.where(dom % 7 == 0), 4, "failed"),
    ]
    merged = parts[0]
    for p in parts[1:]:
        merged = merged.unionByName(p)
    return merged


_LEDGER_PARTS = {
    "run_days": """
  SELECT CAST(event_time AS DATE) AS d, day(event_time) AS dom, COUNT(*) AS n FROM base GROUP BY ALL""",
    "runs": """
  SELECT 'daily:' || strftime(d, '%Y-%m-%d') || ':' || strftime(d, '%Y-%m-%d') AS run_key, d AS from_date,
    d AS through_date, CASE WHEN dom % 5 = 0 THEN 'running' WHEN dom % 7 = 0 THEN 'failed' ELSE 'success' END AS status,
    'healthy' AS source_status, n AS source_observation_count,
    CAST(CASE WHEN dom % 3 = 0 THEN 2 ELSE 1 END AS INTEGER) AS attempt_count,
    CAST(d AS TIMESTAMP) + INTERVAL 3 HOUR AS started_at,
    CASE WHEN dom % 5 <> 0 THEN CAST(d AS TIMESTAMP) + INTERVAL 4 HOUR END AS completed_at,
    CASE WHEN dom % 5 <> 0 AND dom % 7 <> 0 THEN CAST(dom AS BIGINT) END AS analytics_run_id,
    CASE WHEN dom % 5 <> 0 AND dom % 7 <> 0 THEN CAST(0 AS BIGINT) END AS daily_mismatch_rows,
    CASE WHEN dom % 5 <> 0 AND dom % 7 <> 0 THEN CAST(0 AS BIGINT) END AS incident_mismatch_rows,
    CASE WHEN dom % 5 <> 0 AND dom % 7 = 0 THEN 'refresh' END AS failed_task_id,
    CASE WHEN dom % 5 <> 0 AND dom % 7 = 0 THEN 'RuntimeError' END AS error_type FROM run_days""",
}


@query(
    "run_ledger",
    f"""SELECT run_key, {day('from_date')} AS from_date, {day('through_date')} AS through_date, status, source_status,
  source_observation_count, attempt_count, {ts('started_at')} AS started_at, {ts('completed_at')} AS completed_at,
  analytics_run_id, daily_mismatch_rows, incident_mismatch_rows, failed_task_id, error_type,
  (epoch_us(coalesce(completed_at, {NOW_SQL})) - epoch_us(started_at)) / 1e6 AS duration_seconds FROM runs""",
    extra=_LEDGER_PARTS,
)
def run_ledger(spark, folder):
    return W.workflow_status(Q.ledger_state(_ledger_events(Telemetry(spark, folder))), NOW)


@query(
    "workflow_status_or_sentinel",
    f"""SELECT * FROM (SELECT status, source_status, {day('from_date')} AS from_date, {day('through_date')} AS through_date,
  attempt_count, source_observation_count, daily_mismatch_rows, incident_mismatch_rows, failed_task_id, error_type,
  {ts('started_at')} AS started_at, {ts('completed_at')} AS completed_at,
  (epoch_us(coalesce(completed_at, {NOW_SQL})) - epoch_us(started_at)) / 1e6 AS duration_seconds
  FROM runs ORDER BY started_at DESC LIMIT 1)
UNION ALL SELECT 'no_runs', 'not_applicable', NULL, NULL, 0, 0, NULL, NULL, NULL, NULL, NULL, NULL, NULL
  WHERE NOT EXISTS (SELECT 1 FROM runs WHERE attempt_count > 5)""",
    extra=_LEDGER_PARTS,
)
def workflow_status_or_sentinel(spark, folder):
    """The newest run, and the answer for a filter nothing passes."""
    runs = W.workflow_status(Q.ledger_state(_ledger_events(Telemetry(spark, folder))), NOW)
    return P.latest_or_sentinel(runs).unionByName(
        P.latest_or_sentinel(runs.where("attempt_count > 5"))
    )


_VIOLATIONS_SQL = " UNION ALL ".join(
    f"SELECT '{t}' AS table_name, '{r}' AS rule_name, CAST({n} AS BIGINT) AS violations"
    for t, rules, n in (
        (
            "window_metrics",
            ("negative_count", "count_sum", "rate_range", "window_order", "window_size"),
            0,
        ),
        (
            "fact_reliability_daily",
            ("empty_grain", "negative_count", "count_sum", "value_count", "latency_null",
             "loss_null"),
            0,
        ),
    )
    for r in rules
)


@query(
    "constraint_violations",
    _VIOLATIONS_SQL
    + """ UNION ALL SELECT 'distorted_daily', r, CASE r WHEN 'count_sum' THEN (SELECT COUNT(*) FROM daily_fact)
    WHEN 'latency_null' THEN (SELECT COUNT(*) FROM daily_fact WHERE latency_count > 0) ELSE 0 END
  FROM (VALUES ('empty_grain'), ('negative_count'), ('count_sum'), ('value_count'), ('latency_null'), ('loss_null')) v(r)""",
)
def constraint_violations(spark, folder):
    """Own outputs break no rule; a distorted copy breaks the expected ones."""
    t = Telemetry(spark, folder)
    fact = _fact(t)
    metrics = window_metrics(_valid_rows(t))
    distorted = fact.withColumns(
        {
            "failure_count": F.col("failure_count") + 1,
            "latency_sum_ms": F.lit(None).cast("double"),
        }
    )
    return (
        Q.violations(metrics, "window_metrics", Q.window_invariants())
        .unionByName(Q.violations(fact, "fact_reliability_daily", Q.daily_invariants()))
        .unionByName(Q.violations(distorted, "distorted_daily", Q.daily_invariants()))
    )


@query(
    "duplicate_deliveries",
    """SELECT event_id, COUNT(*) AS row_count FROM outcomes WHERE outcome <> 'dead_lettered'
GROUP BY event_id HAVING COUNT(*) > 1""",
)
def duplicate_deliveries(spark, folder):
    outcomes = I.classify_outcome(_referenced(Telemetry(spark, folder)))
    return Q.duplicates(outcomes.where(F.col("outcome") != "dead_lettered"), ["event_id"])


# --- pages and extracts ------------------------------------------------------------------

_PAGE_ORDER = "date_utc DESC, agent_id, endpoint_id, source_kind, probe_type"


@query(
    "daily_page_first",
    f"""SELECT {_VIEW_COLUMNS}, (SELECT COUNT(*) > 50 FROM daily_view) AS has_more
FROM (SELECT * FROM daily_view ORDER BY {_PAGE_ORDER} LIMIT 50)""",
)
def daily_page_first(spark, folder):
    return P.page(_view(Telemetry(spark, folder)), limit=50)


_KEY = P.PageKey(dt.date(2024, 1, 15), "wifi-3", "router", "network_measurement", "router_ping")
_AFTER = f"""(date_utc < DATE '2024-01-15' OR (date_utc = DATE '2024-01-15' AND
  (agent_id, endpoint_id, source_kind, probe_type) > ('wifi-3', 'router', 'network_measurement', 'router_ping')))"""
_FILTER = f"date_utc BETWEEN {RANGE_SQL} AND source_kind = 'network_measurement' AND {_AFTER}"


@query(
    "daily_page_next",
    f"""SELECT {_VIEW_COLUMNS}, (SELECT COUNT(*) > 200 FROM daily_view WHERE {_FILTER}) AS has_more
FROM (SELECT * FROM daily_view WHERE {_FILTER} ORDER BY {_PAGE_ORDER} LIMIT 200)""",
)
def daily_page_next(spark, folder):
    filters = P.PageFilters(FIRST, LAST, source_kind="network_measurement")
    return P.page(_view(Telemetry(spark, folder)), filters, _KEY, limit=200)


def _role_rows(t: Telemetry) -> DataFrame:
    return X.with_roles(_view(t), W.agent_status(t.agents, t.heartbeats, NOW))


_POOLED = f"""SUM(total_count) AS total_probes, SUM(success_count) AS successful_probes, SUM(failure_count) AS failed_probes,
  100.0 * CAST(SUM(success_count) AS DOUBLE) / NULLIF(SUM(total_count), 0) AS success_rate_pct,
  coalesce({O.esum('latency_sum_ms')}, 0) / NULLIF(SUM(latency_count), 0) AS average_latency_ms,
  coalesce({O.esum('packet_loss_sum_pct')}, 0) / NULLIF(SUM(packet_loss_count), 0) AS average_packet_loss_pct"""
_BIGINTS = "REPLACE (CAST(total_probes AS BIGINT) AS total_probes, CAST(successful_probes AS BIGINT) AS successful_probes, CAST(failed_probes AS BIGINT) AS failed_probes)"


@query(
    "export_daily",
    f"""SELECT * {_BIGINTS} FROM (SELECT {day('date_utc')} AS date_utc, {O.pseudonym('agent_id')} AS agent_key, agent_role,
  source_kind, probe_type AS measurement_type, {_POOLED} FROM role_rows
GROUP BY date_utc, agent_id, agent_role, source_kind, probe_type)""",
)
def export_daily(spark, folder):
    return X.export_daily(_role_rows(Telemetry(spark, folder)))


@query(
    "export_agents",
    f"""SELECT * {_BIGINTS} FROM (SELECT {O.pseudonym('agent_id')} AS agent_key, agent_role, source_kind,
  probe_type AS measurement_type, {day('MIN(date_utc)')} AS first_observation_date,
  {day('MAX(date_utc)')} AS latest_observation_date, COUNT(DISTINCT date_utc) AS observation_day_count, {_POOLED}
FROM role_rows GROUP BY agent_id, agent_role, source_kind, probe_type)""",
)
def export_agents(spark, folder):
    return X.export_agents(_role_rows(Telemetry(spark, folder)))


@query(
    "export_incidents",
    f"""SELECT incident_id, incident_type, {O.iso('start_time', 'Z')} AS start_time_utc,
  CASE WHEN end_time IS NOT NULL THEN {O.iso('end_time', 'Z')} END AS end_time_utc, duration_ms, status, severity,
  '1.0.0' AS rule_version, state_revision, affected_agent_count, affected_endpoint_count FROM incident_view""",
    RULE_PAIRS,
)
def export_incidents(spark, folder):
    view = _incident_view(_rules(spark, folder))
    # equal duplicates must collapse
    return X.export_incidents(view.unionByName(view), check=False).drop("confidence_score")


@query(
    "export_health",
    f"""SELECT {O.iso('observed_at', 'Z')} AS observed_at_utc, {O.iso('last_raw', 'Z')} AS last_raw_event_received_at_utc,
  greatest(0, (epoch_us(observed_at) - epoch_us(last_raw)) / 1e6) AS raw_event_age_seconds,
  letters AS pending_dead_letter_count, stream AS stream_processing_failure_count,
  {O.iso('last_batch', 'Z')} AS last_stream_batch_completed_at_utc, active AS active_incident_count,
  waiting AS pending_incident_publication_count FROM status_row""",
    RULE_PAIRS,
    _STATUS_PARTS,
)
def export_health(spark, folder):
    return X.export_pipeline(_ingest_status(_rules(spark, folder)))


@query(
    "pseudonyms",
    f"SELECT agent_id, {O.pseudonym('agent_id')} AS agent_key FROM agents",
)
def pseudonyms(spark, folder):
    return Telemetry(spark, folder).agents.select("agent_id", pseudonym("agent_id").alias("agent_key"))


@query(
    "identifier_privacy",
    """SELECT c_custkey, CAST(NULL AS VARCHAR) AS omitted, 'sha256:' || sha256('pepper:' || c_name) AS hashed,
  c_name AS plain FROM customer""",
)
def identifier_privacy(spark, folder):
    return table(spark, folder, "customer").select(
        "c_custkey",
        protect("c_name", "omit").alias("omitted"),
        protect("c_name", "hash", "pepper").alias("hashed"),
        protect("c_name", "plain").alias("plain"),
    )


# --- probe output ---------------------------------------------------------------------------

_PING_TEXT = """'PING target: ' || CASE k % 4 WHEN 0 THEN '4 packets transmitted, 4 received, 0% packet loss, time 3004ms'
    WHEN 1 THEN '4 packets transmitted, 3 received, 25.5% packet loss, time 3004ms'
    WHEN 2 THEN '4 packets transmitted, 0 received, 100% packet loss' ELSE 'unknown host' END
  || CASE WHEN k % 4 < 2 AND k % 7 <> 0 THEN chr(10) || 'rtt min/avg/max/mdev = ' || CAST(k AS STRING) || '.1/'
    || CAST(k + 1 AS STRING) || '.25/' || CAST(k + 2 AS STRING) || '.5/0.75 ms' ELSE '' END"""
_WIFI_TEXT = """CASE WHEN k % 5 = 0 THEN 'Not connected.' ELSE 'Connected to AA:BB:CC:DD:EE:' || lpad(CAST(k AS STRING), 2, '0')
  || ' (on wlan0)' || chr(10) || chr(9) || 'SSID: home net ' || CAST(k AS STRING) || chr(10) || chr(9) || 'freq: '
  || CAST(2400 + k AS STRING) || chr(10)
  || CASE WHEN k % 3 = 0 THEN '' ELSE chr(9) || 'signal: -' || CAST(k AS STRING) || ' dBm' || chr(10) END || chr(9)
  || 'tx bitrate: ' || CAST(k AS STRING) || '.5 MBit/s' END"""


@query(
    "ping_log_parse",
    f"""SELECT event_no, ok AS success, CASE WHEN ok THEN avg_ms END AS latency_ms, loss AS packet_loss_pct,
  CASE WHEN ok THEN 0.75 END AS jitter_ms, CASE WHEN NOT ok THEN 'PingFailed' END AS error_class,
  CASE WHEN NOT ok THEN CASE WHEN k % 11 = 0 THEN 'sendmsg: no route' ELSE text END END AS error_message
FROM (SELECT *, k % 11 <> 0 AND loss < 100 AND avg_ms IS NOT NULL AS ok
  FROM (SELECT event_no, k, {_PING_TEXT} AS text,
    CAST(CASE k % 4 WHEN 0 THEN 0 WHEN 1 THEN 25.5 ELSE 100 END AS DOUBLE) AS loss,
    CASE WHEN k % 4 < 2 AND k % 7 <> 0 THEN k + 1.25 END AS avg_ms
    FROM base WHERE kind IN ('router_ping','external_ping')))""",
)
def ping_log_parse(spark, folder):
    k = F.col("k")
    log = Telemetry(spark, folder).base.where(
        F.col("kind").isin("router_ping", "external_ping")
    ).select(
        "event_no",
        F.expr(_PING_TEXT).alias("stdout"),
        F.when(k % 11 == 0, F.lit(" sendmsg: no route\n")).otherwise(F.lit("")).alias("stderr"),
        F.when(k % 11 == 0, F.lit(2)).otherwise(F.lit(0)).alias("return_code"),
    )
    fields = ping_fields("stdout", "stderr", "return_code")
    return log.select("event_no", *[c.alias(n) for n, c in fields.items()])


@query(
    "wifi_log_parse",
    """SELECT event_no, ok AS success, ok AS connected, CAST(CASE WHEN ok THEN 0 ELSE 100 END AS DOUBLE) AS packet_loss_pct,
  CASE WHEN ok THEN 'sha256:' || sha256('pepper:home net ' || CAST(k AS VARCHAR)) END AS ssid,
  CASE WHEN ok THEN 'aa:bb:cc:dd:ee:' || lpad(CAST(k AS VARCHAR), 2, '0') END AS bssid,
  CASE WHEN ok AND k % 3 <> 0 THEN CAST(-k AS DOUBLE) END AS signal_dbm,
  CASE WHEN ok THEN CAST(2400 + k AS INTEGER) END AS frequency_mhz, CASE WHEN ok THEN CAST(k + 0.5 AS DOUBLE) END AS bitrate_mbps,
  CASE WHEN NOT ok THEN 'WifiDisconnected' END AS error_class, CASE WHEN NOT ok THEN 'Not connected.' END AS error_message
FROM (SELECT event_no, k, k % 5 <> 0 AS ok FROM base WHERE kind = 'wifi_diagnostics')""",
)
def wifi_log_parse(spark, folder):
    log = Telemetry(spark, folder).base.where(F.col("kind") == "wifi_diagnostics").select(
        "event_no",
        F.expr(_WIFI_TEXT).alias("stdout"),
        F.lit("").alias("stderr"),
        F.lit(0).alias("return_code"),
    )
    fields = wifi_fields(
        "stdout", "stderr", "return_code", ssid_mode="hash", bssid_mode="plain", salt="pepper"
    )
    return log.select("event_no", *[c.alias(n) for n, c in fields.items()])


@query(
    "probe_numbers",
    """SELECT event_no, s BETWEEN 200 AND 399 AS success,
  CASE WHEN k % 9 = 0 THEN 'Timeout' WHEN s NOT BETWEEN 200 AND 399 THEN 'HttpStatusError' END AS error_class,
  (v * 1000000) / 1e6 AS download_mbps, CASE WHEN k = 0 THEN 0 ELSE least(100, greatest(0, v / k * 100)) END AS used_pct
FROM (SELECT event_no, k, v, 150 + k * 4 AS s FROM base)""",
)
def probe_numbers(spark, folder):
    status, late = F.lit(150) + F.col("k") * 4, F.col("k") % 9 == 0
    return Telemetry(spark, folder).base.select(
        "event_no",
        http_success(status).alias("success"),
        http_error_class(status, late).alias("error_class"),
        megabits(F.col("v") * F.lit(1e6)).alias("download_mbps"),
        utilization("v", "k").alias("used_pct"),
    )


# --- service levels ---------------------------------------------------------------------------


def _outcome_log(t: Telemetry) -> DataFrame:
    """Outcome of every record, when it arrived and how long it took."""
    checked = _referenced(t)
    outcomes = I.classify_outcome(checked).select(*I.COORDINATES, "kafka_timestamp", "outcome")
    delay = t.raw_log.select("event_no", "k")
    number = F.pmod("source_offset", F.lit(1_000_000_000)) * 3 + F.col("source_partition")
    return (
        outcomes.withColumn("event_no", number)
        .join(delay, "event_no")
        .select(
            F.col("kafka_timestamp").alias("ts"),
            "outcome",
            ((F.col("k") + 1).cast("double") / F.lit(20.0)).alias("duration_s"),
        )
    )


_SLO_PARTS = {
    "slo_bounds": "SELECT MIN(epoch_us(ts)) AS lo, MAX(epoch_us(ts)) AS hi FROM outcome_log",
    "slo_ticks": f"""
  SELECT n, make_timestamp(n * {SLO_SQL['step']}000000) AS tick FROM (SELECT unnest(generate_series(
    (lo + {SLO_SQL['step']}000000 - 1) // {SLO_SQL['step']}000000,
    (hi + {SLO_SQL['step']}000000 - 1) // {SLO_SQL['step']}000000)) AS n FROM slo_bounds)""",
    "slo_rows": f"""
  SELECT l.*, make_timestamp(n * {SLO_SQL['step']}000000) AS tick FROM (SELECT *, unnest(generate_series(
      (epoch_us(ts) + {SLO_SQL['step']}000000 - 1) // {SLO_SQL['step']}000000,
      (epoch_us(ts) + {SLO_SQL['look']}000000 - 1) // {SLO_SQL['step']}000000)) AS n FROM outcome_log) l
  WHERE epoch_us(ts) > n * {SLO_SQL['step']}000000 - {SLO_SQL['look']}000000 AND epoch_us(ts) <= n * {SLO_SQL['step']}000000""",
    "slo_ratio": f"""
  SELECT t.tick, COUNT(r.outcome) FILTER (WHERE r.outcome IN ('valid','duplicate')) AS good, COUNT(r.outcome) AS total,
    (CAST(COUNT(r.outcome) FILTER (WHERE r.outcome IN ('valid','duplicate')) AS DOUBLE) / {SLO_SQL['look']})
      / greatest(CAST(COUNT(r.outcome) AS DOUBLE) / {SLO_SQL['look']}, CAST(0.000001 AS DOUBLE)) AS success_ratio
  FROM slo_ticks t LEFT JOIN slo_rows r ON r.tick = t.tick GROUP BY t.tick""",
    "slo_burn": """
  SELECT *, greatest(CAST(0 AS DOUBLE), (1 - success_ratio) / CAST(0.01 AS DOUBLE)) AS burn FROM slo_ratio""",
}


def _ratios(spark, t: Telemetry) -> DataFrame:
    log = _outcome_log(t)
    # every record has an outcome, so the records' own times give the span
    span = TickSpan.covering(t.kafka, "timestamp", SLO_CADENCE)
    counts = K.on_spine(
        K.success_counts(log, SLO_CADENCE), spark, span, SLO_CADENCE, ("good", "total")
    )
    return K.success_ratio(counts, SLO_CADENCE)


@query(
    "slo_success_ratio",
    f"SELECT {ts('tick')} AS ts, good, total, success_ratio FROM slo_ratio",
    extra=_SLO_PARTS,
)
def slo_success_ratio(spark, folder):
    return _ratios(spark, Telemetry(spark, folder))


@query(
    "slo_burn",
    f"SELECT {ts('tick')} AS ts, good, total, success_ratio, burn FROM slo_burn",
    extra=_SLO_PARTS,
)
def slo_burn(spark, folder):
    return K.burn(_ratios(spark, Telemetry(spark, folder)))


_P95_ARMS = []
_lower = "0"
_below = "0"
for _i, _bound in enumerate(K.BUCKETS):
    _P95_ARMS.append(
        f"WHEN b{_i} >= r THEN CAST({_lower} AS DOUBLE) + (CAST({_bound} AS DOUBLE) - CAST({_lower} AS DOUBLE))"
        f" * ((r - {_below}) / CAST(b{_i} - {_below} AS DOUBLE))"
    )
    _lower, _below = str(_bound), f"b{_i}"


@query(
    "slo_p95",
    f"""SELECT {ts('tick')} AS ts, total AS samples, CASE {' '.join(_P95_ARMS)} ELSE 10.0 END AS quantile_s FROM (
  SELECT tick, COUNT(*) AS total, CAST(0.95 AS DOUBLE) * COUNT(*) AS r,
    {', '.join(f'COUNT(*) FILTER (WHERE duration_s <= CAST({b} AS DOUBLE)) AS b{i}' for i, b in enumerate(K.BUCKETS))}
  FROM slo_rows GROUP BY tick)""",
    extra=_SLO_PARTS,
)
def slo_p95(spark, folder):
    return K.duration_quantile(_outcome_log(Telemetry(spark, folder)), SLO_CADENCE)


@query(
    "slo_freshness",
    f"""SELECT {ts('last')} AS last_success_at, greatest(0, (epoch_us({NOW_SQL}) - epoch_us(last)) / 1e6) AS freshness_seconds
FROM (SELECT MAX(ts) AS last FROM outcome_log WHERE outcome IN ('valid','duplicate'))""",
)
def slo_freshness(spark, folder):
    return K.freshness(_outcome_log(Telemetry(spark, folder)), NOW)


@query(
    "slo_lag",
    """SELECT source_topic, source_partition, MAX(source_offset) + 1 AS end_offset,
  coalesce(MAX(source_offset) FILTER (WHERE kafka_timestamp < TIMESTAMP '2024-01-20') + 1, 0) AS committed_offset,
  MAX(source_offset) + 1 - coalesce(MAX(source_offset) FILTER (WHERE kafka_timestamp < TIMESTAMP '2024-01-20') + 1, 0) AS lag
FROM records GROUP BY source_topic, source_partition""",
)
def slo_lag(spark, folder):
    source = Telemetry(spark, folder).kafka.select(
        F.col("topic").alias("source_topic"),
        F.col("partition").alias("source_partition"),
        F.col("offset").alias("source_offset"),
        "timestamp",
    )
    done = source.where(F.col("timestamp") < F.lit(dt.datetime(2024, 1, 20, tzinfo=UTC)))
    return K.consumer_lag(source, done)


@query(
    "slo_throughput",
    f"""SELECT outcome, {ts('tick')} AS ts, CAST(COUNT(*) AS DOUBLE) / {SLO_SQL['look']} AS records_per_second
FROM slo_rows GROUP BY outcome, tick""",
    extra=_SLO_PARTS,
)
def slo_throughput(spark, folder):
    return K.throughput(_outcome_log(Telemetry(spark, folder)), SLO_CADENCE)


@query(
    "slo_dead_letter_growth",
    f"""SELECT {ts('tick')} AS ts, COUNT(*) AS increase FROM slo_rows WHERE outcome = 'dead_lettered' GROUP BY tick""",
    extra=_SLO_PARTS,
)
def slo_dead_letter_growth(spark, folder):
    return K.growth(_outcome_log(Telemetry(spark, folder)), SLO_CADENCE, "dead_lettered")


_BURN_LIMIT = 35.0


@query(
    "slo_sustained_breach",
    f"""SELECT {ts('a')} AS pending_since, {ts('a + INTERVAL 3600 SECOND')} AS firing_at, {ts('b')} AS last_true_at, n AS evaluations
FROM (SELECT MIN(tick) AS a, MAX(tick) AS b, COUNT(*) AS n FROM (
    SELECT tick, epoch_us(tick) - row_number() OVER (ORDER BY tick) * {SLO_SQL['step']}000000 AS island
    FROM slo_burn WHERE burn > {_BURN_LIMIT}) GROUP BY island)
WHERE epoch_us(b) - epoch_us(a) >= 3600000000""",
    extra=_SLO_PARTS,
)
def slo_sustained_breach(spark, folder):
    rows = K.burn(_ratios(spark, Telemetry(spark, folder)))
    return K.sustained(rows, F.col("burn") > _BURN_LIMIT, hold=3600, step=SLO_CADENCE.step)


# --- streams and files --------------------------------------------------------------------------


def _landed(spark, rows: DataFrame, name: str) -> str:
    path = scratch_path(spark, name)
    rows.write.mode("overwrite").parquet(path)
    return path


def _stretches(spark, rows: DataFrame, column: str, parts: int) -> list[DataFrame]:
    """Rows cut into ``parts`` equal stretches of a column; one if there are none."""
    rows = spark.read.parquet(_landed(spark, rows, "unordered"))
    low, high = rows.agg(F.min(column), F.max(column)).first()
    if low is None:
        return [rows]
    place = F.least(
        F.floor((F.col(column) - low) * parts / F.lit(max(1, high - low))), F.lit(parts - 1)
    )
    return [rows.where(place == n) for n in range(parts)]


def _landed_in_order(spark, rows: DataFrame, column: str, parts: int) -> str:
    """Rows in ``parts`` equal stretches of a column, written one after the other."""
    path = scratch_path(spark, "ordered")
    for stretch in _stretches(spark, rows, column, parts):
        stretch.coalesce(1).write.mode("append").parquet(path)
    return path


@contextmanager
def _keyed_state(spark):
    """The state store of keyed state, for the streams started inside."""
    from linkwatch.streaming.lifecycle import STATE_STORE

    before = spark.conf.get(STATE_STORE[0], None)
    spark.conf.set(*STATE_STORE)
    try:
        yield
    finally:
        spark.conf.unset(STATE_STORE[0]) if before is None else spark.conf.set(
            STATE_STORE[0], before
        )


@query("stream_window_metrics", _METRICS_SQL)
def stream_window_metrics(spark, folder):
    """Landed records through the metrics stream; all arrive in one trigger, so
    nothing is late and the result is the batch one."""
    from linkwatch.sources.kafka import file_source
    from linkwatch.streaming.jobs import start_query

    landed = _landed(spark, _measurement_records(Telemetry(spark, folder)), "records")
    out = scratch_path(spark, "stream-metrics")
    valid, _ = V.split(file_source(spark, landed), now="kafka_timestamp")
    start_query(
        window_metrics(valid, S.WATERMARK),
        sinks.metrics_writer(f"{out}/metrics", f"{out}/ledger", largest=None),
        name="window-metrics",
        checkpoint=f"{out}/checkpoint",
        mode="update",
    ).awaitTermination()
    log = spark.read.parquet(f"{out}/metrics")
    return _shown_metrics(sinks.resolve_last(log, sinks.METRIC_KEYS).drop(sinks.BATCH))


@query(
    "stream_rejects",
    """SELECT source_topic, source_partition, source_offset, source_key, errors AS validation_errors
FROM stream_checked WHERE errors <> ''""",
)
def stream_rejects(spark, folder):
    from linkwatch.sources.kafka import file_source
    from linkwatch.streaming.jobs import start_query

    landed = _landed(spark, _measurement_records(Telemetry(spark, folder)), "records")
    out = scratch_path(spark, "stream-rejects")
    _, invalid = V.split(file_source(spark, landed), now=NOW)
    start_query(
        invalid,
        sinks.rejects_writer(f"{out}/rejects", f"{out}/ledger", largest=None),
        name="invalid-measurements",
        checkpoint=f"{out}/checkpoint",
        mode="append",
    ).awaitTermination()
    rows = sinks.resolve_first_seen(spark.read.parquet(f"{out}/rejects"))
    return rows.select(
        "source_topic", "source_partition", "source_offset", "source_key", "validation_errors"
    )


@query("stream_lifecycle", _TRANSITIONS_SQL, RULE_PAIRS)
def stream_lifecycle(spark, folder):
    """The keyed-state lifecycle over landed evaluations."""
    return _stream_lifecycle(spark, folder).where("kind = 'state'").select(*_TRANSITION_COLUMNS)


# files come in no order here, so nothing may be taken for lost
_ANY_ORDER = "3650 days"


def _stream_lifecycle(
    spark, folder, files: int | None = None, held: Callable[[Telemetry], DataFrame] | None = None,
    delay: str = _ANY_ORDER,
):
    """The stream's output over landed evaluations; ``held`` names those that were made."""
    from linkwatch.streaming.jobs import start_query
    from linkwatch.streaming.lifecycle import finding_type, lifecycle_stream, tick_rows

    t = _rules(spark, folder)
    found = spark.read.parquet(_landed(spark, _findings(t), "findings"))
    rows = tick_rows(found, _span(t), CFG, held(t) if held else None)
    if held:
        made = rows.join(held(t), ["site_id", "tick_us"], "left_semi")
        landed = _landed_in_order(spark, made, "tick_us", files)
    else:
        if files:
            rows = rows.repartition(files, F.xxhash64("tick_us"))
        landed = _landed(spark, rows, "ticks")
    source = spark.readStream.schema(spark.read.parquet(landed).schema)
    if files:
        source = source.option("maxFilesPerTrigger", 2)
    ticks = source.parquet(landed)
    out = scratch_path(spark, "stream-lifecycle")
    with _keyed_state(spark):
        start_query(
            lifecycle_stream(ticks, CFG, finding_type(found), delay=delay),
            lambda batch, n: sinks.append_batch(batch, f"{out}/transitions", n),
            name="incident-lifecycle",
            checkpoint=f"{out}/checkpoint",
            mode="append",
        ).awaitTermination()
    return spark.read.parquet(f"{out}/transitions")


@query("stream_lifecycle_unordered", _TRANSITIONS_SQL, RULE_PAIRS)
def stream_lifecycle_unordered(spark, folder):
    """The same over several triggers whose files hold the evaluations in no order."""
    rows = _stream_lifecycle(spark, folder, files=6)
    return rows.where("kind = 'state'").select(*_TRANSITION_COLUMNS)


def _evaluated(t: Telemetry) -> DataFrame:
    """A site was evaluated at the ticks before which a router ping of it came."""
    tick = _cadence().tick_at_or_after(F.col("event_time"))
    pings = t.base.where(F.col("kind") == "router_ping")
    return pings.select("site_id", tick.alias("tick_us")).distinct()


def _gap_parts() -> dict[str, str]:
    """The fold over the evaluations that were made, all others left out."""
    parts, step = O.lifecycle(CFG), int(CFG.interval_seconds) * 1000000
    fold = parts["fold"].replace("FROM grid", "FROM gap_grid").replace("JOIN grid", "JOIN gap_grid")
    return {
        "evaluated": f"""
  SELECT DISTINCT site_id, (epoch_us(event_time) + {step - 1}) // {step} AS n
  FROM base WHERE kind = 'router_ping'""",
        "gap_hits": "SELECT h.* FROM hits h JOIN evaluated e ON e.site_id = h.site_id AND e.n = h.n",
        "gap_grid": """
  SELECT k.site_id, k.incident_key, t.n, h.n IS NOT NULL AS hit,
    row_number() OVER (PARTITION BY k.site_id, k.incident_key ORDER BY t.n) AS i
  FROM (SELECT site_id, incident_key, MIN(n) AS first_n FROM gap_hits GROUP BY ALL) k
    JOIN evaluated t ON t.site_id = k.site_id AND t.n >= k.first_n
    LEFT JOIN gap_hits h ON h.site_id = k.site_id AND h.incident_key = k.incident_key AND h.n = t.n""",
        "gap_fold": fold.replace("FROM fold", "FROM gap_fold"),
        "gap_transitions": parts["transitions"]
        .replace("FROM fold", "FROM gap_fold")
        .replace("JOIN hits", "JOIN gap_hits"),
        "gap_steps": f"""
  SELECT site_id, n, n - coalesce(lag(n) OVER (PARTITION BY site_id ORDER BY n),
    (SELECT MIN(n) FROM ticks) - 1) - 1 AS gap FROM evaluated""",
    }


@query(
    "stream_lifecycle_gaps",
    _TRANSITIONS_SQL.replace("FROM transitions", "FROM gap_transitions"),
    RULE_PAIRS,
    extra=_gap_parts(),
)
def stream_lifecycle_gaps(spark, folder):
    """The stream where evaluations are missing: timers close the gaps."""
    rows = _stream_lifecycle(spark, folder, files=6, held=_evaluated, delay="0 seconds")
    return rows.where("kind = 'state'").select(*_TRANSITION_COLUMNS)


@query(
    "stream_lifecycle_losses",
    f"""SELECT site_id, 'missing' AS kind,
  {ts(f'make_timestamp(n * {int(CFG.interval_seconds) * 1000000})')} AS observed_at,
  gap AS evaluations FROM gap_steps WHERE gap > 0""",
    RULE_PAIRS,
    extra=_gap_parts(),
)
def stream_lifecycle_losses(spark, folder):
    """How many evaluations were missing before each one that followed a gap.

    They are due from the first tick on, so those before a site's first one count.
    """
    from linkwatch.streaming.lifecycle import losses_of

    return losses_of(
        _stream_lifecycle(spark, folder, files=6, held=_evaluated, delay="0 seconds")
    )


def _alert_sql(alert: str, ticks: str, hold: int) -> str:
    """Events of an alert over the ticks at which its condition holds."""
    step = SLO_SQL["step"]
    span = f"""(SELECT MIN(tick) AS a, MAX(tick) AS b, COUNT(*) AS n FROM (
    SELECT tick, epoch_us(tick) - row_number() OVER (ORDER BY tick) * {step}000000 AS island
    FROM ({ticks})) GROUP BY island)"""
    held = f"epoch_us(b) - epoch_us(a) >= {hold}000000"
    fires = f"a + INTERVAL {hold} SECOND"
    return f"""
SELECT '{alert}' AS alert, 'firing' AS kind, {ts(fires)} AS at, {ts('a')} AS pending_since,
  {ts(fires)} AS last_true_at, CAST({hold // step + 1} AS BIGINT) AS evaluations
FROM {span} WHERE {held}
UNION ALL
SELECT '{alert}', 'ended', {ts(f'b + INTERVAL {step} SECOND')}, {ts('a')}, {ts('b')}, n
FROM {span} WHERE {held} AND b < (SELECT MAX(tick) FROM slo_ticks)"""


_ALERTS_SQL = " UNION ALL ".join(
    (
        _alert_sql("burn", f"SELECT tick FROM slo_burn WHERE burn > {_BURN_LIMIT}", 3600),
        _alert_sql(
            "growth", "SELECT DISTINCT tick FROM slo_rows WHERE outcome = 'dead_lettered'", 0
        ),
    )
)


@query("slo_alert_events", _ALERTS_SQL, extra=_SLO_PARTS)
def slo_alert_events(spark, folder):
    """Sustained burn and dead-letter growth as events, from the batch series."""
    t = Telemetry(spark, folder)
    last = TickSpan.covering(t.kafka, "timestamp", SLO_CADENCE).last
    step = SLO_CADENCE.step
    burning = K.sustained(
        K.burn(_ratios(spark, t)), F.col("burn") > _BURN_LIMIT, hold=3600, step=step
    )
    grown = K.growth(_outcome_log(t), SLO_CADENCE, "dead_lettered")
    growing = K.sustained(grown, F.col("increase") > 0, hold=0, step=step)
    named = [("burn", burning), ("growth", growing)]
    events = [
        K.alert_events(rows, last, step).select(F.lit(name).alias("alert"), "*")
        for name, rows in named
    ]
    return events[0].unionByName(events[1])


@query("stream_alerts", _ALERTS_SQL, extra=_SLO_PARTS)
def stream_alerts(spark, folder):
    """The same events from keyed state with timers, over six triggers and a restart.

    The outcome log arrives in order of time; a row of the clock at the last tick
    ends it, so the silence since the last outcome is evaluated too.
    """
    from linkwatch.streaming.alerts import (
        Alert,
        alert_stream,
        burning,
        growing,
        outcome_measures,
    )
    from linkwatch.streaming.jobs import start_query

    t = Telemetry(spark, folder)
    log = _outcome_log(t).select("ts", "outcome", F.unix_micros("ts").alias("at_us"))
    stretches = _stretches(spark, log, "at_us", 6)
    last = TickSpan.covering(t.kafka, "timestamp", SLO_CADENCE).last
    clock = spark.range(1).select(
        timestamp_of(last).alias("ts"),
        F.lit(None).cast("string").alias("outcome"),
        last.alias("at_us"),
    )
    landed, out = scratch_path(spark, "outcomes"), scratch_path(spark, "stream-alerts")
    alerts = (
        Alert("burn", burning(_BURN_LIMIT, SLO_CADENCE.lookback), 3600),
        Alert("growth", growing("dead_lettered")),
    )
    with _keyed_state(spark):
        for arrived in (stretches[:3], [*stretches[3:], clock]):
            for rows in arrived:
                rows.coalesce(1).write.mode("append").parquet(landed)
            source = spark.readStream.schema(log.schema).option("maxFilesPerTrigger", 1)
            events = alert_stream(
                source.parquet(landed),
                alerts,
                SLO_CADENCE,
                outcome_measures("dead_lettered"),
                delay="0 seconds",
            )
            start_query(
                events,
                lambda batch, n: sinks.append_batch(batch, f"{out}/events", n),
                name="service-level-alerts",
                checkpoint=f"{out}/checkpoint",
                mode="append",
            ).awaitTermination()
    return spark.read.parquet(f"{out}/events").select(
        "alert", "kind", "at", "pending_since", "last_true_at", "evaluations"
    )


@query(
    "csv_roundtrip",
    """SELECT 'agent_performance' AS dataset, (SELECT COUNT(*) FROM (SELECT DISTINCT agent_id, agent_role, source_kind,
    probe_type FROM role_rows)) AS row_count, CAST(NULL AS VARCHAR) AS problem
UNION ALL SELECT 'daily_reliability', (SELECT COUNT(*) FROM (SELECT DISTINCT date_utc, agent_id, agent_role, source_kind,
    probe_type FROM role_rows)), NULL
UNION ALL SELECT 'incidents', (SELECT COUNT(*) FROM incidents), NULL
UNION ALL SELECT 'pipeline_health', 1, NULL""",
    RULE_PAIRS,
)
def csv_roundtrip(spark, folder):
    """The four extracts written, promoted, and read back for verification."""
    t = _rules(spark, folder)
    out = scratch_path(spark, "extracts")
    transitions = _stored_transitions(t)
    incidents = landed(_incident_view(t, transitions), "incident-view")
    daily = landed(_role_rows(t), "role-rows")
    extracts = X.export_bundle(daily, incidents, _ingest_status(t, transitions))
    versions.publish_folders(spark, out, lambda folder: sinks.write_csv(extracts, folder))
    return sinks.verify_csv(spark, versions.bundle_folder(spark, out))


@query(
    "replaced_range",
    f"""SELECT {day('date_utc')} AS date_utc, COUNT(*) AS grains, CAST(SUM(total_count) AS BIGINT) AS probes
FROM daily_fact WHERE NOT (date_utc BETWEEN {RANGE_SQL} AND day(date_utc) % 3 = 0) GROUP BY date_utc""",
)
def replaced_range(spark, folder):
    """A stored fact whose range is replaced by fewer days; emptied days go."""
    fact = _fact(Telemetry(spark, folder))
    path = scratch_path(spark, "fact")
    versions.publish_range(fact, path)
    fresh = fact.where(F.dayofmonth("date_utc") % 3 != 0)
    versions.publish_range(fresh, path, FIRST, LAST)
    stored = versions.read_table(spark, path)
    return stored.groupBy("date_utc").agg(
        F.count(F.lit(1)).alias("grains"), F.sum("total_count").alias("probes")
    )


# --- sinks and states that other rows do not reach ------------------------------------


@query(
    "upsert_two_versions",
    """SELECT base.agent_id, base.event_no, base.v FROM base JOIN (
  SELECT coalesce(MAX(event_no) FILTER (event_no % 3 <> 0), MAX(event_no)) AS last_no
  FROM base GROUP BY agent_id) ON base.event_no = last_no""",
)
def upsert_two_versions(spark, folder):
    """A table merged with a batch that holds many versions of a key: the last one stays."""
    rows = Telemetry(spark, folder).base.select("agent_id", "event_no", "v")
    old = sinks.resolve_last(rows.where("event_no % 3 = 0"), ["agent_id"], "event_no")
    batch = rows.where("event_no % 3 <> 0")
    return sinks.upsert(old.select(*rows.columns), batch, ["agent_id"], "event_no")


@query(
    "batch_ledger",
    """SELECT 'landed' AS query_name, event_no % 3 AS batch_id, COUNT(*) AS output_rows FROM base
GROUP BY 2""",
)
def batch_ledger(spark, folder):
    """Three batches, one of them written twice: the ledger counts each once."""
    rows = Telemetry(spark, folder).base.select("event_no", "agent_id", "v")
    out = scratch_path(spark, "ledger")
    write = sinks._writer(f"{out}/rows", f"{out}/ledger", None, "landed")
    for n in (0, 1, 2, 1):
        write(rows.where(F.col("event_no") % 3 == n), n)
    return sinks.read_ledger(spark, f"{out}/ledger").drop("completed_at")


@query(
    "snapshot_replaced",
    "SELECT agent_id, COUNT(*) AS records FROM base GROUP BY 1",
)
def snapshot_replaced(spark, folder):
    """A stored table replaced as a whole by that of all events."""
    rows = Telemetry(spark, folder).base.select("agent_id")
    path = scratch_path(spark, "snapshot")
    counts = rows.groupBy("agent_id").agg(F.count("*").alias("records"))
    versions.publish_table(counts.withColumn("records", -F.col("records")), path)
    versions.publish_table(counts, path)
    return versions.read_table(spark, path)


@query(
    "state_log_appended",
    """SELECT state_revision, status, COUNT(*) AS events FROM transitions GROUP BY 1, 2""",
    RULE_PAIRS,
)
def state_log_appended(spark, folder):
    """A log that holds the first two revisions takes all again: none is there twice."""
    events = spark.read.parquet(_landed(spark, _state_log(_rules(spark, folder)), "state-log"))
    log = events.where("state_revision <= 2")
    whole = log.unionByName(L.append_absent(log, events.unionByName(events)))
    return whole.groupBy("state_revision", "status").agg(F.count("*").alias("events"))


@query(
    "incident_constraints",
    """SELECT 'incidents' AS table_name, rule_name, violations FROM (
  SELECT COUNT(*) FILTER (ended < start_time) AS time_order,
    COUNT(*) FILTER ((state = 'resolved') <> (ended IS NOT NULL)) AS resolved_end,
    COUNT(*) FILTER (state NOT IN ('candidate', 'open', 'ongoing', 'recovering', 'resolved')) AS state
  FROM faulty) UNPIVOT (violations FOR rule_name IN (time_order, resolved_end, state))
UNION ALL SELECT 'incidents', 'one_open', COUNT(*) FROM (
  SELECT 1 FROM faulty WHERE state <> 'resolved' GROUP BY site_id, incident_key HAVING COUNT(*) > 1)""".replace(
        "faulty",
        """(SELECT site_id, incident_key, start_time,
    CASE WHEN incident_type = 'high_latency' THEN start_time - INTERVAL 1 HOUR ELSE end_time END AS ended,
    CASE incident_type WHEN 'wifi_outage' THEN 'open' WHEN 'dns_failure' THEN 'closed' ELSE status END AS state
    FROM incidents) AS faulty""",
    ),
    RULE_PAIRS,
)
def incident_constraints(spark, folder):
    """Constraints of stored incidents, over all of them with faults of three kinds of incident."""
    kind = F.col("incident_type")
    early = F.col("start_time") - F.expr("INTERVAL 1 HOUR")
    state = F.when(kind == "wifi_outage", "open").when(kind == "dns_failure", "closed")
    rows = _incidents(_rules(spark, folder)).select(
        "site_id", "incident_key", "start_time",
        F.when(kind == "high_latency", early).otherwise(F.col("end_time")).alias("end_time"),
        state.otherwise(F.col("status")).alias("status"),
    )
    rows = spark.read.schema(rows.schema).parquet(_landed(spark, rows, "faulty-incidents"))
    clashes = Q.open_incident_clashes(rows).agg(F.count(F.lit(1)).alias("violations"))
    return Q.violations(rows, "incidents", Q.incident_invariants()).unionByName(
        clashes.select(
            F.lit("incidents").alias("table_name"), F.lit("one_open").alias("rule_name"), "violations"
        )
    )


@query(
    "lifecycle_problems",
    """SELECT 'missing state ' || s AS problem FROM (
  SELECT unnest(['candidate', 'open', 'recovering', 'resolved']) AS s)
WHERE s NOT IN (SELECT status FROM transitions WHERE incident_id IN (_last_))
UNION ALL SELECT 'newest incident is not resolved' FROM incidents
WHERE incident_id IN (_last_) AND (status <> 'resolved' OR end_time IS NULL)
UNION ALL SELECT 'unpublished state events' FROM transitions WHERE state_revision > 1
GROUP BY ALL HAVING COUNT(*) > 0""".replace(
        "_last_",
        "SELECT incident_id FROM incidents WHERE incident_type = 'wifi_outage'"
        " ORDER BY start_time DESC, incident_id LIMIT 1",
    ),
    RULE_PAIRS,
)
def lifecycle_problems(spark, folder):
    """The lifecycle report where only first revisions were published."""
    t = _rules(spark, folder)
    transitions = _stored_transitions(t)
    incidents = landed(_incidents(t, transitions), "incidents")
    log = landed(_state_log(t, transitions).drop("payload"), "state-log")
    return Q.lifecycle_invariants(incidents, log, _acks(log), "wifi_outage")


@query(
    "ingest_problems",
    """SELECT 'no events of ' || agent_id AS problem FROM (
  SELECT DISTINCT agent_id FROM agents WHERE agent_id NOT IN (SELECT agent_id FROM base))
UNION ALL SELECT 'repeated event ids'
UNION ALL SELECT 'no rows in late'""",
)
def ingest_problems(spark, folder):
    """The ingest report over a log with replays, an empty typed table and silent agents."""
    t = Telemetry(spark, folder)
    raw = t.raw_log.unionByName(t.raw_log.where("event_no % 100 = 0"))
    return Q.ingest_invariants(raw, {"probes": t.measurements, "late": t.checks.limit(0)}, t.agents)


_STATES = ("invalid", "missing", "legitimately_empty", "stale", "delayed", "healthy")


@query(
    "source_states",
    f"""SELECT day(event_time) AS day_no, list_extract({list(_STATES)}, CAST(day(event_time) % 6 AS INTEGER) + 1)
  AS source_status FROM base GROUP BY 1, 2""",
)
def source_states(spark, folder):
    """Each day's snapshot bent so that the gate meets every state in turn."""
    base = Telemetry(spark, folder).base
    at = F.dayofmonth("event_time").cast("bigint").alias("day_no")
    case = F.col("day_no") % 6
    days = base.groupBy(at).agg(F.count("*").alias("n"), F.max("event_time").alias("newest"))
    zero = F.lit(0).cast("bigint")
    older = F.timestamp_micros(F.unix_micros("newest") - F.lit(3_600_000_000))
    rows = days.select(
        "day_no",
        F.when(case.isin(1, 2), zero).otherwise(F.col("n")).alias("observation_count"),
        F.when(case == 2, zero).otherwise(F.col("n")).alias("relevant_raw_count"),
        F.when(case == 2, zero).otherwise(F.col("n")).alias("heartbeat_count"),
        F.when(case == 0, F.col("n")).otherwise(zero).alias("invalid_count"),
        F.when(case == 3, older).otherwise(F.col("newest")).alias("latest_observation_at"),
        F.col("newest").alias("latest_heartbeat_at"),
        F.when(case == 4, F.lit(1e6)).otherwise(F.lit(1.0)).alias(
            "maximum_ingestion_delay_seconds"
        ),
    )
    return Q.source_status(rows).select("day_no", "source_status")

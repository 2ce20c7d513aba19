"""Decode record payloads and list the rules each one breaks.

A rule is a name and a Boolean column that is true where the row breaks it.
All rules of a set are evaluated in one projection; the broken ones form an
array in rule order.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from linkwatch import schemas as S
from linkwatch.functions.numeric import at_least_zero
from linkwatch.functions.temporal import clock, millis_between

Rule = tuple[str, Column]
JSON_OPTIONS = {
    "mode": "PERMISSIVE",
    "columnNameOfCorruptRecord": S.CORRUPT,
    "allowNonNumericNumbers": "false",
}


def broken(rules: Sequence[Rule]) -> Column:
    """Names of the broken rules, in order."""
    marks = F.array(*[F.when(condition, F.lit(name)) for name, condition in rules])
    return F.filter(marks, lambda name: name.isNotNull())


def computed_once(df: DataFrame, name: str, value: Column) -> DataFrame:
    """Add a column that later filters and projections read instead of repeat.

    A filter is pushed through a projection by copying its expressions, so a
    filter on the rule array would decode the payload once per rule.  Filters
    do not pass a generator; exploding an array of one keeps rows as they are.
    """
    return df.select("*", F.explode(F.array(value)).alias(name))


def parse(records: DataFrame, schema: T.StructType) -> DataFrame:
    """Kafka records with the payload decoded into ``event``, once."""
    rows = records.select(
        F.col("topic").alias("source_topic"),
        F.col("partition").alias("source_partition"),
        F.col("offset").alias("source_offset"),
        F.col("timestamp").alias("kafka_timestamp"),
        F.col("key").cast("string").alias("source_key"),
        F.col("value").alias("original_payload"),
    )
    text = F.col("original_payload").cast("string")
    return computed_once(rows, "event", F.from_json(text, schema, JSON_OPTIONS))


def _field(name: str) -> Column:
    return F.col(f"event.{name}")


def stream_rules(null_semantics: str = "strict") -> list[Rule]:
    """The nineteen measurement rules of the metrics stream.

    ``strict`` treats a missing value as wrong.  ``three_valued`` keeps SQL
    comparison semantics, under which a missing event type, version, role or
    measurement type passes.
    """
    if null_semantics not in ("strict", "three_valued"):
        raise ValueError("null_semantics must be 'strict' or 'three_valued'")
    missing_is_wrong = F.lit(null_semantics == "strict")

    def unless(expected: Column) -> Column:
        return F.coalesce(~expected, missing_is_wrong)

    sequence, loss = _field("sequence_number"), _field("packet_loss_pct")
    return [
        ("malformed_json", F.col("event").isNull()),
        ("malformed_json", _field(S.CORRUPT).isNotNull()),
        ("missing_or_invalid:event_id", _field("event_id").isNull()),
        ("invalid:event_id", ~_field("event_id").rlike(S.STRICT_UUID_PATTERN)),
        ("unsupported:event_type", unless(_field("event_type") == S.MEASUREMENT)),
        ("unsupported:schema_version", unless(_field("schema_version") == 1)),
        ("invalid:agent_role", unless(_field("agent_role").isin(*S.STREAM_ROLES))),
        ("missing:agent_id", _field("agent_id").isNull()),
        ("missing_or_invalid:event_time", _field("event_time").isNull()),
        ("missing_or_invalid:published_time", _field("published_time").isNull()),
        ("invalid:sequence_number", sequence.isNull() | (sequence < 0)),
        ("missing:source_version", _field("source_version").isNull()),
        (
            "invalid:measurement_type",
            unless(_field("measurement_type").isin(*S.MEASUREMENT_TYPES)),
        ),
        ("missing:target_id", _field("target_id").isNull()),
        ("missing_or_invalid:success", _field("success").isNull()),
        ("invalid:packet_loss_pct", loss.isNull() | ~loss.between(0, 100)),
        ("invalid:failed_latency", ~_field("success") & _field("latency_ms").isNotNull()),
        (
            "missing:connected",
            (_field("measurement_type") == "wifi_diagnostics") & _field("connected").isNull(),
        ),
        (
            "invalid:agent_key",
            F.col("source_key").isNotNull() & (F.col("source_key") != _field("agent_id")),
        ),
    ]


def checked_measurements(records: DataFrame, null_semantics: str = "strict") -> DataFrame:
    parsed = parse(records, S.measurement_schema())
    return computed_once(parsed, "validation_errors", broken(stream_rules(null_semantics)))


def accepted(checked: DataFrame, now=None) -> DataFrame:
    """Rows without errors; latency from event to ``now`` is never negative."""
    at = F.current_timestamp() if now is None else clock(now)
    return (
        checked.where(F.size("validation_errors") == 0)
        .select(
            "source_topic",
            "source_partition",
            "source_offset",
            "kafka_timestamp",
            "event.*",
        )
        .drop(S.CORRUPT)
        .withColumn("processing_time", at)
        .withColumn(
            "ingestion_latency_ms", at_least_zero(millis_between("processing_time", "event_time"))
        )
    )


def rejected(checked: DataFrame, now=None) -> DataFrame:
    at = F.current_timestamp() if now is None else clock(now)
    return checked.where(F.size("validation_errors") > 0).select(
        "source_topic",
        "source_partition",
        "source_offset",
        "source_key",
        "original_payload",
        "validation_errors",
        at.alias("failed_at"),
    )


def split(records: DataFrame, now=None, null_semantics: str = "strict"):
    checked = checked_measurements(records, null_semantics)
    return accepted(checked, now), rejected(checked, now)


# --- contract of all five event types ---------------------------------------


def _wrong(condition: Column) -> Column:
    """True where the requirement fails or cannot be evaluated."""
    return ~F.coalesce(condition, F.lit(False))


def _text(name: str, longest: int) -> Rule:
    return f"invalid:{name}", _wrong(F.length(_field(name)).between(1, longest))


def _optional_text(name: str, longest: int) -> Rule:
    return f"invalid:{name}", F.coalesce(F.length(_field(name)) > longest, F.lit(False))


def _number(name: str, low: float | None = 0, high: float | None = None) -> Rule:
    field = _field(name)
    inside = F.lit(True) if low is None else field >= low
    if high is not None:
        inside = inside & (field <= high)
    return f"invalid:{name}", _wrong(field.isNotNull() & inside)


def _optional_number(name: str, low: float = 0, high: float | None = None) -> Rule:
    label, wrong = _number(name, low, high)
    return label, _field(name).isNotNull() & wrong


def _one_of(name: str, values: Sequence[str]) -> Rule:
    return f"invalid:{name}", _wrong(_field(name).isin(*values))


def _matches(name: str, pattern: str) -> Rule:
    return f"invalid:{name}", _wrong(_field(name).rlike(pattern))


def _present(name: str) -> Rule:
    return f"missing:{name}", _field(name).isNull()


def instant(name: str) -> Column:
    return F.expr(f"try_cast(event.{name} AS timestamp)")


def _utc_time(name: str, optional: bool = False) -> list[Rule]:
    field = _field(name)
    readable = instant(name).isNotNull()
    wrong = ~readable
    if optional:
        wrong = field.isNotNull() & wrong
    else:
        wrong = field.isNull() | wrong
    return [
        (f"invalid:{name}", wrong),
        (f"not_utc:{name}", readable & ~field.rlike(S.UTC_SUFFIX_PATTERN)),
    ]


def _envelope_rules() -> list[Rule]:
    correlation = _field("correlation_id")
    return [
        _matches("event_id", S.ANY_UUID_PATTERN),
        ("unsupported:schema_version", _wrong(_field("schema_version") == 1)),
        (
            "invalid:agent_id",
            _wrong(
                F.length(_field("agent_id")).between(1, 128)
                & _field("agent_id").rlike(S.AGENT_ID_PATTERN)
            ),
        ),
        _one_of("agent_role", S.ALL_ROLES),
        *_utc_time("event_time"),
        *_utc_time("published_time"),
        _number("sequence_number"),
        (
            "invalid:correlation_id",
            correlation.isNotNull() & ~correlation.rlike(S.ANY_UUID_PATTERN),
        ),
        _matches("source_version", S.SEMVER_PATTERN),
    ]


def _measurement_rules() -> list[Rule]:
    return [
        _one_of("measurement_type", S.MEASUREMENT_TYPES),
        _text("target_id", 128),
        _present("success"),
        _optional_number("latency_ms"),
        _number("packet_loss_pct", 0, 100),
        _optional_number("jitter_ms"),
        _optional_number("signal_dbm", -120, 0),
        _optional_text("error_class", 128),
        _optional_text("error_message", 1024),
        ("forbidden:latency_ms", ~_field("success") & _field("latency_ms").isNotNull()),
        (
            "missing:connected",
            (_field("measurement_type") == "wifi_diagnostics") & _field("connected").isNull(),
        ),
    ]


def _service_rules() -> list[Rule]:
    durations = (
        "lookup_duration_ms",
        "dns_duration_ms",
        "tcp_duration_ms",
        "tls_duration_ms",
        "ttfb_ms",
        "total_duration_ms",
    )
    return [
        _one_of("check_type", S.CHECK_TYPES),
        _text("endpoint_id", 128),
        _present("success"),
        _optional_text("resolver", 255),
        _optional_text("domain", 255),
        *[_optional_number(d) for d in durations],
        _optional_number("http_status", 100, 599),
        _optional_number("returned_record_count"),
        _optional_text("error_class", 128),
        (
            "missing:domain_or_resolver",
            (_field("check_type") == "dns")
            & (_field("domain").isNull() | _field("resolver").isNull()),
        ),
        (
            "missing:total_duration_ms",
            (_field("check_type") == "http")
            & _field("success")
            & _field("total_duration_ms").isNull(),
        ),
    ]


def _speed_rules() -> list[Rule]:
    return [
        _text("provider", 128),
        _optional_text("server_id", 128),
        _present("success"),
        _optional_number("download_mbps"),
        _optional_number("upload_mbps"),
        _optional_number("latency_ms"),
        _number("duration_ms"),
        _number("bytes_transferred"),
        _optional_text("error_class", 128),
    ]


def _heartbeat_rules() -> list[Rule]:
    return [
        _text("hostname", 255),
        _matches("agent_version", S.SEMVER_PATTERN),
        _optional_text("device_model", 255),
        _text("os_version", 255),
        _number("uptime_seconds"),
        _optional_number("cpu_temperature_c", -40, 150),
        _number("cpu_utilization_pct", 0, 100),
        _number("memory_utilization_pct", 0, 100),
        _number("disk_utilization_pct", 0, 100),
        _present("network_interfaces"),
        _number("local_queue_depth"),
    ]


def _incident_rules() -> list[Rule]:
    start, end = instant("start_time"), instant("end_time")
    resolved = _field("status") == "resolved"
    ended = _field("end_time").isNotNull()
    return [
        _matches("incident_id", S.ANY_UUID_PATTERN),
        _one_of("incident_type", S.INCIDENT_TYPES),
        *_utc_time("start_time"),
        *_utc_time("end_time", optional=True),
        _one_of("status", S.INCIDENT_STATES),
        _one_of("severity", S.SEVERITIES),
        _number("confidence_score", 0, 1),
        _present("affected_endpoints"),
        _matches("rule_version", S.SEMVER_PATTERN),
        _optional_number("peak_latency_ms"),
        _optional_number("maximum_packet_loss_pct", 0, 100),
        _optional_number("duration_ms"),
        _text("summary", 2048),
        _text("recommended_action", 2048),
        ("order:end_time", F.coalesce(end < start, F.lit(False))),
        ("missing:end_time", F.coalesce(resolved & ~ended, F.lit(False))),
        ("forbidden:end_time", F.coalesce(~resolved & ended, F.lit(False))),
        ("missing:affected_agents", _wrong(F.size(_field("affected_agents")) > 0)),
        ("missing:evidence", _wrong(F.size(_field("evidence")) > 0)),
    ]


def contract_errors() -> Column:
    """Broken contract rules; a record that cannot be told apart gets one error."""
    envelope = _envelope_rules()
    sets = {
        S.MEASUREMENT: _measurement_rules(),
        S.SERVICE_CHECK: _service_rules(),
        S.SPEED_TEST: _speed_rules(),
        S.HEARTBEAT: _heartbeat_rules(),
        S.INCIDENT: _incident_rules(),
    }
    unreadable = F.col("event").isNull() | _field(S.CORRUPT).isNotNull()
    result = F.when(unreadable, F.array(F.lit("malformed_json")))
    for event_type, rules in sets.items():
        result = result.when(_field("event_type") == event_type, broken(envelope + rules))
    return result.otherwise(F.array(F.lit("unsupported:event_type")))


def checked_contract(records: DataFrame) -> DataFrame:
    parsed = parse(records, S.contract_schema())
    return computed_once(parsed, "validation_errors", contract_errors())


# --- validator over the decoded mapping --------------------------------------

REQUIRED = (
    "agent_id",
    "agent_role",
    "event_id",
    "event_time",
    "event_type",
    "measurement_type",
    "packet_loss_pct",
    "published_time",
    "schema_version",
    "sequence_number",
    "source_version",
    "success",
    "target_id",
)


def mapping_errors(text: Column) -> Column:
    """Presence first; only a complete mapping has its values checked.

    The payload is read as a variant so the JSON type of each value is known.
    """
    whole = F.try_parse_json(text)

    def part(name: str) -> Column:
        return F.try_variant_get(whole, f"$.{name}", "variant")

    def kind(name: str) -> Column:
        return F.schema_of_variant(part(name))

    def value(name: str, as_type: str) -> Column:
        return F.try_variant_get(whole, f"$.{name}", as_type)

    def number(name: str) -> Column:
        return kind(name).isin("BIGINT", "DOUBLE", "FLOAT") | kind(name).startswith("DECIMAL")

    def off_utc(name: str) -> list[Rule]:
        text_value = value(name, "string")
        readable = F.coalesce(
            (kind(name) == "STRING") & text_value.try_cast("timestamp").isNotNull(), F.lit(False)
        )
        return [
            (f"invalid:{name}", ~readable),
            (f"not_utc:{name}", readable & ~text_value.rlike(S.UTC_SUFFIX_PATTERN)),
        ]

    is_object = F.coalesce(F.schema_of_variant(whole).startswith("OBJECT"), F.lit(False))
    missing = broken([(f"missing:{n}", part(n).isNull()) for n in REQUIRED])
    loss_is_number = F.coalesce(number("packet_loss_pct"), F.lit(False))
    uuid_like = r"(?i)^\{?(?:urn:uuid:)?[0-9a-f]{8}-?(?:[0-9a-f]{4}-?){3}[0-9a-f]{12}\}?$"
    rules = [
        ("unsupported:event_type", _wrong(value("event_type", "string") == S.MEASUREMENT)),
        (
            "unsupported:schema_version",
            _wrong(number("schema_version") & (value("schema_version", "double") == 1)),
        ),
        ("invalid:agent_role", _wrong(value("agent_role", "string").isin(*S.STREAM_ROLES))),
        (
            "invalid:measurement_type",
            _wrong(value("measurement_type", "string").isin(*S.MEASUREMENT_TYPES)),
        ),
        ("invalid:success", _wrong(kind("success") == "BOOLEAN")),
        ("invalid:packet_loss_pct", ~loss_is_number),
        (
            "range:packet_loss_pct",
            loss_is_number & _wrong(value("packet_loss_pct", "double").between(0, 100)),
        ),
        (
            "invalid:sequence_number",
            _wrong((kind("sequence_number") == "BIGINT") & (value("sequence_number", "bigint") >= 0)),
        ),
        ("invalid:event_id", _wrong(value("event_id", "string").rlike(uuid_like))),
        *off_utc("event_time"),
        *off_utc("published_time"),
    ]
    return (
        F.when(~is_object, F.array(F.lit("malformed_json")))
        .when(F.size(missing) > 0, missing)
        .otherwise(broken(rules))
    )

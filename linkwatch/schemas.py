"""Record layouts, fixed vocabularies and thresholds."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import types as T

# ---------------------------------------------------------------------------
# Event vocabulary, topics and limits of the version 1 contract.
# ---------------------------------------------------------------------------
MEASUREMENT = "network.measurement"
SERVICE_CHECK = "network.service_check"
SPEED_TEST = "network.speed_test"
HEARTBEAT = "network.agent_heartbeat"
INCIDENT = "network.incident"

TOPICS = {
    MEASUREMENT: "network.measurements.raw.v1",
    SERVICE_CHECK: "network.service-checks.raw.v1",
    SPEED_TEST: "network.speed-tests.raw.v1",
    HEARTBEAT: "network.agent-heartbeats.v1",
    INCIDENT: "network.incidents.v1",
}
RAW_TOPICS = tuple(TOPICS[t] for t in (MEASUREMENT, SERVICE_CHECK, SPEED_TEST, HEARTBEAT))
VALID_TOPIC = "network.measurements.valid.v1"
DEAD_LETTER_TOPIC = "network.dead-letter.v1"

WIRED = "wired_reference"
WIFI = "wifi_observer"
STREAM_ROLES = (WIRED, WIFI)
ALL_ROLES = (WIRED, WIFI, "container_probe", "system_classifier")
MEASUREMENT_TYPES = ("router_ping", "external_ping", "wifi_diagnostics")
CHECK_TYPES = ("dns", "http")
INCIDENT_TYPES = (
    "wifi_degradation",
    "wifi_outage",
    "router_unavailable",
    "isp_outage",
    "dns_failure",
    "external_service_failure",
    "high_latency",
    "high_packet_loss",
    "agent_offline",
    "unknown_network_incident",
)
INCIDENT_STATES = ("candidate", "open", "ongoing", "recovering", "resolved")
SEVERITIES = ("info", "warning", "critical")
SOURCE_KINDS = ("network_measurement", "service_check")
SOURCE_STATES = ("healthy", "delayed", "legitimately_empty", "missing", "stale", "invalid")
REFRESHABLE = ("healthy", "delayed", "legitimately_empty")

AGENT_ID_PATTERN = r"^[a-z0-9][a-z0-9._-]+$"
SEMVER_PATTERN = r"^(0|[1-9]\d*)\.(0|[1-9]\d*)\.(0|[1-9]\d*)(?:-[0-9A-Za-z.-]+)?$"
STRICT_UUID_PATTERN = (
    r"^[0-9a-fA-F]{8}-[0-9a-fA-F]{4}-[1-5][0-9a-fA-F]{3}-[89abAB][0-9a-fA-F]{3}-[0-9a-fA-F]{12}$"
)
ANY_UUID_PATTERN = r"^[0-9a-fA-F]{8}-(?:[0-9a-fA-F]{4}-){3}[0-9a-fA-F]{12}$"
UTC_SUFFIX_PATTERN = r"(?:Z|[+-]00:?00)$"

WINDOW_SIZES = {"1 minute": 60, "5 minutes": 300, "15 minutes": 900, "1 day": 86_400}
WATERMARK = "15 minutes"
RULE_VERSION = "1.0.0"
# ---------------------------------------------------------------------------


def _fields(*pairs: tuple[str, T.DataType]) -> list[T.StructField]:
    return [T.StructField(name, kind) for name, kind in pairs]


_S, _D, _B, _I, _L = (
    T.StringType(),
    T.DoubleType(),
    T.BooleanType(),
    T.IntegerType(),
    T.LongType(),
)
_TEXTS = T.ArrayType(T.StringType())
CORRUPT = "_corrupt_record"


def _envelope(times: T.DataType) -> list[T.StructField]:
    return _fields(
        ("event_id", _S),
        ("event_type", _S),
        ("schema_version", _I),
        ("agent_id", _S),
        ("agent_role", _S),
        ("event_time", times),
        ("published_time", times),
        ("sequence_number", _L),
        ("correlation_id", _S),
        ("source_version", _S),
    )


# Fixed values from here to the thresholds: the field names of the records.
MEASUREMENT_FIELDS = _fields(
    ("measurement_type", _S),
    ("target_id", _S),
    ("success", _B),
    ("latency_ms", _D),
    ("packet_loss_pct", _D),
    ("jitter_ms", _D),
    ("signal_dbm", _D),
    ("connected", _B),
    ("error_class", _S),
    ("error_message", _S),
)
SERVICE_FIELDS = _fields(
    ("check_type", _S),
    ("endpoint_id", _S),
    ("success", _B),
    ("resolver", _S),
    ("domain", _S),
    ("lookup_duration_ms", _D),
    ("dns_duration_ms", _D),
    ("tcp_duration_ms", _D),
    ("tls_duration_ms", _D),
    ("ttfb_ms", _D),
    ("total_duration_ms", _D),
    ("http_status", _I),
    ("returned_record_count", _I),
    ("timeout", _B),
    ("error_class", _S),
)
SPEED_FIELDS = _fields(
    ("provider", _S),
    ("server_id", _S),
    ("success", _B),
    ("download_mbps", _D),
    ("upload_mbps", _D),
    ("latency_ms", _D),
    ("duration_ms", _D),
    ("bytes_transferred", _L),
    ("error_class", _S),
)
HEARTBEAT_FIELDS = _fields(
    ("hostname", _S),
    ("agent_version", _S),
    ("device_model", _S),
    ("os_version", _S),
    ("uptime_seconds", _D),
    ("cpu_temperature_c", _D),
    ("cpu_utilization_pct", _D),
    ("memory_utilization_pct", _D),
    ("disk_utilization_pct", _D),
    ("network_interfaces", _TEXTS),
    ("collection_errors", _TEXTS),
    ("local_queue_depth", _I),
)
INCIDENT_FIELDS = _fields(
    ("incident_id", _S),
    ("incident_type", _S),
    ("start_time", _S),
    ("end_time", _S),
    ("status", _S),
    ("severity", _S),
    ("confidence_score", _D),
    ("affected_agents", _TEXTS),
    ("affected_endpoints", _TEXTS),
    ("evidence", T.ArrayType(T.MapType(_S, _S))),
    ("rule_version", _S),
    ("peak_latency_ms", _D),
    ("maximum_packet_loss_pct", _D),
    ("duration_ms", _D),
    ("summary", _S),
    ("recommended_action", _S),
)

TYPED_FIELDS = {
    MEASUREMENT: MEASUREMENT_FIELDS,
    SERVICE_CHECK: SERVICE_FIELDS,
    SPEED_TEST: SPEED_FIELDS,
    HEARTBEAT: HEARTBEAT_FIELDS,
    INCIDENT: INCIDENT_FIELDS,
}


def measurement_schema() -> T.StructType:
    """What the metrics stream reads out of a measurement payload."""
    return T.StructType(
        _envelope(T.TimestampType()) + MEASUREMENT_FIELDS + _fields((CORRUPT, _S))
    )


def contract_schema() -> T.StructType:
    """Union of the five payloads; times stay text so their offset can be checked."""
    seen: dict[str, T.StructField] = {}
    for field in _envelope(_S):
        seen[field.name] = field
    for fields in TYPED_FIELDS.values():
        for field in fields:
            seen.setdefault(field.name, field)
    return T.StructType([*seen.values(), *_fields((CORRUPT, _S))])


KAFKA_SCHEMA = T.StructType(
    [
        T.StructField("key", T.BinaryType()),
        T.StructField("value", T.BinaryType()),
        T.StructField("topic", _S, False),
        T.StructField("partition", _I, False),
        T.StructField("offset", _L, False),
        T.StructField("timestamp", T.TimestampType(), False),
    ]
)


@dataclass(frozen=True)
class Thresholds:
    """Classifier settings; the defaults are the documented ones."""

    lookback_seconds: float = 60
    interval_seconds: float = 10
    minimum_samples: int = 2
    open_observations: int = 2
    resolve_observations: int = 2
    healthy_success_pct: float = 80.0
    failed_success_pct: float = 20.0
    high_latency_ms: float = 150.0
    high_packet_loss_pct: float = 20.0
    weak_signal_dbm: float = -78.0
    heartbeat_stale_seconds: float = 150

    def __post_init__(self) -> None:
        counts = (
            self.lookback_seconds,
            self.minimum_samples,
            self.open_observations,
            self.resolve_observations,
            self.heartbeat_stale_seconds,
        )
        if min(counts) < 1:
            raise ValueError("counts and time windows must be positive")
        if self.interval_seconds <= 0:
            raise ValueError("the evaluation interval must be positive")
        if not 0 <= self.failed_success_pct < self.healthy_success_pct <= 100:
            raise ValueError("success thresholds must be ordered within 0..100")
        if self.high_latency_ms <= 0 or not 0 <= self.high_packet_loss_pct <= 100:
            raise ValueError("anomaly thresholds are out of range")
        if not -120 <= self.weak_signal_dbm <= 0:
            raise ValueError("weak signal threshold must lie in -120..0 dBm")

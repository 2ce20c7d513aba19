"""Cross-agent incident rules, evaluated for every site and tick at once."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from linkwatch import schemas as S
from linkwatch.functions.temporal import iso_text, seconds_between, timestamp_of


@dataclass(frozen=True)
class IncidentText:
    severity: str
    confidence: float
    summary: str
    action: str


# Severity, confidence and wording of each incident type.
TEXTS = {
    "router_unavailable": IncidentText(
        "critical",
        0.94,
        "Both agents repeatedly failed to reach the configured router.",
        "Check router power, local cabling, and LAN interface status.",
    ),
    "wifi_outage": IncidentText(
        "critical",
        0.96,
        "The wired baseline is healthy while the Wi-Fi agent cannot reach the router and "
        "reports no association.",
        "Check the access point, Wi-Fi credentials, channel, and agent location.",
    ),
    "isp_outage": IncidentText(
        "critical",
        0.92,
        "Both agents can reach the router but repeatedly fail external IP checks.",
        "Check modem or WAN status, then contact the ISP if the condition persists.",
    ),
    "wifi_degradation": IncidentText(
        "warning",
        0.88,
        "The wired baseline is healthy while Wi-Fi latency, loss, or signal quality is degraded.",
        "Move the Wi-Fi agent or access point, then inspect interference and channel "
        "utilization.",
    ),
    "dns_failure": IncidentText(
        "critical",
        0.9,
        "IP reachability is healthy while DNS checks repeatedly fail across both agents.",
        "Test an alternate configured resolver and inspect router DNS settings.",
    ),
    "external_service_failure": IncidentText(
        "warning",
        0.84,
        "Network and DNS checks are healthy while a configured external service repeatedly "
        "fails.",
        "Check the service status and test the endpoint from another network.",
    ),
    "high_packet_loss": IncidentText(
        "warning",
        0.82,
        "Repeated high packet loss is present across wired and Wi-Fi agents.",
        "Inspect router load and WAN quality; compare local and external targets.",
    ),
    "high_latency": IncidentText(
        "warning",
        0.8,
        "Repeated high latency is present across wired and Wi-Fi agents.",
        "Check local congestion and compare router latency with external latency.",
    ),
    "unknown_network_incident": IncidentText(
        "warning",
        0.5,
        "Repeated impairment is present, but the available cross-agent evidence does not "
        "support a more specific classification.",
        "Inspect the affected target and compare both agents before escalating.",
    ),
    "agent_offline": IncidentText(
        "warning",
        0.86,
        "stopped reporting while another agent remained current.",
        "Check agent power, network association, and service logs.",
    ),
}

EVIDENCE = (
    "agent_id",
    "agent_role",
    "endpoint_id",
    "probe_type",
    "sample_count",
    "success_rate_pct",
    "peak_latency_ms",
    "mean_packet_loss_pct",
    "weakest_signal_dbm",
    "connected_rate_pct",
)
FINDING_COLUMNS = (
    "site_id",
    "tick_us",
    "incident_key",
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

_TICK = ("site_id", "tick_us")


def _text(kind: Column, field: str) -> Column:
    result = F.when(F.lit(False), F.lit(None))
    for name, text in TEXTS.items():
        result = result.when(kind == name, F.lit(getattr(text, field)))
    return result


class _Row:
    """Conditions on one summary row."""

    def __init__(self, cfg: S.Thresholds) -> None:
        rate, peak = F.col("success_rate_pct"), F.col("peak_latency_ms")
        loss = F.col("mean_packet_loss_pct")
        self.type = F.col("probe_type")
        self.role = F.col("agent_role")
        self.wired, self.wifi = self.role == S.WIRED, self.role == S.WIFI
        self.router = self.type == "router_ping"
        self.external = self.type == "external_ping"
        self.diagnostic = self.type == "wifi_diagnostics"
        self.ping = self.type.isin(*S.MEASUREMENT_TYPES) & ~self.diagnostic
        self.probe = self.type.isin(*S.MEASUREMENT_TYPES)
        self.dns, self.http = self.type == "dns", self.type == "http"
        self.healthy = rate >= cfg.healthy_success_pct
        self.failed = rate <= cfg.failed_success_pct
        self.lossy = self.ping & F.coalesce(loss >= cfg.high_packet_loss_pct, F.lit(False))
        self.slow = self.probe & F.coalesce(peak >= cfg.high_latency_ms, F.lit(False))
        self.strained = F.coalesce(peak >= cfg.high_latency_ms * 0.5, F.lit(False)) | F.coalesce(
            loss >= cfg.high_packet_loss_pct * 0.75, F.lit(False)
        )
        self.weak = F.coalesce(F.col("weakest_signal_dbm") <= cfg.weak_signal_dbm, F.lit(False))
        self.unlinked = F.coalesce(
            F.col("connected_rate_pct") <= cfg.failed_success_pct, F.lit(False)
        )
        self.impaired = self.ping & (self.failed | self.lossy | self.slow)


def classify_summaries(rows: DataFrame, cfg: S.Thresholds) -> DataFrame:
    """At most one network finding per (site, tick).

    All conditions are aggregates over the summaries of one site and tick.
    They are window aggregates over the partitioning the summaries already
    have, so deciding the class and gathering its evidence share one shuffle.
    """
    r = _Row(cfg)
    group = Window.partitionBy(*_TICK)

    def every(where: Column, holds: Column) -> Column:
        return F.coalesce(F.bool_and(F.when(where, holds)).over(group), F.lit(False))

    def some(condition: Column) -> Column:
        return F.coalesce(F.bool_or(condition).over(group), F.lit(False))

    def only(condition: Column, value: str) -> Column:
        picked = F.when(condition, F.col(value))
        return F.coalesce(F.min(picked).over(group) == F.max(picked).over(group), F.lit(False))

    flags = {
        "wired_router_ok": every(r.wired & r.router, r.healthy),
        "wired_router_dead": every(r.wired & r.router, r.failed),
        "wifi_router_ok": every(r.wifi & r.router, r.healthy),
        "wifi_router_dead": every(r.wifi & r.router, r.failed),
        "wifi_router_seen": some(r.wifi & r.router),
        "wired_external_ok": every(r.wired & r.external, r.healthy),
        "wired_external_dead": every(r.wired & r.external, r.failed),
        "wifi_external_ok": every(r.wifi & r.external, r.healthy),
        "wifi_external_dead": every(r.wifi & r.external, r.failed),
        "wifi_unlinked": every(r.wifi & r.diagnostic, r.unlinked),
        "wifi_strained": some(r.wifi & r.ping & r.strained),
        "wifi_weak": some(r.wifi & r.diagnostic & r.weak),
        "dns_dead_wired": some(r.wired & r.dns & r.failed),
        "dns_dead_wifi": some(r.wifi & r.dns & r.failed),
        "dns_ok": every(r.dns, r.healthy),
        "http_dead": some(r.http & r.failed),
        "http_ok": some(r.http & r.healthy),
        "http_single": only(r.http, "endpoint_id"),
        "lossy_wired": some(r.wired & r.lossy),
        "lossy_wifi": some(r.wifi & r.lossy),
        "slow_wired": some(r.wired & r.slow),
        "slow_wifi": some(r.wifi & r.slow),
        "any_impaired": some(r.impaired),
    }
    gated = rows.where(F.col("sample_count") >= cfg.minimum_samples)
    marked = gated.select("*", *[e.alias(f"_{n}") for n, e in flags.items()])
    decided = marked.withColumn("incident_type", _decide()).where(
        F.col("incident_type").isNotNull()
    )
    kept = decided.where(_is_evidence(F.col("incident_type"), r))
    return _network_findings(kept)


def _decide() -> Column:
    f = _Flags()
    wired_ok = f.wired_router_ok & f.wired_external_ok
    routers_ok = f.wired_router_ok & f.wifi_router_ok
    externals_ok = f.wired_external_ok & f.wifi_external_ok
    dns_dead = f.dns_dead_wired & f.dns_dead_wifi
    late = (
        F.when(f.lossy_wired & f.lossy_wifi, F.lit("high_packet_loss"))
        .when(f.slow_wired & f.slow_wifi, F.lit("high_latency"))
        .when(f.any_impaired, F.lit("unknown_network_incident"))
    )
    services = (
        F.when(dns_dead, F.lit("dns_failure"))
        .when(f.dns_ok & f.http_dead & (f.http_ok | f.http_single),
              F.lit("external_service_failure"))
        .otherwise(late)
    )
    return (
        F.when(f.wired_router_dead & f.wifi_router_dead, F.lit("router_unavailable"))
        .when(wired_ok & f.wifi_router_dead & f.wifi_unlinked, F.lit("wifi_outage"))
        .when(
            routers_ok & f.wired_external_dead & f.wifi_external_dead, F.lit("isp_outage")
        )
        .when(
            wired_ok & f.wifi_router_seen & f.wifi_strained & f.wifi_weak,
            F.lit("wifi_degradation"),
        )
        .when(routers_ok & externals_ok, services)
        .otherwise(late)
    )


class _Flags:
    def __getattr__(self, name: str) -> Column:
        return F.col(f"_{name}")


def _is_evidence(kind: Column, r: _Row) -> Column:
    """Rows a finding of this type is based on."""
    wanted = {
        "router_unavailable": r.router,
        "wifi_outage": r.wifi & (r.router | r.diagnostic),
        "isp_outage": r.router | r.external,
        "wifi_degradation": r.wifi & r.probe,
        "dns_failure": r.dns,
        "external_service_failure": r.http & r.failed,
        "high_packet_loss": r.lossy,
        "high_latency": r.slow,
        "unknown_network_incident": r.impaired,
    }
    # pings of a role that is neither vantage point take no part in R1 to R4
    vantage = r.wired | r.wifi
    result = F.lit(False)
    for name, rows in wanted.items():
        if name in ("router_unavailable", "isp_outage"):
            rows = rows & vantage
        result = result | ((kind == name) & rows)
    return result


def _network_findings(kept: DataFrame) -> DataFrame:
    kind = F.col("incident_type")
    service = kind.isin("dns_failure", "external_service_failure")
    item = F.struct(
        *[F.col(c) for c in EVIDENCE],
        F.lit(None).cast("string").alias("last_heartbeat"),
        F.lit(None).cast("double").alias("age_seconds"),
        F.lit(None).cast("array<string>").alias("other_recent_agents"),
    )
    found = kept.groupBy(*_TICK, "incident_type").agg(
        F.sort_array(F.collect_set("agent_id")).alias("affected_agents"),
        F.sort_array(F.collect_set("endpoint_id")).alias("affected_endpoints"),
        F.sort_array(F.collect_list(item)).alias("evidence"),
        F.max("peak_latency_ms").alias("peak_latency_ms"),
        F.max("mean_packet_loss_pct").alias("maximum_packet_loss_pct"),
    )
    key = F.when(
        service, F.concat(kind, F.lit(":"), F.array_join("affected_endpoints", ","))
    ).otherwise(kind)
    return found.select(
        *_TICK,
        key.alias("incident_key"),
        "incident_type",
        _text(kind, "severity").alias("severity"),
        _text(kind, "confidence").cast("double").alias("confidence_score"),
        "affected_agents",
        "affected_endpoints",
        "evidence",
        F.when(~service, F.col("peak_latency_ms")).alias("peak_latency_ms"),
        F.when(~service, F.col("maximum_packet_loss_pct")).alias("maximum_packet_loss_pct"),
        _text(kind, "summary").alias("summary"),
        _text(kind, "action").alias("recommended_action"),
    )


def offline_findings(latest: DataFrame, cfg: S.Thresholds) -> DataFrame:
    """Stale agents at ticks where another agent of the site is recent."""
    group = Window.partitionBy(*_TICK)
    age = seconds_between(timestamp_of("tick_us"), "last_event_time")
    recent = F.coalesce(age <= cfg.heartbeat_stale_seconds, F.lit(False))
    mixed = (
        latest.withColumns({"age_seconds": age, "recent": recent})
        .withColumns(
            {
                "_some": F.bool_or("recent").over(group),
                "_all": F.bool_and("recent").over(group),
            }
        )
        .where(F.col("_some") & ~F.col("_all"))
    )
    stale = F.struct("agent_id", "agent_role", "last_event_time", "age_seconds")
    split = mixed.groupBy(*_TICK).agg(
        F.sort_array(F.collect_set(F.when(F.col("recent"), F.col("agent_id")))).alias("others"),
        F.collect_list(F.when(~F.col("recent"), stale)).alias("stale"),
    )
    rows = split.select(*_TICK, "others", F.explode("stale").alias("s")).select(
        *_TICK, "others", "s.*"
    )
    none = F.lit(None)
    item = F.struct(
        "agent_id",
        "agent_role",
        none.cast("string").alias("endpoint_id"),
        none.cast("string").alias("probe_type"),
        none.cast("bigint").alias("sample_count"),
        *[none.cast("double").alias(c) for c in EVIDENCE[5:]],
        iso_text("last_event_time").alias("last_heartbeat"),
        "age_seconds",
        F.col("others").alias("other_recent_agents"),
    )
    text = TEXTS["agent_offline"]
    return rows.select(
        *_TICK,
        F.concat(F.lit("agent_offline:"), F.col("agent_id")).alias("incident_key"),
        F.lit("agent_offline").alias("incident_type"),
        F.lit(text.severity).alias("severity"),
        F.lit(text.confidence).alias("confidence_score"),
        F.array("agent_id").alias("affected_agents"),
        F.array().cast("array<string>").alias("affected_endpoints"),
        F.array(item).alias("evidence"),
        none.cast("double").alias("peak_latency_ms"),
        none.cast("double").alias("maximum_packet_loss_pct"),
        F.concat(F.lit("Agent "), F.col("agent_id"), F.lit(" " + text.summary)).alias("summary"),
        F.lit(text.action).alias("recommended_action"),
    )


def classify(summaries: DataFrame, latest: DataFrame | None, cfg: S.Thresholds) -> DataFrame:
    """All findings: the network cascade and, beside it, silent agents."""
    network = classify_summaries(summaries, cfg)
    if latest is None:
        return network
    return network.unionByName(offline_findings(latest, cfg))

"""Privacy-reduced extracts."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from linkwatch.functions.ids import PSEUDONYM_NAMESPACE, pseudonym
from linkwatch.functions.numeric import exact_sum, ratio
from linkwatch.functions.temporal import utc_text
from linkwatch.operators.quality import require_none

# The four extracts and their headers.
DATASETS = {
    "daily_reliability": (
        "date_utc", "agent_key", "agent_role", "source_kind", "measurement_type",
        "total_probes", "successful_probes", "failed_probes", "success_rate_pct",
        "average_latency_ms", "average_packet_loss_pct",
    ),
    "incidents": (
        "incident_id", "incident_type", "start_time_utc", "end_time_utc", "duration_ms",
        "status", "severity", "confidence_score", "rule_version", "state_revision",
        "affected_agent_count", "affected_endpoint_count",
    ),
    "agent_performance": (
        "agent_key", "agent_role", "source_kind", "measurement_type",
        "first_observation_date", "latest_observation_date", "observation_day_count",
        "total_probes", "successful_probes", "failed_probes", "success_rate_pct",
        "average_latency_ms", "average_packet_loss_pct",
    ),
    "pipeline_health": (
        "observed_at_utc", "last_raw_event_received_at_utc", "raw_event_age_seconds",
        "pending_dead_letter_count", "stream_processing_failure_count",
        "last_stream_batch_completed_at_utc", "active_incident_count",
        "pending_incident_publication_count",
    ),
}
MINIMUM_ROWS = {"daily_reliability": 1, "agent_performance": 1}
EXACT_ROWS = {"pipeline_health": 1}


def with_roles(view: DataFrame, status: DataFrame) -> DataFrame:
    """Daily rows with the agent's current role, NULL for unknown agents."""
    return view.join(status.select("agent_id", "agent_role"), "agent_id", "left")


def _totals() -> list[Column]:
    return [
        F.sum("total_count").alias("total_probes"),
        F.sum("success_count").alias("successful_probes"),
        F.sum("failure_count").alias("failed_probes"),
        F.coalesce(exact_sum("latency_sum_ms"), F.lit(0.0)).alias("_latency"),
        F.sum("latency_count").alias("_latencies"),
        F.coalesce(exact_sum("packet_loss_sum_pct"), F.lit(0.0)).alias("_loss"),
        F.sum("packet_loss_count").alias("_losses"),
    ]


def _means(df: DataFrame) -> DataFrame:
    return df.withColumns(
        {
            "success_rate_pct": ratio("successful_probes", "total_probes", 100.0),
            "average_latency_ms": ratio("_latency", "_latencies"),
            "average_packet_loss_pct": ratio("_loss", "_losses"),
        }
    )


def _typed(daily: DataFrame) -> DataFrame:
    return daily.withColumn("measurement_type", F.col("probe_type"))


def _keyed(rows: DataFrame, namespace: str) -> DataFrame:
    """Short keys may clash, so agents are told apart by id until the end."""
    return rows.withColumn("agent_key", pseudonym("agent_id", namespace))


def _ordered(df: DataFrame, dataset: str, *order) -> DataFrame:
    return df.orderBy(*order).select(*DATASETS[dataset])


def _role_order() -> Column:
    return F.coalesce("agent_role", F.lit(""))


def export_daily(daily: DataFrame, namespace: str = PSEUDONYM_NAMESPACE) -> DataFrame:
    """Weighted daily roll-up over endpoints; rates and means of pooled counts."""
    keys = ("date_utc", "agent_id", "agent_role", "source_kind", "measurement_type")
    rows = _keyed(_means(_typed(daily).groupBy(*keys).agg(*_totals())), namespace)
    return _ordered(
        rows, "daily_reliability", "date_utc", "agent_key", _role_order(), *keys[3:]
    )


def export_agents(daily: DataFrame, namespace: str = PSEUDONYM_NAMESPACE) -> DataFrame:
    """Whole-period roll-up.  Days are folded first, so counting the distinct
    ones is counting rows."""
    keys = ("agent_id", "agent_role", "source_kind", "measurement_type")
    by_day = _typed(daily).groupBy(*keys, "date_utc").agg(
        *[
            F.sum(c).alias(c)
            for c in ("total_count", "success_count", "failure_count", "latency_count",
                      "packet_loss_count")
        ],
        exact_sum("latency_sum_ms").alias("latency_sum_ms"),
        exact_sum("packet_loss_sum_pct").alias("packet_loss_sum_pct"),
    )
    rows = by_day.groupBy(*keys).agg(
        F.min("date_utc").alias("first_observation_date"),
        F.max("date_utc").alias("latest_observation_date"),
        F.count(F.lit(1)).alias("observation_day_count"),
        *_totals(),
    )
    rows = _keyed(_means(rows), namespace)
    return _ordered(rows, "agent_performance", "agent_key", _role_order(), *keys[2:])


def incident_conflicts(summary: DataFrame) -> DataFrame:
    """Incident ids that appear with different contents."""
    return (
        summary.distinct()
        .groupBy("incident_id")
        .agg(F.count(F.lit(1)).alias("versions"))
        .where("versions > 1")
    )


def export_incidents(summary: DataFrame, check: bool = True) -> DataFrame:
    """Equal duplicates collapse; differing ones are an error."""
    if check:
        require_none(incident_conflicts(summary), "conflicting duplicate incident")
    rows = summary.distinct().withColumns(
        {"start_time_utc": utc_text("start_time"), "end_time_utc": utc_text("end_time")}
    )
    return _ordered(rows, "incidents", "start_time", "incident_id")


def export_pipeline(status: DataFrame) -> DataFrame:
    return status.select(
        utc_text("observed_at").alias("observed_at_utc"),
        utc_text("last_raw_event_received_at").alias("last_raw_event_received_at_utc"),
        "raw_event_age_seconds",
        "pending_dead_letter_count",
        "stream_processing_failure_count",
        utc_text("last_stream_batch_completed_at").alias("last_stream_batch_completed_at_utc"),
        "active_incident_count",
        "pending_incident_publication_count",
    )


def export_bundle(daily: DataFrame, summary: DataFrame, status: DataFrame) -> dict[str, DataFrame]:
    return {
        "daily_reliability": export_daily(daily),
        "incidents": export_incidents(summary),
        "agent_performance": export_agents(daily),
        "pipeline_health": export_pipeline(status),
    }

"""What the classifier sees at each evaluation tick."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from linkwatch import schemas as S
from linkwatch.functions.numeric import FIXED_POINT, count_true, fixed, ratio
from linkwatch.functions.temporal import Cadence, TickSpan, explode_ticks, timestamp_of

DEFAULT_SITE = ""


def with_site(df: DataFrame) -> DataFrame:
    """Tables of one site need not name it."""
    return df if "site_id" in df.columns else df.withColumn("site_id", F.lit(DEFAULT_SITE))


def observations(measurements: DataFrame, checks: DataFrame) -> DataFrame:
    """Both probe tables under one layout, so they are summarised in one pass."""
    none = F.lit(None)
    probes = with_site(measurements).select(
        "site_id",
        "agent_id",
        "event_time",
        F.col("target_id").alias("endpoint_id"),
        F.col("measurement_type").alias("probe_type"),
        "success",
        "latency_ms",
        "packet_loss_pct",
        "signal_dbm",
        "connected",
    )
    services = with_site(checks).select(
        "site_id",
        "agent_id",
        "event_time",
        "endpoint_id",
        F.col("check_type").alias("probe_type"),
        "success",
        none.cast("double").alias("latency_ms"),
        none.cast("double").alias("packet_loss_pct"),
        none.cast("double").alias("signal_dbm"),
        none.cast("boolean").alias("connected"),
    )
    return probes.unionByName(services)


def summaries(rows: DataFrame, agents: DataFrame, cadence: Cadence) -> DataFrame:
    """One row per (site, tick, agent, endpoint, probe type) over the lookback.

    Observations are first folded into panes; only those small partial results
    are joined to the registry and copied to the ticks whose lookback covers
    them.  The registry's role replaces whatever the event claimed.
    """
    keys = ("site_id", "agent_id", "endpoint_id", "probe_type")
    panes = rows.groupBy(*keys, cadence.pane("event_time").alias("pane_us")).agg(
        F.count(F.lit(1)).alias("n"),
        count_true(F.col("success")).alias("n_ok"),
        F.max("latency_ms").alias("peak"),
        F.sum(fixed("packet_loss_pct")).alias("loss"),
        F.count("packet_loss_pct").alias("n_loss"),
        F.min("signal_dbm").alias("signal"),
        count_true(F.col("connected")).alias("n_linked"),
        F.count("connected").alias("n_link"),
    )
    roles = agents.select("agent_id", "agent_role")
    ticks = panes.join(roles, "agent_id").withColumn(
        "tick_us", F.explode(cadence.ticks_of("pane_us"))
    )
    # rules look at one site and tick at a time: partition for them here, and
    # the aggregates and windows that follow need no further shuffle
    placed = ticks.repartition("site_id", "tick_us")
    return (
        placed.groupBy("site_id", "tick_us", "agent_id", "agent_role", "endpoint_id", "probe_type")
        .agg(
            F.sum("n").alias("sample_count"),
            F.sum("n_ok").alias("n_ok"),
            F.max("peak").alias("peak_latency_ms"),
            F.sum(F.col("loss").cast(FIXED_POINT)).cast("double").alias("loss"),
            F.sum("n_loss").alias("n_loss"),
            F.min("signal").alias("weakest_signal_dbm"),
            F.sum("n_linked").alias("n_linked"),
            F.sum("n_link").alias("n_link"),
        )
        .select(
            "site_id",
            "tick_us",
            "agent_id",
            "agent_role",
            "endpoint_id",
            "probe_type",
            "sample_count",
            ratio("n_ok", "sample_count", 100.0).alias("success_rate_pct"),
            "peak_latency_ms",
            ratio("loss", "n_loss").alias("mean_packet_loss_pct"),
            "weakest_signal_dbm",
            ratio("n_linked", "n_link", 100.0).alias("connected_rate_pct"),
        )
    )


def measurement_summary(measurements, agents, cadence: Cadence) -> DataFrame:
    checks = _no_checks(measurements)
    rows = summaries(observations(measurements, checks), agents, cadence)
    return rows.select(
        "site_id",
        timestamp_of("tick_us").alias("observed_at"),
        "agent_id",
        "agent_role",
        F.col("endpoint_id").alias("target_id"),
        F.col("probe_type").alias("measurement_type"),
        "sample_count",
        "success_rate_pct",
        "peak_latency_ms",
        "mean_packet_loss_pct",
        "weakest_signal_dbm",
        "connected_rate_pct",
    )


def _no_checks(measurements: DataFrame) -> DataFrame:
    return measurements.where(F.lit(False)).select(
        *[c for c in measurements.columns if c in ("site_id",)],
        "agent_id",
        "event_time",
        F.col("target_id").alias("endpoint_id"),
        F.col("measurement_type").alias("check_type"),
        "success",
    )


def service_summary(checks: DataFrame, agents: DataFrame, cadence: Cadence) -> DataFrame:
    none = F.lit(None)
    rows = with_site(checks).select(
        "site_id",
        "agent_id",
        "event_time",
        "endpoint_id",
        F.col("check_type").alias("probe_type"),
        "success",
        none.cast("double").alias("latency_ms"),
        none.cast("double").alias("packet_loss_pct"),
        none.cast("double").alias("signal_dbm"),
        none.cast("boolean").alias("connected"),
    )
    return summaries(rows, agents, cadence).select(
        "site_id",
        timestamp_of("tick_us").alias("observed_at"),
        "agent_id",
        "agent_role",
        "endpoint_id",
        F.col("probe_type").alias("check_type"),
        "sample_count",
        "success_rate_pct",
    )


def heartbeat_segments(
    heartbeats: DataFrame, agents: DataFrame, span: TickSpan, cadence: Cadence
) -> DataFrame:
    """Runs of ticks over which an enabled agent's last heartbeat stays the same.

    An agent that has not reported yet starts with a run whose heartbeat is
    NULL.  Heartbeats after a tick never count for it.
    """
    enabled = with_site(agents.where("enabled")).select("site_id", "agent_id", "agent_role")
    tick = F.greatest(cadence.tick_at_or_after("event_time"), span.first)
    seen = (
        heartbeats.groupBy("agent_id", tick.alias("from_us"))
        .agg(F.max("event_time").alias("last_event_time"))
        .where(F.col("from_us") <= span.last)
    )
    reported = enabled.join(seen, "agent_id")
    silent = enabled.select(
        "*", span.first.alias("from_us"), F.lit(None).cast("timestamp").alias("last_event_time")
    )
    starts = (
        reported.unionByName(silent)
        .groupBy("site_id", "agent_id", "agent_role", "from_us")
        .agg(F.max("last_event_time").alias("last_event_time"))
    )
    following = F.lead("from_us").over(Window.partitionBy("agent_id").orderBy("from_us"))
    return starts.withColumn(
        "to_us", F.coalesce(following - F.lit(cadence.step_us), span.last)
    )


def heartbeat_latest(
    heartbeats: DataFrame, agents: DataFrame, span: TickSpan, cadence: Cadence
) -> DataFrame:
    """Last heartbeat of every enabled agent at every tick."""
    runs = heartbeat_segments(heartbeats, agents, span, cadence)
    return explode_ticks(runs, F.col("from_us"), F.col("to_us"), cadence.step_us).select(
        "site_id", "tick_us", "agent_id", "agent_role", "last_event_time"
    )


def cadence_of(cfg: S.Thresholds) -> Cadence:
    return Cadence(cfg.lookback_seconds, cfg.interval_seconds)

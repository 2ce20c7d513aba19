"""Source gates, reconciliation, invariants and run ledgers."""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from linkwatch import schemas as S
from linkwatch.functions.numeric import at_least_zero, count_true
from linkwatch.functions.temporal import in_days, micros, seconds_between
from linkwatch.operators.daily import GRAIN, MEASURES

# --- source window ------------------------------------------------------------

_PROBE_EVENTS = (S.MEASUREMENT, S.SERVICE_CHECK)
_PROBE_TOPICS = tuple(S.TOPICS[t] for t in _PROBE_EVENTS)


def source_snapshot(
    measurements: DataFrame,
    checks: DataFrame,
    raw_log: DataFrame,
    heartbeats: DataFrame,
    failures: DataFrame,
    first: dt.date,
    last: dt.date,
) -> DataFrame:
    """Counts, newest times and largest delay of a day range, one row.

    A tagged union of five narrow scans feeds one conditional aggregate.
    """
    def tagged(df: DataFrame, tag: str, at: str, delay: Column | None = None) -> DataFrame:
        value = F.lit(None).cast("double") if delay is None else delay
        return df.where(in_days(at, first, last)).select(
            F.lit(tag).alias("tag"), F.col(at).alias("at"), value.alias("delay")
        )

    delay = at_least_zero(seconds_between("received_at", "event_time"))
    rows = (
        tagged(measurements, "observation", "event_time")
        .unionByName(tagged(checks, "observation", "event_time"))
        .unionByName(
            tagged(
                raw_log.where(F.col("event_type").isin(*_PROBE_EVENTS)), "raw", "event_time", delay
            )
        )
        .unionByName(tagged(heartbeats, "heartbeat", "event_time"))
        .unionByName(
            tagged(
                failures.where(F.col("source_topic").isin(*_PROBE_TOPICS)),
                "invalid",
                "last_failed_at",
            )
        )
    )
    tag = F.col("tag")

    def newest(name: str) -> Column:
        return F.max(F.when(tag == name, F.col("at")))

    return rows.agg(
        count_true(tag == "observation").alias("observation_count"),
        count_true(tag == "raw").alias("relevant_raw_count"),
        count_true(tag == "heartbeat").alias("heartbeat_count"),
        count_true(tag == "invalid").alias("invalid_count"),
        newest("observation").alias("latest_observation_at"),
        newest("heartbeat").alias("latest_heartbeat_at"),
        F.max("delay").alias("maximum_ingestion_delay_seconds"),
    )


def source_status(snapshot: DataFrame, stale_s: float = 900, delay_s: float = 600) -> DataFrame:
    """Add status, reason and whether a refresh may go ahead."""
    if stale_s <= 0 or delay_s <= 0:
        raise ValueError("quality thresholds must be positive")
    empty = F.col("observation_count") == 0
    upstream = (F.col("relevant_raw_count") > 0) | (F.col("heartbeat_count") > 0)
    behind = micros("latest_heartbeat_at") - micros("latest_observation_at")
    cases = [
        (F.col("invalid_count") > 0, "invalid", "the window holds rows that break their contract"),
        (
            empty & upstream,
            "missing",
            "records or heartbeats came in, yet none of them is a probe result",
        ),
        (empty, "legitimately_empty", "nothing at all was received for these days"),
        (
            F.coalesce(behind > F.lit(round(stale_s * 1e6)), F.lit(False)),
            "stale",
            "heartbeats go on, the newest probe result is too old",
        ),
        (
            F.coalesce(F.col("maximum_ingestion_delay_seconds") > delay_s, F.lit(False)),
            "delayed",
            "some probe results were received later than allowed",
        ),
    ]
    status = F.when(F.lit(False), F.lit(""))
    reason = F.when(F.lit(False), F.lit(""))
    for condition, name, text in cases:
        status, reason = status.when(condition, name), reason.when(condition, text)
    return snapshot.withColumns(
        {
            "source_status": status.otherwise("healthy"),
            "reason": reason.otherwise("probe results are complete and recent"),
        }
    ).withColumn("may_refresh", F.col("source_status").isin(*S.REFRESHABLE))


# --- reconciliation -------------------------------------------------------------


def reconcile(
    expected: DataFrame, actual: DataFrame, keys: Sequence[str], values: Sequence[str]
) -> DataFrame:
    """Row counts of both sides and how many rows differ, in one full join."""
    left = expected.select(
        *keys, *[F.col(v).alias(f"e_{v}") for v in values], F.lit(True).alias("in_expected")
    )
    right = actual.select(
        *keys, *[F.col(v).alias(f"a_{v}") for v in values], F.lit(True).alias("in_actual")
    )
    differs = F.col("in_expected").isNull() | F.col("in_actual").isNull()
    for v in values:
        differs = differs | ~F.col(f"e_{v}").eqNullSafe(F.col(f"a_{v}"))
    return left.join(right, list(keys), "full").agg(
        F.count("in_expected").alias("source_rows"),
        F.count("in_actual").alias("fact_rows"),
        count_true(differs).alias("mismatch_rows"),
    )


def reconcile_daily(expected: DataFrame, actual: DataFrame) -> DataFrame:
    return reconcile(expected, actual, GRAIN, MEASURES)


def reconcile_incidents(
    incidents: DataFrame, fact: DataFrame, agent_bridge: DataFrame, endpoint_bridge: DataFrame
) -> DataFrame:
    """Array lengths of the source against bridge rows of the fact.

    A repeated member counts in the length but not in the bridge, which makes
    it a mismatch.
    """
    expected = incidents.select(
        "incident_id",
        "status",
        F.col("state_revision").cast("bigint").alias("state_revision"),
        F.size("affected_agents").cast("bigint").alias("agent_count"),
        F.size("affected_endpoints").cast("bigint").alias("endpoint_count"),
    )

    def sizes(rows: DataFrame, name: str) -> DataFrame:
        return rows.groupBy("incident_id").agg(F.count(F.lit(1)).alias(name))

    zero = F.lit(0).cast("bigint")
    actual = (
        fact.select("incident_id", "status", F.col("state_revision").cast("bigint").alias("state_revision"))
        .join(sizes(agent_bridge, "agent_count"), "incident_id", "left")
        .join(sizes(endpoint_bridge, "endpoint_count"), "incident_id", "left")
        .withColumns(
            {c: F.coalesce(c, zero) for c in ("agent_count", "endpoint_count")}
        )
    )
    values = ("status", "state_revision", "agent_count", "endpoint_count")
    return reconcile(expected, actual, ("incident_id",), values)


def duplicates(rows: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Keys held by more than one row."""
    return (
        rows.groupBy(*keys).agg(F.count(F.lit(1)).alias("row_count")).where("row_count > 1")
    )


def validate_reporting(
    view: DataFrame, runs: DataFrame, first: dt.date, last: dt.date, run_id: int
) -> DataFrame:
    """Rows, duplicated grains, impossible values, and whether the run exists.

    Rows are counted per grain first; that one grouping gives all three counts.
    """
    outside = (
        (F.col("total_count") != F.col("success_count") + F.col("failure_count"))
        | ~F.col("success_rate_pct").between(0, 100)
        | (F.col("mean_latency_ms") < 0)
        | ~F.col("mean_packet_loss_pct").between(0, 100)
    )
    grains = (
        view.where(F.col("date_utc").between(first, last))
        .groupBy(*GRAIN)
        .agg(F.count(F.lit(1)).alias("n"), count_true(outside).alias("bad"))
    )
    counted = grains.agg(
        F.coalesce(F.sum("n"), F.lit(0)).alias("reporting_rows"),
        count_true(F.col("n") > 1).alias("duplicate_rows"),
        F.coalesce(F.sum("bad"), F.lit(0)).alias("invalid_rows"),
    )
    matches = runs.where(
        (F.col("run_id") == run_id)
        & (F.col("from_date") == F.lit(first))
        & (F.col("through_date") == F.lit(last))
        & ~F.col("is_all")
    )
    found = matches.agg((F.count(F.lit(1)) > 0).alias("found"))
    return counted.withColumn("run_matches", found.scalar())


# --- row invariants ---------------------------------------------------------------

Invariant = tuple[str, Column]


def _negative(*columns: str) -> Column:
    result = F.lit(False)
    for c in columns:
        result = result | (F.col(c) < 0)
    return result


def window_invariants() -> list[Invariant]:
    return [
        ("negative_count", _negative("event_count", "success_count", "failure_count")),
        (
            "count_sum",
            F.col("success_count") + F.col("failure_count") != F.col("event_count"),
        ),
        ("rate_range", ~F.col("success_rate_pct").between(0, 100)),
        ("window_order", F.col("window_end") <= F.col("window_start")),
        ("window_size", ~F.col("window_size_seconds").isin(*S.WINDOW_SIZES.values())),
    ]


def daily_invariants() -> list[Invariant]:
    return [
        ("empty_grain", F.col("total_count") <= 0),
        ("negative_count", _negative("success_count", "failure_count")),
        (
            "count_sum",
            F.col("success_count") + F.col("failure_count") != F.col("total_count"),
        ),
        (
            "value_count",
            (F.col("latency_count") > F.col("total_count"))
            | (F.col("packet_loss_count") > F.col("total_count")),
        ),
        ("latency_null", (F.col("latency_count") == 0) != F.col("latency_sum_ms").isNull()),
        (
            "loss_null",
            (F.col("packet_loss_count") == 0) != F.col("packet_loss_sum_pct").isNull(),
        ),
    ]


def incident_invariants() -> list[Invariant]:
    return [
        ("time_order", F.col("end_time") < F.col("start_time")),
        ("resolved_end", (F.col("status") == "resolved") != F.col("end_time").isNotNull()),
        ("state", ~F.col("status").isin(*S.INCIDENT_STATES)),
    ]


def run_invariants() -> list[Invariant]:
    return [
        ("range_order", F.col("from_date") > F.col("through_date")),
        ("running_open", (F.col("status") == "running") != F.col("completed_at").isNull()),
        ("attempts", F.col("attempt_count") <= 0),
    ]


def violations(rows: DataFrame, table: str, invariants: Sequence[Invariant]) -> DataFrame:
    """(table, rule, violations) of every invariant from one aggregate."""
    counts = rows.agg(*[count_true(c).alias(name) for name, c in invariants])
    pairs = F.array(
        *[F.struct(F.lit(n).alias("rule_name"), F.col(n).alias("n")) for n, _ in invariants]
    )
    return counts.select(F.lit(table).alias("table_name"), F.explode(pairs).alias("p")).select(
        "table_name", "p.rule_name", F.col("p.n").alias("violations")
    )


def open_incident_clashes(incidents: DataFrame) -> DataFrame:
    """Keys with more than one unresolved incident."""
    keys = [c for c in ("site_id", "incident_key") if c in incidents.columns]
    return duplicates(incidents.where(F.col("status") != "resolved"), keys)


def require_none(problems: DataFrame, what: str) -> None:
    """Fail when a check found anything; only one row is looked at."""
    first = problems.limit(1).collect()
    if first:
        raise ValueError(f"{what}: {first[0].asDict()}")


def streaming_invariants(metrics: DataFrame, rejects: DataFrame, agents: DataFrame) -> DataFrame:
    """One row per broken expectation on the stream's output tables."""
    keys = ("window_start", "window_end", "window_size_seconds", "agent_id", "target_id",
            "measurement_type")
    sizes = F.sort_array(F.collect_set(F.col("window_size_seconds").cast("int")))
    wanted = F.array(*[F.lit(s) for s in sorted(S.WINDOW_SIZES.values())])
    totals = metrics.agg(F.count(F.lit(1)).alias("n"), sizes.alias("sizes"))
    problems = totals.select(
        F.explode(
            F.array_compact(
                F.array(
                    F.when(F.col("n") == 0, F.lit("no window metrics")),
                    F.when(F.col("sizes") != wanted, F.lit("window sizes differ")),
                )
            )
        ).alias("problem")
    )
    repeated = duplicates(metrics, keys).limit(1).select(
        F.lit("repeated metric keys").alias("problem")
    )
    no_rejects = rejects.agg(F.count(F.lit(1)).alias("n")).where("n = 0").select(
        F.lit("no rejects").alias("problem")
    )
    silent = agents.select("agent_id").join(
        metrics.select("agent_id").distinct(), "agent_id", "left_anti"
    ).select(F.concat(F.lit("no metrics of "), F.col("agent_id")).alias("problem"))
    return problems.unionByName(repeated).unionByName(no_rejects).unionByName(silent)


def ingest_invariants(raw: DataFrame, typed: dict[str, DataFrame], agents: DataFrame) -> DataFrame:
    empty = [
        table.agg(F.count(F.lit(1)).alias("n"))
        .where("n = 0")
        .select(F.lit(f"no rows in {name}").alias("problem"))
        for name, table in {"raw log": raw, **typed}.items()
    ]
    repeated = duplicates(raw, ["event_id"]).limit(1).select(
        F.lit("repeated event ids").alias("problem")
    )
    silent = agents.select("agent_id").join(
        raw.select("agent_id").distinct(), "agent_id", "left_anti"
    ).select(F.concat(F.lit("no events of "), F.col("agent_id")).alias("problem"))
    result = repeated.unionByName(silent)
    for part in empty:
        result = result.unionByName(part)
    return result


def observed_states(log: DataFrame) -> DataFrame:
    """States of each incident in revision order."""
    ordered = F.array_sort(F.collect_list(F.struct("state_revision", "status")))
    return log.groupBy("incident_id").agg(
        F.transform(ordered, lambda s: s["status"]).alias("states")
    )


def lifecycle_invariants(
    incidents: DataFrame, log: DataFrame, acknowledged: DataFrame, incident_type: str
) -> DataFrame:
    """The newest incident of a type went through all states and was published."""
    newest = (
        incidents.where(F.col("incident_type") == incident_type)
        .orderBy(F.desc("start_time"), "incident_id")
        .limit(1)
    )
    steps = log.join(newest.select("incident_id"), "incident_id", "left_semi")
    seen = steps.agg(F.collect_set("status").alias("seen"))
    required = ("candidate", "open", "recovering", "resolved")
    missing = seen.select(
        F.explode(
            F.array_except(F.array(*[F.lit(r) for r in required]), F.col("seen"))
        ).alias("state")
    ).select(F.concat(F.lit("missing state "), F.col("state")).alias("problem"))
    unresolved = newest.where(
        (F.col("status") != "resolved") | F.col("end_time").isNull()
    ).select(F.lit("newest incident is not resolved").alias("problem"))
    waiting = (
        log.join(acknowledged.select("event_id"), "event_id", "left_anti")
        .limit(1)
        .select(F.lit("unpublished state events").alias("problem"))
    )
    return missing.unionByName(unresolved).unionByName(waiting)


# --- run ledgers ------------------------------------------------------------------


def run_key(job: str, first: Column, last: Column) -> Column:
    return F.concat_ws(":", F.lit(job), first.cast("string"), last.cast("string"))


LEDGER_RESET = (
    "completed_at",
    "analytics_run_id",
    "daily_mismatch_rows",
    "incident_mismatch_rows",
    "failed_task_id",
    "error_type",
)


def ledger_state(events: DataFrame) -> DataFrame:
    """Current run rows out of an append-only log of start/success/failed events.

    A start resets the outcome and counts an attempt; the event with the
    highest ``seq`` decides the status.  Everything is a per-key aggregate, so
    the log can be appended to and replayed freely.
    """
    started = F.col("event") == "start"
    seq = F.col("seq")
    last_start = F.max(F.when(started, seq))
    rows = events.groupBy("run_key").agg(
        F.max_by(
            F.struct("from_date", "through_date", "source_status", "source_observation_count",
                     F.col("at").alias("started_at")),
            F.when(started, seq),
        ).alias("s"),
        count_true(started).cast("int").alias("attempt_count"),
        last_start.alias("start_seq"),
        F.max_by(
            F.struct(
                seq,
                "event",
                F.col("at").alias("completed_at"),
                "analytics_run_id",
                "daily_mismatch_rows",
                "incident_mismatch_rows",
                "failed_task_id",
                "error_type",
            ),
            F.when(~started, seq),
        ).alias("o"),
    )
    done = F.coalesce(F.col("o.seq") > F.col("start_seq"), F.lit(False))
    status = F.when(~done, F.lit("running")).otherwise(F.col("o.event"))
    return rows.select(
        "run_key",
        "s.from_date",
        "s.through_date",
        status.alias("status"),
        "s.source_status",
        "s.source_observation_count",
        "attempt_count",
        "s.started_at",
        *[F.when(done, F.col(f"o.{c}")).alias(c) for c in LEDGER_RESET],
    )

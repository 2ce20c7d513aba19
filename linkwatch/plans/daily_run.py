"""The daily refresh as one application: gate, refresh, reconcile, validate, record."""

from __future__ import annotations

import datetime as dt
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from linkwatch.operators import daily as D
from linkwatch.operators import quality as Q
from linkwatch.operators import views as W
from linkwatch.sources import files, versions

LONGEST_SCHEDULED_DAYS = 31
JOB = "daily-reliability"
FACT = "fact_daily"
STAR = (FACT, "fact_incident", "bridge_agent_id", "bridge_endpoint_id")

EVENT_SCHEMA = (
    "run_key string, seq bigint, event string, at timestamp, from_date date, through_date date, "
    "source_status string, source_observation_count bigint, analytics_run_id bigint, "
    "daily_mismatch_rows bigint, incident_mismatch_rows bigint, failed_task_id string, "
    "error_type string"
)


@dataclass(frozen=True)
class Sources:
    """The operational tables a refresh reads."""

    measurements: DataFrame
    checks: DataFrame
    raw_log: DataFrame
    heartbeats: DataFrame
    failures: DataFrame
    incidents: DataFrame


class DailyRun:
    """Refreshes the star schema below ``out`` for one range of days.

    Facts are written to a staging path, reconciled there, and only then released,
    all tables in one step, so a failed run leaves the published ones as they were.
    """

    def __init__(self, spark: SparkSession, sources: Sources, out: str) -> None:
        self.spark = spark
        self.sources = sources
        self.out = out.rstrip("/")

    def run_scheduled(self, now: dt.datetime, longest: int = LONGEST_SCHEDULED_DAYS) -> dict:
        """The day before ``now``, under the bound that scheduled runs have."""
        first, last = D.previous_utc_day(now)
        D.checked_range(first, last, longest)
        return self.run(first, last, now)

    def run_all(self, now: dt.datetime) -> dict:
        """Every day the sources have."""
        s = self.sources
        bounds = D.date_bounds(D.event_dates(s.measurements), D.event_dates(s.checks)).first()
        if bounds.from_date is None:
            raise ValueError("the sources hold no day")
        return self.run(bounds.from_date, bounds.through_date, now)

    def run(self, first: dt.date, last: dt.date, now: dt.datetime) -> dict:
        """An explicit range of any length."""
        D.checked_range(first, last)
        key = f"{JOB}:{first}:{last}"
        gate = self._gate(first, last)
        self._record(key, "start", now, first, last, gate)
        stage = "refresh"
        try:
            if not gate["may_refresh"]:
                stage = "check"
                raise RuntimeError(f"source is {gate['source_status']}")
            staged = self._stage(first, last)
            stage = "reconcile"
            daily, incidents = self._reconcile(staged, first, last)
            if daily or incidents:
                raise RuntimeError(f"{daily + incidents} reconciliation mismatches")
            stage = "promote"
            self._promote(staged, first, last)
            stage = "validate"
            run_id = self._job_run(first, last, now)
            self._validate(first, last, run_id)
        except Exception as error:
            self._record(
                key, "failed", now, failed_task_id=stage, error_type=type(error).__name__
            )
            raise
        self._record(
            key, "success", now, analytics_run_id=run_id, daily_mismatch_rows=daily,
            incident_mismatch_rows=incidents,
        )
        return {"run_id": run_id, "source_status": gate["source_status"]}

    def ledger(self) -> DataFrame:
        return Q.ledger_state(self.spark.read.schema(EVENT_SCHEMA).parquet(f"{self.out}/ledger"))

    def view(self) -> DataFrame:
        return W.daily_reliability(self.table(FACT))

    def _gate(self, first: dt.date, last: dt.date) -> dict:
        s = self.sources
        snapshot = Q.source_snapshot(
            s.measurements, s.checks, s.raw_log, s.heartbeats, s.failures, first, last
        )
        return Q.source_status(snapshot).collect()[0].asDict()

    def _stage(self, first: dt.date, last: dt.date) -> str:
        s = self.sources
        staged = files.sibling(f"{self.out}/run", "staging")
        D.daily_fact(s.measurements, s.checks, first, last).write.parquet(f"{staged}/fact_daily")
        D.incident_fact(s.incidents).write.parquet(f"{staged}/fact_incident")
        for column, member in (("affected_agents", "agent_id"), ("affected_endpoints", "endpoint_id")):
            D.bridge(s.incidents, column, member).write.parquet(f"{staged}/bridge_{member}")
        return staged

    def _reconcile(self, staged: str, first: dt.date, last: dt.date) -> tuple[int, int]:
        s, read = self.sources, self.spark.read.parquet
        daily = Q.reconcile_daily(
            D.daily_fact(s.measurements, s.checks, first, last), read(f"{staged}/fact_daily")
        )
        incidents = Q.reconcile_incidents(
            s.incidents,
            read(f"{staged}/fact_incident"),
            read(f"{staged}/bridge_agent_id"),
            read(f"{staged}/bridge_endpoint_id"),
        )
        return daily.collect()[0]["mismatch_rows"], incidents.collect()[0]["mismatch_rows"]

    def _promote(self, staged: str, first: dt.date, last: dt.date) -> None:
        spark, read = self.spark, self.spark.read.parquet
        base = versions.current(spark, self.out)
        before = {name: versions.released(spark, self.out, name, base) for name in STAR}
        new = {
            name: versions.publish_table(
                read(f"{staged}/{name}"), f"{self.out}/{name}", base=before[name]
            )
            for name in STAR[1:]
        }
        new[FACT] = versions.publish_range(
            read(f"{staged}/{FACT}"), f"{self.out}/{FACT}", first, last, base=before[FACT]
        )
        versions.release(spark, self.out, base, new)
        files.delete(spark, staged)

    def table(self, name: str) -> DataFrame:
        """A table of the star schema as last released."""
        found = versions.released(self.spark, self.out, name)
        return versions.read_table(self.spark, f"{self.out}/{name}", version=found)

    def _job_run(self, first: dt.date, last: dt.date, now: dt.datetime) -> int:
        """Append the run; its id follows from what it did and when."""
        row = self.spark.range(1).select(
            F.pmod(
                D.surrogate(F.lit(str(first)), F.lit(str(last)), F.lit(now.isoformat())),
                F.lit(2**53),
            ).alias("run_id"),
            F.lit(first).alias("from_date"),
            F.lit(last).alias("through_date"),
            F.lit(False).alias("is_all"),
            F.lit(now).alias("completed_at"),
        )
        run_id = row.collect()[0]["run_id"]
        row.write.mode("overwrite").parquet(f"{self.out}/job_runs/run={run_id}")
        return run_id

    def _validate(self, first: dt.date, last: dt.date, run_id: int) -> None:
        runs = self.spark.read.parquet(f"{self.out}/job_runs")
        found = Q.validate_reporting(self.view(), runs, first, last, run_id).collect()[0]
        if found["duplicate_rows"] or found["invalid_rows"] or not found["run_matches"]:
            raise RuntimeError(f"reporting validation failed: {found.asDict()}")

    def _record(self, key, event, now, first=None, last=None, gate=None, **outcome) -> None:
        """One event row; its sequence number is the number of events before it."""
        path = f"{self.out}/ledger"
        seq = len(files.children(self.spark, path))
        names = [part.split()[0] for part in EVENT_SCHEMA.split(", ")]
        values = {
            "run_key": key,
            "seq": seq,
            "event": event,
            "at": now,
            "from_date": first,
            "through_date": last,
            "source_status": gate["source_status"] if gate else None,
            "source_observation_count": gate["observation_count"] if gate else None,
            **outcome,
        }
        row = self.spark.createDataFrame([tuple(values.get(n) for n in names)], EVENT_SCHEMA)
        row.write.parquet(f"{path}/step={seq}")

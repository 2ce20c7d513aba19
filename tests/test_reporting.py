"""Star schema, gates, pages, extracts, sinks and the daily run."""

from __future__ import annotations

import datetime as dt
import hashlib

import pytest
from pyspark.sql import functions as F

from linkwatch import schemas as S
from linkwatch.functions.ids import pseudonym
from linkwatch.operators import daily as D
from linkwatch.operators import exports as X
from linkwatch.operators import quality as Q
from linkwatch.operators import serving as P
from linkwatch.operators import views as W
from linkwatch.plans.daily_run import DailyRun, Sources
from linkwatch.sources import sinks, versions

UTC = dt.timezone.utc
DAY = dt.date(2026, 1, 5)
NEXT = dt.date(2026, 1, 6)
MEASUREMENTS = (
    "event_id string, agent_id string, target_id string, event_time timestamp, "
    "measurement_type string, success boolean, latency_ms double, packet_loss_pct double"
)
CHECKS = (
    "event_id string, agent_id string, endpoint_id string, event_time timestamp, "
    "check_type string, success boolean, total_duration_ms double"
)


def at(day: dt.date, *clock: int) -> dt.datetime:
    return dt.datetime.combine(day, dt.time(*clock), UTC)


def probes(spark, *rows):
    data = [(f"e{i}", "a", "router", t, "router_ping", ok, ms, loss) for i, (t, ok, ms, loss) in enumerate(rows)]
    return spark.createDataFrame(data, MEASUREMENTS)


def no_checks(spark):
    return spark.createDataFrame([], CHECKS)


def test_days_break_at_utc_midnight_and_nulls_stay_out_of_sums(spark):
    rows = probes(
        spark,
        (at(DAY, 23, 59, 59), True, 10.0, 0.0),
        (at(NEXT, 0, 0, 0), False, None, 100.0),
    )
    fact = {r["date_utc"]: r for r in D.daily_fact(rows, no_checks(spark), DAY, NEXT).collect()}
    assert (fact[DAY]["latency_sum_ms"], fact[DAY]["latency_count"]) == (10.0, 1)
    assert (fact[NEXT]["latency_sum_ms"], fact[NEXT]["latency_count"]) == (None, 0)
    only = D.daily_fact(rows, no_checks(spark), DAY, DAY).collect()
    assert [r["date_utc"] for r in only] == [DAY]


def test_day_range_reaches_the_scan(spark, tmp_path):
    path = str(tmp_path / "m")
    probes(spark, (at(DAY, 1), True, 1.0, 0.0)).write.parquet(path)
    stored = spark.read.parquet(path)
    plan = D.daily_fact(stored, no_checks(spark), DAY, DAY)._jdf.queryExecution().executedPlan()
    text = plan.toString()
    assert "GreaterThanOrEqual(event_time" in text and "LessThan(event_time" in text
    assert "event_id" not in text.partition("ReadSchema:")[2].partition(">")[0]


def test_range_replace_clears_emptied_days(spark, tmp_path):
    path = str(tmp_path / "fact")
    both = probes(spark, (at(DAY, 1), True, 1.0, 0.0), (at(NEXT, 1), True, 1.0, 0.0))
    D.daily_fact(both, no_checks(spark)).write.partitionBy("date_utc").parquet(path)
    fresh = D.daily_fact(both.where(F.to_date("event_time") == F.lit(NEXT)), no_checks(spark))
    sinks.replace_range(fresh, path, DAY, NEXT)
    assert [r["date_utc"] for r in spark.read.parquet(path).collect()] == [NEXT]


@pytest.mark.parametrize(
    ("row", "status"),
    [
        ((5, 5, 5, 0, 0, 0, 10.0), "healthy"),
        ((5, 5, 5, 0, 0, 0, 601.0), "delayed"),
        ((0, 0, 0, 0, None, None, None), "legitimately_empty"),
        ((0, 3, 0, 0, None, None, 1.0), "missing"),
        ((5, 5, 5, 0, 0, 901, 10.0), "stale"),
        ((0, 0, 0, 1, None, None, None), "invalid"),
    ],
)
def test_source_gate(spark, row, status):
    base = at(DAY, 12)
    move = lambda s: None if s is None else base + dt.timedelta(seconds=s)
    snapshot = spark.createDataFrame(
        [(*row[:4], move(row[4]), move(row[5]), row[6])],
        "observation_count bigint, relevant_raw_count bigint, heartbeat_count bigint, "
        "invalid_count bigint, latest_observation_at timestamp, latest_heartbeat_at timestamp, "
        "maximum_ingestion_delay_seconds double",
    )
    got = Q.source_status(snapshot).collect()[0]
    assert got["source_status"] == status
    assert got["may_refresh"] == (status in S.REFRESHABLE)


FACT = (
    "date_utc date, agent_id string, endpoint_id string, source_kind string, probe_type string, "
    "total_count bigint, success_count bigint, failure_count bigint, latency_sum_ms double, "
    "latency_count bigint, packet_loss_sum_pct double, packet_loss_count bigint"
)


def fact_rows(spark, *rows):
    return spark.createDataFrame(list(rows), FACT)


def grain(day, agent, endpoint, total=2, ok=1, ms=10.0, n=1, loss=100.0, ln=2):
    kind = "network_measurement"
    return (day, agent, endpoint, kind, "router_ping", total, ok, total - ok, ms, n, loss, ln)


def test_extracts_pool_counts_and_hide_ids(spark):
    fact = fact_rows(
        spark,
        grain(DAY, "secret", "r1", total=1, ok=1, ms=10.0, n=1, loss=0.0, ln=1),
        grain(DAY, "secret", "r2", total=3, ok=0, ms=None, n=0, loss=None, ln=0),
        grain(NEXT, "secret", "r1", total=1, ok=0, ms=None, n=0, loss=None, ln=0),
    )
    view = W.daily_reliability(fact).withColumn("agent_role", F.lit(None).cast("string"))
    daily = X.export_daily(view)
    rows = daily.collect()
    assert tuple(daily.columns) == X.DATASETS["daily_reliability"]
    assert [(r["total_probes"], r["success_rate_pct"], r["average_latency_ms"]) for r in rows] == [
        (4, 25.0, 10.0),
        (1, 0.0, None),
    ]
    digest = hashlib.sha256(b"linkwatch-agent-v1\0secret").hexdigest()[:12]
    assert {r["agent_key"] for r in rows} == {f"agent_{digest}"}
    agent = X.export_agents(view).collect()[0]
    assert (agent["observation_day_count"], agent["total_probes"]) == (2, 5)
    assert "secret" not in str(rows) + str(agent)


def test_pseudonym_namespace_is_a_parameter(spark):
    row = spark.range(1).select(pseudonym(F.lit("x"), "other").alias("k")).collect()[0]
    assert row["k"] == "agent_" + hashlib.sha256(b"other\0x").hexdigest()[:12]


SUMMARY = (
    "incident_id string, incident_type string, start_time timestamp, end_time timestamp, "
    "duration_ms double, status string, severity string, confidence_score double, "
    "rule_version string, state_revision bigint, affected_agent_count bigint, "
    "affected_endpoint_count bigint"
)


def incident(revision=1, start=at(DAY, 1)):
    return ("i", "wifi_outage", start, None, 5.0, "open", "critical", 0.9, "1.0.0", revision, 1, 0)


def test_equal_incidents_collapse_and_conflicts_fail(spark):
    same = spark.createDataFrame([incident(), incident()], SUMMARY)
    assert X.export_incidents(same).count() == 1
    with pytest.raises(ValueError, match="conflicting"):
        X.export_incidents(spark.createDataFrame([incident(), incident(2)], SUMMARY))


def test_time_text_shows_microseconds_only_when_present(spark):
    fine = at(DAY, 1).replace(microsecond=5)
    rows = spark.createDataFrame([incident(), incident(start=fine)], SUMMARY)
    texts = {r["start_time_utc"] for r in X.export_incidents(rows, check=False).collect()}
    assert texts == {"2026-01-05T01:00:00Z", "2026-01-05T01:00:00.000005Z"}


PIPELINE = (
    "observed_at timestamp, last_raw_event_received_at timestamp, raw_event_age_seconds double, "
    "pending_dead_letter_count bigint, stream_processing_failure_count bigint, "
    "last_stream_batch_completed_at timestamp, active_incident_count bigint, "
    "pending_incident_publication_count bigint"
)


def bundle(spark):
    view = W.daily_reliability(fact_rows(spark, grain(DAY, "a", "r")))
    status = spark.createDataFrame([(at(DAY, 1), None, None, 0, 0, None, 0, 0)], PIPELINE)
    return X.export_bundle(
        view.withColumn("agent_role", F.lit("r")), spark.createDataFrame([], SUMMARY), status
    )


def test_extracts_are_published_and_verified(spark, tmp_path):
    out = str(tmp_path / "current")
    for _ in range(2):
        sinks.publish_csv(bundle(spark), out)
    found = {r["dataset"]: (r["row_count"], r["problem"]) for r in sinks.verify_csv(spark, out).collect()}
    assert found == {
        "daily_reliability": (1, None),
        "agent_performance": (1, None),
        "incidents": (0, None),
        "pipeline_health": (1, None),
    }
    assert [p.name for p in tmp_path.iterdir() if not p.name.endswith(".crc")] == ["current"]
    with pytest.raises(ValueError, match="exactly"):
        sinks.publish_csv({}, out)


def test_verification_sees_a_line_of_another_width(spark, tmp_path):
    out = tmp_path / "current"
    sinks.publish_csv(bundle(spark), str(out))
    (out / "pipeline_health" / "part-extra.csv").write_text("only,three,fields\n")
    found = {r["dataset"]: r["problem"] for r in sinks.verify_csv(spark, str(out)).collect()}
    assert found["pipeline_health"] == "line of another width"


def test_pages_cover_everything_once_in_order(spark):
    rows = [grain(d, a, e) for d in (DAY, NEXT) for a in "cab" for e in ("x", "y")]
    view = W.daily_reliability(fact_rows(spark, *rows))
    seen, key = [], None
    while True:
        part = P.page(view, after=key, limit=5).collect()
        seen += [tuple(r[c] for c in D.GRAIN) for r in part]
        if not part[-1]["has_more"]:
            break
        key = P.PageKey(*seen[-1])
    want = sorted((r[:5] for r in rows), key=lambda r: (-r[0].toordinal(), *r[1:]))
    assert seen == want


def test_page_is_a_top_k_and_arguments_are_checked(spark):
    view = W.daily_reliability(fact_rows(spark, grain(DAY, "a", "x")))
    plan = P.page(view)._jdf.queryExecution().executedPlan().toString()
    assert "TakeOrderedAndProject" in plan
    for limit in (0, 201, True):
        with pytest.raises(ValueError):
            P.page(view, limit=limit)
    with pytest.raises(ValueError):
        P.PageFilters(from_date=DAY)
    with pytest.raises(ValueError):
        P.PageFilters(DAY, DAY + dt.timedelta(days=366))


def test_sentinel_only_without_runs(spark):
    schema = (
        "run_key string, seq bigint, event string, at timestamp, from_date date, through_date date, "
        "source_status string, source_observation_count bigint, analytics_run_id bigint, "
        "daily_mismatch_rows bigint, incident_mismatch_rows bigint, failed_task_id string, "
        "error_type string"
    )
    start = ("k", 0, "start", at(DAY, 1), DAY, DAY, "healthy", 1, None, None, None, None, None)
    fail = ("k", 1, "failed", at(DAY, 2), None, None, None, None, None, None, None, "t", "E")
    again = ("k", 2, "start", at(DAY, 3), DAY, DAY, "healthy", 1, None, None, None, None, None)
    events = spark.createDataFrame([start, fail, again], schema)
    shown = P.latest_or_sentinel(W.workflow_status(Q.ledger_state(events), at(DAY, 4))).collect()
    assert [(r["status"], r["attempt_count"], r["error_type"]) for r in shown] == [("running", 2, None)]
    none = P.latest_or_sentinel(W.workflow_status(Q.ledger_state(events.where("false")), at(DAY, 4)))
    assert [r["status"] for r in none.collect()] == ["no_runs"]


def test_upsert_log_is_idempotent_and_last_writer_wins(spark, tmp_path):
    path = str(tmp_path / "log")
    one = spark.createDataFrame([("k", 1)], "id string, v int")
    sinks.append_batch(one, path, 0)
    sinks.append_batch(one.withColumn("v", F.lit(2)), path, 1)
    sinks.append_batch(one.withColumn("v", F.lit(3)), path, 1)
    rows = sinks.resolve_last(spark.read.parquet(path), ["id"]).collect()
    assert [(r["id"], r["v"]) for r in rows] == [("k", 3)]


def test_oversized_batch_is_refused(spark):
    with pytest.raises(RuntimeError, match="exceeded"):
        sinks.guarded(spark.range(4), 3)
    assert sinks.guarded(spark.range(3), 3) == 3


def _sources(spark, rows, failures=()):
    raw = spark.createDataFrame([], "event_type string, event_time timestamp, received_at timestamp")
    beats = spark.createDataFrame([], "event_time timestamp")
    failed = spark.createDataFrame(list(failures), "source_topic string, last_failed_at timestamp")
    incidents = spark.createDataFrame(
        [("i1", at(DAY, 1), None, "open", "wifi_outage", "critical", 0.9, 1.0, "1.0.0", 1, ["a", "b"], ["x"])],
        "incident_id string, start_time timestamp, end_time timestamp, status string, "
        "incident_type string, severity string, confidence_score double, duration_ms double, "
        "rule_version string, state_revision bigint, affected_agents array<string>, "
        "affected_endpoints array<string>",
    )
    return Sources(rows, no_checks(spark), raw, beats, failed, incidents)


def test_daily_run_publishes_then_leaves_tables_alone_when_it_fails(spark, tmp_path):
    out = str(tmp_path / "star")
    rows = probes(spark, (at(DAY, 1), True, 3.0, 0.0), (at(DAY, 2), False, None, 100.0))
    result = DailyRun(spark, _sources(spark, rows), out).run(DAY, DAY, at(NEXT, 1))
    assert result["source_status"] == "healthy"
    view = DailyRun(spark, _sources(spark, rows), out).view().collect()
    assert [(r["total_count"], r["success_rate_pct"]) for r in view] == [(2, 50.0)]

    broken = _sources(spark, rows.limit(1), [(S.TOPICS[S.MEASUREMENT], at(DAY, 1))])
    again = DailyRun(spark, broken, out)
    with pytest.raises(RuntimeError, match="invalid"):
        again.run(DAY, DAY, at(NEXT, 2))
    assert again.view().collect()[0]["total_count"] == 2
    run = again.ledger().collect()
    assert [(r["status"], r["attempt_count"], r["failed_task_id"]) for r in run] == [
        ("failed", 2, "check")
    ]


def test_every_day_is_refreshed_and_a_run_that_stops_releases_nothing(spark, tmp_path, monkeypatch):
    out = str(tmp_path / "star")
    rows = probes(spark, (at(DAY, 1), True, 3.0, 0.0), (at(NEXT, 2), False, None, 100.0))
    DailyRun(spark, _sources(spark, rows), out).run_all(at(NEXT, 3))
    run = DailyRun(spark, _sources(spark, rows.unionByName(rows)), out)
    assert sorted(r["date_utc"] for r in run.view().collect()) == [DAY, NEXT]
    assert run.table("bridge_agent_id").count() == 2 and run.table("bridge_endpoint_id").count() == 1
    with monkeypatch.context() as m:  # all tables are written, the release is not
        m.setattr(versions, "release", lambda *_: (_ for _ in ()).throw(OSError("stopped")))
        with pytest.raises(OSError, match="stopped"):
            run.run_all(at(NEXT, 4))
    assert [r["total_count"] for r in run.view().collect()] == [1, 1]
    run.run_scheduled(at(NEXT, 5))  # the day before
    got = {r["date_utc"]: r["total_count"] for r in run.view().collect()}
    assert got == {DAY: 2, NEXT: 1}


def test_repeated_agent_is_an_incident_mismatch(spark):
    incidents = _sources(spark, None).incidents
    doubled = incidents.withColumn("affected_agents", F.array(F.lit("a"), F.lit("a")))
    fact = D.incident_fact(doubled)
    bridges = [D.bridge(doubled, c, m) for c, m in (("affected_agents", "agent_id"), ("affected_endpoints", "endpoint_id"))]
    row = Q.reconcile_incidents(doubled, fact, *bridges).collect()[0]
    assert (row["source_rows"], row["fact_rows"], row["mismatch_rows"]) == (1, 1, 1)

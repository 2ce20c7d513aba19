"""Rules, lifecycle and service-level stretches on small fixtures."""

from __future__ import annotations

import datetime as dt
import itertools
import uuid

import pytest
from pyspark.sql import functions as F

from linkwatch import schemas as S
from linkwatch.functions.ids import uuid5
from linkwatch.functions.temporal import Cadence, TickSpan
from linkwatch.operators import lifecycle as L
from linkwatch.operators import rules as R
from linkwatch.operators import slo as K
from linkwatch.operators import snapshot as N

UTC = dt.timezone.utc
CFG = S.Thresholds()
SUMMARY = (
    "site_id string, tick_us bigint, agent_id string, agent_role string, endpoint_id string, "
    "probe_type string, sample_count bigint, success_rate_pct double, peak_latency_ms double, "
    "mean_packet_loss_pct double, weakest_signal_dbm double, connected_rate_pct double"
)


def healthy() -> dict:
    rows = {}
    for role, name, router, external in (
        (S.WIRED, "wired", 2.0, 18.0),
        (S.WIFI, "wifi", 6.0, 26.0),
    ):
        rows[name, "router_ping"] = [role, "router", 100.0, router, 0.0, None, None]
        rows[name, "external_ping"] = [role, "public", 100.0, external, 0.0, None, None]
        rows[name, "dns"] = [role, "dns-check", 100.0, None, None, None, None]
        rows[name, "http"] = [role, "web", 100.0, None, None, None, None]
    rows["wifi", "wifi_diagnostics"] = [S.WIFI, "wlan", 100.0, None, 0.0, -57.0, 100.0]
    return rows


RATE, PEAK, LOSS, SIGNAL, LINK = 2, 3, 4, 5, 6


def with_changes(changes: dict) -> dict:
    rows = healthy()
    for key, fields in changes.items():
        for i, value in fields.items():
            rows[key][i] = value
    return rows


def frame(spark, rows: dict, samples: int = 5):
    data = [
        ("", 60_000_000, agent, r[0], r[1], probe, samples, r[2], r[3], r[4], r[5], r[6])
        for (agent, probe), r in rows.items()
    ]
    return spark.createDataFrame(data, SUMMARY)


DEAD = {RATE: 0.0, PEAK: None, LOSS: 100.0}
CASES = {
    None: {},
    "router_unavailable": {("wired", "router_ping"): DEAD, ("wifi", "router_ping"): DEAD},
    "wifi_outage": {
        ("wifi", "router_ping"): DEAD,
        ("wifi", "wifi_diagnostics"): {RATE: 0.0, LINK: 0.0},
    },
    "isp_outage": {("wired", "external_ping"): DEAD, ("wifi", "external_ping"): DEAD},
    "wifi_degradation": {
        ("wifi", "router_ping"): {PEAK: 90.0},
        ("wifi", "wifi_diagnostics"): {SIGNAL: -84.0},
    },
    "dns_failure": {("wired", "dns"): {RATE: 0.0}, ("wifi", "dns"): {RATE: 10.0}},
    "external_service_failure": {("wired", "http"): {RATE: 0.0}, ("wifi", "http"): {RATE: 0.0}},
    "high_packet_loss": {
        ("wired", "external_ping"): {LOSS: 35.0},
        ("wifi", "external_ping"): {LOSS: 35.0},
    },
    "high_latency": {
        ("wired", "external_ping"): {PEAK: 240.0},
        ("wifi", "external_ping"): {PEAK: 250.0},
    },
    "unknown_network_incident": {("wired", "external_ping"): {PEAK: 240.0}},
}


@pytest.mark.parametrize("expected", CASES, ids=str)
def test_one_class_per_condition(spark, expected):
    found = R.classify_summaries(frame(spark, with_changes(CASES[expected])), CFG).collect()
    assert [r["incident_type"] for r in found] == ([expected] if expected else [])


def test_too_few_samples_decide_nothing(spark):
    rows = with_changes(CASES["router_unavailable"])
    assert R.classify_summaries(frame(spark, rows, samples=1), CFG).count() == 0


def test_service_branch_without_match_falls_through_to_latency(spark):
    changes = dict(CASES["high_latency"]) | {("wired", "dns"): {RATE: 0.0}}
    found = R.classify_summaries(frame(spark, with_changes(changes)), CFG).collect()
    assert [r["incident_type"] for r in found] == ["high_latency"]


def test_evidence_and_key(spark):
    found = R.classify_summaries(frame(spark, with_changes(CASES["dns_failure"])), CFG).collect()[0]
    assert found["incident_key"] == "dns_failure:dns-check"
    assert found["affected_agents"] == ["wifi", "wired"]
    assert found["peak_latency_ms"] is None
    assert [e["success_rate_pct"] for e in found["evidence"]] == [10.0, 0.0]


def test_offline_needs_a_live_peer(spark):
    at = dt.datetime(1970, 1, 1, 1, tzinfo=UTC)
    tick = 3_600_000_000
    schema = "site_id string, tick_us bigint, agent_id string, agent_role string, last_event_time timestamp"

    def offline(*rows):
        data = [("", tick, a, "r", t) for a, t in rows]
        found = R.offline_findings(spark.createDataFrame(data, schema), CFG).collect()
        return {r["incident_key"]: r["evidence"][0]["other_recent_agents"] for r in found}

    old = at - dt.timedelta(seconds=151)
    assert offline(("a", at), ("b", old)) == {"agent_offline:b": ["a"]}
    assert offline(("a", at), ("b", None)) == {"agent_offline:b": ["a"]}
    assert offline(("a", old), ("b", None)) == {}
    assert offline(("a", at), ("b", at - dt.timedelta(seconds=150))) == {}


def step_by_step(hits: list[bool], open_n: int, resolve_n: int) -> list[tuple]:
    out, live = [], None
    for tick, hit in enumerate(hits):
        if hit and live is None:
            live = [tick, "candidate", 1, 1, 0]
        elif hit:
            live[2] += 1
            live[3] += 1
            live[4] = 0
            if live[1] == "candidate":
                live[1] = "open" if live[3] >= open_n else "candidate"
            else:
                live[1] = "open" if live[1] == "recovering" else "ongoing"
        elif live is not None:
            live[2] += 1
            live[4] += 1
            was = live[1]
            over = was == "candidate" or (was == "recovering" and live[4] >= resolve_n)
            live[1] = "resolved" if over else "recovering"
        else:
            continue
        out.append((tick, *live))
        if live[1] == "resolved":
            live = None
    return out


@pytest.mark.parametrize(("open_n", "resolve_n"), [(1, 1), (2, 2), (3, 2), (2, 4)])
def test_lifecycle_equals_the_step_by_step_definition(spark, open_n, resolve_n):
    """Every hit pattern of ten evaluations, each under a key of its own."""
    cfg = S.Thresholds(open_observations=open_n, resolve_observations=resolve_n)
    step = 10_000_000
    patterns = list(itertools.product([False, True], repeat=10))
    rows = [
        ("s", t * step, f"k{i:04d}")
        for i, pattern in enumerate(patterns)
        for t, hit in enumerate(pattern)
        if hit
    ]
    findings = spark.createDataFrame(rows, "site_id string, tick_us bigint, incident_key string")
    blank = {c: F.lit(None).cast("double") for c in L.FINDING_BODY}
    span = TickSpan(F.lit(0), F.lit(9 * step))
    got = L.lifecycle(findings.withColumns(blank), span, cfg).select(
        "incident_key",
        (F.unix_micros("observed_at") / step).cast("int").alias("t"),
        (F.unix_micros("start_time") / step).cast("int").alias("s"),
        "status",
        "state_revision",
        "positive_observations",
        "recovery_observations",
    )
    actual = sorted(tuple(r) for r in got.collect())
    expected = sorted(
        (f"k{i:04d}", *row)
        for i, pattern in enumerate(patterns)
        for row in step_by_step(list(pattern), open_n, resolve_n)
    )
    assert actual == expected


def test_uuid5_matches_the_standard_library(spark):
    frame = spark.createDataFrame([("a:b:2026-01-05T10:00:00+00:00",), ("é",)], "n string")
    for row in frame.select("n", uuid5(F.col("n")).alias("u")).collect():
        assert row["u"] == str(uuid.uuid5(uuid.NAMESPACE_URL, row["n"]))


def test_lookback_is_open_on_the_left_and_closed_on_the_right(spark):
    cadence = Cadence(60, 10)
    base = dt.datetime(2026, 1, 5, 10, tzinfo=UTC)
    times = [base, base + dt.timedelta(microseconds=1), base + dt.timedelta(seconds=7)]
    frame = spark.createDataFrame([(t,) for t in times], "t timestamp")
    rows = frame.select(
        F.unix_micros("t").alias("us"), F.explode(cadence.ticks_of(cadence.pane("t"))).alias("k")
    ).collect()
    got = {(r["us"], r["k"]) for r in rows}
    us = [int(t.timestamp() * 1_000_000) for t in times]
    want = {
        (u, k)
        for u in us
        for k in range(us[0] - 120_000_000, us[0] + 180_000_000, 10_000_000)
        if k - 60_000_000 < u <= k
    }
    assert got == want


def test_pane_width_that_does_not_divide_the_lookback(spark):
    cadence = Cadence(25, 10)
    frame = spark.range(0, 100).select(F.timestamp_micros(F.col("id") * 1_300_000).alias("t"))
    rows = frame.select(
        F.unix_micros("t").alias("us"), F.explode(cadence.ticks_of(cadence.pane("t"))).alias("k")
    )
    got = {tuple(r) for r in rows.collect()}
    want = {
        (u, k)
        for u in range(0, 130_000_000, 1_300_000)
        for k in range(-50_000_000, 200_000_000, 10_000_000)
        if k - 25_000_000 < u <= k
    }
    assert got == want


def test_sustained_stretches_cross_midnight(spark):
    start = dt.datetime(2026, 1, 5, 23, 50, tzinfo=UTC)
    flags = [1] * 80 + [0] + [1] * 4 + [0] * 3 + [1] * 9
    rows = [(start + dt.timedelta(seconds=15 * i), f) for i, f in enumerate(flags)]
    frame = spark.createDataFrame(rows, "ts timestamp, f int")
    out = K.sustained(frame, F.col("f") == 1, hold=120, step=15).orderBy("pending_since").collect()
    assert [r["evaluations"] for r in out] == [80, 9]
    seconds = (out[0]["firing_at"] - out[0]["pending_since"]).total_seconds()
    assert seconds == 120


def test_summary_role_comes_from_the_registry(spark):
    at = dt.datetime(2026, 1, 5, 10, 0, 5, tzinfo=UTC)
    rows = [("a", at, "router", "router_ping", True, 4.0, 0.0, None, None)] * 2
    frame = spark.createDataFrame(
        rows,
        "agent_id string, event_time timestamp, target_id string, measurement_type string, "
        "success boolean, latency_ms double, packet_loss_pct double, signal_dbm double, "
        "connected boolean",
    )
    agents = spark.createDataFrame([("a", S.WIFI)], "agent_id string, agent_role string")
    out = N.measurement_summary(frame, agents, Cadence(60, 10)).collect()
    assert len(out) == 6
    assert {(r["agent_role"], r["sample_count"], r["connected_rate_pct"]) for r in out} == {
        (S.WIFI, 2, None)
    }

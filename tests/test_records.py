"""Decoding, rules, deduplication and dead letters."""

from __future__ import annotations

import datetime as dt
import json

import pytest
from pyspark.sql import functions as F

from linkwatch import schemas as S
from linkwatch.operators import ingest as I
from linkwatch.operators import validate as V

UTC = dt.timezone.utc
AT = dt.datetime(2026, 1, 5, 10, 0, 0, tzinfo=UTC)
GOOD = {
    "event_id": "11111111-1111-4111-8111-111111111111",
    "event_type": S.MEASUREMENT,
    "schema_version": 1,
    "agent_id": "wired-0",
    "agent_role": S.WIRED,
    "event_time": "2026-01-05T10:00:00Z",
    "published_time": "2026-01-05T10:00:01Z",
    "sequence_number": 3,
    "source_version": "1.0.0",
    "measurement_type": "router_ping",
    "target_id": "router",
    "success": True,
    "latency_ms": 900.0,
    "packet_loss_pct": 0.0,
}
TOPIC = S.TOPICS[S.MEASUREMENT]


def records(spark, *payloads, key="wired-0"):
    rows = []
    for i, p in enumerate(payloads):
        text = p if isinstance(p, str) else json.dumps(p)
        rows.append((key.encode(), text.encode(), TOPIC, i % 3, i, AT + dt.timedelta(seconds=i)))
    return spark.createDataFrame(rows, S.KAFKA_SCHEMA)


def errors_of(spark, payload, **options):
    checked = V.checked_measurements(records(spark, payload, **options))
    return checked.collect()[0]["validation_errors"]


def test_anomalous_but_valid_and_unknown_fields_pass(spark):
    valid, invalid = V.split(records(spark, GOOD | {"future_field": "x"}), now=AT)
    row = valid.collect()[0]
    assert row["latency_ms"] == 900.0
    assert row["ingestion_latency_ms"] == 0.0
    assert invalid.count() == 0


def test_truncated_record_is_malformed(spark):
    assert "malformed_json" in errors_of(spark, json.dumps(GOOD)[:-9])


def test_non_numeric_number_is_malformed(spark):
    assert "malformed_json" in errors_of(spark, json.dumps(GOOD | {"latency_ms": float("nan")}))


def test_key_mismatch(spark):
    assert errors_of(spark, GOOD, key="other") == ["invalid:agent_key"]


@pytest.mark.parametrize(
    ("change", "error"),
    [
        ({"event_id": "nope"}, "invalid:event_id"),
        ({"sequence_number": -1}, "invalid:sequence_number"),
        ({"packet_loss_pct": 101}, "invalid:packet_loss_pct"),
        ({"success": False}, "invalid:failed_latency"),
        ({"measurement_type": "wifi_diagnostics"}, "missing:connected"),
        ({"agent_role": "container_probe"}, "invalid:agent_role"),
        ({"event_type": S.SERVICE_CHECK}, "unsupported:event_type"),
    ],
)
def test_single_rule(spark, change, error):
    assert errors_of(spark, GOOD | change) == [error]


def test_null_semantics_differ_only_on_missing_values(spark):
    payload = {k: v for k, v in GOOD.items() if k != "event_type"}
    frame = records(spark, payload)
    strict = V.checked_measurements(frame).collect()[0]["validation_errors"]
    loose = V.checked_measurements(frame, "three_valued").collect()[0]["validation_errors"]
    assert strict == ["unsupported:event_type"]
    assert loose == []


def test_payload_is_decoded_once(spark):
    checked = V.checked_measurements(records(spark, GOOD))
    plan = checked.where(F.size("validation_errors") == 0)._jdf.queryExecution().optimizedPlan()
    assert plan.toString().count("from_json") == 1


def mapping(spark, payload):
    frame = spark.createDataFrame([(json.dumps(payload),)], "t string")
    return frame.select(V.mapping_errors(F.col("t")).alias("e")).collect()[0]["e"]


def test_mapping_validator(spark):
    assert mapping(spark, GOOD) == []
    assert mapping(spark, {"success": True})[:2] == ["missing:agent_id", "missing:agent_role"]
    bad = GOOD | {
        "success": "yes",
        "packet_loss_pct": True,
        "sequence_number": 1.5,
        "event_time": "2026-01-05T10:00:00+02:00",
        "published_time": "later",
    }
    assert mapping(spark, bad) == [
        "invalid:success",
        "invalid:packet_loss_pct",
        "invalid:sequence_number",
        "not_utc:event_time",
        "invalid:published_time",
    ]


INCIDENT = {
    **{k: GOOD[k] for k in ("event_id", "schema_version", "event_time", "published_time",
                            "sequence_number", "source_version")},
    "event_type": S.INCIDENT,
    "agent_id": "classifier-01",
    "agent_role": "system_classifier",
    "incident_id": GOOD["event_id"],
    "incident_type": "wifi_outage",
    "start_time": "2026-01-05T10:00:00Z",
    "end_time": None,
    "status": "open",
    "severity": "critical",
    "confidence_score": 0.9,
    "affected_agents": ["wifi-0"],
    "affected_endpoints": [],
    "evidence": [{"agent_id": "wifi-0"}],
    "rule_version": "1.0.0",
    "summary": "s",
    "recommended_action": "a",
}


@pytest.mark.parametrize(
    ("change", "errors"),
    [
        ({}, []),
        ({"status": "resolved"}, ["missing:end_time"]),
        ({"end_time": "2026-01-05T09:00:00Z"}, ["order:end_time", "forbidden:end_time"]),
        ({"affected_agents": []}, ["missing:affected_agents"]),
        ({"evidence": []}, ["missing:evidence"]),
        ({"confidence_score": 1.5}, ["invalid:confidence_score"]),
        ({"start_time": "2026-01-05T10:00:00+01:00"}, ["not_utc:start_time"]),
    ],
)
def test_incident_contract(spark, change, errors):
    checked = V.checked_contract(records(spark, INCIDENT | change, key="classifier-01"))
    assert checked.collect()[0]["validation_errors"] == errors


def test_same_id_twice_and_same_coordinates_twice(spark):
    base = records(spark, GOOD, GOOD, "{", GOOD | {"event_id": GOOD["event_id"][:-1] + "2"})
    redelivered = base.unionByName(base.where("offset = 0"))
    outcomes = I.classify_outcome(V.checked_contract(redelivered))
    by_offset = {r["source_offset"]: (r["outcome"], r["deliveries"]) for r in outcomes.collect()}
    assert by_offset == {
        0: ("valid", 2),
        1: ("duplicate", 1),
        2: ("dead_lettered", 1),
        3: ("valid", 1),
    }
    totals = {r["outcome"]: r["records"] for r in I.outcome_counts(outcomes).collect()}
    assert totals == {"valid": 2, "duplicate": 2, "dead_lettered": 1}


def test_replay_against_the_log_inserts_nothing(spark):
    checked = V.checked_contract(records(spark, GOOD))
    log = I.raw_event_log(I.inserted_events(checked))
    assert log.count() == 1
    assert I.inserted_events(checked, log).count() == 0


def test_dead_letter_id_repeats_and_failures_merge(spark):
    checked = V.checked_contract(records(spark, "{"))
    first, second = (I.dead_letters(checked, now=AT + dt.timedelta(hours=h)) for h in (0, 1))
    a, b = first.collect()[0], second.collect()[0]
    assert a["dead_letter_id"] == b["dead_letter_id"]
    merged = I.merge_failures(
        I.fresh_failures(first, F.lit(AT)), I.fresh_failures(second, F.lit(AT + dt.timedelta(hours=1)))
    ).collect()[0]
    assert merged["attempt_count"] == 2
    assert merged["first_failed_at"] < merged["last_failed_at"]


def test_unknown_references(spark):
    agents = spark.createDataFrame([("wired-0", True), ("wifi-0", False)], "agent_id string, enabled boolean")
    points = spark.createDataFrame([("router", True)], "endpoint_id string, enabled boolean")
    frame = records(spark, GOOD, GOOD | {"agent_id": "wifi-0"}, GOOD | {"target_id": "moon"})
    rows = I.check_references(V.checked_contract(frame), agents, points)
    found = {r["source_offset"]: r["validation_errors"] for r in rows.collect()}
    assert found == {0: [], 1: ["unrecognized:agent_id"], 2: ["unrecognized:endpoint"]}

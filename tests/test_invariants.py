"""Constraints and reports on stored tables, connector options and progress lines."""

from __future__ import annotations

import datetime as dt
import json
import logging
from types import SimpleNamespace

import pytest
from pyspark.sql import functions as F

from linkwatch import schemas as S
from linkwatch.operators import ingest, slo
from linkwatch.operators import quality as Q
from linkwatch.sources import kafka, sinks
from linkwatch.streaming import jobs

START = dt.datetime(2026, 1, 5, 12)
LATER = START + dt.timedelta(hours=1)


def broken(rows, invariants):
    found = Q.violations(rows, "t", invariants).collect()
    return {r.rule_name: r.violations for r in found}


def test_incident_constraints(spark):
    rows = spark.createDataFrame(
        [
            ("a", START, None, "open"),
            ("a", START, LATER, "resolved"),
            ("a", START, None, "recovering"),
            ("b", LATER, START, "resolved"),
            ("b", START, None, "resolved"),
            ("c", START, LATER, "open"),
            ("d", START, None, "closed"),
        ],
        "incident_key string, start_time timestamp, end_time timestamp, status string",
    )
    assert broken(rows, Q.incident_invariants()) == {"time_order": 1, "resolved_end": 2, "state": 1}
    assert [r.incident_key for r in Q.open_incident_clashes(rows).collect()] == ["a"]
    with pytest.raises(ValueError, match="two open"):
        Q.require_none(Q.open_incident_clashes(rows), "two open")
    Q.require_none(Q.open_incident_clashes(rows.where("incident_key <> 'a'")), "two open")


def test_run_constraints(spark):
    day, after = START.date(), START.date() + dt.timedelta(days=1)
    rows = spark.createDataFrame(
        [
            (day, after, "running", None, 1),
            (after, day, "succeeded", LATER, 1),
            (day, day, "running", LATER, 1),
            (day, day, "failed", None, 0),
        ],
        "from_date date, through_date date, status string, completed_at timestamp, attempt_count int",
    )
    assert broken(rows, Q.run_invariants()) == {"range_order": 1, "running_open": 2, "attempts": 1}


def test_lifecycle_report(spark):
    incidents = spark.createDataFrame(
        [("old", "x", START, None, "open"), ("new", "x", LATER, LATER, "resolved"), ("y", "y", LATER, None, "open")],
        "incident_id string, incident_type string, start_time timestamp, end_time timestamp, status string",
    )
    steps = ["candidate", "open", "recovering", "resolved"]
    log = spark.createDataFrame(
        [(f"e{i}", "new", s) for i, s in enumerate(steps)] + [("e9", "y", "open")],
        "event_id string, incident_id string, status string",
    )

    def problems(log, acknowledged, kind):
        found = Q.lifecycle_invariants(incidents, log, acknowledged, kind).collect()
        return sorted(r.problem for r in found)

    assert problems(log, log, "x") == []
    assert problems(log, log.where("event_id <> 'e2'"), "x") == ["unpublished state events"]
    assert problems(log.where("status <> 'recovering'"), log, "x") == ["missing state recovering"]
    assert problems(log, log, "y") == [
        "missing state candidate", "missing state recovering", "missing state resolved",
        "newest incident is not resolved",
    ]


class Reader:
    """Takes down what a streaming reader is asked for."""

    def __init__(self):
        self.asked, self.kind = {}, None

    def format(self, kind):
        self.kind = kind
        return self

    def options(self, **options):
        self.asked |= options
        return self

    def load(self):
        return self


def test_stream_of_several_topics():
    options = kafka.kafka_options("h1:1,h2:2", ("a", "b"), fail_on_data_loss=False)
    got = kafka.kafka_source(SimpleNamespace(readStream=Reader()), options)
    assert got.kind == "kafka" and got.asked == {
        "kafka.bootstrap.servers": "h1:1,h2:2",
        "subscribe": "a,b",
        "startingOffsets": "earliest",
        "failOnDataLoss": "false",
        "groupIdPrefix": "linkwatch",
    }
    assert kafka.kafka_options("h")["subscribe"].split(",") == list(S.RAW_TOPICS)
    assert kafka.kafka_options("h")["failOnDataLoss"] == "true"
    sink = kafka.kafka_sink_options("h:1")
    assert sink["kafka.acks"] == "all" and sink["kafka.enable.idempotence"] == "true"


def test_progress_line(caplog):
    state = SimpleNamespace(numRowsTotal=7, numRowsUpdated=2, numRowsDroppedByWatermark=1)
    progress = SimpleNamespace(
        name="q", batchId=3, numInputRows=10, inputRowsPerSecond=5.0, processedRowsPerSecond=4.0,
        eventTime={"watermark": "2026-01-05T00:00:00.000Z"}, stateOperators=[state],
    )
    with caplog.at_level(logging.INFO, logger=jobs.log.name):
        jobs.ProgressLog().onQueryProgress(SimpleNamespace(progress=progress))
    line = json.loads(caplog.records[-1].getMessage())
    assert (line["query"], line["batch_id"], line["input_rows"]) == ("q", 3, 10)
    assert line["state"] == [{"rows": 7, "updated": 2, "dropped_late": 1}]
    assert line["event_time"] == progress.eventTime


def test_first_failure_stays_over_two_batches_and_a_compaction(spark, tmp_path):
    path = str(tmp_path / "log")
    keys = list(sinks.REJECT_KEYS)

    def batch(number, *rows):
        schema = "source_topic string, source_partition int, source_offset long, failed_at timestamp, error string"
        sinks.append_batch(spark.createDataFrame([("t", 0, *r) for r in rows], schema), path, number)

    batch(0, (1, START, "a"), (2, START, "b"))
    batch(1, (1, LATER, "c"), (3, LATER, "d"))
    batch(1, (1, LATER, "c"), (3, LATER, "d"))  # replayed
    rows = sinks.resolve_first_seen(spark.read.parquet(path)).orderBy("source_offset").collect()
    assert [(r.source_offset, r.error) for r in rows] == [(1, "c"), (2, "b"), (3, "d")]
    assert [r.first_failed_at == r.last_failed_at for r in rows] == [False, True, True]
    sinks.compact(spark.read.parquet(path), keys, f"{path}-small")
    batch(2, (2, LATER, "e"))
    small = spark.read.parquet(f"{path}-small")
    assert {r.source_offset: r.error for r in small.collect()} == {1: "c", 2: "b", 3: "d"}
    assert {r[sinks.BATCH] for r in small.collect()} == {-1}


def test_total_lag(spark):
    lags = spark.createDataFrame([(0, 3), (1, 4)], "partition int, lag long")
    assert slo.total_lag(lags).first().consumer_lag == 7
    assert slo.total_lag(lags.where("lag > 9")).first().consumer_lag == 0


def test_messages_of_dead_letters(spark):
    columns = [F.lit(c).alias(c) for c in dict.fromkeys(ingest.DEAD_LETTER_FIELDS)]
    letters = spark.range(1).select(*columns, F.lit("k").alias("source_key"), F.lit("no").alias("extra"))
    row = ingest.dead_letter_messages(letters).first()
    assert (row.topic, row.key) == (S.DEAD_LETTER_TOPIC, "k")
    body = json.loads(row.value)
    assert list(body) == sorted(ingest.DEAD_LETTER_FIELDS) and body["error_class"] == "error_class"

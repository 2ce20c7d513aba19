"""The streaming jobs against their batch counterparts."""

from __future__ import annotations

import datetime as dt
import json
import os

import pytest
from pyspark.sql import functions as F

from linkwatch import schemas as S
from linkwatch.functions.temporal import TickSpan
from linkwatch.operators import lifecycle as L
from linkwatch.operators import quality as Q
from linkwatch.operators import validate as V
from linkwatch.operators.windows import window_metrics
from linkwatch.sources import sinks
from linkwatch.sources.kafka import file_source
from linkwatch.streaming import jobs
from linkwatch.streaming.lifecycle import (
    STATE_STORE,
    finding_type,
    lifecycle_stream,
    losses_of,
    tick_rows,
    transitions_of,
)

from tests.test_incidents import step_by_step

UTC = dt.timezone.utc
START = dt.datetime(2026, 1, 5, 10, tzinfo=UTC)
TOPIC = S.TOPICS[S.MEASUREMENT]
BASE = 1_000_000  # first evaluation; a stream's watermark starts at 1970


def record(i: int, minute: float, **changes):
    payload = {
        "event_id": f"{i:08d}-1111-4111-8111-111111111111",
        "event_type": S.MEASUREMENT,
        "schema_version": 1,
        "agent_id": f"agent-{i % 2}",
        "agent_role": S.WIRED,
        "event_time": (START + dt.timedelta(minutes=minute)).isoformat(),
        "published_time": START.isoformat(),
        "sequence_number": i,
        "source_version": "1.0.0",
        "measurement_type": "router_ping",
        "target_id": "router",
        "success": i % 3 > 0,
        "latency_ms": i / 4 if i % 3 else None,
        "packet_loss_pct": 0.0 if i % 3 else 100.0,
    } | changes
    body = json.dumps({k: v for k, v in payload.items() if v is not None})
    return (None, body.encode(), TOPIC, i % 3, i, START + dt.timedelta(minutes=minute))


def land(spark, folder: str, batches) -> str:
    """One file per batch, their modification times in batch order."""
    for n, rows in enumerate(batches):
        staged = f"{folder}-stage-{n}"
        spark.createDataFrame(rows, S.KAFKA_SCHEMA).coalesce(1).write.parquet(staged)
        os.makedirs(folder, exist_ok=True)
        part = next(f for f in os.listdir(staged) if f.startswith("part-"))
        target = f"{folder}/{n:03d}.parquet"
        os.rename(f"{staged}/{part}", target)
        os.utime(target, (1_700_000_000 + n, 1_700_000_000 + n))
    return folder


def metric_rows(df):
    keep = [c for c in df.columns if c not in ("calculated_at", sinks.BATCH, "ingestion_latency_mean_ms")]
    # the deviation is merged batch by batch, so its last bits may differ
    df = df.withColumn("latency_stddev_ms", F.round("latency_stddev_ms", 9))
    return sorted(map(tuple, df.select(*sorted(keep)).collect()), key=str)


def test_in_order_stream_equals_batch_and_a_restart_adds_nothing(spark, tmp_path):
    batches = [[record(i, i * 2.0) for i in range(b * 10, b * 10 + 10)] for b in range(3)]
    batches[1].append(record(99, 25.0, packet_loss_pct=150.0))
    folder = land(spark, str(tmp_path / "in"), batches)
    out = str(tmp_path / "out")
    for _ in range(2):
        for q in jobs.start_measurement_queries(file_source(spark, folder, 1), out, now=START):
            q.awaitTermination()
    log = spark.read.parquet(f"{out}/metrics")
    stored = sinks.resolve_last(log, sinks.METRIC_KEYS)
    everything = spark.createDataFrame(sum(batches, []), S.KAFKA_SCHEMA)
    valid, _ = V.split(everything, now=START)
    assert metric_rows(stored) == metric_rows(window_metrics(valid))
    rejects = sinks.resolve_first_seen(spark.read.parquet(f"{out}/rejects"))
    assert [r["validation_errors"] for r in rejects.collect()] == [["invalid:packet_loss_pct"]]
    ledger = sinks.read_ledger(spark, f"{out}/ledger").groupBy("query_name").agg(F.sum("output_rows"))
    assert {r[0] for r in ledger.collect()} == {"window-metrics", "invalid-measurements"}
    agents = spark.createDataFrame([("agent-0",), ("agent-1",)], "agent_id string")
    assert Q.streaming_invariants(stored, rejects, agents).count() == 0


def test_late_rows_are_dropped_by_the_watermark(spark, tmp_path):
    # a trigger filters late rows by the watermark the trigger before it ran with
    batches = [[record(1, 0.0)], [record(2, 120.0)], [record(5, 121.0)], [record(4, 1.0)]]
    folder = land(spark, str(tmp_path / "in"), batches)
    out = str(tmp_path / "out")
    valid, _ = V.split(file_source(spark, folder, 1), now=START)
    query = jobs.start_query(
        window_metrics(valid, "15 minutes", sizes={"1 minute": 60}),
        sinks.metrics_writer(f"{out}/m", f"{out}/l"),
        name="late",
        checkpoint=f"{out}/c",
        mode="update",
    )
    query.awaitTermination()
    rows = sinks.resolve_last(spark.read.parquet(f"{out}/m"), sinks.METRIC_KEYS)
    starts = sorted((r["window_start"].hour, r["window_start"].minute) for r in rows.collect())
    assert starts == [(10, 0), (12, 0), (12, 1)]
    dropped = sum(s.numRowsDroppedByWatermark for p in query.recentProgress for s in p.stateOperators)
    assert dropped == 1


def test_stream_deduplicates_on_request(spark, tmp_path):
    folder = land(spark, str(tmp_path / "in"), [[record(1, 0.0)], [record(1, 0.0)]])
    out = str(tmp_path / "out")
    metrics, rejects = jobs.start_measurement_queries(
        file_source(spark, folder, 1), out, now=START, dedup=True
    )
    metrics.awaitTermination()
    rejects.awaitTermination()
    rows = sinks.resolve_last(spark.read.parquet(f"{out}/metrics"), sinks.METRIC_KEYS).collect()
    assert {r["event_count"] for r in rows} == {1}


@pytest.mark.parametrize("later_first", [False, True])
def test_keyed_state_lifecycle_equals_the_window_form(spark, tmp_path, later_first):
    step = 10_000_000
    hits = {"s1": ["110100111000", "001100000011"], "s2": ["101010101010", "111111000110"]}
    rows = [
        (site, (BASE + t) * step, f"k{i}")
        for site, patterns in hits.items()
        for i, pattern in enumerate(patterns)
        for t, flag in enumerate(pattern)
        if flag == "1"
    ]
    cfg = S.Thresholds(open_observations=2, resolve_observations=2)
    findings = spark.createDataFrame(
        rows, "site_id string, tick_us bigint, incident_key string"
    ).withColumns(
        {
            c: F.array(F.lit("x")) if c.startswith("affected") or c == "evidence" else F.lit("v")
            for c in L.FINDING_BODY
        }
    )
    span = TickSpan(F.lit(BASE * step), F.lit((BASE + 11) * step))
    landed = str(tmp_path / "ticks")
    for half in (0, 1):
        part = tick_rows(findings, span, cfg).where(
            (F.col("tick_us") < (BASE + 6) * step) == F.lit((half == 0) != later_first)
        )
        part.coalesce(1).write.mode("append").parquet(landed)
    files = sorted((f for f in os.listdir(landed) if f.startswith("part")),
                   key=lambda f: os.stat(f"{landed}/{f}").st_mtime)
    for n, f in enumerate(files):
        os.utime(f"{landed}/{f}", (1_700_000_000 + n, 1_700_000_000 + n))
    schema = spark.read.parquet(landed).schema
    ticks = spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).parquet(landed)
    out = str(tmp_path / "out")
    spark.conf.set(*STATE_STORE)
    try:
        jobs.start_query(
            lifecycle_stream(ticks, cfg, finding_type(findings)),
            lambda batch, n: sinks.append_batch(transitions_of(batch), f"{out}/t", n),
            name="lifecycle",
            checkpoint=f"{out}/c",
            mode="append",
        ).awaitTermination()
    finally:
        spark.conf.unset(STATE_STORE[0])
    columns = ["incident_id", "incident_key", "observed_at", "start_time", "end_time", "status",
               "state_revision", "positive_observations", "recovery_observations"]
    got = sorted(map(tuple, spark.read.parquet(f"{out}/t").select(*columns).collect()), key=str)
    want = sorted(map(tuple, L.lifecycle(findings, span, cfg).select(*columns).collect()), key=str)
    assert got == want


def test_a_missing_evaluation_does_not_stall_the_site(spark, tmp_path):
    """Evaluations 0 to 39, the sixth never comes, two come twice; a restart in between."""
    step, cfg = 10_000_000, S.Thresholds(open_observations=2, resolve_observations=2)
    pattern = [t % 7 < 4 for t in range(40)]
    findings = spark.createDataFrame(
        [("s", (BASE + t) * step, "k") for t, hit in enumerate(pattern) if hit],
        "site_id string, tick_us bigint, incident_key string",
    ).withColumns(
        {
            c: F.array(F.lit("x")) if c.startswith("affected") or c == "evidence" else F.lit("v")
            for c in L.FINDING_BODY
        }
    )
    rows = tick_rows(findings, TickSpan(F.lit(BASE * step), F.lit((BASE + 39) * step)), cfg)
    rows = rows.where(f"tick_us <> {(BASE + 5) * step}")
    rows = spark.createDataFrame(rows.collect(), rows.schema)
    landed, out = str(tmp_path / "ticks"), str(tmp_path / "out")
    spark.conf.set(*STATE_STORE)

    def run():
        ticks = spark.readStream.schema(rows.schema).option("maxFilesPerTrigger", 1).parquet(landed)
        query = jobs.start_query(
            lifecycle_stream(ticks, cfg, finding_type(findings), delay="0 seconds"),
            lambda batch, n: sinks.append_batch(batch, f"{out}/t", n),
            name="lifecycle-gap",
            checkpoint=f"{out}/c",
            mode="append",
        )
        query.awaitTermination()
        return query

    try:
        for low, high in ((0, 12), (12, 20), (20, 40)):
            part = rows.where(f"tick_us >= {(BASE + low) * step} and tick_us < {(BASE + high) * step}")
            if low == 12:
                part = part.unionByName(part.where(f"tick_us >= {(BASE + 18) * step}"))
            part.coalesce(1).write.mode("append").parquet(landed)
            query = run()
        state = query.recentProgress[-1].stateOperators[0]
        late = rows.where(f"tick_us = {(BASE + 3) * step}")
        late.coalesce(1).write.mode("append").parquet(landed)
        query = run()
        dropped = sum(s.numRowsDroppedByWatermark for p in query.recentProgress for s in p.stateOperators)
    finally:
        spark.conf.unset(STATE_STORE[0])
    assert dropped == 1
    # one row for the last tick, at most one active incident and nothing waiting
    assert state.numRowsTotal <= 4
    stored = spark.read.parquet(f"{out}/t")
    losses = sorted((r.kind, r.evaluations) for r in losses_of(stored).collect())
    assert losses == [("missing", 1), ("repeated", 2)]
    got = [
        (r.observed_at.timestamp() * 1e6 / step - BASE, r.status, r.state_revision)
        for r in transitions_of(stored).orderBy("observed_at").collect()
    ]
    made = [t for t in range(40) if t != 5]
    want = [
        (float(made[i]), status, revision)
        for i, _, status, revision, _, _ in step_by_step([pattern[t] for t in made], 2, 2)
    ]
    assert got == want


def test_cluster_must_name_the_shared_folder(spark, monkeypatch):
    from linkwatch import session

    class Context:
        master = "yarn"

        @staticmethod
        def getConf():
            return {}

    class Fake:
        sparkContext = Context()

        class conf:  # noqa: N801
            @staticmethod
            def get(key, default=None):
                return default

    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        session.shared_dir(Fake())


def test_package_reaches_workers(spark):
    from linkwatch import session

    session.ship_package(spark)

    def where(_):
        import sys

        return [any(p.endswith("linkwatch.zip") for p in sys.path)]

    assert all(spark.sparkContext.parallelize(range(2), 2).mapPartitions(where).collect())


def test_scratch_is_released(spark):
    from linkwatch import session
    from linkwatch.sources import files

    path = session.scratch_path(spark, "some")
    spark.range(3).write.parquet(path)
    assert files.exists(spark, path)
    assert session.release_scratch(spark) >= 1
    assert not files.exists(spark, path) and session.release_scratch(spark) == 0

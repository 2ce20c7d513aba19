"""Streaming alerts against the batch series and a plain evaluation."""

from __future__ import annotations

import datetime as dt
import random

from pyspark.sql import functions as F

from linkwatch.functions.temporal import MICROS, Cadence
from linkwatch.operators import slo as K
from linkwatch.sources import sinks
from linkwatch.streaming import jobs
from linkwatch.streaming.alerts import Alert, alert_stream, burning, growing, outcome_measures
from linkwatch.streaming.lifecycle import STATE_STORE

UTC = dt.timezone.utc
START = dt.datetime(2026, 1, 5, tzinfo=UTC)
CADENCE = Cadence(300, 60)
HOLD = 240
ALERTS = (
    Alert("burn", burning(20.0, CADENCE.lookback), HOLD),
    Alert("growth", growing("dead_lettered")),
)
SCHEMA = "series string, ts timestamp, outcome string"


def at(second: float) -> dt.datetime:
    return START + dt.timedelta(seconds=second)


def outcomes():
    """Two series with bad stretches; the second one is silent for long in between."""
    rng, rows = random.Random(5), []
    for second in range(0, 7200, 20):
        bad = 1500 < second < 3000 or 5000 < second < 5100
        rows.append(("a", at(second), "invalid" if bad and rng.random() < 0.6 else "valid"))
        if second < 1800 or second > 5400:
            rows.append(("b", at(second + 0.000001 * rng.randrange(3)), "valid"))
    rows += [("a", at(600), "dead_lettered"), ("b", at(6000.5), "dead_lettered")]
    return sorted(rows, key=lambda r: r[1])


def evaluated(rows, name, last):
    """Events by evaluating every tick of a series in order."""
    own = [(int((ts - START).total_seconds() * MICROS + 0.5), o) for s, ts, o in rows if s == name]
    step, events = CADENCE.step_us, []
    state = {a.name: None for a in ALERTS}
    tick = -(-own[0][0] // step) * step
    while tick <= last * MICROS:
        inside = [o for t, o in own if tick - CADENCE.lookback_us < t <= tick]
        sums = {
            "good": sum(o in K.GOOD for o in inside),
            "total": len(inside),
            "dead_lettered": inside.count("dead_lettered"),
        }
        for a in ALERTS:
            old = state[a.name]
            if a.holds(sums):
                since, n = (old[0], old[2] + 1) if old else (tick, 1)
                state[a.name] = (since, tick, n)
                if tick - since == a.wait_us(step):
                    events.append((name, a.name, "firing", tick, since, tick, n))
            elif old:
                state[a.name] = None
                if old[1] - old[0] >= a.wait_us(step):
                    events.append((name, a.name, "ended", tick, *old))
        tick += step
    return events


def us(value: dt.datetime) -> int:
    return round((value.replace(tzinfo=value.tzinfo or UTC) - START).total_seconds() * MICROS)


def collected(events):
    return sorted(
        (r.series, r.alert, r.kind, us(r.at), us(r.pending_since), us(r.last_true_at), r.evaluations)
        for r in events.collect()
    )


def test_alerts_over_restarts_and_silence(spark, tmp_path):
    rows = outcomes()
    landed, out = str(tmp_path / "log"), str(tmp_path / "out")
    before = spark.conf.get(STATE_STORE[0], None)
    spark.conf.set(*STATE_STORE)

    def run(part):
        for one in part:
            spark.createDataFrame(one, SCHEMA).coalesce(1).write.mode("append").parquet(landed)
        log = spark.readStream.schema(SCHEMA).option("maxFilesPerTrigger", 1).parquet(landed)
        query = jobs.start_query(
            alert_stream(
                log, ALERTS, CADENCE, outcome_measures("dead_lettered"),
                series=F.col("series"), delay="30 seconds",
            ),
            lambda batch, n: sinks.append_batch(batch, f"{out}/events", n),
            name="alerts",
            checkpoint=f"{out}/checkpoint",
            mode="append",
        )
        query.awaitTermination()
        return query

    try:
        third = len(rows) // 3
        run([rows[:third], rows[third : 2 * third]])
        query = run([rows[2 * third :], [(None, at(9030), None)]])
        panes = CADENCE.lookback_us // CADENCE.pane_us
        held = {s.operatorName: s.numRowsTotal for s in query.recentProgress[-1].stateOperators}
    finally:
        spark.conf.unset(STATE_STORE[0]) if before is None else spark.conf.set(STATE_STORE[0], before)
    got = collected(spark.read.parquet(f"{out}/events"))
    assert got == sorted(evaluated(rows, "a", 9000) + evaluated(rows, "b", 9000))
    kinds = {(r[0], r[1], r[2]) for r in got}
    # the silence of b fires its alert and traffic ends it; growth ends without new outcomes
    assert {("b", "burn", "firing"), ("b", "burn", "ended"), ("a", "growth", "ended")} <= kinds
    assert max(held.values()) <= 2 * (panes + len(ALERTS) + 2)


def test_batch_events_of_one_series(spark):
    rows = [r for r in outcomes() if r[0] == "a"]
    log = spark.createDataFrame(rows, SCHEMA).select("ts", "outcome")
    step = CADENCE.step_us
    first, last = us(at(0)), 7140 * MICROS
    zero = round(START.timestamp()) * MICROS

    class Span:
        first = F.lit(zero + us(at(0)))
        last = F.lit(zero + 7140 * MICROS)

    ratios = K.success_ratio(
        K.on_spine(K.success_counts(log, CADENCE), spark, Span, CADENCE, ("good", "total")), CADENCE
    )
    burn = K.sustained(K.burn(ratios), F.col("burn") > 20.0, hold=HOLD, step=CADENCE.step)
    events = K.alert_events(burn, Span.last, CADENCE.step)
    got = collected(events.select(F.lit("a").alias("series"), F.lit("burn").alias("alert"), "*"))
    assert first % step == 0 and last % step == 0
    assert got == sorted(e for e in evaluated(rows, "a", 7140) if e[1] == "burn")
    assert {e[2] for e in got} == {"firing", "ended"}

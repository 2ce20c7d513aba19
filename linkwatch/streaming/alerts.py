"""Service-level alerts as keyed state over a stream of processing outcomes.

Outcomes are counted per pane by a native aggregate, so a busy series reaches its
state as one row a pane.  The state of a series holds the panes of one lookback
and what each alert has seen; it is evaluated at every tick the watermark has
passed.  A timer stands at the next tick, so a series that falls silent is
evaluated as well and silence fires or ends its alerts.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence
from dataclasses import dataclass

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

from linkwatch import schemas as S
from linkwatch.functions.temporal import MICROS, Cadence, timestamp_of
from linkwatch.operators.slo import CLAMP, ENDED, ERROR_BUDGET, FIRING, GOOD

Sums = dict[str, int]


@dataclass(frozen=True)
class Alert:
    """Fires once ``holds`` was true at all evaluations of ``hold`` seconds."""

    name: str
    holds: Callable[[Sums], bool]
    hold: float = 0.0

    def wait_us(self, step_us: int) -> int:
        return -(-round(self.hold * MICROS) // step_us) * step_us


def burning(limit: float, lookback: float, budget: float = ERROR_BUDGET) -> Callable[[Sums], bool]:
    """The error budget burns faster than ``limit``; without traffic nothing succeeds."""

    def holds(sums: Sums) -> bool:
        ratio = (sums["good"] / lookback) / max(sums["total"] / lookback, CLAMP)
        return max(0.0, (1.0 - ratio) / budget) > limit

    return holds


def growing(measure: str) -> Callable[[Sums], bool]:
    return lambda sums: sums[measure] > 0


def outcome_measures(*counted: str) -> dict[str, Column]:
    """Good and all outcomes, and the number of each outcome in ``counted``."""
    one = {name: F.count_if(F.col("outcome") == name) for name in counted}
    return {
        "good": F.count_if(F.col("outcome").isin(*GOOD)),
        "total": F.count("outcome"),
    } | one


_OUTPUT = T.StructType(
    [
        T.StructField("series", T.StringType()),
        T.StructField("alert", T.StringType()),
        T.StructField("kind", T.StringType()),
        T.StructField("at_us", T.LongType()),
        T.StructField("since_us", T.LongType()),
        T.StructField("last_true_us", T.LongType()),
        T.StructField("evaluations", T.LongType()),
    ]
)


class AlertProcessor(StatefulProcessor):
    """The alerts of one series, advanced tick by tick behind the watermark."""

    def __init__(self, alerts: Sequence[Alert], measures: Sequence[str], cadence: Cadence) -> None:
        self._alerts = tuple(alerts)
        self._measures = tuple(measures)
        self._step = cadence.step_us
        self._lookback = cadence.lookback_us

    def init(self, handle: StatefulProcessorHandle) -> None:
        def fields(*names: str) -> T.StructType:
            return T.StructType([T.StructField(n, T.LongType()) for n in names])

        name = T.StructType([T.StructField("alert", T.StringType())])
        self._handle = handle
        self._panes = handle.getMapState("panes", fields("pane_us"), fields(*self._measures))
        self._seen = handle.getMapState("seen", name, fields("since_us", "last_us", "evaluations"))
        self._last = handle.getValueState("last_tick", fields("tick_us"))

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues):
        come: dict[int, tuple[int, ...]] = {}
        for frame in rows:
            if key[0] is None:
                continue  # rows of the clock have moved the watermark, nothing else
            counts = zip(*[frame[m].tolist() for m in self._measures], strict=True)
            come.update(zip(frame["pane_us"].tolist(), counts, strict=True))
        if come:
            yield from self._evaluated(key[0], come, timerValues)

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo):
        yield from self._evaluated(key[0], {}, timerValues)

    def _evaluated(self, series: str, come: dict, timerValues) -> Iterator[pd.DataFrame]:
        passed = timerValues.getCurrentWatermarkInMs() * 1000
        panes = {k[0]: tuple(v) for k, v in self._panes.iterator()}
        stored = set(panes)
        panes.update(come)
        seen = {k[0]: tuple(v) for k, v in self._seen.iterator()}
        before = dict(seen)
        if self._last.exists():
            last = self._last.get()[0]
        else:
            last = -(-min(panes) // self._step) * self._step - self._step
        out: list[tuple] = []
        while last + self._step <= passed:
            tick = last + self._step
            panes = {p: c for p, c in panes.items() if p > tick - self._lookback}
            # with no pane left all ticks up to the watermark are alike
            ticks = 1 if panes else (passed - last) // self._step
            inside = [c for p, c in panes.items() if p <= tick]
            sums = {m: sum(c[i] for c in inside) for i, m in enumerate(self._measures)}
            for alert in self._alerts:
                state, events = self._run(alert, seen.pop(alert.name, None), tick, ticks, sums)
                out += [(series, alert.name, *e) for e in events]
                if state:
                    seen[alert.name] = state
            last += ticks * self._step
        for pane in stored - panes.keys():
            self._panes.removeKey((pane,))
        for pane in panes.keys() - stored:
            self._panes.updateValue((pane,), panes[pane])
        for name in before.keys() - seen.keys():
            self._seen.removeKey((name,))
        for name, state in seen.items():
            if before.get(name) != state:
                self._seen.updateValue((name,), state)
        self._last.update((last,))
        # due as soon as the watermark reaches the next tick
        due = (last + self._step) // 1000 - 1
        if due not in set(self._timers()):
            self._handle.registerTimer(due)
        if out:
            yield pd.DataFrame(out, columns=_OUTPUT.fieldNames())

    def _timers(self) -> Iterator[int]:
        for t in self._handle.listTimers():
            yield t[0] if isinstance(t, tuple) else t

    def _run(
        self, alert: Alert, state: tuple | None, tick: int, ticks: int, sums: Sums
    ) -> tuple[tuple | None, list[tuple]]:
        """State after ``ticks`` equal evaluations from ``tick`` on, and what happened."""
        wait = alert.wait_us(self._step)
        if not alert.holds(sums):
            if state is None:
                return None, []
            since, last_true, n = state
            fired = last_true - since >= wait
            return None, [(ENDED, tick, since, last_true, n)] if fired else []
        since, _, n = state or (tick, tick, 0)
        last_true, fires = tick + (ticks - 1) * self._step, since + wait
        events = []
        if tick <= fires <= last_true:
            events.append((FIRING, fires, since, fires, wait // self._step + 1))
        return (since, last_true, n + ticks), events

    def close(self) -> None:
        pass


def alert_stream(
    log: DataFrame,
    alerts: Sequence[Alert],
    cadence: Cadence,
    measures: dict[str, Column],
    *,
    series: Column | None = None,
    delay: str = S.WATERMARK,
) -> DataFrame:
    """Events of a stream of outcomes (``ts``, ``outcome``) as ``slo.alert_events`` has them.

    A row with a null ``outcome`` is one of a clock: all up to its ``ts`` has been
    sent.  It counts nowhere and only moves the watermark, so alerts go on while
    no outcome arrives.  A series starts with its first outcome; what comes
    behind the watermark is dropped and counted in Spark's progress.
    """
    clock = F.col("outcome").isNull()
    at = F.when(clock, F.col("ts")).otherwise(F.timestamp_micros(F.unix_micros("ts") - 1))
    key = F.when(~clock, F.lit("all") if series is None else series)
    panes = (
        log.withColumn("pane_at", at)
        .withWatermark("pane_at", delay)
        .groupBy(
            key.alias("series"),
            F.window("pane_at", f"{cadence.pane_us} microseconds").alias("pane"),
        )
        .agg(*[value.cast("bigint").alias(name) for name, value in measures.items()])
    )
    events = (
        panes.withColumn("pane_us", F.unix_micros("pane.end"))
        .groupBy("series")
        .transformWithStateInPandas(
            statefulProcessor=AlertProcessor(alerts, list(measures), cadence),
            outputStructType=_OUTPUT,
            outputMode="append",
            timeMode="EventTime",
        )
    )
    return events.select(
        "series",
        "alert",
        "kind",
        timestamp_of("at_us").alias("at"),
        timestamp_of("since_us").alias("pending_since"),
        timestamp_of("last_true_us").alias("last_true_at"),
        "evaluations",
    )

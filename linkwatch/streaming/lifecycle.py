"""The incident lifecycle as keyed state over a stream of evaluations.

Evaluations of a site are taken in order.  One that waits for an evaluation
before it waits no longer than the watermark: when that passes the gap, a timer
closes it, the missing evaluations count as not made, and a side row says how
many they were.  So a lost evaluation neither stalls a site nor keeps state.
"""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

from linkwatch import schemas as S
from linkwatch.functions.temporal import TickSpan, explode_ticks, timestamp_of
from linkwatch.operators.lifecycle import (
    FINDING_BODY,
    ID_PREFIX,
    hits_to_open,
    incident_id,
    misses_to_resolve,
)
from linkwatch.operators.snapshot import cadence_of

# The state store that holds several named states per key.
STATE_STORE = (
    "spark.sql.streaming.stateStore.providerClass",
    "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
)

_STATE = T.StructType(
    [
        T.StructField("start_us", T.LongType()),
        T.StructField("status", T.StringType()),
        T.StructField("revision", T.LongType()),
        T.StructField("positives", T.LongType()),
        T.StructField("recoveries", T.LongType()),
        T.StructField("finding", T.StringType()),
    ]
)
# kinds of output rows: a state of an incident; evaluations that never came (their
# number is the revision) and evaluations delivered again
STATE, MISSING, REPEATED = "state", "missing", "repeated"
_OUTPUT = T.StructType(
    [
        T.StructField("kind", T.StringType()),
        T.StructField("site_id", T.StringType()),
        T.StructField("incident_key", T.StringType()),
        T.StructField("observed_us", T.LongType()),
        *_STATE.fields,
    ]
)


def tick_rows(
    findings: DataFrame, span: TickSpan, cfg: S.Thresholds, sites: DataFrame | None = None
) -> DataFrame:
    """One row per site and evaluation with its findings, none for a quiet one.

    Quiet evaluations drive recovery, so they are rows too.  Each row names the
    first evaluation that was due, so a stream can take them in any order without
    losing one and knows how many never came.  ``sites`` are those evaluated; left
    out, they are the sites with a finding.
    """
    step = cadence_of(cfg).step_us
    sites = (findings if sites is None else sites).select("site_id").distinct()
    spine = explode_ticks(sites, span.first, span.last, step)
    found = findings.groupBy("site_id", "tick_us").agg(
        F.collect_list(
            F.struct("incident_key", F.to_json(F.struct(*FINDING_BODY)).alias("finding"))
        ).alias("findings")
    )
    return spine.join(found, ["site_id", "tick_us"], "left").select(
        "site_id",
        "tick_us",
        span.first.alias("first_us"),
        F.to_json(
            F.map_from_entries(
                F.coalesce(
                    "findings",
                    F.array().cast("array<struct<incident_key:string,finding:string>>"),
                )
            )
        ).alias("findings"),
    )


class LifecycleProcessor(StatefulProcessor):
    """Active incidents of one site, advanced evaluation by evaluation.

    An evaluation waits in the state until the one before it has been taken or
    the watermark has passed all that could come between.  One that was taken
    already is a repeated delivery and changes nothing but a count.
    """

    def __init__(self, to_open: int, to_resolve: int, step_us: int) -> None:
        self._to_open = to_open
        self._to_resolve = to_resolve
        self._step_us = step_us

    def init(self, handle: StatefulProcessorHandle) -> None:
        key = T.StructType([T.StructField("incident_key", T.StringType())])
        tick = T.StructType([T.StructField("tick_us", T.LongType())])
        waiting = T.StructType(
            [
                T.StructField("tick_us", T.LongType()),
                T.StructField("first_us", T.LongType()),
                T.StructField("findings", T.StringType()),
            ]
        )
        self._handle = handle
        self._active = handle.getMapState("active", key, _STATE)
        # a list is read and written as a whole; each entry of a map would be a request
        self._waiting = handle.getListState("waiting", waiting)
        self._last = handle.getValueState("last_tick", tick)

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues):
        last, held = self._last_taken(), self._held()
        come: dict[int, tuple[int, str]] = {}
        repeated = 0
        for frame in rows:
            for tick, first, findings in zip(
                frame["tick_us"], frame["first_us"], frame["findings"]
            ):
                tick = int(tick)
                if tick in come or tick in held or (last is not None and tick <= last):
                    repeated += 1
                else:
                    come[tick] = (int(first), findings)
        yield from self._taken(key[0], last, held, come, repeated, timerValues)

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo):
        yield from self._taken(key[0], self._last_taken(), self._held(), {}, 0, timerValues)

    def _last_taken(self) -> int | None:
        return self._last.get()[0] if self._last.exists() else None

    def _held(self) -> dict[int, tuple[int, str]]:
        return {tick: (first, findings) for tick, first, findings in self._waiting.get()}

    def _taken(
        self, site: str, last: int | None, held: dict, come: dict, repeated: int, timerValues
    ) -> Iterator[pd.DataFrame]:
        """Take what is in order, counting new arrivals in, and wait for the rest."""
        # nothing before this can come any more; in micro-seconds
        passed = timerValues.getCurrentWatermarkInMs() * 1000
        stored = set(held)
        held.update(come)
        active = {k[0]: tuple(v) for k, v in self._active.iterator()}
        before = dict(active)
        nothing = (None, None, None, None)
        out = []
        if repeated:
            out.append((REPEATED, site, None, last, None, None, repeated, *nothing[1:]))
        for tick in sorted(held):
            first, findings = held[tick]
            due = first if last is None else last + self._step_us
            gap = (tick - due) // self._step_us
            if gap:
                if tick - self._step_us >= passed:
                    # fires when the watermark has gone past the last evaluation before this one
                    self._handle.registerTimer((tick - self._step_us) // 1000 + 1)
                    break
                out.append((MISSING, site, None, tick, None, None, gap, *nothing[1:]))
            del held[tick]
            last = tick
            out += [(STATE, *row) for row in self._advance(site, tick, _decode(findings), active)]
        new = [(tick, *held[tick]) for tick in sorted(held.keys() - stored)]
        if stored - held.keys():
            rest = [(tick, *held[tick]) for tick in sorted(held)]
            self._waiting.put(rest) if rest else self._waiting.clear()
        elif new:
            self._waiting.appendList(new)
        for name in before.keys() - active.keys():
            self._active.removeKey((name,))
        for name, state in active.items():
            if before.get(name) != state:
                self._active.updateValue((name,), state)
        if last is not None:
            self._last.update((last,))
        if out:
            yield pd.DataFrame(out, columns=_OUTPUT.fieldNames())

    def _advance(self, site: str, tick: int, found: dict, active: dict) -> list[tuple]:
        out = []
        for name in sorted(found.keys() | active.keys()):
            state = self._step(tick, active.get(name), found.get(name))
            out.append((site, name, tick, *state))
            if state[1] == "resolved":
                del active[name]
            else:
                active[name] = state
        return out

    def _step(self, tick: int, old: tuple | None, finding: str | None) -> tuple:
        if old is None:
            return tick, "candidate", 1, 1, 0, finding
        start, status, revision, positives, recoveries, kept = old
        if finding is None:
            recoveries += 1
            over = status == "candidate" or recoveries >= self._to_resolve
            return start, "resolved" if over else "recovering", revision + 1, positives, recoveries, kept
        positives += 1
        if status == "candidate":
            status = "open" if positives >= self._to_open else "candidate"
        else:
            status = "open" if status == "recovering" else "ongoing"
        return start, status, revision + 1, positives, 0, finding

    def close(self) -> None:
        pass


def _decode(text: str) -> dict:
    import json

    return json.loads(text) if text else {}


def lifecycle_stream(
    ticks: DataFrame,
    cfg: S.Thresholds,
    finding_type: T.DataType,
    prefix: str = ID_PREFIX,
    delay: str = S.WATERMARK,
) -> DataFrame:
    """Transitions of a stream of ``tick_rows``, as the batch operator lays them out.

    ``delay`` is how much later than the newest evaluation another one may
    come.  Spark drops what comes later still and counts it in its progress
    (``numRowsDroppedByWatermark``).  Rows whose ``kind`` is not ``STATE`` are
    counts of missing and repeated evaluations; ``transitions_of`` and
    ``losses_of`` part a written batch.
    """
    step = cadence_of(cfg).step_us
    processor = LifecycleProcessor(hits_to_open(cfg), misses_to_resolve(cfg), step)
    timed = ticks.withColumn("evaluated_at", timestamp_of("tick_us"))
    raw = timed.withWatermark("evaluated_at", delay).groupBy("site_id").transformWithStateInPandas(
        statefulProcessor=processor,
        outputStructType=_OUTPUT,
        outputMode="append",
        timeMode="EventTime",
    )
    start, at = timestamp_of("start_us"), timestamp_of("observed_us")
    return raw.select(
        incident_id(F.col("site_id"), F.col("incident_key"), start, prefix).alias("incident_id"),
        "site_id",
        "incident_key",
        at.alias("observed_at"),
        start.alias("start_time"),
        F.when(F.col("status") == "resolved", at).alias("end_time"),
        "status",
        F.col("revision").alias("state_revision"),
        F.col("positives").alias("positive_observations"),
        F.col("recoveries").alias("recovery_observations"),
        F.from_json("finding", finding_type).alias("finding"),
        "kind",
    ).select("*", "finding.*").drop("finding")


def transitions_of(rows: DataFrame) -> DataFrame:
    return rows.where(F.col("kind") == STATE).drop("kind")


def losses_of(rows: DataFrame) -> DataFrame:
    """How many evaluations of a site were missing before a tick or came again."""
    return rows.where(F.col("kind") != STATE).select(
        "site_id", "kind", "observed_at", F.col("state_revision").alias("evaluations")
    )


def finding_type(findings: DataFrame) -> T.StructType:
    return findings.select(*FINDING_BODY).schema

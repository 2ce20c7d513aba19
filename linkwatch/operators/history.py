"""Incident states over long histories as an associative scan.

The future of an incident depends on a handful of modes: none, a candidate with
its positives, active, or recovering with its misses.  A block of evaluations is
therefore a small table that maps the mode before the block to the mode after
it, with what it does to the incident's start, revision and positives.  Such
tables compose.  Blocks of a day are composed sixty-four at a time until one is
left, the states at the block starts flow back down, and every block is then
replayed on its own: no task ever holds or sorts the history of one key.

A block without a hit is not stored.  It is at least as long as a recovery, so
whatever was active before it has ended.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from linkwatch.session import landed

FAN = 64
_FAR = 1 << 61  # ticks to a hit that never comes
STATUSES = ("candidate", "open", "ongoing", "recovering", "resolved")
CANDIDATE, OPEN, ONGOING, RECOVERING, RESOLVED = range(5)

# mode, whether an incident started on the way, its start, revisions and positives
# (since the start, or more than before)
State = tuple[int, int, int, int, int]
NONE: State = (0, 0, 0, 0, 0)


@dataclass(frozen=True)
class Automaton:
    """Modes: 0 none, up to ``to_open`` - 1 a candidate's positives, ``to_open`` active,
    above that the misses of a recovery."""

    to_open: int
    to_resolve: int

    @property
    def modes(self) -> int:
        return self.to_open + self.to_resolve

    def hits(self, state: State, first: int, n: int) -> State:
        """The state after ``n`` hits in a row from tick ``first``."""
        mode, started, start, revisions, positives = state
        if mode == 0:
            started, start, revisions, positives = 1, first, 0, 0
        mode = min(mode + n, self.to_open) if mode < self.to_open else self.to_open
        return mode, started, start, revisions + n, positives + n

    def misses(self, state: State, n: int) -> State:
        """The state after ``n`` misses that follow a hit."""
        mode, started, start, revisions, positives = state
        if not n:
            return state
        if mode < self.to_open or n >= self.to_resolve:
            return NONE
        return mode + n, started, start, revisions + n, positives

    def block(self, ticks: np.ndarray, following: int) -> np.ndarray:
        """Table of a block's hits and the misses up to the hit ``following`` it."""
        cut = np.flatnonzero(np.diff(ticks) > 1) + 1
        first = ticks[np.r_[0, cut]].tolist()
        n = np.diff(np.r_[0, cut, len(ticks)]).tolist()
        nexts = [*first[1:], following]
        out = []
        for mode in range(self.modes):
            state: State = (mode, 0, 0, 0, 0)
            for at, length, then in zip(first, n, nexts, strict=True):
                state = self.misses(self.hits(state, at, length), then - at - length)
            out.append(state)
        return np.array(out, np.int64)

    def replay(self, state: State, ticks: list[int], following: int) -> Iterator[tuple]:
        """(tick, status, start, revision, positives, misses, last hit) of each evaluation."""
        for at, then in zip(ticks, [*ticks[1:], following], strict=True):
            before = state[0]
            state = self.hits(state, at, 1)
            mode, _, start, revision, positives = state
            if mode < self.to_open:
                status = CANDIDATE
            else:
                status = ONGOING if before == self.to_open else OPEN
            yield at, status, start, revision, positives, 0, at
            gap = then - at - 1
            last = 1 if mode < self.to_open else self.to_resolve
            for miss in range(1, min(gap, last) + 1):
                status = RESOLVED if miss == last else RECOVERING
                yield at + miss, status, start, revision + miss, positives, miss, at
            state = self.misses(state, gap)


def then(first: np.ndarray, second: np.ndarray) -> np.ndarray:
    """The table of two blocks in a row; associative."""
    after = second[first[:, 0]]
    both = first.copy()
    both[:, 0] = after[:, 0]
    both[:, 3:] += after[:, 3:]
    return np.where(after[:, 1:2] == 1, after, both)


def applied(table: np.ndarray, state: State) -> State:
    return tuple(then(np.array([state], np.int64), table)[0].tolist())


_KEY = ("site_id", "incident_key")
_STATE = ("mode", "started", "start", "revisions", "positives")
_STATE_TYPE = ", ".join(f"{c} long" for c in _STATE)


def _blocks(hits: DataFrame, automaton: Automaton, length: int) -> DataFrame:
    """Hits of every key and block, at most ``length`` of them, and the block's table."""
    place = F.expr(f"(tick - pmod(tick, {length})) div {length}")
    rows = hits.groupBy(*_KEY, place.alias("block")).agg(
        F.array_sort(F.collect_set("tick")).alias("ticks")
    )
    rows = landed(rows, "hit-blocks")
    following = rows.select(
        *_KEY, (F.col("block") - 1).alias("block"), F.col("ticks")[0].alias("following")
    )
    rows = rows.join(following, [*_KEY, "block"], "left").select(
        *_KEY, "block", "ticks", F.coalesce("following", F.lit(_FAR)).alias("following")
    )

    def build(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = zip(batch.column(3), batch.column(4).to_pylist(), strict=True)
            tables = [automaton.block(x.values.to_numpy(), n).tobytes() for x, n in found]
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, pa.array(tables, pa.binary())], names=[*batch.schema.names, "map"]
            )

    schema = (
        "site_id string, incident_key string, block long, ticks array<long>, following long, "
        "map binary"
    )
    return landed(rows.mapInArrow(build, schema), "block-maps")


def _grouped(level: DataFrame) -> DataFrame:
    """Rows of one group after each other, in order of their blocks; a group has ``FAN`` at most."""
    return level.repartition(*_KEY, "parent").sortWithinPartitions(*_KEY, "parent", "block")


def _composed(level: DataFrame, modes: int) -> DataFrame:
    """One row per group of ``FAN`` blocks: the table of all of them in a row."""
    ended = np.zeros((modes, 5), np.int64)

    def build(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        group, table, at = None, None, 0

        def out(rows: list[tuple]) -> pa.RecordBatch:
            columns = list(zip(*rows, strict=True)) or [()] * 4
            kinds = (pa.string(), pa.string(), pa.int64(), pa.binary())
            return pa.RecordBatch.from_arrays(
                [pa.array(c, k) for c, k in zip(columns, kinds, strict=True)],
                names=[*_KEY, "block", "map"],
            )

        def closed() -> tuple:
            whole = table if at == (group[2] + 1) * FAN - 1 else ended
            return *group, whole.tobytes()

        for batch in batches:
            rows = []
            for *own, block, blob in zip(*[c.to_pylist() for c in batch.columns], strict=True):
                new = np.frombuffer(blob, np.int64).reshape(-1, 5)
                if tuple(own) != group:
                    if group is not None:
                        rows.append(closed())
                    group = tuple(own)
                    # blocks missing before the first one end whatever was active
                    table = new if block == group[2] * FAN else then(ended, new)
                else:
                    table = then(table if block == at + 1 else ended, new)
                at = block
            yield out(rows)
        if group is not None:
            yield out([closed()])

    ordered = _grouped(level).select(*_KEY, "parent", "block", "map")
    return ordered.mapInArrow(build, "site_id string, incident_key string, block long, map binary")


def _pushed_down(level: DataFrame, states: DataFrame) -> DataFrame:
    """The state before every block, from the states before the groups."""

    def build(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        group, state, at = None, NONE, 0
        for batch in batches:
            found = []
            columns = [c.to_pylist() for c in batch.columns]
            for site, key, parent, block, blob, *before in zip(*columns, strict=True):
                if (site, key, parent) != group:
                    group = (site, key, parent)
                    state, at = tuple(before), parent * FAN - 1
                if block != at + 1:
                    state = NONE
                found.append(state)
                state, at = applied(np.frombuffer(blob, np.int64).reshape(-1, 5), state), block
            values = list(zip(*found, strict=True)) or [()] * 5
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), batch.column(3)]
                + [pa.array(v, pa.int64()) for v in values],
                names=[*_KEY, "block", *_STATE],
            )

    above = states.withColumnRenamed("block", "parent")
    rows = level.join(above, [*_KEY, "parent"])
    ordered = _grouped(rows).select(*_KEY, "parent", "block", "map", *_STATE)
    return ordered.mapInArrow(build, f"site_id string, incident_key string, block long, {_STATE_TYPE}")


def evaluations(hits: DataFrame, automaton: Automaton, length: int) -> DataFrame:
    """Every state of every incident, from hits (site_id, incident_key, tick).

    ``length`` is the number of ticks in a block, at least a recovery's.  Misses
    go on until the incident has ended, also beyond the last evaluation there is.
    """
    if length < automaton.to_resolve:
        raise ValueError("a block has to be at least as long as a recovery")
    blocks = _blocks(hits, automaton, length)
    level, levels = blocks.select(*_KEY, "block", "map"), []
    while True:
        ends = level.agg(F.min("block"), F.max("block")).first()
        if ends[0] == ends[1]:  # one block for every key, or none at all
            break
        level = level.withColumn("parent", F.floor(F.col("block") / FAN))
        levels.append(level)
        level = landed(_composed(level, automaton.modes), "composed-maps")
    states = level.select(*_KEY, "block", *[F.lit(x).cast("long").alias(c) for c, x in zip(_STATE, NONE)])
    for below in reversed(levels):
        states = landed(_pushed_down(below, states), "block-states")
    rows = blocks.drop("map").join(states, [*_KEY, "block"])

    def build(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                one = batch.slice(i, 1)
                site, key, ticks, following, *state = (c.to_pylist()[0] for c in one.columns)
                found = list(automaton.replay(tuple(state), ticks, following))
                columns = list(zip(*found, strict=True))
                n = len(found)
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array([site] * n, pa.string()),
                        pa.array([key] * n, pa.string()),
                        pa.array(columns[0], pa.int64()),
                        pa.array([STATUSES[s] for s in columns[1]], pa.string()),
                        *[pa.array(c, pa.int64()) for c in columns[2:]],
                    ],
                    names=[*_KEY, "tick", "status", "start", "revision", "positives", "miss", "hit"],
                )

    return rows.select(*_KEY, "ticks", "following", *_STATE).mapInArrow(
        build,
        "site_id string, incident_key string, tick long, status string, start long, "
        "revision long, positives long, miss long, hit long",
    )

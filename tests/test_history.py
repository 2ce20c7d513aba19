"""The associative scan of incident states."""

from __future__ import annotations

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from linkwatch.operators import history
from linkwatch.operators.history import NONE, STATUSES, Automaton, applied, evaluations, then
from tests.test_incidents import step_by_step

FAR = history._FAR


def folded(ticks, open_n, resolve_n):
    last = ticks[-1] + resolve_n + 2
    rows = step_by_step([t in set(ticks) for t in range(last)], open_n, resolve_n)
    return [(t, status, start, revision, positives, miss) for t, start, status, revision, positives, miss in rows]


TICKS = st.sets(st.integers(0, 60), min_size=1).map(sorted)


@settings(max_examples=200, deadline=None)
@given(TICKS, st.integers(2, 4), st.integers(2, 4), st.integers(4, 20))
def test_blocks_compose_to_the_fold(ticks, to_open, to_resolve, length):
    auto = Automaton(to_open, to_resolve)
    blocks: dict[int, list[int]] = {}
    for t in ticks:
        blocks.setdefault(t // length, []).append(t)
    state, got, tables = NONE, [], []
    for b, own in sorted(blocks.items()):
        following = blocks.get(b + 1, [FAR])[0]
        if b - 1 not in blocks:
            state = NONE
        got += [(t, STATUSES[s], *rest[:4]) for t, s, *rest in auto.replay(state, own, following)]
        table = auto.block(np.array(own), following)
        tables.append(table)
        state = applied(table, state)
    assert got == folded(ticks, to_open, to_resolve)
    if len(tables) > 2:
        left, right = then(then(tables[0], tables[1]), tables[2]), then(tables[0], then(tables[1], tables[2]))
        live = left[:, 0] > 0
        assert (left[live] == right[live]).all() and (left[:, 0] == right[:, 0]).all()


@pytest.mark.parametrize(("length", "fan"), [(4, 2), (4, 3), (50, 64)])
def test_levels_of_blocks(spark, rng_hits, monkeypatch, length, fan):
    monkeypatch.setattr(history, "FAN", fan)
    rows = [("s", key, t) for key, ticks in rng_hits.items() for t in ticks]
    hits = spark.createDataFrame(rows + rows[:5], "site_id string, incident_key string, tick long")
    got = evaluations(hits, Automaton(2, 3), length).drop("site_id", "hit")
    have = sorted(map(tuple, got.collect()))
    want = sorted(
        (key, t, status, start, revision, positives, miss)
        for key, ticks in rng_hits.items()
        for t, status, start, revision, positives, miss in folded(ticks, 2, 3)
    )
    assert have == want


@pytest.fixture
def rng_hits():
    import random

    rng = random.Random(3)
    dense = {f"d{i}": [t for t in range(200) if rng.random() < 0.2 + 0.2 * i] for i in range(4)}
    return dense | {"whole": list(range(150)), "one": [7], "ends": [0, 199], "edge": [3, 4, 7, 8, 16]}


def test_one_long_history_is_spread(spark):
    """One key with 60,000 hits: no task replays more than a few blocks."""
    hits = spark.range(60_000).select(
        F.lit("s").alias("site_id"), F.lit("k").alias("incident_key"), F.col("id").alias("tick")
    )
    rows = evaluations(hits, Automaton(2, 2), 300)
    last = rows.where("hit = 59999 and miss = 0").first()
    assert (last.start, last.revision, last.positives, last.status) == (0, 60_000, 60_000, "ongoing")
    assert rows.count() == 60_002
    tasks = rows.groupBy(F.floor(F.col("hit") / 300)).agg(F.count("*").alias("n"))
    assert tasks.agg(F.max("n")).first()[0] <= 302


def test_empty_and_short_blocks(spark):
    empty = spark.createDataFrame([], "site_id string, incident_key string, tick long")
    assert evaluations(empty, Automaton(2, 2), 10).count() == 0
    with pytest.raises(ValueError, match="as long as a recovery"):
        evaluations(empty, Automaton(2, 9), 8)

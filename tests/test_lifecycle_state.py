"""How often the keyed lifecycle asks the state store, without a stream."""

from __future__ import annotations

from types import SimpleNamespace

import pandas as pd

from linkwatch.streaming.lifecycle import MISSING, REPEATED, LifecycleProcessor

STEP = 10_000_000


class Store:
    """One named state as a list; counts requests."""

    def __init__(self):
        self.rows, self.calls = [], 0

    def get(self):
        self.calls += 1
        return list(self.rows)

    def put(self, rows):
        self.calls, self.rows = self.calls + 1, list(rows)

    def appendList(self, rows):
        self.calls, self.rows = self.calls + 1, self.rows + list(rows)

    def clear(self):
        self.calls, self.rows = self.calls + 1, []


class Value(Store):
    def exists(self):
        return bool(self.rows)

    def get(self):
        return self.rows[0]

    def update(self, row):
        self.rows = [row]


class Active:
    def iterator(self):
        return iter(())


def test_a_waiting_evaluation_is_no_request_of_its_own():
    waiting, timers = Store(), []
    processor = LifecycleProcessor(2, 2, STEP)
    processor.init(
        SimpleNamespace(
            getMapState=lambda *_: Active(),
            getValueState=lambda *_: Value(),
            getListState=lambda *_: waiting,
            registerTimer=timers.append,
        )
    )

    def sent(ticks, watermark=0):
        times = [t * STEP for t in ticks]
        frame = pd.DataFrame({"tick_us": times, "first_us": 0, "findings": None})
        clock = SimpleNamespace(getCurrentWatermarkInMs=lambda: watermark)
        found = processor.handleInputRows(("s",), iter([frame]), clock)
        return [r for f in found for r in f[["kind", "observed_us", "revision"]].itertuples(index=False)]

    assert sent(range(1, 800, 2)) == [] and len(waiting.rows) == 400
    # 3 and 5 come again; what is waiting is read and written once a call
    assert [(k, int(n)) for k, _, n in sent([3, 5, 2])] == [(REPEATED, 2)]
    assert len(waiting.rows) == 401 and waiting.calls <= 4 and timers
    assert sent([0]) == []  # takes 0 to 3 in order
    assert sorted(r[0] for r in waiting.rows)[0] == 5 * STEP
    # the watermark passes all: the missing ones before each are counted
    lost = sent([], watermark=10**9)
    assert {k for k, *_ in lost} == {MISSING} and sum(int(n) for *_, n in lost) == 398
    assert waiting.rows == [] and waiting.calls <= 8

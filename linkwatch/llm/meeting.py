"""Keys that two or more ids share."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame


def meeting(rows: DataFrame) -> DataFrame:
    """Rows (key, sid) of keys that two or more sids have, with the group's least sid as its pivot.

    Sorted rows stream through; a group is never held.
    """

    def group(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = None  # last row: key, sid, pivot, whether its group has been seen before it

        def out(k, s, p) -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays(
                [pa.array(k), pa.array(s), pa.array(p)], names=["key", "sid", "pivot"]
            )

        for batch in batches:
            k, s = (batch.column(i).to_numpy() for i in (0, 1))
            if not len(k):
                continue
            if held:
                k, s = np.r_[held[0], k], np.r_[held[1], s]
            new = np.r_[True, (k[1:] != k[:-1]) | (s[1:] != s[:-1])]
            k, s = k[new], s[new]
            same = k[1:] == k[:-1]
            start = np.flatnonzero(np.r_[True, ~same])
            pivot = np.repeat(s[start], np.diff(np.r_[start, len(k)]))
            joined = np.r_[bool(held and held[3]), same]
            if held:
                pivot[: start[1] if len(start) > 1 else len(k)] = held[2]
            keep = joined[:-1] | same
            yield out(k[:-1][keep], s[:-1][keep], pivot[:-1][keep])
            held = (k[-1], s[-1], pivot[-1], bool(joined[-1]))
        if held and held[3]:
            yield out(*[np.array([x]) for x in held[:3]])

    ordered = rows.repartition("key").sortWithinPartitions("key", "sid")
    return ordered.mapInArrow(group, "key long, sid long, pivot long")

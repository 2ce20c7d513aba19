"""Vector best-fit packing of token runs into fixed-length sequences.

A sequence has three capacities: tokens, documents and attention cost (the sum
of squared run lengths).  Only lengths matter for the fit, so the plan is made
on the histogram of run lengths, which has at most ``max_tokens`` entries
whatever the corpus.  Bins in the same state form one class with a multiplicity
and a step places one length into a whole class.  Rows then find their bin by
their rank among the rows of their length; the ranks are prefix sums of counts
per task, so no length is ever gathered in one place.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from linkwatch.llm.common import landed
from linkwatch.llm.tokens import encoder

SLICE = 512
PIECES = (
    "doc_id long, piece int, start long, length long, ids_crc32 long, part int, local_rank long"
)


@dataclass(frozen=True)
class Capacities:
    """Limits of a sequence; the last two default to what tokens alone allow.

    ``select`` is ``norm`` (smallest weighted norm of what stays free) or ``dot``
    (largest weighted dot product of need and free space); ``weights`` belong to
    tokens, documents and attention cost.
    """

    tokens: int = 1024
    documents: int | None = None
    attention: int | None = None
    select: str = "norm"
    weights: tuple[float, float, float] = (1.0, 0.0, 0.0)

    def vector(self) -> np.ndarray:
        docs = self.tokens if self.documents is None else self.documents
        cost = self.tokens**2 if self.attention is None else self.attention
        return np.array([self.tokens, docs, cost], np.int64)

    def longest_piece(self) -> int:
        """No run may be longer than a sequence takes, by tokens or by cost."""
        full = self.vector()
        return max(1, min(int(full[0]), int(np.sqrt(float(full[2])))))


def plan_bins(histogram: dict[int, int], limits: Capacities) -> np.ndarray:
    """Placements (length, first rank, count, first bin, offset) for every run.

    Runs of one length with ranks ``first .. first + count - 1`` go to the bins
    from ``first bin`` on, one each.  Longest lengths come first.
    """
    full = limits.vector().astype(np.float64)
    weights = np.array(limits.weights)
    free = np.empty((4096, 3))
    first = np.empty(4096, np.int64)
    many = np.zeros(4096, np.int64)
    used = np.empty(4096, np.int64)
    classes, bins, out = 0, 0, []

    def add(state: np.ndarray, start: int, count: int, tokens: int) -> None:
        nonlocal classes, free, first, many, used
        if classes == len(many):
            keep = np.flatnonzero(many[:classes])
            room = max(4096, 2 * len(keep))
            grown = [np.zeros((room, *x.shape[1:]), x.dtype) for x in (free, first, many, used)]
            for new, old in zip(grown, (free, first, many, used), strict=True):
                new[: len(keep)] = old[keep]
            free, first, many, used = grown
            classes = len(keep)
        free[classes], first[classes], many[classes], used[classes] = state, start, count, tokens
        classes += 1

    for length in sorted(histogram, reverse=True):
        need = np.array([length, 1, length * length], np.float64)
        left, rank = int(histogram[length]), 0
        while left:
            fits = np.flatnonzero((many[:classes] > 0) & (free[:classes] >= need).all(axis=1))
            if len(fits):
                if limits.select == "dot":
                    best = fits[np.argmax((free[fits] / full * need / full) @ weights)]
                else:
                    best = fits[np.argmin((((free[fits] - need) / full) ** 2) @ weights)]
                n = min(left, int(many[best]))
                out.append((length, rank, n, first[best], used[best]))
                state, start, tokens = free[best] - need, int(first[best]), int(used[best])
                first[best] += n
                many[best] -= n
                add(state, start, n, tokens + length)
                left, rank = left - n, rank + n
                continue
            each = int(min(full // need))
            if not each:
                raise ValueError(f"a run of {length} tokens exceeds the capacities")
            opened = max(1, left // each)
            here = min(left, each)
            for k in range(here):
                out.append((length, rank, opened, bins, k * length))
                left, rank = left - opened, rank + opened
            add(full - here * need, bins, opened, here * length)
            bins += opened
    return np.array(out, np.int64).reshape(-1, 5)


def cut_pieces(
    docs: DataFrame,
    tokenizer: str,
    end_id: int,
    longest: int,
    *,
    id_col: str = "doc_id",
    text_col: str = "text",
) -> DataFrame:
    """Token runs of every document with end id, cut at ``longest``; only the first is shorter.

    Written to the shared folder with the writing task and the rank among its
    runs of the same length.  Texts are tokenised where they are read and never
    shuffled.  A null or empty text is a run of the end id alone.
    """

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc = encoder(tokenizer, end_id)
        end, width = np.array([end_id], enc.dtype).tobytes(), enc.dtype.itemsize
        seen: dict[int, int] = {}
        part = TaskContext.get().partitionId()
        for batch in batches:
            for at in range(0, batch.num_rows, SLICE):
                rows = batch.slice(at, SLICE)
                out: list[list] = [[] for _ in range(7)]
                blobs = enc.encode(rows.column(1).to_pylist())
                for doc, blob in zip(rows.column(0).to_pylist(), blobs, strict=True):
                    ids = np.frombuffer(blob + end, enc.dtype).astype("<u4")
                    total = len(blob) // width + 1
                    stop, piece, start = (total - 1) % longest + 1, 0, 0
                    while start < total:
                        length = stop - start
                        rank = seen.get(length, 0)
                        seen[length] = rank + 1
                        crc = zlib.crc32(ids[start:stop].tobytes())
                        for column, x in zip(
                            out, (doc, piece, start, length, crc, part, rank), strict=True
                        ):
                            column.append(x)
                        start, stop, piece = stop, stop + longest, piece + 1
                kinds = [pa.int64(), pa.int32(), *[pa.int64()] * 3, pa.int32(), pa.int64()]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(x, k) for x, k in zip(out, kinds, strict=True)],
                    names=[x.split()[0] for x in PIECES.split(", ")],
                )

    narrow = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    return landed(narrow.mapInArrow(cut, PIECES), "token-runs")


def pack(pieces: DataFrame, limits: Capacities) -> DataFrame:
    """Give every run its sequence and the offset there.

    ``pieces`` comes from :func:`cut_pieces`.  The driver sees the histogram
    (at most ``limits.tokens`` rows) and sends back the plan, whose size also
    depends on the capacities alone.
    """
    counts = pieces.groupBy("length", "part").agg(F.count("*").alias("n"))
    before = Window.partitionBy("length").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    bases = counts.select(
        "length", "part", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("base")
    )
    histogram = {x.length: x.n for x in pieces.groupBy("length").agg(F.count("*").alias("n")).collect()}
    plan = plan_bins(histogram, limits)
    plan = plan[np.lexsort((plan[:, 1], plan[:, 0]))]
    sent = pieces.sparkSession.sparkContext.broadcast(plan)
    ranked = pieces.join(bases, ["length", "part"]).select(
        "doc_id",
        "piece",
        "start",
        "length",
        "ids_crc32",
        (F.col("base") + F.col("local_rank")).alias("rank"),
    )

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        steps = sent.value
        low = np.searchsorted(steps[:, 0], np.arange(int(steps[-1, 0]) + 2)) if len(steps) else None
        for batch in batches:
            length = batch.column("length").to_numpy()
            rank = batch.column("rank").to_numpy()
            row = np.empty(len(rank), np.int64)
            for x in np.unique(length):
                at = np.flatnonzero(length == x)
                a, b = low[x], low[x + 1]
                row[at] = a + np.searchsorted(steps[a:b, 1], rank[at], "right") - 1
            yield pa.RecordBatch.from_arrays(
                [
                    *batch.columns[:5],
                    pa.array(steps[row, 3] + rank - steps[row, 1]),
                    pa.array(steps[row, 4]),
                ],
                names=[*batch.schema.names[:5], "sequence_id", "offset"],
            )

    return ranked.mapInArrow(
        place,
        "doc_id long, piece int, start long, length long, ids_crc32 long,"
        " sequence_id long, offset long",
    )


def pack_documents(
    docs: DataFrame, tokenizer: str, end_id: int, limits: Capacities = Capacities(), **columns: str
) -> DataFrame:
    """Pack whole documents; empty tables give empty results."""
    return pack(cut_pieces(docs, tokenizer, end_id, limits.longest_piece(), **columns), limits)

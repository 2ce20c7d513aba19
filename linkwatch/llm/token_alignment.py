"""Alignment of two tokenizers' tokens over the bytes of one text.

Tokens of both tokenizers are laid over the same bytes.  Offsets where tokens of
both end cut them into groups; they are found by a galloping intersection: the
shorter list of ends drives an exponential and then a binary search into the
longer.  Within a group the ranks of a token's two ends in the other list give
the range of tokens it overlaps.

A text is cut before each blank that follows no blank and precedes a visible
character.  Both tokenizers always end a token there, so a stretch is aligned
once per worker and looked up afterwards; a text without such blanks is one
stretch and is searched whole.
"""

from __future__ import annotations

import hashlib
import os
import re
from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from linkwatch.llm.common import landed

_CUT = re.compile(r"(?<! ) (?=\S)")
_ODD = re.compile(r" (?=\s|\Z)")
CACHED_STRETCHES = 200_000
LONGEST_CACHED = 48
SLICE = 256
ROW = 1024
# keys that a task counts before it passes them on
COUNTED = 2_000_000
# the most frequent id pairs, sent to every executor as 16 bytes each; the others are joined
HEAD_PAIRS = 1 << 19


@dataclass(frozen=True)
class Tokenizers:
    """Files of a byte-level BPE (tokenizers library) and of a sentencepiece model."""

    byte_level: str
    pieces: str


def default_tokenizers() -> Tokenizers:
    import public_tokenizers

    path = public_tokenizers.path
    return Tokenizers(path("byte_bpe_50k.json"), path("piece_bpe_32k.model"))


def gallop(ends: np.ndarray, others: np.ndarray, low: np.ndarray) -> np.ndarray:
    """For each end the first place from its ``low`` on where ``others`` is not below it.

    All ends search at once: steps double until the place is passed, then the
    last step is halved.
    """
    low, n, step = low.copy(), len(others), 1
    high, active = low.copy(), np.arange(len(ends))
    while True:
        active = active[high[active] < n]
        active = active[others[high[active]] < ends[active]]
        if not len(active):
            break
        low[active] = high[active] + 1
        high[active] += step
        step *= 2
    np.minimum(high, n, out=high)
    active = np.flatnonzero(low < high)
    while len(active):
        middle = (low[active] + high[active]) // 2
        below = others[middle] < ends[active]
        low[active[below]] = middle[below] + 1
        high[active[~below]] = middle[~below]
        active = active[low[active] < high[active]]
    return low


def common_ends(
    a: np.ndarray, b: np.ndarray, cuts: np.ndarray | None = None
) -> tuple[np.ndarray, np.ndarray]:
    """Places in ``a`` and in ``b`` of the ends both rising lists have.

    The shorter list drives the search into the longer.  ``cuts`` are ends that
    are known to be common; a search starts behind the one before it.
    """
    if len(a) > len(b):
        return common_ends(b, a, cuts)[::-1]
    cuts = np.zeros(0, np.int64) if cuts is None else cuts
    behind = np.r_[0, np.searchsorted(b, cuts) + 1]
    at = gallop(a, b, behind[np.searchsorted(cuts, a)])
    found = np.flatnonzero(at < len(b))
    found = found[b[at[found]] == a[found]]
    return found, at[found]


def overlaps(a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """First and last token of ``b`` that share bytes with each token of ``a``: ranks of its ends."""
    return np.searchsorted(b, np.r_[0, a[:-1]], side="right"), np.searchsorted(b, a)


def _byte_level_alphabet() -> dict[str, int]:
    """Characters that stand for bytes: printable ones for themselves, others from U+0100 on."""
    plain = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    others = [b for b in range(256) if b not in set(plain)]
    return {chr(b): b for b in plain} | {chr(0x100 + i): b for i, b in enumerate(others)}


class Aligner:
    """Both tokenizers with the bytes of their tokens and the stretches seen so far.

    At most ``cached`` stretches are remembered, then the memory starts anew.
    """

    def __init__(self, files: Tokenizers, cached: int = CACHED_STRETCHES):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        import sentencepiece
        from tokenizers import Tokenizer

        self.a = Tokenizer.from_file(files.byte_level)
        self.a.encode_special_tokens = True
        alphabet = _byte_level_alphabet()
        vocabulary = self.a.get_vocab(with_added_tokens=True)
        self.bytes_a = [b""] * (max(vocabulary.values()) + 1)
        for token, number in vocabulary.items():
            self.bytes_a[number] = bytes(alphabet.get(c, 0x3F) for c in token)
        self.b = sentencepiece.SentencePieceProcessor(model_file=files.pieces)
        self.bytes_b = []
        for number in range(self.b.get_piece_size()):
            piece = self.b.id_to_piece(number)
            one = re.fullmatch("<0x([0-9A-F]{2})>", piece)
            self.bytes_b.append(
                bytes([int(one[1], 16)]) if one else piece.replace("▁", " ").encode()
            )
        self.length_a, self.length_b = (
            np.array([len(x) for x in spelled]) for spelled in (self.bytes_a, self.bytes_b)
        )
        # numbers as text, with what may follow them
        self.text_a, self.text_b = (
            [np.array([f"{i}{mark}" for i in range(len(spelled))], object) for mark in marks]
            for spelled, marks in ((self.bytes_a, ",|"), (self.bytes_b, ",;"))
        )
        self.cached = cached
        self.known: dict[str, tuple[bytes, str, bytes] | None] = {}

    def _spelled(self, a: list[int], b: list[int], raw: bytes) -> bool:
        return (
            b"".join(map(self.bytes_a.__getitem__, a)) == raw
            and b"".join(map(self.bytes_b.__getitem__, b)) == raw
        )

    def _laid(
        self, lengths: list[int], a: list[int], b: list[int]
    ) -> list[tuple[bytes, str, bytes]]:
        """Counts, group text and id pairs of each stretch; ``a`` and ``b`` spell them all in a row."""
        a, b, cuts = np.array(a), np.array(b), np.cumsum(lengths)
        ends_a, ends_b = np.cumsum(self.length_a[a]), np.cumsum(self.length_b[b])
        i, j = common_ends(ends_a, ends_b, cuts)
        first, last = overlaps(ends_a, ends_b)
        n = last - first + 1
        starts = np.cumsum(n) - n
        pairs = np.repeat(a.astype("<u8") << np.uint64(32), n)
        pairs |= b[np.repeat(first - starts, n) + np.arange(n.sum())].astype("<u8")
        # where each stretch ends in the lists of tokens, groups and pairs
        to_a, to_b = np.searchsorted(ends_a, cuts) + 1, np.searchsorted(ends_b, cuts) + 1
        to_group, to_pair = np.searchsorted(i, to_a), np.r_[starts, n.sum()][to_a]
        to = np.column_stack([to_a, to_b, to_group, to_pair])
        counts = np.diff(to, axis=0, prepend=np.zeros((1, 4), to.dtype)).astype("<u8").tobytes()
        # texts of the numbers, those of a group's two sides next to each other
        groups_a = np.searchsorted(i, np.arange(len(a)))
        groups_b = np.searchsorted(j, np.arange(len(b)))
        text = np.empty(len(a) + len(b), object)
        ends = [np.zeros(len(x), bool) for x in (a, b)]
        ends[0][i], ends[1][j] = True, True
        before_b, before_a = np.r_[0, j + 1][groups_a], (i + 1)[groups_b]
        text[np.arange(len(a)) + before_b] = np.where(ends[0], self.text_a[1][a], self.text_a[0][a])
        text[np.arange(len(b)) + before_a] = np.where(ends[1], self.text_b[1][b], self.text_b[0][b])
        text, blob = text.tolist(), pairs.tobytes()
        out, token, pair = [], 0, 0
        for k, (t, p) in enumerate(zip((to_a + to_b).tolist(), to_pair.tolist(), strict=True)):
            out.append(
                (counts[32 * k : 32 * k + 32], "".join(text[token:t]), blob[8 * pair : 8 * p])
            )
            token, pair = t, p
        return out

    def _learn(self, new: list[str], out: dict) -> None:
        """Align stretches; None for one that a tokenizer does not spell byte for byte."""
        alone, plain = [], []
        for x in new:
            odd = not x or x[0].isspace() or x[-1].isspace() or "\u2581" in x
            (alone if odd else plain).append(x)
        for at in range(0, len(plain), ROW):
            # stretches between visible characters keep their tokens in a row of them
            row = plain[at : at + ROW]
            text = " ".join(row)
            a = self.a.encode_batch_fast([" " + text], add_special_tokens=False)[0].ids
            b = self.b.encode(text)
            if not self._spelled(a, b, (" " + text).encode()):
                alone += row
                continue
            lengths = [1 + (len(x) if x.isascii() else len(x.encode())) for x in row]
            out.update(zip(row, self._laid(lengths, a, b), strict=True))
        for at in range(0, len(alone), ROW):
            row = alone[at : at + ROW]
            found = self.a.encode_batch_fast([" " + x for x in row], add_special_tokens=False)
            lengths, a, b, good = [], [], [], []
            for x, one, other in zip(row, found, self.b.encode(row, num_threads=1), strict=True):
                raw = (" " + x).encode()
                if not self._spelled(one.ids, other, raw):
                    out[x] = None
                    continue
                good.append(x)
                lengths.append(len(raw))
                a += one.ids
                b += other
            if good:
                out.update(zip(good, self._laid(lengths, a, b), strict=True))

    def stretches(self, text: str | None) -> list[str]:
        """Stretches of a blank and the text, without their first blank; none for no text."""
        if not text:
            return []
        whole = " " + text
        parts = _CUT.split(whole) if _ODD.search(whole) else whole.split(" ")
        return parts[1:] if not parts[0] else [parts[0][1:], *parts[1:]]

    def align(self, texts: list[str | None]) -> list[list[tuple[bytes, str, bytes] | None]]:
        """The aligned stretches of each text."""
        split = [self.stretches(t) for t in texts]
        if len(self.known) > self.cached:
            self.known.clear()
        wanted = {x for parts in split for x in parts}
        new = [x for x in wanted if x not in self.known]
        known, extra = self.known, {}
        self._learn([x for x in new if len(x) <= LONGEST_CACHED], known)
        self._learn([x for x in new if len(x) > LONGEST_CACHED], extra)
        if extra:
            return [[known[x] if x in known else extra[x] for x in parts] for parts in split]
        return [list(map(known.__getitem__, parts)) for parts in split]


@lru_cache(maxsize=2)
def _aligner(files: Tokenizers) -> Aligner:
    return Aligner(files)


ALIGNED = (
    "doc_id long, row long, n_a long, n_b long, n_groups long, n_links long, "
    "groups_sha256 string, pairs binary, links binary"
)


def alignments(docs: DataFrame, files: Tokenizers) -> DataFrame:
    """Counts, group digest and the distinct id pairs (with their links) of every row.

    ``row`` tells rows apart; it holds for one reading of the result, so write it first.
    """

    def build(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        aligner, number = _aligner(files), TaskContext.get().partitionId() << 33
        for batch in batches:
            for at in range(0, batch.num_rows, SLICE):
                rows = batch.slice(at, SLICE)
                counts, digests, pairs, links = [], [], [], []
                for parts in aligner.align(rows.column(1).to_pylist()):
                    if not parts or None in parts:
                        counts.append((0, 0, 0, 0))
                        digests.append("")
                        pairs.append(b"")
                        links.append(b"")
                        continue
                    n = np.frombuffer(b"".join([p[0] for p in parts]), "<u8").reshape(-1, 4)
                    counts.append(n.sum(axis=0).tolist())
                    digests.append(
                        hashlib.sha256("".join([p[1] for p in parts])[:-1].encode()).hexdigest()
                    )
                    found = np.frombuffer(b"".join([p[2] for p in parts]), "<u8")
                    keys, times = np.unique(found, return_counts=True)
                    pairs.append(keys.tobytes())
                    links.append(times.astype("<u4").tobytes())
                columns = list(zip(*counts, strict=True))
                yield pa.RecordBatch.from_arrays(
                    [
                        rows.column(0),
                        pa.array(np.arange(number, number + rows.num_rows)),
                        *[pa.array(c, pa.int64()) for c in columns],
                        pa.array(digests, pa.string()),
                        pa.array(pairs, pa.binary()),
                        pa.array(links, pa.binary()),
                    ],
                    names=[c.split()[0] for c in ALIGNED.split(", ")],
                )
                number += rows.num_rows

    return docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(build, ALIGNED)


def pair_counts(aligned: DataFrame) -> DataFrame:
    """(pair, n): how many rows hold each linked id pair; tasks add up before they shuffle."""

    def build(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def out(held: list[bytes]) -> pa.RecordBatch:
            keys, n = np.unique(np.frombuffer(b"".join(held), "<u8"), return_counts=True)
            return pa.RecordBatch.from_arrays(
                [pa.array(keys.view(np.int64)), pa.array(n.astype(np.int64))], names=["pair", "n"]
            )

        held, size = [], 0
        for batch in batches:
            for blob in batch.column(0).to_pylist():
                held.append(blob)
                size += len(blob)
                if size > 8 * COUNTED:
                    yield out(held)
                    held, size = [], 0
        yield out(held)

    partial = aligned.select("pairs").mapInArrow(build, "pair long, n long")
    return partial.groupBy("pair").agg(F.sum("n").alias("n"))


def _looked_up(table_keys, table_counts, keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Counts of keys and whether the sorted table has them."""
    if not len(table_keys):
        return np.zeros(len(keys), np.int64), np.zeros(len(keys), bool)
    at = np.minimum(np.searchsorted(table_keys, keys), len(table_keys) - 1)
    found = table_keys[at] == keys
    return np.where(found, table_counts[at], 0), found


def aligned_tokens(
    docs: DataFrame, files: Tokenizers | None = None, head_pairs: int = HEAD_PAIRS
) -> DataFrame:
    """Token alignment of every row of ``docs``; doc_id and text are read.

    Tokens come from a blank and the text.  A text that is null or empty, or
    that a tokenizer does not spell byte for byte, has no tokens: its counts are
    0 and its digest is ''.  Rows that repeat an id count one by one; an empty
    table gives no rows.  ``n_best`` and ``count_sum`` compare a row's links
    with the whole table: a pair's count is the number of rows that hold it.

    The ``head_pairs`` most frequent pairs are sent to the executors, all others
    are joined, each of which no more rows hold than any pair of the head.
    """
    files = files or default_tokenizers()
    spark = docs.sparkSession
    aligned = landed(alignments(docs, files), "token-alignments")
    counts = landed(pair_counts(aligned), "pair-counts")
    # one row per id of the first vocabulary
    best_of = counts.groupBy(F.shiftright("pair", 32).alias("a")).agg(F.max("n").alias("n")).collect()
    best = np.zeros(max((r.a for r in best_of), default=-1) + 1, np.int64)
    for r in best_of:
        best[r.a] = r.n
    cut = 0
    if counts.count() > head_pairs:
        last = counts.select("n").orderBy(F.desc("n")).limit(head_pairs + 1).agg(F.min("n"))
        cut = last.first()[0]
    head = counts.where(F.col("n") > cut).toArrow()
    keys, n = (head.column(c).to_numpy().astype(np.int64) for c in ("pair", "n"))
    order = np.argsort(keys)
    shared = spark.sparkContext.broadcast((keys[order], n[order], best))

    def unpacked(batch: pa.RecordBatch, first: int):
        blobs = batch.column(first).to_pylist()
        own = np.frombuffer(b"".join(blobs), "<u8").view(np.int64)
        times = np.frombuffer(b"".join(batch.column(first + 1).to_pylist()), "<u4")
        row = np.repeat(np.arange(len(blobs)), [len(x) // 8 for x in blobs])
        return own, times.astype(np.int64), row

    def add_up(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table_keys, table_counts, most = shared.value
        for whole in batches:
            for at in range(0, whole.num_rows, SLICE):
                batch = whole.slice(at, SLICE)
                own, times, row = unpacked(batch, 7)
                count, found = _looked_up(table_keys, table_counts, own)
                is_best = found & (count == most[own >> 32]) if len(own) else found
                sums = [np.zeros(batch.num_rows, np.int64) for _ in range(2)]
                np.add.at(sums[0], row, times * is_best)
                np.add.at(sums[1], row, times * count)
                yield pa.RecordBatch.from_arrays(
                    [*batch.columns[:7], *map(pa.array, sums)],
                    names=[*batch.schema.names[:7], "n_best", "count_sum"],
                )

    schema = ALIGNED.replace("pairs binary, links binary", "n_best long, count_sum long")
    out = aligned.mapInArrow(add_up, schema)
    if cut:

        def others(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            table_keys, table_counts, _ = shared.value
            for batch in batches:
                own, times, row = unpacked(batch, 1)
                rare = ~_looked_up(table_keys, table_counts, own)[1]
                rows = batch.column(0).to_numpy()[row[rare]]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(rows), pa.array(own[rare]), pa.array(times[rare])],
                    names=["row", "pair", "times"],
                )

        rare = aligned.select("row", "pairs", "links").mapInArrow(
            others, "row long, pair long, times long"
        )
        rows = spark.createDataFrame([(r.a, r.n) for r in best_of], "a long, most long")
        found = counts.where(F.col("n") <= cut).join(
            rows.hint("broadcast"), F.shiftright("pair", 32) == F.col("a")
        )
        more = (
            rare.join(found.select("pair", "n", "most"), "pair")
            .groupBy("row")
            .agg(
                F.sum(F.when(F.col("n") == F.col("most"), F.col("times")).otherwise(0)).alias("best"),
                F.sum(F.col("times") * F.col("n")).alias("sum"),
            )
        )
        out = out.join(more, "row", "left").select(
            *[c for c in out.columns if c not in ("n_best", "count_sum")],
            (F.col("n_best") + F.coalesce("best", F.lit(0))).alias("n_best"),
            (F.col("count_sum") + F.coalesce("sum", F.lit(0))).alias("count_sum"),
        )
    return out.drop("row")

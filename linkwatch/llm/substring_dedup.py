"""Repeated passages found with suffix automata of reference shards.

A passage of ``length`` words counts as repeated in a document when a document
with a smaller id has it too.  The whole corpus is the reference, so its
automata cannot be broadcast; they are built per shard and the passages that
could match travel to them:

1. Every window has an anchor, its word group of least hash.  Equal windows
   have equal anchors, so only windows whose anchor stands in two or more
   documents can repeat.
2. Consecutive windows of one such anchor form a segment.  Equal segments are
   one reference text, owned by the least id that has it.
3. The segments of an anchor are a shard.  In order of id each one streams
   through the automaton of those before it, whose matching statistics mark the
   windows found there, and then joins the automaton.  Anchors with very many
   segments are split by window, so a shard is bounded.
4. Marks go back to all documents with that segment, and words that a marked
   window covers are removed.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from linkwatch.llm.common import fresh, landed
from linkwatch.llm.meeting import meeting
from linkwatch.llm.shingles import STEP, Words, mix, windows

_U = np.uint64
SLICE = 256
LONGEST_RUN = 32
SENT = 1_000_000
STEP_INVERSE = _U(pow(int(STEP), -1, 1 << 64))


@dataclass(frozen=True)
class Passages:
    """Window length and anchor length in words, and the most segments of a shard."""

    length: int = 13
    anchor: int = 5
    shard: int = 1000


class Automaton:
    """Suffix automaton of several word sequences with the least owner of every state.

    Sequences must come in ascending order of owner; then a state's owner is
    the one that made it.
    """

    def __init__(self):
        self.next: list[dict[bytes, int]] = [{}]
        self.link, self.length, self.owner = [-1], [0], [None]

    def _state(self, follow: dict[bytes, int], link: int, length: int, owner: int) -> int:
        self.next.append(follow)
        self.link.append(link)
        self.length.append(length)
        self.owner.append(owner)
        return len(self.link) - 1

    def _split(self, p: int, w: bytes, q: int) -> int:
        """The part of state q that ends in w after p, as a state of its own."""
        copy = self._state(dict(self.next[q]), self.link[q], self.length[p] + 1, self.owner[q])
        while p != -1 and self.next[p].get(w) == q:
            self.next[p][w] = copy
            p = self.link[p]
        self.link[q] = copy
        return copy

    def add(self, words: list[bytes], owner: int) -> None:
        last = 0
        for w in words:
            q = self.next[last].get(w)
            if q is not None:
                last = q if self.length[q] == self.length[last] + 1 else self._split(last, w, q)
                continue
            new, p = self._state({}, 0, self.length[last] + 1, owner), last
            while p != -1 and w not in self.next[p]:
                self.next[p][w] = new
                p = self.link[p]
            if p != -1:
                q = self.next[p][w]
                whole = self.length[q] == self.length[p] + 1
                self.link[new] = q if whole else self._split(p, w, q)
            last = new

    def repeated(self, words: list[bytes], owner: int, length: int) -> int:
        """Bit i: the ``length`` words from i on belong to a smaller owner.

        The match is kept at ``length`` words, so the state is that of the window.
        """
        state = matched = marks = 0
        for i, w in enumerate(words):
            while state and w not in self.next[state]:
                state = self.link[state]
                matched = self.length[state]
            state = self.next[state].get(w, 0)
            matched = matched + 1 if state else 0
            if matched >= length:
                while self.length[self.link[state]] >= length:
                    state = self.link[state]
                matched = length
                if self.owner[state] < owner:
                    marks |= 1 << (i - length + 1)
        return marks


def _anchors(words: Words, rule: Passages) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Places of all windows, their texts and their anchors."""
    groups = windows(words.hash, rule.anchor)
    n = len(words.hash) - rule.length + 1
    if n <= 0:
        return np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, _U)
    least = groups[:n].copy()
    for k in range(1, rule.length - rule.anchor + 1):
        np.minimum(least, groups[k : k + n], out=least)
    text = np.repeat(np.arange(len(words.first) - 1), np.diff(words.first))
    place = np.flatnonzero(text[:n] == text[rule.length - 1 :])
    return place, text[place], least[place]


def anchor_rows(docs: DataFrame, rule: Passages) -> DataFrame:
    """(key, sid): each anchor of each document once."""

    def build(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, SLICE):
                rows = batch.slice(at, SLICE)
                words = Words(rows.column(1).cast(pa.binary()).to_pylist())
                _, text, anchor = _anchors(words, rule)
                new = np.r_[True, (anchor[1:] != anchor[:-1]) | (text[1:] != text[:-1])]
                new = new[: len(anchor)]
                anchor, text = anchor[new], text[new]
                _, once = np.unique(anchor ^ mix(text.astype(_U) + _U(7)), return_index=True)
                ids = rows.column(0).to_numpy()
                yield pa.RecordBatch.from_arrays(
                    [pa.array(anchor[once].view(np.int64)), pa.array(ids[text[once]])],
                    names=["key", "sid"],
                )

    return docs.mapInArrow(build, "key long, sid long")


SEGMENTS = "anchor long, name long, doc long, row long, start int, n int, words binary"


def segments(docs: DataFrame, rule: Passages) -> DataFrame:
    """Runs of windows with one repeated anchor; a task sends equal texts once.

    ``docs`` has doc, row, text and the document's repeated anchors.
    """

    def build(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sent: set[tuple[int, int]] = set()
        for batch in batches:
            for at in range(0, batch.num_rows, SLICE):
                rows = batch.slice(at, SLICE)
                words = Words(rows.column(2).cast(pa.binary()).to_pylist())
                place, text, anchor = _anchors(words, rule)
                kept = np.zeros(len(anchor), bool)
                bounds = np.searchsorted(text, np.arange(rows.num_rows + 1))
                for i, own in enumerate(rows.column(3)):
                    a, b = bounds[i], bounds[i + 1]
                    own = own.values.to_numpy(zero_copy_only=False).view(_U)
                    kept[a:b] = np.isin(anchor[a:b], own)
                place, text, anchor = place[kept], text[kept], anchor[kept]
                if not len(place):
                    continue
                new = (anchor[1:] != anchor[:-1]) | (place[1:] != place[:-1] + 1)
                new |= text[1:] != text[:-1]
                head = np.flatnonzero(np.r_[True, new])
                run = np.arange(len(place)) - np.repeat(head, np.diff(np.r_[head, len(place)]))
                head = np.flatnonzero(run % LONGEST_RUN == 0)
                count = np.diff(np.r_[head, len(place)])
                first, text, anchor = place[head], text[head], anchor[head].view(np.int64)
                last = first + count + rule.length - 2
                size = len(words.hash)
                up = np.cumprod(np.r_[_U(1), np.full(size, STEP)], dtype=_U)
                down = np.cumprod(np.r_[_U(1), np.full(size, STEP_INVERSE)], dtype=_U)
                sums = np.r_[_U(0), np.cumsum(words.hash * up[:size], dtype=_U)]
                name = mix((sums[last + 1] - sums[first]) * down[first] + count.astype(_U))
                name = name.view(np.int64)
                spans = zip(words.start[first].tolist(), words.end[last].tolist(), strict=True)
                payload = []
                for key, (x, y) in zip(
                    zip(anchor.tolist(), name.tolist(), strict=True), spans, strict=True
                ):
                    if key in sent:
                        payload.append(None)
                    else:
                        payload.append(words.data[x:y])
                        sent.add(key)
                if len(sent) > SENT:
                    sent.clear()
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(anchor),
                        pa.array(name),
                        pa.array(rows.column(0).to_numpy()[text]),
                        pa.array(rows.column(1).to_numpy()[text]),
                        pa.array((first - words.first[text]).astype(np.int32)),
                        pa.array(count.astype(np.int32)),
                        pa.array(payload, pa.binary()),
                    ],
                    names=[x.split()[0] for x in SEGMENTS.split(", ")],
                )

    return docs.mapInArrow(build, SEGMENTS)


def references(found: DataFrame) -> DataFrame:
    """Each distinct segment with its least owner; combined in the tasks before the shuffle."""

    def combine(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        least: dict[tuple[int, int], int] = {}
        texts: dict[tuple[int, int], bytes] = {}

        def out() -> pa.RecordBatch:
            keys = list(least)
            batch = pa.RecordBatch.from_arrays(
                [
                    pa.array([k[0] for k in keys], pa.int64()),
                    pa.array([k[1] for k in keys], pa.int64()),
                    pa.array([least[k] for k in keys], pa.int64()),
                    pa.array([texts.get(k) for k in keys], pa.binary()),
                ],
                names=["anchor", "name", "doc", "words"],
            )
            least.clear()
            texts.clear()
            return batch

        for batch in batches:
            for a, n, d, w in zip(*[batch.column(i).to_pylist() for i in range(4)], strict=True):
                key = (a, n)
                old = least.get(key)
                if old is None or d < old:
                    least[key] = d
                if w is not None:
                    texts[key] = w
            if len(least) > SENT // 4:
                yield out()
        yield out()

    rows = found.select("anchor", "name", "doc", "words").mapInArrow(
        combine, "anchor long, name long, doc long, words binary"
    )
    return rows.groupBy("anchor", "name").agg(
        F.min("doc").alias("doc"), F.max("words").alias("words")
    )


def marks(texts: DataFrame, rule: Passages) -> DataFrame:
    """Windows of each reference segment that a smaller owner has: (anchor, name, bits)."""
    crowded = texts.groupBy("anchor").agg(F.count("*").alias("many"))
    crowded = crowded.where(F.col("many") > rule.shard)
    rows = texts.join(crowded, "anchor", "left").select(
        "anchor", "name", "doc", "words", F.col("many").isNotNull()
    )

    def route(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out: list[tuple] = []
            for a, n, d, w, split in zip(
                *[batch.column(i).to_pylist() for i in range(5)], strict=True
            ):
                if not split:
                    out.append((a, d, a, n, 0, w))
                    continue
                words = w.split()
                hashes = windows(Words([w]).hash, rule.length).view(np.int64).tolist()
                out += [
                    (h, d, a, n, i, b" ".join(words[i : i + rule.length]))
                    for i, h in enumerate(hashes)
                ]
            columns = list(zip(*out, strict=True)) or [()] * 6
            kinds = [*[pa.int64()] * 4, pa.int32(), pa.binary()]
            yield pa.RecordBatch.from_arrays(
                [pa.array(x, k) for x, k in zip(columns, kinds, strict=True)],
                names=["shard", "doc", "anchor", "name", "at", "words"],
            )

    def match(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shard, automaton, waiting = None, None, None
        for batch in batches:
            found = []
            for s, d, a, n, at, w in zip(
                *[batch.column(i).to_pylist() for i in range(6)], strict=True
            ):
                if s != shard:
                    shard, automaton, waiting = s, None, (w, d)
                    continue
                if automaton is None:
                    automaton = Automaton()
                    automaton.add(waiting[0].split(), waiting[1])
                words = w.split()
                bits = automaton.repeated(words, d, rule.length)
                if bits:
                    found.append((a, n, bits << at))
                if bits.bit_count() < len(words) - rule.length + 1:
                    automaton.add(words, d)
            yield pa.RecordBatch.from_arrays(
                [pa.array([x[i] for x in found], pa.int64()) for i in range(3)],
                names=["anchor", "name", "bits"],
            )

    routed = rows.mapInArrow(
        route, "shard long, doc long, anchor long, name long, at int, words binary"
    )
    ordered = routed.repartition("shard").sortWithinPartitions("shard", "doc", "name", "at")
    found = ordered.mapInArrow(match, "anchor long, name long, bits long")
    return found.groupBy("anchor", "name").agg(F.bit_or("bits").alias("bits"))


def deduplicated(docs: DataFrame, rule: Passages = Passages()) -> DataFrame:
    """The documents with repeated passages cut out of ``text``.

    Returns the columns of ``docs`` and the words before and removed, as the
    last two columns, whatever their names.  A text that loses nothing stays as
    it is; in others a removed stretch leaves a line feed if it held one, else a
    blank.  Windows are judged on the input, not on what is left.  A null text
    becomes empty.  Rows that repeat an id are one document:
    none of them is cut because of another.  Rows without an id are left whole.
    An empty table gives an empty one.
    """
    row = fresh(docs.columns, "row_key")
    keyed = docs.withColumn(row, F.xxhash64(F.col("doc_id").cast("long"), "text"))
    narrow = keyed.select(
        F.col("doc_id").cast("long").alias("doc"), F.col(row).alias("row"), F.col("text")
    ).where(F.col("doc").isNotNull() & F.col("text").isNotNull())
    shared = landed(
        meeting(anchor_rows(narrow.select("doc", "text"), rule)).select("key", "sid"), "anchors"
    )
    wanted = shared.groupBy("sid").agg(F.collect_list("key").alias("anchors"))
    joined = narrow.join(wanted, F.col("doc") == F.col("sid"))
    found = landed(segments(joined.select("doc", "row", "text", "anchors"), rule), "segments")
    texts = landed(references(found), "references")
    bits = marks(texts, rule)
    owners = texts.select("anchor", "name", F.col("doc").alias("owner"))
    # written first, so that the join below shuffles both sides itself and can split hot segments
    owners = landed(owners.join(bits, ["anchor", "name"], "left"), "owners")
    spans = found.select("anchor", "name", "doc", "row", "start", "n").join(
        owners, ["anchor", "name"]
    )
    every = F.expr("shiftleft(1L, n) - 1")
    hit = F.when(F.col("doc") > F.col("owner"), every).otherwise(F.coalesce("bits", F.lit(0)))
    spans = spans.select("row", "start", hit.alias("bits")).where("bits <> 0")
    spans = spans.groupBy("row").agg(F.collect_list(F.struct("start", "bits")).alias("spans"))
    return cut(keyed, row, landed(spans, "spans"), rule)


def cut(keyed: DataFrame, row: str, spans: DataFrame, rule: Passages) -> DataFrame:
    spans = spans.select(F.col("row").alias(row), F.col("spans").alias(f"{row}_spans"))
    joined = keyed.join(spans, row, "left")
    plain = [c for c in keyed.columns if c != row]
    before, removed = fresh(plain, "n_words"), fresh(plain, "n_removed")
    at = plain.index("text")
    schema = keyed.select(*plain).schema.add(before, "long").add(removed, "long")

    def kept(text: bytes, found: list[dict]) -> tuple[bytes, int, int]:
        words = Words([text])
        n = len(words.hash)
        change = np.zeros(n + 1, np.int64)
        for span in found:
            start, bits = span["start"], span["bits"]
            while bits:
                low = (bits & -bits).bit_length() - 1
                change[start + low] += 1
                change[start + low + rule.length] -= 1
                bits &= bits - 1
        covered = np.cumsum(change[:-1]) > 0
        edge = np.flatnonzero(np.diff(np.r_[True, covered, True]))
        out, last = [], None
        for a, b in edge.reshape(-1, 2).tolist():  # runs of kept words
            start, end = int(words.start[a]), int(words.end[b - 1])
            if last is not None:
                out.append(b"\n" if b"\n" in text[last:start] else b" ")
            out.append(text[start:end])
            last = end
        return b"".join(out), n, int(covered.sum())

    def clean(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out, total, gone = [], [], []
            texts = batch.column(at).cast(pa.binary()).to_pylist()
            for text, found in zip(texts, batch.column(len(plain)), strict=True):
                text = text or b""
                if found.is_valid:
                    text, n, lost = kept(text, found.as_py())
                else:
                    n, lost = len(text.split()), 0
                out.append(text)
                total.append(n)
                gone.append(lost)
            columns = [*batch.columns[: len(plain)]]
            columns[at] = pa.array(out, pa.binary()).cast(pa.string())
            yield pa.RecordBatch.from_arrays(
                [*columns, pa.array(total, pa.int64()), pa.array(gone, pa.int64())],
                names=[*plain, before, removed],
            )

    return joined.select(*plain, f"{row}_spans").mapInArrow(clean, schema)

"""Jaccard self-join of shingle sets through parity sketches.

Every shingle toggles one bit of a sketch, so two sketches differ in at most as
many bits as the sets differ in shingles.  Sets that reach the threshold differ
in at most D shingles, D known for a band of sizes; a sketch cut into more than
D segments then has an equal segment in both.  Segments are join keys; what
meets in one is tested on whole sketches first and on the texts at last.

Only connected components are wanted, so a group that meets in a key is never
expanded into pairs: its members are tested against one of them, then along a
forest of pairs whose sketches are near, and only pairs that are still in
different components are all tested.
"""

from __future__ import annotations

import math
from bisect import bisect_left
from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from linkwatch.llm.common import landed
from linkwatch.llm.components import connected
from linkwatch.llm.meeting import meeting
from linkwatch.llm.shingles import Words, mix, shingle_set

_U = np.uint64
SLICE = 256
SEGMENT_BITS = 20
LEAST_SKETCH = 256
BLOCK = 1024
STAR = 256
SCANNED = 4096
# a list of wanted texts is sent to all executors up to this many rows of five numbers
BROADCAST_ROWS = 400_000


@dataclass(frozen=True)
class Similarity:
    """Sets link when ``den`` * intersection >= ``num`` * union, on shingles of ``words`` words."""

    words: int = 4
    num: int = 85
    den: int = 100

    def links(self, a: int, b: int, both: int) -> bool:
        return both > 0 and self.den * both >= self.num * (a + b - both)

    def apart(self, a, b):
        """Most shingles two linked sets of these sizes differ in."""
        return (self.den - self.num) * (a + b) // (self.den + self.num)

    def largest(self, a: int) -> int:
        return a * self.den // self.num


@dataclass(frozen=True)
class Band:
    """Pairs whose smaller set has ``low`` to ``high`` shingles; ``spare`` segments may be empty."""

    number: int
    low: int
    high: int
    largest: int
    segments: int
    spare: int


def _exceeded(mean: float, k: int) -> float:
    """Probability that a Poisson number of this mean is above ``k``; no more than 1."""
    if not mean:
        return 0.0
    term = math.exp(min(0.0, (k + 1) * math.log(mean) - mean - math.lgamma(k + 2)))
    total, at = 0.0, k + 1
    # terms rise up to the mean and then fall; those left out are too small to count
    while total < 1 and (at <= mean or term > 1e-12):
        total += term
        at += 1
        term *= mean / at
    return min(1.0, total)


def _spare(low: int, most: int) -> int:
    """Empty segments that a set of the least size exceeds about once in ten thousand."""

    def enough(spare: int) -> bool:
        m = most + 1 + spare
        mean = m * math.exp(-low / m)
        return spare > mean and _exceeded(mean, spare) < 1e-4

    last = most + low + 1
    if last < SCANNED:
        return next((x for x in range(1, last) if enough(x)), last)
    # large sets: once enough, more are enough too
    return bisect_left(range(last), True, lo=1, key=enough)


@lru_cache(maxsize=100_000)
def band_of(size: int, rule: Similarity) -> tuple[Band, ...]:
    """The bands a set of this size takes part in: its own and those it is the larger set of."""
    return tuple(b for b in _bands(rule, size) if b.low <= size <= b.largest and b.segments)


_known: dict[Similarity, list[Band]] = {}


def _bands(rule: Similarity, size: int) -> list[Band]:
    bands = _known.setdefault(rule, [])
    while not bands or bands[-1].high < size:
        low = bands[-1].high + 1 if bands else 1
        high = max(low, math.ceil(low * rule.den / rule.num) - 1)
        largest = rule.largest(high)
        most = rule.apart(high, largest)
        spare = _spare(low, most) if most else 0
        bands.append(Band(len(bands), low, high, largest, most + 1 + spare if most else 0, spare))
    near = bands[-1].number
    while near and bands[near - 1].largest >= size:
        near -= 1
    # bands are in order of size; those far below cannot hold a partner
    return [b for b in bands[max(0, near - 2) :] if b.low <= size] + [
        b for b in bands[: max(0, near - 2)] if b.low <= size <= b.largest
    ]


def segment_keys(shingles: np.ndarray, rule: Similarity) -> np.ndarray:
    """Join keys of a sorted set: one for every segment of its sketch that has a bit set.

    An empty segment says nothing, so bands have spare segments and empty ones
    are left out, unless a set has more of them than the spare ones.
    """
    out = []
    bits = mix((shingles & _U((1 << SEGMENT_BITS) - 1)) + _U(1 << 40))
    for band in band_of(len(shingles), rule):
        segment = ((shingles >> _U(32)) * _U(band.segments)) >> _U(32)
        starts = np.r_[0, np.flatnonzero(segment[1:] != segment[:-1]) + 1]
        value = np.bitwise_xor.reduceat(bits, starts)
        place = segment[starts]
        full = value != 0
        value, place = value[full], place[full]
        if band.segments - len(place) > band.spare:
            empty = np.setdiff1d(np.arange(band.segments, dtype=_U), place)
            value, place = np.r_[value, np.zeros(len(empty), _U)], np.r_[place, empty]
        out.append(mix(value ^ mix(place + _U((band.number + 1) << 32))))
    return np.concatenate(out) if out else np.zeros(0, _U)


def sketch(shingles: np.ndarray) -> bytes:
    """Parity bits of the whole set, at least two per shingle, a power of two in number."""
    size = max(LEAST_SKETCH, 1 << (2 * len(shingles) - 1).bit_length())
    odd = np.bincount(((shingles >> _U(8)) & _U(size - 1)).astype(np.int64), minlength=size) & 1
    return np.packbits(odd.astype(np.uint8), bitorder="little").tobytes()


def differing(a: bytes, b: bytes) -> int:
    """Bits two sketches differ in, at the size of the smaller one: a lower bound."""
    x, y, size = int.from_bytes(a, "little"), int.from_bytes(b, "little"), len(a) * 8
    while size > 8 * len(b):
        size //= 2
        x = (x >> size) ^ (x & ((1 << size) - 1))
    other = len(b) * 8
    while other > size:
        other //= 2
        y = (y >> other) ^ (y & ((1 << other) - 1))
    return (x ^ y).bit_count()


def identity(shingles: np.ndarray) -> tuple[int, int]:
    """Two 64-bit sums that tell sets apart; the first is the set's name in the join."""
    with np.errstate(over="ignore"):
        first = mix(shingles + _U(0x51)).sum(dtype=_U)
        second = mix(shingles + _U(0xA7 << 8)).sum(dtype=_U)
    return int(first.view(np.int64)), int(second.view(np.int64))


def set_of(text: bytes | None, rule: Similarity) -> np.ndarray:
    return shingle_set(Words([text], lower=True).hash, rule.words)


SETS = "doc_id long, n long, sid long, check long, sketch binary"
KEYS = "key long, sid long"


def sets(docs: DataFrame, rule: Similarity) -> DataFrame:
    """Size, identity and sketch of every document's set."""

    def build(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, SLICE):
                rows = batch.slice(at, SLICE)
                words = Words(rows.column(1).cast(pa.binary()).to_pylist(), lower=True)
                out = []
                for i in range(rows.num_rows):
                    own = words.hash[words.first[i] : words.first[i + 1]]
                    s = shingle_set(own, rule.words)
                    out.append((len(s), *identity(s), sketch(s) if len(s) else b""))
                columns = list(zip(*out, strict=True))
                yield pa.RecordBatch.from_arrays(
                    [
                        rows.column(0),
                        *[pa.array(x, pa.int64()) for x in columns[:3]],
                        pa.array(columns[3], pa.binary()),
                    ],
                    names=["doc_id", "n", "sid", "check", "sketch"],
                )

    return docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(build, SETS)


def keys(docs: DataFrame, rule: Similarity) -> DataFrame:
    """Segment keys of every distinct set; a task sends the keys of equal sets once."""

    def build(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: set[int] = set()
        for batch in batches:
            for at in range(0, batch.num_rows, SLICE):
                words = Words(
                    batch.column(0).slice(at, SLICE).cast(pa.binary()).to_pylist(), lower=True
                )
                found, names = [np.zeros(0, _U)], [np.zeros(0, np.int64)]
                for a, b in zip(words.first[:-1], words.first[1:], strict=True):
                    s = shingle_set(words.hash[a:b], rule.words)
                    if not len(s):
                        continue
                    sid = identity(s)[0]
                    if sid not in seen:
                        seen.add(sid)
                        found.append(segment_keys(s, rule))
                        names.append(np.full(len(found[-1]), sid, np.int64))
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.concatenate(found).view(np.int64)), pa.array(np.concatenate(names))],
                    names=["key", "sid"],
                )

    return docs.where(F.col("doc_id").isNotNull()).select("text").mapInArrow(build, KEYS)


def near_pairs(pairs: DataFrame, nodes: DataFrame, rule: Similarity) -> DataFrame:
    """Pairs (a, b) of sets whose sizes and sketches allow a link, with their documents."""
    left = nodes.select(*[F.col(c).alias(f"{c}_a") for c in ("sid", "doc", "n", "sketch")])
    right = nodes.select(*[F.col(c).alias(f"{c}_b") for c in ("sid", "doc", "n", "sketch")])
    both = pairs.join(left, F.col("a") == F.col("sid_a")).join(right, F.col("b") == F.col("sid_b"))
    fits = (F.least("n_a", "n_b") * rule.den) >= (F.greatest("n_a", "n_b") * rule.num)

    def test(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            na, nb, sa, sb = (batch.column(i).to_pylist() for i in range(4, 8))
            keep = [
                differing(x, y) <= rule.apart(p, q)
                for p, q, x, y in zip(na, nb, sa, sb, strict=True)
            ]
            yield pa.RecordBatch.from_arrays(batch.columns[:4], names=batch.schema.names[:4]).filter(
                pa.array(keep, pa.bool_())
            )

    return both.where(fits).select(
        "a", "b", "doc_a", "doc_b", "n_a", "n_b", "sketch_a", "sketch_b"
    ).mapInArrow(test, "a long, b long, doc_a long, doc_b long")


def verified(pairs: DataFrame, docs: DataFrame, rule: Similarity) -> DataFrame:
    """The pairs whose texts link, as edges between documents.

    Pairs of one set are tested together, so its text travels once for up to
    ``STAR`` partners; a set with more of them is dealt over several groups.
    """
    pairs = landed(pairs, "near-pairs")
    many = pairs.groupBy("a").agg(F.ceil(F.count("*") / STAR).alias("parts"))
    dealt = pairs.join(many, "a").select(
        F.col("a").alias("lead"),
        F.pmod(F.xxhash64("b"), F.col("parts")).alias("part"),
        "b",
        "doc_a",
        "doc_b",
    )
    leads = dealt.select(
        "lead", "part", F.lit(0).alias("role"), F.col("lead").alias("sid"), F.col("doc_a").alias("doc")
    ).distinct()
    partners = dealt.select(
        "lead", "part", F.lit(1).alias("role"), F.col("b").alias("sid"), F.col("doc_b").alias("doc")
    )
    wanted = landed(leads.unionByName(partners), "wanted-texts")
    if wanted.count() <= BROADCAST_ROWS:
        wanted = F.broadcast(wanted)
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    found = texts.join(wanted, F.col("doc_id") == F.col("doc")).select(
        "lead", "part", "role", "sid", "doc", "text"
    )

    def test(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        group, lead, lead_doc = None, np.zeros(0, _U), None
        for batch in batches:
            edges = []
            columns = [batch.column(i).to_pylist() for i in range(5)]
            texts = batch.column(5).cast(pa.binary()).to_pylist()
            for a, part, role, sid, doc, text in zip(*columns, texts, strict=True):
                own = set_of(text, rule)
                if identity(own)[0] != sid:  # another row of the same id
                    continue
                if role == 0:
                    group, lead, lead_doc = (a, part), own, doc
                elif group == (a, part):
                    both = len(np.intersect1d(lead, own, assume_unique=True))
                    if rule.links(len(lead), len(own), both):
                        edges.append((lead_doc, doc))
            yield pa.RecordBatch.from_arrays(
                [pa.array([e[i] for e in edges], pa.int64()) for i in (0, 1)], names=["a", "b"]
            )

    ordered = found.repartition("lead", "part").sortWithinPartitions("lead", "part", "role")
    return ordered.mapInArrow(test, "a long, b long")


def unresolved(groups: DataFrame, nodes: DataFrame, parts: DataFrame) -> DataFrame:
    """Members of keys that still hold several components, with their sketches.

    A pivot has been tested against all of its group and is left out.
    """
    place = nodes.join(parts, F.col("doc") == F.col("node"), "left").select(
        "sid", F.coalesce("component", "doc").alias("component")
    )
    rows = groups.where("sid <> pivot").select("key", "sid").join(place, "sid")
    mixed = rows.groupBy("key").agg(
        F.min("component").alias("x"), F.max("component").alias("y"), F.count("*").alias("g")
    )
    mixed = mixed.where("x <> y").select("key", F.ceil(F.col("g") / BLOCK).alias("blocks"))
    return rows.join(mixed, "key").join(nodes.select("sid", "n", "sketch"), "sid")


def cross_pairs(rows: DataFrame, rule: Similarity, forest: bool) -> DataFrame:
    """Pairs of one key in different components whose sketches are near.

    ``forest`` takes only pairs that connect something within a block of the
    group, so their number stays below the group's; else every pair is found,
    block against block.
    """
    own = F.pmod(F.xxhash64("sid"), F.col("blocks"))
    if forest:
        rows = rows.select("*", own.alias("i"), own.alias("j"), F.lit(0).alias("side"))
    else:
        other = F.explode(F.sequence(F.lit(0).cast("long"), F.col("blocks") - 1))
        rows = rows.select("*", own.alias("own")).select("*", other.alias("other"))
        rows = rows.select(
            "*",
            F.least("own", "other").alias("i"),
            F.greatest("own", "other").alias("j"),
            (F.col("own") > F.col("other")).cast("int").alias("side"),
        )

    def build(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, held = None, []

        def pairs() -> list[tuple[int, int]]:
            found, root = [], {c: c for _, _, c, _, _ in held}

            def top(c: int) -> int:
                while root[c] != c:
                    root[c] = c = root[root[c]]
                return c

            diagonal = key[1] == key[2]
            for x, (sx, gx, cx, nx, kx) in enumerate(held):
                for y in range(x + 1, len(held)):
                    sy, gy, cy, ny, ky = held[y]
                    if cx == cy or (not diagonal and gx == gy):
                        continue
                    if min(nx, ny) * rule.den < max(nx, ny) * rule.num:
                        continue
                    if forest and top(cx) == top(cy):
                        continue
                    if differing(kx, ky) <= rule.apart(nx, ny):
                        found.append((min(sx, sy), max(sx, sy)))
                        if forest:
                            root[top(cx)] = top(cy)
            return found

        def out(found: list[tuple[int, int]]) -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays(
                [pa.array([p[i] for p in found], pa.int64()) for i in (0, 1)], names=["a", "b"]
            )

        for batch in batches:
            found = []
            for k, i, j, *rest in zip(
                *[batch.column(c).to_pylist() for c in range(8)], strict=True
            ):
                if (k, i, j) != key:
                    if len(held) > 1:
                        found += pairs()
                    key, held = (k, i, j), []
                held.append(tuple(rest))
            yield out(found)
        if len(held) > 1:
            yield out(pairs())

    ordered = rows.select("key", "i", "j", "sid", "side", "component", "n", "sketch")
    ordered = ordered.repartition("key", "i", "j").sortWithinPartitions("key", "i", "j")
    return ordered.mapInArrow(build, "a long, b long").distinct()


def similar_components(docs: DataFrame, rule: Similarity = Similarity()) -> DataFrame:
    """doc_id, n_shingles and component_id of every row.

    Words are split at ASCII white space and compared with A-Z in lower case.  A
    text with fewer words than a shingle is one shingle.  A null, empty or blank
    text has none and is linked with nothing; so is a row without an id, whose
    component is null.  Equal sets are one node, so copies are never paired.
    Rows that repeat an id are nodes of that id, each by its own text.  Sets are
    told apart by 64-bit names, checked by a second sum (good for some 10**9
    distinct texts); a clash is reported as an error, never joined.
    """
    docs = docs.select("doc_id", "text")
    named = landed(sets(docs, rule), "shingle-sets")
    usable = named.where((F.col("n") > 0) & F.col("doc_id").isNotNull())
    nodes = landed(
        usable.groupBy("sid").agg(
            F.min("doc_id").alias("doc"),
            F.min("n").alias("n"),
            F.min_by("sketch", "doc_id").alias("sketch"),
            (F.min("check") != F.max("check")).alias("clash"),
        ),
        "set-nodes",
    )
    if nodes.where("clash").limit(1).count():
        raise RuntimeError("two different shingle sets have the same name; change the hash base")
    groups = landed(meeting(keys(docs, rule)), "meetings")
    pairs = groups.where("sid <> pivot").select(F.col("pivot").alias("a"), F.col("sid").alias("b"))
    links = landed(verified(near_pairs(pairs.distinct(), nodes, rule), docs, rule), "links")
    # copies of an id with several texts meet in that id
    parts = connected(links)
    for forest in (True, False):
        rows = landed(unresolved(groups, nodes, parts), "unresolved")
        more = near_pairs(cross_pairs(rows, rule, forest), nodes, rule)
        new = landed(verified(more, docs, rule), "links")
        if new.limit(1).count():
            links = links.unionByName(new)
            parts = connected(links)
    place = landed(
        nodes.join(parts, F.col("doc") == F.col("node"), "left").select(
            "sid", F.coalesce("component", "doc").alias("component_id")
        ),
        "set-components",
    )
    alone = F.when(F.col("n") == 0, F.col("doc_id"))
    linked = F.when((F.col("n") > 0) & F.col("doc_id").isNotNull(), F.col("sid"))
    return (
        named.select("doc_id", F.col("n").alias("n_shingles"), linked.alias("sid"), alone.alias("own"))
        .join(place, "sid", "left")
        .select("doc_id", "n_shingles", F.coalesce("component_id", "own").alias("component_id"))
    )

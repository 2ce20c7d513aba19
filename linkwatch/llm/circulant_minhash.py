"""Near-duplicate removal with circulant MinHash.

Shingles get a place among ``PLACES`` by a first permutation.  A second one,
held as a table, gives every place a rank; coordinate k of a signature is the
least rank of the set's places after a circular shift by k.  The ranks that one
shingle adds to all coordinates are thus neighbours in the table.  Bands of
coordinates are join keys; what shares a key is tested on whole signatures and
then on the full shingle sets.

Only components are wanted, so the members of a key are tested against one of
them first, each member against the least of its keys' pivots before the others.
Keys that still hold several components are searched along forests of near
signatures and then completely; a large one is first cut again by a second band,
which every linked pair shares as well.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from linkwatch.llm.common import fresh, landed
from linkwatch.llm.components import connected
from linkwatch.llm.shingles import mix, windows

_U = np.uint64
PLACE_BITS = 22
PLACES = 1 << PLACE_BITS
SLICE = 256
CHUNK = 2048
BLOCK = 1024
# keys of more blocks are cut by a second band: a row has one copy a block, or one a band
CUT_BLOCKS = 8
STAR = 256
REMEMBERED_WORDS = 400_000
LONGEST_REMEMBERED = 64
# a list of wanted texts is sent to all executors up to this many rows of four numbers
BROADCAST_ROWS = 400_000


@dataclass(frozen=True)
class NearRule:
    """Sets of ``words``-word shingles link when ``den`` * intersection >= ``num`` * union.

    A pair at the threshold shares no band with probability
    (1 - (num / den) ** rows) ** bands, 2e-13 with these values.
    """

    words: int = 5
    num: int = 85
    den: int = 100
    bands: int = 50
    rows: int = 5

    @property
    def size(self) -> int:
        return self.bands * self.rows

    @property
    def least_equal(self) -> int:
        """Coordinates a linked pair has in common: six standard deviations below the mean."""
        share = self.num / self.den
        return math.floor(
            self.size * share - 6 * math.sqrt(self.size * share * (1 - share))
        )

    def links(self, a: int, b: int, both: int) -> bool:
        return both > 0 and self.den * both >= self.num * (a + b - both)


class WordDigests(dict):
    """128-bit BLAKE2b digests of words, those seen lately remembered."""

    def __missing__(self, word: bytes) -> bytes:
        digest = hashlib.blake2b(word, digest_size=16).digest()
        if len(word) <= LONGEST_REMEMBERED:
            if len(self) >= REMEMBERED_WORDS:
                self.clear()
            self[word] = digest
        return digest


_digests = WordDigests()


def shingle_digests(text: bytes | None, size: int) -> tuple[np.ndarray, np.ndarray]:
    """Two 64-bit digests of every distinct shingle, sorted by the first."""
    words = text.lower().split() if text else []
    if not words:
        return np.zeros(0, _U), np.zeros(0, _U)
    both = np.frombuffer(b"".join(map(_digests.__getitem__, words)), _U).reshape(-1, 2)
    k = min(size, len(words))
    first, at = np.unique(windows(both[:, 0], k) + _U(k), return_index=True)
    return first, windows(both[:, 1], k)[at] + _U(k)


@lru_cache(maxsize=2)
def _ranks(size: int) -> np.ndarray:
    """Every run of ``size`` neighbours of the circular table of ranks."""
    order = np.argsort(mix(np.arange(PLACES, dtype=_U) + _U(1 << 50)), kind="stable")
    ranks = np.empty(PLACES, np.uint32)
    ranks[order] = np.arange(PLACES, dtype=np.uint32)
    return np.lib.stride_tricks.sliding_window_view(np.r_[ranks, ranks[: size - 1]], size)


def signature(shingles: np.ndarray, size: int) -> np.ndarray:
    """``size`` coordinates of a set that is not empty."""
    table = _ranks(size)
    place = (mix(shingles + _U(0xC1)) >> _U(64 - PLACE_BITS)).astype(np.int64)
    least = table[place[:CHUNK]].min(axis=0)
    for at in range(CHUNK, len(place), CHUNK):
        np.minimum(least, table[place[at : at + CHUNK]].min(axis=0), out=least)
    return least


def band_keys(coordinates: np.ndarray, rule: NearRule) -> np.ndarray:
    parts = coordinates.astype(_U).reshape(rule.bands, rule.rows)
    key = np.arange(1, rule.bands + 1, dtype=_U) << _U(40)
    for k in range(rule.rows):
        key = mix(key ^ parts[:, k])
    return key


SETS = "doc_id long, n long, name binary, low binary, keys binary"


def signed(docs: DataFrame, rule: NearRule) -> DataFrame:
    """Size, 128-bit name, low bytes of the signature and band keys of every document's set."""

    def build(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, SLICE):
                rows = batch.slice(at, SLICE)
                out = []
                for text in rows.column(1).cast(pa.binary()).to_pylist():
                    first, second = shingle_digests(text, rule.words)
                    if not len(first):
                        out.append((0, b"", b"", b""))
                        continue
                    name = hashlib.blake2b(first.tobytes(), digest_size=16)
                    name.update(second.tobytes())
                    s = signature(first, rule.size)
                    low = s.astype(np.uint8).tobytes()
                    out.append((len(first), name.digest(), low, band_keys(s, rule).tobytes()))
                n, *blobs = zip(*out, strict=True)
                yield pa.RecordBatch.from_arrays(
                    [rows.column(0), pa.array(n, pa.int64()), *[pa.array(b, pa.binary()) for b in blobs]],
                    names=["doc_id", "n", "name", "low", "keys"],
                )

    return docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(build, SETS)


def band_rows(nodes: DataFrame) -> DataFrame:
    """(key, node) for each band of each node."""

    def build(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, SLICE):
                rows = batch.slice(at, SLICE)
                blobs = rows.column(1).to_pylist()
                keys = np.frombuffer(b"".join(blobs), np.int64)
                node = np.repeat(rows.column(0).to_numpy(), [len(b) // 8 for b in blobs])
                yield pa.RecordBatch.from_arrays(
                    [pa.array(keys), pa.array(node)], names=["key", "node"]
                )

    return nodes.select("node", "keys").mapInArrow(build, "key long, node long")


def shared_keys(rows: DataFrame) -> DataFrame:
    """Rows of keys that several nodes have, with the key's least node as its pivot.

    Keys are found by partial sums; the join back splits a crowded key.
    """
    ends = rows.groupBy("key").agg(F.min("node").alias("pivot"), F.max("node").alias("last"))
    return rows.join(ends.where("pivot <> last").select("key", "pivot"), "key")


def near_pairs(pairs: DataFrame, nodes: DataFrame, rule: NearRule) -> DataFrame:
    """Pairs (a, b) of nodes whose sizes and signatures allow a link."""
    left, right = (
        nodes.select(*[F.col(c).alias(f"{c}_{s}") for c in ("node", "n", "low")]) for s in "ab"
    )
    both = pairs.join(left, F.col("a") == F.col("node_a")).join(right, F.col("b") == F.col("node_b"))
    fits = (F.least("n_a", "n_b") * rule.den) >= (F.greatest("n_a", "n_b") * rule.num)

    def test(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x, y = (
                np.frombuffer(b"".join(batch.column(i).to_pylist()), np.uint8).reshape(-1, rule.size)
                for i in (2, 3)
            )
            keep = (x == y).sum(axis=1) >= rule.least_equal
            yield pa.RecordBatch.from_arrays(batch.columns[:2], names=["a", "b"]).filter(pa.array(keep))

    return both.where(fits).select("a", "b", "low_a", "low_b").mapInArrow(test, "a long, b long").distinct()


def verified(pairs: DataFrame, docs: DataFrame, rule: NearRule) -> DataFrame:
    """The pairs whose full shingle sets link.

    Partners of one node are tested together, at most ``STAR`` in a group, so a
    text travels once per group.
    """
    pairs = landed(pairs, "near-pairs")
    many = pairs.groupBy("a").agg(F.ceil(F.count("*") / STAR).alias("parts"))
    dealt = pairs.join(many, "a").select(
        F.col("a").alias("lead"), F.pmod(F.xxhash64("b"), F.col("parts")).alias("part"), "b"
    )
    leads = dealt.select("lead", "part", F.lit(0).alias("role"), F.col("lead").alias("node")).distinct()
    partners = dealt.select("lead", "part", F.lit(1).alias("role"), F.col("b").alias("node"))
    wanted = landed(leads.unionByName(partners), "wanted-texts")
    if wanted.count() <= BROADCAST_ROWS:
        wanted = F.broadcast(wanted)
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    found = texts.join(wanted, F.col("doc_id") == F.col("node")).select(
        "lead", "part", "role", "node", "text"
    )

    def test(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        group, held = None, []
        for batch in batches:
            edges = []
            columns = [batch.column(i).to_pylist() for i in range(4)]
            texts = batch.column(4).cast(pa.binary()).to_pylist()
            for lead, part, role, node, text in zip(*columns, texts, strict=True):
                if group != (lead, part):
                    group, held = (lead, part), []
                first, second = shingle_digests(text, rule.words)
                if role == 0:  # several where rows repeat the id
                    held.append((first, second))
                    continue
                for other in held if len(first) else ():
                    both = _in_common((first, second), other)
                    if rule.links(len(other[0]), len(first), both):
                        edges.append((lead, node))
                        break
            yield pa.RecordBatch.from_arrays(
                [pa.array([e[i] for e in edges], pa.int64()) for i in (0, 1)], names=["a", "b"]
            )

    ordered = found.repartition("lead", "part").sortWithinPartitions("lead", "part", "role")
    return ordered.mapInArrow(test, "a long, b long")


def keys_of(rows: DataFrame) -> DataFrame:
    """Rows (key, node) as one row a node with its keys, ``bands`` at most for each of its sets."""
    return rows.groupBy("node").agg(F.collect_list("key").alias("shared"))


def with_component(rows: DataFrame, parts: DataFrame) -> DataFrame:
    """``rows``, one a node, with the component the node is in so far."""
    place = parts.select("node", "component")
    return rows.join(place, "node", "left").withColumn("component", F.coalesce("component", "node"))


def unresolved(rows: DataFrame) -> DataFrame:
    """Rows (key, node, component) of keys that still hold several components."""
    mixed = rows.groupBy("key").agg(
        F.min("component").alias("x"), F.max("component").alias("y"), F.count("*").alias("g")
    )
    mixed = mixed.where("x <> y").select("key", F.ceil(F.col("g") / BLOCK).alias("blocks"))
    return rows.join(mixed, "key").select("key", "node", "component", "blocks")


def unresolved_members(members: DataFrame, parts: DataFrame) -> DataFrame:
    """``unresolved`` of rows (node, shared); components are joined before keys are unfolded."""
    placed = with_component(members, parts)
    return unresolved(placed.select(F.explode("shared").alias("key"), "node", "component"))


def cut_again(rows: DataFrame, nodes: DataFrame, rule: NearRule) -> DataFrame:
    """Keys of a band and a second one for each member; a linked pair that shares a
    band shares another one with it as surely as it shared the first."""
    bands = nodes.select("node", "keys")

    def build(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, SLICE):
                some = batch.slice(at, SLICE)
                key, node, component = (some.column(i).to_numpy() for i in range(3))
                keys = np.frombuffer(b"".join(some.column(3).to_pylist()), np.int64)
                keys = keys.reshape(-1, rule.bands)
                other = keys != key[:, None]
                own = np.repeat(key, rule.bands).reshape(keys.shape)
                times = other.sum(axis=1)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(_cut(own, keys)[other]), *[pa.array(np.repeat(c, times)) for c in (node, component)]],
                    names=["key", "node", "component"],
                )

    wanted = rows.select("key", "node", "component").join(bands, "node")
    return wanted.select("key", "node", "component", "keys").mapInArrow(
        build, "key long, node long, component long"
    )


def _runs(batches: Iterator[pa.RecordBatch], keys: int) -> Iterator[list[tuple]]:
    """Rows of a sorted stream that agree in their first columns, one group at a time."""
    group: list[tuple] = []
    for batch in batches:
        for row in zip(*[c.to_pylist() for c in batch.columns], strict=True):
            if group and row[:keys] != group[0][:keys]:
                yield group
                group = []
            group.append(row)
    if group:
        yield group


def _cut(key: np.ndarray, other: np.ndarray) -> np.ndarray:
    """The key of what shares two bands, given by their keys."""
    return mix(mix(key.view(_U)) ^ other.view(_U)).view(np.int64)


def _bands_of(own: int, keys: np.ndarray) -> tuple[int, int]:
    """The band (twice) or the two bands that a group's key stands for, from a member's keys."""
    plain = np.flatnonzero(keys == own)
    if len(plain):
        return int(plain[0]), int(plain[0])
    a, b = np.nonzero(_cut(keys[:, None], keys[None, :]) == own)
    return int(a[0]), int(b[0])


def _in_common(a: tuple[np.ndarray, np.ndarray], b: tuple[np.ndarray, np.ndarray]) -> int:
    """Shingles that two sets share, by both digests."""
    place = np.minimum(np.searchsorted(b[0], a[0]), len(b[0]) - 1)
    return int(((b[0][place] == a[0]) & (b[1][place] == a[1])).sum())


def _near(group: list[tuple], rule: NearRule, first_only: bool) -> Iterator[tuple]:
    """Places x, y of rows in different components whose sizes and signatures are near.

    Rows are (key, i, j, node, side, component, n, low, keys).  A pair of different
    blocks has one row of each.  ``first_only`` leaves a pair to the first band
    it shares, or the first two where the first one's key was cut again.
    """
    diagonal = group[0][1] == group[0][2]
    side, component, n = (np.array([r[c] for r in group]) for c in (4, 5, 6))
    low = np.frombuffer(b"".join(r[7] for r in group), np.uint8).reshape(-1, rule.size)
    keys = np.frombuffer(b"".join(r[8] for r in group), np.int64).reshape(-1, rule.bands)
    bands = _bands_of(group[0][0], keys[0]) if first_only else (0, 0)
    for x in range(len(group) - 1):
        y = np.arange(x + 1, len(group))
        small, large = np.minimum(n[x], n[y]), np.maximum(n[x], n[y])
        keep = (component[y] != component[x]) & (small * rule.den >= large * rule.num)
        if not diagonal:
            keep &= side[y] != side[x]
        y = y[keep]
        y = y[(low[y] == low[x]).sum(axis=1) >= rule.least_equal]
        if first_only and len(y):
            shared = keys[y] == keys[x]
            first = shared.argmax(axis=1) == bands[0]
            shared[:, bands[0]] &= bands[0] == bands[1]
            y = y[first & (shared.argmax(axis=1) == bands[1])]
        if len(y):
            yield x, y, component


_DEALT = ("key", "i", "j", "node", "side", "component", "n", "low", "keys")
_DEALT_TYPE = (
    "key long, i long, j long, node long, side int, component long, n long, low binary, keys binary"
)


def _in_order(rows: DataFrame, *more: str) -> DataFrame:
    rows = rows.select(*_DEALT, *more)
    return rows.repartition("key", "i", "j").sortWithinPartitions("key", "i", "j")


def forest_pairs(rows: DataFrame, nodes: DataFrame, rule: NearRule) -> DataFrame:
    """Near pairs of one block of a key that connect something, fewer than it has rows."""
    own = F.pmod(F.xxhash64("node"), F.col("blocks"))
    rows = rows.join(nodes.select("node", "n", "low", "keys"), "node").select(
        "*", own.alias("i"), own.alias("j"), F.lit(0).alias("side")
    )

    def build(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for group in _runs(batches, 3):
            found = []
            for x, y, component in _near(group, rule, False):
                y = y[component[y] != component[x]]
                joined, at = np.unique(component[y], return_index=True)
                component[np.isin(component, joined)] = component[x]
                found += [sorted((group[x][3], group[k][3])) for k in y[at].tolist()]
            yield pa.RecordBatch.from_arrays(
                [pa.array([p[k] for p in found], pa.int64()) for k in (0, 1)], names=["a", "b"]
            )

    return _in_order(rows).mapInArrow(build, "a long, b long").distinct()


def block_links(rows: DataFrame, nodes: DataFrame, docs: DataFrame, rule: NearRule) -> DataFrame:
    """All links between different components of one key, block against block.

    Pairs are never written: rows that have a near partner get their text, and
    the block they meet in compares the full shingle sets.
    """
    own = F.pmod(F.xxhash64("node"), F.col("blocks"))
    other = F.explode(F.sequence(F.lit(0).cast("long"), F.col("blocks") - 1))
    rows = rows.join(nodes.select("node", "n", "low", "keys"), "node")
    rows = rows.select("*", own.alias("own")).select("*", other.alias("other")).select(
        "*",
        F.least("own", "other").alias("i"),
        F.greatest("own", "other").alias("j"),
        (F.col("own") > F.col("other")).cast("int").alias("side"),
    )
    kinds = [pa.int64()] * 4 + [pa.int32()] + [pa.int64()] * 2 + [pa.binary()] * 2

    def paired(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for group in _runs(batches, 3):
            used = np.zeros(len(group), bool)
            for x, y, _ in _near(group, rule, True):
                used[x] = True
                used[y] = True
            columns = list(zip(*[r for r, u in zip(group, used, strict=True) if u], strict=True))
            if columns:
                yield pa.RecordBatch.from_arrays(
                    [pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], names=list(_DEALT)
                )

    kept = landed(_in_order(rows).mapInArrow(paired, _DEALT_TYPE), "near-rows")
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    found = texts.join(kept, F.col("doc_id") == F.col("node"))

    def test(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for group in _runs(batches, 3):
            sets = [shingle_digests(r[9].encode() if r[9] else None, rule.words) for r in group]
            empty = not all(len(s[0]) for s in sets)
            if empty:  # rows that repeat an id of the group without a text
                group = [r for r, s in zip(group, sets, strict=True) if len(s[0])]
                sets = [s for s in sets if len(s[0])]
                if not group:
                    continue
            edges = []
            for x, y, _ in _near(group, rule, True):
                for k in y.tolist():
                    both = _in_common(sets[x], sets[k])
                    if rule.links(len(sets[x][0]), len(sets[k][0]), both):
                        edges.append((group[x][3], group[k][3]))
            yield pa.RecordBatch.from_arrays(
                [pa.array([e[k] for e in edges], pa.int64()) for k in (0, 1)], names=["a", "b"]
            )

    return _in_order(found, "text").mapInArrow(test, "a long, b long").distinct()


def near_components(docs: DataFrame, rule: NearRule = NearRule()) -> DataFrame:
    """doc_id, n_shingles, component_id and kept of every row; doc_id and text are read.

    Words are split at ASCII white space and compared with A-Z in lower case.  A
    text with fewer words than a shingle is one shingle.  A null, empty or blank
    text has none and is linked with nothing.  A row without an id is judged like
    one without words: its component is null and it stays.  Equal sets are one
    node, so copies are never paired; rows that repeat an id are in that id's
    component, each linked by its own text.  An empty table gives no rows.
    """
    docs = docs.select("doc_id", "text")
    sets = landed(signed(docs, rule), "signed-sets")
    usable = (F.col("n") > 0) & F.col("doc_id").isNotNull()
    nodes = landed(
        sets.where(usable)
        .groupBy("name")
        .agg(
            F.min("doc_id").alias("node"),
            F.first("n").alias("n"),
            F.first("low").alias("low"),
            F.first("keys").alias("keys"),
        ),
        "set-nodes",
    )
    # ids whose rows have other sets as well are one node with them
    own = sets.where(usable).select("name", "doc_id").distinct()
    same = own.join(nodes.select("name", "node"), "name").where("doc_id <> node").select(F.col("node").alias("a"), F.col("doc_id").alias("b"))
    repeated = sets.where(usable).groupBy("doc_id").agg(
        F.min("name").alias("x"), F.max("name").alias("y")
    ).where("x <> y").select(F.col("doc_id").alias("b"))
    links = landed(same.join(repeated, "b", "left_semi").select("a", "b"), "links")
    groups = landed(shared_keys(band_rows(nodes)), "shared-keys")
    stars = groups.where("node <> pivot")
    # most groups are joined by the least pivot of each node; the others matter where it failed
    first = stars.groupBy("node").agg(F.min("pivot").alias("a")).select("a", F.col("node").alias("b"))
    found = landed(verified(near_pairs(first, nodes, rule), docs, rule), "links")
    links = links.unionByName(found)
    parts = connected(links)
    place = parts.select("node", "component")
    apart = (
        stars.select(F.col("pivot").alias("a"), F.col("node").alias("b"))
        .distinct()
        .join(place.select(F.col("node").alias("a"), F.col("component").alias("x")), "a", "left")
        .join(place.select(F.col("node").alias("b"), F.col("component").alias("y")), "b", "left")
        .where(F.coalesce("x", "a") != F.coalesce("y", "b"))
        .select("a", "b")
    )
    apart = landed(apart, "pairs-apart")
    found = landed(verified(near_pairs(apart, nodes, rule), docs, rule), "links")
    if found.limit(1).count():
        links = links.unionByName(found)
        parts = connected(links)
    # a pivot has been tested against all of its key
    members = landed(keys_of(stars), "member-keys")
    rows = landed(unresolved_members(members, parts), "unresolved")
    if rows.limit(1).count():
        more = near_pairs(forest_pairs(rows, nodes, rule), nodes, rule)
        found = landed(verified(more, docs, rule), "links")
        if found.limit(1).count():
            links = links.unionByName(found)
            parts = connected(links)
        rows = landed(unresolved_members(members, parts), "unresolved")
        large = cut_again(rows.where(F.col("blocks") > CUT_BLOCKS), nodes, rule)
        rows = rows.where(F.col("blocks") <= CUT_BLOCKS).unionByName(unresolved(large))
        found = landed(block_links(landed(rows, "mixed-keys"), nodes, docs, rule), "links")
        if found.limit(1).count():
            parts = connected(links.unionByName(found))
    place = landed(
        nodes.join(parts, "node", "left").select(
            "name", F.coalesce("component", "node").alias("component_id")
        ),
        "set-components",
    )
    linked = F.when(usable, F.col("name"))
    alone = F.when(F.col("n") == 0, F.col("doc_id"))
    named = sets.select("doc_id", F.col("n").alias("n_shingles"), linked.alias("name"), alone.alias("own"))
    out = named.join(place, "name", "left").select(
        "doc_id", "n_shingles", F.coalesce("component_id", "own").alias("component_id")
    )
    return out.withColumn("kept", F.coalesce(F.col("doc_id") == F.col("component_id"), F.lit(True)))


def deduplicated(docs: DataFrame, rule: NearRule = NearRule()) -> DataFrame:
    """The rows of ``docs`` that stay, with all their columns: one id of each component."""
    kept = near_components(docs, rule).where("kept and doc_id is not null").select("doc_id").distinct()
    name = fresh(docs.columns, "kept_id")
    wanted = kept.select(F.col("doc_id").alias(name))
    held = docs.join(wanted, docs["doc_id"].cast("long") == wanted[name], "left_semi")
    return held.unionByName(docs.where("doc_id is null"))

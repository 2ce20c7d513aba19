"""Ranked lexical search of many items over all documents by presence masks.

Texts are read and split once: each document's occurrences of the items' terms
are written as a row of two lists, which both the corpus figures and the search
read.

A block of documents has a bitmap per term.  For one item, the bitmaps tell
which of its terms a document holds, its presence mask; documents with the same
mask are a group.  A group's mask has a largest possible score: the sum of its
terms' largest impacts in the block.  Groups that cannot reach the item's 50th
score so far are dropped; the rest is evaluated by descending largest score,
until no group left can reach it.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass, field
from functools import reduce
from operator import or_

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from linkwatch.llm.common import landed
from linkwatch.session import scratch_path
from linkwatch.sources import files

# the first block of a task is small: it sets the scores the next ones have to reach
FIRST_BLOCK = 128
BLOCK = 2048
SPLIT = 512  # texts that are split at a time, which bounds memory
SALTS = 32
SHARD_BYTES = 8 << 20

_terms = bytearray(range(256))
for _b in range(128):
    if not chr(_b).isalnum():
        _terms[_b] = 0x20
    elif chr(_b).isupper():
        _terms[_b] = _b + 32
_TERMS = bytes(_terms)


def terms_of(text: bytes | None) -> list[bytes]:
    """Runs of ASCII letters, digits and characters beyond ASCII, A-Z in lower case."""
    return text.translate(_TERMS).split() if text else []


@dataclass
class Shard:
    """Items searched together: their terms by number, and weights once those are known."""

    terms: pa.StringArray
    items: list[list[int]]
    weights: np.ndarray = field(default_factory=lambda: np.zeros(0, np.int64))
    n_docs: int = 0
    n_terms: int = 0


def _strings(texts: list[bytes]) -> pa.StringArray:
    """Bytes that need not be valid UTF-8 as Arrow strings."""
    return pa.array(texts, pa.binary()).view(pa.string())


def build_shard(texts: list[bytes]) -> Shard:
    numbers: dict[bytes, int] = {}
    items = []
    for text in texts:
        own = dict.fromkeys(terms_of(text))
        items.append([numbers.setdefault(t, len(numbers)) for t in own])
    return Shard(_strings(list(numbers)), items)


def weight(n_docs: int, df: int) -> int:
    return math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df + 1)))


def _postings(
    shard: Shard, texts: list[bytes | None]
) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Document, term and occurrences of a block, by document and term; and all lengths."""
    plain = _strings([t.translate(_TERMS).strip() if t else b"" for t in texts])
    words = pc.ascii_split_whitespace(plain)
    # without a term, the list has one empty string
    lengths = pc.list_value_length(words).to_numpy() - (pc.binary_length(plain).to_numpy() == 0)
    doc = pc.list_parent_indices(words).to_numpy()
    found = pc.index_in(words.flatten(), value_set=shard.terms).fill_null(-1).to_numpy()
    held = found >= 0
    size = max(len(shard.terms), 1)
    keys, tf = np.unique(doc[held] * size + found[held], return_counts=True)
    return keys // size, keys % size, tf, lengths


def postings(docs: DataFrame, shard: Shard) -> DataFrame:
    """A row a document: all its terms (n), and the terms of the shard it holds with occurrences."""
    shared = docs.sparkSession.sparkContext.broadcast(shard)

    def build(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, SPLIT):
                rows = batch.slice(at, SPLIT)
                texts = rows.column(1).cast(pa.binary()).to_pylist()
                doc, term, tf, lengths = _postings(shared.value, texts)
                first = pa.array(np.searchsorted(doc, np.arange(len(texts) + 1)), pa.int32())
                lists = [
                    pa.ListArray.from_arrays(first, pa.array(x, pa.int32())) for x in (term, tf)
                ]
                yield pa.RecordBatch.from_arrays(
                    [rows.column(0), pa.array(lengths, pa.int64()), *lists],
                    names=["doc_id", "n", "terms", "tf"],
                )

    rows = docs.select(F.col("doc_id").cast("long"), "text")
    return rows.mapInArrow(build, "doc_id long, n long, terms array<int>, tf array<int>")


def weighted(rows: DataFrame, shard: Shard) -> Shard:
    """The shard with the corpus figures; the driver gets one number per term of the shard."""
    totals = rows.agg(F.count_if(F.col("n") > 0), F.sum("n")).first()
    shard.n_docs, shard.n_terms = totals[0], totals[1] or 0
    counts = rows.select(F.explode("terms").alias("term")).groupBy("term").agg(F.count("*"))
    df = dict(map(tuple, counts.collect()))
    shard.weights = np.array(
        [weight(shard.n_docs, df.get(t, 0)) for t in range(len(shard.terms))], np.int64
    )
    return shard


class Best:
    """The highest scores of one item so far, equal scores by ascending document."""

    def __init__(self, k: int):
        self.k = k
        self.least = 1  # a score has to be above 0
        self.score, self.doc = np.zeros(0, np.int64), np.zeros(0, np.int64)

    def add(self, score: np.ndarray, doc: np.ndarray) -> None:
        keep = score >= self.least
        if not keep.any():
            return
        score, doc = np.r_[self.score, score[keep]], np.r_[self.doc, doc[keep]]
        order = np.lexsort((doc, -score))[: self.k]
        self.score, self.doc = score[order], doc[order]
        if len(order) == self.k:
            self.least = max(1, int(self.score[-1]))


@dataclass
class Block:
    """By term: the block's documents that hold it, their impacts, its bitmap and largest impact."""

    ids: np.ndarray
    docs: dict[int, np.ndarray]
    impacts: dict[int, np.ndarray]
    bitmap: dict[int, int]
    largest: dict[int, int]

    def sums(self, terms: list[int], values: np.ndarray) -> np.ndarray:
        """By document, the sum of ``values``: one for each document of each of the terms."""
        out = np.zeros(len(self.ids), np.int64)
        np.add.at(out, np.concatenate([self.docs[t] for t in terms]), values)
        return out

    def scores(
        self, docs: np.ndarray, weights: np.ndarray, terms: list[int] | None = None
    ) -> np.ndarray:
        """Exact scores of documents for ``terms``, or for all terms with a weight."""
        terms = [t for t in (self.docs if terms is None else terms) if t in self.docs]
        return self.sums(terms, np.concatenate([weights[t] * self.impacts[t] for t in terms]))[docs]


def block_of(
    shard: Shard,
    ids: np.ndarray,
    doc: np.ndarray,
    term: np.ndarray,
    tf: np.ndarray,
    lengths: np.ndarray,
) -> Block:
    """The block of postings that come by document and term."""
    m = 50 + 50 * lengths.astype(np.int64) * shard.n_docs // max(shard.n_terms, 1)
    impact = 1_000_000_000 * tf // (1000 * tf + 20 * m[doc])
    order = np.argsort(term, kind="stable")
    doc, impact = doc[order], impact[order]
    held, starts = np.unique(term[order], return_index=True)
    block = Block(ids, {}, {}, {}, {})
    if not len(held):
        return block
    ends = np.r_[starts[1:], len(term)]
    width = -(-len(ids) // 8)
    bits = np.zeros(len(held) * width, np.uint8)
    local = np.repeat(np.arange(len(held)), ends - starts)
    np.bitwise_or.at(bits, local * width + (doc >> 3), (1 << (doc & 7)).astype(np.uint8))
    raw = bits.tobytes()
    most = np.maximum.reduceat(impact, starts).tolist()
    for i, (t, a, b) in enumerate(zip(held.tolist(), starts.tolist(), ends.tolist(), strict=True)):
        block.docs[t], block.impacts[t] = doc[a:b], impact[a:b]
        block.bitmap[t] = int.from_bytes(raw[i * width : (i + 1) * width], "little")
        block.largest[t] = most[i]
    return block


def build_block(shard: Shard, ids: np.ndarray, texts: list[bytes | None]) -> Block:
    return block_of(shard, ids, *_postings(shard, texts))


def _unpacked(bitmaps: list[int], n_docs: int) -> np.ndarray:
    """A row of 0 and 1 a bitmap."""
    width = -(-n_docs // 8)
    raw = b"".join([b.to_bytes(width, "little") for b in bitmaps])
    rows = np.frombuffer(raw, np.uint8).reshape(len(bitmaps), width)
    return np.unpackbits(rows, axis=1, count=n_docs, bitorder="little")


def masks(block: Block, terms: list[tuple[int, int]], least: int, n_docs: int) -> list[tuple[int, int]]:
    """(largest score, bitmap) of every presence mask that can reach ``least``.

    ``terms`` are numbers with weights.  Largest scores are summed for all
    documents at once; only those that can reach ``least`` are grouped.
    """
    held = [t for t, _ in terms if t in block.bitmap]
    if not held:
        return []
    gains = [w * block.largest[t] for t, w in terms if t in block.bitmap]
    most = block.sums(held, np.repeat(gains, [len(block.docs[t]) for t in held]))
    docs = np.flatnonzero(most >= least)
    present = _unpacked([block.bitmap[t] for t in held], n_docs)[:, docs].T.tobytes()
    groups: dict[tuple[int, bytes], int] = {}
    starts = range(0, len(present), len(held))
    for doc, score, start in zip(docs.tolist(), most[docs].tolist(), starts, strict=True):
        mask = (score, present[start : start + len(held)])
        groups[mask] = groups.get(mask, 0) | 1 << doc
    return [(score, group) for (score, _), group in groups.items()]


def search_block(block: Block, terms: list[tuple[int, int]], weights: np.ndarray, best: Best) -> None:
    """Evaluate masks by descending largest score until the item's list is safe."""
    n_docs = len(block.ids)
    held = sorted(masks(block, terms, best.least, n_docs), key=lambda m: m[0], reverse=True)
    numbers = [t for t, _ in terms]
    at = 0
    while at < len(held) and held[at][0] >= best.least:
        # a list that is not full first takes as many masks as fill it: a score they
        # reach may end the search
        until = len(held) if len(best.doc) == best.k else at + best.k
        group = reduce(or_, [bits for most, bits in held[at:until] if most >= best.least])
        docs = np.flatnonzero(_unpacked([group], n_docs)[0])
        best.add(block.scores(docs, weights, numbers), block.ids[docs])
        at = until


LAST = (1 << 63) - 1  # stands for a null id, which comes last


def partial_ranks(rows: DataFrame, shard: Shard, k: int) -> DataFrame:
    """The best ``k`` documents of each item within each task, from rows of postings."""
    shared = rows.sparkSession.sparkContext.broadcast(shard)

    def build(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = shared.value
        best = [Best(k) for _ in own.items]
        items = [[(t, int(own.weights[t])) for t in item if own.weights[t]] for item in own.items]
        size = FIRST_BLOCK
        for batch in batches:
            at = 0
            while at < batch.num_rows:
                ids, n, terms, tf = batch.slice(at, size).columns
                at, size = at + size, min(BLOCK, 2 * size)
                block = block_of(
                    own,
                    ids.fill_null(LAST).to_numpy(),
                    np.repeat(np.arange(len(ids)), pc.list_value_length(terms).to_numpy()),
                    terms.flatten().to_numpy(),
                    tf.flatten().to_numpy().astype(np.int64),
                    n.to_numpy(),
                )
                for found, top in zip(items, best, strict=True):
                    search_block(block, found, own.weights, top)
        for item, x in enumerate(best):
            if len(x.doc):
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(np.full(len(x.doc), item)),
                        pa.array(x.doc, mask=x.doc == LAST),
                        pa.array(x.score),
                    ],
                    names=["item", "doc_id", "score"],
                )

    return rows.mapInArrow(build, "item long, doc_id long, score long")


def best_rows(rows: DataFrame, k: int, *keys: str) -> DataFrame:
    order = Window.partitionBy(*keys).orderBy(F.desc("score"), F.asc_nulls_last("doc_id"))
    return rows.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)


def shards(items: DataFrame, shard_bytes: int = SHARD_BYTES) -> Iterator[tuple[list, Shard]]:
    """Items in shards of bounded text, with the ids of their rows, one shard at a time."""
    rows: list = []
    size = 0
    for r in items.select("item_id", "text").where("text is not null").toLocalIterator():
        text = r.text.encode()
        if rows and size + len(text) > shard_bytes:
            yield [i for i, _ in rows], build_shard([t for _, t in rows])
            rows, size = [], 0
        rows.append((r.item_id, text))
        size += len(text)
    if rows:
        yield [i for i, _ in rows], build_shard([t for _, t in rows])


def ranked(docs: DataFrame, items: DataFrame, k: int = 50, shard_bytes: int = SHARD_BYTES) -> DataFrame:
    """item_id, rank, doc_id and score of each item's ``k`` best rows of ``docs``.

    Columns doc_id, text and item_id, text are read.  A null or empty text has no
    terms: such a document is found by nothing and does not count, such an item
    finds nothing.  Every row is a document or an item of its own, also one that
    repeats an id; equal scores go by ascending doc_id, a null id last.  An item
    with fewer documents above 0 gets those.  Empty tables give no rows.

    Items are sent to the executors in shards of at most ``shard_bytes`` of text
    (a single longer item is a shard); a larger table has more of them.  ``docs``
    is read once a shard.  The result is read from a table of its own; the rows of
    postings a shard was searched in are deleted.
    """
    spark = docs.sparkSession
    out = None
    for ids, shard in shards(items, shard_bytes):
        path = scratch_path(spark, "item-postings")
        rows = postings(docs, shard)
        rows.write.parquet(path)
        rows = spark.read.schema(rows.schema).parquet(path)
        found = partial_ranks(rows, weighted(rows, shard), k)
        # a task gives k rows an item at most; many tasks are first cut down by salt
        salt = F.pmod(F.xxhash64("doc_id"), F.lit(SALTS)).alias("salt")
        cut = best_rows(found.select("*", salt), k, "item", "salt").drop("rank", "salt")
        names = spark.createDataFrame(list(enumerate(ids)), f"item long, item_id {items.schema['item_id'].dataType.simpleString()}")
        top = best_rows(cut, k, "item").join(names.hint("broadcast"), "item")
        top = landed(top.select("item_id", "rank", "doc_id", "score"), "item-ranks")
        files.delete(spark, path)
        out = top if out is None else out.unionByName(top)
    if out is None:
        kind = items.schema["item_id"].dataType.simpleString()
        return spark.createDataFrame([], f"item_id {kind}, rank int, doc_id long, score long")
    return out

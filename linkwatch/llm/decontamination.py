"""Benchmark items in training passages: BM25 with block-max WAND, then verified.

The items are the indexed texts and every passage of every document is a query.
A passage is a run of words with an overlap as long as the longest item, so an
item that stands in a document stands whole in one of them.  Scores are divided
by the score an item gives itself; all items above a share of it are retrieved.
What is retrieved counts when enough of the item's question and of its answer
stand in the passage word for word, or, with ``LEAKS``, enough of the item as a
whole or one long run of its words: an item that is cut short or edited.
"""

from __future__ import annotations

import math
from bisect import bisect_left
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from linkwatch.llm.common import fresh, landed
from linkwatch.llm.shingles import Words, windows

_U = np.uint64
SLICE = 256
BLOCK = 8
MOST_BLOCKS = 512
COMMON_SHARE = 0.75
SHARD_BYTES = 16_000_000
LEAST_PASSAGE = 64
# fixed value: what stands between two words
MARKS = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"
HITS = (
    "doc_id long, item_id long, score double, question_overlap double, answer_overlap double,"
    " passage long"
)


@dataclass(frozen=True)
class Overlap:
    """``score`` is a share of an item's own BM25 score; overlaps are shares of word groups.

    With ``whole`` that share of all groups of an item counts as well, and with
    ``run`` so many of its words in a row, or half of the words of a shorter item.
    """

    score: float = 0.6
    question: float = 0.5
    answer: float = 0.5
    group: int = 3
    answer_share: float = 0.25
    k1: float = 1.2
    b: float = 0.75
    whole: float | None = None
    run: int | None = None


# what the registered query and the pipeline count
LEAKS = Overlap(whole=0.5, run=13)


@dataclass
class Index:
    """Postings of one shard of items: normalised impacts, whole and per block."""

    terms: np.ndarray  # sorted word hashes
    postings: list[tuple[list[int], list[float], float, list[int], list[float]]]
    items: list[int]
    question: list[np.ndarray]
    answer: list[np.ndarray]
    words: list[np.ndarray]
    passage: int
    common: np.ndarray  # terms that cannot reach the threshold without others
    bounds: tuple[np.ndarray, np.ndarray, np.ndarray]  # other terms: places, blocks, block maxima
    spare: np.ndarray  # most that common terms give an item of the block
    slot: np.ndarray = field(default_factory=lambda: np.zeros(0, np.int32))

    def look_up(self, hashes: np.ndarray) -> np.ndarray:
        """Term numbers, -1 for words that are in no item."""
        last = len(self.slot) - 1
        at = (hashes & _U(last)).astype(np.int64)
        found = self.slot[at]
        # a place that another term has taken: the word may stand in one of the next
        left = np.flatnonzero((found >= 0) & (self.terms[found] != hashes))
        while len(left):
            at[left] = (at[left] + 1) & last
            found[left] = self.slot[at[left]]
            left = left[(found[left] >= 0) & (self.terms[found[left]] != hashes[left])]
        return found


def _groups(words: np.ndarray, size: int) -> np.ndarray:
    return np.unique(windows(words, max(1, min(size, len(words)))))


def _slots(terms: np.ndarray) -> np.ndarray:
    """Term numbers by the last bits of their hashes, in the next free place each.

    There are at least four and at most eight places a term.
    """
    slot = np.full(1 << max(10, (4 * len(terms)).bit_length()), -1, np.int32)
    last = len(slot) - 1
    at = (terms & _U(last)).astype(np.int64)
    left = np.arange(len(terms))
    while len(left):
        free = left[slot[at[left]] < 0]
        slot[at[free]] = free  # of terms that meet, one stays
        left = left[slot[at[left]] != left]
        at[left] = (at[left] + 1) & last
    return slot


def build_index(
    rows: list[tuple[int, bytes]],
    frequency: dict[bytes, int],
    n_items: int,
    mean_length: float,
    rule: Overlap,
) -> Index:
    """The last words of an item are its answer, those before it its question."""
    kept, questions, answers, wholes, impacts = [], [], [], [], []
    longest = 1
    for item, text in rows:
        words = Words([text], plain=True)
        n = len(words.hash)
        if not n:
            continue
        longest = max(longest, n)
        split = n - max(1, math.ceil(rule.answer_share * n))
        questions.append(_groups(words.hash[:split], rule.group) if split else np.zeros(0, _U))
        answers.append(_groups(words.hash[split:], rule.group))
        wholes.append(words.hash)
        spans = zip(words.start.tolist(), words.end.tolist(), strict=True)
        counts = Counter(words.data[a:b] for a, b in spans)
        lengthened = rule.k1 * (1 - rule.b + rule.b * n / mean_length)
        own = {}
        for word, tf in counts.items():
            df = frequency.get(word, 1)
            idf = math.log(1 + (n_items - df + 0.5) / (df + 0.5))
            own[word] = idf * tf * (rule.k1 + 1) / (tf + lengthened)
        total = sum(own.values())
        impacts.append({w: x / total for w, x in own.items()})
        kept.append(item)
    vocabulary = sorted({w for x in impacts for w in x})
    hashes = Words([b"\n".join(vocabulary)], plain=True).hash
    order = np.argsort(hashes)
    number = {vocabulary[w]: t for t, w in enumerate(order.tolist())}
    lists: list[list[tuple[int, float]]] = [[] for _ in vocabulary]
    for i, x in enumerate(impacts):
        for w, value in x.items():
            lists[number[w]].append((i, value))
    postings = []
    for found in lists:
        items, values = [i for i, _ in found], [v for _, v in found]
        blocks = range(0, len(items), BLOCK)
        postings.append(
            (
                items,
                values,
                max(values),
                [items[min(k + BLOCK, len(items)) - 1] for k in blocks],
                [max(values[k : k + BLOCK]) for k in blocks],
            )
        )
    # the most frequent terms, as long as no item gets most of the threshold from them
    gained = np.zeros(len(kept))
    common = np.zeros(len(postings), bool)
    for t in sorted(range(len(postings)), key=lambda t: -len(postings[t][0])):
        items, values = postings[t][:2]
        if (gained[items] + values).max() <= COMMON_SHARE * rule.score:
            gained[items] += values
            common[t] = True
    width = max(1, -(-len(kept) // MOST_BLOCKS))
    spare = np.zeros(-(-len(kept) // width))
    np.maximum.at(spare, np.arange(len(kept)) // width, gained)
    places, blocks, maxima = [0], [], []
    for t, (items, values, *_) in enumerate(postings):
        best: dict[int, float] = {}
        for i, v in zip(items, values, strict=True) if not common[t] else ():
            best[i // width] = max(v, best.get(i // width, 0.0))
        blocks += best
        maxima += best.values()
        places.append(len(blocks))
    terms = hashes[order]
    return Index(
        terms,
        postings,
        kept,
        questions,
        answers,
        wholes,
        max(LEAST_PASSAGE, longest),
        common,
        (np.array(places), np.array(blocks, np.int64), np.array(maxima, np.float64)),
        spare,
        _slots(terms),
    )


def promising(index: Index, term: np.ndarray, first: np.ndarray, least: float):
    """Passages with a block of items whose bound reaches the threshold: text and first unit.

    A unit is a stretch of ``index.passage`` words, a passage is two units in a row.
    """
    units = -(-np.diff(first) // index.passage)
    start = np.r_[0, np.cumsum(units)]
    text = np.repeat(np.arange(len(units)), units)
    places, blocks, maxima = index.bounds
    hit = np.flatnonzero((term >= 0) & ~index.common[term])
    owner = np.searchsorted(first, hit, "right") - 1
    unit = start[owner] + (hit - first[owner]) // index.passage
    many = places[term[hit] + 1] - places[term[hit]]
    at = np.arange(many.sum()) - np.repeat(np.cumsum(many) - many, many)
    at += np.repeat(places[term[hit]], many)
    width = len(index.spare)
    bound = np.bincount(
        np.repeat(unit, many) * width + blocks[at], maxima[at], minlength=len(text) * width
    ).reshape(len(text), width)
    inner = np.flatnonzero(text[:-1] == text[1:])  # the unit after belongs to the text too
    both = bound.copy()
    both[inner] += bound[inner + 1]
    alone = np.r_[text[:-1] != text[1:], True] & (units[text] > 1)
    good = (both + index.spare >= least).any(axis=1) & ~alone[: len(text)]
    found = np.flatnonzero(good)
    return text[found], found - start[text[found]]


def search(index: Index, terms: list[int], least: float) -> list[tuple[int, float]]:
    """All items whose score for these distinct terms reaches ``least``, by block-max WAND."""
    cursors = [[index.postings[t][0][0], 0, index.postings[t]] for t in terms]
    found = []
    while cursors:
        cursors.sort(key=lambda c: c[0])
        bound, pivot = 0.0, -1
        for n, c in enumerate(cursors):
            bound += c[2][2]
            if bound >= least:
                pivot = n
                break
        if pivot < 0:
            break
        item = cursors[pivot][0]
        while pivot + 1 < len(cursors) and cursors[pivot + 1][0] == item:
            pivot += 1
        near, following = 0.0, 1 << 60
        for c in cursors[: pivot + 1]:
            block = bisect_left(c[2][3], item)
            if block < len(c[2][3]):
                near += c[2][4][block]
                following = min(following, c[2][3][block] + 1)
        if near < least:
            # no item up to the end of the nearest block can reach the threshold
            if pivot + 1 < len(cursors):
                following = min(following, cursors[pivot + 1][0])
            target, moved = max(item + 1, following), cursors[: pivot + 1]
        elif cursors[0][0] == item:
            score = sum(c[2][1][c[1]] for c in cursors[: pivot + 1])
            if score >= least:
                found.append((item, score))
            target, moved = item + 1, cursors[: pivot + 1]
        else:
            target, moved = item, [c for c in cursors[:pivot] if c[0] < item]
        ended = False
        for c in moved:
            items = c[2][0]
            c[1] = bisect_left(items, target, c[1])
            if c[1] < len(items):
                c[0] = items[c[1]]
            else:
                c[0], ended = -1, True
        if ended:
            cursors = [c for c in cursors if c[0] >= 0]
    return found


def stands(item: np.ndarray, passage: np.ndarray, rule: Overlap) -> bool:
    """Enough of the item as a whole, or a long enough run of it, is in the passage."""
    if rule.whole is not None:
        groups = _groups(item, rule.group)
        size = min(rule.group, len(item))
        if np.isin(groups, windows(passage, size)).mean() >= rule.whole:
            return True
    if rule.run is None:
        return False
    run = min(rule.run, max(len(item) // 2, min(rule.group, len(item))))
    return len(passage) >= run and bool(np.isin(windows(item, run), windows(passage, run)).any())


def passage_hits(index: Index, docs: DataFrame, rule: Overlap) -> DataFrame:
    """(doc, item) pairs that are retrieved and verified, best passage first."""
    sent = docs.sparkSession.sparkContext.broadcast(index)

    def query(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        index = sent.value
        for batch in batches:
            best: dict[tuple[int, int], tuple] = {}
            for at in range(0, batch.num_rows, SLICE):
                rows = batch.slice(at, SLICE)
                texts = [t.lower().encode() for t in rows.column(1).to_pylist()]
                words = Words(texts, plain=True)
                term = index.look_up(words.hash)
                ids = rows.column(0).to_pylist()
                owners, units = promising(index, term, words.first, rule.score - 1e-9)
                for o, u in zip(owners.tolist(), units.tolist(), strict=True):
                    a = int(words.first[o]) + u * index.passage
                    b = min(a + 2 * index.passage, int(words.first[o + 1]))
                    terms = np.unique(term[a:b])
                    terms = terms[terms >= 0]
                    for i, score in search(index, terms.tolist(), rule.score - 1e-9):
                        own = windows(words.hash[a:b], min(rule.group, b - a))
                        asked, said = index.question[i], index.answer[i]
                        q = np.isin(asked, own).mean() if len(asked) else 1.0
                        s = np.isin(said, own).mean() if len(said) else 1.0
                        if q < rule.question or s < rule.answer:
                            if not stands(index.words[i], words.hash[a:b], rule):
                                continue
                        key = (ids[o], index.items[i])
                        row = (score, float(q), float(s), a - int(words.first[o]))
                        if key not in best or row > best[key]:
                            best[key] = row
            out = [(*k, *v) for k, v in best.items()]
            kinds = [pa.int64(), pa.int64(), *[pa.float64()] * 3, pa.int64()]
            yield pa.RecordBatch.from_arrays(
                [pa.array([r[i] for r in out], k) for i, k in enumerate(kinds)],
                names=[x.split()[0] for x in HITS.split(", ")],
            )

    return docs.mapInArrow(query, HITS)


def contaminated(docs: DataFrame, benchmark: DataFrame, rule: Overlap = Overlap()) -> DataFrame:
    """One row per document and benchmark item found in it, with its best passage.

    Words are runs of ASCII letters, digits and characters beyond ASCII, in
    lower case.  Null or empty texts, on either side, match nothing; rows of the
    same id count together.  The index of a shard of items is bounded by
    ``SHARD_BYTES`` of text and sent to all executors; a larger benchmark has
    more shards, each of them queried by every passage.  Document frequencies
    and lengths are those of the whole benchmark.
    """
    words = F.filter(F.split(F.lower(F.coalesce("text", F.lit(""))), MARKS), lambda w: w != "")
    items = landed(
        benchmark.where(F.col("item_id").isNotNull()).select(
            F.col("item_id").cast("long").alias("item_id"), "text", words.alias("words")
        ),
        "benchmark-items",
    )
    sizes = items.agg(
        F.count("*"), F.avg(F.size("words")), F.sum(F.octet_length("text"))
    ).first()
    shards = max(1, -(-(sizes[2] or 0) // SHARD_BYTES))
    shard = F.pmod(F.xxhash64("item_id"), F.lit(shards))
    words = items.select(shard.alias("shard"), F.explode(F.array_distinct("words")).alias("word"))
    counted = words.groupBy("word").agg(F.count("*").alias("n"))
    texts = docs.select(F.col("doc_id").cast("long"), "text").where(F.col("text").isNotNull())
    found = None
    for k in range(shards):
        own = words.where(F.col("shard") == k).select("word").distinct().join(counted, "word")
        frequency = {r.word.encode(): r.n for r in own.collect()}
        rows = [
            (r.item_id, (r.text or "").lower().encode())
            for r in items.where(shard == k).orderBy("item_id").collect()
        ]
        index = build_index(rows, frequency, sizes[0], sizes[1] or 1.0, rule)
        if not index.items:
            continue
        hits = passage_hits(index, texts, rule)
        found = hits if found is None else found.unionByName(hits)
    if found is None:
        return docs.sparkSession.createDataFrame([], HITS)
    best = F.max(F.struct("score", "question_overlap", "answer_overlap", "passage"))
    return found.groupBy("doc_id", "item_id").agg(best.alias("b")).select("doc_id", "item_id", "b.*")


def clean_documents(docs: DataFrame, benchmark: DataFrame, rule: Overlap = Overlap()) -> DataFrame:
    """The documents in which no benchmark item was found; rows without an id stay."""
    name = fresh(docs.columns, "found_id")
    found = landed(contaminated(docs, benchmark, rule), "contaminated")
    found = found.select(F.col("doc_id").alias(name)).distinct()
    return docs.join(found, F.col("doc_id").cast("long") == F.col(name), "left_anti")

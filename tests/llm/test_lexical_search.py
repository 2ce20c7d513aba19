"""Mask search against scoring every document."""

from __future__ import annotations

import math
import re
from collections import Counter
from pathlib import Path

import numpy as np
import pytest
from pyspark.sql import functions as F

from linkwatch.llm import lexical_search
from linkwatch.llm.lexical_search import Best, build_block, build_shard, masks, postings, ranked, search_block
from linkwatch.session import shared_dir
from tests.llm.conftest import ODD_TEXTS

LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
TERM = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")


def terms(text):
    return TERM.findall((text or "").translate(LOWER))


def brute(docs, items, k=50):
    own = [(d, Counter(terms(t))) for d, t in docs]
    n_docs, n_terms = sum(bool(c) for _, c in own), sum(sum(c.values()) for _, c in own)
    df = Counter(t for _, c in own for t in c)
    out = []
    for item, text in items:
        found = []
        for d, c in own:
            n, score = sum(c.values()), 0
            for t in set(terms(text)) & set(c):
                w = math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[t] + 1)))
                m = 100 - 50 + (50 * n * n_docs) // n_terms
                score += w * ((1000000000 * c[t]) // (1000 * c[t] + 20 * m))
            if score > 0:
                found.append((-score, math.inf if d is None else d))
        for rank, (score, d) in enumerate(sorted(found)[:k], 1):
            out.append((item, rank, None if d == math.inf else d, -score))
    return sorted(out, key=str)


def result(df):
    assert df.columns == ["item_id", "rank", "doc_id", "score"]
    return sorted(map(tuple, df.collect()), key=str)


ITEMS = "item_id long, text string"


def corpus(rng, n, words=300):
    def word():
        return f"W{int(rng.paretovariate(0.6)) % words}"

    return [(i, " ".join(word() for _ in range(rng.randrange(1, 80)))) for i in range(n)]


def test_against_all_scores(spark, docs_of, rng, monkeypatch):
    monkeypatch.setattr(lexical_search, "FIRST_BLOCK", 8)
    docs = corpus(rng, 700)
    docs += [(900 + i, docs[i % 5][1]) for i in range(120)]  # ties
    docs += [(3, "w1 w2 w3"), (3, "w1 w2 w3"), (None, "w1 w2 w3 w4"), (801, None), (802, " .,; ")]
    items = corpus(rng, 25) + [(50, None), (51, ""), (52, "unseen words"), (53, "w1 w1 W1"), (53, "w2")]
    got = ranked(docs_of(docs, 7), spark.createDataFrame(items, ITEMS))
    assert result(got) == brute(docs, items)


def test_few_rows_and_many_shards(spark, docs_of, rng):
    docs, items = corpus(rng, 90), corpus(rng, 12)
    table = spark.createDataFrame(items, ITEMS)
    whole = result(ranked(docs_of(docs), table, k=7))
    assert whole == brute(docs, items, 7)
    assert result(ranked(docs_of(docs), table, k=7, shard_bytes=500)) == whole


def test_odd_and_empty_tables(spark, docs_of):
    docs = docs_of(list(enumerate(ODD_TEXTS)))
    for c in ("item", "score", "rank", "salt", "item_id"):
        docs = docs.withColumn(c, F.lit(c))
    items = spark.createDataFrame([(1, "ONE b"), (2, "wörd")], ITEMS).withColumn("doc_id", F.lit("x"))
    assert result(ranked(docs, items)) == brute(list(enumerate(ODD_TEXTS)), [(1, "ONE b"), (2, "wörd")])
    assert result(ranked(docs.limit(0), items)) == []
    assert result(ranked(docs, items.limit(0))) == []


@pytest.mark.parametrize("least", [1, 400, 900, 5000])
def test_masks_partition_the_block(rng, least):
    shard = build_shard([b"a b c d"])
    shard.weights, shard.n_docs, shard.n_terms = np.array([7, 5, 3, 1]), 60, 200
    texts = [" ".join(rng.choices("abcdxyz", k=rng.randrange(1, 7))).encode() for _ in range(60)]
    block = build_block(shard, np.arange(60), texts)
    terms_of_item = [(t, int(shard.weights[t])) for t in range(4)]
    found = masks(block, terms_of_item, least, 60)
    seen = 0
    for most, bits in found:
        assert not seen & bits
        seen |= bits
        held = {t for t in range(4) if block.bitmap.get(t, 0) & bits}
        assert all(block.bitmap[t] & bits == bits for t in held)
        assert most == sum(shard.weights[t] * block.largest[t] for t in held)
    some = [d for d in range(60) if any(block.bitmap.get(t, 0) >> d & 1 for t in range(4))]
    scores = dict(zip(some, block.scores(np.array(some), shard.weights).tolist(), strict=True))
    # whatever is not in a group cannot reach the score
    assert all(s < least for d, s in scores.items() if not seen >> d & 1)
    best = Best(5)
    search_block(block, terms_of_item, shard.weights, best)
    want = sorted((-s, d) for d, s in scores.items())[:5]
    assert list(zip((-best.score).tolist(), best.doc.tolist(), strict=True)) == want


def test_texts_are_read_once(spark, docs_of, rng):
    texts_read = spark.sparkContext.accumulator(0)

    def counted(text):
        texts_read.add(1)
        return text

    docs, items = corpus(rng, 60) + [(60, None), (61, "")], corpus(rng, 5)
    table = docs_of(docs).withColumn("text", F.udf(counted, "string")("text"))
    found = ranked(table, spark.createDataFrame(items, ITEMS))
    assert result(found) == result(found) == brute(docs, items)
    assert texts_read.value == len(docs)


def test_postings_hold_the_terms_of_items_and_all_lengths(docs_of):
    docs = list(enumerate([*ODD_TEXTS, " a\x00B--b a.", "\u00a0a b\u2028", "a\x1fb\x7fz"]))
    own = ["one", "wörd", "a", "b", "e"]
    rows = postings(docs_of(docs), build_shard([" ".join(own).encode()])).collect()
    got = {r.doc_id: (r.n, {own[t]: n for t, n in zip(r.terms, r.tf, strict=True)}) for r in rows}
    count = {d: Counter(terms(t)) for d, t in docs}
    assert len(rows) == len(docs)
    assert got == {d: (c.total(), {t: n for t, n in c.items() if t in own}) for d, c in count.items()}


def test_no_postings_stay_behind(spark, docs_of, rng):
    items = spark.createDataFrame(corpus(rng, 9), ITEMS)
    before = set(Path(shared_dir(spark)).glob("item-postings-*"))
    assert ranked(docs_of(corpus(rng, 30)), items, k=3, shard_bytes=400).count() == 27
    assert set(Path(shared_dir(spark)).glob("item-postings-*")) == before

"""Components of the sketch join against all pairs."""

from __future__ import annotations

import math
import re
import time

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from linkwatch.llm import parity_join
from linkwatch.llm.components import connected
from linkwatch.llm.parity_join import (
    Similarity,
    band_of,
    differing,
    segment_keys,
    similar_components,
    sketch,
)
from tests.llm.conftest import ODD_TEXTS, prose

LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
RULE = Similarity()


def shingles(text, k=4):
    words = re.findall(r"[^\x20\x09-\x0D]+", (text or "").translate(LOWER))
    if not words:
        return frozenset()
    k = min(k, len(words))
    return frozenset(tuple(words[i : i + k]) for i in range(len(words) - k + 1))


def brute(rows, rule=RULE):
    sets = {i: shingles(t, rule.words) for i, t in rows}
    root = {i: i for i in sets}

    def top(x):
        while root[x] != x:
            x = root[x]
        return x

    ids = sorted(sets)
    for n, a in enumerate(ids):
        for b in ids[n + 1 :]:
            both = len(sets[a] & sets[b])
            if both and rule.den * both >= rule.num * (len(sets[a]) + len(sets[b]) - both):
                x, y = top(a), top(b)
                root[max(x, y)] = min(x, y)
    return {i: (len(sets[i]), top(i)) for i in ids}


def edited(rng, words, share):
    out = list(words)
    for _ in range(max(1, int(share * len(words)))):
        kind, at = rng.randrange(3), rng.randrange(len(out))
        if kind == 0:
            out[at] = f"new{rng.randrange(10**6)}"
        elif kind == 1 and len(out) > 5:
            del out[at]
        else:
            out.insert(at, f"new{rng.randrange(10**6)}")
    return out


def near_copies(rng):
    rows = list(enumerate(ODD_TEXTS))
    line = prose(rng, 12)
    for _ in range(25):
        base = prose(rng, rng.choice([3, 6, 15, 40, 120, 400]), 3000)
        for _ in range(rng.choice([1, 2, 5, 20])):
            words = edited(rng, base, rng.choice([0.002, 0.01, 0.02, 0.04]))
            if rng.random() < 0.3:
                words = line + words
            text = " ".join(words)
            rows.append((len(rows), text.upper() if rng.random() < 0.2 else text))
            if rng.random() < 0.3:
                rows.append((len(rows), text.replace(" ", "\n", 3)))
    ids = rng.sample(range(5000), len(rows))
    return [(i, t) for i, (_, t) in zip(ids, rows, strict=True)]


@pytest.mark.parametrize("rule", [RULE, Similarity(words=5, num=80)])
def test_components_equal_all_pairs(docs_of, rng, rule):
    rows = near_copies(rng)
    docs = docs_of(rows).withColumn("sid", F.lit("x")).withColumn("key", F.lit(1))
    got = {r.doc_id: (r.n_shingles, r.component_id) for r in similar_components(docs, rule).collect()}
    assert got == brute(rows, rule)


def test_crowded_keys_are_split(docs_of, rng, monkeypatch):
    monkeypatch.setattr(parity_join, "BLOCK", 4)
    monkeypatch.setattr(parity_join, "STAR", 3)
    monkeypatch.setattr(parity_join, "BROADCAST_ROWS", 0)
    base = prose(rng, 60, 3000)
    rows = [(i, " ".join(edited(rng, base, rng.choice([0.01, 0.02, 0.03])))) for i in range(80)]
    got = {r.doc_id: (r.n_shingles, r.component_id) for r in similar_components(docs_of(rows)).collect()}
    assert got == brute(rows)


def test_null_ids_repeated_rows_and_empty_tables(docs_of):
    text = "a b c d e f g h i j"
    got = similar_components(docs_of([(None, text), (4, text), (4, text), (2, text), (9, None)]))
    assert sorted((r.doc_id or -1, r.component_id or -1) for r in got.collect()) == [
        (-1, -1), (2, 2), (4, 2), (4, 2), (9, 9),
    ]
    assert similar_components(docs_of([])).count() == 0


@settings(max_examples=60, deadline=None)
@given(st.integers(1, 600), st.integers(0, 10**6), st.floats(0, 1))
def test_linked_sets_share_a_key(size, seed, share):
    rng = np.random.default_rng(seed)
    a = np.unique(rng.integers(0, 1 << 63, size, dtype=np.uint64))
    most = next(d for d in range(len(a) + 1, -1, -1) if d <= RULE.apart(len(a), len(a) + d))
    extra = rng.integers(0, 1 << 63, int(share * most), dtype=np.uint64)
    b = np.union1d(a, extra)
    assert RULE.links(len(a), len(b), len(a))
    if len(b) > len(a):
        assert np.intersect1d(segment_keys(a, RULE), segment_keys(b, RULE)).size
    assert differing(sketch(a), sketch(b)) <= len(b) - len(a)


def test_bands_cover_every_linked_pair():
    for a in range(1, 800):
        for b in (a, min(RULE.largest(a), a + 1), RULE.largest(a)):
            shared = {x.number for x in band_of(a, RULE)} & {x.number for x in band_of(b, RULE)}
            assert shared or RULE.apart(a, b) == 0


@pytest.mark.parametrize("rule", [RULE, Similarity(words=5, num=80)])
def test_bands_of_very_large_sets_are_found_in_time(rule):
    begun = time.process_time()
    for size in (700_000, 5_000_000):
        bands = band_of(size, rule)
        assert bands
        for band in bands:
            mean = band.segments * math.exp(-band.low / band.segments)
            assert 3 * math.sqrt(mean) < band.spare - mean < 5 * math.sqrt(mean)
    assert time.process_time() - begun < 20


def test_spare_segments_of_small_bands_by_summing():
    for low in (*range(1, 60), 200, 1000, 3000):
        for rule in (RULE, Similarity(words=5, num=80)):
            most = rule.apart(low, rule.largest(low))
            spare = 0
            for spare in range(1, most + low + 2):
                m = most + 1 + spare
                mean = m * math.exp(-low / m)
                term = total = math.exp(-mean)
                for k in range(1, spare + 1):
                    term *= mean / k
                    total += term
                if 1 - total < 1e-4:
                    break
            assert parity_join._spare(low, most) == spare


def test_components_of_a_long_path(spark):
    n = 300
    edges = [(i, i + 1) for i in range(n)] + [(1000, 1001), (1001, 1000), (5, 5)]
    got = connected(spark.createDataFrame(edges, "a long, b long")).collect()
    want = {i: 0 for i in range(n + 1)} | {1000: 1000, 1001: 1000}
    assert len(got) == len(want) and {r.node: r.component for r in got} == want

"""Near-duplicate components against all pairs."""

from __future__ import annotations

import numpy as np
import pytest
from pyspark.sql import functions as F

from linkwatch.llm import circulant_minhash
from linkwatch.llm.circulant_minhash import (
    NearRule,
    band_keys,
    deduplicated,
    near_components,
    shingle_digests,
    signature,
)
from tests.llm.conftest import ODD_TEXTS, prose
from tests.llm.test_parity_join import brute as components
from tests.llm.test_parity_join import edited

RULE = NearRule()


def brute(rows):
    found = components(rows, RULE)
    return sorted((i, n, c, i == c) for i, (n, c) in found.items())


def result(df):
    assert df.columns == ["doc_id", "n_shingles", "component_id", "kept"]
    return sorted((tuple(r) for r in df.collect()), key=str)


def test_against_all_pairs(spark, docs_of, rng):
    rows, at = [], 0
    for size in [1, 2, 4, 5, 6, 7, 9, 12, 20, 60, 200, 900]:
        for _ in range(4):
            base = prose(rng, size)
            for share in (0, 0, 0.004, 0.01, 0.02, 0.04):
                rows.append((at, " ".join(edited(rng, base, share) if share else base)))
                at += 1
    rows += [(at, rows[50][1].upper()), (at + 1, "\n".join(rows[60][1].split()))]
    assert result(near_components(docs_of(rows))) == sorted(brute(rows), key=str)


@pytest.mark.parametrize("block", [512, 8])
def test_large_group_and_shared_passage(spark, docs_of, rng, monkeypatch, block):
    """Chains of near copies, copies, and texts alike in most but not enough words."""
    monkeypatch.setattr(circulant_minhash, "BLOCK", block)
    monkeypatch.setattr(circulant_minhash, "CUT_BLOCKS", 1)
    monkeypatch.setattr(circulant_minhash, "STAR", 4)
    base, rows = prose(rng, 80, 5000), []
    chain = list(base)
    for i in range(60):  # each is near the one before it
        chain = list(chain)
        chain[rng.randrange(len(chain))] = f"n{i}"
        rows.append((i, " ".join(chain)))
    rows += [(100 + i, rows[7][1]) for i in range(50)]
    shared = prose(rng, 60, 5000)
    rows += [(200 + i, " ".join(shared + prose(rng, 14, 5000))) for i in range(60)]
    assert result(near_components(docs_of(rows))) == sorted(brute(rows), key=str)


def test_words_with_structure_do_not_collide(spark, docs_of):
    """Words on which polynomial hashes modulo powers of two are equal."""
    word = "a"
    while len(word) < 4096:
        word += word.translate(str.maketrans("ab", "ba"))
    other = word.translate(str.maketrans("ab", "ba"))
    rows = [(1, " ".join([word] * 13)), (2, " ".join([other] * 13)), (3, word), (4, other)]
    assert [r[2] for r in result(near_components(docs_of(rows)))] == [1, 2, 3, 4]


def test_repeated_ids_nulls_and_odd_texts(spark, docs_of, rng):
    one, two, three = (" ".join(prose(rng, 50, 5000)) for _ in range(3))
    rows = [(5, one), (7, one), (7, two), (9, two), (9, two), (8, three), (None, three), (None, None)]
    got = [r[:3] for r in result(near_components(docs_of(rows)))]
    assert [c for i, _, c in got if i in (5, 7, 9)] == [5] * 5
    assert [c for i, _, c in got if i == 8] == [8] and [c for i, _, c in got if i is None] == [None] * 2
    docs = docs_of(list(enumerate(ODD_TEXTS)) + [(20, "x" * 30_000), (21, None)])
    for c in ("name", "node", "component", "component_id", "kept", "kept_id"):
        docs = docs.withColumn(c, F.lit(c))
    rows = list(enumerate(ODD_TEXTS)) + [(20, "x" * 30_000), (21, None)]
    assert result(near_components(docs)) == sorted(brute(rows), key=str)
    kept = deduplicated(docs)
    assert kept.columns == docs.columns
    assert {r.doc_id for r in kept.collect()} == {i for i, _ in rows} - {20}
    assert result(near_components(docs.limit(0))) == []


def test_signature_coordinates_are_minima_of_shifted_ranks(rng):
    s, _ = shingle_digests(" ".join(prose(rng, 3000)).encode(), 5)
    ranks = circulant_minhash._ranks(RULE.size)[:, 0]
    assert len(np.unique(ranks)) == circulant_minhash.PLACES
    place = (circulant_minhash.mix(s + np.uint64(0xC1)) >> np.uint64(64 - 22)).astype(np.int64)
    want = [ranks[(place + k) % circulant_minhash.PLACES].min() for k in range(RULE.size)]
    assert signature(s, RULE.size).tolist() == want


def test_signatures_estimate_similarity(rng):
    words = prose(rng, 2000, 10**6)
    text = lambda w: shingle_digests(" ".join(w).encode(), 5)[0]
    equal, exact, met = [], [], 0
    for n in range(40):
        a, b = text(words[: 40 + 20 * n]), text(edited(rng, words[: 40 + 20 * n], 0.015))
        x, y = (signature(s, RULE.size) for s in (a, b))
        both = len(np.intersect1d(a, b))
        exact.append(both / (len(a) + len(b) - both))
        equal.append((x == y).mean())
        met += bool(np.intersect1d(band_keys(x, RULE), band_keys(y, RULE)).size)
    assert abs(np.mean(equal) - np.mean(exact)) < 0.01
    assert max(abs(p - q) for p, q in zip(equal, exact, strict=True)) < 0.12
    assert met == 40

"""Retrieval against full scoring, and whole documents against planted items."""

from __future__ import annotations

from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from linkwatch.llm import decontamination
from linkwatch.llm.decontamination import (
    LEAKS,
    Overlap,
    build_index,
    clean_documents,
    contaminated,
    promising,
    search,
)
from linkwatch.llm.shingles import Words
from tests.llm.conftest import ODD_TEXTS, prose


def index_of(rows):
    words = {i: t.split() for i, t in rows}
    frequency = Counter(w.encode() for x in words.values() for w in set(x))
    mean = sum(map(len, words.values())) / len(words)
    return build_index([(i, t.encode()) for i, t in rows], frequency, len(rows), mean, Overlap())


@pytest.mark.parametrize("least", [0.05, 0.2, 0.4, 0.6, 0.9])
def test_search_returns_every_item_above_the_threshold(rng, least):
    rows = [(i, " ".join(prose(rng, rng.randrange(5, 40), 120))) for i in range(150)]
    index = index_of(rows)
    for _ in range(40):
        terms = sorted(rng.sample(range(len(index.terms)), rng.randrange(1, 70)))
        scores = Counter()
        for t in terms:
            for i, v in zip(*index.postings[t][:2], strict=True):
                scores[i] += v
        want = {i: s for i, s in scores.items() if s >= least}
        got = dict(search(index, terms, least))
        assert got.keys() == want.keys()
        assert all(got[i] == pytest.approx(want[i]) for i in want)


@pytest.mark.parametrize("most", [512, 7])
def test_passages_left_out_hold_no_item(rng, monkeypatch, most):
    monkeypatch.setattr(decontamination, "MOST_BLOCKS", most)
    index = index_of([(i, " ".join(prose(rng, 30, 60 + i * 10))) for i in range(80)])
    texts = [" ".join(prose(rng, n, 800)).encode() for n in (0, 1, 40, 64, 65, 128, 129, 700)] * 3
    words = Words(texts, plain=True)
    term = index.look_up(words.hash)
    least = 0.25
    owners, units = promising(index, term, words.first, least)
    got = set(zip(owners.tolist(), units.tolist(), strict=True))
    for o in range(len(texts)):
        n = int(words.first[o + 1] - words.first[o])
        for u in range(max(1, -(-n // index.passage) - 1) if n else 0):
            a = int(words.first[o]) + u * index.passage
            terms = np.unique(term[a : min(a + 2 * index.passage, int(words.first[o + 1]))])
            if search(index, terms[terms >= 0].tolist(), least):
                assert (o, u) in got
    assert all(u == 0 or u + 1 < -(-int(words.first[o + 1] - words.first[o]) // index.passage) for o, u in got)


def planted(rng):
    items = [(i, " ".join(prose(rng, rng.randrange(15, 60), 3000))) for i in range(40)]
    items += [(90, None), (91, " , ;"), (92, items[0][1])]
    rows, want = list(enumerate(ODD_TEXTS)), set()
    for i in range(100, 220):
        words = prose(rng, rng.randrange(0, 600), 3000)
        if i % 3 == 0:
            item, text = rng.choice(items[:40])
            at = rng.randrange(len(words) + 1)
            shown = text.upper().replace(" ", ", ") if i % 2 else text
            words = words[:at] + shown.split(" ") + words[at:]
            want.add((i, item))
            if item == 0:
                want.add((i, 92))
        rows.append((i, " ".join(words)))
    return items, rows, want


@pytest.mark.parametrize("shard_bytes", [16_000_000, 2_000])
def test_planted_items_are_found_and_nothing_else(spark, docs_of, rng, monkeypatch, shard_bytes):
    monkeypatch.setattr(decontamination, "SHARD_BYTES", shard_bytes)
    items, rows, want = planted(rng)
    benchmark = spark.createDataFrame(items, "item_id long, text string")
    docs = docs_of(rows).withColumn("item_id", F.lit("own"))
    got = {(r.doc_id, r.item_id) for r in contaminated(docs, benchmark).collect()}
    assert got == want
    clean = clean_documents(docs, benchmark)
    assert clean.columns == docs.columns
    assert {r.doc_id for r in clean.collect()} == {i for i, _ in rows} - {i for i, _ in want}


def test_question_alone_is_not_enough(spark, docs_of, rng):
    words = prose(rng, 40, 5000)
    benchmark = spark.createDataFrame([(1, " ".join(words))], "item_id long, text string")
    docs = docs_of([(1, " ".join(words[:30])), (2, " ".join(words)), (None, " ".join(words))])
    assert [r.doc_id for r in contaminated(docs.where("doc_id > 0"), benchmark).collect()] == [2]
    assert {r.doc_id for r in clean_documents(docs, benchmark).collect()} == {1, None}


def test_cut_and_edited_items_are_found(spark, docs_of, rng):
    """Items of 12 to 60 words, cut at either end or with a word changed anywhere."""
    items = [(i, prose(rng, n, 5000)) for i, n in enumerate((12, 16, 20, 24, 28, 40, 60))]
    rows, want = {}, set()

    def plant(item, words):
        doc = len(rows)
        rows[doc] = prose(rng, 90, 5000) + words + prose(rng, 90, 5000)
        want.add((doc, item))

    for i, words in items:
        most = len(words) * 3 // 4
        plant(i, words[:most])
        plant(i, words[-most:])
        for at in range(0, len(words), 3):
            plant(i, words[:at] + ["other"] + words[at + 1 :])
        plant(i, words[: len(words) - 3] + ["other"] + words[len(words) - 2 :])
        plant(i, words[:5] + ["more"] + words[5:])
    for _ in range(30):
        rows[len(rows)] = prose(rng, 200, 5000)
    for i, words in items:  # words of an item in another order are not the item
        rows[len(rows)] = prose(rng, 90, 5000) + rng.sample(words, len(words)) + prose(rng, 90, 5000)
    benchmark = spark.createDataFrame(
        [(i, " ".join(w)) for i, w in items], "item_id long, text string"
    )
    docs = docs_of([(i, " ".join(w)) for i, w in rows.items()])
    found = {(r.doc_id, r.item_id) for r in contaminated(docs, benchmark, LEAKS).collect()}
    assert found == want
    assert {r.doc_id for r in clean_documents(docs, benchmark, LEAKS).collect()} == {
        i for i in rows if i not in {d for d, _ in want}
    }


def test_empty_tables(spark, docs_of):
    none = spark.createDataFrame([], "item_id long, text string")
    assert contaminated(docs_of([(1, "a b c")]), none).count() == 0
    some = spark.createDataFrame([(1, "a b c")], "item_id long, text string")
    assert clean_documents(docs_of([]), some).count() == 0


def test_index_stays_small_and_finds_words_whose_places_meet(rng):
    words = [f"w{n}" for n in range(20_000)]
    rows = [(i, " ".join(words[i * 40 : i * 40 + 40])) for i in range(500)]
    index = index_of(rows)
    assert len(index.slot) <= 8 * len(words)
    assert index.look_up(index.terms).tolist() == list(range(len(words)))
    others = Words([" ".join(f"x{n}" for n in range(5_000)).encode()], plain=True).hash
    assert (index.look_up(others) == -1).all()
    same = np.arange(9, dtype=np.uint64) << np.uint64(40)  # one place for all of them
    index.terms, index.slot = same, decontamination._slots(same)
    assert index.look_up(same[::-1]).tolist() == list(range(9))[::-1]
    assert index.look_up(same + np.uint64(1 << 60)).tolist() == [-1] * 9

"""Passage removal against a direct count of windows."""

from __future__ import annotations

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from linkwatch.llm.substring_dedup import Automaton, Passages, deduplicated
from tests.llm.conftest import ODD_TEXTS, prose


def brute(rows, length=13):
    words = [(i, (t or "").encode().split()) for i, t in rows]
    first = {}
    for i, w in words:
        for k in range(len(w) - length + 1):
            key = tuple(w[k : k + length])
            if i is not None:
                first[key] = min(first.get(key, i), i)
    out = []
    for i, w in words:
        gone = set()
        for k in range(len(w) - length + 1):
            if i is not None and first[tuple(w[k : k + length])] < i:
                gone.update(range(k, k + length))
        kept = b" ".join(x for k, x in enumerate(w) if k not in gone).decode()
        out.append((-1 if i is None else i, len(w), len(gone), kept))
    return sorted(out)


def passages(rng):
    shared = [prose(rng, rng.randrange(8, 60), 5000) for _ in range(6)]
    rows = list(enumerate(ODD_TEXTS))
    for _ in range(120):
        words = []
        for _ in range(rng.randrange(1, 5)):
            words += prose(rng, rng.randrange(0, 40), rng.choice([3, 5000]))
            piece = rng.choice(shared)
            a = rng.randrange(len(piece) // 2)
            words += piece[a : a + rng.randrange(5, 60)]
        rows.append((len(rows), rng.choice([" ", "\n", "  "]).join(words)))
    rows += [(50, rows[50][1]), (3, rows[60][1]), (None, rows[70][1])]
    return rows


@pytest.mark.parametrize("shard", [1000, 3])
def test_equals_direct_count(docs_of, rng, shard):
    rows = passages(rng)
    docs = docs_of(rows).withColumn("n_words", F.lit("own")).withColumn("row_key", F.lit(1))
    cut = deduplicated(docs, Passages(shard=shard))
    assert cut.columns[:-2] == docs.columns
    got = sorted(
        (-1 if r.doc_id is None else r.doc_id, r[-2], r[-1], " ".join(r.text.split()))
        for r in cut.collect()
    )
    assert got == brute(rows)


def test_untouched_texts_and_line_breaks_stay(docs_of):
    a = " ".join(f"w{i}" for i in range(13))
    rows = [(1, f"first\n\n  {a}"), (2, f"x\ny {a}\nz  q"), (3, "  plain\n text ")]
    got = {r.doc_id: r.text for r in deduplicated(docs_of(rows)).collect()}
    assert got == {1: rows[0][1], 2: "x\ny\nz  q", 3: rows[2][1]}


def test_empty_table(docs_of):
    assert deduplicated(docs_of([])).count() == 0


@settings(max_examples=200, deadline=None)
@given(st.lists(st.lists(st.sampled_from([b"a", b"b", b"c"]), max_size=14), max_size=6))
def test_automaton_finds_the_windows_of_earlier_owners(texts):
    automaton, seen = Automaton(), set()
    for owner, words in enumerate(texts):
        runs = [tuple(words[i : i + 3]) for i in range(len(words) - 2)]
        bits = automaton.repeated(words, owner, 3)
        assert bits == sum(1 << i for i, r in enumerate(runs) if r in seen)
        automaton.add(words, owner)
        assert not automaton.repeated(words, owner, 3) & ~bits
        seen.update(runs)

"""Word hashes: equal for equal words wherever they stand, different else."""

from __future__ import annotations

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from linkwatch.llm.parity_join import similar_components
from linkwatch.llm.shingles import Words
from linkwatch.llm.substring_dedup import Passages, deduplicated


def morse(n: int) -> tuple[str, str]:
    word = "a"
    while len(word) < n:
        word += word.translate(str.maketrans("ab", "ba"))
    return word, word.translate(str.maketrans("ab", "ba"))


@pytest.mark.parametrize("n", [64, 1024, 4096, 8192])
def test_words_of_two_letters_in_mirrored_order(n):
    one, other = morse(n)
    hashes = Words([f"{one} {other} {one[::-1]}x {one}".encode()]).hash
    assert len(set(hashes.tolist())) == 3 and hashes[0] == hashes[3]


@settings(max_examples=200, deadline=None)
@given(st.lists(st.text(alphabet="abAé \n\t", max_size=200), min_size=1, max_size=6))
def test_hash_depends_on_the_word_alone(texts):
    raw = [t.encode() for t in texts]
    words = Words(raw)
    spelled = [w for t in raw for w in t.split()]
    assert [words.data[a:b] for a, b in zip(words.start, words.end, strict=True)] == spelled
    alone = {w: Words([w]).hash[0] for w in set(spelled)}
    assert words.hash.tolist() == [int(alone[w]) for w in spelled]
    assert len({int(h) for h in alone.values()}) == len(alone)
    counts = np.diff(words.first).tolist()
    assert counts[: len(raw)] == [len(t.split()) for t in raw] or sum(counts) == len(spelled)


def test_documents_of_colliding_polynomials_are_not_copies(spark, docs_of):
    one, other = morse(1024)
    docs = docs_of([(1, " ".join([one] * 13)), (2, " ".join([other] * 13))])
    cut = {r.doc_id: r.n_removed for r in deduplicated(docs, Passages(length=13)).collect()}
    assert cut == {1: 0, 2: 0}
    assert {r.component_id for r in similar_components(docs).collect()} == {1, 2}

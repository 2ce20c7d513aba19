"""Base phrases against a scan of all words, templates against their own texts."""

from __future__ import annotations

import re

import pytest
from pyspark.sql import functions as F

from linkwatch.llm.license_scan import (
    BASE_PHRASES,
    DOCUMENTS,
    DRIFTS,
    NOTICES,
    TEMPLATES,
    PositionalIndex,
    document_frequencies,
    scanned,
)
from tests.llm.conftest import ODD_TEXTS, prose

LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def brute(text):
    words = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", (text or "").translate(LOWER))
    found = [
        (i, label)
        for label, phrase in BASE_PHRASES.items()
        for p in [phrase.split()]
        for i in range(len(words) - len(p) + 1)
        if words[i : i + len(p)] == p
    ]
    places = [i for i, _ in found]
    labels = ",".join(sorted({k for _, k in found}))
    return len(words), len(found), min(places, default=None), max(places, default=None), labels


def test_base_columns(docs_of, rng):
    texts = ODD_TEXTS + ["ALL rights-reserved. cc/by CC  BY", "acc by cc bye éall rights reserved"]
    for _ in range(80):
        words = prose(rng, rng.randrange(0, 60))
        for _ in range(rng.randrange(3)):
            at = rng.randrange(len(words) + 1)
            words[at:at] = rng.choice([*BASE_PHRASES.values(), "cc", "general public"]).split()
        texts.append(rng.choice([" ", ", ", "\n"]).join(words))
    docs = docs_of(list(enumerate(texts)) + [(0, None)]).withColumn("labels", F.lit("own"))
    rows = scanned(docs, document_frequencies(docs)).collect()
    assert len(rows) == len(texts) + 1
    for r in rows:
        got = (r.n_words, r.n_base, r.first_word, r.last_word, r.base_labels)
        assert got == brute(texts[r.doc_id])
        assert 0 <= r.score <= 1 and set(r.base_labels.split(",")) <= set(r.labels.split(","))


def test_notices_are_found_in_long_texts(docs_of, rng):
    rows = []
    for i, (_, _, notice) in enumerate(NOTICES):
        words = prose(rng, 300)
        words[150:150] = notice.upper().split()
        rows.append((i, " ".join(words)))
    docs = docs_of(rows)
    frequencies = document_frequencies(docs)
    for r in scanned(docs, frequencies).collect():
        assert NOTICES[r.doc_id][0] in r.labels.split(",") and r.score == pytest.approx(1.0)
    found = scanned(docs, frequencies, findings=True).where("start between 145 and 175")
    assert {r.doc_id for r in found.collect()} == set(range(len(NOTICES)))


def test_a_phrase_without_its_notice_needs_enough_of_it(docs_of):
    phrase = "redistribution and use in source and binary forms"
    rows = [(0, phrase), (1, phrase + " with or without modification are permitted provided that"), (2, "the mit of license")]
    got = {r.doc_id: (r.labels, r.score) for r in scanned(docs_of(rows), {}, least=0.7).collect()}
    assert got[0] == ("", 0.0) and got[1][0] == "bsd" and got[2] == ("", 0.0)


def aligned(index, words):
    """Every template tried at every word, without postings."""
    out = []
    for n, t in enumerate(TEMPLATES):
        for key in range(len(words) - len(t.phrase) + 1):
            if tuple(words[key : key + len(t.phrase)]) != t.phrase:
                continue
            got = sum(1 + index.idf[w] for w in t.phrase)
            for ks in (range(t.at)[::-1], range(t.at + len(t.phrase), len(t.words))):
                base = key - t.at
                for k in ks:
                    for d in DRIFTS:
                        j = base + k + d
                        if 0 <= j < len(words) and words[j] == t.words[k]:
                            got, base = got + 1 + index.idf[t.words[k]], base + d
                            break
            out.append((n, key, round(got / index.weight[n], 9)))
    return sorted(out)


def edited(rng, words, phrase, edits):
    """The words with some changed, lost or added outside the phrase."""
    out = list(words)
    for _ in range(edits):
        at = next(i for i in range(len(out)) if out[i : i + len(phrase)] == phrase)
        free = [i for i in range(len(out) + 1) if not at < i < at + len(phrase)]
        i = rng.choice(free)
        if rng.random() < 0.5 or i in (at, len(out)):
            out[i:i] = [b"edit"]
        elif rng.random() < 0.5:
            out[i] = b"edit"
        else:
            del out[i]
    return out


@pytest.mark.parametrize("counts", [{}, {DOCUMENTS: 500, b"by": 400, b"cc": 3, b"license": 80, b"gnu": 9}])
def test_postings_give_what_an_alignment_at_every_word_gives(rng, counts):
    index = PositionalIndex(counts)
    vocabulary = sorted({w for t in TEMPLATES for w in t.words})
    for _ in range(150):
        words = [w.encode() for w in prose(rng, rng.randrange(0, 40))]
        words += [rng.choice(vocabulary) for _ in range(rng.randrange(0, 60))]
        for t in rng.sample(TEMPLATES, rng.randrange(4)):
            at = rng.randrange(len(words) + 1)
            words[at:at] = edited(rng, t.words, list(t.phrase), rng.randrange(3)) if not t.base else t.words
        got = sorted((n, key, round(share, 9)) for n, key, share in index.scan(words))
        assert got == aligned(index, words)


def test_recall_of_cut_moved_and_edited_notices(docs_of, rng):
    rows, wanted = [], {}
    for copy in range(6):
        for label, phrase, notice in NOTICES:
            own, key = notice.encode().split(), phrase.encode().split()
            at = next(i for i in range(len(own)) if own[i : i + len(key)] == key)
            if copy % 3 == 0:  # cut at either end, the phrase stays
                own = own[rng.randrange(at + 1) :][: max(len(own) - 2, at + len(key))]
            elif copy % 3 == 1:
                own = edited(rng, own, key, 2)
            words = [w.encode() for w in prose(rng, 200)]
            place = rng.randrange(len(words) + 1)
            words[place:place] = own
            wanted[len(rows)] = label
            rows.append((len(rows), b" ".join(words).decode()))
        rows.append((len(rows), " ".join(prose(rng, 200))))
    docs = docs_of(rows)
    got = {r.doc_id: r.labels.split(",") for r in scanned(docs, document_frequencies(docs)).collect()}
    caught = sum(label in got[i] for i, label in wanted.items())
    assert caught >= 0.9 * len(wanted)
    assert all(got[i] == [""] for i in got if i not in wanted)


def test_documents_are_counted_whether_they_hold_licence_words_or_not(docs_of):
    docs = docs_of([(0, "cc by"), (1, None), (2, "plain"), (2, "plain"), (3, "")])
    assert document_frequencies(docs) == {DOCUMENTS: 5, b"cc": 1, b"by": 1}


def test_empty_table(docs_of):
    assert scanned(docs_of([]), document_frequencies(docs_of([]))).count() == 0

"""Token alignment against whole-text encoding and all pairs of tokens."""

from __future__ import annotations

import hashlib
import json
import re
from collections import Counter, defaultdict

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from linkwatch.llm.token_alignment import (
    Aligner,
    aligned_tokens,
    common_ends,
    default_tokenizers,
    overlaps,
)
from tests.llm.conftest import ODD_TEXTS

TEXTS = [
    "The quick  brown fox.\nJumps over\t the  lazy dog ",
    "  two blanks first",
    "\nline first and <s> or <|endoftext|> inside, </s> too",
    "日本語のテキスト と emoji 🎉🎉 naïve café",
    "trailing   ",
    " ",
    "\n \n  a   b c \x1c d \x85 e",
    "literal ▁ mark",
    "<0x41> <0x0A>",
    "don't won't 's x's ''s 12345 67 ###$$$ %%%",
    "a\x00b",
    "word " * 50,
    "word " * 50,
]


class Whole:
    """Both libraries on whole texts."""

    def __init__(self):
        import sentencepiece
        from tokenizers import Tokenizer

        files = default_tokenizers()
        self.a = Tokenizer.from_file(files.byte_level)
        self.a.encode_special_tokens = True
        spelled = json.load(open(files.byte_level, encoding="utf-8"))["model"]["vocab"]
        # the inverse of the usual byte-level alphabet, built byte by byte from single tokens
        letters, extra = {}, 0
        for b in range(256):
            if 0x21 <= b <= 0x7E or 0xA1 <= b <= 0xAC or 0xAE <= b:
                letters[chr(b)] = b
            else:
                letters[chr(256 + extra)] = b
                extra += 1
        self.raw = {i: bytes(letters[c] for c in t) for t, i in spelled.items()}
        self.b = sentencepiece.SentencePieceProcessor(model_file=files.pieces)

    def spans(self, text):
        a = self.a.encode(" " + text, add_special_tokens=False).ids
        b = self.b.encode(text)
        raw_a = [self.raw[i] for i in a]
        raw_b = []
        for i in b:
            piece = self.b.id_to_piece(i)
            one = re.fullmatch("<0x(..)>", piece)
            raw_b.append(bytes([int(one[1], 16)]) if one else piece.replace("▁", " ").encode())
        want = (" " + text).encode()
        if not text or b"".join(raw_a) != want or b"".join(raw_b) != want:
            return [], []
        return self.placed(a, raw_a), self.placed(b, raw_b)

    @staticmethod
    def placed(ids, raw):
        out, at = [], 0
        for i, r in zip(ids, raw, strict=True):
            out.append((i, at, at + len(r)))
            at += len(r)
        return out


@pytest.fixture(scope="module")
def whole():
    return Whole()


def brute(whole, rows):
    spans = [whole.spans(t or "") for _, t in rows]
    links = [
        [(x[0], y[0]) for x in a for y in b if x[1] < y[2] and y[1] < x[2]] for a, b in spans
    ]
    count = Counter(p for one in links for p in set(one))
    best = defaultdict(int)
    for (a, _), n in count.items():
        best[a] = max(best[a], n)
    out = []
    for (doc, _), (a, b), own in zip(rows, spans, links, strict=True):
        cuts = sorted({x[2] for x in a} & {y[2] for y in b})
        groups, low = [], 0
        for cut in cuts:
            parts = [[str(t[0]) for t in side if low <= t[1] and t[2] <= cut] for side in (a, b)]
            groups.append("|".join(map(",".join, parts)))
            low = cut
        digest = hashlib.sha256(";".join(groups).encode()).hexdigest() if a else ""
        n_best = sum(count[p] == best[p[0]] for p in own)
        out.append(
            (doc, len(a), len(b), len(groups), len(own), digest, n_best, sum(count[p] for p in own))
        )
    return sorted(out, key=str)


COLUMNS = ["doc_id", "n_a", "n_b", "n_groups", "n_links", "groups_sha256", "n_best", "count_sum"]


def result(df):
    assert df.columns == COLUMNS
    return sorted(map(tuple, df.collect()), key=str)


@pytest.mark.parametrize("head", [1 << 19, 40, 0])
def test_against_whole_texts(spark, docs_of, whole, head):
    rows = list(enumerate(TEXTS + [None, ""])) + [(3, TEXTS[3]), (None, "no id")]
    assert result(aligned_tokens(docs_of(rows), head_pairs=head)) == brute(whole, rows)


def test_given_texts(spark, whole):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").limit(60)
    rows = [(r.doc_id, r.text) for r in docs.select("doc_id", "text").collect() if len(r.text) < 4000]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    assert result(aligned_tokens(df)) == brute(whole, rows)


def test_odd_and_empty_tables(spark, docs_of):
    docs = docs_of(list(enumerate(ODD_TEXTS)))
    for c in ("row", "n", "pairs", "links", "pair"):
        docs = docs.withColumn(c, F.lit(c))
    got = result(aligned_tokens(docs))
    assert len(got) == len(ODD_TEXTS)
    zero = {r[0]: r for r in got if r[1] == 0}
    assert set(zero) == {0, 1} and all(r[1:] == (0, 0, 0, 0, "", 0, 0) for r in zero.values())
    assert result(aligned_tokens(docs.limit(0))) == []


ENDS = st.lists(st.integers(1, 60), unique=True).map(sorted)


@settings(max_examples=300, deadline=None)
@given(ENDS, ENDS, st.integers(0, 3))
def test_common_ends(a, b, cuts):
    both = sorted(set(a) & set(b))
    want = [(a.index(x), b.index(x)) for x in both]
    known = np.array(both[:: cuts + 1] if cuts else [], np.int64)
    i, j = common_ends(np.array(a, np.int64), np.array(b, np.int64), known)
    assert list(zip(i.tolist(), j.tolist(), strict=True)) == want


@settings(max_examples=200, deadline=None)
@given(ENDS, ENDS)
def test_overlaps(a, b):
    if not a or not b:
        return
    b = sorted({x for x in b if x < a[-1]} | {a[-1]})
    spans = lambda ends: list(zip([0, *ends[:-1]], ends, strict=True))
    want = [[j for j, (s, e) in enumerate(spans(b)) if s < y and x < e] for x, y in spans(a)]
    first, last = overlaps(np.array(a), np.array(b))
    assert [list(range(x, y + 1)) for x, y in zip(first, last, strict=True)] == want


@settings(max_examples=150, deadline=None)
@given(st.text(alphabet=" \n\ta1.é▁日 \x1c'sS", max_size=30))
def test_stretches_do_not_change_tokens(text):
    aligner = _shared()
    got = [p for p in aligner.align([text])[0]]
    a = aligner.a.encode(" " + text, add_special_tokens=False).ids if text else []
    b = aligner.b.encode(text) if text else []
    if None in got:
        assert b"".join(aligner.bytes_b[i] for i in b) != (" " + text).encode()
        return
    sides = [g.split("|") for p in got for g in p[1][:-1].split(";")]
    ids = lambda k: [int(x) for s in sides for x in s[k].split(",")]
    assert (ids(0), ids(1)) == (a, b)


_made: list[Aligner] = []


def _shared() -> Aligner:
    if not _made:
        _made.append(Aligner(default_tokenizers(), cached=50))
    return _made[0]

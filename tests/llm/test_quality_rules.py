"""Measures, exact bounds and cutoffs against plain Python."""

from __future__ import annotations

import math
import re
from fractions import Fraction

import pytest
from pyspark.sql import functions as F

from linkwatch.llm.quality_rules import (
    RULES,
    Risk,
    binomial_tail,
    kept_documents,
    measured,
    quality_verdicts,
)
from tests.llm.conftest import ODD_TEXTS, prose

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def brute(text):
    text = text or ""
    words = WORD.findall(text)
    places = {}
    for i in range(len(words) - 7):
        places.setdefault(tuple(words[i : i + 8]), []).append(i)
    covered = {j for p in places.values() if len(p) > 1 for i in p for j in range(i, i + 8)}
    lines = [x for x in text.split("\n") if WORD.search(x)]
    return (
        len(words),
        sum(map(len, words)),
        len(re.findall(r"[#*$%&|<>]", text)),
        text.count("!"),
        len(lines),
        len(lines) - len(set(lines)),
        len(covered),
    )


def test_measures(docs_of, rng):
    texts = ODD_TEXTS + [
        " ".join(prose(rng, rng.randrange(5, 200), rng.choice([2, 5, 1000]))) for _ in range(60)
    ]
    texts += ["a # b\n\n a # b\r\na # b", "a b c d e f g h " * 2, "x y\n" * 9, "\x0b\x0c\r a"]
    rows = measured(docs_of(list(enumerate(texts))), "m").select("doc_id", "m.*").collect()
    for r in rows:
        got = (
            r.n_words, r.word_chars, r.n_symbols, r.n_exclaims, r.n_lines, r.n_dup_lines,
            r.n_repeat_words,
        )
        assert got == brute(texts[r.doc_id])


def test_binomial_tail_is_exact(spark):
    cases = [(0, 5), (1, 40), (3, 500), (17, 2000), (0, 19), (2, 21), (30, 100)]
    rate = 0.05
    rows = spark.createDataFrame(cases, "k long, n long")
    got = rows.select("k", "n", binomial_tail(F.col("k"), F.col("n"), rate).alias("p")).collect()
    for r in got:
        exact = sum(
            math.comb(r.n, i) * Fraction(1, 20) ** i * Fraction(19, 20) ** (r.n - i)
            for i in range(r.k + 1)
        )
        want = 1.0 if r.k >= r.n * rate else float(exact)
        assert r.p == pytest.approx(want, rel=1e-9)


def corpus(rng):
    rows, labels = [], []
    for i in range(1600):
        words = prose(rng, 40)
        good = i % 5 != 0
        if not good:
            words = [w + "%%%" for w in words]
        rows.append((i, " ".join(words)))
        labels.append((i, int(good)))
    return rows, labels


def test_certified_cutoff_removes_bad_and_keeps_good(spark, docs_of, rng):
    rows, labels = corpus(rng)
    docs = docs_of(rows).withColumn("m", F.lit("own")).withColumn("kept", F.lit(0))
    marks = spark.createDataFrame(labels, "doc_id long, quality int")
    judged = quality_verdicts(docs, marks)
    kept = {r.doc_id for r in judged.where(judged[judged.columns[-1]]).collect()}
    assert kept == {i for i, q in labels if q}
    out = kept_documents(docs, marks)
    assert out.columns == docs.columns and out.count() == len(kept)


def test_without_enough_labels_only_base_rules_hold(spark, docs_of, rng):
    rows, labels = corpus(rng)
    marks = spark.createDataFrame(labels[:50], "doc_id long, quality int")
    assert kept_documents(docs_of(rows), marks).count() == len(rows)
    none = spark.createDataFrame([], "doc_id long, quality int")
    odd = docs_of(list(enumerate(ODD_TEXTS)) + [(None, " ".join(prose(rng, 30))), (3, None)])
    nulls = odd.withColumn("lang", F.lit(None).cast("string"))
    assert [r.doc_id for r in kept_documents(nulls, none).collect()] == [None]
    assert kept_documents(docs_of([]), none).count() == 0


def test_risk_is_split_over_rules_and_strata():
    risk = Risk()
    assert risk.rate / len(RULES) == pytest.approx(0.01)

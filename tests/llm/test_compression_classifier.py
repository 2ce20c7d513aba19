"""Held-out accuracy and odd inputs of the compression classifier."""

from __future__ import annotations

from pyspark.sql import functions as F

from linkwatch.llm.compression_classifier import Bounds, bucket, fitted, scored
from tests.llm.conftest import ODD_TEXTS, prose


def corpus(rng, n=900):
    rows, labels = [], []
    for i in range(n):
        good = i % 4 != 0
        words = prose(rng, 60, 3000)
        rows.append((i, " ".join(words) if good else " ".join(w + "$$" for w in words)))
        labels.append((i, int(good), i))
    return rows, labels


def test_held_out_accuracy(spark, docs_of, rng):
    rows, labels = corpus(rng)
    marks = spark.createDataFrame(labels, "doc_id long, quality int, text long")
    docs = docs_of(rows).withColumn("quality", F.lit("own"))
    model = fitted(docs, marks)
    got = scored(docs, model).where(bucket(F.col("doc_id")) == 2).collect()
    truth = {i: q for i, q, _ in labels}
    assert len(got) > 150
    assert sum((r.score >= 0.5) == truth[r.doc_id] for r in got) > 0.97 * len(got)


def test_held_out_labels_are_not_learned(spark, docs_of, rng):
    rows, labels = corpus(rng, 300)
    marks = spark.createDataFrame(labels, "doc_id long, quality int, text long")
    flipped = marks.withColumn(
        "quality", F.when(bucket(F.col("doc_id")) == 2, 1 - F.col("quality")).otherwise(F.col("quality"))
    )
    assert fitted(docs_of(rows), marks) == fitted(docs_of(rows), flipped)


def test_sample_is_bounded(spark, docs_of, rng):
    rows, labels = corpus(rng, 300)
    marks = spark.createDataFrame(labels, "doc_id long, quality int, text long")
    few = fitted(docs_of(rows), marks, Bounds(per_class=20))
    assert len(few.good) < 20 * 60 * 6


def test_odd_texts_and_missing_labels(spark, docs_of):
    none = spark.createDataFrame([], "doc_id long, quality int")
    docs = docs_of(list(enumerate(ODD_TEXTS)) + [(None, "x"), (1, "y")])
    got = scored(docs, fitted(docs, none)).collect()
    assert len(got) == len(ODD_TEXTS) + 2 and all(r.score == 0.5 for r in got)
    nulls = spark.createDataFrame([(3, None), (4, 1)], "doc_id long, quality int")
    assert scored(docs_of([]), fitted(docs, nulls)).count() == 0

"""Quality by compression: which dictionary makes a text smaller.

Two zstandard dictionaries are built from labelled good and bad texts.  Every
text is compressed block by block with both.  The difference of the two sizes,
divided by their sum, and the logarithm of the size under the good dictionary
against the text's own size (repetition shows there) go through a logistic curve
fitted on other labelled documents, which gives the probability of label 1.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

SCORES = "doc_id long, score double, good_bytes long, bad_bytes long"


@dataclass(frozen=True)
class Bounds:
    """The sample a model is fitted on: documents per class, and their longest text."""

    per_class: int = 2500
    longest: int = 20_000
    dictionary: int = 112_640
    block: int = 1024
    level: int = 3


@dataclass(frozen=True)
class Model:
    good: bytes
    bad: bytes
    weights: tuple[float, float, float]
    bounds: Bounds


def bucket(doc_id: Column) -> Column:
    return F.crc32(doc_id.cast("string").cast("binary")) % 4


@lru_cache(maxsize=4)
def _compressors(good: bytes, bad: bytes, level: int):
    import zstandard

    pair = []
    for data in (good, bad):
        dictionary = zstandard.ZstdCompressionDict(data, zstandard.DICT_TYPE_AUTO)
        dictionary.precompute_compress(level=level)
        pair.append(
            zstandard.ZstdCompressor(
                dict_data=dictionary,
                write_content_size=False,
                write_checksum=False,
                write_dict_id=False,
            )
        )
    return pair


def sizes(text: bytes, model_key: tuple[bytes, bytes, int], block: int) -> tuple[int, int]:
    """Compressed bytes under the good and the bad dictionary, over all blocks."""
    good, bad = _compressors(*model_key)
    a = b = 0
    for at in range(0, len(text), block):
        part = text[at : at + block]
        a += len(good.compress(part))
        b += len(bad.compress(part))
    return a, b


def features(texts: list[bytes], pairs: list[tuple[int, int]]) -> np.ndarray:
    """Normalised difference, log ratio and 1 per text; an empty text has 0, 0 and 1."""
    good, bad = np.array(pairs, float).reshape(-1, 2).T
    own = np.array([len(t) for t in texts], float)
    used = own > 0
    out = np.zeros((len(own), 3))
    out[:, 2] = 1
    out[used, 0] = (bad - good)[used] / (bad + good)[used]
    out[used, 1] = np.log(good[used] / own[used])
    return out


def logistic(x: np.ndarray, weights: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x @ weights, -30, 30)))


def labelled_sample(docs: DataFrame, labels: DataFrame, bounds: Bounds) -> list:
    """Labelled texts outside the held-out bucket, at most ``per_class`` of each label.

    Chosen by a hash of the id.  Labels that contradict each other are left out;
    so are null labels, null texts and texts beyond ``longest``.
    """
    marks = labels.where(F.col("quality").isNotNull() & (bucket(F.col("doc_id")) != 2))
    marks = marks.groupBy("doc_id").agg(
        F.min("quality").alias("quality"), F.max("quality").alias("most")
    )
    marks = marks.where(F.col("quality") == F.col("most")).drop("most")
    order = F.xxhash64("doc_id")
    chosen = None
    for label in (0, 1):
        few = marks.where(F.col("quality") == label).orderBy(order).limit(bounds.per_class)
        chosen = few if chosen is None else chosen.union(few)
    texts = docs.select("doc_id", "text").where(
        F.col("text").isNotNull() & (F.length("text") <= bounds.longest)
    )
    # the chosen ids are bounded by twice per_class
    found = texts.join(F.broadcast(chosen), "doc_id")
    return (
        found.groupBy("doc_id")
        .agg(F.min("text").alias("text"), F.min("quality").alias("quality"))
        .withColumn("bucket", bucket(F.col("doc_id")))
        .orderBy(order)
        .collect()
    )


def good_share(labels: DataFrame) -> float:
    """Share of label 1 among all labels outside the held-out bucket."""
    known = labels.where(F.col("quality").isNotNull() & (bucket(F.col("doc_id")) != 2))
    return known.agg(F.avg((F.col("quality") == 1).cast("int"))).first()[0]


def _dictionary(texts: list[bytes], size: int, block: int) -> bytes:
    import zstandard

    parts = [t[i : i + block] for t in texts for i in range(0, len(t), block)]
    if sum(map(len, parts)) > 8 * size and len(parts) > 100:
        return zstandard.train_dictionary(size, parts).as_bytes()
    # too little to train on: the newest bytes themselves are the dictionary
    return b"".join(parts)[-size:] or b" "


def fitted(docs: DataFrame, labels: DataFrame, bounds: Bounds = Bounds()) -> Model:
    """Dictionaries from buckets 0 and 1, the curve from bucket 3.

    Without labels of both kinds in either part the curve is flat.
    """
    rows = labelled_sample(docs, labels, bounds)
    texts = [(x.text.encode(), x.quality, x.bucket) for x in rows]
    good, bad = (
        _dictionary(
            [t for t, q, b in texts if q == label and b != 3], bounds.dictionary, bounds.block
        )
        for label in (1, 0)
    )
    key = (good, bad, bounds.level)
    rest = [(t, q) for t, q, b in texts if b == 3]
    y = np.array([q for _, q in rest], float)
    if not 0 < y.sum() < len(y):
        return Model(good, bad, (0.0, 0.0, 0.0), bounds)
    x = features([t for t, _ in rest], [sizes(t, key, bounds.block) for t, _ in rest])
    scale = np.where(x.std(axis=0) > 0, x.std(axis=0), 1.0)
    # the sample is even, the labels need not be: weigh them as they occur
    share = good_share(labels)
    weight = np.where(y == 1, share / y.sum(), (1 - share) / (len(y) - y.sum())) * len(y)
    w, z = np.zeros(3), x / scale
    for _ in range(50):
        p = logistic(z, w)
        slope = z.T @ (weight * (p - y)) + 0.01 * w
        bend = (z * (weight * p * (1 - p))[:, None]).T @ z + 0.01 * np.eye(3)
        step = np.linalg.solve(bend, slope)
        w -= step
        if np.abs(step).max() < 1e-9:
            break
    return Model(good, bad, tuple(float(v) for v in w / scale), bounds)


def scored(docs: DataFrame, model: Model) -> DataFrame:
    """Score of every whole text; a null or empty text has features 0."""
    sent = docs.sparkSession.sparkContext.broadcast(model)

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m = sent.value
        key = (m.good, m.bad, m.bounds.level)
        for batch in batches:
            texts = batch.column(1).cast(pa.binary()).to_pylist()
            pairs = [sizes(t or b"", key, m.bounds.block) for t in texts]
            p = logistic(features([t or b"" for t in texts], pairs), np.array(m.weights))
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0),
                    pa.array(p, pa.float64()),
                    *[pa.array([q[k] for q in pairs], pa.int64()) for k in (0, 1)],
                ],
                names=["doc_id", "score", "good_bytes", "bad_bytes"],
            )

    return docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(score, SCORES)

"""Encoder, token files and packing against the tokenizer itself."""

from __future__ import annotations

import math
import tempfile
import zlib

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from linkwatch.llm.packing import Capacities, pack_documents, plan_bins
from linkwatch.llm.queries import SEQUENCE
from linkwatch.llm.token_files import read_token_files, write_token_files
from linkwatch.llm.tokens import StretchEncoder, default_tokenizer
from tests.llm.conftest import ODD_TEXTS, prose

PLAIN = Tokenizer.from_file(default_tokenizer())
PLAIN.encode_special_tokens = True
ENCODER = StretchEncoder(default_tokenizer(), 2, cached=50)


def ids_of(text):
    return PLAIN.encode(text or "", add_special_tokens=False).ids


def crc(ids):
    return zlib.crc32(np.array(ids, "<u4").tobytes())


@settings(max_examples=300, deadline=None)
@given(
    st.lists(
        st.text(alphabet=" \n\t\r 　\x1c\x85ab'sé1.!<|endoftext>", max_size=30), max_size=4
    )
)
def test_encoder_gives_the_library_ids(texts):
    got = [np.frombuffer(x, ENCODER.dtype).tolist() for x in ENCODER.encode(texts)]
    assert got == [ids_of(t) for t in texts]


def corpus(rng):
    texts = ODD_TEXTS[:5] + [" ".join(prose(rng, rng.randrange(1, 900))) for _ in range(60)]
    return [(i * 3 - 20, t) for i, t in enumerate(texts)] + [(7, "twice"), (7, "twice")]


def test_token_files(spark, docs_of, rng):
    rows = corpus(rng) + [(None, "no id")]
    folder = tempfile.mkdtemp(prefix="spark-", dir="/tmp") + "/files"
    extra = docs_of(rows).withColumn("id", F.lit(1)).withColumn("part", F.lit("x"))
    manifest = write_token_files(extra, folder, default_tokenizer(), 2, partitions=5)
    got = read_token_files(spark, folder, manifest).orderBy("start").collect()
    want = sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0))
    assert [r.doc_id for r in got] == [i for i, _ in want]
    start = 0
    for r in got:
        assert r.start == start
        start += r.n_tokens
    key = lambda r: (str(r[0]), r[1], r[2])
    assert sorted([(r.doc_id, r.n_tokens, r.ids_crc32) for r in got], key=key) == sorted(
        [(i, len(ids_of(t)) + 1, crc(ids_of(t) + [2])) for i, t in rows], key=key
    )


def test_rows_that_repeat_an_id_stand_in_an_order_of_their_texts(docs_of):
    rows = [(7, f"text {i} " * i) for i in range(40)] + [(None, "x y"), (None, None), (3, "z")]
    got = []
    for order in (rows, rows[::-1]):
        folder = tempfile.mkdtemp(prefix="spark-", dir="/tmp") + "/files"
        docs = docs_of(order)
        manifest = write_token_files(docs, folder, default_tokenizer(), 2, partitions=4)
        files = read_token_files(docs.sparkSession, folder, manifest)
        got.append([(r.doc_id, r.start, r.n_tokens, r.ids_crc32) for r in files.orderBy("start").collect()])
        # a shared id is spread over files
        assert files.where("doc_id = 7").select("partition").distinct().count() > 1
    assert got[0] == got[1] and len(got[0]) == len(rows)


def test_files_follow_the_bytes_of_the_texts(docs_of, monkeypatch):
    monkeypatch.setattr("linkwatch.llm.token_files.FILE_BYTES", 200)
    docs = docs_of([(i, "some words of a text") for i in range(300)])
    folder = tempfile.mkdtemp(prefix="spark-", dir="/tmp") + "/files"
    parts = write_token_files(docs, folder, default_tokenizer(), 2)
    assert parts.count() > int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    assert parts.agg(F.sum("n_docs").alias("n")).first().n == 300


def test_token_files_of_an_empty_table(spark, docs_of):
    folder = tempfile.mkdtemp(prefix="spark-", dir="/tmp") + "/files"
    manifest = write_token_files(docs_of([]), folder, default_tokenizer(), 2)
    assert read_token_files(spark, folder, manifest).count() == 0


@pytest.mark.parametrize(
    "limits",
    [
        Capacities(tokens=256),
        Capacities(tokens=256, documents=3),
        Capacities(tokens=256, attention=20_000, weights=(1, 0, 1)),
        Capacities(tokens=256, select="dot"),
    ],
)
def test_packing(docs_of, rng, limits):
    rows = corpus(rng)
    got = pack_documents(docs_of(rows).withColumn("rank", F.lit(1)), default_tokenizer(), 2, limits)
    got = got.collect()
    longest = limits.longest_piece()
    pieces, bins = {}, {}
    for r in got:
        pieces.setdefault(r.doc_id, []).append(r)
        bins.setdefault(r.sequence_id, []).append(r)
    assert sum(r.length for r in got) == sum(len(ids_of(t)) + 1 for _, t in rows)
    for doc, text in dict(rows).items():
        if doc == 7:
            continue
        ids, place = ids_of(text) + [2], 0
        for n, r in enumerate(sorted(pieces[doc], key=lambda r: r.piece)):
            assert (r.piece, r.start) == (n, place)
            assert r.ids_crc32 == crc(ids[place : place + r.length])
            assert r.length <= longest and (n == 0 or r.length == longest)
            place += r.length
        assert place == len(ids)
    full = limits.vector()
    for group in bins.values():
        end = 0
        for r in sorted(group, key=lambda r: r.offset):
            assert r.offset == end
            end += r.length
        assert end <= full[0] and len(group) <= full[1]
        assert sum(r.length**2 for r in group) <= full[2]
    if limits == Capacities(tokens=256):
        assert len(bins) <= 1.05 * math.ceil(sum(r.length for r in got) / 256) + 1


def test_packing_an_empty_table(docs_of):
    assert pack_documents(docs_of([]), default_tokenizer(), 2).count() == 0


def test_plan_does_not_grow_with_the_counts():
    small = {n: 3 + n % 5 for n in range(1, 257)}
    large = {n: 1000 * c for n, c in small.items()}
    a, b = (plan_bins(h, Capacities(tokens=256)) for h in (small, large))
    assert len(b) < 4 * len(a) + 1024
    for h, plan in ((small, a), (large, b)):
        for n, c in h.items():
            assert plan[plan[:, 0] == n, 2].sum() == c


def test_registered_packing_weighs_all_capacities():
    """By tokens alone the run of 100 would join the two of 350, whose bin is fuller."""
    histogram = {690: 1, 350: 2, 100: 1}
    bins = lambda c: {int(x[0]): int(x[3]) for x in plan_bins(histogram, c)}
    by_tokens, by_all = bins(Capacities(tokens=1024)), bins(SEQUENCE)
    assert by_tokens[100] == by_tokens[350] != by_tokens[690]
    assert by_all[100] == by_all[690] != by_all[350]

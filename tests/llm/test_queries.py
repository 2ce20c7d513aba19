"""Registered queries: their SQL on the smallest tables, and the stages of the pipeline."""

from __future__ import annotations

import duckdb
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from linkwatch.llm.queries import ORACLES, QUERIES
from tests.llm.conftest import prose
from tests.llm.test_parity_join import brute as components

FOLDER = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def engine():
    con = duckdb.connect()
    for name in ("documents", "conversations", "pages", "benchmark", "labels"):
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{FOLDER}/{name}.parquet'")
    return con


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query_matches_its_sql(spark, engine, name):
    df = QUERIES[name](spark, FOLDER)
    columns = sorted(df.columns)
    got = sorted((tuple(r[c] for c in columns) for r in df.collect()), key=str)
    cursor = engine.execute(ORACLES[name])
    names = [d[0] for d in cursor.description]
    assert sorted(names) == columns
    order = [names.index(c) for c in columns]
    want = sorted((tuple(r[i] for i in order) for r in cursor.fetchall()), key=str)
    assert got == want


def test_one_query_per_operator():
    assert sorted(int(n[2:].split("_")[0]) for n in QUERIES) == list(range(1, 14))


def planted(rng):
    """Clean texts, near copies, a shared passage and a benchmark item."""
    item, passage = prose(rng, 40, 4000), prose(rng, 60, 4000)
    rows = {i: prose(rng, 300, 4000) for i in range(30)}
    rows[40] = rows[3][:150] + ["other"] + rows[3][151:]
    rows[41] = rows[5][:100] + passage + rows[5][100:]
    rows[42] = prose(rng, 100, 4000) + passage + prose(rng, 100, 4000)
    rows[43] = prose(rng, 100, 4000) + passage
    rows[44] = prose(rng, 100, 4000) + item + prose(rng, 50, 4000)
    rows[45] = ["short", "text"]
    rows[46] = ["again"] * 60
    return item, passage, [(i, " ".join(w)) for i, w in rows.items()]


def test_stages(spark, docs_of, rng, tmp_path):
    item, passage, rows = planted(rng)
    docs = docs_of(rows + [(47, None), (48, ""), (None, " ".join(prose(rng, 50)))])
    folder = str(tmp_path)
    spark.createDataFrame([(1, " ".join(item))], "item_id long, text string").write.parquet(
        f"{folder}/benchmark.parquet"
    )
    spark.createDataFrame([(1, 1)], "doc_id long, quality int").write.parquet(
        f"{folder}/labels.parquet"
    )
    docs.write.parquet(f"{folder}/documents.parquet")
    quality, near, passages, clean, packed = (f for _, f in corpus_pipeline.STAGES)
    assert [n for n, _ in corpus_pipeline.STAGES][-1] == "best-fit packing"
    ids = lambda df: {r.doc_id for r in df.collect()}
    one = quality(spark, docs, folder)
    assert ids(one) == {i for i, _ in rows} - {45, 46} | {None} and one.columns == docs.columns
    two = near(spark, one, folder)
    groups = components([r for r in rows if r[0] not in (45, 46)], corpus_pipeline.NEAR)
    assert ids(two) == {i for i, (_, c) in groups.items() if i == c} | {None}
    assert 40 not in ids(two)
    three = passages(spark, two, folder)
    left = {r.doc_id: r for r in three.collect()}
    assert three.columns == docs.columns and left.keys() == ids(two)
    assert all(r.n_chars == len(r.text) for r in left.values())
    holders = [i for i in (41, 42, 43) if i in left and " ".join(passage) in left[i].text]
    assert holders == [min(i for i in (41, 42, 43) if i in left)]
    four = clean(spark, three, folder)
    assert ids(four) == left.keys() - {44} and four.columns == docs.columns
    five = packed(spark, four, folder)
    assert {r.doc_id for r in five.collect()} == ids(four)
    whole = corpus_pipeline.run(spark, folder)
    assert whole.columns == five.columns
    key = lambda df: sorted((str(r.doc_id), r.piece, r.ids_crc32) for r in df.collect())
    assert key(whole) == key(five)
    empty = docs.limit(0)
    for stage in (quality, near, passages, clean, packed):
        assert stage(spark, empty, folder).count() == 0


def test_stages_keep_extra_columns(spark, docs_of, rng, tmp_path):
    folder = str(tmp_path)
    spark.createDataFrame([], "doc_id long, quality int").write.parquet(f"{folder}/labels.parquet")
    spark.createDataFrame([], "item_id long, text string").write.parquet(
        f"{folder}/benchmark.parquet"
    )
    docs = docs_of([(i, " ".join(prose(rng, 40))) for i in range(9)])
    for c in ("measures", "kept", "row_key", "later_id", "found_id", "n_words", "stratum", "sid"):
        docs = docs.withColumn(c, F.lit(c))
    for _, stage in corpus_pipeline.STAGES[:-1]:
        out = stage(spark, docs, folder)
        assert out.columns == docs.columns and out.count() == 9
        assert out.where("kept = 'kept' and measures = 'measures' and row_key = 'row_key'").count() == 9

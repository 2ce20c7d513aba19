"""Registered queries against their SQL on the smallest tables."""

from __future__ import annotations

import duckdb
import pytest

from linkwatch.plans.catalog import ORACLES, QUERIES

FOLDER = "/root/testdata/sf0.001"
SAMPLED = (
    "daily_reliability",
    "parse_split_rejects",
    "contract_violations",
    "window_metrics_all",
    "findings",
    "incident_transitions",
    "heartbeat_latest",
    "export_agents",
    "slo_p95",
    "run_ledger",
)


@pytest.fixture(scope="module")
def engine():
    con = duckdb.connect()
    for name in ("events", "customer", "supplier"):
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{FOLDER}/{name}.parquet'")
    return con


@pytest.mark.parametrize("name", SAMPLED)
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


def test_every_query_has_sql():
    assert set(QUERIES) == set(ORACLES)

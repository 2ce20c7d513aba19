"""Registered queries against their SQL on tables whose rows end or begin midway."""

from __future__ import annotations

import duckdb

from pyspark.sql import functions as F

from linkwatch.plans.catalog import ORACLES, QUERIES

FOLDER = "/root/testdata/sf0.001"


def both(spark, folder, name):
    """Rows of a query and of its SQL, with columns in order of their names."""
    df = QUERIES[name](spark, folder)
    columns = sorted(df.columns)
    got = sorted((tuple(r[c] for c in columns) for r in df.collect()), key=str)
    con = duckdb.connect()
    for table in ("events", "customer"):
        con.execute(f"CREATE VIEW {table} AS SELECT * FROM '{folder}/{table}.parquet/*.parquet'")
    cursor = con.execute(ORACLES[name])
    names = [d[0] for d in cursor.description]
    assert sorted(names) == columns
    order = [names.index(c) for c in columns]
    return got, sorted((tuple(r[i] for i in order) for r in cursor.fetchall()), key=str)


def landed(spark, folder, events):
    customers = spark.read.parquet(f"{FOLDER}/customer.parquet")
    events.coalesce(1).write.parquet(f"{folder}/events.parquet")
    customers.write.parquet(f"{folder}/customer.parquet")
    return str(folder)


def test_incidents_that_go_on_at_the_last_tick_keep_the_constraints(spark, tmp_path):
    events = spark.read.parquet(f"{FOLDER}/events.parquet").where("ts < '2024-01-04 12:00:00'")
    folder = landed(spark, tmp_path, events)
    got, want = both(spark, folder, "incident_constraints")
    assert got == want and ("state", "incidents", 0) in {(r, t, n) for r, t, n in got}


def test_evaluations_before_the_first_of_a_site_are_missing(spark, tmp_path):
    """One site begins 30 hours late, another is evaluated but has no finding."""
    events = spark.read.parquet(f"{FOLDER}/events.parquet").where("ts < '2024-01-04 12:00:00'")
    late = events.where("ts > '2024-01-02 06:00:00'").withColumn("user_id", F.col("user_id") + 80)
    quiet = events.where("event_type = 'view' and ts > '2024-01-03'").withColumn(
        "user_id", F.col("user_id") + 8000
    )
    folder = landed(spark, tmp_path, events.union(late).union(quiet))
    got, want = both(spark, folder, "stream_lifecycle_losses")
    assert got == want
    assert {r[3] for r in got} == {"site-0", "site-1", "site-100"}
    assert max(r[0] for r in got if r[3] == "site-1") >= 29

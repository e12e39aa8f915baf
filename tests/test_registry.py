"""Registered queries beside their SQL; a part by default, all with ALL_QUERIES=1."""

import os

import duckdb
import pytest

import __spark_entry__ as entry
from compare import TABLES, rows_of
from tourlytics.registry import catalog

SOME = [
    "web_events", "fact_events", "session_metrics_v1", "session_metrics_v3", "classified_journeys",
    "user_journey_analysis", "spatial_analytics", "time_travel_analysis", "snapshot_trend",
    "data_quality_monitor", "rolling_event_statistics", "ingest_counts", "normalized_stream_events",
    "raw_to_web_events", "merge_upsert", "compacted_partitions", "check_alerts", "stream_hourly_metrics",
]
NAMES = list(catalog.QUERIES) if os.environ.get("ALL_QUERIES") == "1" else SOME


@pytest.fixture(scope="module")
def duck(small):
    con = duckdb.connect()
    for table in TABLES:
        con.execute(f"CREATE VIEW {table} AS SELECT * FROM '{small}/{table}.parquet'")
    return con


@pytest.fixture(scope="module")
def small():
    return entry.SMOKE_FOLDER


@pytest.mark.parametrize("name", NAMES)
def test_query_matches_sql(spark, small, duck, name):
    df = entry.queries()[name](spark, small)
    found = duck.execute(entry.oracle_sql()[name])
    names = [d[0] for d in found.description]
    assert rows_of(df.columns, df.collect()) == rows_of(names, found.fetchall())


def test_every_query_has_sql_and_entry_runs(spark):
    assert set(catalog.QUERIES) == set(catalog.SQL)
    assert entry.entry(spark).count() > 0

"""Journeys over midnight, long sessions, snapshot changes and spatial levels on small fixtures."""

import datetime as dt

from pyspark.sql import functions as F

from tourlytics.operators import monitor
from tourlytics.plans import journey, snapshots
from tourlytics.schemas import SNAPSHOT_ANALYSIS, SPATIAL_ANALYTICS

NIGHT = dt.datetime(2024, 1, 10, 23, 59, 0)


def night_fact(spark):
    """One session over midnight and one of a single event."""
    rows = []
    for i in range(6):
        at = NIGHT + dt.timedelta(seconds=20 * i)
        rows.append((f"e{i}", "s", "u", at, at.date(), i + 1, f"/p{i}", f"ref{i}", "unit" if i % 2 else "amenity",
                     f"sp{i}", i % 3, f"tp{i}"))
    rows.append(("x", "t", "v", NIGHT, NIGHT.date(), 1, "/viewer", "", "tour", None, 5, "evening"))
    df = spark.createDataFrame(
        rows,
        "event_id string, session_id string, anonymous_id string, event_timestamp timestamp, event_date date, "
        "session_event_sequence int, page_path string, referrer string, space_type string, space_id string, "
        "engagement_score int, time_period string",
    )
    return df.selectExpr(
        "*", "20L time_on_page_seconds", "'navigation' journey_milestone", "'single_page' exploration_depth",
        "true is_virtual_tour_page", "space_id is not null has_space_context",
        "space_type = 'unit' is_core_virtual_tour_event", "concat('d', session_event_sequence) device_type",
        "'Other' detailed_region", "0.8D data_quality_score",
    )


def test_session_over_midnight_has_two_rows_and_one_entry(spark):
    rows = journey.daily_sessions(night_fact(spark), "2024-01-31").where("session_id = 's'").collect()
    rows = sorted(rows, key=lambda r: r["analysis_date"])
    assert [r["analysis_date"].day for r in rows] == [10, 11]
    assert [r["total_events"] for r in rows] == [3, 3]
    for row in rows:
        assert (row["entry_page"], row["exit_page"], row["entry_referrer"]) == ("/p0", "/p5", "ref0")
        assert (row["device_type"], row["session_time_period"]) == ("d1", "tp0")


def test_sequences_are_whole_in_bounded_rows(spark):
    fact = night_fact(spark)
    whole = journey.journey_sequences(fact, "2024-01-31").where("session_id = 's'").collect()
    assert sorted(len(r["journey_sequence"]) for r in whole) == [3, 3]
    parts = journey.journey_sequences(fact, "2024-01-31", steps_per_row=2).where("session_id = 's'").collect()
    assert all(len(r["journey_sequence"]) <= 2 for r in parts)
    steps = [s["session_event_sequence"] for r in sorted(parts, key=lambda r: (r["analysis_date"], r["part"]))
             for s in r["journey_sequence"]]
    assert steps == [1, 2, 3, 4, 5, 6]


def test_segments_and_minimum_size(spark):
    fact = night_fact(spark)
    found = journey.user_journey_analysis(fact, "2024-01-31", min_segment=1)
    assert sum(r["session_count"] for r in found.collect()) == 3
    assert journey.user_journey_analysis(fact, "2024-01-31").count() == 0
    assert journey.user_journey_analysis(fact, "2024-03-31", min_segment=1).count() == 0


def counts(spark, day, kind, events, sessions, engagement=2.0, quality=0.9):
    return spark.createDataFrame(
        [(day, kind, events, sessions, sessions, engagement, 30.0, 1, quality)],
        "event_date date, space_type string, total_events bigint, unique_sessions bigint, unique_users bigint, "
        "avg_engagement_score double, avg_time_on_page double, core_tour_events bigint, avg_data_quality double",
    )


def test_snapshot_changes(spark):
    day = dt.date(2024, 1, 5)
    now = counts(spark, day, "unit", 5, 3).unionByName(counts(spark, day, "tour", 4, 2))
    now = now.unionByName(counts(spark, day, None, 7, 2))
    then = counts(spark, day, "unit", 3, 3, 1.0, 0.7).unionByName(counts(spark, day, None, 7, 2))
    compared = snapshots.snapshot_compare(now, then)
    assert compared.schema.names == SNAPSHOT_ANALYSIS.names
    rows = {r["space_type"]: r for r in compared.collect()}
    unit = rows["unit"]
    assert round(unit["events_change_pct"], 2) == 66.67 and unit["events_variance_flag"] == "high_variance"
    assert unit["engagement_variance_flag"] == "high_variance"
    assert unit["quality_trend"] == "quality_improvement" and unit["data_freshness_status"] == "data_stable"
    assert rows["tour"]["historical_events"] == 0 and rows["tour"]["events_change_pct"] is None
    assert rows["tour"]["data_freshness_status"] == "data_growing"
    assert rows[None]["historical_events"] == 0  # NULL keys never match
    summary = snapshots.snapshot_summary(compared).first()
    assert (summary["current_events"], summary["historical_events"]) == (16, 3)
    assert summary["space_type"] == "all_spaces" and summary["engagement_change_pct"] is None


def test_trend_counts_each_snapshot(spark):
    df = spark.createDataFrame(
        [(dt.datetime(2024, 1, d), s) for d, s in [(1, 1.0), (2, 0.5), (3, None), (9, 0.0)]],
        "processed_timestamp timestamp, data_quality_score double",
    )
    moments = ["2024-01-02 00:00:00", "2023-12-01 00:00:00", "2024-01-05 00:00:00"]
    rows = [tuple(r)[1:] for r in snapshots.snapshot_trend(df, moments).orderBy("snapshot_timestamp").collect()]
    assert rows == [(0, None), (2, 0.75), (3, 0.75)]


def test_growth_without_history(spark):
    df = spark.createDataFrame(
        [(dt.date(2024, 1, 5), dt.datetime(2024, 1, 6))], "event_date date, processed_timestamp timestamp"
    )
    row = snapshots.snapshot_growth(df, "2024-01-05", "2024-01-05 12:00:00").first()
    assert (row["current_events"], row["events_added"], row["growth_percentage"]) == (1, 1, None)


def test_health_of_an_empty_table(spark):
    df = spark.createDataFrame(
        [],
        "event_date date, space_type string, processed_timestamp timestamp, data_quality_score double, is_bot boolean",
    )
    assert monitor.table_health(df, "2024-01-31 00:00:00").first()["health_status"] == "NO_DATA"


def test_cohorts(spark):
    def visit(user, day):
        return (user, dt.date(2024, 1, day))

    df = spark.createDataFrame(
        [visit("a", 1), visit("a", 2), visit("a", 9), visit("b", 3), visit("c", 10), (None, dt.date(2024, 1, 1))],
        "anonymous_id string, event_date date",
    )
    rows = [(r["cohort_week"].day, r["weeks_since_first_visit"], r["active_users"], r["retention_rate"])
            for r in monitor.cohort_retention(df).collect()]
    assert rows == [(1, 0, 2, 1.0), (1, 1, 1, 0.5), (8, 0, 1, 1.0)]


def test_rolling_statistics_flag_a_jump(spark):
    days = [(dt.date(2024, 1, 1) + dt.timedelta(days=i), 10 if i < 8 else 100) for i in range(9)]
    df = spark.createDataFrame([(d,) for d, n in days for _ in range(n)], "event_date date")
    rows = monitor.rolling_event_statistics(df).orderBy("analysis_date").collect()
    assert [r["is_anomaly"] for r in rows] == [False] * 8 + [True]
    assert rows[0]["rolling_stddev_events"] == 0.0 and rows[8]["period_over_period_change"] == 9.0


def test_declared_columns_of_the_spatial_mart():
    assert len(SPATIAL_ANALYTICS) == 30 and len(SNAPSHOT_ANALYSIS) == 30


def test_top_spaces_orders_ties(spark):
    rows = [(dt.date(2024, 1, 1), name, "unit", "s", t) for name, t in [("b", 5), ("a", 5), ("c", 9), (None, 99)]]
    df = spark.createDataFrame(
        rows, "event_date date, space_name string, space_type string, session_id string, time_on_page_seconds bigint"
    )
    got = monitor.top_spaces(df, "2024-01-01", 2).select("space_name").collect()
    assert [r[0] for r in got] == ["c", "a"]
    assert df.where(F.col("space_name").isNull()).count() == 1

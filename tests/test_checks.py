"""Every check has a fixture that passes and one that does not."""

import datetime as dt

import pytest

from tourlytics.operators import checks as c

NOW = "2024-01-10 12:00:00"
TODAY = dt.date(2024, 1, 10)
COLS = (
    "event_id string, event_timestamp timestamp, event_date date, anonymous_id string, user_id string, "
    "session_id string, session_event_sequence int, space_type string, time_on_page_seconds bigint, "
    "engagement_score int, data_quality_score double, processed_timestamp timestamp, timezone string, "
    "user_agent string"
)


def rows(spark, n=40, **changes):
    """Two events per session, one space type after the other, the last five days."""
    data = []
    for i in range(n):
        day = i % 5
        at = dt.datetime(2024, 1, 10, 10) - dt.timedelta(days=day, seconds=i)
        row = {
            "event_id": f"e{i}",
            "event_timestamp": at,
            "event_date": at.date(),
            "anonymous_id": f"u{i // 10}",
            "user_id": None,
            "session_id": f"s{i // 10}-{day}",
            "session_event_sequence": i % 10 // 5 + 1,
            "space_type": ["unit", "amenity", "tour"][i % 3],
            "time_on_page_seconds": 30,
            "engagement_score": i % 4,
            "data_quality_score": 0.9,
            "processed_timestamp": at + dt.timedelta(hours=1, minutes=30),
            "timezone": "UTC",
            "user_agent": "a",
        }
        for name, change in changes.items():
            row[name] = change(i, row) if callable(change) else change
        data.append(tuple(row.values()))
    return spark.createDataFrame(data, COLS)


def status(df):
    return [r["status"] for r in df.collect()]


CASES = {
    "unique": (lambda d: c.check_unique(d, "event_id"), {"event_id": "same"}),
    "not_null": (
        lambda d: c.check_not_null(d, "space_type", "engagement_score >= 1"),
        {"space_type": lambda i, r: None if i == 1 else "unit"},
    ),
    "accepted": (
        lambda d: c.check_accepted_values(d, "space_type", ["unit", "amenity", "tour"]),
        {"space_type": lambda i, r: "garage" if i == 3 else "unit"},
    ),
    "range": (
        lambda d: c.check_accepted_range(d, "data_quality_score", 0, 1),
        {"data_quality_score": 1.2},
    ),
    "expression": (
        lambda d: c.check_expression(d, "time", "time_on_page_seconds >= 0"),
        {"time_on_page_seconds": None},
    ),
    "freshness": (
        lambda d: c.check_freshness(d, "processed_timestamp", NOW),
        {"processed_timestamp": dt.datetime(2024, 1, 10, 7)},
    ),
    "space": (
        lambda d: c.check_space_metrics(d, NOW),
        {"time_on_page_seconds": -5},
    ),
    "travel": (
        lambda d: c.check_time_travel_consistency(d, NOW),
        {"event_timestamp": lambda i, r: dt.datetime(2024, 1, 9, 1), "processed_timestamp": dt.datetime(2024, 1, 9, 2)},
    ),
    "merge": (lambda d: c.check_merge_integrity(d, NOW), {"event_id": lambda i, r: f"e{i % 5}"}),
    "distribution": (
        lambda d: c.check_partition_distribution(d, TODAY),
        {"event_date": lambda i, r: TODAY if i % 3 else r["event_date"]},
    ),
    "required": (
        lambda d: c.check_required_columns(d, TODAY),
        {"processed_timestamp": lambda i, r: None if i == 5 else r["processed_timestamp"]},
    ),
    "incremental": (lambda d: c.check_incremental_merge(d, NOW), {"event_id": lambda i, r: f"e{i % 7}"}),
    "incremental lag": (
        lambda d: c.check_incremental_merge(d, NOW),
        {"processed_timestamp": dt.datetime(2024, 1, 10, 9)},
    ),
    "isolation": (
        lambda d: c.check_session_isolation(d, NOW),
        {"anonymous_id": lambda i, r: f"u{i}"},
    ),
    "isolation sequence": (
        lambda d: c.check_session_isolation(d, NOW),
        {"session_event_sequence": lambda i, r: r["session_event_sequence"] + 1},
    ),
    "compaction": (lambda d: c.check_post_compaction(d, NOW), {"data_quality_score": 0.6}),
    "compaction spread": (
        lambda d: c.check_post_compaction(d, NOW),
        {"data_quality_score": lambda i, r: 0.3 if i // 5 % 4 == 0 else 1.0},
    ),
    "clustering": (lambda d: c.check_clustering(written(d), NOW, 0.6), {"session_id": lambda i, r: f"s{i}"}),
    "growth": (
        lambda d: c.check_time_travel_growth(d, TODAY, "2024-01-10 11:20:00"),
        {"processed_timestamp": dt.datetime(2024, 1, 10, 11)},
    ),
    "consistency": (
        lambda d: c.check_session_consistency(d),
        {"user_agent": lambda i, r: f"a{i}", "session_id": "one", "anonymous_id": "one"},
    ),
    "privacy": (lambda d: c.check_privacy(d), {"user_id": lambda i, r: "a.b@example.com" if i == 4 else None}),
}


def written(df):
    """The clustering check reads file names, so it needs a table of files."""
    import tempfile

    path = tempfile.mkdtemp(prefix="run-") + "/t"
    df.write.parquet(path)
    return df.sparkSession.read.parquet(path)


@pytest.mark.parametrize("name", CASES)
def test_pass_and_fail(spark, name):
    build, changes = CASES[name]
    good = {"processed_timestamp": dt.datetime(2024, 1, 10, 11, 30)} if name in ("growth",) else {}
    assert status(build(rows(spark, **good))) == ["pass"]
    assert status(build(rows(spark, **changes))) == ["error"]


def test_relationships(spark):
    d = rows(spark)
    assert status(c.check_relationships(d, d, "session_id")) == ["pass"]
    row = c.check_relationships(d, d.where("session_id <> 's0-0'"), "session_id", warn=0, error=5).first()
    assert (row["observed"], row["status"]) == (2.0, "warn")


def test_sequence_continuity(spark):
    assert status(c.check_sequence_continuity(rows(spark), NOW)) == ["pass"]
    gaps = rows(spark, 400, session_event_sequence=lambda i, r: i * 2, session_id="s")
    assert status(c.check_sequence_continuity(gaps, NOW)) == ["error"]
    some = rows(spark, 40, session_event_sequence=lambda i, r: i * 2, session_id="s")
    assert status(c.check_sequence_continuity(some, NOW)) == ["warn"]


def test_coverage(spark):
    d = rows(spark)
    assert status(c.check_partition_coverage(d, NOW)) == ["warn", "pass"]
    assert status(c.check_partition_coverage(d, NOW, min_days=5)) == ["pass", "pass"]
    assert status(c.check_partition_coverage(rows(spark, space_type="unit"), NOW))[1] == "error"


def test_partition_spread(spark):
    row = c.partition_spread(rows(spark), NOW).first()
    assert (row["small_partitions"], row["large_partitions"], row["total_partitions"]) == (15, 0, 15)
    assert status(c.check_partition_spread(rows(spark), NOW)) == ["pass"]


def test_service_levels(spark):
    from tourlytics.operators.monitor import completeness

    assert status(c.check_service_levels(completeness(rows(spark), NOW))) == ["pass"] * 3
    bad = rows(spark, event_id=lambda i, r: None if i < 2 else "x", processed_timestamp=dt.datetime(2024, 1, 9))
    assert status(c.check_service_levels(completeness(bad, NOW))) == ["error"] * 3


def test_alerts(spark):
    fresh = rows(spark, processed_timestamp=dt.datetime(2024, 1, 10, 11, 50))
    assert status(c.check_alerts(c.alert_metrics(fresh, NOW))) == ["pass"] * 3
    poor = rows(spark, data_quality_score=0.4, processed_timestamp=dt.datetime(2024, 1, 10, 11))
    assert status(c.check_alerts(c.alert_metrics(poor, NOW))) == ["warn", "error", "warn"]


def test_schema_compatible(spark):
    old = rows(spark, 1)
    assert status(c.check_schema_compatible(old, old.selectExpr("*", "1 more"))) == ["pass"]
    assert status(c.check_schema_compatible(old, old.drop("user_id"))) == ["error"]
    emptied = old.selectExpr("* except (session_id)", "cast(null as string) session_id")
    assert status(c.check_schema_compatible(old, emptied)) == ["error"]
    assert status(c.check_schema_compatible(old, old.limit(0))) == ["pass"]
    retyped = old.selectExpr("* except (engagement_score)", "'1' engagement_score")
    assert c.schema_changes(old, retyped) == [("engagement_score", "type")]
    assert status(c.check_schema_compatible(old, old, ["event_date"], ["space_type"])) == ["error"]


def test_empty_input_fails_or_passes_cleanly(spark):
    empty = rows(spark, 1).where("false")
    assert status(c.check_required_columns(empty, TODAY)) == ["error"]
    assert status(c.check_unique(empty, "event_id")) == ["pass"]
    assert status(c.check_freshness(empty, "processed_timestamp", NOW)) == ["error"]

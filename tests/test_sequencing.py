"""Sessions in time slices give what one window over the session gives."""

import datetime as dt
import random

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from tourlytics.operators import session_metrics as sm
from tourlytics.operators.sequencing import (
    SLICE_SECONDS,
    sequence_gaps,
    sequence_sessions,
    session_boundaries,
    session_positions,
)

BASE = dt.datetime(2024, 1, 1, 22, 0, 0)


def skewed_events(spark, n=1500):
    """One session holds a third of all rows, over days; others are short; times repeat."""
    rnd = random.Random(7)
    rows = []
    for i in range(n):
        if i % 3 == 0:
            session, at = "hot", BASE + dt.timedelta(seconds=rnd.randrange(200_000))
        else:
            session = f"s{rnd.randrange(150)}"
            at = BASE + dt.timedelta(seconds=rnd.randrange(5_000), microseconds=rnd.randrange(3) * 333_333)
        rows.append((f"e{i:05d}", session, at))
    rows += [("n1", None, BASE), ("n2", None, BASE)]
    return spark.createDataFrame(rows, "event_id string, session_id string, event_timestamp timestamp")


def plain_windows(df):
    w = Window.partitionBy("session_id").orderBy("event_timestamp", "event_id")
    return df.where("session_id is not null").select(
        "event_id",
        F.row_number().over(w).alias("_rank"),
        F.count(F.lit(1)).over(Window.partitionBy("session_id")).alias("_total"),
        F.lag("event_timestamp").over(w).alias("_prev"),
        F.lead("event_timestamp").over(w).alias("_next"),
    )


def test_slices_equal_one_window(spark):
    df = skewed_events(spark)
    expected = sorted(plain_windows(df).collect())
    for seconds in (60, 3600, 10**7):
        got = session_positions(df, seconds)
        known = got.where("session_id is not null").select("event_id", "_rank", "_total", "_prev", "_next")
        assert sorted(known.collect()) == expected
        assert got.count() == df.count()


def test_hot_session_is_split_before_the_sort(spark):
    """The shuffle of the rows is keyed by session and slice, never by the session alone."""
    df = skewed_events(spark)
    hottest = df.withColumn("_slice", F.floor(F.unix_micros("event_timestamp") / 3_600_000_000))
    biggest = hottest.groupBy("session_id", "_slice").count().agg(F.max("count")).first()[0]
    assert biggest < df.count() / 20
    plan = session_positions(df, 3600)._jdf.queryExecution().executedPlan().toString()
    wide = [line for line in plan.splitlines() if "Exchange hashpartitioning(session_id" in line]
    assert any("_slice" in line for line in wide)


def test_time_on_page_uses_whole_seconds(spark):
    rows = [
        ("a", "s", dt.datetime(2024, 1, 1, 0, 0, 0, 900_000)),
        ("b", "s", dt.datetime(2024, 1, 1, 0, 0, 1, 100_000)),
        ("c", "s", dt.datetime(2024, 1, 1, 0, 0, 1, 900_000)),
    ]
    df = spark.createDataFrame(rows, "event_id string, session_id string, event_timestamp timestamp")
    got = {r["event_id"]: r for r in sequence_sessions(df).collect()}
    # difference of the whole seconds, not whole seconds of the difference
    assert [got[k]["time_on_page_seconds"] for k in "abc"] == [1, 0, 30]
    assert [got[k]["session_event_sequence"] for k in "abc"] == [1, 2, 3]
    assert [got[k]["is_first_event_in_session"] for k in "abc"] == [True, False, False]


def test_boundaries(spark):
    rows = [("a", "s", BASE, 1), ("b", "s", BASE + dt.timedelta(seconds=1.5), 2), ("c", "t", BASE, 4)]
    df = spark.createDataFrame(
        rows, "event_id string, session_id string, event_timestamp timestamp, session_event_sequence int"
    )
    got = {r["event_id"]: r for r in session_boundaries(df).collect()}
    assert got["a"]["seconds_to_next_event"] == 1.5 and got["b"]["seconds_to_next_event"] == 30.0
    assert [got[k]["journey_stage"] for k in "abc"] == ["entry", "exit", "exit"]
    assert [got[k]["total_session_events"] for k in "abc"] == [2, 2, 1]
    assert got["a"]["is_session_start"] and not got["a"]["is_session_end"]
    assert got["b"]["is_session_end"] and got["b"]["session_event_rank"] == 2


def test_gaps_over_slices(spark):
    numbers = [1, 2, 3, 5, 9, 10, 11, 25]
    df = spark.createDataFrame([("s", n) for n in numbers], "session_id string, session_event_sequence int")
    for width in (2, 4, 1000):
        got = sorted((r[1], r["gap"]) for r in sequence_gaps(df, width).collect())
        assert got == [(1, None), (2, 1), (3, 1), (5, 2), (9, 4), (10, 1), (11, 1), (25, 14)]


def session_rows(spark):
    """Five sessions of ten events, five minutes apart, two space types each."""
    rows = []
    for s in range(5):
        for i in range(10):
            at = dt.datetime(2024, 1, 1, 10) + dt.timedelta(minutes=5 * i)
            rows.append((f"{s}-{i}", f"session-{s}", f"user-{s}", at, at.date(), i + 1,
                         "unit" if i % 2 else "amenity", f"sp{i % 3}", 30 + 10 * i,
                         None if i == 0 else f"ref{i}"))
    return spark.createDataFrame(
        rows,
        "event_id string, session_id string, anonymous_id string, event_timestamp timestamp, "
        "event_date date, session_event_sequence int, space_type string, space_id string, "
        "time_on_page_seconds bigint, referrer string",
    ).selectExpr("*", "'a' user_agent", "'UTC' timezone", "'desktop' device_type", "'Other' region")


def test_session_roll_ups(spark):
    df = session_rows(spark)
    for row in sm.session_diversity(df).collect():
        assert (row["total_events"], row["unique_space_types"]) == (10, 2)
    rows = sm.session_metrics_v1(df).collect()
    assert len(rows) == 5
    for row in rows:
        assert [tuple(c) for c in row["space_type_counts"]] == [("amenity", 5), ("unit", 5)]
        assert row["unique_spaces_viewed"] == 3 and row["session_duration_seconds"] == 2700
        assert row["total_time_on_site_seconds"] == sum(30 + 10 * i for i in range(10))
        assert row["referrer"] is None  # the first event has none
        assert not row["bounce_session"]


def test_lists_come_in_bounded_rows(spark):
    listed = sm.space_types_listed(sm.session_metrics_v1(session_rows(spark)), 2).orderBy("session_id", "space_type", "part")
    rows = [r["space_types_viewed"] for r in listed.collect()]
    assert rows[:6] == [["amenity"] * 2, ["amenity"] * 2, ["amenity"], ["unit"] * 2, ["unit"] * 2, ["unit"]]
    assert len(rows) == 5 * 6


@pytest.mark.parametrize("width", [1, 60, SLICE_SECONDS, 86_400])
def test_slice_width_does_not_matter(spark, width):
    df = skewed_events(spark)
    same = session_positions(df, width).where("session_id is not null")
    expected = sorted(plain_windows(df).collect())
    assert sorted(same.select("event_id", "_rank", "_total", "_prev", "_next").collect()) == expected

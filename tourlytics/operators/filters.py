"""Row filters. Conditions stay on bare columns, so they reach the scan and prune partitions."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def timestamp_at(as_of: dt.datetime | str) -> Column:
    return F.lit(str(as_of)).cast("timestamp")


def date_at(as_of: dt.date | dt.datetime | str) -> Column:
    return F.lit(str(as_of)[:10]).cast("date")


def days_back(as_of, days: int) -> Column:
    """A literal date, computed here so that the scan sees a constant."""
    day = dt.date.fromisoformat(str(as_of)[:10]) - dt.timedelta(days=days)
    return F.lit(day.isoformat()).cast("date")


def hours_back(as_of, hours: float) -> Column:
    moment = dt.datetime.fromisoformat(str(as_of)) - dt.timedelta(hours=hours)
    return F.lit(moment.isoformat(sep=" ")).cast("timestamp")


def valid_events(events: DataFrame, allow_user_id: bool = False) -> DataFrame:
    """Session, visitor and time are known; a signed-in user may stand in for the visitor."""
    known = F.col("anonymous_id").isNotNull()
    if allow_user_id:
        known = known | F.col("user_id").isNotNull()
    return events.where(
        F.col("session_id").isNotNull() & known & F.col("event_timestamp").isNotNull()
    )


def clean_traffic(events: DataFrame, min_quality: float = 0.5) -> DataFrame:
    return events.where(~F.col("is_bot") & (F.col("data_quality_score") >= min_quality))


def staging_filter(
    events: DataFrame,
    start,
    as_of,
    exclude_bots: bool = True,
    min_quality: float = 0.5,
) -> DataFrame:
    kept = events.where(
        F.col("event_date").between(date_at(start), date_at(as_of))
        & (F.col("data_quality_score") >= min_quality)
    )
    return kept.where(~F.col("is_bot")) if exclude_bots else kept


def fact_filter(events: DataFrame, min_quality: float = 0.7) -> DataFrame:
    return clean_traffic(valid_events(events), min_quality)


def since_days(df: DataFrame, as_of, days: int, column: str = "event_date") -> DataFrame:
    return df.where(F.col(column) >= days_back(as_of, days))


def since_hours(df: DataFrame, as_of, hours: float, column: str) -> DataFrame:
    """Rows of the last hours. For the event time, the day it implies prunes the partitions too."""
    recent = df.where(F.col(column) >= hours_back(as_of, hours))
    if column == "event_timestamp" and "event_date" in df.columns:
        start = dt.datetime.fromisoformat(str(as_of)) - dt.timedelta(hours=hours)
        recent = recent.where(F.col("event_date") >= date_at(start))
    return recent


def spatially_relevant(events: DataFrame) -> DataFrame:
    return events.where(
        F.col("coordinates").isNotNull()
        | F.col("room_name").isNotNull()
        | F.col("community").isNotNull()
    )


def lookup_user(events: DataFrame, anonymous_id: str, n: int) -> DataFrame:
    """The first ``n`` events of a visitor in time order."""
    return (
        events.where(F.col("anonymous_id") == anonymous_id)
        .orderBy("event_timestamp", "event_id")
        .limit(n)
    )


def lookup_identity(events: DataFrame, anonymous_id: str | None = None, user_id: str | None = None) -> DataFrame:
    """All events of a visitor, an account, or either. The test reaches the reader, which skips row groups
    by the Bloom filters and dictionaries of the two columns."""
    wanted = [F.col(c) == v for c, v in (("anonymous_id", anonymous_id), ("user_id", user_id)) if v is not None]
    if not wanted:
        raise ValueError("name a visitor or an account")
    return events.where(wanted[0] if len(wanted) == 1 else wanted[0] | wanted[1])

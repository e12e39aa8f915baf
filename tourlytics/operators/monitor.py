"""Monitoring and reporting aggregates over the event table and the event fact."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import classify
from ..functions.rules import count_if, percent
from .filters import clean_traffic, date_at, since_days, since_hours, timestamp_at


def _rows() -> Column:
    return F.count(F.lit(1))


def realtime_metrics(fact: DataFrame, as_of, hours: int = 24, min_quality: float = 0.7) -> DataFrame:
    """Last hours by hour, space type and device, newest hour first."""
    recent = clean_traffic(since_hours(fact, as_of, hours, "event_timestamp"), min_quality)
    hour = F.date_trunc("hour", "event_timestamp").alias("hour_bucket")
    return (
        recent.groupBy(hour, "space_type", "device_type")
        .agg(
            _rows().alias("events_count"),
            F.count_distinct("session_id").alias("unique_sessions"),
            F.count_distinct("anonymous_id").alias("unique_users"),
            F.avg("engagement_score").alias("avg_engagement"),
            count_if(F.col("is_core_virtual_tour_event")).alias("core_tour_events"),
            F.avg("time_on_page_seconds").alias("avg_time_on_page"),
        )
        .orderBy(F.desc("hour_bucket"))
    )


def data_quality_monitor(events: DataFrame, as_of, days: int = 7) -> DataFrame:
    score = F.col("data_quality_score")
    return (
        since_days(events, as_of, days)
        .groupBy("event_date", "space_type")
        .agg(
            _rows().alias("total_events"),
            F.count_if(F.col("session_id").isNull()).alias("missing_session_id"),
            F.count_if(F.col("anonymous_id").isNull()).alias("missing_anonymous_id"),
            F.count_if(F.col("user_agent").isNull()).alias("missing_user_agent"),
            count_if(F.col("is_bot")).alias("bot_events"),
            F.avg(score).alias("avg_quality_score"),
            F.min(score).alias("min_quality_score"),
            F.max("processed_timestamp").alias("latest_processed"),
            count_if(score < 0.5).alias("low_quality_events"),
            count_if(score >= 0.9).alias("high_quality_events"),
        )
        .orderBy(F.desc("event_date"), "space_type")
    )


def validate_tables(events: DataFrame, sessions: DataFrame) -> DataFrame:
    """Size, sessions and date range of the two base tables, one row each."""

    def line(table: DataFrame, name: str, quality: Column) -> DataFrame:
        return table.agg(
            _rows().alias("record_count"),
            F.count_distinct("session_id").alias("unique_sessions"),
            F.min("event_date").alias("earliest_date"),
            F.max("event_date").alias("latest_date"),
            quality.alias("avg_quality"),
        ).withColumn("table_name", F.lit(name))

    return line(events, "web_events", F.avg("data_quality_score")).unionByName(
        line(sessions, "session_metrics", F.first(F.lit(1.0)))
    )


def recent_activity(events: DataFrame, as_of, hours: int = 1) -> DataFrame:
    return since_hours(events, as_of, hours, "processed_timestamp").agg(
        _rows().alias("events_last_hour"),
        F.count_distinct("session_id").alias("sessions_last_hour"),
        F.avg("data_quality_score").alias("avg_quality_score"),
        F.max("processed_timestamp").alias("latest_processed"),
    ).withColumn("check_type", F.lit("real_time_check"))


def table_health(events: DataFrame, as_of, hours: int = 2) -> DataFrame:
    now = timestamp_at(as_of)
    health = classify.health_status(
        F.col("latest_update"), F.col("avg_quality"), F.col("record_count"), now
    )
    return (
        since_hours(events, as_of, hours, "processed_timestamp")
        .agg(
            _rows().alias("record_count"),
            F.count_distinct("event_date").alias("date_partitions"),
            F.count_distinct("space_type").alias("space_partitions"),
            F.max("processed_timestamp").alias("latest_update"),
            F.avg("data_quality_score").alias("avg_quality"),
            count_if(F.col("is_bot")).alias("bot_events"),
        )
        .withColumns(
            {
                "table_name": F.lit("web_events"),
                "check_timestamp": now,
                "health_status": health,
            }
        )
    )


def quality_trend(events: DataFrame, as_of, days: int = 7) -> DataFrame:
    return (
        since_days(events, as_of, days)
        .groupBy("event_date")
        .agg(
            F.avg("data_quality_score").alias("avg_quality"),
            percent(count_if(F.col("is_bot")), _rows()).alias("bot_percentage"),
            _rows().alias("total_events"),
        )
        .orderBy(F.desc("event_date"))
    )


def _totals() -> list[Column]:
    return [
        _rows().alias("total_events"),
        F.count_distinct("session_id").alias("unique_sessions"),
        F.count_distinct("anonymous_id").alias("unique_users"),
        F.avg("data_quality_score").alias("avg_quality"),
    ]


def daily_totals(events: DataFrame, day) -> DataFrame:
    return events.where(F.col("event_date") == date_at(day)).agg(*_totals())


def rows_by_date(events: DataFrame) -> DataFrame:
    return events.groupBy("event_date").agg(_rows().alias("rows"))


def filtered_engagement(fact: DataFrame, condition: Column) -> DataFrame:
    """Count, visitors and mean score of the events that meet a condition."""
    return fact.where(condition).agg(
        _rows().alias("matching_events"),
        F.count_distinct("anonymous_id").alias("unique_users"),
        F.avg("engagement_score").alias("avg_engagement"),
    )


def engagement_by_space_type(fact: DataFrame) -> DataFrame:
    return fact.groupBy("space_type").agg(F.avg("engagement_score").alias("avg_engagement"))


def partition_statistics(fact: DataFrame) -> DataFrame:
    return fact.groupBy("event_date", "space_type").agg(
        _rows().alias("record_count"),
        F.min("event_timestamp").alias("min_timestamp"),
        F.max("event_timestamp").alias("max_timestamp"),
        F.avg("engagement_score").alias("avg_engagement"),
    )


def completeness(events: DataFrame, as_of, key: str = "event_id") -> DataFrame:
    """Share of known and of different keys, and seconds since the latest processing."""
    lag = F.unix_timestamp(timestamp_at(as_of)) - F.unix_timestamp("latest_processed")
    return (
        events.agg(
            _rows().alias("total_rows"),
            F.count(key).alias("known_keys"),
            F.count_distinct(key).alias("distinct_keys"),
            F.max("processed_timestamp").alias("latest_processed"),
        )
        .withColumns(
            {
                "completeness_pct": percent(F.col("known_keys"), F.col("total_rows")),
                "uniqueness_pct": percent(F.col("distinct_keys"), F.col("total_rows")),
                "lag_seconds": lag,
            }
        )
    )


def hourly_metrics(events: DataFrame) -> DataFrame:
    hour = F.date_trunc("hour", "event_timestamp").alias("hour_bucket")
    return events.groupBy(hour).agg(
        _rows().alias("events_processed"),
        F.count_distinct("session_id").alias("unique_sessions"),
        F.avg("data_quality_score").alias("avg_quality_score"),
    )


def table_footprint(
    events: DataFrame, as_of, max_bytes: float = 1e12, max_files: int = 1_000_000, max_lag: int = 3600
) -> DataFrame:
    """Bytes, files and processing lag of a file table, with a flag per limit.

    The first aggregate collapses the rows to one per file, so sizes are summed once.
    """
    files = events.groupBy(
        F.col("_metadata.file_path").alias("path"), F.col("_metadata.file_size").alias("size")
    ).agg(F.max("processed_timestamp").alias("latest"), _rows().alias("n"))
    lag = F.unix_timestamp(timestamp_at(as_of)) - F.unix_timestamp("latest_processed")
    return (
        files.agg(
            F.sum("size").alias("total_bytes"),
            _rows().alias("file_count"),
            F.sum("n").alias("row_count"),
            F.max("latest").alias("latest_processed"),
        )
        .withColumn("lag_seconds", lag)
        .withColumns(
            {
                "size_ok": F.col("total_bytes") <= max_bytes,
                "files_ok": F.col("file_count") <= max_files,
                "lag_ok": F.col("lag_seconds") <= max_lag,
            }
        )
    )


def top_spaces(fact: DataFrame, day, n: int = 10) -> DataFrame:
    """Spaces of a day with the longest mean time, ties by name and type."""
    return (
        space_engagement(fact.where(F.col("event_date") == date_at(day)))
        .orderBy(F.desc("avg_time_on_space"), "space_name", "space_type")
        .limit(n)
    )


def space_engagement(fact: DataFrame) -> DataFrame:
    """Sessions, mean time and views per session by day and space."""
    return (
        fact.where(F.col("space_name").isNotNull())
        .groupBy(F.col("event_date").alias("analysis_date"), "space_name", "space_type")
        .agg(
            F.count_distinct("session_id").alias("unique_sessions"),
            F.avg("time_on_page_seconds").alias("avg_time_on_space"),
            _rows().alias("views"),
        )
        .withColumn(
            "views_per_session",
            F.try_divide(F.col("views").cast("double"), F.col("unique_sessions").cast("double")),
        )
    )


def daily_summary(events: DataFrame) -> DataFrame:
    return events.groupBy("event_date").agg(*_totals())


def weekly_summary(events: DataFrame) -> DataFrame:
    week = F.to_date(F.date_trunc("week", "event_date")).alias("week_start")
    return events.groupBy(week).agg(
        *_totals(), F.count_distinct("event_date").alias("days_with_data")
    )


def rolling_event_statistics(events: DataFrame, days: int = 7, limit: float = 2.0) -> DataFrame:
    """Daily counts with rolling mean and deviation, change to the day before and an anomaly flag.

    The windows run over one row per day. A day is anomalous when it is more than ``limit``
    deviations from the rolling mean.
    """
    daily = events.groupBy("event_date").agg(_rows().alias("total_events"))
    by_day = Window.orderBy("event_date")
    rolling = by_day.rowsBetween(-(days - 1), 0)
    total = F.col("total_events")
    before = F.lag("total_events").over(by_day)
    return daily.select(
        F.col("event_date").alias("analysis_date"),
        "total_events",
        F.avg("total_events").over(rolling).alias("rolling_avg_events"),
        F.coalesce(F.stddev("total_events").over(rolling), F.lit(0.0)).alias("rolling_stddev_events"),
        F.try_divide((total - before).cast("double"), before.cast("double")).alias(
            "period_over_period_change"
        ),
    ).withColumn(
        "is_anomaly",
        F.abs(total - F.col("rolling_avg_events")) > limit * F.col("rolling_stddev_events"),
    )


def cohort_retention(events: DataFrame, user: str = "anonymous_id") -> DataFrame:
    """Share of a weekly cohort that is active again, by weeks since the first visit.

    Events collapse to one row per visitor and week first; the window that finds the first week
    sees at most one row per week of a visitor.
    """
    week = F.to_date(F.date_trunc("week", "event_date")).alias("week")
    active = events.where(F.col(user).isNotNull()).select(user, week).distinct()
    first = F.min("week").over(Window.partitionBy(user))
    since = F.floor(F.datediff("week", "cohort_week") / 7).cast("int")
    sizes = Window.partitionBy("cohort_week")
    return (
        active.withColumn("cohort_week", first)
        .withColumn("weeks_since_first_visit", since)
        .groupBy("cohort_week", "weeks_since_first_visit")
        .agg(_rows().alias("active_users"))
        .withColumn(
            "cohort_size",
            F.max(F.when(F.col("weeks_since_first_visit") == 0, F.col("active_users"))).over(sizes),
        )
        .withColumn("retention_rate", percent(F.col("active_users"), F.col("cohort_size")) / 100.0)
        .orderBy("cohort_week", "weeks_since_first_visit")
    )

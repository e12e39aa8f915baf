"""User journeys: fact to daily sessions, to classified journeys, to segments with rates."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import classify
from ..functions.rules import count_if, percent
from ..operators.filters import date_at, since_days

SEGMENT_KEYS = [
    "analysis_date",
    "journey_type",
    "engagement_tier",
    "journey_quality",
    "device_type",
    "detailed_region",
    "session_time_period",
    "conversion_intent_level",
    "space_preference_pattern",
]
SESSION_KEYS = ["analysis_date", "session_id", "anonymous_id"]


def recent_quality_events(fact: DataFrame, as_of, days: int = 30) -> DataFrame:
    recent = since_days(fact, as_of, days).where(F.col("data_quality_score") >= 0.7)
    return recent.withColumn("analysis_date", F.col("event_date"))


def daily_sessions(fact: DataFrame, as_of, days: int = 30) -> DataFrame:
    """One row per day, session and visitor.

    Entry and exit values belong to the whole session, also when it runs over midnight. They are
    mergeable ``min_by``/``max_by`` aggregates per session, joined to the daily rows: no window runs
    over events, and a session id that many visitors share is split by the adaptive skew join.
    """
    core, tour = F.col("is_core_virtual_tour_event"), F.col("is_virtual_tour_page")
    recent = recent_quality_events(fact, as_of, days)
    daily = recent.groupBy(*SESSION_KEYS).agg(
        F.min("event_timestamp").alias("session_start"),
        F.max("event_timestamp").alias("session_end"),
        F.count(F.lit(1)).alias("total_events"),
        F.count_distinct("space_id").alias("unique_spaces_viewed"),
        F.sum("time_on_page_seconds").alias("total_time_on_site_seconds"),
        F.max("exploration_depth").alias("max_exploration_depth"),
        F.sum("engagement_score").alias("total_engagement_score"),
        F.avg("engagement_score").alias("avg_engagement_score"),
        count_if(tour).alias("virtual_tour_events"),
        count_if(F.col("has_space_context")).alias("space_context_events"),
        count_if(core).alias("core_tour_events"),
        F.array_sort(F.collect_set("space_type")).alias("space_types_engaged"),
        F.avg("data_quality_score").alias("avg_data_quality_score"),
        F.min("data_quality_score").alias("min_data_quality_score"),
    )
    return daily.join(session_ends(recent), "session_id")


def session_ends(events: DataFrame) -> DataFrame:
    """First and last values of every session by sequence number."""
    order = F.struct("session_event_sequence", "event_id")
    entry = F.struct(
        F.col("referrer").alias("entry_referrer"),
        F.col("page_path").alias("entry_page"),
        F.col("time_period").alias("session_time_period"),
        "device_type",
        "detailed_region",
    )
    return (
        events.groupBy("session_id")
        .agg(
            F.min_by(entry, order).alias("_entry"),
            F.max_by(F.col("page_path"), order).alias("exit_page"),
        )
        .select("session_id", "_entry.*", "exit_page")
    )


def journey_sequences(fact: DataFrame, as_of, days: int = 30, steps_per_row: int = 1000) -> DataFrame:
    """The ordered steps of every daily session, whole, in rows of at most ``steps_per_row``.

    ``part`` counts the rows of a session from 0 by sequence number; ordinary sessions have one row.
    Bounded rows keep a session with very many events from becoming one huge array in one task.
    """
    steps = [
        "session_event_sequence",
        "page_path",
        "space_type",
        "journey_milestone",
        "engagement_score",
        "event_timestamp",
    ]
    part = F.floor((F.col("session_event_sequence") - 1) / F.lit(steps_per_row))
    return (
        recent_quality_events(fact, as_of, days)
        .groupBy(*SESSION_KEYS, part.alias("part"))
        .agg(F.array_sort(F.collect_list(F.struct(*steps))).alias("journey_sequence"))
    )


def classify_journeys(daily: DataFrame) -> DataFrame:
    seconds = F.unix_timestamp("session_end") - F.unix_timestamp("session_start")
    minutes = F.col("session_duration_minutes")
    return daily.withColumn("session_duration_minutes", seconds / F.lit(60.0)).withColumns(
        {
            "journey_type": classify.journey_type(),
            "engagement_tier": classify.engagement_tier(F.col("total_engagement_score")),
            "journey_quality": classify.journey_quality(F.col("avg_data_quality_score")),
            "bounce_classification": classify.bounce_classification(F.col("total_events"), minutes),
            "conversion_intent_level": classify.conversion_intent_level(),
            "space_preference_pattern": classify.space_preference_pattern(
                F.col("space_types_engaged")
            ),
        }
    )


def journey_segments(classified: DataFrame, min_quality: float = 0.5) -> DataFrame:
    """Nine-dimensional segments of sessions with counts, means and the median duration."""
    kept = classified.where(F.col("min_data_quality_score") >= min_quality)
    bounce, intent = F.col("bounce_classification"), F.col("conversion_intent_level")
    share = F.col("space_context_events").cast("double") / F.col("total_events").cast("double")
    return kept.groupBy(*SEGMENT_KEYS).agg(
        F.count(F.lit(1)).alias("session_count"),
        F.count_distinct("anonymous_id").alias("unique_users"),
        F.avg("session_duration_minutes").alias("avg_session_duration_minutes"),
        # A daily session lasts a whole number of seconds of one day, so the exact percentile counts at
        # most 86,400 different values per segment, whatever the number of sessions.
        F.percentile("session_duration_minutes", 0.5).alias("median_session_duration_minutes"),
        F.avg("total_events").alias("avg_events_per_session"),
        F.avg("unique_spaces_viewed").alias("avg_spaces_per_session"),
        F.avg("total_engagement_score").alias("avg_engagement_score"),
        F.max("total_engagement_score").cast("double").alias("max_engagement_score"),
        F.avg("virtual_tour_events").alias("avg_virtual_tour_events"),
        F.avg("core_tour_events").alias("avg_core_tour_events"),
        F.avg(share).alias("space_context_ratio"),
        count_if(bounce == "immediate_bounce").alias("immediate_bounce_sessions"),
        count_if(bounce == "quick_bounce").alias("quick_bounce_sessions"),
        count_if(bounce == "engaged_session").alias("engaged_sessions"),
        count_if(intent == "high_conversion_intent").alias("high_intent_sessions"),
        count_if(intent == "medium_conversion_intent").alias("medium_intent_sessions"),
        count_if(intent == "low_conversion_intent").alias("low_intent_sessions"),
        count_if(F.col("entry_referrer") != "").alias("referred_sessions"),
        count_if(F.col("entry_page").contains(classify.VIEWER_PATH)).alias("direct_tour_entries"),
        F.avg("avg_data_quality_score").alias("avg_session_quality_score"),
        count_if(F.col("journey_quality") == "high_quality").alias("high_quality_sessions"),
    )


def _rates() -> dict[str, Column]:
    sessions = F.col("session_count")
    bounces = F.col("immediate_bounce_sessions") + F.col("quick_bounce_sessions")
    intents = F.col("high_intent_sessions") + F.col("medium_intent_sessions")
    return {
        "users_per_session_ratio": F.try_divide(
            F.col("unique_users").cast("double"), sessions.cast("double")
        ),
        "total_bounce_rate": percent(bounces, sessions),
        "engagement_rate": percent(F.col("engaged_sessions"), sessions),
        "conversion_intent_rate": percent(intents, sessions),
        "referral_rate": percent(F.col("referred_sessions"), sessions),
        "high_quality_rate": percent(F.col("high_quality_sessions"), sessions),
    }


def journey_kpis(segments: DataFrame, min_segment: int = 10) -> DataFrame:
    return (
        segments.where(F.col("session_count") >= min_segment)
        .withColumns(_rates())
        .withColumns(
            {
                "bounce_category": classify.bounce_category(F.col("total_bounce_rate")),
                "conversion_segment": classify.conversion_segment(F.col("conversion_intent_rate")),
                "created_at": F.current_timestamp(),
                "processing_version": F.lit("iceberg_enhanced"),
            }
        )
    )


def user_journey_analysis(
    fact: DataFrame, as_of, days: int = 30, min_segment: int = 10, ordered: bool = True
) -> DataFrame:
    daily = daily_sessions(fact, as_of, days)
    result = journey_kpis(journey_segments(classify_journeys(daily)), min_segment)
    if not ordered:
        return result
    return result.orderBy(F.desc("analysis_date"), F.desc("session_count"))


def daily_report(journeys: DataFrame, date) -> DataFrame:
    """Totals of one day by journey type, tier, device and region, largest first."""
    return (
        journeys.where(F.col("analysis_date") == date_at(date))
        .groupBy("journey_type", "engagement_tier", "device_type", "detailed_region")
        .agg(
            F.sum("session_count").alias("total_sessions"),
            F.sum("unique_users").alias("total_users"),
            F.avg("avg_session_duration_minutes").alias("avg_duration"),
            F.avg("conversion_intent_rate").alias("avg_conversion_rate"),
            F.sum("high_intent_sessions").alias("high_intent_sessions"),
            F.avg("engagement_rate").alias("avg_engagement_rate"),
        )
        .withColumn("report_date", F.lit(str(date)[:10]))
        .orderBy(F.desc("total_sessions"))
    )


def engagement_funnel(classified: DataFrame) -> DataFrame:
    """Sessions, mean duration and share of sessions with intent, by journey type and tier."""
    wanted = F.col("conversion_intent_level").isin(
        "high_conversion_intent", "medium_conversion_intent"
    )
    return (
        classified.groupBy("journey_type", "engagement_tier")
        .agg(
            F.count(F.lit(1)).alias("sessions"),
            F.avg("session_duration_minutes").alias("avg_duration"),
            percent(count_if(wanted), F.count(F.lit(1))).alias("conversion_rate"),
        )
        .orderBy(F.desc("sessions"))
    )

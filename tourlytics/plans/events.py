"""Event marts: staging view, session view and event fact, each a function of the one before."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import classify
from ..functions.keys import surrogate_key
from ..operators.filters import fact_filter, staging_filter
from ..operators.sequencing import SLICE_SECONDS, session_boundaries


def stage_events(
    web_events: DataFrame,
    start,
    as_of,
    exclude_bots: bool = True,
    min_quality: float = 0.5,
) -> DataFrame:
    """Filtered events with recomputed flags; keeps every event column.

    ``event_key`` is the surrogate key over session, visitor and time. The source's ``event_id``
    stays, because two events of a visitor at one moment share that key.
    """
    kept = staging_filter(web_events, start, as_of, exclude_bots, min_quality)
    return kept.withColumns(
        {
            "event_key": surrogate_key("session_id", "anonymous_id", "event_timestamp"),
            "engagement_level": classify.engagement_level(F.col("time_on_page_seconds")),
            "is_virtual_tour_page": classify.viewer_page_prefix(F.col("page_path")),
            "has_space_context": F.col("space_id").isNotNull(),
            "region": classify.region(F.col("timezone")),
        }
    )


def fact_columns() -> dict[str, Column]:
    """Columns the fact adds to the session view."""
    direction = F.col("coordinates")
    return {
        "space_category": classify.space_category(),
        "room_category": classify.room_category(F.col("room_name")),
        "location_context_level": classify.location_context_level(
            F.col("community"), F.col("building")
        ),
        "navigation_type": classify.navigation_type(F.col("event_name"), direction["pitch"]),
        "engagement_score": classify.engagement_score(),
        "spatial_exploration_level": classify.spatial_exploration_level(direction),
        "journey_milestone": classify.journey_milestone(),
        "exploration_depth": classify.exploration_depth(F.col("total_session_events")),
        "time_period": classify.time_period(F.col("event_hour")),
        "detailed_region": classify.detailed_region(F.col("timezone")),
        "session_progress_ratio": classify.session_progress_ratio(
            F.col("session_event_sequence"), F.col("total_session_events")
        ),
        "is_core_virtual_tour_event": classify.is_core_tour_event(
            F.col("has_space_context"), F.col("space_type")
        ),
        "processing_source": F.lit("iceberg_native"),
        "dbt_processed_at": F.current_timestamp(),
    }


def build_fact(boundaries: DataFrame, min_quality: float = 0.7) -> DataFrame:
    return fact_filter(boundaries.withColumns(fact_columns()), min_quality)


def fact_from_web_events(
    web_events: DataFrame, slice_seconds: int = SLICE_SECONDS, **staging
) -> DataFrame:
    staged = stage_events(web_events, **staging)
    return build_fact(session_boundaries(staged, slice_seconds))

"""Spatial analytics: four aggregation levels over events with a place or a direction."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import classify
from ..functions.rules import count_if, percent
from ..operators.filters import date_at, spatially_relevant
from ..operators.quantiles import grouped_quantiles, join_groups
from ..schemas import SPATIAL_ANALYTICS, conform

ROOM_KEYS = ["analysis_date", "community", "building", "space_name", "room_category"]
CELL_KEYS = [
    *ROOM_KEYS, "room_name", "navigation_intensity", "session_id", "anonymous_id", "user_id",
]
_VIEWED_ROOMS = ["living_space", "bedroom", "kitchen", "bathroom", "outdoor_space"]


def _turned() -> Column:
    return F.col("coordinates").isNotNull()


def spatial_events(fact: DataFrame, start) -> DataFrame:
    """Events with a direction, a room or a community; only the columns the levels use."""
    direction = F.col("coordinates")
    return spatially_relevant(fact.where(F.col("event_date") >= date_at(start))).select(
        F.col("event_date").alias("analysis_date"),
        "community",
        "building",
        "space_type",
        "space_name",
        "room_id",
        "room_name",
        "event_name",
        "coordinates",
        "session_id",
        "anonymous_id",
        "user_id",
        "event_timestamp",
        "engagement_score",
        "time_on_page_seconds",
        direction["pitch"].alias("pitch_angle"),
        direction["yaw"].alias("yaw_angle"),
        direction["hfov"].alias("field_of_view"),
        classify.room_category(F.col("room_name")).alias("room_category"),
        classify.navigation_event_type(F.col("event_name")).alias("navigation_event_type"),
    )


def spatial_cells(spatial: DataFrame) -> DataFrame:
    """One row per place, direction class, session and visitor, with counts and sums.

    Every level but the exact quantiles is a roll-up of these rows, so distinct counts run over them and
    not over events.
    """
    event, turned = F.col("navigation_event_type"), _turned()
    intensity = classify.navigation_intensity(F.col("pitch_angle"), F.col("yaw_angle"))
    averaged = {
        "engagement": F.col("engagement_score"),
        "time": F.col("time_on_page_seconds"),
        "pitch": F.col("pitch_angle"),
        "yaw": F.col("yaw_angle"),
        "pitch_size": F.abs("pitch_angle"),
        "yaw_size": F.abs("yaw_angle"),
        "fov": F.col("field_of_view"),
    }
    sums = [F.sum(c).alias(f"{name}_sum") for name, c in averaged.items()]
    counts = [F.count(c).alias(f"{name}_n") for name, c in averaged.items()]
    return spatial.withColumn("navigation_intensity", F.when(turned, intensity)).groupBy(*CELL_KEYS).agg(
        F.count(F.lit(1)).alias("events"),
        count_if(turned).alias("turned"),
        count_if(event == "position_change").alias("position_changes"),
        count_if(event == "room_entry").alias("room_entries"),
        count_if(F.col("engagement_score") >= 3).alias("strong"),
        *sums,
        *counts,
    )


def _total(name: str) -> Column:
    return F.coalesce(F.sum(name), F.lit(0)).cast("bigint")


def _mean(name: str) -> Column:
    return F.try_divide(F.sum(f"{name}_sum").cast("double"), F.sum(f"{name}_n"))


def community_analytics(cells: DataFrame) -> DataFrame:
    rows, in_room = F.sum("events"), F.when(F.col("room_name").isNotNull(), F.col("events"))
    views = [
        F.coalesce(F.sum(F.when(F.col("room_category") == room, F.col("events"))), F.lit(0)).alias(f"{room}_views")
        for room in _VIEWED_ROOMS
    ]
    return cells.groupBy("analysis_date", "community", "building").agg(
        rows.alias("total_spatial_events"),
        F.count_distinct("session_id").alias("unique_sessions"),
        F.count_distinct("anonymous_id").alias("unique_anonymous_users"),
        F.count_distinct("user_id").alias("unique_authenticated_users"),
        F.count_distinct("space_name").alias("unique_spaces_viewed"),
        F.count_distinct("room_name").alias("unique_rooms_viewed"),
        _mean("engagement").alias("avg_engagement_score"),
        _mean("time").alias("avg_time_per_view"),
        F.sum("time_sum").alias("total_engagement_time"),
        _total("turned").alias("three_d_navigation_events"),
        _total("position_changes").alias("position_changes"),
        _mean("pitch_size").alias("avg_pitch_variation"),
        _mean("yaw_size").alias("avg_yaw_variation"),
        *views,
        percent(F.sum("turned"), rows).alias("three_d_engagement_rate"),
        percent(F.coalesce(F.sum(in_room), F.lit(0)), rows).alias("room_context_rate"),
    )


def room_analytics(cells: DataFrame, spatial: DataFrame) -> DataFrame:
    rows = F.sum("events")
    rooms = cells.where(F.col("room_name").isNotNull()).groupBy(*ROOM_KEYS).agg(
        F.count_distinct("session_id").alias("sessions_visiting_room"),
        rows.alias("total_room_events"),
        _mean("time").alias("avg_time_in_room"),
        _total("turned").alias("three_d_events_in_room"),
        _mean("pitch").alias("avg_pitch_in_room"),
        _mean("yaw").alias("avg_yaw_in_room"),
        _mean("fov").alias("avg_fov_in_room"),
        _total("room_entries").alias("room_entries"),
        _total("position_changes").alias("position_changes_in_room"),
        _total("strong").alias("high_engagement_events"),
        percent(F.sum("strong"), rows).alias("high_engagement_rate"),
    )
    in_room = spatial.where(F.col("room_name").isNotNull())
    median = grouped_quantiles(in_room, ROOM_KEYS, "time_on_page_seconds", {"median_time_in_room": 0.5})
    return join_groups(rooms, median, ROOM_KEYS)


def navigation_behavior(cells: DataFrame, spatial: DataFrame) -> DataFrame:
    keys = ["analysis_date", "navigation_intensity"]
    behavior = cells.where(F.col("turned") > 0).groupBy(*keys).agg(
        F.sum("events").alias("events_count"),
        F.count_distinct("session_id").alias("unique_sessions"),
        _mean("time").alias("avg_time_per_view"),
        _mean("engagement").alias("avg_engagement"),
        _mean("fov").alias("avg_field_of_view"),
    )
    intensity = classify.navigation_intensity(F.col("pitch_angle"), F.col("yaw_angle"))
    turned = spatial.where(_turned()).withColumn("navigation_intensity", intensity)
    quartiles = grouped_quantiles(turned, keys, "field_of_view", {"p25_fov": 0.25, "p75_fov": 0.75})
    return join_groups(behavior, quartiles, keys)


def auth_impact(cells: DataFrame) -> DataFrame:
    rows, in_room = F.sum("events"), F.when(F.col("room_name").isNotNull(), F.col("events")).otherwise(0)
    kind = classify.user_type(F.col("user_id")).alias("user_type")
    return cells.groupBy("analysis_date", kind).agg(
        rows.alias("total_events"),
        F.count_distinct("session_id").alias("unique_sessions"),
        F.count_distinct(F.coalesce("user_id", "anonymous_id")).alias("unique_users"),
        _total("turned").alias("three_d_events"),
        F.sum(in_room).alias("room_context_events"),
        _mean("engagement").alias("avg_engagement_score"),
        _mean("time").alias("avg_time_per_event"),
        F.count_distinct("room_name").alias("unique_rooms_accessed"),
        F.count_distinct("community").alias("unique_communities_accessed"),
        percent(F.sum("turned"), rows).alias("three_d_usage_rate"),
        percent(F.sum(in_room), rows).alias("room_context_rate"),
    )


def spatial_analytics(cells: DataFrame, spatial: DataFrame) -> DataFrame:
    """The four levels stacked; a column a level lacks is a typed NULL.

    ``cells`` is best a written table (see ``spatial_cells``): each level reads it. Events are read for
    the quantiles alone.
    """
    community = community_analytics(cells).withColumn("analysis_level", F.lit("community_level"))
    rooms = (
        room_analytics(cells, spatial)
        .withColumnsRenamed(
            {
                "total_room_events": "total_spatial_events",
                "sessions_visiting_room": "unique_sessions",
                "avg_time_in_room": "avg_time_per_view",
                "three_d_events_in_room": "three_d_navigation_events",
            }
        )
        .withColumn("analysis_level", F.lit("room_level"))
    )
    movement = (
        navigation_behavior(cells, spatial)
        .withColumnsRenamed(
            {"events_count": "total_spatial_events", "avg_engagement": "avg_engagement_score"}
        )
        .withColumns(
            {
                "analysis_level": F.lit("navigation_behavior"),
                "three_d_navigation_events": F.col("total_spatial_events"),
            }
        )
    )
    kind, users = F.col("user_type"), F.col("unique_users")
    access = (
        auth_impact(cells)
        .withColumnsRenamed(
            {
                "total_events": "total_spatial_events",
                "unique_rooms_accessed": "unique_rooms_viewed",
                "avg_time_per_event": "avg_time_per_view",
                "three_d_events": "three_d_navigation_events",
            }
        )
        .withColumns(
            {
                "analysis_level": F.lit("user_type_analysis"),
                "unique_anonymous_users": F.when(kind == "anonymous", users),
                "unique_authenticated_users": F.when(kind == "authenticated", users),
                "three_d_engagement_rate": F.col("three_d_usage_rate"),
            }
        )
    )
    stacked = conform(community, SPATIAL_ANALYTICS)
    for level in (rooms, movement, access):
        stacked = stacked.unionByName(conform(level, SPATIAL_ANALYTICS))
    return stacked

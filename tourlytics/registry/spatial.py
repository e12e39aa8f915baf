"""Spatial analytics."""

from __future__ import annotations

from ..plans import spatial
from ..schemas import SPATIAL_ANALYTICS
from ..sources.tables import write_mart
from . import data
from .catalog import query
from .oracle_base import big, chain, day, rnd, ts
from .result import plain

SPATIAL = """
spa AS (
  SELECT *, event_date AS analysis_date,
    CASE WHEN strpos(event_name, 'Room View Position') > 0 THEN 'position_change'
      WHEN strpos(event_name, 'Room View') > 0 THEN 'room_entry'
      WHEN strpos(event_name, 'Toggle') > 0 THEN 'ui_interaction' ELSE 'standard_event' END
      AS navigation_event_type
  FROM fct WHERE has_coordinates OR room_name IS NOT NULL OR community IS NOT NULL)"""

COMMUNITY = """
com AS (
  SELECT analysis_date, community, building, count(*) AS total_spatial_events,
    count(DISTINCT session_id) AS unique_sessions,
    count(DISTINCT anonymous_id) AS unique_anonymous_users,
    count(DISTINCT user_id) AS unique_authenticated_users,
    count(DISTINCT space_name) AS unique_spaces_viewed,
    count(DISTINCT room_name) AS unique_rooms_viewed,
    avg(engagement_score) AS avg_engagement_score, avg(time_on_page_seconds) AS avg_time_per_view,
    CAST(sum(time_on_page_seconds) AS BIGINT) AS total_engagement_time,
    count(*) FILTER (WHERE has_coordinates) AS three_d_navigation_events,
    count(*) FILTER (WHERE navigation_event_type = 'position_change') AS position_changes,
    avg(abs(pitch)) AS avg_pitch_variation, avg(abs(yaw)) AS avg_yaw_variation,
    count(*) FILTER (WHERE room_category = 'living_space') AS living_space_views,
    count(*) FILTER (WHERE room_category = 'bedroom') AS bedroom_views,
    count(*) FILTER (WHERE room_category = 'kitchen') AS kitchen_views,
    count(*) FILTER (WHERE room_category = 'bathroom') AS bathroom_views,
    count(*) FILTER (WHERE room_category = 'outdoor_space') AS outdoor_space_views,
    100 * avg(has_coordinates::INT) AS three_d_engagement_rate,
    100 * avg((room_name IS NOT NULL)::INT) AS room_context_rate
  FROM spa GROUP BY analysis_date, community, building)"""

ROOM = """
rom AS (
  SELECT analysis_date, community, building, space_name, room_category,
    count(DISTINCT session_id) AS sessions_visiting_room, count(*) AS total_room_events,
    avg(time_on_page_seconds) AS avg_time_in_room,
    quantile_cont(time_on_page_seconds::DOUBLE, 0.5) AS median_time_in_room,
    count(*) FILTER (WHERE has_coordinates) AS three_d_events_in_room,
    avg(pitch) AS avg_pitch_in_room, avg(yaw) AS avg_yaw_in_room, avg(hfov) AS avg_fov_in_room,
    count(*) FILTER (WHERE navigation_event_type = 'room_entry') AS room_entries,
    count(*) FILTER (WHERE navigation_event_type = 'position_change') AS position_changes_in_room,
    count(*) FILTER (WHERE engagement_score >= 3) AS high_engagement_events,
    100 * avg((engagement_score >= 3)::INT) AS high_engagement_rate
  FROM spa WHERE room_name IS NOT NULL
  GROUP BY analysis_date, community, building, space_name, room_category)"""

NAVIGATION = """
nav AS (
  SELECT analysis_date,
    CASE WHEN pitch IS NULL OR yaw IS NULL THEN 'intensive_navigation'
      WHEN abs(pitch) <= 10 AND abs(yaw) <= 45 THEN 'minimal_navigation'
      WHEN abs(pitch) <= 30 AND abs(yaw) <= 120 THEN 'moderate_navigation'
      WHEN abs(pitch) <= 60 AND abs(yaw) <= 270 THEN 'active_navigation'
      ELSE 'intensive_navigation' END AS navigation_intensity,
    count(*) AS events_count, count(DISTINCT session_id) AS unique_sessions,
    avg(time_on_page_seconds) AS avg_time_per_view, avg(engagement_score) AS avg_engagement,
    avg(hfov) AS avg_field_of_view, quantile_cont(hfov, 0.25) AS p25_fov,
    quantile_cont(hfov, 0.75) AS p75_fov
  FROM spa WHERE has_coordinates GROUP BY ALL)"""

ACCESS = """
acc AS (
  SELECT analysis_date, if(user_id IS NULL, 'anonymous', 'authenticated') AS user_type,
    count(*) AS total_events, count(DISTINCT session_id) AS unique_sessions,
    count(DISTINCT coalesce(user_id, anonymous_id)) AS unique_users,
    count(*) FILTER (WHERE has_coordinates) AS three_d_events,
    count(room_name) AS room_context_events, avg(engagement_score) AS avg_engagement_score,
    avg(time_on_page_seconds) AS avg_time_per_event,
    count(DISTINCT room_name) AS unique_rooms_accessed,
    count(DISTINCT community) AS unique_communities_accessed,
    100 * avg(has_coordinates::INT) AS three_d_usage_rate,
    100 * avg((room_name IS NOT NULL)::INT) AS room_context_rate
  FROM spa GROUP BY ALL)"""


def _cols(text: str, doubles: str) -> str:
    names = ", ".join(text.split())
    return f"{day('analysis_date')}, {names}, " + ", ".join(rnd(c, c) for c in doubles.split())


def _spatial(spark, folder):
    return spatial.spatial_events(data.fact(spark, folder), data.START)


def _cells(spark, folder):
    """The roll-up that the levels read, written once."""

    def write(path: str) -> None:
        write_mart(spatial.spatial_cells(_spatial(spark, folder)), path, ["analysis_date"])

    return spark.read.parquet(data.written_path(spark, folder, "spatial_cells", write))


@query(
    "spatial_events",
    chain("fct", SPATIAL)
    + f"""SELECT {day("analysis_date")}, community, building, space_type, space_name, room_id,
room_name, event_name, session_id, anonymous_id, user_id, {ts("event_timestamp")}, engagement_score,
time_on_page_seconds, pitch AS pitch_angle, yaw AS yaw_angle, hfov AS field_of_view, room_category,
navigation_event_type FROM spa""",
)
def events(spark, folder):
    return plain(_spatial(spark, folder).drop("coordinates"))


@query(
    "community_analytics",
    chain("fct", SPATIAL, COMMUNITY)
    + "SELECT "
    + _cols(
        """community building total_spatial_events unique_sessions unique_anonymous_users
        unique_authenticated_users unique_spaces_viewed unique_rooms_viewed total_engagement_time
        three_d_navigation_events position_changes living_space_views bedroom_views kitchen_views
        bathroom_views outdoor_space_views""",
        """avg_engagement_score avg_time_per_view avg_pitch_variation avg_yaw_variation
        three_d_engagement_rate room_context_rate""",
    )
    + " FROM com",
)
def community(spark, folder):
    return plain(spatial.community_analytics(_cells(spark, folder)))


@query(
    "room_analytics",
    chain("fct", SPATIAL, ROOM)
    + "SELECT "
    + _cols(
        """community building space_name room_category sessions_visiting_room total_room_events
        three_d_events_in_room room_entries position_changes_in_room high_engagement_events""",
        """avg_time_in_room median_time_in_room avg_pitch_in_room avg_yaw_in_room avg_fov_in_room
        high_engagement_rate""",
    )
    + " FROM rom",
)
def rooms(spark, folder):
    return plain(spatial.room_analytics(_cells(spark, folder), _spatial(spark, folder)))


@query(
    "navigation_behavior",
    chain("fct", SPATIAL, NAVIGATION)
    + "SELECT "
    + _cols(
        "navigation_intensity events_count unique_sessions",
        "avg_time_per_view avg_engagement avg_field_of_view p25_fov p75_fov",
    )
    + " FROM nav",
)
def navigation(spark, folder):
    return plain(spatial.navigation_behavior(_cells(spark, folder), _spatial(spark, folder)))


@query(
    "auth_impact",
    chain("fct", SPATIAL, ACCESS)
    + "SELECT "
    + _cols(
        """user_type total_events unique_sessions unique_users three_d_events room_context_events
        unique_rooms_accessed unique_communities_accessed""",
        "avg_engagement_score avg_time_per_event three_d_usage_rate room_context_rate",
    )
    + " FROM acc",
)
def access(spark, folder):
    return plain(spatial.auth_impact(_cells(spark, folder)))


_LEVELS = """
lev AS (
  SELECT *, 'community_level' AS analysis_level FROM com
  UNION ALL BY NAME
  SELECT * RENAME (total_room_events AS total_spatial_events,
      sessions_visiting_room AS unique_sessions, avg_time_in_room AS avg_time_per_view,
      three_d_events_in_room AS three_d_navigation_events), 'room_level' AS analysis_level FROM rom
  UNION ALL BY NAME
  SELECT * RENAME (events_count AS total_spatial_events, avg_engagement AS avg_engagement_score),
    events_count AS three_d_navigation_events, 'navigation_behavior' AS analysis_level FROM nav
  UNION ALL BY NAME
  SELECT * EXCLUDE (unique_users) RENAME (total_events AS total_spatial_events,
      unique_rooms_accessed AS unique_rooms_viewed, avg_time_per_event AS avg_time_per_view,
      three_d_events AS three_d_navigation_events),
    three_d_usage_rate AS three_d_engagement_rate,
    if(user_type = 'anonymous', unique_users, NULL) AS unique_anonymous_users,
    if(user_type = 'authenticated', unique_users, NULL) AS unique_authenticated_users,
    'user_type_analysis' AS analysis_level FROM acc)"""


def _mart_cols() -> str:
    out = []
    for field in SPATIAL_ANALYTICS.fields:
        kind, name = field.dataType.simpleString(), field.name
        out.append({"date": day, "double": lambda n: rnd(n, n), "bigint": lambda n: big(n, n)}.get(
            kind, str)(name))
    return ", ".join(out)


@query(
    "spatial_analytics",
    chain("fct", SPATIAL, COMMUNITY, ROOM, NAVIGATION, ACCESS, _LEVELS)
    + f"SELECT {_mart_cols()} FROM lev",
)
def analytics(spark, folder):
    return plain(spatial.spatial_analytics(_cells(spark, folder), _spatial(spark, folder)))

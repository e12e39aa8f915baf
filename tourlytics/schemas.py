"""Declared tables: column names, types, comments and partition keys.

Fixed values: the names, types and partition keys below are the data contract of the tables.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

COORDINATES = T.StructType(
    [
        T.StructField("pitch", T.DoubleType(), True, {"comment": "vertical angle, degrees"}),
        T.StructField("yaw", T.DoubleType(), True, {"comment": "horizontal angle, degrees"}),
        T.StructField("hfov", T.DoubleType(), True, {"comment": "horizontal field of view, degrees"}),
    ]
)

_TYPES = {
    "string": T.StringType(),
    "timestamp": T.TimestampType(),
    "date": T.DateType(),
    "int": T.IntegerType(),
    "bigint": T.LongType(),
    "double": T.DoubleType(),
    "boolean": T.BooleanType(),
    "strings": T.ArrayType(T.StringType()),
    "coordinates": COORDINATES,
}


def _table(text: str) -> T.StructType:
    """One ``name type comment`` per line."""
    fields = []
    for line in text.strip().splitlines():
        name, kind, comment = line.strip().split(None, 2)
        fields.append(T.StructField(name, _TYPES[kind], True, {"comment": comment}))
    return T.StructType(fields)


WEB_EVENTS = _table(
    """
    event_id string key of the event
    event_timestamp timestamp when it happened, UTC
    event_date date day of the event, partition key
    event_hour int hour of the day
    event_type string page, track, ...
    event_name string specific action
    anonymous_id string visitor
    user_id string signed-in user
    session_id string client session
    session_event_sequence int position in the session, from 1
    is_first_event_in_session boolean first position
    time_on_page_seconds bigint whole seconds until the next event
    app_id string application
    app_name string application label
    page_url string full address
    page_path string path part
    page_title string title
    url_search string query part
    url_hash string fragment part
    space_id string virtual space
    space_name string space label
    space_type string unit, amenity, ...; partition key
    space_token string access token
    room_id string room
    room_name string room label
    community string property
    building string building
    floorplan string floor plan
    coordinates coordinates viewer direction
    user_agent string browser text
    os_name string operating system
    locale string language and country
    timezone string zone name
    referrer string referring address
    screen_width int pixels
    screen_height int pixels
    device_type string mobile, tablet, desktop
    is_virtual_tour_page boolean viewer page
    has_space_context boolean a space is known
    data_quality_score double 0 to 1
    is_bot boolean automated traffic
    processed_timestamp timestamp when it was processed
    seconds_utc_ts bigint original time, milliseconds
    kinesis_sequence_number string sequence number of the record
    kinesis_partition_key string partition key of the record
    properties_json string raw properties
    mongodb_id string id of the source document
    created_at timestamp creation of the source document
    updated_at timestamp last change of the source document
    """
)

# Columns the batch flow adds to the declared event table.
WEB_EVENTS_ENRICHED = T.StructType(
    WEB_EVENTS.fields
    + _table(
        """
        has_room_context boolean a room is known
        has_coordinates boolean a direction is known
        region string coarse region from the zone
        """
    ).fields
)

SESSION_METRICS = _table(
    """
    session_id string client session
    anonymous_id string visitor
    user_id string signed-in user
    session_start timestamp first event
    session_end timestamp last event
    session_duration_seconds bigint whole seconds from first to last
    total_events bigint events
    unique_spaces_viewed bigint different spaces
    total_time_on_site_seconds bigint sum of time on page
    bounce_session boolean one event only
    space_types_viewed strings different space types
    rooms_viewed strings different room labels
    virtual_tour_events bigint events on viewer pages
    core_tour_events bigint core tour events
    three_d_navigation_events bigint events with a direction
    communities_visited strings different communities
    buildings_visited strings different buildings
    referrer string of the first event
    user_agent string of the first event
    timezone string of the first event
    device_type string of the first event
    region string of the first event
    processed_timestamp timestamp when it was processed
    event_date date day, partition key
    """
)

USER_JOURNEY = _table(
    """
    analysis_date date day, partition key
    journey_type string kind of journey
    engagement_tier string engagement level
    journey_quality string quality level
    device_type string device
    detailed_region string region
    session_time_period string part of the day
    conversion_intent_level string intent level
    space_preference_pattern string preferred spaces
    session_count bigint sessions
    unique_users bigint visitors
    avg_session_duration_minutes double mean duration
    median_session_duration_minutes double median duration
    avg_events_per_session double mean events
    avg_spaces_per_session double mean spaces
    avg_engagement_score double mean session score
    max_engagement_score double highest session score
    avg_virtual_tour_events double mean viewer events
    avg_core_tour_events double mean core events
    space_context_ratio double mean share of events with a space
    immediate_bounce_sessions bigint one-event sessions
    quick_bounce_sessions bigint short sessions
    engaged_sessions bigint other sessions
    high_intent_sessions bigint high intent
    medium_intent_sessions bigint medium intent
    low_intent_sessions bigint low intent
    referred_sessions bigint sessions with a referrer
    direct_tour_entries bigint sessions that start in the viewer
    avg_session_quality_score double mean quality
    high_quality_sessions bigint high quality sessions
    users_per_session_ratio double visitors per session
    total_bounce_rate double percent
    engagement_rate double percent
    conversion_intent_rate double percent
    referral_rate double percent
    high_quality_rate double percent
    bounce_category string level of the bounce rate
    conversion_segment string level of the intent rate
    created_at timestamp when it was built
    processing_version string version label
    """
)

SNAPSHOT_ANALYSIS = _table(
    """
    event_date date day, partition key
    space_type string space type or all_spaces
    current_events bigint events now
    current_sessions bigint sessions now
    current_users bigint visitors now
    current_engagement double mean score now
    current_time_on_page double mean time now
    current_core_events bigint core events now
    current_quality double mean quality now
    historical_events bigint events then
    historical_sessions bigint sessions then
    historical_users bigint visitors then
    historical_engagement double mean score then
    historical_time_on_page double mean time then
    historical_core_events bigint core events then
    historical_quality double mean quality then
    events_change bigint difference
    sessions_change bigint difference
    users_change bigint difference
    engagement_change double difference
    time_on_page_change double difference
    core_events_change bigint difference
    quality_change double difference
    events_change_pct double percent
    sessions_change_pct double percent
    engagement_change_pct double percent
    events_variance_flag string size of the event change
    engagement_variance_flag string size of the score change
    quality_trend string direction of the quality
    data_freshness_status string growth of the data
    """
)

SPATIAL_ANALYTICS = _table(
    """
    analysis_date date day, partition key
    analysis_level string which of the four levels
    community string property
    building string building
    space_name string space label
    room_category string kind of room
    navigation_intensity string strength of the movement
    user_type string authenticated or anonymous
    total_spatial_events bigint events
    unique_sessions bigint sessions
    unique_anonymous_users bigint visitors
    unique_authenticated_users bigint signed-in users
    unique_spaces_viewed bigint spaces
    unique_rooms_viewed bigint rooms
    avg_engagement_score double mean score
    avg_time_per_view double mean seconds
    three_d_navigation_events bigint events with a direction
    three_d_engagement_rate double percent
    room_context_rate double percent
    living_space_views bigint events
    bedroom_views bigint events
    kitchen_views bigint events
    bathroom_views bigint events
    outdoor_space_views bigint events
    avg_pitch_in_room double degrees
    avg_yaw_in_room double degrees
    avg_fov_in_room double degrees
    high_engagement_rate double percent
    avg_field_of_view double degrees
    three_d_usage_rate double percent
    """
)

PARTITIONS = {
    "web_events": ["event_date", "space_type"],
    "session_metrics": ["event_date"],
    "user_journey_analysis": ["analysis_date"],
    "spatial_analytics": ["analysis_date"],
    "time_travel_analysis": ["event_date"],
    "fct_web_events": ["event_date", "space_type"],
}


def conform(df: DataFrame, schema: T.StructType) -> DataFrame:
    """Project to the declared columns in order; a column the input lacks becomes NULL."""
    have = set(df.columns)

    def one(field: T.StructField) -> Column:
        value = F.col(field.name) if field.name in have else F.lit(None)
        return value.cast(field.dataType).alias(field.name, metadata=field.metadata)

    return df.select(*[one(f) for f in schema.fields])

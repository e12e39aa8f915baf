"""DuckDB text of the shared stages, written apart from the Spark code.

``chain(upto)`` returns the WITH clause up to a stage: src, seq, web, stg, bnd, fct.
"""

from __future__ import annotations

AS_OF = "2024-01-31 00:00:00"
THEN = "2024-01-30 00:00:00"


def ladder(value: str, steps, otherwise: str) -> str:
    """CASE over descending lower bounds."""
    arms = " ".join(f"WHEN {value} >= {bound} THEN '{label}'" for bound, label in steps)
    return f"CASE {arms} ELSE '{otherwise}' END"


def pick(index: str, *values) -> str:
    arms = " ".join(f"WHEN {at} THEN '{v}'" for at, v in enumerate(values) if v is not None)
    return f"CASE {index} {arms} END"


SRC = f"""
raw0 AS (
  SELECT event_id AS i, user_id AS usr, event_type AS et, props, epoch_us(ts) AS ts_us,
         CAST(regexp_extract(props, '([0-9]+)', 1) AS INT) AS k,
         CASE WHEN user_id % 3 = 0 THEN user_id % 5 ELSE 100 + user_id % 37 END AS u,
         CASE WHEN user_id % 3 = 0 THEN 1 ELSE 1 + (user_id % 37) % 6 END AS m
  FROM events),
raw1 AS (
  SELECT *, (ts_us // 86400000000) * 86400000000 + (u % 24) * 3600000000
            + (ts_us % 86400000000) // 60 AS us FROM raw0),
raw2 AS (
  SELECT *, make_timestamp(us) AS t,
         {pick("i % 4", "/viewer", "/viewer/x", "/home", "/a/viewer")} AS pth,
         'u' || u AS who FROM raw1),
src AS (
  SELECT 'e' || i AS event_id, t AS event_timestamp, CAST(t AS DATE) AS event_date,
    CAST(hour(t) AS BIGINT) AS event_hour,
    if(et IN ('view', 'signup'), 'page', 'track') AS event_type,
    {pick("k % 4", "Room View Position", "Room View", "Toggle Fullscreen")} AS event_name,
    if(k IN (7, 8), NULL, who) AS anonymous_id,
    if(k % 4 = 0, 'auth' || u, NULL) AS user_id,
    if(k = 9, NULL, who || '-' || strftime(t, '%Y%m%d') || '-' || (i % m)) AS session_id,
    'web-viewer' AS app_id, 'tour' AS app_name,
    if(k = 21, NULL, 'https://tours.example' || pth) AS page_url, pth AS page_path,
    'Page ' || (i % 4) AS page_title, if(k % 2 = 0, '?k=' || k, NULL) AS url_search,
    if(k % 7 = 0, NULL, 'sp' || (k % 12)) AS space_id,
    if(k % 7 = 0, NULL, 'Space ' || (k % 12)) AS space_name,
    {pick("i % 5", "unit", "amenity", "common_area", "tour", "unknown")} AS space_type,
    if(k % 9 IN (0, 7), NULL, 'room' || (k % 9)) AS room_id,
    {pick("k % 9", None, "Living Room", "Master Bedroom", "Kitchen", "Bathroom", "Patio",
          "Home Office", "Hallway", "family den")} AS room_name,
    if(k % 5 = 0, NULL, 'Community ' || (k % 3)) AS community,
    if(k % 3 = 0, NULL, 'B' || (k % 4)) AS building,
    if(k % 2 = 0, NULL, 'fp' || (k % 6)) AS floorplan,
    k % 3 <> 0 AS has_coordinates,
    if(k % 3 = 0 OR k = 31, NULL, CAST(k * 3 % 151 - 75 AS DOUBLE)) AS pitch,
    if(k % 3 = 0, NULL, CAST(i * 37 % 721 - 360 AS DOUBLE)) AS yaw,
    if(k % 3 = 0, NULL, CAST(60 + k % 60 AS DOUBLE)) AS hfov,
    CASE k WHEN 13 THEN 'Googlebot/2.1' WHEN 14 THEN 'Site CRAWLER 1.0' WHEN 17 THEN NULL
      WHEN 19 THEN '' ELSE 'Mozilla/5.0 Browser/' || (k % 3) END AS user_agent,
    {pick("k % 3", "Linux", "Windows", "macOS")} AS os_name, 'en-US' AS locale,
    {pick("k % 10", "America/New_York", "America/Chicago", "America/Los_Angeles", "Europe/Paris",
          "Asia/Tokyo", "Pacific/Auckland", "Africa/Cairo", "America/Buenos_Aires", None,
          "UTC")} AS timezone,
    {pick("i % 6", "", "https://search.example/q", "https://tours.example/home?from=mail", None,
          "https://tours.example/viewer", "")} AS referrer,
    CAST({pick("k % 6", "375", "767", "768", "1023", "1024")} AS BIGINT) AS screen_width,
    CAST(800 AS BIGINT) AS screen_height,
    make_timestamp(us + (k % 48) * 3600000000) AS processed_timestamp,
    us // 1000 AS seconds_utc_ts, 'seq' || i AS kinesis_sequence_number,
    who AS kinesis_partition_key, props AS properties_json, 'doc' || i AS mongodb_id,
    t AS created_at, t AS updated_at
  FROM raw2)"""

ENR = """
enr AS (
  SELECT *,
    CASE WHEN screen_width < 768 THEN 'mobile' WHEN screen_width < 1024 THEN 'tablet'
      ELSE 'desktop' END AS device_type,
    strpos(page_path, '/viewer') > 0 AS is_virtual_tour_page,
    space_id IS NOT NULL AS has_space_context, room_id IS NOT NULL AS has_room_context,
    CASE WHEN regexp_matches(timezone, 'America') THEN 'Americas'
      WHEN regexp_matches(timezone, 'Europe') THEN 'Europe'
      WHEN regexp_matches(timezone, 'Asia|Pacific') THEN 'Asia-Pacific' ELSE 'Other' END AS region
  FROM src
  WHERE session_id IS NOT NULL AND coalesce(anonymous_id, user_id) IS NOT NULL)"""

SEQ = """
seq0 AS (
  SELECT *, row_number() OVER s AS session_event_sequence,
         lead(event_timestamp) OVER s AS next_event_timestamp
  FROM enr WINDOW s AS (PARTITION BY session_id ORDER BY event_timestamp, event_id)),
seq AS (
  SELECT *, session_event_sequence = 1 AS is_first_event_in_session,
    CAST(coalesce(floor(epoch(next_event_timestamp)) - floor(epoch(event_timestamp)), 30)
      AS BIGINT) AS time_on_page_seconds FROM seq0)"""

WEB = """
sco AS (
  SELECT *,
    CASE WHEN coalesce(user_agent, '') = '' THEN 0.6::DOUBLE
      WHEN is_virtual_tour_page AND NOT has_space_context THEN 0.7::DOUBLE
      WHEN has_room_context AND has_coordinates THEN 1.0::DOUBLE ELSE 0.8::DOUBLE
      END AS data_quality_score,
    coalesce(regexp_matches(lower(user_agent), 'bot|crawler|spider|scraper'), false)
      OR time_on_page_seconds < 1 AS is_bot
  FROM seq),
web AS (SELECT * FROM sco WHERE NOT is_bot AND data_quality_score >= 0.5)"""

STG = """
stg AS (
  SELECT * REPLACE (
      starts_with(page_path, '/viewer') AS is_virtual_tour_page),
    CASE WHEN time_on_page_seconds < 10 THEN 'bounce' WHEN time_on_page_seconds < 30
      THEN 'moderate' ELSE 'engaged' END AS engagement_level
  FROM web WHERE event_date BETWEEN DATE '2024-01-01' AND DATE '2024-01-31')"""

BND = """
bnd0 AS (
  SELECT * EXCLUDE (next_event_timestamp),
    lag(event_timestamp) OVER s AS prev_event_timestamp,
    lead(event_timestamp) OVER s AS next_event_timestamp,
    row_number() OVER s AS session_event_rank,
    count(*) OVER (PARTITION BY session_id) AS total_session_events
  FROM stg WINDOW s AS (PARTITION BY session_id ORDER BY event_timestamp, event_id)),
bnd AS (
  SELECT *, prev_event_timestamp IS NULL AS is_session_start,
    next_event_timestamp IS NULL AS is_session_end,
    coalesce((epoch_us(next_event_timestamp) - epoch_us(event_timestamp)) / 1e6, 30.0)::DOUBLE
      AS seconds_to_next_event,
    if(session_event_sequence = 1, 'entry', if(next_event_timestamp IS NULL, 'exit',
      'progression')) AS journey_stage
  FROM bnd0)"""

FCT = f"""
fct0 AS (
  SELECT *,
    CASE WHEN space_type = 'unit' THEN if(room_name IS NULL, 'residential_unit',
        'unit_room_level')
      WHEN space_type = 'amenity' OR space_type = 'common_area' THEN 'shared_space'
      WHEN space_type = 'tour' THEN 'guided_experience'
      WHEN space_type = 'unknown' AND strpos(page_path, 'viewer') > 0 THEN 'unclassified_space'
      ELSE 'other' END AS space_category,
    CASE WHEN room_name IS NULL THEN 'no_room_context'
      WHEN regexp_matches(room_name, 'LIVING|FAMILY', 'i') THEN 'living_space'
      WHEN regexp_matches(room_name, 'BED', 'i') THEN 'bedroom'
      WHEN regexp_matches(room_name, 'KITCHEN', 'i') THEN 'kitchen'
      WHEN regexp_matches(room_name, 'BATH', 'i') THEN 'bathroom'
      WHEN regexp_matches(room_name, 'PATIO|BALCONY', 'i') THEN 'outdoor_space'
      WHEN regexp_matches(room_name, 'OFFICE|STUDY', 'i') THEN 'work_space'
      ELSE 'other_room' END AS room_category,
    if(community IS NULL, if(building IS NULL, 'no_location_hierarchy', 'building_level'),
      if(building IS NULL, 'community_level', 'full_location_context'))
      AS location_context_level,
    CASE WHEN pitch IS NOT NULL THEN 'active_3d_navigation'
      WHEN starts_with(event_name, 'Room View Position') THEN 'position_tracking'
      WHEN starts_with(event_name, 'Toggle') THEN 'interaction_event'
      ELSE 'standard_pageview' END AS navigation_type,
    CAST(CASE WHEN event_name IS NOT NULL AND has_coordinates AND room_name IS NOT NULL THEN 5
      WHEN event_name IS NOT NULL AND has_space_context THEN 4
      WHEN engagement_level = 'engaged' THEN if(has_space_context, 3, 2)
      WHEN has_coordinates THEN 2
      WHEN engagement_level = 'moderate' OR room_name IS NOT NULL THEN 1
      ELSE 0 END AS BIGINT) AS engagement_score,
    CASE WHEN NOT has_coordinates THEN 'no_3d_data'
      WHEN coalesce(abs(pitch), 0) > 45 OR abs(yaw) > 180 THEN 'high_exploration'
      WHEN coalesce(abs(pitch), 0) > 15 OR abs(yaw) > 90 THEN 'medium_exploration'
      ELSE 'low_exploration' END AS spatial_exploration_level,
    CASE WHEN is_session_start AND referrer <> '' AND strpos(referrer, page_url) = 0
        THEN 'external_referral_entry'
      WHEN is_session_start THEN if(coalesce(referrer, '') = '', 'direct_entry',
        'internal_referral_entry')
      WHEN is_virtual_tour_page AND has_space_context THEN if(session_event_sequence <= 3,
        'early_space_exploration', 'deep_space_exploration')
      WHEN journey_stage = 'exit' THEN if(total_session_events > 5, 'engaged_exit',
        'quick_exit')
      ELSE 'navigation' END AS journey_milestone,
    {ladder("total_session_events", ((20, "very_deep_exploration"), (10, "deep_exploration"),
            (5, "moderate_exploration"), (2, "light_exploration")), "single_page")}
      AS exploration_depth,
    CASE WHEN event_hour < 6 OR event_hour > 22 THEN 'off_hours' WHEN event_hour < 9
      THEN 'morning' WHEN event_hour < 18 THEN 'business_hours' ELSE 'evening' END
      AS time_period,
    CASE WHEN regexp_matches(timezone, 'America/(New_York|Toronto)') THEN 'Eastern_US'
      WHEN regexp_matches(timezone, 'America/(Chicago|Denver)') THEN 'Central_US'
      WHEN regexp_matches(timezone, 'America/(Los_Angeles|Vancouver)') THEN 'Western_US'
      WHEN regexp_matches(timezone, 'Europe') THEN 'Europe'
      WHEN regexp_matches(timezone, 'Asia|Pacific') THEN 'Asia_Pacific'
      ELSE 'Other' END AS detailed_region,
    session_event_sequence::DOUBLE / total_session_events AS session_progress_ratio,
    has_space_context AND space_type IN ('unit', 'tour') AS is_core_virtual_tour_event
  FROM bnd),
fct AS (
  SELECT * FROM fct0 WHERE data_quality_score >= 0.7 AND anonymous_id IS NOT NULL)"""

_STAGES = [
    ("src", SRC),
    ("enr", ENR),
    ("seq", SEQ),
    ("web", WEB),
    ("stg", STG),
    ("bnd", BND),
    ("fct", FCT),
]


def chain(upto: str, *more: str) -> str:
    """``WITH`` clause up to a stage, plus further named queries."""
    parts = []
    for name, text in _STAGES:
        parts.append(text)
        if name == upto:
            break
    return "WITH " + ",".join([*parts, *more]) + "\n"


def ts(column: str, alias: str | None = None) -> str:
    return f"strftime({column}, '%Y-%m-%d %H:%M:%S.%f') AS {alias or column.split('.')[-1]}"


def day(column: str, alias: str | None = None) -> str:
    return f"strftime({column}, '%Y-%m-%d') AS {alias or column.split('.')[-1]}"


def rnd(expr: str, alias: str) -> str:
    return f"round(CAST({expr} AS DOUBLE), 8) AS {alias}"


def big(expr: str, alias: str) -> str:
    return f"CAST({expr} AS BIGINT) AS {alias}"


def arr(expr: str, alias: str) -> str:
    return f"array_to_string(list_sort({expr}), ',') AS {alias}"

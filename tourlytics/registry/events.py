"""Events, classifiers, sequencing and session roll-ups."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import classify
from ..functions.keys import surrogate_key
from ..operators import session_metrics as sessions
from ..operators.filters import (
    clean_traffic,
    lookup_user,
    since_hours,
    spatially_relevant,
    staging_filter,
    valid_events,
)
from ..operators.sequencing import build_web_events, sequence_gaps, sequence_sessions, session_boundaries
from ..plans.events import fact_from_web_events
from . import data
from .catalog import query
from .oracle_base import AS_OF, arr, big, chain, day, rnd, ts
from .result import plain

SOURCE_COLS = [
    "event_id", "event_timestamp", "event_date", "event_hour", "event_type", "event_name",
    "anonymous_id", "user_id", "session_id", "app_id", "app_name", "page_url", "page_path",
    "page_title", "url_search", "space_id", "space_name", "space_type", "room_id", "room_name",
    "community", "building", "floorplan", "coordinates", "user_agent", "os_name", "locale",
    "timezone", "referrer", "screen_width", "screen_height", "processed_timestamp",
    "seconds_utc_ts", "kinesis_sequence_number", "kinesis_partition_key", "properties_json",
    "mongodb_id", "created_at", "updated_at",
]
TIMES = {"event_timestamp", "processed_timestamp", "created_at", "updated_at",
         "prev_event_timestamp", "next_event_timestamp"}
DOUBLES = {"data_quality_score", "seconds_to_next_event", "session_progress_ratio"}
WEB_COLS = [
    *SOURCE_COLS, "device_type", "is_virtual_tour_page", "has_space_context", "has_room_context",
    "has_coordinates", "region", "session_event_sequence", "is_first_event_in_session",
    "time_on_page_seconds", "data_quality_score", "is_bot",
]
FACT_ADDED = [
    "space_category", "room_category", "location_context_level", "navigation_type",
    "engagement_score", "spatial_exploration_level", "journey_milestone", "exploration_depth",
    "time_period", "detailed_region", "session_progress_ratio", "is_core_virtual_tour_event",
]
BOUNDARY_COLS = [
    "event_id", "session_id", "event_timestamp", "prev_event_timestamp", "next_event_timestamp",
    "is_session_start", "is_session_end", "seconds_to_next_event", "session_event_rank",
    "total_session_events", "journey_stage", "session_event_sequence",
]


def sql_cols(names: list[str]) -> str:
    """The select list that matches ``plain`` for event columns."""
    out = []
    for n in names:
        if n in TIMES:
            out.append(ts(n))
        elif n == "event_date":
            out.append(day(n))
        elif n == "coordinates":
            out += ["pitch", "yaw", "hfov"]
        elif n in DOUBLES:
            out.append(rnd(n, n))
        else:
            out.append(n)
    return ", ".join(out)


@query("event_model", chain("src") + f"SELECT {sql_cols(SOURCE_COLS)} FROM src")
def event_model(spark, folder):
    return plain(data.source(spark, folder).select(*SOURCE_COLS))


@query(
    "valid_events",
    chain("src")
    + """SELECT coalesce(anonymous_id, '-') AS anonymous_id, CAST(count(*) AS BIGINT) AS rows
FROM src WHERE session_id IS NOT NULL AND anonymous_id IS NOT NULL AND event_timestamp IS NOT NULL
GROUP BY ALL""",
)
def valid(spark, folder):
    kept = valid_events(data.source(spark, folder))
    who = F.coalesce("anonymous_id", F.lit("-")).alias("anonymous_id")
    return plain(kept.groupBy(who).agg(F.count(F.lit(1)).alias("rows")))


_SEQUENCED = (
    chain("seq")
    + f"""SELECT event_id, session_id, {ts("event_timestamp")}, session_event_sequence,
is_first_event_in_session, {ts("next_event_timestamp")}, time_on_page_seconds FROM seq"""
)


def _sequenced(spark, folder, slice_seconds):
    return plain(
        sequence_sessions(data.valid(spark, folder), slice_seconds).select(
            "event_id", "session_id", "event_timestamp", "session_event_sequence",
            "is_first_event_in_session", "next_event_timestamp", "time_on_page_seconds",
        )
    )


@query("sequenced_sessions", _SEQUENCED)
def sequenced(spark, folder):
    return _sequenced(spark, folder, 3600)


@query("sequenced_short_slices", _SEQUENCED)
def sequenced_short(spark, folder):
    """Slices of a minute: most sessions have several, so their carried values matter."""
    return _sequenced(spark, folder, 60)


@query("web_events", chain("web") + f"SELECT {sql_cols(WEB_COLS)} FROM web")
def web_events(spark, folder):
    return plain(data.web_events_plan(spark, folder).select(*WEB_COLS))


@query(
    "web_events_v1",
    chain(
        "seq",
        """enr1 AS (SELECT * FROM seq WHERE false UNION ALL BY NAME SELECT * FROM enr
             WHERE anonymous_id IS NOT NULL)""",
        """s1 AS (SELECT * EXCLUDE (session_event_sequence, next_event_timestamp,
             time_on_page_seconds, is_first_event_in_session),
             row_number() OVER w AS session_event_sequence, CAST(coalesce(floor(epoch(lead(
             event_timestamp) OVER w)) - floor(epoch(event_timestamp)), 30) AS BIGINT)
             AS time_on_page_seconds
           FROM enr1 WINDOW w AS (PARTITION BY session_id ORDER BY event_timestamp, event_id))""",
        """q1 AS (SELECT *, CASE WHEN length(coalesce(user_agent, '')) = 0 THEN 0.6::DOUBLE
             WHEN space_id IS NULL AND is_virtual_tour_page THEN 0.7::DOUBLE ELSE 1.0::DOUBLE END
             AS data_quality_score FROM s1)""",
    )
    + f"""SELECT event_id, session_id, session_event_sequence, time_on_page_seconds,
{rnd("data_quality_score", "data_quality_score")} FROM q1
WHERE time_on_page_seconds >= 1 AND data_quality_score >= 0.5
  AND NOT coalesce(regexp_matches(user_agent, 'bot|crawler|spider|scraper', 'i'), false)""",
)
def web_events_v1(spark, folder):
    valid1 = valid_events(data.source(spark, folder))
    return plain(
        build_web_events(valid1, quality="tiered_v1").select(
            "event_id", "session_id", "session_event_sequence", "time_on_page_seconds",
            "data_quality_score",
        )
    )


@query(
    "scored_events",
    chain("web")
    + f"""SELECT event_id, {rnd("data_quality_score", "tiered_v2")}, is_bot,
CAST(round(least(1, greatest(0, 1 - if(coalesce(user_agent, '') = '', 0.2, 0)
  - if(space_id IS NULL AND page_path LIKE '%/viewer%', 0.1, 0)
  + if(room_id IS NOT NULL AND room_name IS NOT NULL, 0.1, 0)
  + if(has_coordinates, 0.05, 0) + if(event_name IS NOT NULL, 0.05, 0))), 2) AS DOUBLE) AS additive,
coalesce(user_agent, '') = '' OR regexp_matches(lower(user_agent), 'bot|crawler|spider|scraper')
  AS is_bot_documented
FROM sco""",
)
def scored_events(spark, folder):
    return plain(
        data.scored(spark, folder).select(
            "event_id",
            F.col("data_quality_score").alias("tiered_v2"),
            "is_bot",
            classify.additive_quality_batch().alias("additive"),
            classify.is_bot_documented(F.col("user_agent")).alias("is_bot_documented"),
        )
    )


@query(
    "edge_classifiers",
    chain("src")
    + """SELECT event_id,
CASE WHEN coalesce(screen_width, 0) = 0 THEN 'unknown' WHEN screen_width < 768 THEN 'mobile'
  WHEN screen_width < 1024 THEN 'tablet' ELSE 'desktop' END AS device_type,
CAST(round(least(1, greatest(0, 1 - if(session_id IS NULL, 0.3, 0)
  - if(coalesce(anonymous_id, user_id) IS NULL, 0.3, 0) - if(coalesce(user_agent, '') = '', 0.2, 0)
  - if(space_id IS NULL AND page_path LIKE '/viewer%', 0.1, 0)
  + if(room_id IS NOT NULL AND room_name IS NOT NULL, 0.1, 0) + if(has_coordinates, 0.05, 0))), 2)
  AS DOUBLE) AS data_quality_score,
coalesce(user_agent, '') = '' OR regexp_matches(lower(user_agent),
  'bot|crawler|spider|scraper|automated') AS is_bot,
page_path LIKE '/viewer%' AS is_virtual_tour_page
FROM src""",
)
def edge_classifiers(spark, folder):
    return plain(
        data.source(spark, folder).select(
            "event_id",
            classify.device_type_edge(F.col("screen_width").cast("string")).alias("device_type"),
            classify.additive_quality_edge().alias("data_quality_score"),
            classify.is_bot_edge(F.col("user_agent")).alias("is_bot"),
            classify.viewer_page_prefix(F.col("page_path")).alias("is_virtual_tour_page"),
        )
    )


STAGED = [*WEB_COLS, "engagement_level", "event_key"]


@query(
    "staged_events",
    chain("stg")
    + f"""SELECT {sql_cols(WEB_COLS)}, engagement_level,
md5(session_id || '-' || coalesce(anonymous_id, '_dbt_utils_surrogate_key_null_') || '-'
  || epoch_us(event_timestamp)) AS event_key FROM stg""",
)
def staged_events(spark, folder):
    return plain(data.staged(spark, folder).select(*STAGED))


@query(
    "staging_filter_window",
    chain("web")
    + f"""SELECT {day("event_date")}, CAST(count(*) AS BIGINT) AS rows FROM sco
WHERE event_date BETWEEN DATE '2024-01-10' AND DATE '2024-01-20' AND data_quality_score >= 0.75
GROUP BY event_date""",
)
def staging_window(spark, folder):
    kept = staging_filter(
        data.scored(spark, folder), "2024-01-10", "2024-01-20 00:00:00", False, 0.75
    )
    return plain(kept.groupBy("event_date").agg(F.count(F.lit(1)).alias("rows")))


@query("session_boundaries", chain("bnd") + f"SELECT {sql_cols(BOUNDARY_COLS)} FROM bnd")
def boundaries(spark, folder):
    return plain(session_boundaries(data.staged(spark, folder)).select(*BOUNDARY_COLS))


@query("session_boundaries_short_slices", chain("bnd") + f"SELECT {sql_cols(BOUNDARY_COLS)} FROM bnd")
def boundaries_short(spark, folder):
    return plain(session_boundaries(data.staged(spark, folder), 60).select(*BOUNDARY_COLS))


FACT_COLS = [*WEB_COLS, "engagement_level", *BOUNDARY_COLS[3:-1], *FACT_ADDED]


@query("fact_events", chain("fct") + f"SELECT {sql_cols(FACT_COLS)} FROM fct")
def fact_events(spark, folder):
    built = fact_from_web_events(data.web_events(spark, folder), start=data.START, as_of=data.AS_OF)
    return plain(built.select(*FACT_COLS))


@query(
    "documented_journey_stage",
    chain("fct")
    + """SELECT event_id, CASE WHEN session_event_sequence = 1 THEN 'entry'
WHEN session_event_sequence < 4 AND has_space_context THEN 'exploration'
WHEN engagement_score > 2 AND time_on_page_seconds > 30 THEN 'engagement'
WHEN event_type = 'track' AND strpos(event_name, 'Conversion') > 0 THEN 'conversion'
WHEN session_event_sequence = total_session_events THEN 'exit' ELSE 'navigation' END AS stage
FROM fct""",
)
def documented_stage(spark, folder):
    return data.fact(spark, folder).select(
        "event_id", classify.journey_stage_documented().alias("stage")
    )


@query(
    "spatial_filter",
    chain("fct")
    + """SELECT space_type, CAST(count(*) AS BIGINT) AS rows FROM fct
WHERE has_coordinates OR room_name IS NOT NULL OR community IS NOT NULL GROUP BY space_type""",
)
def spatial_filter(spark, folder):
    kept = spatially_relevant(data.fact(spark, folder))
    return kept.groupBy("space_type").agg(F.count(F.lit(1)).alias("rows"))


@query(
    "recent_clean_events",
    chain("fct")
    + f"""SELECT event_id, {ts("event_timestamp")} FROM fct
WHERE event_timestamp >= TIMESTAMP '{AS_OF}' - INTERVAL 36 HOUR AND data_quality_score >= 0.8""",
)
def recent_clean(spark, folder):
    kept = clean_traffic(since_hours(data.fact(spark, folder), AS_OF, 36, "event_timestamp"), 0.8)
    return plain(kept.select("event_id", "event_timestamp"))


@query(
    "user_lookup",
    chain("web")
    + f"""SELECT event_id, {ts("event_timestamp")}, page_path FROM web WHERE anonymous_id = 'u3'
ORDER BY web.event_timestamp, event_id LIMIT 20""",
)
def user_lookup(spark, folder):
    found = lookup_user(data.web_events(spark, folder), "u3", 20)
    return plain(found.select("event_id", "event_timestamp", "page_path"))


@query(
    "sequence_gaps",
    chain("fct")
    + """SELECT event_id, prev_sequence, session_event_sequence - prev_sequence AS gap FROM (
SELECT event_id, session_event_sequence, lag(session_event_sequence) OVER (
  PARTITION BY session_id ORDER BY session_event_sequence) AS prev_sequence FROM fct)""",
)
def gaps(spark, folder):
    # Short slices, so that the carry between slices is used on this data too.
    table = data.fact(spark, folder).select("event_id", "session_id", "session_event_sequence")
    return plain(sequence_gaps(table, 4).select("event_id", "prev_sequence", "gap"))




def _first(*names: str) -> str:
    # first() keeps the NULL of the first event.
    return ", ".join(
        f"first({n} ORDER BY event_timestamp, event_id) AS {n}" for n in names
    )


_SPAN = (
    f"{ts('min(event_timestamp)', 'session_start')}, {ts('max(event_timestamp)', 'session_end')}, "
    "count(*) AS total_events, CAST(floor(epoch(max(event_timestamp))) - "
    "floor(epoch(min(event_timestamp))) AS BIGINT) AS session_duration_seconds, "
    "count(*) = 1 AS bounce_session"
)


@query(
    "session_metrics_v1",
    chain("web")
    + f"""SELECT session_id, anonymous_id, {day("event_date")}, {_SPAN},
count(DISTINCT space_id) AS unique_spaces_viewed,
{big("sum(time_on_page_seconds)", "total_time_on_site_seconds")},
coalesce(array_to_string([x.key || ':' || x.value FOR x IN map_entries(histogram(space_type)
  FILTER (WHERE space_type IS NOT NULL))], ','), '') AS space_type_counts,
{_first("referrer", "user_agent", "timezone", "device_type", "region")}
FROM web GROUP BY session_id, anonymous_id, event_date""",
)
def metrics_v1(spark, folder):
    rows = sessions.session_metrics_v1(data.web_events(spark, folder))
    counts = F.transform("space_type_counts", lambda c: F.concat_ws(":", c["space_type"], c["events"].cast("string")))
    return plain(rows.withColumn("space_type_counts", F.array_join(counts, ",")))


@query(
    "space_types_listed",
    chain("web")
    + f"""SELECT session_id, anonymous_id, {day("event_date")}, space_type, part,
{arr("list(space_type)", "space_types_viewed")} FROM (SELECT *, (row_number() OVER (
  PARTITION BY session_id, anonymous_id, event_date, space_type) - 1) // 3 AS part FROM web)
WHERE space_type IS NOT NULL GROUP BY session_id, anonymous_id, event_date, space_type, part""",
)
def types_listed(spark, folder):
    """The list in rows of three."""
    return plain(sessions.space_types_listed(sessions.session_metrics_v1(data.web_events(spark, folder)), 3))


@query(
    "session_metrics_v2",
    chain("web")
    + f"""SELECT session_id, anonymous_id, user_id, {day("event_date")}, {_SPAN},
count(DISTINCT space_id) AS unique_spaces_viewed, count(DISTINCT room_id) AS unique_rooms_viewed,
{big("sum(time_on_page_seconds)", "total_time_on_site_seconds")},
count(*) FILTER (WHERE has_coordinates) AS events_with_3d_navigation,
{arr("list(DISTINCT space_type)", "space_types_viewed")},
coalesce(array_to_string(list_sort(list(DISTINCT room_name)), ','), '') AS rooms_visited,
{_first("referrer", "user_agent", "timezone", "device_type", "region", "community")},
{rnd("avg(data_quality_score)", "avg_data_quality_score")},
bool_or(has_coordinates) AS has_3d_engagement
FROM web GROUP BY session_id, anonymous_id, user_id, event_date""",
)
def metrics_v2(spark, folder):
    return plain(sessions.session_metrics_v2(data.web_events(spark, folder)))


@query(
    "session_metrics_v3",
    chain("fct")
    + f"""SELECT session_id, anonymous_id, user_id, {day("event_date")}, {_SPAN},
count(DISTINCT space_id) AS unique_spaces_viewed,
{big("sum(time_on_page_seconds)", "total_time_on_site_seconds")},
{arr("list(DISTINCT space_type)", "space_types_viewed")},
coalesce(array_to_string(list_sort(list(DISTINCT room_name)), ','), '') AS rooms_viewed,
count(*) FILTER (WHERE is_virtual_tour_page) AS virtual_tour_events,
count(*) FILTER (WHERE has_space_context AND space_type IN ('tour', 'unit')) AS core_tour_events,
count(*) FILTER (WHERE has_coordinates) AS three_d_navigation_events,
coalesce(array_to_string(list_sort(list(DISTINCT community)), ','), '') AS communities_visited,
coalesce(array_to_string(list_sort(list(DISTINCT building)), ','), '') AS buildings_visited,
{_first("referrer", "user_agent", "timezone", "device_type", "region")},
{ts("max(processed_timestamp)", "processed_timestamp")}
FROM fct GROUP BY session_id, anonymous_id, user_id, event_date""",
)
def metrics_v3(spark, folder):
    return plain(sessions.session_metrics_v3(data.fact(spark, folder)))


@query(
    "session_diversity",
    chain("web")
    + f"""SELECT session_id, anonymous_id, {ts("min(event_timestamp)", "session_start")},
{ts("max(event_timestamp)", "session_end")}, count(*) AS total_events,
count(DISTINCT space_type) AS unique_space_types,
{big("sum(time_on_page_seconds)", "total_time_seconds")},
{arr("list(DISTINCT space_type)", "space_types_viewed")}
FROM web GROUP BY session_id, anonymous_id""",
)
def diversity(spark, folder):
    return plain(sessions.session_diversity(data.web_events(spark, folder)))


@query(
    "event_keys",
    chain("src")
    + """SELECT event_id, md5(coalesce(session_id, '_dbt_utils_surrogate_key_null_') || '-'
|| coalesce(anonymous_id, '_dbt_utils_surrogate_key_null_') || '-' || epoch_us(event_timestamp))
  AS surrogate_key,
coalesce(session_id, 'unknown') || '_' || seconds_utc_ts || '_' || kinesis_sequence_number AS stream_id,
coalesce(session_id, anonymous_id, 'unknown') || '_' || kinesis_sequence_number || '_'
  || seconds_utc_ts AS edge_id FROM src""",
)
def event_keys(spark, folder):
    from ..functions.keys import edge_event_id, stream_event_id

    session, millis = F.col("session_id"), F.col("seconds_utc_ts")
    sequence = F.col("kinesis_sequence_number")
    return data.source(spark, folder).select(
        "event_id",
        surrogate_key("session_id", "anonymous_id", "event_timestamp").alias("surrogate_key"),
        stream_event_id(session, millis, sequence).alias("stream_id"),
        edge_event_id(session, F.col("anonymous_id"), millis, sequence).alias("edge_id"),
    )

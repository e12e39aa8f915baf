"""Monitoring, reporting and documented roll-ups."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import monitor
from ..operators.session_metrics import session_metrics_v2
from ..sources.tables import partition_files
from . import data
from .catalog import query
from .oracle_base import AS_OF, big, chain, day, rnd, ts
from .result import plain

_CORE = "count(*) FILTER (WHERE is_core_virtual_tour_event)"


@query(
    "realtime_metrics",
    chain("fct")
    + f"""SELECT {ts("date_trunc('hour', event_timestamp)", "hour_bucket")}, space_type, device_type,
count(*) AS events_count, count(DISTINCT session_id) AS unique_sessions,
count(DISTINCT anonymous_id) AS unique_users, {rnd("avg(engagement_score)", "avg_engagement")},
{_CORE} AS core_tour_events, {rnd("avg(time_on_page_seconds)", "avg_time_on_page")}
FROM fct WHERE event_timestamp >= TIMESTAMP '2024-01-30 00:00:00' GROUP BY ALL""",
)
def realtime(spark, folder):
    return plain(monitor.realtime_metrics(data.fact(spark, folder), AS_OF))


@query(
    "data_quality_monitor",
    chain("web")
    + f"""SELECT {day("event_date")}, space_type, count(*) AS total_events,
count(*) - count(session_id) AS missing_session_id,
count(*) - count(anonymous_id) AS missing_anonymous_id,
count(*) - count(user_agent) AS missing_user_agent, count(*) FILTER (WHERE is_bot) AS bot_events,
{rnd("avg(data_quality_score)", "avg_quality_score")},
{rnd("min(data_quality_score)", "min_quality_score")},
{ts("max(processed_timestamp)", "latest_processed")},
count(*) FILTER (WHERE data_quality_score < 0.5) AS low_quality_events,
count(*) FILTER (WHERE data_quality_score >= 0.9) AS high_quality_events
FROM sco WHERE event_date >= DATE '2024-01-24' GROUP BY event_date, space_type""",
)
def quality_monitor(spark, folder):
    return plain(monitor.data_quality_monitor(data.scored(spark, folder), AS_OF))


@query(
    "table_validation",
    chain(
        "web",
        """ses AS (SELECT session_id, event_date FROM web
             GROUP BY session_id, anonymous_id, user_id, event_date)""",
    )
    + f"""SELECT 'web_events' AS table_name, count(*) AS record_count,
count(DISTINCT session_id) AS unique_sessions, {day("min(event_date)", "earliest_date")},
{day("max(event_date)", "latest_date")}, {rnd("avg(data_quality_score)", "avg_quality")} FROM web
UNION ALL SELECT 'session_metrics', count(*), count(DISTINCT session_id),
strftime(min(event_date), '%Y-%m-%d'), strftime(max(event_date), '%Y-%m-%d'), 1.0 FROM ses""",
)
def validation(spark, folder):
    events = data.web_events(spark, folder)
    return plain(monitor.validate_tables(events, session_metrics_v2(events)))


@query(
    "recent_activity",
    chain("web")
    + f"""SELECT 'real_time_check' AS check_type, count(*) AS events_last_hour,
count(DISTINCT session_id) AS sessions_last_hour,
{rnd("avg(data_quality_score)", "avg_quality_score")},
{ts("max(processed_timestamp)", "latest_processed")}
FROM web WHERE processed_timestamp >= TIMESTAMP '{AS_OF}' - INTERVAL 1 HOUR""",
)
def activity(spark, folder):
    return plain(monitor.recent_activity(data.web_events(spark, folder), AS_OF))


@query(
    "table_health",
    chain("web")
    + f"""SELECT 'web_events' AS table_name, record_count, date_partitions, space_partitions,
{ts("latest_update")}, {rnd("avg_quality", "avg_quality")}, bot_events,
'2024-01-31 00:00:00.000000' AS check_timestamp,
CASE WHEN latest_update < TIMESTAMP '{AS_OF}' - INTERVAL 30 MINUTE THEN 'STALE'
  WHEN avg_quality < 0.8 THEN 'QUALITY_ISSUE' WHEN record_count = 0 THEN 'NO_DATA'
  ELSE 'HEALTHY' END AS health_status
FROM (SELECT count(*) AS record_count, count(DISTINCT event_date) AS date_partitions,
  count(DISTINCT space_type) AS space_partitions, max(processed_timestamp) AS latest_update,
  avg(data_quality_score) AS avg_quality, count(*) FILTER (WHERE is_bot) AS bot_events
  FROM sco WHERE processed_timestamp >= TIMESTAMP '{AS_OF}' - INTERVAL 2 HOUR)""",
)
def health(spark, folder):
    return plain(monitor.table_health(data.scored(spark, folder), AS_OF))


@query(
    "quality_trend",
    chain("web")
    + f"""SELECT {day("event_date")}, {rnd("avg(data_quality_score)", "avg_quality")},
{rnd("100 * avg(is_bot::INT)", "bot_percentage")}, count(*) AS total_events
FROM sco WHERE event_date >= DATE '2024-01-24' GROUP BY event_date""",
)
def trend(spark, folder):
    return plain(monitor.quality_trend(data.scored(spark, folder), AS_OF))


_TOTALS = f"""count(*) AS total_events, count(DISTINCT session_id) AS unique_sessions,
count(DISTINCT anonymous_id) AS unique_users, {rnd("avg(data_quality_score)", "avg_quality")}"""


@query("daily_totals", chain("web") + f"SELECT {_TOTALS} FROM web WHERE event_date = DATE '2024-01-15'")
def totals(spark, folder):
    return plain(monitor.daily_totals(data.web_events(spark, folder), "2024-01-15"))


@query(
    "rows_by_date",
    chain("web") + f"SELECT {day('event_date')}, count(*) AS rows FROM web GROUP BY event_date",
)
def by_date(spark, folder):
    return plain(monitor.rows_by_date(data.web_events(spark, folder)))


def _pattern(name: str, where: str, condition) -> None:
    sql = (
        chain("fct")
        + f"""SELECT count(*) AS matching_events, count(DISTINCT anonymous_id) AS unique_users,
{rnd("avg(engagement_score)", "avg_engagement")} FROM fct WHERE {where}"""
    )

    @query(f"filter_aggregate_{name}", sql)
    def run(spark, folder):
        return plain(monitor.filtered_engagement(data.fact(spark, folder), condition()))


_pattern(
    "date",
    "event_date = DATE '2024-01-12'",
    lambda: F.col("event_date") == F.lit("2024-01-12").cast("date"),
)
_pattern("space_type", "space_type = 'unit'", lambda: F.col("space_type") == "unit")
_pattern("quality", "data_quality_score >= 0.9", lambda: F.col("data_quality_score") >= 0.9)
_pattern(
    "combined",
    "event_date >= DATE '2024-01-20' AND space_type = 'tour' AND data_quality_score >= 0.8",
    lambda: (F.col("event_date") >= F.lit("2024-01-20").cast("date"))
    & (F.col("space_type") == "tour")
    & (F.col("data_quality_score") >= 0.8),
)


@query(
    "engagement_by_space_type",
    chain("fct") + f"SELECT space_type, {rnd('avg(engagement_score)', 'avg_engagement')} FROM fct GROUP BY 1",
)
def by_space(spark, folder):
    return plain(monitor.engagement_by_space_type(data.fact(spark, folder)))


@query(
    "partition_statistics",
    chain("fct")
    + f"""SELECT {day("event_date")}, space_type, count(*) AS record_count,
{ts("min(event_timestamp)", "min_timestamp")}, {ts("max(event_timestamp)", "max_timestamp")},
{rnd("avg(engagement_score)", "avg_engagement")} FROM fct GROUP BY event_date, space_type""",
)
def partitions(spark, folder):
    return plain(monitor.partition_statistics(data.fact(spark, folder)))


@query(
    "completeness",
    chain("web")
    + f"""SELECT count(*) AS total_rows, count(event_id) AS known_keys,
count(DISTINCT event_id) AS distinct_keys, {ts("max(processed_timestamp)", "latest_processed")},
{rnd("100.0 * count(event_id) / count(*)", "completeness_pct")},
{rnd("100.0 * count(DISTINCT event_id) / count(*)", "uniqueness_pct")},
{big(f"epoch(TIMESTAMP '{AS_OF}') - floor(epoch(max(processed_timestamp)))", "lag_seconds")}
FROM web""",
)
def complete(spark, folder):
    return plain(monitor.completeness(data.web_events(spark, folder), AS_OF))


@query(
    "hourly_metrics",
    chain("web")
    + f"""SELECT {ts("date_trunc('hour', event_timestamp)", "hour_bucket")},
count(*) AS events_processed, count(DISTINCT session_id) AS unique_sessions,
{rnd("avg(data_quality_score)", "avg_quality_score")} FROM web GROUP BY 1""",
)
def hourly(spark, folder):
    return plain(monitor.hourly_metrics(data.web_events(spark, folder)))


@query(
    "table_footprint",
    chain("web")
    + f"""SELECT count(*) AS row_count, {ts("max(processed_timestamp)", "latest_processed")},
{big(f"epoch(TIMESTAMP '{AS_OF}') - floor(epoch(max(processed_timestamp)))", "lag_seconds")},
true AS size_ok, true AS files_ok, true AS lag_ok, true AS as_listed FROM web""",
)
def footprint(spark, folder):
    """Bytes and files depend on the writer, so they are compared with the listing of the table."""
    found = monitor.table_footprint(data.web_events(spark, folder), AS_OF)
    listed = partition_files(spark, data.web_events_path(spark, folder)).agg(F.sum("bytes").alias("b"), F.sum("files").alias("f")).first()
    same = (F.col("total_bytes") == listed["b"]) & (F.col("file_count") == listed["f"])
    return plain(found.withColumn("as_listed", same).drop("total_bytes", "file_count"))


_SPACE = f"""space_name, space_type, count(DISTINCT session_id) AS unique_sessions,
avg(time_on_page_seconds) AS avg_time, count(*) AS views"""


@query(
    "top_spaces",
    chain("fct", f"spc AS (SELECT event_date, {_SPACE} FROM fct WHERE space_name IS NOT NULL GROUP BY ALL)")
    + f"""SELECT {day("event_date", "analysis_date")}, space_name, space_type, unique_sessions,
{rnd("avg_time", "avg_time_on_space")}, views,
{rnd("views::DOUBLE / unique_sessions", "views_per_session")} FROM spc
WHERE event_date = DATE '2024-01-15' ORDER BY avg_time DESC, space_name, space_type LIMIT 10""",
)
def spaces(spark, folder):
    return plain(monitor.top_spaces(data.fact(spark, folder), "2024-01-15"))


@query(
    "space_engagement",
    chain("fct", f"spc AS (SELECT event_date, {_SPACE} FROM fct WHERE space_name IS NOT NULL GROUP BY ALL)")
    + f"""SELECT {day("event_date", "analysis_date")}, space_name, space_type, unique_sessions,
{rnd("avg_time", "avg_time_on_space")}, views,
{rnd("views::DOUBLE / unique_sessions", "views_per_session")} FROM spc""",
)
def space_rows(spark, folder):
    return plain(monitor.space_engagement(data.fact(spark, folder)))


@query("daily_summary", chain("web") + f"SELECT {day('event_date')}, {_TOTALS} FROM web GROUP BY event_date")
def summary(spark, folder):
    return plain(monitor.daily_summary(data.web_events(spark, folder)))


@query(
    "weekly_summary",
    chain("web")
    + f"""SELECT {day("date_trunc('week', event_date)", "week_start")}, {_TOTALS},
count(DISTINCT event_date) AS days_with_data FROM web GROUP BY date_trunc('week', event_date)""",
)
def weekly(spark, folder):
    return plain(monitor.weekly_summary(data.web_events(spark, folder)))


@query(
    "rolling_event_statistics",
    chain(
        "web",
        "dy AS (SELECT event_date, count(*) AS n FROM web GROUP BY event_date)",
        """rl AS (SELECT *, avg(n) OVER w AS mean, coalesce(stddev_samp(n) OVER w, 0) AS dev,
             lag(n) OVER (ORDER BY event_date) AS was FROM dy
           WINDOW w AS (ORDER BY event_date ROWS BETWEEN 6 PRECEDING AND CURRENT ROW))""",
    )
    + f"""SELECT {day("event_date", "analysis_date")}, n AS total_events,
{rnd("mean", "rolling_avg_events")}, {rnd("dev", "rolling_stddev_events")},
{rnd("(n - was)::DOUBLE / was", "period_over_period_change")}, abs(n - mean) > 2 * dev AS is_anomaly
FROM rl""",
)
def rolling(spark, folder):
    return plain(monitor.rolling_event_statistics(data.web_events(spark, folder)))


@query(
    "cohort_retention",
    chain(
        "web",
        """uw AS (SELECT DISTINCT anonymous_id, date_trunc('week', event_date) AS wk FROM web
             WHERE anonymous_id IS NOT NULL)""",
        "ch AS (SELECT anonymous_id, min(wk) AS c FROM uw GROUP BY 1)",
        "sz AS (SELECT c, count(*) AS size FROM ch GROUP BY c)",
    )
    + f"""SELECT {day("c", "cohort_week")}, CAST((wk - c) // 7 AS BIGINT) AS weeks_since_first_visit,
count(*) AS active_users, any_value(size) AS cohort_size,
{rnd("count(*)::DOUBLE / any_value(size)", "retention_rate")}
FROM uw JOIN ch USING (anonymous_id) JOIN sz USING (c) GROUP BY c, wk""".replace(
        "(wk - c) // 7", "date_diff('day', c, wk) // 7"
    ),
)
def cohorts(spark, folder):
    return plain(monitor.cohort_retention(data.web_events(spark, folder)))

"""Snapshot comparison."""

from __future__ import annotations

from ..plans import snapshots
from ..schemas import SNAPSHOT_ANALYSIS
from ..sources.tables import as_of_time
from . import data
from .catalog import query
from .oracle_base import AS_OF, THEN, big, chain, day, rnd, ts
from .result import plain

TRENDS = ["2024-01-05 00:00:00", "2024-01-12 12:00:00", "2024-01-20 00:00:00", "2024-02-05 00:00:00"]


def metrics(name: str, cut: str) -> str:
    return f"""
{name} AS (
  SELECT event_date, space_type, count(*) AS events, count(DISTINCT session_id) AS sessions,
    count(DISTINCT anonymous_id) AS users, avg(engagement_score) AS engagement,
    avg(time_on_page_seconds) AS time_on_page,
    count(*) FILTER (WHERE is_core_virtual_tour_event) AS core_events,
    avg(data_quality_score) AS quality
  FROM fct WHERE event_date >= DATE '2024-01-24' AND {cut} GROUP BY event_date, space_type)"""


NOW = metrics("nowm", "true")
PAST = metrics("pastm", f"processed_timestamp <= TIMESTAMP '{THEN}'")
_STEMS = ["events", "sessions", "users", "engagement", "time_on_page", "core_events", "quality"]

COMPARE = (
    """
cmp0 AS (
  SELECT n.event_date, n.space_type, """
    + ", ".join(
        f"n.{s} AS current_{s}, coalesce(p.{s}, 0) AS historical_{s}, "
        f"n.{s} - coalesce(p.{s}, 0) AS {s}_change"
        for s in _STEMS
    )
    + ", "
    + ", ".join(
        f"if(p.{s} > 0, 100.0::DOUBLE * (n.{s} - p.{s}) / p.{s}, NULL) AS {s}_change_pct"
        for s in ("events", "sessions", "engagement")
    )
    + """
  FROM nowm n LEFT JOIN pastm p USING (event_date, space_type)),
cmp AS (
  SELECT *,
    CASE WHEN abs(events_change_pct) > 50 THEN 'high_variance'
      WHEN abs(events_change_pct) > 25 THEN 'medium_variance' ELSE 'normal_variance' END
      AS events_variance_flag,
    CASE WHEN abs(engagement_change_pct) > 30 THEN 'high_variance'
      WHEN abs(engagement_change_pct) > 15 THEN 'medium_variance' ELSE 'normal_variance' END
      AS engagement_variance_flag,
    if(quality_change < -0.1, 'quality_degradation', if(quality_change > 0.1,
      'quality_improvement', 'quality_stable')) AS quality_trend,
    CASE WHEN events_change < 0 THEN 'data_decreasing'
      WHEN events_change > 0 AND sessions_change > 0 THEN 'data_growing'
      WHEN events_change = 0 AND sessions_change = 0 THEN 'data_stale' ELSE 'data_stable' END
      AS data_freshness_status
  FROM cmp0)"""
)

_SUM = {"events", "sessions", "users", "core_events"}
SUMMARY = (
    """
smm AS (
  SELECT event_date, 'all_spaces' AS space_type, """
    + ", ".join(
        f"{'sum' if s in _SUM else 'avg'}({c}) AS {c}"
        for s in _STEMS
        for c in (f"current_{s}", f"historical_{s}", f"{s}_change")
    )
    + """,
    if(sum(cmp.historical_events) > 0, 100.0::DOUBLE * sum(cmp.events_change)
      / sum(cmp.historical_events), NULL) AS events_change_pct,
    if(sum(cmp.historical_sessions) > 0, 100.0::DOUBLE * sum(cmp.sessions_change)
      / sum(cmp.historical_sessions), NULL) AS sessions_change_pct,
    NULL::DOUBLE AS engagement_change_pct, 'summary' AS events_variance_flag,
    'summary' AS engagement_variance_flag, 'summary' AS quality_trend,
    'summary' AS data_freshness_status
  FROM cmp GROUP BY event_date)"""
)


def _cols() -> str:
    out = []
    for field in SNAPSHOT_ANALYSIS.fields:
        kind, name = field.dataType.simpleString(), field.name
        out.append({"date": day, "double": lambda n: rnd(n, n), "bigint": lambda n: big(n, n)}.get(
            kind, str)(name))
    return ", ".join(out)


_METRIC_COLS = f"""{day("event_date")}, space_type, events AS total_events,
sessions AS unique_sessions, users AS unique_users, {rnd("engagement", "avg_engagement_score")},
{rnd("time_on_page", "avg_time_on_page")}, core_events AS core_tour_events,
{rnd("quality", "avg_data_quality")}"""


@query("snapshot_metrics", chain("fct", NOW) + f"SELECT {_METRIC_COLS} FROM nowm")
def current(spark, folder):
    return plain(snapshots.snapshot_metrics(data.fact(spark, folder), AS_OF))


@query("snapshot_metrics_as_of", chain("fct", PAST) + f"SELECT {_METRIC_COLS} FROM pastm")
def historical(spark, folder):
    past = as_of_time(data.fact(spark, folder), THEN)
    return plain(snapshots.snapshot_metrics(past, AS_OF))


def _compared(spark, folder):
    fact = data.fact(spark, folder)
    return snapshots.snapshot_compare(
        snapshots.snapshot_metrics(fact, AS_OF),
        snapshots.snapshot_metrics(as_of_time(fact, THEN), AS_OF),
    )


@query("snapshot_compare", chain("fct", NOW, PAST, COMPARE) + f"SELECT {_cols()} FROM cmp")
def compare(spark, folder):
    return plain(_compared(spark, folder))


@query("snapshot_summary", chain("fct", NOW, PAST, COMPARE, SUMMARY) + f"SELECT {_cols()} FROM smm")
def summary(spark, folder):
    return plain(snapshots.snapshot_summary(_compared(spark, folder)))


@query(
    "time_travel_analysis",
    chain("fct", NOW, PAST, COMPARE, SUMMARY)
    + f"SELECT {_cols()} FROM (SELECT * FROM cmp UNION ALL BY NAME SELECT * FROM smm)",
)
def analysis(spark, folder):
    return plain(snapshots.time_travel_analysis(data.fact(spark, folder), AS_OF, THEN))


@query(
    "snapshot_growth",
    chain("web")
    + f"""SELECT n AS current_events, h AS historical_events, n - h AS events_added,
{rnd("if(h > 0, 100.0 * (n - h) / h, NULL)", "growth_percentage")} FROM (
SELECT count(*) AS n, count(*) FILTER (WHERE processed_timestamp <= TIMESTAMP '{THEN}') AS h
FROM web WHERE event_date = DATE '2024-01-29')""",
)
def growth(spark, folder):
    return plain(snapshots.snapshot_growth(data.web_events(spark, folder), "2024-01-29", THEN))


@query(
    "snapshot_space_counts",
    chain("fct")
    + f"""SELECT space_type, count(*) AS events_count,
{rnd("avg(engagement_score)", "avg_engagement_score")} FROM fct
WHERE processed_timestamp <= TIMESTAMP '2024-01-15 00:00:00' GROUP BY space_type""",
)
def space_counts(spark, folder):
    return plain(snapshots.snapshot_space_counts(data.fact(spark, folder), "2024-01-15 00:00:00"))


_TIMES = " UNION ALL ".join(f"SELECT TIMESTAMP '{t}' AS moment" for t in TRENDS)


@query(
    "snapshot_trend",
    chain("web", f"moments AS ({_TIMES})")
    + f"""SELECT {ts("moment", "snapshot_timestamp")}, count(*) AS records_at_snapshot,
{rnd("avg(data_quality_score)", "quality_score_trend")}
FROM moments JOIN web ON processed_timestamp <= moment GROUP BY moment""",
)
def trend(spark, folder):
    return plain(snapshots.snapshot_trend(data.web_events(spark, folder), TRENDS))

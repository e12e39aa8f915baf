"""Data-quality checks."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import checks
from ..operators.monitor import completeness
from ..operators.sequencing import session_boundaries
from ..plans import journey
from . import data
from .catalog import query
from .journeys import CLASSED, DAILY, SEGMENTS, kpis
from .oracle_base import AS_OF, THEN, big, chain, rnd
from .result import plain


def verdict(name: str, value: str, warn=None, error=0, below: bool = False) -> str:
    """Select list of one check; ``value`` is a column of the FROM clause."""
    op = "<" if below else ">"
    arms = f"WHEN {value} IS NULL THEN 'error' "
    if error is not None:
        arms += f"WHEN {value} {op} {error} THEN 'error' "
    if warn is not None:
        arms += f"WHEN {value} {op} {warn} THEN 'warn' "

    def limit(x):
        return "NULL::DOUBLE" if x is None else f"{float(x)}::DOUBLE"

    return f"""SELECT '{name}' AS check_name, {rnd(value, "observed")}, {limit(warn)} AS warn_limit,
{limit(error)} AS error_limit, CASE {arms}ELSE 'pass' END AS status """


def check(name: str, label: str, source: str, build, warn=None, error=0, below=False) -> None:
    """Registers a check whose SQL measures column ``o``."""
    sql = source.replace("@@", verdict(label, "o", warn, error, below))

    @query(f"check_{name}", sql)
    def run(spark, folder):
        return plain(build(spark, folder))


def fct(body: str) -> str:
    return chain("fct") + f"@@ FROM ({body})"


def web(body: str) -> str:
    return chain("web") + f"@@ FROM ({body})"


_LATEST_DAY = "event_date >= DATE '2024-01-30'"
_WEEK = "event_date >= DATE '2024-01-24'"

check(
    "unique_event_id",
    "unique(event_id)",
    fct("SELECT count(*) - count(DISTINCT event_id) AS o FROM fct"),
    lambda s, d: checks.check_unique(data.fact(s, d), "event_id"),
)
check(
    "unique_session_id",
    "unique(session_id)",
    web("SELECT count(*) AS o FROM (SELECT 1 FROM web GROUP BY session_id HAVING count(*) > 1)"),
    lambda s, d: checks.check_unique(data.web_events(s, d), "session_id"),
)
check(
    "not_null_anonymous_id",
    "not_null(anonymous_id)",
    web("SELECT count(*) AS o FROM web WHERE anonymous_id IS NULL AND event_type = 'page'"),
    lambda s, d: checks.check_not_null(data.web_events(s, d), "anonymous_id", "event_type = 'page'"),
)
check(
    "session_relationship",
    "relationships(session_id)",
    fct("SELECT count(*) AS o FROM fct WHERE session_id NOT IN (SELECT session_id FROM bnd)"),
    lambda s, d: checks.check_relationships(
        data.fact(s, d), session_boundaries(data.staged(s, d)), "session_id"
    ),
)
check(
    "fact_covers_sessions",
    "relationships(session_id)",
    fct("SELECT count(*) AS o FROM web WHERE session_id NOT IN (SELECT session_id FROM fct)"),
    lambda s, d: checks.check_relationships(
        data.web_events(s, d), data.fact(s, d), "session_id", warn=0, error=None
    ),
    warn=0,
    error=None,
)
check(
    "accepted_space_types",
    "accepted_values(space_type)",
    web("SELECT count(*) AS o FROM web WHERE space_type NOT IN ('unit', 'amenity', 'tour', 'unknown')"),
    lambda s, d: checks.check_accepted_values(
        data.web_events(s, d), "space_type", ["unit", "amenity", "tour", "unknown"], warn=0, error=None
    ),
    warn=0,
    error=None,
)
check(
    "quality_range",
    "accepted_range(data_quality_score)",
    web("SELECT count(*) AS o FROM web WHERE data_quality_score < 0 OR data_quality_score > 1"),
    lambda s, d: checks.check_accepted_range(data.web_events(s, d), "data_quality_score", 0.0, 1.0),
)
check(
    "bounce_rate_expression",
    "expression(bounce_rate)",
    chain("fct", DAILY, CLASSED, SEGMENTS, kpis(1))
    + "@@ FROM (SELECT count(*) AS o FROM kpi WHERE total_bounce_rate < 0 OR total_bounce_rate > 100)",
    lambda s, d: checks.check_expression(
        journey.user_journey_analysis(data.fact(s, d), AS_OF, min_segment=1, ordered=False),
        "bounce_rate",
        "total_bounce_rate BETWEEN 0 AND 100",
    ),
)
check(
    "freshness",
    "freshness(processed_timestamp)",
    web(
        f"""SELECT (epoch(TIMESTAMP '{AS_OF}') - floor(epoch(max(processed_timestamp)))) / 3600.0 AS o
FROM web"""
    ),
    lambda s, d: checks.check_freshness(data.web_events(s, d), "processed_timestamp", AS_OF),
    warn=2,
    error=4,
)
check(
    "sequence_continuity",
    "sequence_continuity",
    fct(
        f"""SELECT count(*) AS o FROM (SELECT session_event_sequence - lag(session_event_sequence)
OVER (PARTITION BY session_id ORDER BY session_event_sequence) AS g FROM fct WHERE {_WEEK}) WHERE g > 1"""
    ),
    lambda s, d: checks.check_sequence_continuity(data.fact(s, d), AS_OF),
    warn=10,
    error=100,
)
check(
    "space_metrics",
    "space_metrics",
    fct(
        f"""SELECT count(*) AS o FROM (SELECT count(DISTINCT session_id) AS s,
avg(time_on_page_seconds) AS a, 100 * avg((engagement_score >= 2)::INT) AS r FROM fct
WHERE {_LATEST_DAY} GROUP BY space_type) WHERE s = 0 OR a < 0 OR r < 0 OR r > 100"""
    ),
    lambda s, d: checks.check_space_metrics(data.fact(s, d), AS_OF),
)
check(
    "time_travel_consistency",
    "time_travel_consistency",
    web(
        f"""SELECT (n = 0 AND h > 0)::INT AS o FROM (SELECT
count(*) FILTER (WHERE event_timestamp >= TIMESTAMP '{THEN}') AS n,
count(*) FILTER (WHERE event_timestamp < TIMESTAMP '{THEN}' AND processed_timestamp
  <= TIMESTAMP '{THEN}' AND event_timestamp >= TIMESTAMP '{THEN}' - INTERVAL 1 DAY) AS h FROM web)"""
    ),
    lambda s, d: checks.check_time_travel_consistency(data.web_events(s, d), AS_OF),
)
check(
    "merge_integrity",
    "merge_integrity(event_id)",
    web(f"SELECT count(*) - count(DISTINCT event_id) AS o FROM web WHERE {_LATEST_DAY}"),
    lambda s, d: checks.check_merge_integrity(data.web_events(s, d), AS_OF),
)
check(
    "partition_distribution",
    "partition_distribution",
    web(
        """SELECT (h = 0 OR h > n * 0.5)::INT AS o FROM (SELECT count(*) AS n,
count(*) FILTER (WHERE event_date = DATE '2024-01-30') AS h FROM web
WHERE event_date >= DATE '2024-01-23' AND event_date <= DATE '2024-01-30')"""
    ),
    lambda s, d: checks.check_partition_distribution(data.web_events(s, d), "2024-01-30"),
)
check(
    "required_columns",
    "required_columns",
    web(
        """SELECT (count(*) = 0 OR count(event_id) < count(*) OR count(processed_timestamp) < count(*)
OR count(event_timestamp) < count(*))::INT AS o FROM web WHERE event_date = DATE '2024-01-30'"""
    ),
    lambda s, d: checks.check_required_columns(data.web_events(s, d), "2024-01-30"),
)
check(
    "incremental_merge",
    "incremental_merge",
    web(
        f"""SELECT CASE WHEN n = 0 OR (n - k)::DOUBLE / n > 0.1 OR l < TIMESTAMP '{AS_OF}' - INTERVAL
2 HOUR THEN 1 ELSE 0 END AS o FROM (SELECT count(*) AS n, count(DISTINCT event_id) AS k,
max(processed_timestamp) AS l FROM web WHERE {_LATEST_DAY})"""
    ),
    lambda s, d: checks.check_incremental_merge(data.web_events(s, d), AS_OF),
)
check(
    "session_isolation",
    "session_isolation",
    web(
        f"""SELECT count(*) AS o FROM (SELECT count(DISTINCT anonymous_id) AS u,
count(DISTINCT event_timestamp::DATE) AS d, max(session_event_sequence) AS m, count(*) AS n
FROM web WHERE {_WEEK} GROUP BY session_id) WHERE u > 1 OR d > 1 OR m <> n"""
    ),
    lambda s, d: checks.check_session_isolation(data.web_events(s, d), AS_OF),
)
check(
    "post_compaction_quality",
    "post_compaction_quality",
    web(
        f"""SELECT (avg(data_quality_score) < 0.7 OR stddev(data_quality_score) > 0.3
OR count(*) FILTER (WHERE data_quality_score < 0.5) > count(*) * 0.2)::INT AS o FROM web
WHERE {_LATEST_DAY}"""
    ),
    lambda s, d: checks.check_post_compaction(data.web_events(s, d), AS_OF),
)
check(
    "partition_spread",
    "large_partitions",
    web(
        f"""SELECT count(*) FILTER (WHERE n > 1000000) AS o FROM (SELECT count(*) AS n FROM web
WHERE {_WEEK} GROUP BY event_date, space_type)"""
    ),
    lambda s, d: checks.check_partition_spread(data.web_events(s, d), AS_OF),
)
check(
    "clustering",
    "clustering",
    web(
        f"""SELECT avg(c::DOUBLE / n) AS o FROM (SELECT count(*) AS n,
count(DISTINCT concat_ws('_', session_id, anonymous_id)) AS c FROM web WHERE {_WEEK}
GROUP BY event_timestamp::DATE)"""
    ),
    lambda s, d: checks.check_clustering(data.web_events(s, d), AS_OF),
    error=0.8,
)
check(
    "time_travel_growth",
    "time_travel_growth",
    web(
        f"""SELECT (count(*) = count(*) FILTER (WHERE processed_timestamp <= TIMESTAMP '{THEN}'))::INT
AS o FROM web WHERE event_date = DATE '2024-01-30'"""
    ),
    lambda s, d: checks.check_time_travel_growth(data.web_events(s, d), "2024-01-30", THEN),
)
check(
    "session_consistency",
    "session_consistency",
    web(
        """SELECT count(*) AS o FROM (SELECT count(DISTINCT anonymous_id) AS u,
count(DISTINCT timezone) AS z, count(DISTINCT user_agent) AS a FROM web GROUP BY session_id)
WHERE u > 1 OR z > 2 OR a > 2"""
    ),
    lambda s, d: checks.check_session_consistency(data.web_events(s, d)),
)
check(
    "privacy",
    "privacy",
    web(
        """SELECT count(*) AS o FROM web
WHERE regexp_matches(concat_ws(' ', anonymous_id, user_id, session_id), '[^ ]+@[^ ]+\\.[A-Za-z]')"""
    ),
    lambda s, d: checks.check_privacy(data.web_events(s, d)),
)


@query(
    "check_partition_coverage",
    chain("fct", "cov AS (SELECT count(DISTINCT event_date) AS a, count(DISTINCT space_type) AS b FROM fct)")
    + verdict("days_with_data", "a", 25, None, True)
    + "FROM cov UNION ALL "
    + verdict("space_types_covered", "b", None, 3, True)
    + "FROM cov",
)
def coverage(spark, folder):
    return plain(checks.check_partition_coverage(data.fact(spark, folder), AS_OF))


@query(
    "check_service_levels",
    chain(
        "web",
        f"""lv AS (SELECT 100.0::DOUBLE * count(event_id) / count(*) AS a,
100.0::DOUBLE * count(DISTINCT event_id) / count(*) AS b,
epoch(TIMESTAMP '{AS_OF}') - floor(epoch(max(processed_timestamp))) AS c FROM web)""",
    )
    + verdict("completeness_pct", "a", None, 99.9, True)
    + "FROM lv UNION ALL "
    + verdict("uniqueness_pct", "b", None, 100, True)
    + "FROM lv UNION ALL "
    + verdict("lag_seconds", "c", None, 3600)
    + "FROM lv",
)
def service_levels(spark, folder):
    return plain(checks.check_service_levels(completeness(data.web_events(spark, folder), AS_OF)))


@query(
    "check_alerts",
    chain(
        "web",
        f"""al AS (SELECT (epoch(TIMESTAMP '{AS_OF}') - floor(epoch(max(processed_timestamp)))) / 60 AS a,
100 * avg((data_quality_score < 0.5)::INT) AS b, 0.8 - avg(data_quality_score) AS c FROM sco)""",
    )
    + verdict("processing_delay_minutes", "a", 15, 240)
    + "FROM al UNION ALL "
    + verdict("error_rate_pct", "b", 1, 5)
    + "FROM al UNION ALL "
    + verdict("quality_shortfall", "c", 0, None)
    + "FROM al",
)
def alerts(spark, folder):
    return plain(checks.check_alerts(checks.alert_metrics(data.scored(spark, folder), AS_OF)))


@query(
    "partition_spread",
    chain("web")
    + f"""SELECT {big("count(*) FILTER (WHERE n < 100)", "small_partitions")},
{big("count(*) FILTER (WHERE n > 1000000)", "large_partitions")}, count(*) AS total_partitions,
{rnd("sum(b)::DOUBLE / sum(n)", "avg_id_size")} FROM (SELECT count(*) AS n,
sum(strlen(event_id)) AS b FROM web WHERE {_WEEK} GROUP BY event_date, space_type)""",
)
def spread(spark, folder):
    return plain(checks.partition_spread(data.web_events(spark, folder), AS_OF))


@query(
    "check_schema_compatible",
    chain(
        "fct",
        """sc AS (SELECT (count(session_id) = 0)::INT + (count(page_path) = 0)::INT AS o FROM fct),
sd AS (SELECT 1 + (count(session_id) = 0)::INT + (count(page_path) > 0)::INT AS o FROM fct)""",
    )
    + verdict("schema_compatible", "o")
    + "FROM sc UNION ALL "
    + verdict("schema_broken", "o")
    + "FROM sd",
)
def schema(spark, folder):
    """The fact must keep every column of the event table, with type and content; a damaged copy must fail."""
    events, fact = data.web_events(spark, folder), data.fact(spark, folder)
    good = checks.check_schema_compatible(events, fact)
    damaged = fact.drop("user_agent").withColumn("page_path", F.lit(None).cast("string"))
    bad = checks.check_schema_compatible(events, damaged).replace("schema_compatible", "schema_broken")
    return plain(good.unionByName(bad))

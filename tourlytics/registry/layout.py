"""File layout, look-ups by identity, and stored sketches."""

from __future__ import annotations

import math

from pyspark.sql import functions as F

from ..operators import checks, sketches
from ..operators.filters import lookup_identity
from ..session import working_path
from ..sources import bucketed, clustering, tables
from . import data
from .catalog import query
from .oracle_base import chain, day, rnd, ts
from .result import plain

FILES = 64
TOUCHED = 0.3  # of the files, by a look-up of either column; with 64 files the square root is an eighth


@query(
    "z_ordered_files",
    chain("web")
    + """SELECT count(*) AS rows, count(DISTINCT session_id) AS sessions, count(DISTINCT anonymous_id) AS visitors,
true AS session_reads_few_files, true AS visitor_reads_few_files FROM web""",
)
def z_ordered(spark, folder):
    """The event table in Z-order of session and visitor: a look-up of either touches few files."""
    columns, path = ["session_id", "anonymous_id"], working_path(spark, "z_ordered")
    clustering.write_z_ordered(data.web_events(spark, folder), path, columns, FILES)
    table = spark.read.parquet(path)
    ranges = clustering.file_ranges(table, columns)
    shares = [clustering.touched_share(ranges, table, c) for c in columns]
    return table.agg(
        F.count(F.lit(1)).alias("rows"),
        F.count_distinct("session_id").alias("sessions"),
        F.count_distinct("anonymous_id").alias("visitors"),
        F.lit(shares[0] <= TOUCHED).alias("session_reads_few_files"),
        F.lit(shares[1] <= TOUCHED).alias("visitor_reads_few_files"),
    )


@query(
    "identity_lookup",
    chain("web")
    + f"""SELECT event_id, anonymous_id, user_id, {ts("event_timestamp")} FROM web
WHERE anonymous_id = 'u3' OR user_id = 'auth101'""",
)
def identity(spark, folder):
    found = lookup_identity(data.web_events(spark, folder), "u3", "auth101")
    return plain(found.select("event_id", "anonymous_id", "user_id", "event_timestamp"))


@query(
    "erased_accounts_on_storage",
    chain("web")
    + f"""SELECT {day("event_date")}, count(*) AS rows FROM web
WHERE user_id IS NULL OR user_id NOT IN ('auth0', 'auth103', 'nobody') GROUP BY event_date""",
)
def erased_accounts(spark, folder):
    """Accounts are found through the Bloom filters; one of them is not there."""
    path = working_path(spark, "accounts")
    tables.write_events(data.web_events(spark, folder), path)
    subjects = spark.createDataFrame([("auth0",), ("auth103",), ("nobody",), (None,)], "user_id string")
    tables.erase_on_storage(spark, path, subjects, "user_id")
    return plain(spark.read.parquet(path).groupBy("event_date").agg(F.count(F.lit(1)).alias("rows")))


def _hours(spark, folder):
    """The hourly sketches, written once; everything larger is made from them."""

    def write(path: str) -> None:
        sketches.hourly_sketches(data.web_events(spark, folder)).write.parquet(path)

    return spark.read.parquet(data.written_path(spark, folder, "hourly_sketches", write))


def _level(level: str) -> str:
    return chain("web") + f"""SELECT {ts(f"date_trunc('{level}', event_timestamp)", "bucket")}, count(*) AS total_events,
{rnd("avg(data_quality_score)", "avg_quality_score")}, true AS estimates_hold FROM web GROUP BY 1"""


def _folded(spark, folder, level: str):
    """Metrics folded from the stored hours; the estimates lie within four times their error of the exact numbers."""
    found = sketches.folded_metrics(_hours(spark, folder), level)
    exact = data.web_events(spark, folder).groupBy(F.date_trunc(level, "event_timestamp").alias("bucket")).agg(
        F.count_distinct("session_id").alias("sessions"), F.count_distinct("anonymous_id").alias("visitors")
    )
    bound = 4 * 1.04 / math.sqrt(2**sketches.PRECISION)
    near = lambda a, b: F.abs(F.col(a) - F.col(b)) <= F.greatest(F.lit(1.0), bound * F.col(b))
    held = (near("unique_sessions", "sessions") & near("unique_users", "visitors")).alias("estimates_hold")
    return plain(found.join(exact, "bucket").select("bucket", "total_events", "avg_quality_score", held))


@query("daily_from_sketches", _level("day"))
def daily_folded(spark, folder):
    return _folded(spark, folder, "day")


@query("weekly_from_sketches", _level("week"))
def weekly_folded(spark, folder):
    return _folded(spark, folder, "week")


_NUMBERS = ["time_on_page_seconds", "session_event_sequence", "pitch", "hfov", "screen_width"]
_RANK_ERROR = 3.3 / sketches.DISTRIBUTION_SIZE


@query(
    "column_distributions",
    chain("web")
    + " UNION ALL ".join(
        f"""SELECT '{c}' AS column_name, count(*) AS rows, count({c}) AS "values", CAST(min({c}) AS DOUBLE) AS smallest,
CAST(max({c}) AS DOUBLE) AS largest, true AS quartiles_hold FROM web"""
        for c in _NUMBERS
    ),
)
def column_distributions(spark, folder):
    """Quartiles from sketches stored per day; their exact ranks are within the error of the sketch."""
    events = data.web_events(spark, folder).withColumns({c: F.col(f"coordinates.{c}") for c in ("pitch", "hfov")})
    path = working_path(spark, "distributions")
    sketches.partition_distributions(events, _NUMBERS, ["event_date"]).write.parquet(path)
    rows = sketches.distributions(spark.read.parquet(path), _NUMBERS)  # one row a column
    checks = []
    for r in rows.collect():
        value = F.col(r["column_name"]).cast("double")
        for at, p in sketches.QUARTILES.items():
            under = F.count_if(value < r[at]) <= (p + _RANK_ERROR) * F.count(value)
            upto = F.count_if(value <= r[at]) >= (p - _RANK_ERROR) * F.count(value)
            checks.append(F.struct(F.lit(r["column_name"]).alias("column_name"), (under & upto).alias("held")))
    held = events.agg(F.explode(F.array(*checks)).alias("c")).groupBy("c.column_name").agg(F.bool_and("c.held").alias("quartiles_hold"))
    return rows.join(held, "column_name").select("column_name", "rows", "values", "smallest", "largest", "quartiles_hold")


BUCKETS = 8


def bucketed_table(spark, folder, kind: str, build):
    """A bucketed copy of a table, written once."""
    name = f"{kind}_{abs(hash((spark.sparkContext.applicationId, folder))):x}"
    path = data.written_path(spark, folder, name, lambda path: bucketed.write_bucketed(build(), name, path, BUCKETS))
    return bucketed.read_bucketed(spark, name, path, BUCKETS)


@query(
    "check_session_relationship_bucketed",
    chain("fct")
    + """SELECT 'relationships(session_id)' AS check_name, CAST(count(*) AS DOUBLE) AS observed
FROM fct WHERE session_id NOT IN (SELECT session_id FROM bnd)""",
)
def relationship_bucketed(spark, folder):
    """Fact to sessions over tables bucketed alike: neither side is shuffled."""
    fact = bucketed_table(spark, folder, "fact_by_session", lambda: data.fact(spark, folder).select("session_id", "event_id"))
    sessions = bucketed_table(
        spark, folder, "sessions_by_session", lambda: data.staged(spark, folder).select("session_id").distinct()
    )
    found = checks.check_relationships(fact, sessions, "session_id")
    return found.select("check_name", F.col("observed").cast("double").alias("observed"))

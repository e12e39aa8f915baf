"""Order of results, order inside files, and other properties of what is written."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..operators import monitor
from ..plans import journey, snapshots
from ..sources import tables
from . import data
from .catalog import SQL, query
from .data import AS_OF, THEN
from .oracle_base import chain, day, ts
from .result import plain


def _placed(ordered: DataFrame, *keys: str) -> DataFrame:
    """The sort keys at each place of an ordered result, as it comes."""
    numbered = ordered.select(*keys, F.monotonically_increasing_id().alias("_at"))
    place = F.row_number().over(Window.orderBy("_at")).alias("position")
    return plain(numbered.select(place, *keys))


def _in_order(name: str, order: str, *keys: str) -> str:
    return f"SELECT row_number() OVER (ORDER BY {order}) AS position, {', '.join(keys)} FROM ({SQL[name]})"


@query(
    "journeys_in_order",
    _in_order("user_journey_analysis", "analysis_date DESC, session_count DESC", "analysis_date", "session_count"),
)
def journeys(spark, folder):
    found = journey.user_journey_analysis(data.fact(spark, folder), AS_OF, min_segment=1)
    return _placed(found, "analysis_date", "session_count")


@query(
    "snapshots_in_order",
    _in_order("time_travel_analysis", "event_date DESC, space_type NULLS FIRST", "event_date", "space_type"),
)
def compared(spark, folder):
    return _placed(snapshots.time_travel_analysis(data.fact(spark, folder), AS_OF, THEN), "event_date", "space_type")


@query("realtime_in_order", _in_order("realtime_metrics", "hour_bucket DESC", "hour_bucket"))
def realtime(spark, folder):
    return _placed(monitor.realtime_metrics(data.fact(spark, folder), AS_OF), "hour_bucket")


@query("report_in_order", _in_order("daily_report", "total_sessions DESC", "total_sessions"))
def report(spark, folder):
    found = journey.user_journey_analysis(data.fact(spark, folder), AS_OF, min_segment=1, ordered=False)
    return _placed(journey.daily_report(found, "2024-01-15"), "total_sessions")


@query(
    "sorted_files",
    chain("web") + f"SELECT {day('event_date')}, space_type, 0 AS out_of_order FROM web GROUP BY event_date, space_type",
)
def sorted_files(spark, folder):
    """Rows of a file that stand before a smaller session or, in a session, a smaller visitor."""
    rows = data.web_events(spark, folder).select(
        "event_date", "space_type", F.struct("session_id", "anonymous_id").alias("k"),
        F.col("_metadata.file_path").alias("file"), F.col("_metadata.row_index").alias("at"),
    )
    before = F.lag("k").over(Window.partitionBy("file").orderBy("at"))
    wrong = F.count_if(F.col("before") > F.col("k")).alias("out_of_order")
    return plain(rows.withColumn("before", before).groupBy("event_date", "space_type").agg(wrong))


@query(
    "fact_constants",
    chain("fct") + "SELECT 'iceberg_native' AS processing_source, count(*) AS rows, true AS all_stamped FROM fct",
)
def constants(spark, folder):
    stamped = (F.count("dbt_processed_at") == F.count(F.lit(1))).alias("all_stamped")
    return plain(data.fact(spark, folder).groupBy("processing_source").agg(F.count(F.lit(1)).alias("rows"), stamped))


@query(
    "read_events",
    chain("web")
    + f"""SELECT event_id, {ts("processed_timestamp")}, if(event_date <= DATE '2024-01-05', NULL, page_path) AS page_path
FROM web WHERE processed_timestamp <= TIMESTAMP '2024-01-10 06:00:00'""",
)
def read(spark, folder):
    """A table whose older days lack a column, read with merged schemas as of a moment."""

    def write(path: str) -> None:
        events = data.web_events(spark, folder).select("event_id", "event_date", "space_type", "processed_timestamp", "page_path")
        old = F.col("event_date") <= F.lit("2024-01-05").cast("date")
        tables.write_events(events.where(old).drop("page_path"), path)
        tables.write_events(events.where(~old), path)

    path = data.written_path(spark, folder, "evolved_events", write)
    found = tables.read_events(spark, path, "2024-01-10 06:00:00", merge_schema=True)
    return plain(found.select("event_id", "processed_timestamp", "page_path"))

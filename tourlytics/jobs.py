"""The jobs a deployment runs: historical load, mart refresh, maintenance and reports.

Each step reads a written table and writes the next one, so no step repeats the one before, and a lost
executor costs only tasks of the running step.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .operators.filters import valid_events
from .operators.sequencing import SLICE_SECONDS, build_web_events
from .operators.session_metrics import session_metrics_v2, session_metrics_v3
from .plans.events import fact_from_web_events
from .plans.journey import daily_report, user_journey_analysis
from .plans.snapshots import time_travel_analysis
from .plans.spatial import spatial_analytics, spatial_cells, spatial_events
from .schemas import (
    PARTITIONS,
    SNAPSHOT_ANALYSIS,
    SPATIAL_ANALYTICS,
    USER_JOURNEY,
    WEB_EVENTS_ENRICHED,
    conform,
)
from .sources.normalize import normalize_event
from .sources.raw import decode_lines, read_raw_lines
from .session import drop_path, working_path
from .sources.tables import (
    append_new,
    clustered,
    compact_partitions,
    folders_of,
    read_folders,
    read_if_exists,
    replace_partitions,
    write_events,
    write_mart,
    write_report,
)

REJECT_KEY = ["payload", "kinesis_sequence_number", "kinesis_partition_key"]


@dataclass(frozen=True)
class Tables:
    """Where the tables of a deployment lie."""

    root: str

    def path(self, name: str) -> str:
        return f"{self.root.rstrip('/')}/{name}"

    def read(self, spark: SparkSession, name: str) -> DataFrame:
        return spark.read.parquet(self.path(name))


def load_history(
    spark: SparkSession,
    lines_path: str,
    tables: Tables,
    quality: str = "tiered_v2",
    slice_seconds: int = SLICE_SECONDS,
    ingest_time: Column | None = None,
) -> None:
    """Archived lines to ``web_events`` and ``session_metrics``; rejects go to ``rejected_records``.

    It can be repeated: documents are merged into ``landed_events`` by event id and rejects into
    ``rejected_records`` by their content, so an archive loaded twice, or one that overlaps another, adds
    nothing twice. As a session may span archives, the sessions of the events that are new are then sequenced anew
    from all that has landed of them; see ``refresh_sessions``. Their ids are written below the tables before the
    events land, and dropped when the sessions are up to date: a load that was interrupted is mended by running it, or
    any other, again. Events that have landed before keep the scores of that load (``rebuild_sessions`` scores all
    anew). Input is decoded once, into a folder that is dropped at the end.
    """
    pending = tables.path("pending_sessions")

    def note(new: DataFrame) -> None:
        valid_events(new, allow_user_id=True).select("session_id").distinct().write.mode("append").parquet(pending)

    decoded = decode_lines(read_raw_lines(spark, lines_path))
    landing = working_path(spark, "landing")
    rejected = F.when(F.col("error").isNotNull(), F.col("payload"))
    normalize_event(decoded, "batch", ingest_time, keep=["payload"]).withColumn("payload", rejected).write.parquet(landing)
    try:
        landed = spark.read.parquet(landing)
        good = landed.where("error is null").drop("error", "payload")
        append_new(spark, tables.path("landed_events"), good, written=True, before=note)
        said = F.concat_ws("|", "error", *[F.coalesce(c, F.lit("")) for c in REJECT_KEY])
        rejects = landed.where("error is not null").withColumn("reject_id", F.md5(said))
        append_new(spark, tables.path("rejected_records"), rejects, "reject_id", ["error"], None, written=True)
        touched = read_if_exists(spark, pending)
        if touched is None:  # nothing new
            touched = spark.createDataFrame([], "session_id string")
        refresh_sessions(spark, tables, touched, quality, slice_seconds)
        drop_path(spark, pending)
    finally:
        drop_path(spark, landing)


def rebuild_sessions(
    spark: SparkSession, tables: Tables, quality: str = "tiered_v2", slice_seconds: int = SLICE_SECONDS
) -> None:
    """``web_events`` and ``session_metrics_v2`` from all events that have landed."""
    valid = valid_events(tables.read(spark, "landed_events"), allow_user_id=True)
    clean = build_web_events(valid, quality, slice_seconds=slice_seconds)
    write_events(conform(clean, WEB_EVENTS_ENRICHED), tables.path("web_events"), mode="overwrite")
    stamped = _stamped_sessions(tables.read(spark, "web_events"))
    write_mart(stamped, tables.path("session_metrics_v2"), PARTITIONS["session_metrics"])


def refresh_sessions(
    spark: SparkSession,
    tables: Tables,
    touched: DataFrame,
    quality: str = "tiered_v2",
    slice_seconds: int = SLICE_SECONDS,
) -> None:
    """Brings the event and session tables up to date with the sessions that occur in ``touched``, and only them.

    Of the landed table the session ids alone are read whole. They name the partitions in which these
    sessions have events; those are read, the sessions in them sequenced anew, and the partitions replaced
    by their other rows and the new ones. Partitions without such a session keep their files. The first
    load, and one that has been interrupted before it wrote both tables, build them whole.
    """
    names = ("web_events", "session_metrics_v2")
    if any(read_if_exists(spark, tables.path(name)) is None for name in names):
        rebuild_sessions(spark, tables, quality, slice_seconds)
        return
    days, parts = PARTITIONS["session_metrics"], PARTITIONS["web_events"]
    steps = [working_path(spark, name) for name in ("sessions", "touched_partitions")]
    try:
        touched.select("session_id").distinct().write.parquet(steps[0])
        ids = spark.read.schema("session_id string").parquet(steps[0])
        if ids.isEmpty():
            return
        landed = tables.read(spark, "landed_events")
        landed.select(*parts, "session_id").join(ids, "session_id", "left_semi").select(*parts).distinct().write.parquet(steps[1])
        where = spark.read.parquet(steps[1])

        path = tables.path("landed_events")
        held = read_folders(spark, path, folders_of(spark, path, where, parts), landed.schema)
        theirs = valid_events(held.join(ids, "session_id", "left_semi"), allow_user_id=True)
        clean = conform(build_web_events(theirs, quality, slice_seconds=slice_seconds), WEB_EVENTS_ENRICHED)
        _replace_sessions(spark, tables.path("web_events"), clean, ids, where, parts)

        path, events = tables.path("web_events"), tables.read(spark, "web_events")
        now = read_folders(spark, path, folders_of(spark, path, where, parts), events.schema)
        sessions = _stamped_sessions(now.join(ids, "session_id", "left_semi"))
        _replace_sessions(spark, tables.path("session_metrics_v2"), sessions, ids, where.select(*days).distinct(), days)
    finally:
        for step in steps:
            drop_path(spark, step)


def _stamped_sessions(events: DataFrame) -> DataFrame:
    return session_metrics_v2(events).withColumn("processed_timestamp", F.current_timestamp())


def _replace_sessions(spark, path: str, rows: DataFrame, ids: DataFrame, where: DataFrame, partitions: list[str]) -> None:
    """In the partitions ``where``, the rows of the sessions ``ids`` give way to ``rows``."""
    table = spark.read.parquet(path)
    folders = folders_of(spark, path, where, partitions)
    others = read_folders(spark, path, folders, table.schema).join(ids, "session_id", "left_anti")
    both = others.select(*table.columns).unionByName(rows.select(*table.columns))
    replace_partitions(spark, path, clustered(both, partitions), folders, partitions)


def refresh_marts(
    spark: SparkSession,
    tables: Tables,
    as_of,
    then,
    start,
    exclude_bots: bool = True,
    slice_seconds: int = SLICE_SECONDS,
    min_segment: int = 10,
) -> None:
    """Staging and session views to the fact table, then the marts, each a full refresh."""
    web_events = tables.read(spark, "web_events")
    built = fact_from_web_events(
        web_events, slice_seconds, start=start, as_of=as_of, exclude_bots=exclude_bots
    )
    write_events(built, tables.path("fct_web_events"), mode="overwrite")
    fact = tables.read(spark, "fct_web_events")
    spatial = spatial_events(fact, start)
    write_mart(spatial_cells(spatial), tables.path("spatial_cells"), ["analysis_date"])
    cells = tables.read(spark, "spatial_cells")

    marts = {
        "session_metrics": session_metrics_v3(fact),
        "user_journey_analysis": conform(
            user_journey_analysis(fact, as_of, min_segment=min_segment, ordered=False), USER_JOURNEY
        ),
        "spatial_analytics": conform(spatial_analytics(cells, spatial), SPATIAL_ANALYTICS),
        "time_travel_analysis": conform(time_travel_analysis(fact, as_of, then), SNAPSHOT_ANALYSIS),
    }
    for name, mart in marts.items():
        write_mart(mart, tables.path(name), PARTITIONS[name])


def maintain(spark: SparkSession, tables: Tables, since) -> None:
    """Compacts the recent partitions of the event and session tables."""
    compact_partitions(spark, tables.path("web_events"), since)
    compact_partitions(
        spark,
        tables.path("session_metrics"),
        since,
        partitions=PARTITIONS["session_metrics"],
        spread_by="session_id",
    )


def report_day(spark: SparkSession, tables: Tables, day) -> str:
    """Creates the report of a day from the journey mart and returns its path."""
    journeys = tables.read(spark, "user_journey_analysis")
    return write_report(daily_report(journeys, day), tables.path("reports"), day)

"""Shared inputs of the registered queries.

The marts read written tables, as they do in production: the event table and the event fact are
built once per application and data folder, below the shared folder, and read from there.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from ..operators.filters import clean_traffic, valid_events
from ..operators.sequencing import build_web_events, score_events
from ..plans.events import fact_from_web_events, stage_events
from ..sources.event_table import source_events
from ..sources.tables import write_events
from ..session import DEFAULTS, bound_reads, working_path

START = "2024-01-01"
AS_OF = "2024-01-31 00:00:00"
THEN = "2024-01-30 00:00:00"

_written: dict[tuple[str, str, str], str] = {}


def written_path(
    spark: SparkSession, folder: str, name: str, write: Callable[[str], None]
) -> str:
    """Where ``write`` has put its output; it runs once per application and data folder."""
    prepare(spark)
    key = (spark.sparkContext.applicationId, folder, name)
    if key not in _written:
        path = working_path(spark, name)
        write(path)
        _written[key] = path
    return _written[key]


def written(spark: SparkSession, folder: str, name: str, build: Callable[[], DataFrame]) -> DataFrame:
    def write(path: str) -> None:
        write_events(build(), path)

    return spark.read.parquet(written_path(spark, folder, name, write))


def prepare(spark: SparkSession) -> None:
    """The one setting that results depend on, and the size of reads, for a session that was not built here."""
    spark.conf.set("spark.sql.session.timeZone", DEFAULTS["spark.sql.session.timeZone"])
    bound_reads(spark)


def source(spark: SparkSession, folder: str) -> DataFrame:
    prepare(spark)
    return source_events(spark, folder)


def valid(spark: SparkSession, folder: str) -> DataFrame:
    return valid_events(source(spark, folder), allow_user_id=True)


def scored_plan(spark: SparkSession, folder: str) -> DataFrame:
    return score_events(valid(spark, folder))


def scored(spark: SparkSession, folder: str) -> DataFrame:
    """All sequenced and scored events, robots too, as a table partitioned by day."""
    return written(spark, folder, "scored_events", lambda: scored_plan(spark, folder))


def web_events_plan(spark: SparkSession, folder: str) -> DataFrame:
    return build_web_events(valid(spark, folder))


def web_events_path(spark: SparkSession, folder: str) -> str:
    web_events(spark, folder)
    return _written[(spark.sparkContext.applicationId, folder, "web_events")]


def web_events(spark: SparkSession, folder: str) -> DataFrame:
    return written(spark, folder, "web_events", lambda: clean_traffic(scored(spark, folder)))


def staged(spark: SparkSession, folder: str) -> DataFrame:
    return stage_events(web_events(spark, folder), START, AS_OF)


def fact_plan(spark: SparkSession, folder: str) -> DataFrame:
    return fact_from_web_events(web_events(spark, folder), start=START, as_of=AS_OF)


def fact(spark: SparkSession, folder: str) -> DataFrame:
    return written(spark, folder, "fct_web_events", lambda: fact_plan(spark, folder))

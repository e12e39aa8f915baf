"""Positions and neighbours of events inside their session.

A plain window over ``session_id`` puts a whole session into one task, and one session id (a robot, a
shared kiosk, a default value) may hold a large part of all rows. So the window runs inside time
slices of a session, and a small table with one row per session and slice carries the count before
the slice and the times next to its two ends. The rows are shuffled once, by session and slice; the
join with the carried values keeps that partitioning and order.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions import classify
from .filters import clean_traffic

DEFAULT_LAST_SECONDS = 30  # time on page of the last event of a session
SLICE_SECONDS = 300  # fine enough for a robot's session, and coarse beside the events of a person


def session_positions(
    events: DataFrame,
    slice_seconds: int = SLICE_SECONDS,
    key: str = "session_id",
    time: str = "event_timestamp",
    tie: str = "event_id",
) -> DataFrame:
    """Adds ``_rank``, ``_total``, ``_prev`` and ``_next`` over (session, time, tie).

    ``slice_seconds`` bounds what one task sorts for a session. The result does not depend on it. Rows without a session id stay, with NULL in the added columns.
    """
    width = slice_seconds * 1_000_000
    sliced = events.withColumn("_slice", F.floor(F.unix_micros(F.col(time)) / F.lit(width)))

    inside = Window.partitionBy(key, "_slice").orderBy(time, tie)
    local = sliced.select(
        "*",
        F.row_number().over(inside).alias("_row"),
        F.lag(time).over(inside).alias("_prev_in"),
        F.lead(time).over(inside).alias("_next_in"),
    )

    along = Window.partitionBy(key).orderBy("_slice")
    carried = (
        sliced.where(F.col(key).isNotNull())
        .groupBy(key, "_slice")
        .agg(F.count(F.lit(1)).alias("_n"), F.min(time).alias("_first"), F.max(time).alias("_last"))
        .select(
            key,
            "_slice",
            F.coalesce(
                F.sum("_n").over(along.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)
            ).alias("_before"),
            F.sum("_n").over(Window.partitionBy(key)).alias("_total"),
            F.lag("_last").over(along).alias("_prev_out"),
            F.lead("_first").over(along).alias("_next_out"),
        )
    )
    added = {
        "_rank": (F.col("_row") + F.col("_before")).cast("int"),
        "_prev": F.coalesce("_prev_in", "_prev_out"),
        "_next": F.coalesce("_next_in", "_next_out"),
    }
    return (
        local.join(carried, [key, "_slice"], "left")
        .withColumns(added)
        .select(*events.columns, "_rank", "_total", "_prev", "_next")
    )


def sequence_sessions(events: DataFrame, slice_seconds: int = SLICE_SECONDS) -> DataFrame:
    """Position, first-event flag, next time and whole seconds on the page."""
    # Whole seconds, rounded down before 1970 too.
    stay = F.unix_seconds("next_event_timestamp") - F.unix_seconds("event_timestamp")
    return (
        session_positions(events, slice_seconds)
        .withColumnsRenamed({"_rank": "session_event_sequence", "_next": "next_event_timestamp"})
        .withColumns(
            {
                "is_first_event_in_session": F.col("session_event_sequence") == 1,
                "time_on_page_seconds": F.coalesce(stay, F.lit(DEFAULT_LAST_SECONDS)),
            }
        )
        .drop("_prev", "_total")
    )


def enrich_events(events: DataFrame) -> DataFrame:
    """Device, region and context flags of the batch flow."""
    return events.withColumns(
        {
            "device_type": classify.device_type(F.col("screen_width")),
            "is_virtual_tour_page": classify.viewer_page_contains(F.col("page_path")),
            "has_space_context": F.col("space_id").isNotNull(),
            "has_room_context": F.col("room_id").isNotNull(),
            "has_coordinates": F.col("coordinates").isNotNull(),
            "region": classify.region(F.col("timezone")),
        }
    )


QUALITY = {
    "tiered_v2": classify.tiered_quality_v2,
    "tiered_v1": classify.tiered_quality_v1,
    "additive": classify.additive_quality_batch,
}


def score_events(
    valid: DataFrame, quality: str = "tiered_v2", slice_seconds: int = SLICE_SECONDS
) -> DataFrame:
    """Sequence, then score and bot flag: the flag needs the time on the page."""
    sequenced = sequence_sessions(enrich_events(valid), slice_seconds)
    bot = classify.is_bot_batch(F.col("user_agent"), F.col("time_on_page_seconds"))
    return sequenced.withColumns({"data_quality_score": QUALITY[quality](), "is_bot": bot})


def build_web_events(
    valid: DataFrame,
    quality: str = "tiered_v2",
    min_quality: float = 0.5,
    slice_seconds: int = SLICE_SECONDS,
) -> DataFrame:
    """Clean event table from valid events; surviving sequences may have gaps."""
    return clean_traffic(score_events(valid, quality, slice_seconds), min_quality)


def session_boundaries(staged: DataFrame, slice_seconds: int = SLICE_SECONDS) -> DataFrame:
    """Neighbours, start and end flags, rank, size and stage of every staged event."""
    gap = (F.unix_micros("next_event_timestamp") - F.unix_micros("event_timestamp")) / 1e6
    return (
        session_positions(staged.drop("next_event_timestamp"), slice_seconds)
        .withColumnsRenamed(
            {
                "_prev": "prev_event_timestamp",
                "_next": "next_event_timestamp",
                "_rank": "session_event_rank",
                "_total": "total_session_events",
            }
        )
        .withColumns(
            {
                "is_session_start": F.col("prev_event_timestamp").isNull(),
                "is_session_end": F.col("next_event_timestamp").isNull(),
                "seconds_to_next_event": F.coalesce(gap, F.lit(float(DEFAULT_LAST_SECONDS))),
                "journey_stage": classify.journey_stage(
                    F.col("session_event_sequence"), F.col("next_event_timestamp")
                ),
            }
        )
    )


def sequence_gaps(events: DataFrame, slice_numbers: int = 1000) -> DataFrame:
    """Difference of each sequence number to the one before it in the session.

    Sequence numbers are unique in a session, so slices of the number itself bound the groups: the
    window runs inside a slice and the last number of earlier slices is carried over.
    """
    key, number = "session_id", "session_event_sequence"
    sliced = events.where(F.col(key).isNotNull()).withColumn(
        "_slice", F.floor(F.col(number) / F.lit(slice_numbers))
    )
    inside = Window.partitionBy(key, "_slice").orderBy(number)
    local = sliced.select("*", F.lag(number).over(inside).alias("_prev_in"))
    along = Window.partitionBy(key).orderBy("_slice")
    carried = (
        sliced.groupBy(key, "_slice")
        .agg(F.max(number).alias("_last"))
        .select(key, "_slice", F.lag("_last").over(along).alias("_prev_out"))
    )
    return (
        local.join(carried, [key, "_slice"], "left")
        .withColumn("prev_sequence", F.coalesce("_prev_in", "_prev_out"))
        .withColumn("gap", F.col(number) - F.col("prev_sequence"))
        .select(*events.columns, "prev_sequence", "gap")
    )

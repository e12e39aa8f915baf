"""Comparison of a table now with the same table at an earlier moment."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import classify
from ..functions.rules import count_if, percent
from ..operators.filters import date_at, since_days, timestamp_at
from ..schemas import SNAPSHOT_ANALYSIS, conform
from ..sources.tables import as_of_time

# measure of snapshot_metrics to the stem of its comparison columns
STEMS = {
    "total_events": "events",
    "unique_sessions": "sessions",
    "unique_users": "users",
    "avg_engagement_score": "engagement",
    "avg_time_on_page": "time_on_page",
    "core_tour_events": "core_events",
    "avg_data_quality": "quality",
}
KEYS = ["event_date", "space_type"]
PERCENT_STEMS = ["events", "sessions", "engagement"]
SUMMED = ["events", "sessions", "users", "core_events"]
FLAGS = [
    "events_variance_flag",
    "engagement_variance_flag",
    "quality_trend",
    "data_freshness_status",
]


def snapshot_metrics(fact: DataFrame, as_of, days: int = 7) -> DataFrame:
    return (
        since_days(fact, as_of, days)
        .groupBy("event_date", "space_type")
        .agg(
            F.count(F.lit(1)).alias("total_events"),
            F.count_distinct("session_id").alias("unique_sessions"),
            F.count_distinct("anonymous_id").alias("unique_users"),
            F.avg("engagement_score").alias("avg_engagement_score"),
            F.avg("time_on_page_seconds").alias("avg_time_on_page"),
            count_if(F.col("is_core_virtual_tour_event")).alias("core_tour_events"),
            F.avg("data_quality_score").alias("avg_data_quality"),
        )
    )


def snapshot_compare(current: DataFrame, historical: DataFrame) -> DataFrame:
    """Now, then, difference, percent change and flags per day and space type.

    Both sides are aggregates, so the join is small; NULL keys never match.
    """
    now = current.select(*KEYS, *[F.col(m).alias(f"current_{s}") for m, s in STEMS.items()])
    then = historical.select(*KEYS, *[F.col(m).alias(f"_h_{s}") for m, s in STEMS.items()])
    return _changes(now.join(then, KEYS, "left"))


def snapshot_pair(
    fact: DataFrame, as_of, then, days: int = 7, system_time: str = "processed_timestamp"
) -> DataFrame:
    """Measures now and at ``then`` side by side, from one scan of an append-only fact.

    Events collapse to one row per session and visitor first, with sums for both moments; the distinct
    counts then run over those rows. A row without a space type has no history, as a NULL key never
    matches in the join of two snapshots.
    """
    seen = F.col(system_time) <= timestamp_at(then)
    values = {
        "engagement": F.col("engagement_score"),
        "time_on_page": F.col("time_on_page_seconds"),
        "quality": F.col("data_quality_score"),
    }
    parts = []
    for side, inside in (("current", F.lit(True)), ("_h", seen)):
        parts.append(count_if(inside).alias(f"{side}_events"))
        parts.append(count_if(inside & F.col("is_core_virtual_tour_event")).alias(f"{side}_core_events"))
        for stem, value in values.items():
            parts.append(F.sum(F.when(inside, value)).alias(f"{side}_{stem}_sum"))
            parts.append(F.count(F.when(inside, value)).alias(f"{side}_{stem}_n"))
    sessions = (
        since_days(fact, as_of, days).groupBy(*KEYS, "session_id", "anonymous_id").agg(*parts)
    )
    folded = []
    for side in ("current", "_h"):
        present = F.col(f"{side}_events") > 0
        folded += [
            F.sum(f"{side}_events").alias(f"{side}_events"),
            F.sum(f"{side}_core_events").alias(f"{side}_core_events"),
            F.count_distinct(F.when(present, F.col("session_id"))).alias(f"{side}_sessions"),
            F.count_distinct(F.when(present, F.col("anonymous_id"))).alias(f"{side}_users"),
        ]
        folded += [
            F.try_divide(
                F.sum(f"{side}_{stem}_sum").cast("double"), F.sum(f"{side}_{stem}_n").cast("double")
            ).alias(f"{side}_{stem}")
            for stem in values
        ]
    known = F.col("space_type").isNotNull() & (F.col("_h_events") > 0)
    return (
        sessions.groupBy(*KEYS)
        .agg(*folded)
        .withColumns({f"_h_{s}": F.when(known, F.col(f"_h_{s}")) for s in STEMS.values()})
    )


def _changes(paired: DataFrame) -> DataFrame:
    columns: dict[str, Column] = {}
    for stem in STEMS.values():
        was = F.coalesce(F.col(f"_h_{stem}"), F.lit(0))
        columns[f"historical_{stem}"] = was
        columns[f"{stem}_change"] = F.col(f"current_{stem}") - was
    for stem in PERCENT_STEMS:
        was = F.col(f"_h_{stem}")
        change = percent(F.col(f"current_{stem}") - was, was)
        columns[f"{stem}_change_pct"] = F.when(was > 0, change)
    flagged = paired.withColumns(columns).withColumns(
        {
            "events_variance_flag": classify.variance_flag(F.col("events_change_pct")),
            "engagement_variance_flag": classify.variance_flag(
                F.col("engagement_change_pct"), classify.ENGAGEMENT_VARIANCE
            ),
            "quality_trend": classify.quality_trend(F.col("quality_change")),
            "data_freshness_status": classify.data_freshness_status(
                F.col("events_change"), F.col("sessions_change")
            ),
        }
    )
    return conform(flagged, SNAPSHOT_ANALYSIS)


def _folds() -> list[Column]:
    measures = []
    for stem in STEMS.values():
        fold = F.sum if stem in SUMMED else F.avg
        for name in (f"current_{stem}", f"historical_{stem}", f"{stem}_change"):
            measures.append(fold(name).alias(name))
    return measures


def snapshot_summary(compared: DataFrame) -> DataFrame:
    """One row per day over all space types; a visitor of two space types counts twice."""
    summary = compared.groupBy("event_date").agg(*_folds())
    return conform(summary.withColumns(_summary_values()), SNAPSHOT_ANALYSIS)


def _summary_rates() -> dict[str, Column]:
    return {
        f"{stem}_change_pct": F.when(
            F.col(f"historical_{stem}") > 0,
            percent(F.col(f"{stem}_change"), F.col(f"historical_{stem}")),
        )
        for stem in ("events", "sessions")
    }


def _summary_values() -> dict[str, Column]:
    """Columns of a summary row that are not folds of the details."""
    return {
        "space_type": F.lit("all_spaces"),
        **_summary_rates(),
        "engagement_change_pct": F.lit(None).cast("double"),
        **{flag: F.lit("summary") for flag in FLAGS},
    }


def time_travel_analysis(
    fact: DataFrame, as_of, then, historical: DataFrame | None = None, days: int = 7
) -> DataFrame:
    """Details and daily summary, newest day first.

    ``historical`` is the earlier snapshot where a table format offers one; else both moments come
    from one scan of the fact, cut at ``then`` by its processing time.
    """
    if historical is None:
        compared = _changes(snapshot_pair(fact, as_of, then, days))
    else:
        compared = snapshot_compare(
            snapshot_metrics(fact, as_of, days), snapshot_metrics(historical, as_of, days)
        )
    return _with_summary(compared).orderBy(F.desc("event_date"), "space_type")


def _with_summary(compared: DataFrame) -> DataFrame:
    """Details and summary rows from one evaluation of the details.

    Each detail row is emitted for its own level and for the level of its day, then folded: a detail
    level holds one row, which a sum or mean leaves as it is.
    """
    levels = compared.withColumn("_day", F.explode(F.array(F.lit(False), F.lit(True))))
    own = F.when(~F.col("_day"), F.col("space_type")).alias("space_type")
    kept = [*FLAGS, *[f"{stem}_change_pct" for stem in PERCENT_STEMS]]
    folded = levels.groupBy("event_date", "_day", own).agg(
        *_folds(), *[F.max(name).alias(name) for name in kept]
    )
    chosen = {
        name: F.when(F.col("_day"), value).otherwise(F.col(name))
        for name, value in _summary_values().items()
    }
    return conform(folded.withColumns(chosen), SNAPSHOT_ANALYSIS)


def snapshot_growth(events: DataFrame, day, then, system_time: str = "processed_timestamp") -> DataFrame:
    """Events of a day now and at ``then``, with the growth in percent; one pass over the day."""
    seen = F.col(system_time) <= timestamp_at(then)
    counts = events.where(F.col("event_date") == date_at(day)).agg(
        F.count(F.lit(1)).alias("current_events"), count_if(seen).alias("historical_events")
    )
    added = F.col("current_events") - F.col("historical_events")
    return counts.withColumns(
        {
            "events_added": added,
            "growth_percentage": F.when(
                F.col("historical_events") > 0, percent(added, F.col("historical_events"))
            ),
        }
    )


def snapshot_space_counts(fact: DataFrame, moment) -> DataFrame:
    """Events and mean score per space type at one moment."""
    return (
        as_of_time(fact, moment)
        .groupBy("space_type")
        .agg(
            F.count(F.lit(1)).alias("events_count"),
            F.avg("engagement_score").alias("avg_engagement_score"),
        )
    )


def snapshot_trend(events: DataFrame, moments: list[str]) -> DataFrame:
    """Rows and mean quality at each of several moments, in one pass.

    Every event is counted in the first snapshot that holds it; running sums over the few snapshots
    give the totals. Events after the last moment belong to none.
    """
    ordered = sorted(set(str(m) for m in moments))
    first = F.lit(None).cast("string")
    for moment in reversed(ordered):
        first = F.when(F.col("processed_timestamp") <= timestamp_at(moment), moment).otherwise(first)
    added = (
        events.select(first.alias("_at"), "data_quality_score")
        .where(F.col("_at").isNotNull())
        .groupBy("_at")
        .agg(
            F.count(F.lit(1)).alias("_rows"),
            F.sum("data_quality_score").alias("_sum"),
            F.count("data_quality_score").alias("_scored"),
        )
    )
    times = events.sparkSession.range(1).select(
        F.explode(F.array(*[F.lit(moment) for moment in ordered])).alias("_at")
    )
    so_far = Window.orderBy("_at").rowsBetween(Window.unboundedPreceding, 0)

    def running(name: str) -> Column:
        return F.sum(F.coalesce(F.col(name), F.lit(0))).over(so_far)

    return times.join(added, "_at", "left").select(
        F.col("_at").cast("timestamp").alias("snapshot_timestamp"),
        running("_rows").alias("records_at_snapshot"),
        F.try_divide(running("_sum"), running("_scored")).alias("quality_score_trend"),
    )

"""Data-quality checks. Each returns one row: name, observed value, warn and error limits, status.

``observed`` counts failures unless the name says otherwise; a check fails when it goes beyond a
limit. Checks are aggregates over the whole table.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.rules import count_if, first_of
from .filters import date_at, days_back, hours_back, since_days, since_hours, timestamp_at
from .sequencing import sequence_gaps


def _judge(name: str, value: Column, warn, error, below: bool) -> Column:
    value = value.cast("double")

    def beyond(limit: float) -> Column:
        return value < limit if below else value > limit

    rules = [(value.isNull(), "error")]
    if error is not None:
        rules.append((beyond(error), "error"))
    if warn is not None:
        rules.append((beyond(warn), "warn"))
    return F.struct(
        F.lit(name).alias("check_name"),
        value.alias("observed"),
        F.lit(warn).cast("double").alias("warn_limit"),
        F.lit(error).cast("double").alias("error_limit"),
        first_of(rules, "pass").alias("status"),
    )


def verdicts(measured: DataFrame, specs: Sequence[tuple]) -> DataFrame:
    """One row per (name, column, warn, error, below) over a one-row table, in a single pass."""
    judged = [_judge(name, F.col(col), warn, error, low) for name, col, warn, error, low in specs]
    return measured.select(F.explode(F.array(*judged)).alias("v")).select("v.*")


def verdict(
    measured: DataFrame,
    name: str,
    observed: str = "observed",
    warn: float | None = None,
    error: float | None = 0,
    below: bool = False,
) -> DataFrame:
    """Status from the limits: beyond ``error`` fails, beyond ``warn`` warns, else passes.

    With ``below`` the value must not fall under the limits. An unknown value fails.
    """
    return measured.select(_judge(name, F.col(observed), warn, error, below).alias("v")).select("v.*")


def _scope(df: DataFrame, where: Column | str | None) -> DataFrame:
    return df if where is None else df.where(where)


def _failures(df: DataFrame, bad: Column) -> DataFrame:
    return df.agg(F.count_if(bad).alias("observed"))


def check_unique(df: DataFrame, key: str, **limits) -> DataFrame:
    repeated = df.where(F.col(key).isNotNull()).groupBy(key).count().where(F.col("count") > 1)
    return verdict(repeated.agg(F.count(F.lit(1)).alias("observed")), f"unique({key})", **limits)


def check_not_null(df: DataFrame, column: str, where=None, **limits) -> DataFrame:
    measured = _failures(_scope(df, where), F.col(column).isNull())
    return verdict(measured, f"not_null({column})", **limits)


def check_relationships(child: DataFrame, parent: DataFrame, key: str, **limits) -> DataFrame:
    """Child rows whose key the parent lacks. Both sides are reduced to keys before the join."""
    keys = child.where(F.col(key).isNotNull()).groupBy(key).agg(F.count(F.lit(1)).alias("n"))
    orphans = keys.join(parent.select(key).distinct(), key, "left_anti")
    measured = orphans.agg(F.coalesce(F.sum("n"), F.lit(0)).alias("observed"))
    return verdict(measured, f"relationships({key})", **limits)


def check_accepted_values(df: DataFrame, column: str, values: Sequence, where=None, **limits):
    bad = F.col(column).isNotNull() & ~F.col(column).isin(*values)
    return verdict(_failures(_scope(df, where), bad), f"accepted_values({column})", **limits)


def check_accepted_range(df: DataFrame, column: str, low, high, where=None, **limits) -> DataFrame:
    bad = ~F.col(column).between(low, high)
    return verdict(_failures(_scope(df, where), bad), f"accepted_range({column})", **limits)


def check_expression(df: DataFrame, name: str, expression: Column | str, where=None, **limits):
    """Rows where the expression is not true; NULL counts as a failure."""
    true = F.expr(expression) if isinstance(expression, str) else expression
    bad = ~F.coalesce(true, F.lit(False))
    return verdict(_failures(_scope(df, where), bad), f"expression({name})", **limits)


def check_freshness(
    df: DataFrame, column: str, as_of, warn_hours: float = 2, error_hours: float = 4
) -> DataFrame:
    """Hours from the latest value to now."""
    age = F.unix_timestamp(timestamp_at(as_of)) - F.unix_timestamp("latest")
    measured = df.agg(F.max(column).alias("latest")).select((age / 3600.0).alias("observed"))
    return verdict(measured, f"freshness({column})", warn=warn_hours, error=error_hours)


def check_sequence_continuity(fact: DataFrame, as_of, warn: int = 10, error: int = 100) -> DataFrame:
    recent = since_days(fact, as_of, 7).select("session_id", "session_event_sequence")
    gaps = sequence_gaps(recent).agg(F.count_if(F.col("gap") > 1).alias("observed"))
    return verdict(gaps, "sequence_continuity", warn=warn, error=error)


def check_space_metrics(fact: DataFrame, as_of, days: int = 1) -> DataFrame:
    """Space types with impossible sessions, time or engagement rate."""
    recent = since_days(fact, as_of, days).where(F.col("space_type").isNotNull())
    engaged = count_if(F.col("engagement_score") >= 2) * 100.0 / F.count(F.lit(1))
    per_type = recent.groupBy("space_type").agg(
        F.count("session_id").alias("with_session"),
        F.avg("time_on_page_seconds").alias("avg_time"),
        engaged.alias("rate"),
    )
    bad = (F.col("with_session") == 0) | (F.col("avg_time") < 0) | ~F.col("rate").between(0, 100)
    return verdict(_failures(per_type, bad), "space_metrics")


def check_partition_coverage(
    fact: DataFrame, as_of, days: int = 30, min_days: int = 25, min_types: int = 3
) -> DataFrame:
    """Two rows: days with data (warns) and space types covered (fails)."""
    parts = since_days(fact, as_of, days).groupBy("event_date", "space_type").count()
    covered = parts.agg(
        F.count_distinct("event_date").alias("days"), F.count_distinct("space_type").alias("types")
    )
    return verdicts(
        covered,
        [
            ("days_with_data", "days", min_days, None, True),
            ("space_types_covered", "types", None, min_types, True),
        ],
    )


def check_time_travel_consistency(
    df: DataFrame, as_of, time: str = "event_timestamp", hours: int = 24
) -> DataFrame:
    """Fails when recent data is gone although the earlier window, as it stood then, has some.

    One pass: the recent and the earlier window, the latter cut by processing time.
    """
    start = hours_back(as_of, hours)
    recent = F.col(time) >= start
    earlier = (F.col(time) < start) & (F.col("processed_timestamp") <= start)
    counts = since_hours(df, as_of, 2 * hours, time).agg(
        count_if(recent).alias("now"),
        F.count_if(recent & F.col(time).isNotNull()).alias("stamped"),
        count_if(earlier).alias("then"),
    )
    lost = (F.col("now") == 0) & (F.col("then") > 0)
    unstamped = (F.col("now") > 0) & (F.col("stamped") == 0)
    measured = counts.select((lost | unstamped).cast("int").alias("observed"))
    return verdict(measured, "time_travel_consistency")


def check_merge_integrity(df: DataFrame, as_of, key: str = "event_id", days: int = 1) -> DataFrame:
    repeated = since_days(df, as_of, days).groupBy(key).count().where(F.col("count") > 1)
    return verdict(repeated.agg(F.count(F.lit(1)).alias("observed")), f"merge_integrity({key})")


def check_partition_distribution(df: DataFrame, day, column: str = "event_date") -> DataFrame:
    """Fails when a day has no rows or more than half of the rows of its week."""
    week = df.where(F.col(column).between(days_back(day, 7), date_at(day)))
    counts = week.agg(
        F.count(F.lit(1)).alias("all"), F.count_if(F.col(column) == date_at(day)).alias("hit")
    )
    bad = (F.col("hit") == 0) | (F.col("hit") > F.col("all") * 0.5)
    return verdict(counts.select(bad.cast("int").alias("observed")), "partition_distribution")


def check_required_columns(
    df: DataFrame,
    day,
    columns: Sequence[str] = ("event_id", "processed_timestamp", "event_timestamp"),
) -> DataFrame:
    """Fails when a required value is missing on a day, or the day is empty."""
    missing = F.lit(False)
    for column in columns:
        missing = missing | F.col(column).isNull()
    counts = df.where(F.col("event_date") == date_at(day)).agg(
        F.count(F.lit(1)).alias("all"), F.count_if(missing).alias("missing")
    )
    bad = (F.col("missing") > 0) | (F.col("all") == 0)
    return verdict(counts.select(bad.cast("int").alias("observed")), "required_columns")


def check_incremental_merge(
    df: DataFrame, as_of, key: str = "event_id", max_ratio: float = 0.1, max_lag_hours: float = 2
) -> DataFrame:
    """Fails on no rows, too many repeated keys, or stale processing."""
    stats = since_days(df, as_of, 1).agg(
        F.count(F.lit(1)).alias("all"),
        F.count_distinct(key).alias("keys"),
        F.max("processed_timestamp").alias("latest"),
    )
    repeated = F.try_divide((F.col("all") - F.col("keys")).cast("double"), F.col("all").cast("double"))
    bad = first_of(
        [
            (F.col("all") == 0, 1),
            (repeated > max_ratio, 1),
            (F.col("latest") < hours_back(as_of, max_lag_hours), 1),
        ],
        0,
    )
    return verdict(stats.select(bad.alias("observed")), "incremental_merge")


def check_session_isolation(df: DataFrame, as_of, key: str = "session_id", days: int = 7) -> DataFrame:
    """Sessions with several visitors, several days or a sequence that is not its event count.

    Several visitors or days are seen by comparing the smallest with the largest value, which needs
    no distinct counts.
    """
    recent = since_days(df, as_of, days)
    day = F.to_date("event_timestamp")
    sessions = recent.groupBy(key).agg(
        (F.min("anonymous_id") != F.max("anonymous_id")).alias("users"),
        (F.min(day) != F.max(day)).alias("days"),
        (F.max("session_event_sequence") != F.count(F.lit(1))).alias("jumps"),
    )
    bad = F.lit(False)
    for flag in ("users", "days", "jumps"):
        bad = bad | F.coalesce(F.col(flag), F.lit(False))
    return verdict(_failures(sessions, bad), "session_isolation")


def check_post_compaction(df: DataFrame, as_of, column: str = "data_quality_score") -> DataFrame:
    """Fails when quality is low on average, scattered, or low for many rows."""
    stats = since_days(df, as_of, 1).agg(
        F.avg(column).alias("mean"),
        F.stddev(column).alias("spread"),
        F.count_if(F.col(column) < 0.5).alias("low"),
        F.count(F.lit(1)).alias("all"),
    )
    bad = first_of(
        [
            (F.col("mean") < 0.7, 1),
            (F.col("spread") > 0.3, 1),
            (F.col("low") > F.col("all") * 0.2, 1),
        ],
        0,
    )
    return verdict(stats.select(bad.alias("observed")), "post_compaction_quality")


def partition_spread(
    df: DataFrame, as_of, columns: Sequence[str] = ("event_date", "space_type"), days: int = 7
) -> DataFrame:
    """Small (< 100 rows) and large (> 1,000,000 rows) partitions, and the mean size of an id."""
    parts = since_days(df, as_of, days).groupBy(*columns).agg(
        F.count(F.lit(1)).alias("n"), F.sum(F.octet_length("event_id")).alias("id_bytes")
    )
    return parts.agg(
        F.count_if(F.col("n") < 100).alias("small_partitions"),
        F.count_if(F.col("n") > 1_000_000).alias("large_partitions"),
        F.count(F.lit(1)).alias("total_partitions"),
        F.try_divide(F.sum("id_bytes").cast("double"), F.sum("n").cast("double")).alias("avg_id_size"),
    )


def check_partition_spread(df: DataFrame, as_of, **kwargs) -> DataFrame:
    return verdict(partition_spread(df, as_of, **kwargs), "large_partitions", "large_partitions")


def clustering_by_day(
    df: DataFrame, as_of, columns: Sequence[str] = ("session_id", "anonymous_id"), days: int = 7
) -> DataFrame:
    """Different key combinations per row and day; needs a scan of a file table for the files."""
    combos = F.concat_ws("_", *[F.col(c) for c in columns])
    return (
        since_days(df, as_of, days)
        .groupBy(F.to_date("event_timestamp").alias("event_day"))
        .agg(
            F.count_distinct(combos).alias("unique_combinations"),
            F.count(F.lit(1)).alias("total_records"),
            F.count_distinct("_metadata.file_path").alias("file_count"),
        )
    )


def check_clustering(df: DataFrame, as_of, limit: float = 0.8, **kwargs) -> DataFrame:
    """Mean share of different key combinations among the rows of a day."""
    share = F.col("unique_combinations").cast("double") / F.col("total_records")
    measured = clustering_by_day(df, as_of, **kwargs).agg(F.avg(share).alias("observed"))
    return verdict(measured, "clustering", error=limit)


def check_time_travel_growth(df: DataFrame, day, then) -> DataFrame:
    """Fails when a day holds as many rows as it held earlier: nothing arrived in between."""
    counts = df.where(F.col("event_date") == date_at(day)).agg(
        F.count(F.lit(1)).alias("now"),
        F.count_if(F.col("processed_timestamp") <= timestamp_at(then)).alias("then"),
    )
    measured = counts.select((F.col("now") == F.col("then")).cast("int").alias("observed"))
    return verdict(measured, "time_travel_growth")


def check_service_levels(completeness: DataFrame) -> DataFrame:
    """Limits on completeness, uniqueness and lag of one completeness row."""
    return verdicts(
        completeness,
        [
            ("completeness_pct", "completeness_pct", None, 99.9, True),
            ("uniqueness_pct", "uniqueness_pct", None, 100.0, True),
            ("lag_seconds", "lag_seconds", None, 3600, False),
        ],
    )


def check_session_consistency(
    df: DataFrame, max_users: int = 1, max_zones: int = 2, max_agents: int = 2
) -> DataFrame:
    """Sessions with more visitors, zones or agents than allowed."""
    sessions = df.groupBy("session_id").agg(
        F.count_distinct("anonymous_id").alias("users"),
        F.count_distinct("timezone").alias("zones"),
        F.count_distinct("user_agent").alias("agents"),
    )
    bad = (
        (F.col("users") > max_users)
        | (F.col("zones") > max_zones)
        | (F.col("agents") > max_agents)
    )
    return verdict(_failures(sessions, bad), "session_consistency")


# Name parts of columns that must not occur, and the shape of a mail address.
PRIVATE_NAMES = ("email", "phone", "address", "ssn", "credit_card")
MAIL_PATTERN = r"[A-Za-z0-9._%+-]+@[A-Za-z0-9.-]+\.[A-Za-z]{2,}"


def check_privacy(
    df: DataFrame, columns: Sequence[str] = ("anonymous_id", "user_id", "session_id")
) -> DataFrame:
    """Columns with a private name plus rows whose ids look like a mail address."""
    named = sum(any(word in c.lower() for word in PRIVATE_NAMES) for c in df.columns)
    shaped = F.lit(False)
    for column in columns:
        shaped = shaped | F.coalesce(F.col(column).rlike(MAIL_PATTERN), F.lit(False))
    measured = df.agg((F.count_if(shaped) + F.lit(named)).alias("observed"))
    return verdict(measured, "privacy")


def schema_changes(old: DataFrame, new: DataFrame) -> list[tuple[str, str]]:
    """Removed and re-typed columns from one table version to the next."""
    after = {f.name: f.dataType for f in new.schema.fields}
    changes = []
    for field in old.schema.fields:
        if field.name not in after:
            changes.append((field.name, "removed"))
        elif after[field.name] != field.dataType:
            changes.append((field.name, "type"))
    return changes


def check_schema_compatible(
    old: DataFrame,
    new: DataFrame,
    old_partitions: Sequence[str] = (),
    new_partitions: Sequence[str] = (),
) -> DataFrame:
    """Removed or re-typed columns, a change of the partition columns, and kept columns that lost their values.

    A kept column that holds values in ``old`` and none in ``new`` counts too: a renamed or wrongly mapped
    column keeps its name and type but not its content. Each table is read once, for counts.
    """
    broken = {name for name, _ in schema_changes(old, new)}
    kept = [f.name for f in old.schema.fields if f.name not in broken]
    filled = lambda df: df.agg(*[F.count(F.col(f"`{c}`")).alias(f"_{k}") for k, c in enumerate(kept)], F.count(F.lit(1)).alias("_n"))
    sides = filled(old).withColumn("_old", F.lit(True)).unionByName(filled(new).withColumn("_old", F.lit(False)))
    of = lambda name, is_old: F.max(F.when(F.col("_old") == is_old, F.col(name)))
    lost = [((of(f"_{k}", True) > 0) & (of(f"_{k}", False) == 0) & (of("_n", False) > 0)).cast("int") for k in range(len(kept))]
    found = F.lit(len(broken) + int(list(old_partitions) != list(new_partitions)))
    for part in lost:
        found = found + part
    measured = sides.agg(found.alias("observed"))
    return verdict(measured, "schema_compatible")


# Alert limits. metric, warn above, error above.
ALERT_LIMITS = (
    ("processing_delay_minutes", 15.0, 240.0),
    ("error_rate_pct", 1.0, 5.0),
    ("quality_shortfall", 0.0, None),
)
MIN_QUALITY = 0.8


def alert_metrics(events: DataFrame, as_of) -> DataFrame:
    """Delay of the latest processing, share of low-quality rows and shortfall of the mean score."""
    delay = F.unix_timestamp(timestamp_at(as_of)) - F.unix_timestamp("latest")
    low = F.count_if(F.col("data_quality_score") < 0.5)
    return events.agg(
        F.max("processed_timestamp").alias("latest"),
        (low * 100.0 / F.count(F.lit(1))).cast("double").alias("error_rate_pct"),
        F.avg("data_quality_score").alias("quality"),
    ).select(
        (delay / 60.0).alias("processing_delay_minutes"),
        "error_rate_pct",
        (F.lit(MIN_QUALITY) - F.col("quality")).alias("quality_shortfall"),
    )


def check_alerts(metrics: DataFrame) -> DataFrame:
    """One row per alert metric of a one-row table."""
    return verdicts(metrics, [(name, name, warn, error, False) for name, warn, error in ALERT_LIMITS])

"""Adapter from the plain ``events`` table (id, time, user, type, value, props) to the event model.

Each model column is a fixed rule over ``event_id``, ``user_id``, ``ts`` and ``k`` (the number in
``props``), so that every branch of every classifier is reached and any SQL engine can repeat it.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import file_system

PART_BYTES = 1024 * 1024  # some 60,000 rows, which take 60 MB as model events
DAY_MICROS = 86_400_000_000
HOUR_MICROS = 3_600_000_000


def _pick(index: Column, *values) -> Column:
    """The value at ``index`` of a constant array; NULL past the end."""
    return F.get(F.array(*[F.lit(v).cast("string") for v in values]), index.cast("int"))


def _unless(condition: Column, value: Column) -> Column:
    return F.when(~condition, value)


def source_events(spark: SparkSession, folder: str) -> DataFrame:
    """Typed, not yet enriched events of the model, one per row of ``events``."""
    return model_events(spread_rows(spark, f"{folder}/events.parquet"))


def spread_rows(spark: SparkSession, path: str, part_bytes: int = PART_BYTES) -> DataFrame:
    """A table of narrow rows, dealt to a task per ``part_bytes`` of its files before they are widened.

    A reader cannot split a row group, which may hold a million such rows. One smaller than a part is read as it is.
    """
    files, place = file_system(spark, path)
    parts = -(-files.getContentSummary(place).getLength() // part_bytes)
    rows = spark.read.parquet(path)
    return rows.repartition(max(parts, spark.sparkContext.defaultParallelism)) if parts > 1 else rows


def model_events(events: DataFrame) -> DataFrame:
    i, k, user = F.col("event_id"), F.col("k"), F.col("user_id")
    heavy = user % 3 == 0
    day = F.floor(F.col("ts_us") / DAY_MICROS) * DAY_MICROS
    base = (
        events.withColumn("ts_us", F.unix_micros(F.col("ts").cast("timestamp")))
        .withColumn("k", F.regexp_extract("props", "([0-9]+)", 1).cast("int"))
        .withColumn("u", F.when(heavy, user % 5).otherwise(100 + user % 37))
        .withColumn("m", F.when(heavy, F.lit(1)).otherwise(1 + (user % 37) % 6))
        # A day is squeezed into 24 minutes of one hour, so that gaps fall on both sides of 1, 10, 30 s.
        .withColumn(
            "event_us",
            day + (F.col("u") % 24) * HOUR_MICROS + F.floor((F.col("ts_us") - day) / 60),
        )
        .withColumn("event_timestamp", F.timestamp_micros(F.col("event_us")))
    )
    u = F.col("u")
    who = F.concat(F.lit("u"), u.cast("string"))
    date_text = F.date_format("event_timestamp", "yyyyMMdd")
    session = F.concat_ws("-", who, date_text, (i % F.col("m")).cast("string"))
    path = _pick(i % 4, "/viewer", "/viewer/x", "/home", "/a/viewer")
    no_space, no_turn = k % 7 == 0, k % 3 == 0
    number = F.struct(
        F.when(k != 31, (k * 3 % 151 - 75).cast("double")).alias("pitch"),
        (i * 37 % 721 - 360).cast("double").alias("yaw"),
        (60 + k % 60).cast("double").alias("hfov"),
    )

    def label(prefix: str, n: Column) -> Column:
        return F.concat(F.lit(prefix), n.cast("string"))

    return base.select(
        label("e", i).alias("event_id"),
        F.col("event_timestamp"),
        F.to_date("event_timestamp").alias("event_date"),
        F.hour("event_timestamp").alias("event_hour"),
        F.when(F.col("event_type").isin("view", "signup"), "page")
        .otherwise("track")
        .alias("event_type"),
        _pick(k % 4, "Room View Position", "Room View", "Toggle Fullscreen", None).alias("event_name"),
        _unless(k.isin(7, 8), who).alias("anonymous_id"),
        F.when(k % 4 == 0, label("auth", u)).alias("user_id"),
        _unless(k == 9, session).alias("session_id"),
        F.lit("web-viewer").alias("app_id"),
        F.lit("tour").alias("app_name"),
        _unless(k == 21, F.concat(F.lit("https://tours.example"), path)).alias("page_url"),
        path.alias("page_path"),
        label("Page ", i % 4).alias("page_title"),
        F.when(k % 2 == 0, label("?k=", k)).alias("url_search"),
        F.lit(None).cast("string").alias("url_hash"),
        _unless(no_space, label("sp", k % 12)).alias("space_id"),
        _unless(no_space, label("Space ", k % 12)).alias("space_name"),
        _pick(i % 5, "unit", "amenity", "common_area", "tour", "unknown").alias("space_type"),
        F.lit(None).cast("string").alias("space_token"),
        _unless(k % 9 % 7 == 0, label("room", k % 9)).alias("room_id"),
        _pick(
            k % 9,
            None,
            "Living Room",
            "Master Bedroom",
            "Kitchen",
            "Bathroom",
            "Patio",
            "Home Office",
            "Hallway",
            "family den",
        ).alias("room_name"),
        _unless(k % 5 == 0, label("Community ", k % 3)).alias("community"),
        _unless(k % 3 == 0, label("B", k % 4)).alias("building"),
        _unless(k % 2 == 0, label("fp", k % 6)).alias("floorplan"),
        _unless(no_turn, number).alias("coordinates"),
        F.when(k == 13, "Googlebot/2.1")
        .when(k == 14, "Site CRAWLER 1.0")
        .when(k == 17, F.lit(None).cast("string"))
        .when(k == 19, "")
        .otherwise(label("Mozilla/5.0 Browser/", k % 3))
        .alias("user_agent"),
        _pick(k % 3, "Linux", "Windows", "macOS").alias("os_name"),
        F.lit("en-US").alias("locale"),
        _pick(
            k % 10,
            "America/New_York",
            "America/Chicago",
            "America/Los_Angeles",
            "Europe/Paris",
            "Asia/Tokyo",
            "Pacific/Auckland",
            "Africa/Cairo",
            "America/Buenos_Aires",
            None,
            "UTC",
        ).alias("timezone"),
        _pick(
            i % 6,
            "",
            "https://search.example/q",
            "https://tours.example/home?from=mail",
            None,
            "https://tours.example/viewer",
            "",
        ).alias("referrer"),
        _pick(k % 6, "375", "767", "768", "1023", "1024", None).cast("int").alias("screen_width"),
        F.lit(800).alias("screen_height"),
        F.timestamp_micros(F.col("event_us") + (k % 48) * HOUR_MICROS).alias("processed_timestamp"),
        F.floor(F.col("event_us") / 1000).alias("seconds_utc_ts"),
        label("seq", i).alias("kinesis_sequence_number"),
        who.alias("kinesis_partition_key"),
        F.col("props").alias("properties_json"),
        label("doc", i).alias("mongodb_id"),
        F.col("event_timestamp").alias("created_at"),
        F.col("event_timestamp").alias("updated_at"),
    )

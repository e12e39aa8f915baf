"""Typed events from document texts.

A document is either the event itself or wraps it in ``eventData`` beside ``metadata`` and ids.
Values are read as text and typed with ``try_cast``, so a wrong type gives NULL and never a failure.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions import classify, keys
from ..functions.rules import first_of
from ..schemas import COORDINATES

# Names of the document fields.
DOCUMENT_FIELDS = ["_id", "createdAt", "updatedAt", "metadata", "eventData"]
EVENT_FIELDS = [
    "type",
    "event",
    "anonymousId",
    "userId",
    "sessionId",
    "appId",
    "app",
    "userAgent",
    "locale",
    "timezone",
    "referrer",
    "os",
    "page",
    "properties",
    "secondsUtcTS",
]
PAGE_FIELDS = [
    "url",
    "path",
    "title",
    "search",
    "hash",
    "spaceId",
    "spaceName",
    "spaceType",
    "spaceToken",
    "width",
    "height",
]
PLACE_FIELDS = ["roomId", "roomName", "community", "building", "floorplan", "coordinates"]
BAD_TIME = "bad_time"
FIRST_MILLIS, LAST_MILLIS = -62_135_596_800_000, 253_402_300_799_999  # the years 1 to 9999
BAD_CONTAINER = "bad_container"
CONTAINERS = ["eventData", "properties", "page", "os"]


def _texts(names: list[str]) -> T.StructType:
    return T.StructType([T.StructField(n, T.StringType()) for n in names])


def _event_fields() -> T.StructType:
    """The event's fields as text, but the time as it stands."""
    kinds = {"secondsUtcTS": T.VariantType()}
    return T.StructType([T.StructField(n, kinds.get(n, T.StringType())) for n in EVENT_FIELDS])


def _number(value: Column) -> Column:
    """A JSON number as a double; NULL for anything else."""
    return F.when(F.schema_of_variant(value).rlike("^(BIGINT|DOUBLE|DECIMAL|FLOAT)"), F.try_variant_get(value, "$", "double"))


def _object(text: Column) -> Column:
    return text.startswith("{")


def _either(*values: Column) -> Column:
    """First value that is neither missing nor the empty text."""
    return F.coalesce(*[F.nullif(v, F.lit("")) for v in values])


def _whole(text: Column) -> Column:
    return text.try_cast("double").try_cast("int")


def _document_time(value: Column) -> Column:
    """A text, or an object that holds it under ``$date``."""
    inner = F.when(_object(value), F.get_json_object(value, "$['$date']")).otherwise(value)
    return inner.try_cast("timestamp")


def normalize_event(
    decoded: DataFrame,
    layout: str = "batch",
    ingest_time: Column | None = None,
    keep: Sequence[str] = (),
) -> DataFrame:
    """Events in the columns of the event table, plus ``error`` for rejected documents.

    ``layout`` selects what differs between the flows: ``batch``, ``stream`` or ``edge``. It fixes the
    form of the event id; and a time of 0 counts as missing in ``batch`` only. A missing time becomes
    the ingest time; one outside the years 1 to 9999 is an error. ``keep`` names columns of the decoded
    record to keep beside the event.
    """
    if layout not in ("batch", "stream", "edge"):
        raise ValueError(f"unknown layout: {layout}")
    now = F.current_timestamp() if ingest_time is None else ingest_time
    doc, event, props, page = (F.col(c) for c in ("_doc", "_event", "_props", "_page"))

    # A flat document is parsed once, with the fields of the wrapper and of the event together; only a
    # wrapped event is parsed again. The time stays a variant, which tells a number from JSON text.
    flat = T.StructType(_texts(DOCUMENT_FIELDS).fields + _event_fields().fields)
    inner = F.from_json(F.col("_doc.eventData"), _event_fields())
    nested = (
        decoded.withColumn("_doc", F.from_json("payload", flat))
        .withColumn("_wrapped", doc["eventData"].isNotNull())
        .withColumn("_body", F.coalesce(doc["eventData"], F.col("payload")))
        .withColumn(
            "_event",
            F.when(F.col("_wrapped"), inner).otherwise(F.struct(*[doc[f].alias(f) for f in EVENT_FIELDS])),
        )
        .withColumn("_props", F.from_json(event["properties"], _texts(PAGE_FIELDS + PLACE_FIELDS)))
        .withColumn("_page", F.from_json(event["page"], _texts(PAGE_FIELDS)))
        .withColumn("_ms", _number(event["secondsUtcTS"]))
        .withColumn("_given", ~F.coalesce(F.is_variant_null(event["secondsUtcTS"]), F.lit(True)))
    )
    # The generator keeps the parsed values as they are, so that a filter on the result does not
    # parse every document once more.
    parsed = nested.select(F.explode(F.array(F.struct("*"))).alias("r")).select("r.*")

    has_page = event["page"].isNotNull()

    def on_page(name: str) -> Column:
        return F.when(has_page, page[name]).otherwise(props[name])

    def either_place(name: str) -> Column:
        return _either(props[name], on_page(name))

    def size(name: str) -> Column:
        return F.coalesce(
            F.nullif(_whole(on_page(name)), F.lit(0)), F.nullif(_whole(props[name]), F.lit(0))
        )

    # A number of any size or sign gives a time or is rejected; none fails the job.
    whole = F.col("_ms").try_cast("bigint")
    in_range = F.coalesce(whole.between(FIRST_MILLIS, LAST_MILLIS), F.lit(False))
    given = F.nullif(whole, F.lit(0)) if layout == "batch" else whole
    millis = F.coalesce(F.when(in_range, given), F.unix_millis(now))
    metadata = F.when(_object(doc["metadata"]), doc["metadata"])
    meta_visitor = F.get_json_object(metadata, "$.anonymousId")
    session, sequence = event["sessionId"], F.col("sequence_number")
    event_id = {
        "batch": lambda: keys.batch_event_id(session, millis, F.col("_body")),
        "stream": lambda: keys.stream_event_id(session, millis, sequence),
        "edge": lambda: keys.edge_event_id(session, meta_visitor, millis, sequence),
    }[layout]()

    wrong = F.lit(False)
    for name in CONTAINERS:
        holder = doc[name] if name == "eventData" else event[name]
        wrong = wrong | F.coalesce(~_object(holder), F.lit(False))
    error = F.coalesce(
        F.col("error"),
        first_of(
            [
                (wrong, BAD_CONTAINER),
                (F.col("_given") & ~in_range, BAD_TIME),
            ],
            None,
        ),
    )
    turned = props["coordinates"]
    is_turned = _object(turned) & ~turned.rlike(r"^\{\s*\}$")
    mongodb_id = F.when(
        F.col("_wrapped"), F.coalesce(F.get_json_object(doc["_id"], "$['$oid']"), F.lit(""))
    )

    def wrapped_time(name: str) -> Column:
        return F.when(F.col("_wrapped"), _document_time(doc[name]))

    return (
        parsed.withColumn("_millis", millis)
        .withColumn("event_timestamp", F.timestamp_millis("_millis"))
        .select(
            event_id.alias("event_id"),
            "event_timestamp",
            F.to_date("event_timestamp").alias("event_date"),
            F.hour("event_timestamp").alias("event_hour"),
            F.coalesce(event["type"], F.lit("unknown")).alias("event_type"),
            event["event"].alias("event_name"),
            _either(event["anonymousId"], meta_visitor).alias("anonymous_id"),
            event["userId"].alias("user_id"),
            session.alias("session_id"),
            _either(event["appId"], F.get_json_object(metadata, "$.appId")).alias("app_id"),
            event["app"].alias("app_name"),
            on_page("url").alias("page_url"),
            on_page("path").alias("page_path"),
            on_page("title").alias("page_title"),
            on_page("search").alias("url_search"),
            on_page("hash").alias("url_hash"),
            either_place("spaceId").alias("space_id"),
            either_place("spaceName").alias("space_name"),
            F.coalesce(either_place("spaceType"), F.lit("unknown")).alias("space_type"),
            either_place("spaceToken").alias("space_token"),
            props["roomId"].alias("room_id"),
            props["roomName"].alias("room_name"),
            props["community"].alias("community"),
            props["building"].alias("building"),
            props["floorplan"].alias("floorplan"),
            F.when(is_turned, F.from_json(turned, COORDINATES)).alias("coordinates"),
            event["userAgent"].alias("user_agent"),
            F.get_json_object(event["os"], "$.name").alias("os_name"),
            event["locale"].alias("locale"),
            event["timezone"].alias("timezone"),
            F.coalesce(event["referrer"], F.lit("")).alias("referrer"),
            size("width").alias("screen_width"),
            size("height").alias("screen_height"),
            now.alias("processed_timestamp"),
            F.col("_millis").alias("seconds_utc_ts"),
            sequence.alias("kinesis_sequence_number"),
            F.col("partition_key").alias("kinesis_partition_key"),
            F.coalesce(event["properties"], F.lit("{}")).alias("properties_json"),
            mongodb_id.alias("mongodb_id"),
            wrapped_time("createdAt").alias("created_at"),
            wrapped_time("updatedAt").alias("updated_at"),
            error.alias("error"),
            *keep,
        )
    )


def coordinates_json(coordinates: Column) -> Column:
    """JSON text of the viewer direction."""
    return F.to_json(coordinates)


def edge_enrichment(events: DataFrame) -> DataFrame:
    """Columns the edge flow adds to each normalised event."""
    return events.withColumns(
        {
            "device_type": classify.device_type_edge(F.col("screen_width").cast("string")),
            "has_space_context": classify.filled(F.col("space_id")),
            "is_virtual_tour_page": F.coalesce(
                classify.viewer_page_prefix(F.col("page_path")), F.lit(False)
            ),
            "data_quality_score": classify.additive_quality_edge(),
            "is_bot": classify.is_bot_edge(F.col("user_agent")),
        }
    )

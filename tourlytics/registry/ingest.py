"""Raw ingestion: lines derived from the events table, decoded and normalised again."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..operators.filters import timestamp_at, valid_events
from ..operators.sequencing import build_web_events, sequence_sessions
from ..jobs import Tables, load_history
from ..sources.normalize import coordinates_json, edge_enrichment, normalize_event
from ..sources.raw import (
    decode_lines,
    decode_records,
    ingest_counts,
    read_raw_lines,
    split_quarantine,
    to_envelopes,
)
from ..session import working_path
from . import data
from .catalog import query
from .oracle_base import chain, day, ts
from .result import plain

INGEST_TIME = "2024-02-01 00:00:00"


def documents(events: DataFrame) -> DataFrame:
    """Document text per event: even ids wrapped with a page object, odd ids flat.

    Some are damaged on purpose, by the number of the event: see the reasons in the oracle.
    """
    i = F.expr("substring(event_id, 2)").cast("bigint")
    page = [
        F.col("page_url").alias("url"),
        F.col("page_path").alias("path"),
        F.col("page_title").alias("title"),
        F.col("url_search").alias("search"),
        F.concat(F.lit("#h"), i % 7).alias("hash"),
        F.col("screen_width").alias("width"),
        F.col("screen_height").alias("height"),
    ]
    space = [
        F.col("space_id").alias("spaceId"),
        F.col("space_name").alias("spaceName"),
        F.col("space_type").alias("spaceType"),
        F.concat(F.lit("tok"), i % 5).alias("spaceToken"),
    ]
    place = [
        F.col("room_id").alias("roomId"),
        F.col("room_name").alias("roomName"),
        "community",
        "building",
        "floorplan",
        "coordinates",
    ]

    def event(visitor: Column, parts: list[Column]) -> Column:
        return F.struct(
            F.col("event_type").alias("type"),
            F.col("event_name").alias("event"),
            visitor.alias("anonymousId"),
            F.col("user_id").alias("userId"),
            F.col("session_id").alias("sessionId"),
            F.col("app_name").alias("app"),
            F.col("user_agent").alias("userAgent"),
            "locale",
            "timezone",
            "referrer",
            F.struct(F.col("os_name").alias("name")).alias("os"),
            F.col("seconds_utc_ts").alias("secondsUtcTS"),
            *parts,
        )

    flat = event(
        F.col("anonymous_id"),
        [F.struct(*page, *space, *place).alias("properties"), F.col("app_id").alias("appId")],
    )
    created = F.struct(
        F.date_format("created_at", "yyyy-MM-dd'T'HH:mm:ss.SSS'Z'").alias("$date")
    )
    nested = F.struct(
        F.struct(F.col("mongodb_id").alias("$oid")).alias("_id"),
        created.alias("createdAt"),
        F.date_format(F.col("created_at") + F.expr("INTERVAL 1 DAY"), "yyyy-MM-dd'T'HH:mm:ss.SSS'Z'").alias("updatedAt"),
        F.struct(F.col("anonymous_id").alias("anonymousId"), F.col("app_id").alias("appId")).alias(
            "metadata"
        ),
        event(
            F.lit(""),
            [F.struct(*page).alias("page"), F.struct(*space, *place).alias("properties")],
        ).alias("eventData"),
    )
    text = F.when(i % 2 == 0, F.to_json(nested)).otherwise(F.to_json(flat))
    damaged = (
        F.when(i % 40 == 0, F.expr("left(t, 20)"))
        .when(i % 40 == 2, F.lit("{}"))
        .when(i % 40 == 3, F.lit("[1, 2]"))
        .when(i % 40 == 4, F.regexp_replace("t", '"secondsUtcTS":([0-9]+)', '"secondsUtcTS":"$1"'))
        .when(i % 40 == 5, F.lit('{"sessionId": "s", "anonymousId": "a", "properties": "text"}'))
        # Times in nanoseconds, beyond any whole number, before 1970, and with a fraction.
        .when(i % 40 == 6, F.regexp_replace("t", '"secondsUtcTS":([0-9]+)', '"secondsUtcTS":$1000000'))
        .when(i % 40 == 7, F.regexp_replace("t", '"secondsUtcTS":[0-9]+', '"secondsUtcTS":1e30'))
        .when(i % 40 == 8, F.regexp_replace("t", '"secondsUtcTS":', '"secondsUtcTS":-'))
        .when(i % 40 == 11, F.regexp_replace("t", '"secondsUtcTS":([0-9]+)', '"secondsUtcTS":$1.75'))
        .otherwise(F.col("t"))
    )
    base = events.withColumn("i", i).withColumn("t", text).withColumn("payload", damaged)
    return base.select(
        "i",
        "payload",
        encoded(F.col("payload"), F.col("i")).alias("data"),
        F.col("kinesis_sequence_number").alias("sequence_number"),
        F.col("kinesis_partition_key").alias("partition_key"),
        F.col("event_timestamp").alias("at"),
    )


def encoded(payload: Column, i: Column) -> Column:
    """The record data of a document; some are damaged."""
    # base64() breaks its text into lines; a record is one line.
    text = F.regexp_replace(F.base64(F.encode(payload, "UTF-8")), "[\\r\\n]", "")
    return F.when(i % 40 == 1, F.lit("not base64!")).otherwise(text)


def raw_line_plan(spark, folder) -> DataFrame:
    """Nine of ten events in envelopes of nine, the others on lines of their own, two forms; blanks.

    Single lines and blanks are rebalanced by size, as the envelopes are by their shuffle. Written as they are read, each
    task that reads events would leave two small files, and the micro-batches, a few files each, would grow in number.
    """
    docs = documents(data.source(spark, folder))
    i = F.col("i")
    enveloped = to_envelopes(docs.where(i % 10 != 9), F.floor(i / 10), "i", encoded)
    single = docs.where(i % 10 == 9).select(
        F.when(i % 20 == 9, F.concat(F.lit('"'), F.col("data"), F.lit('"')))
        .otherwise(F.col("payload"))
        .alias("value")
    )
    blank = docs.where(i % 100 == 50).select(F.lit("  ").alias("value"))
    return enveloped.unionByName(single.hint("rebalance")).unionByName(blank.hint("rebalance"))


def raw_lines(spark, folder) -> DataFrame:
    """The archived line files, written once per application."""
    return read_raw_lines(spark, line_files(spark, folder))


def line_files(spark, folder) -> str:
    def write(path: str) -> None:
        raw_line_plan(spark, folder).write.text(path)

    return data.written_path(spark, folder, "raw_lines", write)


def ingest_time() -> Column:
    return F.lit(INGEST_TIME).cast("timestamp")


RAW = """
num AS (SELECT CAST(substr(event_id, 2) AS BIGINT) AS n, * REPLACE (
    if(CAST(substr(event_id, 2) AS BIGINT) % 40 = 8, -seconds_utc_ts, seconds_utc_ts) AS seconds_utc_ts)
  FROM src),
good AS (SELECT *, make_timestamp(seconds_utc_ts * 1000) AS tm,
    if(n % 10 = 9, NULL, kinesis_sequence_number) AS sq,
    if(n % 10 = 9, NULL, kinesis_partition_key) AS pk
  FROM num WHERE n % 40 > 7)"""

_COMMON = f"""{ts("tm", "event_timestamp")}, {day("tm", "event_date")},
CAST(hour(tm) AS BIGINT) AS event_hour, event_type, event_name, anonymous_id, user_id, session_id,
app_id, app_name, page_url, page_path, page_title, url_search, space_id, space_name, space_type,
room_id, room_name, community, building, floorplan, pitch, yaw, hfov, user_agent, os_name, locale,
timezone, coalesce(referrer, '') AS referrer, screen_width, screen_height, seconds_utc_ts,
sq AS kinesis_sequence_number, pk AS kinesis_partition_key,
if(n % 2 = 0, mongodb_id, NULL) AS mongodb_id,
if(n % 2 = 0, strftime(make_timestamp(abs(seconds_utc_ts) * 1000), '%Y-%m-%d %H:%M:%S.%f'), NULL)
  AS created_at,
'2024-02-01 00:00:00.000000' AS processed_timestamp"""
_DROPPED = ("url_hash", "space_token", "updated_at", "properties_json", "error")  # see normalized_raw_fields


def _normalized(spark, folder, layout: str) -> DataFrame:
    decoded = decode_lines(raw_lines(spark, folder))
    return normalize_event(decoded, layout, ingest_time()).where(F.col("error").isNull())


@query(
    "decoded_payloads",
    chain("src", RAW)
    + """SELECT coalesce(kinesis_sequence_number, '-') AS sequence_number,
coalesce(kinesis_partition_key, '-') AS partition_key FROM num
WHERE n % 10 <> 9 AND n % 40 NOT IN (0, 1, 2, 3)""",
)
def payloads(spark, folder):
    good, _ = split_quarantine(decode_lines(raw_lines(spark, folder)))
    return good.where(F.col("sequence_number").isNotNull()).select("sequence_number", "partition_key")


@query(
    "quarantined_records",
    chain("src", RAW)
    + """SELECT kinesis_sequence_number AS sequence_number,
CASE n % 40 WHEN 0 THEN 'bad_json' WHEN 1 THEN 'bad_base64' WHEN 2 THEN 'empty_document'
  ELSE 'not_an_object' END AS error FROM num WHERE n % 40 < 4""",
)
def quarantined(spark, folder):
    _, bad = split_quarantine(decode_lines(raw_lines(spark, folder)))
    return bad.select("sequence_number", "error")


@query(
    "ingest_counts",
    chain("src", RAW)
    + """SELECT CASE n % 40 WHEN 0 THEN 'bad_json' WHEN 1 THEN 'bad_base64' WHEN 2 THEN
'empty_document' WHEN 3 THEN 'not_an_object' WHEN 4 THEN 'bad_time' WHEN 5 THEN 'bad_container'
WHEN 6 THEN 'bad_time' WHEN 7 THEN 'bad_time'
ELSE 'processed' END AS outcome, count(*) AS records FROM num GROUP BY 1""",
)
def counts(spark, folder):
    decoded = decode_lines(raw_lines(spark, folder))
    return ingest_counts(normalize_event(decoded, "batch", ingest_time()))


@query(
    "normalized_stream_events",
    chain("src", RAW)
    + f"""SELECT coalesce(session_id, 'unknown') || '_' || seconds_utc_ts || '_' || coalesce(sq, '')
AS event_id, {_COMMON} FROM good""",
)
def stream_layout(spark, folder):
    return plain(_normalized(spark, folder, "stream").drop(*_DROPPED))


@query(
    "normalized_batch_events",
    chain("src", RAW)
    + f"""SELECT coalesce(session_id, 'unknown') || '_' || seconds_utc_ts AS id_head, {_COMMON}
FROM good""",
)
def batch_layout(spark, folder):
    """Without the hash at the end of the id, which SQL engines compute differently."""
    events = _normalized(spark, folder, "batch")
    head = F.regexp_replace("event_id", "_[0-9]+$", "").alias("id_head")
    return plain(events.select(head, *[c for c in events.columns if c != "event_id"]).drop(*_DROPPED))


@query(
    "normalized_raw_fields",
    chain("src", RAW)
    + """SELECT seconds_utc_ts, '#h' || (n % 7) AS url_hash, 'tok' || (n % 5) AS space_token,
if(n % 2 = 0, strftime(make_timestamp(abs(seconds_utc_ts) * 1000) + INTERVAL 1 DAY, '%Y-%m-%d %H:%M:%S.%f'), NULL)
  AS updated_at, space_id AS json_space_id, room_name AS json_room_name, CAST(pitch AS VARCHAR) AS json_pitch,
CAST(hfov AS VARCHAR) AS coordinates_hfov, (regexp_extract(session_id, '.*') IS NOT NULL) AS has_session,
true AS id_is_stable FROM good""",
)
def raw_fields(spark, folder):
    """What the typed columns do not show: the properties as they came, and a batch id that a second run repeats."""
    events = _normalized(spark, folder, "batch")
    again = _normalized(spark, folder, "batch").select(F.col("event_id").alias("again")).distinct()
    of = lambda path: F.get_json_object("properties_json", path)
    return plain(
        events.join(again, F.col("event_id") == F.col("again"), "left").select(
            "seconds_utc_ts", "url_hash", "space_token", "updated_at", of("$.spaceId").alias("json_space_id"),
            of("$.roomName").alias("json_room_name"), of("$.coordinates.pitch").alias("json_pitch"),
            F.get_json_object(coordinates_json(F.col("coordinates")), "$.hfov").alias("coordinates_hfov"),
            F.col("session_id").isNotNull().alias("has_session"), F.col("again").isNotNull().alias("id_is_stable"),
        )
    )


def _archive(spark, folder, name: str, wanted: Column) -> str:
    """Compressed line files of some of the documents, as in ``raw_line_plan``."""
    docs = documents(data.source(spark, folder)).where(wanted)
    i = F.col("i")
    enveloped = to_envelopes(docs.where(i % 10 != 9), F.floor(i / 10), "i", encoded)
    single = docs.where(i % 10 == 9).select(F.when(i % 20 == 9, F.concat(F.lit('"'), F.col("data"), F.lit('"'))).otherwise(F.col("payload")).alias("value"))
    return data.written_path(spark, folder, name, lambda path: enveloped.unionByName(single).write.text(path, compression="gzip"))


def repeated_load(spark, folder) -> Tables:
    """An archive loaded twice, then one that overlaps it and holds all the first one lacks."""
    i = F.col("i")
    first = _archive(spark, folder, "archive_1", i % 3 != 0)
    second = _archive(spark, folder, "archive_2", (i % 3 == 0) | (i % 2 == 0))

    def load(root: str) -> None:
        for archive in (first, first, second):
            load_history(spark, archive, Tables(root), ingest_time=ingest_time())

    return Tables(data.written_path(spark, folder, "repeated_load", load))


LOADED = """
loaded AS (SELECT * FROM good WHERE session_id IS NOT NULL AND coalesce(anonymous_id, user_id) IS NOT NULL)"""


@query(
    "repeated_load",
    chain("src", RAW, LOADED)
    + f"""SELECT session_id, seconds_utc_ts, row_number() OVER (PARTITION BY session_id ORDER BY tm) AS place,
count(*) OVER (PARTITION BY session_id) AS whole FROM loaded""",
)
def loaded(spark, folder):
    """Ids stay unique and sessions whole, whatever is loaded again."""
    landed = repeated_load(spark, folder).read(spark, "landed_events")
    valid = sequence_sessions(valid_events(landed, allow_user_id=True))
    sizes = valid.groupBy("session_id").agg(F.count_distinct("event_id").alias("whole"))
    return plain(valid.join(sizes, "session_id").select("session_id", "seconds_utc_ts", F.col("session_event_sequence").alias("place"), "whole"))


@query(
    "repeated_load_sessions",
    chain("src", RAW, LOADED)
    + f"""SELECT session_id, max(place) AS last_place, count(*) AS events FROM (SELECT *,
  row_number() OVER w AS place, CAST(coalesce(floor(epoch(lead(tm) OVER w)) - floor(epoch(tm)), 30) AS BIGINT) AS stay
  FROM loaded WINDOW w AS (PARTITION BY session_id ORDER BY tm))
WHERE stay >= 1 AND NOT coalesce(regexp_matches(lower(user_agent), 'bot|crawler|spider|scraper'), false)
GROUP BY session_id""",
)
def loaded_sessions(spark, folder):
    events = repeated_load(spark, folder).read(spark, "web_events")
    return plain(events.groupBy("session_id").agg(F.max("session_event_sequence").alias("last_place"), F.count_distinct("event_id").alias("events")))


@query(
    "repeated_load_rejects",
    chain("src", RAW)
    + """SELECT CASE n % 40 WHEN 0 THEN 'bad_json' WHEN 1 THEN 'bad_base64' WHEN 2 THEN 'empty_document'
WHEN 3 THEN 'not_an_object' WHEN 5 THEN 'bad_container' ELSE 'bad_time' END AS error, count(*) AS records
FROM num WHERE n % 40 < 8 GROUP BY 1""",
)
def loaded_rejects(spark, folder):
    """Rejects of both archives, once each."""
    rejects = repeated_load(spark, folder).read(spark, "rejected_records")
    return rejects.groupBy("error").agg(F.count(F.lit(1)).alias("records"))


NEXT_ARCHIVE = "2024-01-20 12:00:00"


def later_load(spark, folder) -> tuple[Tables, DataFrame]:
    """The archive of all documents up to a moment, then that of the later ones; the files of the event table between."""
    later = F.col("at") >= timestamp_at(NEXT_ARCHIVE)
    archives = [_archive(spark, folder, f"archive_{name}", wanted) for name, wanted in (("early", ~later), ("late", later))]

    def load(root: str) -> None:
        tables = Tables(root)
        load_history(spark, archives[0], tables, ingest_time=ingest_time())
        _files(spark, tables).write.parquet(tables.path("files_before"))
        load_history(spark, archives[1], tables, ingest_time=ingest_time())

    tables = Tables(data.written_path(spark, folder, "later_load", load))
    return tables, tables.read(spark, "files_before")


def _files(spark, tables: Tables) -> DataFrame:
    files = spark.read.format("binaryFile").option("pathGlobFilter", "*.parquet").load(tables.path("web_events"))
    return files.select("event_date", "space_type", "path")


SEQUENCED = """
sequenced AS (SELECT *, row_number() OVER w AS place,
    CAST(coalesce(floor(epoch(lead(tm) OVER w)) - floor(epoch(tm)), 30) AS BIGINT) AS stay
  FROM loaded WINDOW w AS (PARTITION BY session_id ORDER BY tm)),
cleaned AS (SELECT * FROM sequenced WHERE stay >= 1
  AND NOT coalesce(regexp_matches(lower(user_agent), 'bot|crawler|spider|scraper'), false))"""


@query(
    "later_load_partitions",
    chain("src", RAW, LOADED, SEQUENCED)
    + f"""SELECT {day("CAST(tm AS DATE)", "event_date")}, space_type,
bool_or(touched) AS rewritten FROM (
  SELECT tm, space_type, session_id IN (SELECT session_id FROM loaded WHERE event_timestamp >= TIMESTAMP '{NEXT_ARCHIVE}') AS touched
  FROM loaded)
WHERE (CAST(tm AS DATE), space_type) IN (SELECT CAST(tm AS DATE), space_type FROM cleaned) GROUP BY ALL""",
)
def later_partitions(spark, folder):
    """A second archive gives new files to the partitions that hold a session of it, and to no others."""
    tables, before = later_load(spark, folder)
    keys = ["event_date", "space_type", "path"]
    both = before.select(*keys, F.lit(1).alias("old")).join(_files(spark, tables).select(*keys, F.lit(1).alias("new")), keys, "full")
    changed = F.bool_or(F.col("old").isNull() | F.col("new").isNull()).alias("rewritten")
    return plain(both.groupBy("event_date", "space_type").agg(changed))


@query(
    "later_load_events",
    chain("src", RAW, LOADED, SEQUENCED)
    + "SELECT session_id, seconds_utc_ts, place, stay FROM cleaned",
)
def later_events(spark, folder):
    """The event table after both archives is that of one load of all."""
    events = later_load(spark, folder)[0].read(spark, "web_events")
    place, stay = F.col("session_event_sequence").alias("place"), F.col("time_on_page_seconds").alias("stay")
    return plain(events.select("session_id", "seconds_utc_ts", place, stay))


@query(
    "later_load_sessions",
    chain("src", RAW, LOADED, SEQUENCED)
    + f"""SELECT session_id, anonymous_id, user_id, {day("CAST(tm AS DATE)", "event_date")},
CAST(sum(stay) AS BIGINT) AS total_time_on_site_seconds, count(*) AS total_events FROM cleaned GROUP BY session_id, anonymous_id, user_id, CAST(tm AS DATE)""",
)
def later_sessions(spark, folder):
    rows = later_load(spark, folder)[0].read(spark, "session_metrics_v2")
    return plain(rows.select("session_id", "anonymous_id", "user_id", "event_date", "total_time_on_site_seconds", "total_events"))


@query(
    "record_ingest",
    chain("src", RAW)
    + f"""SELECT seconds_utc_ts, session_id, kinesis_sequence_number FROM (
  SELECT * REPLACE (num.kinesis_sequence_number AS kinesis_sequence_number) FROM num
  WHERE n % 40 > 7)""",
)
def record_ingest(spark, folder):
    """The same documents as single records of a stream source, by columns."""
    docs = documents(data.source(spark, folder))
    events = normalize_event(decode_records(docs.select("sequence_number", "partition_key", "data")), "stream", ingest_time())
    good = events.where(F.col("error").isNull())
    return plain(good.select("seconds_utc_ts", "session_id", "kinesis_sequence_number"))


@query(
    "edge_events",
    chain("src", RAW)
    + f"""SELECT coalesce(session_id, if(n % 2 = 0, anonymous_id, NULL), 'unknown') || '_'
|| coalesce(sq, '') || '_' || seconds_utc_ts AS event_id, {_COMMON},
CASE WHEN coalesce(screen_width, 0) = 0 THEN 'unknown' WHEN screen_width < 768 THEN 'mobile'
  WHEN screen_width < 1024 THEN 'tablet' ELSE 'desktop' END AS device_type,
space_id IS NOT NULL AS has_space_context, page_path LIKE '/viewer%' AS is_virtual_tour_page,
CAST(round(least(1, greatest(0, 1 - if(session_id IS NULL, 0.3, 0)
  - if(coalesce(anonymous_id, user_id) IS NULL, 0.3, 0) - if(coalesce(user_agent, '') = '', 0.2, 0)
  - if(space_id IS NULL AND page_path LIKE '/viewer%', 0.1, 0)
  + if(room_id IS NOT NULL AND room_name IS NOT NULL, 0.1, 0) + if(has_coordinates, 0.05, 0))), 2)
  AS DOUBLE) AS data_quality_score,
coalesce(user_agent, '') = '' OR regexp_matches(lower(user_agent),
  'bot|crawler|spider|scraper|automated') AS is_bot FROM good""",
)
def edge_layout(spark, folder):
    return plain(edge_enrichment(_normalized(spark, folder, "edge")).drop(*_DROPPED))


@query(
    "raw_to_web_events",
    chain(
        "src",
        RAW,
        """seqr AS (SELECT *, row_number() OVER w AS sq_no, CAST(coalesce(floor(epoch(lead(tm) OVER w))
             - floor(epoch(tm)), 30) AS BIGINT) AS stay FROM good
           WHERE session_id IS NOT NULL AND coalesce(anonymous_id, user_id) IS NOT NULL
           WINDOW w AS (PARTITION BY session_id ORDER BY tm,
             session_id || '_' || seconds_utc_ts || '_' || coalesce(sq, '')))""",
    )
    + f"""SELECT session_id, sq_no AS session_event_sequence, stay AS time_on_page_seconds,
{ts("tm", "event_timestamp")} FROM seqr WHERE stay >= 1
AND NOT coalesce(regexp_matches(lower(user_agent), 'bot|crawler|spider|scraper'), false)""",
)
def raw_to_table(spark, folder):
    """The whole batch flow: lines, documents, events, sequence, score, clean table."""
    events = valid_events(_normalized(spark, folder, "stream"), allow_user_id=True)
    landed = working_path(spark, "valid_events")
    events.write.parquet(landed)  # the sequence reads them twice, which would decode every document twice
    valid = spark.read.schema(events.schema).parquet(landed)
    return plain(
        build_web_events(valid).select(
            "session_id", "session_event_sequence", "time_on_page_seconds", "event_timestamp"
        )
    )

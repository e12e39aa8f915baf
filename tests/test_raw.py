"""Line forms, malformed input, and the two document layouts."""

import base64
import datetime as dt
import json

import pytest
from pyspark.sql import functions as F

from tourlytics.operators.filters import valid_events
from tourlytics.sources.normalize import coordinates_json, edge_enrichment, normalize_event
from tourlytics.sources.raw import decode_lines, ingest_counts, read_raw_lines, split_quarantine

MILLIS = 1706012345678
FLAT = {
    "type": "page",
    "anonymousId": "visitor-17",
    "sessionId": "visit-4",
    "secondsUtcTS": MILLIS,
    "properties": {
        "url": "https://x.example/viewer",
        "path": "/viewer",
        "title": "T",
        "spaceId": "sp1",
        "spaceType": "unit",
        "width": 1920,
        "height": 1080,
    },
    "os": {"name": "Windows"},
    "referrer": "https://r.example",
    "timezone": "Europe/Lisbon",
    "userAgent": "Mozilla/5.0",
    "appId": "web",
}
NESTED = {
    "_id": {"$oid": "65b1"},
    "createdAt": {"$date": "2024-01-01T00:00:00.000Z"},
    "updatedAt": "2024-01-02T00:00:00.000Z",
    "metadata": {"anonymousId": "meta-user", "appId": "web-viewer"},
    "eventData": {
        "type": "track",
        "event": "Room View Position",
        "sessionId": "s-1",
        "anonymousId": "",
        "userId": "u-9",
        "secondsUtcTS": MILLIS,
        "page": {"path": "/viewer/a", "spaceId": "sp-page", "width": 0},
        "properties": {
            "spaceId": "",
            "path": "/other",
            "width": 375,
            "roomId": "r1",
            "roomName": "Living Room",
            "community": "C",
            "coordinates": {"pitch": 7.77, "yaw": -121.71, "hfov": 123},
        },
    },
}


def b64(text):
    data = text.encode() if isinstance(text, str) else text
    return base64.b64encode(data).decode()


def record(data, seq="1", key="k"):
    return {"kinesis": {"data": data, "sequenceNumber": seq, "partitionKey": key}}


def lines(spark, *values):
    return spark.createDataFrame([(v,) for v in values], "value string")


def decoded(spark, *values):
    return decode_lines(lines(spark, *values))


def documents(spark, *docs):
    texts = [d if isinstance(d, str) else json.dumps(d) for d in docs]
    records = [record(b64(t), str(i)) for i, t in enumerate(texts)]
    return decoded(spark, json.dumps({"Records": records}))


def events(spark, *docs, layout="batch", **kw):
    return normalize_event(documents(spark, *docs), layout, **kw)


def test_line_forms(spark, tmp_path):
    flat, nested = json.dumps(FLAT), json.dumps(NESTED)
    envelope = json.dumps({"Records": [record(b64(flat), "11"), record(b64(nested), "12", "p2")]})
    path = tmp_path / "in.txt"
    path.write_text("\n".join([envelope, flat, json.dumps(b64(nested)), "", "   "]) + "\n")
    rows = decode_lines(read_raw_lines(spark, str(path))).collect()
    assert sorted((r["sequence_number"] or "", r["partition_key"] or "", r["error"]) for r in rows) == [
        ("", "", None),
        ("", "", None),
        ("11", "k", None),
        ("12", "p2", None),
    ]
    assert sorted(json.loads(r["payload"])["sessionId"] if "sessionId" in json.loads(r["payload"]) else "-"
                  for r in rows) == ["-", "-", "visit-4", "visit-4"]


@pytest.mark.parametrize(
    "line, reason",
    [
        ('{"unclosed": 1', "bad_json"),
        ("plain text", "bad_json"),
        ('{"a": 1,, "b": 2}', "bad_json"),
        ("{}", "empty_document"),
        ("{ }", "empty_document"),
        ("null", "not_an_object"),
        ("[1, 2]", "not_an_object"),
        ("42", "not_an_object"),
        ('"@@@"', "bad_base64"),
        (json.dumps(b64("not json")), "bad_json"),
        (json.dumps(b64(b"\xff\xfe\x00")), "bad_utf8"),
        (json.dumps({"Records": [record("%%%")]}), "bad_base64"),
        (json.dumps({"Records": [record(b64("{broken"))]}), "bad_json"),
        (json.dumps({"Records": [{"other": 1}]}), "no_data"),
    ],
)
def test_bad_lines(spark, line, reason):
    assert [r["error"] for r in decoded(spark, line).collect()] == [reason]


def test_bad_records_leave_their_siblings(spark):
    good = record(b64(json.dumps(FLAT)), "7")
    mixed = json.dumps({"Records": [good, 5, None, {"kinesis": "text"}, record("%%"), good]})
    rows = decoded(spark, mixed)
    assert {r["outcome"]: r["records"] for r in ingest_counts(rows).collect()} == {
        "processed": 2,
        "no_data": 2,
        "bad_base64": 1,
    }
    ok, bad = split_quarantine(rows)
    assert (ok.count(), bad.count()) == (2, 3)


def test_records_that_are_no_list_are_an_event(spark):
    rows = decoded(spark, json.dumps({**FLAT, "Records": "text"})).collect()
    assert [r["error"] for r in rows] == [None]


def test_flat_layout(spark):
    row = events(spark, FLAT).first()
    assert row["error"] is None and row["event_id"].startswith(f"visit-4_{MILLIS}_")
    assert row["event_timestamp"] == dt.datetime(2024, 1, 23, 12, 19, 5, 678000)
    assert (row["event_date"], row["event_hour"]) == (dt.date(2024, 1, 23), 12)
    assert (row["page_path"], row["screen_width"], row["os_name"]) == ("/viewer", 1920, "Windows")
    assert row["mongodb_id"] is None and row["created_at"] is None and row["coordinates"] is None
    assert json.loads(row["properties_json"])["spaceId"] == "sp1"


def test_nested_layout(spark):
    row = events(spark, NESTED).first()
    assert (row["anonymous_id"], row["user_id"], row["app_id"]) == ("meta-user", "u-9", "web-viewer")
    assert (row["page_path"], row["space_id"], row["space_type"]) == ("/viewer/a", "sp-page", "unknown")
    assert row["screen_width"] == 375  # a width of 0 counts as missing
    assert row["page_url"] is None  # the page object is taken as a whole
    assert row["coordinates"].asDict() == {"pitch": 7.77, "yaw": -121.71, "hfov": 123.0}
    assert row["mongodb_id"] == "65b1"
    assert row["created_at"] == dt.datetime(2024, 1, 1) and row["updated_at"] == dt.datetime(2024, 1, 2)
    assert row["referrer"] == "" and row["event_name"] == "Room View Position"
    text = events(spark, NESTED).select(coordinates_json(F.col("coordinates"))).first()[0]
    assert json.loads(text) == {"pitch": 7.77, "yaw": -121.71, "hfov": 123.0}


def test_ids_of_the_layouts(spark):
    no_session = {**FLAT, "sessionId": None}
    ids = [r["event_id"] for r in events(spark, FLAT, no_session, layout="stream").collect()]
    assert ids == [f"visit-4_{MILLIS}_0", f"unknown_{MILLIS}_1"]
    empty = {**NESTED, "eventData": {**NESTED["eventData"], "sessionId": ""}}
    ids = [r["event_id"] for r in events(spark, NESTED, empty, no_session, layout="edge").collect()]
    assert ids == [f"s-1_0_{MILLIS}", f"meta-user_1_{MILLIS}", f"unknown_2_{MILLIS}"]
    again = [events(spark, FLAT).first()["event_id"] for _ in range(2)]
    assert again[0] == again[1]


def test_missing_and_zero_time(spark):
    now = F.lit("2024-02-01 00:00:00").cast("timestamp")
    missing = {k: v for k, v in FLAT.items() if k != "secondsUtcTS"}
    zero = {**FLAT, "secondsUtcTS": 0}
    batch = events(spark, missing, zero, ingest_time=now).collect()
    assert {r["event_timestamp"] for r in batch} == {dt.datetime(2024, 2, 1)}
    stream = events(spark, missing, zero, layout="stream", ingest_time=now).collect()
    assert [r["event_timestamp"] for r in stream] == [dt.datetime(2024, 2, 1), dt.datetime(1970, 1, 1)]


@pytest.mark.parametrize(
    "change, error",
    [
        ({"secondsUtcTS": "1706012345678"}, "bad_time"),
        ({"secondsUtcTS": "soon"}, "bad_time"),
        ({"secondsUtcTS": MILLIS * 1_000_000}, "bad_time"),
        ({"secondsUtcTS": 1e30}, "bad_time"),
        ({"secondsUtcTS": -1e300}, "bad_time"),
        ({"secondsUtcTS": 10**400}, "bad_time"),
        ({"secondsUtcTS": 253_402_300_800_000}, "bad_time"),
        ({"secondsUtcTS": 253_402_300_799_999}, None),
        ({"secondsUtcTS": -62_135_500_000_000}, None),
        ({"secondsUtcTS": -62_135_596_800_001}, "bad_time"),
        ({"secondsUtcTS": -5}, None),
        ({"secondsUtcTS": 12.75}, None),
        ({"properties": "text"}, "bad_container"),
        ({"properties": [1]}, "bad_container"),
        ({"page": "text"}, "bad_container"),
        ({"os": "Linux"}, "bad_container"),
        ({"eventData": "text"}, "bad_container"),
        ({"properties": {"width": "wide", "coordinates": {}}}, None),
        ({"properties": {"width": "1920.5", "coordinates": "none"}}, None),
        ({"unknown": {"deep": [1, {"x": 2}]}}, None),
    ],
)
def test_malformed_documents(spark, change, error):
    row = events(spark, {**FLAT, **change}).first()
    assert row["error"] == error
    if error is None:
        assert row["coordinates"] is None


def test_missing_fields_and_validity(spark):
    docs = [
        {"sessionId": "s", "secondsUtcTS": MILLIS},
        {"anonymousId": "a", "secondsUtcTS": MILLIS},
        {"sessionId": "s", "userId": "u", "secondsUtcTS": MILLIS},
        {"sessionId": "s", "anonymousId": "a", "secondsUtcTS": MILLIS},
    ]
    df = events(spark, *docs)
    assert valid_events(df).count() == 1 and valid_events(df, allow_user_id=True).count() == 2
    row = df.first()
    assert (row["event_type"], row["space_type"], row["referrer"]) == ("unknown", "unknown", "")


def test_unicode_and_many_keys(spark):
    many = {f"key_{i}": f"value {i}" for i in range(1000)}
    doc = {**FLAT, "properties": {**many, "spaceName": "Büro 東京 🏠", "spaceId": "z"}}
    row = events(spark, doc).first()
    assert row["space_name"] == "Büro 東京 🏠" and len(json.loads(row["properties_json"])) == 1002


def test_edge_enrichment(spark):
    rows = edge_enrichment(events(spark, FLAT, {**FLAT, "userAgent": ""}, layout="edge")).collect()
    assert [r["device_type"] for r in rows] == ["desktop", "desktop"]
    assert [r["data_quality_score"] for r in rows] == [1.0, 0.8]
    assert [r["is_bot"] for r in rows] == [False, True]
    assert all(r["has_space_context"] and r["is_virtual_tour_page"] for r in rows)


def test_single_records_of_a_stream_source(spark):
    from tourlytics.sources.raw import decode_records

    rows = [(b64(json.dumps(FLAT)), "1", "k"), ("%%%", "2", "k"), (None, "3", "k"), (b64("x"), "4", "k")]
    df = spark.createDataFrame(rows, "data string, sequence_number string, partition_key string")
    found = {r["sequence_number"]: r["error"] for r in decode_records(df).collect()}
    assert found == {"1": None, "2": "bad_base64", "3": "no_data", "4": "bad_json"}
    event = normalize_event(decode_records(df.limit(1)), "stream").first()
    assert event["event_id"] == f"visit-4_{MILLIS}_1"

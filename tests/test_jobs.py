"""The whole flow on small files: lines, tables, marts, maintenance, report."""

import json

import pytest
from pyspark.sql import functions as F

from test_raw import FLAT, NESTED, b64, record
from tourlytics import jobs
from tourlytics.sources import tables as sources
from tourlytics.jobs import Tables, load_history, maintain, rebuild_sessions, refresh_marts, report_day
from tourlytics.schemas import SPATIAL_ANALYTICS, WEB_EVENTS_ENRICHED

START = 1_705_300_000_000  # 2024-01-15 06:26:40 UTC


def write_lines(path):
    lines = ["broken {", ""]
    for s in range(6):
        docs = []
        for i in range(8):
            flat = {**FLAT, "sessionId": f"s{s}", "anonymousId": f"u{s % 3}", "secondsUtcTS": START + 40_000 * i}
            event = {**NESTED["eventData"], "userAgent": "Mozilla", "sessionId": f"s{s}"}
            event["secondsUtcTS"] = START + 40_000 * i + 20_000
            docs += [flat, {**NESTED, "metadata": {"anonymousId": f"u{s % 3}"}, "eventData": event}]
        lines.append(json.dumps({"Records": [record(b64(json.dumps(d)), f"{s}-{i}") for i, d in enumerate(docs)]}))
    path.mkdir()
    (path / "a.txt").write_text("\n".join(lines))


def test_from_lines_to_report(spark, tmp_path):
    write_lines(tmp_path / "lines")
    tables = Tables(str(tmp_path / "tables"))
    processed = F.lit("2024-01-15 12:00:00").cast("timestamp")
    load_history(spark, str(tmp_path / "lines"), tables, ingest_time=processed)
    events = tables.read(spark, "web_events")
    assert events.count() == 96 and set(events.columns) == set(WEB_EVENTS_ENRICHED.names)
    assert tables.read(spark, "rejected_records").count() == 1
    assert {r["session_event_sequence"] for r in events.where("session_id = 's1'").collect()} == set(
        range(1, 17)
    )
    # a user id on every second event splits the session rows by user
    assert tables.read(spark, "session_metrics_v2").count() == 12

    refresh_marts(spark, tables, "2024-01-16 00:00:00", "2024-01-15 00:00:00", "2024-01-01", min_segment=1, slice_seconds=60)
    fact = tables.read(spark, "fct_web_events")
    assert fact.count() == 96 and {"room_category", "coordinates", "user_id"} <= set(fact.columns)
    spatial = tables.read(spark, "spatial_analytics")
    assert set(spatial.columns) == set(SPATIAL_ANALYTICS.names)
    assert {r[0] for r in spatial.select("analysis_level").distinct().collect()} == {
        "community_level", "room_level", "navigation_behavior", "user_type_analysis",
    }
    compared = tables.read(spark, "time_travel_analysis").collect()
    assert {r["space_type"] for r in compared} == {"unit", "unknown", "all_spaces"}
    assert all(r["historical_events"] == 0 and r["data_freshness_status"] in ("data_growing", "summary")
               for r in compared)
    assert sum(r["session_count"] for r in tables.read(spark, "user_journey_analysis").collect()) == 6

    maintain(spark, tables, "2024-01-01")
    assert tables.read(spark, "web_events").count() == 96
    report = spark.read.parquet(report_day(spark, tables, "2024-01-15"))
    assert report.agg(F.sum("total_sessions")).first()[0] == 6


def lines_of(path, *events):
    """One file of flat documents: (session, minute)."""
    path.mkdir()
    docs = [{**FLAT, "userAgent": "Mozilla", "sessionId": s, "anonymousId": "u", "secondsUtcTS": START + 60_000 * m} for s, m in events]
    path.joinpath("a.txt").write_text(json.dumps({"Records": [record(b64(json.dumps(d)), f"{d['sessionId']}-{d['secondsUtcTS']}") for d in docs]}))
    return str(path)


def test_a_later_archive_rewrites_the_days_of_its_sessions_only(spark, tmp_path):
    day = 24 * 60
    first = lines_of(tmp_path / "first", *[(f"s{d}", d * day + m) for d in range(4) for m in range(3)], ("wide", 0), ("wide", 3 * day))
    second = lines_of(tmp_path / "second", ("s1", day + 1), ("s1", day + 30), ("s9", day + 5), ("wide", 3 * day + 9))
    tables, whole = Tables(str(tmp_path / "t")), Tables(str(tmp_path / "whole"))
    processed = F.lit("2024-02-01 12:00:00").cast("timestamp")
    load_history(spark, first, tables, ingest_time=processed)
    names = ("web_events", "session_metrics_v2")
    files = lambda: {n: {d: {f.name for f in p.rglob("*.parquet")} for d, p in days(tmp_path / "t" / n)} for n in names}
    days = lambda root: [(p.name[-2:], p) for p in root.glob("event_date=*")]
    before = files()
    load_history(spark, second, tables, ingest_time=processed)
    after = files()
    for name in names:  # sessions s1 and s9 lie on the 16th, the wide one on the 15th and the 18th
        assert {d for d in after[name] if before[name].get(d) != after[name][d]} == {"15", "16", "18"}
    for archive in (first, second):
        load_history(spark, archive, whole, ingest_time=processed)
    rebuild_sessions(spark, whole)
    for name in names:
        mine, wanted = (t.read(spark, name).drop("processed_timestamp") for t in (tables, whole))
        assert mine.exceptAll(wanted.select(*mine.columns)).isEmpty() and wanted.count() == mine.count() > 0
    load_history(spark, second, tables, ingest_time=processed)
    assert tables.read(spark, "web_events").count() == 17


def tables_of(spark, tables):
    names = ("web_events", "session_metrics_v2")
    rows = {n: sorted(map(str, tables.read(spark, n).drop("processed_timestamp").collect())) for n in names}
    return rows, {n: sorted(tables.read(spark, n).inputFiles()) for n in names}


def test_an_archive_that_has_landed_rewrites_nothing(spark, tmp_path):
    first = lines_of(tmp_path / "first", ("s1", 0), ("s1", 3), ("s2", 1))
    second = lines_of(tmp_path / "second", ("s1", 3), ("s1", 5), ("s2", 1))
    tables, processed = Tables(str(tmp_path / "t")), F.lit("2024-02-01 12:00:00").cast("timestamp")
    load_history(spark, first, tables, ingest_time=processed)
    before = tables_of(spark, tables)
    load_history(spark, first, tables, ingest_time=processed)
    assert tables_of(spark, tables) == before and len(before[0]["web_events"]) == 3
    load_history(spark, second, tables, ingest_time=processed)  # some known, one new
    assert tables.read(spark, "web_events").count() == 4 and not (tmp_path / "t" / "pending_sessions").exists()


@pytest.mark.parametrize("dies", ["refresh_sessions", "write_events"])
def test_any_later_load_mends_an_interrupted_one(spark, tmp_path, monkeypatch, dies):
    first = lines_of(tmp_path / "first", ("s1", 0), ("s1", 3), ("s2", 1))
    second = lines_of(tmp_path / "second", ("s1", 1), ("s3", 5))
    tables, whole, processed = Tables(str(tmp_path / "t")), Tables(str(tmp_path / "w")), F.lit("2024-02-01 12:00:00").cast("timestamp")
    load_history(spark, first, tables, ingest_time=processed)

    def lost(*_, **__):
        raise RuntimeError("lost the driver")

    monkeypatch.setattr(jobs if dies == "refresh_sessions" else sources, dies, lost)
    with pytest.raises(RuntimeError):
        load_history(spark, second, tables, ingest_time=processed)
    monkeypatch.undo()
    landed = dies == "refresh_sessions"
    for archive in [first] if landed else [first, second]:
        load_history(spark, archive, tables, ingest_time=processed)
    for archive in (first, second):
        load_history(spark, archive, whole, ingest_time=processed)
    rebuild_sessions(spark, whole)
    assert tables_of(spark, tables)[0] == tables_of(spark, whole)[0] and tables.read(spark, "web_events").count() == 5

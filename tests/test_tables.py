import datetime as dt
import shutil

import pytest
from pyspark.sql import functions as F

from tourlytics.schemas import PARTITIONS, WEB_EVENTS, conform
from tourlytics.session import shared_folder, working_path
from tourlytics.sources import tables as t

DAY = dt.date(2024, 1, 1)
COLS = "event_id string, event_date date, space_type string, session_id string, anonymous_id string, n int"


def rows(spark, ids, n=0, days=3):
    kinds = ["unit", "amenity", "common_area"]
    data = [
        (f"evt-{i}", DAY + dt.timedelta(days=i % days), kinds[i % 3], f"s{i % 10}", f"u{i % 5}", n) for i in ids
    ]
    return spark.createDataFrame(data, COLS)


def test_merges(spark):
    base, batch = rows(spark, range(25), 1), rows(spark, range(20, 35), 2)
    inserted = {r["event_id"]: r["n"] for r in t.merge_insert_only(base, batch).collect()}
    assert len(inserted) == 35 and inserted["evt-20"] == 1 and inserted["evt-30"] == 2
    updated = {r["event_id"]: r["n"] for r in t.merge_upsert(base, batch).collect()}
    assert len(updated) == 35 and updated["evt-20"] == 2 and updated["evt-0"] == 1
    united = {r["event_id"]: r["n"] for r in t.union_dedup(base, batch, "event_id").collect()}
    assert united == inserted


def test_upsert_takes_the_latest_of_the_batch(spark):
    batch = rows(spark, [1], 5).unionByName(rows(spark, [1], 9)).unionByName(rows(spark, [1], 7))
    got = t.merge_upsert(rows(spark, range(3), 1), batch, order_cols=["n"]).collect()
    assert sorted(r["n"] for r in got) == [1, 1, 9]


def test_append_new_is_idempotent(spark, tmp_path):
    path = str(tmp_path / "events")
    for ids in (range(20), range(10, 30), range(10, 30), [5, 5, 40, 40]):
        t.append_new(spark, path, rows(spark, ids))
    got = [r["event_id"] for r in spark.read.parquet(path).collect()]
    assert sorted(got) == sorted(f"evt-{i}" for i in [*range(30), 40])


def test_partitioned_write_prunes(spark, tmp_path):
    path = str(tmp_path / "events")
    t.write_events(rows(spark, range(30)), path)
    read = t.read_events(spark, path).where(F.col("event_date") == F.lit(DAY))
    plan = read._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(event_date" in plan
    assert read.count() == 10
    assert t.list_partitions(spark, path).count() == 3


def test_hot_partition_is_split_on_write(spark, tmp_path):
    """A partition beyond the advisory size is written by several tasks."""
    path = str(tmp_path / "events")
    wide = spark.range(60_000).select(
        F.concat(F.lit("e"), F.col("id")).alias("event_id"),
        F.lit(DAY).alias("event_date"),
        F.when(F.col("id") % 3 == 0, "hot").otherwise(F.concat(F.lit("t"), F.col("id") % 5)).alias("space_type"),
        F.sha2(F.col("id").cast("string"), 512).alias("session_id"),
    )
    old = spark.conf.get("spark.sql.adaptive.advisoryPartitionSizeInBytes")
    spark.conf.set("spark.sql.adaptive.advisoryPartitionSizeInBytes", "400k")
    try:
        t.write_events(wide.repartition(6), path, cluster_by=["session_id"])
    finally:
        spark.conf.set("spark.sql.adaptive.advisoryPartitionSizeInBytes", old)
    files = {r["space_type"]: r["files"] for r in t.partition_files(spark, path).collect()}
    assert files["hot"] > 1
    assert spark.read.parquet(path).count() == 60_000


def test_compaction_keeps_rows_and_old_partitions(spark, tmp_path):
    path = str(tmp_path / "events")
    for n in range(6):
        rows(spark, range(n * 30, n * 30 + 30)).repartition(3).write.mode("append").partitionBy(
            "event_date", "space_type"
        ).parquet(path)
    before = {(r[0], r[1]): r["files"] for r in t.partition_files(spark, path).collect()}
    ids = sorted(r[0] for r in spark.read.parquet(path).select("event_id").collect())
    t.compact_partitions(spark, path, DAY + dt.timedelta(days=1))
    after = {(r[0], r[1]): r["files"] for r in t.partition_files(spark, path).collect()}
    assert sorted(r[0] for r in spark.read.parquet(path).select("event_id").collect()) == ids
    for (day, kind), files in after.items():
        assert files == (before[(day, kind)] if day == DAY else 1)


def test_compaction_aims_at_the_target_size(spark, tmp_path):
    path = str(tmp_path / "events")
    big = spark.range(20_000).select(
        F.col("id").cast("string").alias("event_id"),
        F.lit(DAY).alias("event_date"),
        F.lit("unit").alias("space_type"),
        F.sha2(F.col("id").cast("string"), 512).alias("session_id"),
    )
    big.repartition(12).write.partitionBy("event_date", "space_type").parquet(path)
    size = t.partition_files(spark, path).first()["bytes"]
    t.compact_partitions(spark, path, DAY, target_bytes=size // 3)
    row = t.partition_files(spark, path).first()
    assert 2 <= row["files"] <= 4 and spark.read.parquet(path).count() == 20_000


def test_staging_lines(spark, tmp_path):
    path = str(tmp_path / "staging")
    df = rows(spark, range(12)).unionByName(rows(spark, [50]).withColumn("space_type", F.lit(None).cast("string")))
    t.write_staging_jsonl(df, path)
    back = spark.read.schema("event_id string, event_date date, space_type string").json(path)
    assert back.count() == 13 and back.where("space_type = 'unknown'").count() == 1


def test_reports_and_marts(spark, tmp_path):
    out = str(tmp_path)
    first = t.write_report(rows(spark, range(3)), out, "2024-01-05")
    assert first.endswith("daily_analytics_report_20240105")
    t.write_report(rows(spark, range(9)), out, "2024-01-05")
    assert spark.read.parquet(first).count() == 3
    mart = str(tmp_path / "mart")
    for n in (9, 4):
        t.write_mart(rows(spark, range(n)), mart, ["event_date"])
    assert spark.read.parquet(mart).count() == 4


def test_schema_versions(spark):
    v1 = spark.createDataFrame([("a", "page")], "event_id string, event_type string")
    v2 = spark.createDataFrame([("b", "page", "s")], "event_id string, event_type string, session_id string")
    got = {r["event_id"]: r["session_id"] for r in t.union_evolved(v1, v2).collect()}
    assert got == {"a": None, "b": "s"}
    declared = conform(v1, WEB_EVENTS)
    assert declared.schema.names == WEB_EVENTS.names and declared.count() == 1
    assert set(PARTITIONS["web_events"]) <= set(WEB_EVENTS.names)


def test_as_of(spark):
    df = spark.createDataFrame(
        [(i, dt.datetime(2024, 1, 1) + dt.timedelta(hours=i)) for i in range(5)],
        "n int, processed_timestamp timestamp",
    )
    assert t.as_of_time(df, "2024-01-01 02:00:00").count() == 3


def test_column_stats(spark):
    df = spark.createDataFrame([(1, "a"), (5, None), (3, "c")], "n int, s string")
    got = {r["column_name"]: r for r in t.column_stats(df).collect()}
    assert (got["n"]["smallest"], got["n"]["largest"], got["s"]["nulls"]) == ("1", "5", 1)
    assert got["n"]["distinct_estimate"] == 3


def test_erase_restore_retain(spark, tmp_path):
    base = rows(spark, range(30))
    gone = t.erase_subject(base, spark.createDataFrame([("u1",), ("u1",)], "anonymous_id string"))
    assert gone.count() == 24
    backup, path = str(tmp_path / "backup"), str(tmp_path / "live")
    t.write_events(base, backup)
    t.write_events(base.where(F.col("event_id") != "evt-3"), path)
    t.restore_partition(spark, backup, path, DAY)
    assert spark.read.parquet(path).count() == 30
    assert t.retain_since(base, DAY + dt.timedelta(days=2)).count() == 10


def test_views(spark):
    t.register_views({"events_view": rows(spark, range(4))})
    assert spark.sql("SELECT count(*) FROM events_view").first()[0] == 4


class FakeSession:
    """Only what the folder look-up asks for."""

    def __init__(self, master, **conf):
        self.conf = conf
        self.sparkContext = self
        self.master, self.applicationId = master, "app"


def test_shared_folder_is_read_from_the_session(spark):
    assert working_path(spark, "a") != working_path(spark, "a")
    cluster = FakeSession("yarn", **{"spark.checkpoint.dir": "/shared/folder/"})
    assert shared_folder(cluster) == "/shared/folder"
    assert working_path(cluster, "x").startswith("/shared/folder/tourlytics/app/x-")


def test_no_machine_local_folder_on_a_cluster():
    with pytest.raises(ValueError):
        shared_folder(FakeSession("yarn"))


def parted(spark, path):
    return {(str(r[0]), r[1]) for r in t.list_partitions(spark, path).collect()}


def test_erasing_on_storage_drops_emptied_partitions(spark, tmp_path):
    path = str(tmp_path / "t")
    day = dt.date(2024, 1, 5)
    table = [("a", "u1", day, "unit"), ("b", "u2", day, "unit"), ("c", "u1", day, "only: u1/?"), ("d", None, day, "unit"), ("e", "u1", None, None)]
    events = spark.createDataFrame(table, "event_id string, anonymous_id string, event_date date, space_type string")
    t.write_events(events, path)
    t.erase_on_storage(spark, path, spark.createDataFrame([("u1",), (None,), ("nobody",)], "anonymous_id string"))
    assert {r["event_id"] for r in spark.read.parquet(path).collect()} == {"b", "d"}
    assert parted(spark, path) == {("2024-01-05", "unit")}
    t.erase_on_storage(spark, path, spark.createDataFrame([("nobody",)], "anonymous_id string"))
    assert spark.read.parquet(path).count() == 2


def test_retention_drops_folders(spark, tmp_path):
    path = str(tmp_path / "t")
    days = [dt.date(2024, 1, d) for d in (1, 2, 3)]
    t.write_events(spark.createDataFrame([(str(d), d, "unit") for d in days], "event_id string, event_date date, space_type string"), path)
    t.retain_on_storage(spark, path, days[1])
    assert parted(spark, path) == {("2024-01-02", "unit"), ("2024-01-03", "unit")}
    assert not (tmp_path / "t" / "event_date=2024-01-01").exists() or not list((tmp_path / "t" / "event_date=2024-01-01").rglob("*.parquet"))


def test_an_interrupted_replacement_is_finished_or_forgotten(spark, tmp_path, monkeypatch):
    path, day = str(tmp_path / "t"), dt.date(2024, 1, 5)
    rows = lambda *x: spark.createDataFrame([(i, day, s) for i, s in x], "event_id string, event_date date, space_type string")
    t.write_events(rows(("a", "unit"), ("b", "tour"), ("c", "gone")), path)
    whole = {("A", "unit"), ("B", "tour")}
    now = lambda: {(r["event_id"], r["space_type"]) for r in spark.read.parquet(path).collect()}
    old = [f"{path}/event_date=2024-01-05/space_type={s}" for s in ("unit", "tour", "gone")]
    old = [f"file:{f}" for f in old]
    # before the plan is written: the table stays as it was
    monkeypatch.setattr(t, "_folders", lambda *_: 1 / 0)
    with pytest.raises(ZeroDivisionError):
        t.replace_partitions(spark, path, rows(("A", "unit"), ("B", "tour")), old)
    assert now() == {("a", "unit"), ("b", "tour"), ("c", "gone")}
    monkeypatch.undo()
    # between two swaps: a later call ends it
    real, calls = t.resume_replacement, []
    monkeypatch.setattr(t, "resume_replacement", lambda *a: calls.append(a))
    t.replace_partitions(spark, path, rows(("A", "unit"), ("B", "tour")), old, expected=2)
    monkeypatch.undo()
    target = tmp_path / "t" / "event_date=2024-01-05" / "space_type=unit"
    for f in target.iterdir():
        f.unlink()
    target.rmdir()
    (tmp_path / "t" / t.STAGED / "rows" / "event_date=2024-01-05" / "space_type=unit").rename(target)
    real(spark, path)
    assert now() == whole and not (tmp_path / "t" / t.STAGED).exists()
    real(spark, path)
    with pytest.raises(ValueError):
        t.replace_partitions(spark, path, rows(("A", "unit")), old, expected=2)
    assert now() == whole


def test_restore_removes_foreign_partitions(spark, tmp_path):
    backup, path, day = str(tmp_path / "b"), str(tmp_path / "t"), dt.date(2024, 1, 5)
    rows = lambda *x: spark.createDataFrame([(i, day, s) for i, s in x], "event_id string, event_date date, space_type string")
    t.write_events(rows(("a", "unit"), ("b", "tour")), backup)
    t.write_events(rows(("x", "junk"), ("a", "unit")), path)
    t.restore_partition(spark, backup, path, day)
    assert {r["event_id"] for r in spark.read.parquet(path).collect()} == {"a", "b"}
    assert parted(spark, path) == {("2024-01-05", "unit"), ("2024-01-05", "tour")}


def test_copied_keys_follow_the_table(spark, tmp_path):
    """Each file is opened once; what others write, drop or rewrite is seen; days that are no longer asked for go."""
    path, read, real = str(tmp_path / "t"), [], t.read_folders

    def events(*keys):
        df = spark.createDataFrame([(k, d, s) for k, d, s in keys], "event_id string, d string, space_type string")
        return df.select("event_id", F.to_date("d").alias("event_date"), "space_type")

    def put(*keys):
        t.write_events(events(*keys), path)

    def found(first="2024-01-01", last="2024-01-31"):
        keys = copy.read(spark, path, spark.read.parquet(path), ["event_id", "event_date"], first, last)
        return sorted(r["event_id"] for r in keys.collect())

    def spy(spark, path, files, schema):
        read.extend(files)
        return real(spark, path, files, schema)

    copy = t.KeyCopy()
    t.read_folders = spy
    try:
        put(("a", "2024-01-01", "unit"), ("b", "2024-01-02", "a b%*"))
        assert found() == ["a", "b"] and not read
        put(("c", "2024-01-02", "a b%*"), ("d", None, None))
        assert found() == ["a", "b", "c", "d"] and len(read) == 2
        assert found() == ["a", "b", "c", "d"] and len(read) == 2  # nothing new
        put(*[(f"m{i:02}", f"2024-03-{i:02}", "unit") for i in range(1, 20)])
        assert found() == ["a", "b", "c", "d"] and len(read) == 2  # other days
        assert len(found("2024-01-01", "2024-03-31")) == 23
        assert found("2024-03-02", "2024-03-03") == ["d", "m02", "m03"]  # the others have gone from the copy
        shutil.rmtree(tmp_path / "t" / "event_date=2024-03-02")
        assert found("2024-03-02", "2024-03-03") == ["d", "m03"]
        t.append_new(spark, path, events(("m03", "2024-03-03", "unit"), ("n", "2024-03-03", "unit"), ("m02", "2024-03-02", "unit")), copy=copy)
        t.append_new(spark, path, events(("n", "2024-03-03", "unit"), ("o", "2024-03-03", "unit")), copy=copy)
        assert sorted(r[0] for r in spark.read.parquet(path).where("event_date between '2024-03-02' and '2024-03-03'").select("event_id").collect()) == ["m02", "m03", "n", "o"]
    finally:
        t.read_folders = real

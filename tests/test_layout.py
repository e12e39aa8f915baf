"""Files that look-ups can skip, and sketches that fold."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from tourlytics.operators import checks, sketches
from tourlytics.operators.filters import lookup_identity
from tourlytics.sources import bucketed, clustering, tables


def rows_read(df):
    """Rows that the scan of a query hands on; 0 if it skips every row group."""
    df.collect()
    leaves = df._jdf.queryExecution().executedPlan().collectLeaves()
    return sum(leaves.apply(k).metrics().apply("numOutputRows").value() for k in range(leaves.size()))


@pytest.fixture(scope="module")
def visitors(spark, tmp_path_factory):
    """More ids than a dictionary holds, so that only Bloom filters can tell."""
    path = str(tmp_path_factory.mktemp("visitors"))
    events = spark.range(0, 160_000, 1, 1).select(
        F.sha2(F.col("id").cast("string"), 256).alias("anonymous_id"),
        F.when(F.col("id") % 2 == 0, F.md5(F.col("id").cast("string"))).alias("user_id"),
        F.lit(dt.date(2024, 1, 1)).alias("event_date"), F.lit("unit").alias("space_type"),
        F.concat(F.lit("s"), F.col("id")).alias("session_id"),
    )
    tables.write_events(events, path)
    return spark.read.parquet(path)


def test_lookup_of_an_absent_id_reads_no_row_group(spark, visitors):
    ids = [r[0] for r in visitors.select("anonymous_id").limit(3).collect()]
    absent = ["8" * 64, "a" + "0" * 63]  # inside the range of the ids
    assert lookup_identity(visitors, ids[0]).count() == 1
    assert rows_read(lookup_identity(visitors, ids[0])) > 0
    assert rows_read(lookup_identity(visitors, absent[0])) == 0
    assert rows_read(lookup_identity(visitors, absent[1], "7" * 32)) == 0
    assert rows_read(visitors.where(clustering.any_of("anonymous_id", [f"{k:064x}" for k in range(2**250, 2**250 + 25)]))) == 0
    assert rows_read(visitors.where(clustering.any_of("anonymous_id", [*absent, *ids]))) > 0
    spark.conf.set("parquet.filter.bloom.enabled", "false")
    try:
        assert rows_read(lookup_identity(visitors, absent[0])) > 0
    finally:
        spark.conf.unset("parquet.filter.bloom.enabled")
    with pytest.raises(ValueError):
        lookup_identity(visitors)


def test_erasure_of_few_and_of_many(spark, tmp_path, monkeypatch):
    for most in (tables.PUSHED_IDS, 1):
        monkeypatch.setattr(tables, "PUSHED_IDS", most)
        path = str(tmp_path / f"t{most}")
        data = [(f"e{i}", f"u{i % 5}", dt.date(2024, 1, 1 + i % 10), "unit") for i in range(100)]
        tables.write_events(spark.createDataFrame(data, "event_id string, anonymous_id string, event_date date, space_type string"), path)
        before = set(map(str, (tmp_path / f"t{most}").rglob("*.parquet")))
        tables.erase_on_storage(spark, path, spark.createDataFrame([("u1",), ("u2",), ("gone",), (None,)], "anonymous_id string"))
        assert spark.read.parquet(path).groupBy("anonymous_id").count().count() == 3
        kept = before & set(map(str, (tmp_path / f"t{most}").rglob("*.parquet")))
        assert {p.split("event_date=")[1][:10] for p in kept} == {f"2024-01-{d:02}" for d in (1, 4, 5, 6, 9, 10)}
        tables.erase_on_storage(spark, path, spark.createDataFrame([], "anonymous_id string"))
        assert spark.read.parquet(path).count() == 60


def test_z_order_skips_files_by_both_columns(spark, tmp_path):
    """Two columns that have nothing to do with each other; a third of the rows is one session, nulls among them."""
    events = spark.range(40_000).select(
        F.when(F.col("id") % 3 == 0, "hot").otherwise(F.concat(F.lit("s"), F.xxhash64("id", F.lit(1)) % 5000)).alias("session_id"),
        F.when(F.col("id") % 50 == 0, None).otherwise(F.concat(F.lit("v"), F.xxhash64("id", F.lit(2)) % 5000)).alias("anonymous_id"),
        (F.col("id") % 2).alias("day"),
    )
    names, path = ["session_id", "anonymous_id"], str(tmp_path / "z")
    clustering.write_z_ordered(events, path, names, files=64)
    table = spark.read.parquet(path)
    ranges = clustering.file_ranges(table, names)
    sizes = [r["rows"] for r in ranges.collect()]
    assert sum(sizes) == 40_000 and 50 <= len(sizes) <= 64 and max(sizes) < 2_000
    assert all(clustering.touched_share(ranges, table, name) < 0.3 for name in names)
    one = table.where("anonymous_id = 'v17'")
    assert one.count() == events.where("anonymous_id = 'v17'").count() and rows_read(one) < 16_000
    sorted_path = str(tmp_path / "sorted")
    events.repartitionByRange(64, *names).sortWithinPartitions(*names).write.parquet(sorted_path)
    plain = clustering.file_ranges(spark.read.parquet(sorted_path), names)
    assert clustering.touched_share(plain, table, "anonymous_id") > 0.6
    parted = str(tmp_path / "parted")
    clustering.write_z_ordered(events, parted, names, 16, ["day"])
    assert sorted(p.name for p in (tmp_path / "parted").glob("day=*")) == ["day=0", "day=1"]
    clustering.write_z_ordered(events.limit(0), str(tmp_path / "none"), names, 4)
    assert spark.read.schema(events.schema).parquet(str(tmp_path / "none")).count() == 0


def test_sketches_fold_in_any_order(spark):
    rows = [(f"s{i % 700}", f"u{i % 90}" if i % 9 else None, dt.datetime(2024, 1, 1 + i % 20, i % 24), None if i % 10 == 0 else 0.5) for i in range(5000)]
    events = spark.createDataFrame(rows, "session_id string, anonymous_id string, event_timestamp timestamp, data_quality_score double")
    events = events.withColumn("event_date", F.to_date("event_timestamp"))
    late = events.where("day(event_date) = 3")
    hours = sketches.hourly_sketches(events.where("day(event_date) <> 3")).unionByName(sketches.hourly_sketches(late))
    hours = hours.unionByName(sketches.hourly_sketches(late.limit(0)))
    (month,) = sketches.folded_metrics(hours, "month").collect()
    assert month.total_events == 5000 and month.avg_quality_score == 0.5
    assert abs(month.unique_sessions - 700) <= 20 and abs(month.unique_users - len({r[1] for r in rows} - {None})) <= 3
    assert sketches.folded_metrics(hours, "day").count() == 20


def test_distributions_of_odd_columns(spark):
    rows = [(k % 3, k, None if k % 2 else float(k * k), None) for k in range(3000)]
    df = spark.createDataFrame(rows, "part int, a long, b double, c double")
    stored = sketches.partition_distributions(df, ["a", "b", "c"], ["part"])
    found = {r.column_name: r for r in sketches.distributions(stored, ["a", "b", "c"]).collect()}
    assert [found[n]["values"] for n in "abc"] == [3000, 1500, 0] and found["b"].largest == 2998.0**2
    assert abs(found["a"].median - 1500) <= 15 and abs(found["b"].q1 ** 0.5 - 750) <= 15
    assert found["c"].median is None and found["c"].smallest is None
    by_part = sketches.distributions(stored, ["a"], by=["part"]).collect()
    assert len(by_part) == 3 and all(r.rows == 1000 for r in by_part)


def test_bucketed_tables_join_without_a_shuffle(spark, tmp_path):
    rows = spark.range(20_000).select(F.concat(F.lit("s"), F.col("id") % 3000).alias("session_id"), "id")
    parents = spark.range(2990).select(F.concat(F.lit("s"), F.col("id")).alias("session_id"))
    paths = {n: str(tmp_path / n) for n in ("child_b", "parent_b")}
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        for name, df in (("child_b", rows), ("parent_b", parents)):
            bucketed.write_bucketed(df, name, paths[name], 8)
        child, parent = (bucketed.read_bucketed(spark, n, p, 8) for n, p in paths.items())
        found = checks.check_relationships(child, parent, "session_id")
        plan = found._jdf.queryExecution().executedPlan().toString()
        assert plan.count("Exchange") == 1 and "Exchange SinglePartition" in plan and "SortMergeJoin" in plan
        assert plan.count("Bucketed: true") == 2
        assert found.first()["observed"] == sum(1 for i in range(20_000) if i % 3000 >= 2990)
        # a session with most of the rows: its bucket is not read by one task
        hot = rows.withColumn("session_id", F.when(F.col("id") % 10 > 0, "hot").otherwise(F.col("session_id")))
        bucketed.write_bucketed(hot, "hot_b", str(tmp_path / "hot"), 8)
        read = bucketed.read_bucketed(spark, "hot_b", str(tmp_path / "hot"), 8, uneven=2)
        assert "Bucketed: true" not in read.groupBy("session_id").count()._jdf.queryExecution().executedPlan().toString()
        assert read.count() == 20_000
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
        for name in ("child_b", "parent_b", "hot_b"):
            spark.sql(f"DROP TABLE IF EXISTS {name}")

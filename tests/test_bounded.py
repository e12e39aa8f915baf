"""What a task holds: narrow rows are dealt before they are widened, lists are made after the shuffle, keys are merged alone."""

import datetime as dt

from pyspark.sql import functions as F

from tourlytics import session
from tourlytics.registry import data, ingest, streams
from tourlytics.sources import tables
from tourlytics.sources.event_table import spread_rows
from tourlytics.sources.raw import decode_lines, to_envelopes


def test_one_row_group_is_dealt(spark, tmp_path):
    path = str(tmp_path / "events.parquet")
    spark.range(300_000).select("id", F.rand(1).alias("v")).coalesce(1).write.parquet(path)
    dealt = spread_rows(spark, path)
    sizes = [r["count"] for r in dealt.groupBy(F.spark_partition_id().alias("p")).count().collect()]
    assert len(sizes) >= 8 and max(sizes) < 60_000
    assert dealt.agg(F.count_distinct("id")).first()[0] == 300_000


def test_reads_are_bounded(spark):
    names = ("spark.sql.files.maxPartitionBytes", "spark.sql.files.openCostInBytes")
    before = [spark.conf.get(n) for n in names]
    try:
        for given, held in (("128MB", ["16m", "512k"]), ("100k", ["100k", "100k"])):
            for n in names:
                spark.conf.set(n, given)
            data.prepare(spark)
            assert [spark.conf.get(n) for n in names] == held
    finally:
        for n, v in zip(names, before):
            spark.conf.set(n, v)


def test_envelopes_are_listed_after_the_shuffle(spark):
    rows = spark.createDataFrame([(i, '{"a": %d}' % i, f"s{i}", "k") for i in range(30)], "i int, payload string, sequence_number string, partition_key string")
    text = lambda payload, i: F.base64(F.encode(payload, "UTF-8"))
    ready = rows.withColumn("data", text(F.col("payload"), F.col("i")))
    plain, made = (to_envelopes(ready, F.floor(F.col("i") / 10), "i", e) for e in (None, text))
    plan = made._jdf.queryExecution().executedPlan().toString()
    assert sorted(r[0] for r in plain.collect()) == sorted(r[0] for r in made.collect())
    assert sorted(r["payload"] for r in decode_lines(made).collect()) == sorted(r["payload"] for r in rows.collect())
    assert plan.rindex("collect_list") < plan.index("Exchange hashpartitioning")


def _rows(spark, *rows):
    day = dt.date(2024, 1, 1)
    return spark.createDataFrame([(k, day, "tour", v, dt.datetime(2024, 1, 1, 0, v)) for k, v in rows], "event_id string, event_date date, space_type string, v int, processed_timestamp timestamp")


def test_written_batches_are_merged_by_keys(spark, tmp_path):
    table, batch = str(tmp_path / "table"), str(tmp_path / "batch")
    found = lambda: sorted((r[0] or "", r[1]) for r in spark.read.parquet(table).select("event_id", "v").collect())
    _rows(spark, ("a", 1), ("a", 2), ("b", 1), (None, 1), (None, 3)).write.parquet(batch)
    tables.append_new(spark, table, spark.read.parquet(batch), written=True)
    assert found() == [("", 3), ("a", 2), ("b", 1)] and spark.read.parquet(batch).count() == 5
    files = spark.read.parquet(table).inputFiles()
    tables.append_new(spark, table, spark.read.parquet(batch).where("event_id IS NOT NULL"), written=True)  # all known
    assert sorted(spark.read.parquet(table).inputFiles()) == sorted(files)
    tables.append_new(spark, table, _rows(spark, ("b", 9), ("c", 4), ("c", 5)))  # some known
    tables.append_new(spark, table, _rows(spark, ("d", 6)))  # none known
    assert found() == [("", 3), ("a", 2), ("b", 1), ("c", 5), ("d", 6)]


def test_archives_are_compressed(spark, small):
    path = ingest._archive(spark, small, "archive_of_test", F.lit(True))
    assert all(f.endswith(".gz") for f in spark.read.text(path).inputFiles())


def test_streams_are_fed_what_they_use(spark, small, monkeypatch):
    fed = {}
    monkeypatch.setattr(streams, "_drained", lambda s, parts, build, name: fed.setdefault(name, parts)[0])
    monkeypatch.setattr(streams.data, "web_events", lambda s, f: data.source(s, f).withColumns(
        {"device_type": F.lit("d"), "data_quality_score": F.lit(1.0), "is_bot": F.lit(False)}))
    streams.dedup(spark, small)
    streams.hourly_distincts(spark, small)
    assert [p.columns for p in fed["dedup"]] == [["event_id", "event_timestamp"]] * 3
    assert all(set(p.columns) == set(streams._MEASURED) for p in fed["distincts"])
    assert session.DEFAULTS["spark.sql.files.maxPartitionBytes"] == "16m"


def test_line_files_do_not_grow_with_the_tasks_that_read(spark, small, monkeypatch, tmp_path):
    """A micro-batch takes a few files, so files of a few rows would make many batches."""
    real, lines = data.source, []
    for tasks in (1, 40):
        monkeypatch.setattr(data, "source", lambda s, f, n=tasks: real(s, f).repartition(n))
        path = str(tmp_path / f"lines{tasks}")
        ingest.raw_line_plan(spark, small).write.text(path)
        written = spark.read.text(path)
        lines.append(sorted(r[0] for r in written.collect()))
        assert len(written.inputFiles()) <= 3 * 8
    assert lines[0] == lines[1]


def test_documents_are_decoded_once_for_the_sequence(spark, small):
    plan = ingest.raw_to_table(spark, small)._jdf.queryExecution().optimizedPlan().toString()
    assert "session_id" in plan and "from_json" not in plan.lower() and "json" not in plan.lower().replace("properties_json", "")


def test_a_batch_is_merged_into_a_table_that_repeats_keys(spark, tmp_path, monkeypatch):
    """The table's keys pass by those of the batch, and each known key counts once."""
    table, sides = str(tmp_path / "table"), []
    _rows(spark, ("a", 1), ("a", 2), ("b", 1)).write.partitionBy("event_date", "space_type").parquet(table)
    real = type(spark.range(0)).join

    def spy(self, other, on=None, how=None):
        sides.append((other.inputFiles(), how))
        return real(self, other, on, how)

    monkeypatch.setattr(type(spark.range(0)), "join", spy)
    tables.append_new(spark, table, _rows(spark, ("a", 9), ("c", 4)))
    monkeypatch.undo()
    assert sorted(tuple(r) for r in spark.read.parquet(table).select("event_id", "v").collect()) == [("a", 1), ("a", 2), ("b", 1), ("c", 4)]
    semi = [folder for folder, how in sides if how == "left_semi"]
    assert semi and not any(table in f for folder in semi for f in folder)


def test_a_record_is_decoded_once(spark):
    lines = spark.createDataFrame([('{"a": 1}',)], "value string")
    plan = decode_lines(lines)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("unbase64(") == 1 and plan.count("tryValidateUTF8String(") == 1

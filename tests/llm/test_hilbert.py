import zlib

import pytest
from pyspark.sql import functions as F

from llm_frames import documents
from tourlytics.llm import hilbert


@pytest.mark.parametrize("axes, bits", [(2, 3), (3, 2), (2, 1), (1, 4), (4, 2)])
def test_curve_visits_every_point_and_steps_to_a_neighbour(spark, axes, bits):
    points = [F.expr(f"shiftright(id, {bits * at}) & {(1 << bits) - 1}") for at in range(axes)]
    grid = spark.range(1 << (axes * bits)).select(hilbert.curve_index(points, bits), *points)
    rows = sorted(map(tuple, grid.collect()))
    assert [r[0] for r in rows] == list(range(len(rows)))
    assert all(sum(abs(a - b) for a, b in zip(p[1:], q[1:])) == 1 for p, q in zip(rows, rows[1:]))


def test_cells_hold_about_equal_numbers(spark):
    rows = spark.range(6400).select(F.expr("id * id").alias("x"), F.concat(F.lit("k"), F.col("id") % 4).alias("y"))
    cells = {tuple(r) for r in rows.select(hilbert._cell(F.col("x"), hilbert._cut_points(rows.select(F.col("x").alias("v")), 6400, 32)), "x").collect()}
    assert all(cell == int(x**0.5 + 0.5) // 200 for cell, x in cells)
    assert hilbert._cut_points(rows.select(F.col("y").alias("v")), 6400, 32) == [("k0", 0), ("k1", 8), ("k2", 16), ("k3", 24)]


def shards(df, **more):
    return [r.asDict(recursive=True) for r in hilbert.curve_shards(df, **more).collect()]


@pytest.mark.parametrize("law", hilbert.LAWS)
def test_odd_rows(spark, law):
    rows = shards(documents(spark), law=law, keep=["doc_id", "text", "bucket"], shards=4)
    assert len(rows) == 12
    for r in rows:
        text = (r["row"]["text"] or "").encode()
        assert (r["size"], r["text_crc32"], r["law"]) == (len(text) + 1, zlib.crc32(text), law)
        assert r["row"]["bucket"] == (None if r["row"]["doc_id"] is None else str(r["row"]["doc_id"]))
    slots = {s: sorted(r["slot"] for r in rows if r["shard"] == s) for s in {r["shard"] for r in rows}}
    assert all(got == list(range(len(got))) for got in slots.values()) and set(slots) <= {0, 1, 2, 3}
    if law == "rows":
        assert sorted(map(len, slots.values())) == [3, 3, 3, 3]
    assert shards(documents(spark, []), law=law) == []
    with pytest.raises(ValueError):
        hilbert.curve_shards(documents(spark), law="size")


def test_laws_hold_with_a_hot_group_and_every_range_is_bounded(spark):
    """A third of the rows is one row again and again, one id and one text; texts differ in size."""
    docs = spark.range(6000).select(
        F.when(F.col("id") % 3 == 0, 7).otherwise(F.col("id")).alias("doc_id"),
        F.when(F.col("id") % 3 == 0, "same words").otherwise(F.repeat(F.lit("x"), (F.col("id") % 97).cast("int"))).alias("text"),
        F.when(F.col("id") % 3 == 0, "en").otherwise(F.concat(F.lit("l"), F.col("id") % 5)).alias("lang"),
        F.when(F.col("id") % 3 == 0, "hot").otherwise(F.concat(F.lit("s"), F.col("id") % 40)).alias("source"),
        (F.when(F.col("id") % 3 == 0, 10).otherwise(F.col("id") % 97)).alias("n_chars"),
    )
    rows = shards(docs, keep=["doc_id"])
    counts = [sum(1 for r in rows if r["shard"] == s) for s in range(16)]
    assert max(counts) - min(counts) <= 1 and sum(counts) == 6000
    rows = shards(docs, law="bytes")
    sizes = [sum(r["size"] for r in rows if r["shard"] == s) for s in range(16)]
    assert max(sizes) - min(sizes) <= 2 * max(r["size"] for r in rows)
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    lined = hilbert.lined_up(docs.select("doc_id"), ["doc_id"], "lined")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")
    assert lined.groupBy("task").count().agg(F.max("count")).first()[0] < 2000


def test_files_are_skipped_by_each_column(spark):
    """Boxes over any of three columns touch far fewer shards than rows sorted by the first one."""
    docs = spark.range(32768).select(
        F.col("id").alias("doc_id"), F.lit("t").alias("text"),
        *[F.expr(f"(xxhash64(id, {at}) & 1023)").alias(f"c{at}") for at in range(3)],
    )
    names = ["c0", "c1", "c2"]
    placed = hilbert.curve_shards(docs, names, shards=64, keep=names)
    ranges = hilbert.extents(placed, names).collect()
    assert sum(r["rows"] for r in ranges) == 32768 and len(ranges) == 64
    for name in names:
        touched = sum(1 for r in ranges if r[f"min_{name}"] <= 520 and r[f"max_{name}"] >= 512)
        assert touched <= 26  # sorted by one column, the other two would need all 64

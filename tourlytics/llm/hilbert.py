"""Shards as runs of a Hilbert curve through several metadata columns.

Each column is quantised by its own distribution into 2^bits cells of about equal numbers of rows, the cells
are the coordinates of a point, and rows are ordered by the point's index on the Hilbert curve. A run of the
curve covers a small box, so the smallest and largest value of each column in a file skip most files for a
filter on any of the columns. All is DataFrame functions.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

from .shared import ahead, forget, lined_up, settle

BITS = 5  # a column has 2^BITS cells
LEADING = 64  # characters of a string that its cell is taken from; longer values that agree there share a cell
DIMENSIONS = ("lang", "source", "n_chars")
LAWS = ("rows", "bytes")


def _cut_points(values: DataFrame, rows: int, cells: int) -> list[tuple[object, int]]:
    """(smallest value, cell) of the cells in use, ascending; at most ``cells``. ``values`` has one column, v.

    A value's cell is its number of smaller rows x cells / rows, nulls being smallest. Equal values are
    counted first, so what is ordered has a row a value.
    """
    counts = lined_up(values.groupBy("v").agg(F.count(F.lit(1)).alias("n")), ["v"], "values")
    starts = ahead(counts.groupBy("task").agg(F.sum("n").alias("inside")), "inside")
    earlier = Window.partitionBy("task").orderBy("at").rowsBetween(Window.unboundedPreceding, -1)
    below = F.col("ahead") + F.coalesce(F.sum("n").over(earlier), F.lit(0))
    placed = counts.join(F.broadcast(starts.select("task", "ahead")), "task").select(
        "v", F.floor(below * cells / F.lit(rows)).cast("int").alias("cell")
    )
    found = placed.where(F.col("v").isNotNull()).groupBy("cell").agg(F.min("v").alias("v")).orderBy("cell").collect()
    forget(counts)
    return [(r["v"], r["cell"]) for r in found]


def _cell(value: Column, cuts: list[tuple[object, int]]) -> Column:
    out = F.lit(0).cast("bigint")
    for low, cell in cuts:
        out = F.when(value >= F.lit(low), F.lit(cell).cast("bigint")).otherwise(out)
    return out


def curve_index(coordinates: list[Column], bits: int = BITS) -> Column:
    """Place of a point on the Hilbert curve through a cube of 2^bits cells a side; coordinates are longs.

    Plane by plane from the highest bit, the lower bits are reflected or exchanged with the first axis as
    the curve's turn in that plane asks; the Gray code of what is left is the index, bits interleaved.
    """
    axes = len(coordinates)
    steps = F.array(
        *[
            F.struct(F.lit(1 << b).cast("bigint").alias("plane"), F.lit(axis).alias("axis"))
            for b in range(bits - 1, 0, -1)
            for axis in range(axes)
        ]
    )

    def turn(point: Column, step: Column) -> Column:
        plane, axis = step["plane"], step["axis"]
        low, first, mine = plane - 1, point[0], F.get(point, axis)
        set_there = mine.bitwiseAND(plane) != 0
        apart = first.bitwiseXOR(mine).bitwiseAND(low)
        return F.transform(
            point,
            lambda x, at: F.when(at == 0, x.bitwiseXOR(F.when(set_there, low).otherwise(apart)))
            .when((at == axis) & ~set_there, x.bitwiseXOR(apart))
            .otherwise(x),
        )

    turned = F.aggregate(steps, F.array(*coordinates), turn) if bits > 1 else F.array(*coordinates)
    # Gray code: each axis takes the ones before it, then the last axis says which lower bits turn over.
    gray = F.transform(
        turned, lambda x, at: F.aggregate(F.slice(turned, 1, at + 1), F.lit(0).cast("bigint"), lambda a, b: a.bitwiseXOR(b))
    )
    planes = F.array(*[F.lit(b) for b in range(bits - 1, 0, -1)]) if bits > 1 else F.array().cast("array<int>")
    one = F.lit(1).cast("bigint")

    def flipped(point: Column) -> Column:
        last = F.element_at(point, -1)
        flip = F.aggregate(
            planes,
            F.lit(0).cast("bigint"),
            lambda t, b: F.when(
                F.call_function("shiftright", last, b).bitwiseAND(one) != 0,
                t.bitwiseXOR(F.call_function("shiftleft", one, b) - 1),
            ).otherwise(t),
        )
        return F.transform(point, lambda x: x.bitwiseXOR(flip))

    places = F.array(*[F.struct(F.lit(b).alias("b"), F.lit(a).alias("a")) for b in range(bits - 1, -1, -1) for a in range(axes)])
    woven = F.transform(
        F.array(gray),
        lambda g: F.transform(
            F.array(flipped(g)),
            lambda point: F.aggregate(
                places,
                F.lit(0).cast("bigint"),
                lambda index, p: index * 2 + F.call_function("shiftright", F.get(point, p["a"]), p["b"]).bitwiseAND(one),
            ),
        )[0],
    )
    return woven[0]


def on_curve(rows: DataFrame, dimensions: Sequence[str], bits: int = BITS) -> DataFrame:
    """``rows`` with ``curve`` (long). The cells are cut from all rows; the driver sees 2^bits values a column."""
    total = max(1, rows.count())
    cells = []
    for name in dimensions:
        value = F.col(name)
        if isinstance(rows.schema[name].dataType, StringType):
            value = F.substring(value, 1, LEADING)
        cells.append(_cell(value, _cut_points(rows.select(value.alias("v")), total, 1 << bits)))
    return rows.withColumn("curve", curve_index(cells, bits))


def curve_shards(
    docs: DataFrame,
    dimensions: Sequence[str] = DIMENSIONS,
    shards: int = 16,
    law: str = "rows",
    keep: Sequence[str] = ("doc_id",),
    bits: int = BITS,
) -> DataFrame:
    """``row`` (struct of ``keep``), size, text_crc32, law, curve, shard and slot of every row.

    Rows are ordered by curve index, then text checksum, id and size: equal texts of one cell lie together.
    ``rows`` cuts that order into shards whose counts are at most one apart; ``bytes`` cuts it where the running
    size passes a shard's share, so a shard is off by at most its largest row. A group of equal texts larger
    than a shard is cut as well. ``slot`` follows the curve, from 0, without gaps.

    Null texts count as no bytes (size 1, checksum 0), null metadata lie in the first cell, null ids come
    first, repeated rows all have a place of their own; an empty table gives no rows. Other columns of
    ``docs`` never matter; those in ``keep`` (texts too, to write the files) travel inside ``row``.
    """
    if law not in LAWS:
        raise ValueError(f"law is one of {LAWS}")
    size = F.coalesce(F.octet_length("text"), F.lit(0)).cast("bigint") + 1
    checksum = F.crc32(F.coalesce(F.col("text"), F.lit("")))
    axes = [F.col(name).alias(f"axis{at}") for at, name in enumerate(dimensions)]
    slim = docs.select(
        F.struct(*keep).alias("row"), F.col("doc_id").alias("id"), size.alias("size"), checksum.alias("text_crc32"), *axes
    )
    slim = settle(slim, "measured")
    placed = on_curve(slim, [f"axis{at}" for at in range(len(axes))], bits)
    lined = lined_up(placed.select("row", "id", "size", "text_crc32", "curve"), ["curve", "text_crc32", "id", "size"], "curve")
    forget(slim)
    tasks = lined.groupBy("task").agg(F.count(F.lit(1)).alias("n"), F.sum("size").alias("total"))
    starts = ahead(tasks, "n").withColumnRenamed("ahead", "earlier_rows")
    starts = ahead(starts, "total").withColumnRenamed("ahead", "earlier_bytes")
    all_rows, all_bytes = (lined.agg(F.count(F.lit(1)), F.coalesce(F.sum("size"), F.lit(0))).first())
    found = lined.join(F.broadcast(starts.select("task", "earlier_rows", "earlier_bytes")), "task")
    found = found.withColumn("rank", F.col("earlier_rows") + F.col("at"))
    if law == "rows":
        found = found.withColumn("shard", F.expr(f"int(rank * {shards} div {max(1, all_rows)})"))
        first = F.expr(f"(shard * {all_rows}L + {shards - 1}) div {shards}")
    else:
        inside = Window.partitionBy("task").orderBy("at").rowsBetween(Window.unboundedPreceding, -1)
        below = F.col("earlier_bytes") + F.coalesce(F.sum("size").over(inside), F.lit(0))
        found = found.withColumn("below", below)
        found = found.withColumn("shard", F.expr(f"int(below * {shards} div {max(1, all_bytes)})"))
        firsts = found.groupBy("shard").agg(F.min("rank").alias("first"))  # a row a shard
        found, first = found.join(F.broadcast(firsts), "shard"), F.col("first")
    slot = (F.col("rank") - first).alias("slot")
    return found.select("row", "size", "text_crc32", F.lit(law).alias("law"), "curve", "shard", slot)


def extents(placed: DataFrame, dimensions: Sequence[str] = DIMENSIONS) -> DataFrame:
    """A row a shard: rows, bytes, and the smallest and largest value of each column, which must be kept in ``row``."""
    ranges = [f(f"row.{name}").alias(f"{f.__name__}_{name}") for name in dimensions for f in (F.min, F.max)]
    return placed.groupBy("shard").agg(F.count(F.lit(1)).alias("rows"), F.sum("size").alias("bytes"), *ranges)

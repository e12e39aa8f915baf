"""Files laid out so that look-ups by session or by visitor read few of them.

Rows are ordered by a Z-order key: the ranks of several columns, their bits interleaved. A file then covers a
small range of each column, and the reader skips the others by their smallest and largest values. Inside a
range, Bloom filters (see ``tables.write_events``) tell which row groups cannot hold an id.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

RANK_BITS = 6
SAMPLE_ROWS = 20_000  # that the ranks are cut from; they shape files, not results
PUSHED_IDS = 200  # ids that a look-up hands to the reader; more are joined
IN_LIST = 10  # longer lists reach the reader as a range only


def any_of(column: str, values: Sequence) -> Column:
    """``column`` is one of the values, in lists short enough for the reader to test each value by itself."""
    lists = [F.col(column).isin(list(values[k : k + IN_LIST])) for k in range(0, len(values), IN_LIST)]
    return reduce(lambda a, b: a | b, lists, F.lit(False))


def rank_cuts(df: DataFrame, columns: Sequence[str], bits: int = RANK_BITS, sample_rows: int = SAMPLE_ROWS) -> list[list]:
    """For each column the values that cut its rows into 2^bits ranks of about equal size; nulls come first.

    They are read off a sample of about half of ``sample_rows`` rows, never more than those, on the driver.
    """
    share = min(1.0, sample_rows / 2 / max(1, df.count()))
    picked = df.select(*columns).sample(share, seed=11).limit(sample_rows).collect()
    cuts = []
    for name in columns:
        values = sorted(r[name] for r in picked if r[name] is not None)
        at = [values[len(values) * k // (1 << bits)] for k in range(1, 1 << bits)] if values else []
        cuts.append(sorted(set(at)))
    return cuts


def _rank(value: Column, cuts: list, base: int = 0) -> Column:
    """Number of cuts that are not above the value, by halving."""
    if not cuts:
        return F.lit(base).cast("long")
    middle = len(cuts) // 2
    below, above = _rank(value, cuts[:middle], base), _rank(value, cuts[middle + 1 :], base + middle + 1)
    return F.when(value >= F.lit(cuts[middle]), above).otherwise(below)


def z_order(columns: Sequence[str], cuts: list[list], bits: int = RANK_BITS) -> Column:
    """The ranks of the columns with their bits interleaved, the first column's ahead."""
    key = F.lit(0).cast("long")
    for bit in range(bits):
        for at, (name, mine) in enumerate(zip(columns, cuts, strict=True)):
            one = F.shiftright(_rank(F.col(name), mine), bit).bitwiseAND(F.lit(1).cast("long"))
            key = key + F.shiftleft(one, bit * len(columns) + len(columns) - 1 - at)
    return key


def write_z_ordered(
    df: DataFrame,
    path: str,
    columns: Sequence[str] = ("session_id", "anonymous_id"),
    files: int = 64,
    partitions: Sequence[str] = (),
    mode: str = "append",
    bits: int = RANK_BITS,
    **options: str,
) -> None:
    """Writes a table as about ``files`` files in Z-order of the columns, inside partitions if there are some.

    Rows are dealt out by ranges of partition and key, and ties by the columns and a hash of the row's
    place, so a session or visitor of any size is cut into several files.
    """
    keyed = df.withColumn("_z", z_order(columns, rank_cuts(df, columns, bits), bits))
    spread = keyed.withColumn("_tie", F.xxhash64(F.monotonically_increasing_id()))
    order = [*partitions, "_z", *columns]
    ranged = spread.repartitionByRange(files, *order, "_tie").sortWithinPartitions(*order).drop("_z", "_tie")
    writer = ranged.write.mode(mode).option("compression", "zstd").options(**options)
    (writer.partitionBy(*partitions) if partitions else writer).parquet(path)


def file_ranges(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """A row a file: rows, and the smallest and largest value of each column; only these columns are read."""
    ranges = [f(name).alias(f"{f.__name__}_{name}") for name in columns for f in (F.min, F.max)]
    return df.groupBy(F.col("_metadata.file_path").alias("file")).agg(F.count(F.lit(1)).alias("rows"), *ranges)


def touched_share(ranges: DataFrame, values: DataFrame, column: str) -> float:
    """Mean share of the files whose range holds a value of ``column`` (one row per value), over all values."""
    inside = F.col(column).between(F.col(f"min_{column}"), F.col(f"max_{column}"))
    wanted = values.select(column).where(F.col(column).isNotNull()).distinct()
    # The ranges are one row a file, so they go to every task; the values stay where they are.
    hits = wanted.join(F.broadcast(ranges), inside).count()
    return hits / max(1, wanted.count() * ranges.count())

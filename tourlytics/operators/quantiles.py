"""Exact grouped quantiles without holding a group in one task.

Spark's ``percentile`` keeps every different value of a group in one buffer. Here an estimate, which
merges on the map side, brackets the wanted rank; values below the bracket are only counted, and only
those inside it are ordered: a few ten-thousandths of the group, whatever its size or its values.
"""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

ACCURACY = 10_000  # of the estimates: their rank is wrong by a share of 1 / ACCURACY at most


def grouped_quantiles(
    df: DataFrame,
    keys: Sequence[str],
    value: str,
    wanted: dict[str, float],
    accuracy: int = ACCURACY,
) -> DataFrame:
    """One row per key with the continuous quantiles ``wanted`` (name to probability).

    ``accuracy`` sizes the brackets: about 6 / accuracy of a group's values are ordered for a quantile,
    or all of a group of at most ``accuracy`` rows. The result does not depend on it. Groups without a
    value are absent. NULL keys form groups as in ``groupBy``.
    """
    safe = [f"_k{at}" for at in range(len(keys))]
    named = [F.col(k).alias(s) for k, s in zip(keys, safe)]
    values = df.where(F.col(value).isNotNull()).select(*named, F.col(value).cast("double").alias("_v"))
    shares = [min(1.0, max(0.0, p + side * 3 / accuracy)) for p in wanted.values() for side in (-1, 1)]
    brackets = values.groupBy(*safe).agg(
        F.count(F.lit(1)).alias("_total"), F.percentile_approx("_v", shares, accuracy).alias("_q")
    ).withColumn("_q", F.when(F.col("_total") > accuracy, F.col("_q")))
    freq = values.groupBy(*safe, "_v").agg(F.count(F.lit(1)).alias("_n"))

    parts = []
    for i, (low, high) in enumerate(zip(shares[::2], shares[1::2])):
        under = F.lit(False) if low == 0.0 else F.coalesce(F.col("_v") < F.col("_q")[2 * i], F.lit(False))
        over = F.lit(False) if high == 1.0 else F.coalesce(F.col("_v") > F.col("_q")[2 * i + 1], F.lit(False))
        inside = F.struct(F.lit(i).alias("i"), F.when(~under, F.col("_v")).alias("v"))
        parts.append(F.when(~over, inside))
    near = join_groups(freq, brackets, safe)
    spread = near.select(*safe, "_total", "_n", F.explode(F.array_compact(F.array(*parts))).alias("p"))
    counted = spread.groupBy(*safe, "_total", F.col("p.i").alias("_i"), F.col("p.v").alias("_w")).agg(F.sum("_n").alias("_n"))
    along = Window.partitionBy(*safe, "_i").orderBy(F.col("_w").asc_nulls_first())
    placed = counted.withColumn("_from", F.sum("_n").over(along) - F.col("_n"))

    def value_at(i: int, rank: Column) -> Column:
        here = (F.col("_i") == i) & (rank >= F.col("_from")) & (rank < F.col("_from") + F.col("_n"))
        return F.max(F.when(here, F.col("_w")))

    low_high = []
    for i, (name, p) in enumerate(wanted.items()):
        low, high = _ranks(p)
        low_high += [value_at(i, low).alias(f"_{name}_low"), value_at(i, high).alias(f"_{name}_high")]
    found = placed.groupBy(*safe).agg(F.max("_total").alias("_total"), *low_high)

    def between(name: str, p: float) -> Column:
        part = (F.col("_total") - 1) * F.lit(p)
        part = part - F.floor(part)
        low, high = F.col(f"_{name}_low"), F.col(f"_{name}_high")
        return (low + (high - low) * part).alias(name)

    return found.select(
        *[F.col(s).alias(k) for k, s in zip(keys, safe)],
        *[between(name, p) for name, p in wanted.items()],
    )


def _ranks(p: float) -> tuple[Column, Column]:
    """Zero-based ranks below and above the quantile."""
    if not 0.0 <= p <= 1.0 or math.isnan(p):
        raise ValueError(f"not a probability: {p}")
    at = (F.col("_total") - 1) * F.lit(p)
    return F.floor(at), F.ceil(at)


def join_groups(left: DataFrame, right: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Left join of two grouped results on their keys; NULL keys match."""
    renamed = right.withColumnsRenamed({k: f"_r_{k}" for k in keys})
    same = F.lit(True)
    for key in keys:
        same = same & F.col(key).eqNullSafe(F.col(f"_r_{key}"))
    return left.join(renamed, same, "left").drop(*[f"_r_{k}" for k in keys])

"""Near-duplicate vectors of a label, by p-stable hashing for Euclidean distance and exact cosines.

Vectors are scaled to length one, so a least cosine is a greatest distance. Each table cuts some random
projections into cells; vectors of a label that share all cells of a table are compared exactly. A pair
counts in the first table that brings it together, so links are counted without listing pairs. Equal vectors
are one row with a count throughout. Cells that hold many vectors are cut into chunks, and every two chunks
of a cell are compared apart; tasks are as many as the rows, with the copies for other chunks, call for.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .components import connected
from .shared import parts, settle

LEAST_COSINE = 0.93
TABLES = 36
PROJECTIONS = 10
CELL = 2.0
CHUNK = 2048  # vectors of a cell that are compared at once
PAIRS = 1 << 14  # pairs whose signatures are compared at once
ROWS_PER_TASK = 20_000

_MIX = np.uint64(0x9E3779B97F4A7C15)


def collision(distance: float, projections: int = PROJECTIONS, cell: float = CELL) -> float:
    """Chance that two vectors at a distance share a cell of one table."""
    ratio = cell / distance
    tail = math.erfc(ratio / math.sqrt(2))
    one = 1 - tail - 2 / (math.sqrt(2 * math.pi) * ratio) * (1 - math.exp(-ratio * ratio / 2))
    return one**projections


def _signatures(unit: np.ndarray, seed: int) -> np.ndarray:
    """A hash for each vector and table; the projections depend on seed and dimension only."""
    rng = np.random.default_rng((seed, unit.shape[1]))
    lines = rng.normal(size=(unit.shape[1], TABLES * PROJECTIONS))
    shift = rng.uniform(0, CELL, TABLES * PROJECTIONS)
    cells = np.floor((unit @ lines + shift) / CELL).astype(np.int64).view(np.uint64).reshape(len(unit), TABLES, PROJECTIONS)
    out = np.zeros((len(unit), TABLES), np.uint64)
    for k in range(PROJECTIONS):
        out = (out ^ (out >> np.uint64(29)) ^ cells[:, :, k]) * _MIX
    return out


def _units(blobs: list[bytes], kind: str) -> np.ndarray:
    """Vectors of one dimension, scaled to length one in double precision."""
    x = np.frombuffer(b"".join(blobs), kind).astype(np.float64).reshape(len(blobs), -1)
    x = x / np.abs(x).max(axis=1, keepdims=True)
    return x / np.sqrt((x * x).sum(axis=1, keepdims=True))


def _clean(kind: str):
    """Vectors as bytes of their own precision; null where the vector can link with nothing."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            for x in batch.column("embedding"):
                v = None
                if x.is_valid and len(x) and x.values.null_count == 0:
                    v = np.asarray(x.values.to_numpy(zero_copy_only=False), kind)
                    v = v if np.isfinite(v).all() and v.any() else None
                out.append(None if v is None else (v + v.dtype.type(0)).tobytes())
            yield pa.RecordBatch.from_arrays([batch.column("vec_id"), batch.column("label"), pa.array(out, pa.binary())], ["vec_id", "label", "v"])

    return run


def _hash(seed: int, kind: str):
    """The cells of each vector, one a table, without the vector."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            blobs = batch.column("v").to_pylist()
            salt = batch.column("label").to_numpy().view(np.uint64)
            sizes = np.array([len(b) for b in blobs])
            for size in np.unique(sizes):
                at = np.flatnonzero(sizes == size)
                found = _signatures(_units([blobs[i] for i in at], kind), seed)
                keys = ((found ^ (salt[at][:, None] + np.uint64(int(size) * int(_MIX) % 2**64))) + np.arange(TABLES, dtype=np.uint64)[None, :]) * _MIX
                keys ^= keys >> np.uint64(31)
                rows = pa.array(np.repeat(at, TABLES))
                columns = [
                    pa.array(keys.ravel().view(np.int64)), pa.array(np.tile(np.arange(TABLES, dtype=np.int32), len(at))),
                    batch.column("cid").take(rows), batch.column("label").take(rows),
                ]
                yield pa.RecordBatch.from_arrays(columns, ["cell", "tab", "cid", "label"])

    return run


def _compare(least: float, seed: int, kind: str):
    def run(rows: pa.Table) -> pa.Table:
        found: list[tuple[int, int | None, int]] = []
        rows = rows.sort_by([(k, "ascending") for k in ("cell", "tab", "label", "low", "high", "chunk", "cid")])
        names = ("cell", "tab", "label", "low", "high", "chunk", "cid", "n")
        cell, tab, label, low, high, chunk, cid, n = (rows.column(k).to_numpy() for k in names)
        blobs = rows.column("v").to_pylist()
        size = np.array([len(b) for b in blobs], np.int64)
        if len(cell):
            key = np.stack((cell, tab, label, low, high), axis=1)
            cuts = [0, *(np.flatnonzero((key[1:] != key[:-1]).any(axis=1)) + 1).tolist(), len(cell)]
            for a, b in zip(cuts[:-1], cuts[1:], strict=True):
                if b - a < 2:
                    continue
                for s in np.unique(size[a:b]):
                    at = a + np.flatnonzero(size[a:b] == s)
                    found += _pairs([blobs[i] for i in at], cid[at], n[at], chunk[at], int(tab[a]), low[a] == high[a], least, seed, kind)
        return pa.table(
            {
                "a": pa.array([x[0] for x in found], pa.int64()),
                "b": pa.array([x[1] for x in found], pa.int64()),
                "links": pa.array([x[2] for x in found], pa.int64()),
            }
        )

    return run


def _pairs(blobs, cid, n, chunk, tab, same_chunk, least, seed, kind) -> list[tuple[int, int | None, int]]:
    """Link counts of the vectors of one cell, and a forest of their links."""
    unit = _units(blobs, kind)
    if same_chunk:
        left = right = np.arange(len(unit))
    else:
        left, right = np.flatnonzero(chunk == chunk.min()), np.flatnonzero(chunk != chunk.min())
    close = unit[left] @ unit[right].T >= least
    if same_chunk:
        close = np.triu(close, 1)
    i, j = np.nonzero(close)
    if not len(i):
        return []
    i, j = left[i], right[j]
    if tab:
        signs = _signatures(unit, seed)[:, :tab]
        new = np.ones(len(i), bool)
        for at in range(0, len(i), PAIRS):
            part = slice(at, at + PAIRS)
            new[part] = ~(signs[i[part]] == signs[j[part]]).any(axis=1)
        i, j = i[new], j[new]
    count = np.bincount(i, n[j], len(unit)) + np.bincount(j, n[i], len(unit))
    out: list[tuple[int, int | None, int]] = [(int(cid[k]), None, int(count[k])) for k in np.flatnonzero(count)]
    top = _tops(i, j, len(unit))
    return out + [(int(cid[k]), int(cid[top[k]]), 0) for k in np.flatnonzero(top != np.arange(len(unit)))]


def _tops(i: np.ndarray, j: np.ndarray, n: int) -> np.ndarray:
    """For each of n nodes the first one that links tie it to."""
    top = np.arange(n)
    while True:
        new = top.copy()
        np.minimum.at(new, i, top[j])
        np.minimum.at(new, j, top[i])
        new = new[new]
        if (new == top).all():
            return top
        top = new


def _label(vectors: DataFrame) -> Column:
    """Whole numbers as they are; any other label by its 64-bit hash, so that labels of every type keep apart."""
    kind, label = vectors.schema["label"].dataType, F.col("label")
    if isinstance(kind, T.IntegralType):
        return label.cast("long")
    plain = label + 0.0 if isinstance(kind, T.FractionalType) else label
    return F.when(label.isNotNull(), F.xxhash64(plain))


def linked(vectors: DataFrame, least: float = LEAST_COSINE, seed: int = 7, chunk: int = CHUNK) -> DataFrame:
    """vec_id, n_links, component_id, kept for each row of ``vectors`` (vec_id, embedding, label).

    Two rows link if their labels are equal and not null, their vectors have one length and their cosine in
    double precision is at least ``least``; a row whose vector is null, empty, zero or holds a null or
    non-finite component links with nothing, nor does one without a label. No link below ``least`` is ever
    returned; a pair of cosine 0.93 itself is missed with a chance of (1 - collision(0.374)) ** TABLES, about
    0.0004, closer ones more rarely, equal vectors never. Repeated rows link with each other like any two.
    A component is named by its smallest vec_id; rows without an id are never kept.
    """
    kind = "<f4" if vectors.schema["embedding"].dataType == T.ArrayType(T.FloatType()) else "<f8"
    rows = vectors.select(F.col("vec_id").cast("long").alias("vec_id"), _label(vectors).alias("label"), "embedding")
    clean = settle(rows.mapInArrow(_clean(kind), "vec_id long, label long, v binary").withColumn("h", F.sha2("v", 256)), "vectors")
    usable = clean.where("v is not null and label is not null")
    classes = usable.groupBy("label", "h").agg(F.first("v").alias("v"), F.count(F.lit(1)).alias("n"), F.min("vec_id").alias("least_id"))
    classes = settle(classes.withColumn("cid", F.monotonically_increasing_id()), "classes")
    cells = classes.select("cid", "label", "v").mapInArrow(_hash(seed, kind), "cell long, tab int, cid long, label long")
    sizes = cells.groupBy("cell", "tab", "label").agg(F.count(F.lit(1)).alias("size")).where("size > 1")
    # Written first, so that both sides of the join are plain shuffles and a cell with many rows is split.
    sizes = settle(sizes, "cells")
    shared = cells.join(sizes, ["cell", "tab", "label"])
    chunks = F.ceil(F.col("size") / chunk).cast("int")
    own = shared.withColumn("chunks", chunks).withColumn("chunk", F.pmod(F.xxhash64("cid"), F.col("chunks")).cast("int"))
    # Vectors join the cells that several of them share, and no others.
    own = own.join(classes.select("cid", "n", "v"), "cid")
    dealt = own.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("chunks") - 1)))
    dealt = dealt.select("cell", "tab", "label", "cid", "n", "v", "chunk", F.least("chunk", "other").alias("low"), F.greatest("chunk", "other").alias("high"))
    copies = sizes.agg(F.coalesce(F.sum(F.col("size") * chunks), F.lit(0)).alias("n")).first()["n"]
    tasks = parts(max(classes.count() * TABLES, copies), ROWS_PER_TASK, 12)
    dealt = dealt.withColumn("task", F.pmod(F.xxhash64("cell", "tab", "label", "low", "high"), F.lit(tasks)))
    found = settle(dealt.groupBy("task").applyInArrow(_compare(least, seed, kind), "a long, b long, links long"), "links")
    counts = found.groupBy(F.col("a").alias("cid")).agg(F.sum("links").alias("links"))
    tied = connected(found.where("b is not null").select("a", "b")).select(F.col("node").alias("cid"), "component")
    named = classes.select("cid", "label", "h", "n", "least_id").join(counts, "cid", "left").join(tied, "cid", "left")
    named = named.withColumn("component", F.coalesce("component", "cid"))
    # Written, as above: a giant component can be split.
    least_id = settle(named.groupBy("component").agg(F.min("least_id").alias("component_id")), "least")
    named = named.join(least_id, "component").select("label", "h", (F.coalesce("links", F.lit(0)) + F.col("n") - 1).alias("n_links"), "component_id")
    out = clean.drop("v").join(named, ["label", "h"], "left")
    name = F.when(F.col("n_links").isNull(), F.col("vec_id")).otherwise(F.col("component_id"))
    out = out.select("vec_id", F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"), name.alias("component_id"))
    return out.withColumn("kept", F.coalesce(F.col("vec_id") == F.col("component_id"), F.lit(False)))

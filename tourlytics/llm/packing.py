"""Packing of token pieces into sequences by the sum of squares.

Each piece goes where the squared numbers of open sequences per residual gap become smallest, or into a
new sequence if that is smaller still. Groups of pieces are packed apart, as tasks; sequences that are
full are done, the pieces of the others are dealt to fewer groups and packed again, until one group is
left. There the sequences still open are dissolved once more and their pieces put, longest first, where
the least space remains. If too few sequences fill for the groups to become fewer, this last step is
done from the number of pieces of each length, whatever the number of pieces.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .shared import parts, settle
from .tokens import chunks_of, public_path

CAPACITY = 4096
END_ID = 1
GROUP_PIECES = 50_000

_PIECES = "doc_id long, doc_row long, piece int, start long, length long, ids_crc32 long"
_PLACED = "doc_row long, piece int, length long, grp long, bin long, offset long, open boolean, nth long"
_SEATED = "doc_row long, piece int, bin long, offset long"


def _cut(path: str, capacity: int, end_id: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        store, end = chunks_of(path), np.array([end_id], "<u4")
        for batch in batches:
            which, piece, start, length, crc = [], [], [], [], []
            for row, ids in enumerate(store.each(batch.column("text"))):
                ids = np.concatenate((ids, end)).astype("<u4")
                for k, at in enumerate(range(0, len(ids), capacity)):
                    some = ids[at : at + capacity]
                    which.append(row)
                    piece.append(k)
                    start.append(at)
                    length.append(len(some))
                    crc.append(zlib.crc32(some.tobytes()))
            at = pa.array(which, pa.int64())
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("doc_id").take(at), batch.column("doc_row").take(at), pa.array(piece, pa.int32()),
                    pa.array(start, pa.int64()), pa.array(length, pa.int64()), pa.array(crc, pa.int64()),
                ],
                ["doc_id", "doc_row", "piece", "start", "length", "ids_crc32"],
            )

    return run


def pieces(docs: DataFrame, tokenizer: str | None = None, capacity: int = CAPACITY, end_id: int = END_ID) -> DataFrame:
    """doc_id, doc_row, piece, start, length, ids_crc32: the ids of each text and an end id, cut at ``capacity``.

    ``doc_row`` numbers the rows, so that rows with equal or null ids stay apart; it is fixed only once
    the result is written. Null and empty texts are one piece that holds the end id.
    """
    path = tokenizer or public_path("word_bpe_49k.json")
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.monotonically_increasing_id().alias("doc_row"), "text")
    return rows.mapInArrow(_cut(path, capacity, end_id), _PIECES)


class _Open:
    """Open sequences by their gap."""

    def __init__(self, capacity: int) -> None:
        self.capacity, self.n = capacity, np.zeros(capacity + 1, np.int64)
        self.by_gap: dict[int, list[list[int]]] = {}

    def _change(self, size: int) -> np.ndarray:
        """Half the change of the sum of squares if a piece goes to a sequence of gap size, size + 1, ..."""
        taken = self.n[size : self.capacity]
        cost = self.n[: self.capacity - size] - taken + 1.0
        if len(cost):
            cost[0] = 0.5 - taken[0]  # the sequence is full and counts no more
        cost[taken == 0] = np.inf
        return cost

    def place(self, item: int, size: int) -> list[int] | None:
        """Puts a piece and returns the sequence if that has filled it."""
        cost = self._change(size)
        best = int(np.argmin(cost)) if len(cost) else -1
        if best >= 0 and cost[best] <= self.n[self.capacity - size] + 0.5:
            return self.put(item, size + best, best)
        return self.put(item, self.capacity, self.capacity - size)

    def put(self, item: int, gap: int, left: int) -> list[int] | None:
        if gap == self.capacity:
            held: list[int] = []
        else:
            held = self.by_gap[gap].pop()
            self.n[gap] -= 1
        held.append(item)
        if left == 0:
            return held
        self.n[left] += 1
        self.by_gap.setdefault(left, []).append(held)
        return None

    def rest(self) -> list[list[int]]:
        return [held for gap in sorted(self.by_gap) for held in self.by_gap[gap]]


def sum_of_squares(sizes: np.ndarray, capacity: int = CAPACITY) -> tuple[list[list[int]], list[list[int]]]:
    """Indices of the pieces of each full sequence and of each open one; longer pieces go first."""
    bins, full = _Open(capacity), []
    for i in np.argsort(-sizes, kind="stable").tolist():
        if (done := bins.place(i, int(sizes[i]))) is not None:
            full.append(done)
    return full, bins.rest()


def tightest(sizes: np.ndarray, capacity: int = CAPACITY) -> list[list[int]]:
    """Pieces, longest first, each into the open sequence in which the least space remains."""
    bins, full = _Open(capacity), []
    for i in np.argsort(-sizes, kind="stable").tolist():
        size = int(sizes[i])
        fits = np.flatnonzero(bins.n[size:capacity])
        gap = size + int(fits[0]) if len(fits) else capacity
        if (done := bins.put(i, gap, gap - size)) is not None:
            full.append(done)
    return full + bins.rest()


def tightest_by_count(counts: dict[int, int], capacity: int = CAPACITY) -> tuple[np.ndarray, int]:
    """``tightest`` from the number of pieces of each length, and the number of sequences.

    A row (size, first, bin, each, offset) says that the pieces of that size from number ``first`` on go, ``each``
    to a sequence, to the sequences from ``bin`` on, behind ``offset``. Sequences with one gap are ranges, and a
    size splits at most one, so that the work does not grow with the number of pieces.
    """
    by_gap: dict[int, list[tuple[int, int]]] = {}
    n, bins, out = np.zeros(capacity + 1, np.int64), 0, []

    def keep(gap: int, first: int, many: int) -> None:
        if gap and many:
            n[gap] += 1
            by_gap.setdefault(gap, []).append((first, many))

    for size in sorted(counts, reverse=True):
        at = 0
        while at < counts[size]:
            left = counts[size] - at
            fits = np.flatnonzero(n[size:capacity])
            gap = size + int(fits[0]) if len(fits) else capacity
            each = min(gap // size, left)
            if len(fits):
                first, many = by_gap[gap].pop()
                n[gap] -= 1
            else:
                first, many = bins, left // each
                bins += many
            used = min(many, left // each)
            out.append((size, at, first, each, capacity - gap))
            keep(gap, first + used, many - used)
            keep(gap - each * size, first, used)
            at += used * each
    return np.array(sorted(out), np.int64).reshape(-1, 5), bins


def _pack(capacity: int, last: bool):
    def run(key: tuple, group: pa.Table) -> pa.Table:
        group = group.sort_by([("doc_row", "ascending"), ("piece", "ascending")])
        sizes = np.asarray(group.column("length"), np.int64)
        full, still_open = sum_of_squares(sizes, capacity)
        if last:
            left = np.array([i for held in still_open for i in held], np.int64)
            again = [left[held].tolist() for held in tightest(sizes[left], capacity)]
            full += min(still_open, again, key=len)
            still_open = []
        every = full + still_open
        which = np.array([i for held in every for i in held], np.int64)
        number = [k for k, held in enumerate(every) for _ in held]
        offset = [x for held in every for x in np.cumsum([0, *sizes[held[:-1]]]).tolist()]
        unfilled = np.array(number, np.int64) >= len(full)
        nth = np.zeros(len(which), np.int64)  # among the group's pieces of one length that are left
        spare = np.flatnonzero(unfilled)
        spare = spare[np.argsort(sizes[which[spare]], kind="stable")]
        _, begin, many = np.unique(sizes[which[spare]], return_index=True, return_counts=True)
        nth[spare] = np.arange(len(spare)) - np.repeat(begin, many)
        at = pa.array(which, pa.int64())
        return pa.table(
            {
                "doc_row": group.column("doc_row").take(at),
                "piece": group.column("piece").take(at),
                "length": group.column("length").take(at),
                "grp": pa.array(np.full(len(which), key[0].as_py(), np.int64)),
                "bin": pa.array(number, pa.int64()),
                "offset": pa.array(offset, pa.int64()),
                "open": pa.array(unfilled),
                "nth": pa.array(nth),
            }
        )

    return run


def _seat(rules: np.ndarray):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        size, first, begin, each, offset = rules.T
        starts = (size << 48) + first
        for batch in batches:
            length, nth = (np.asarray(batch.column(k), np.int64) for k in ("length", "nth"))
            rule = np.searchsorted(starts, (length << 48) + nth, side="right") - 1
            row, place = np.divmod(nth - first[rule], each[rule])
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_row"), batch.column("piece"), pa.array(begin[rule] + row), pa.array(offset[rule] + place * length)],
                ["doc_row", "piece", "bin", "offset"],
            )

    return run


def _rest(left: DataFrame, part: int, capacity: int) -> DataFrame:
    """doc_row, piece, part, bin, offset of pieces in open sequences: as they are, or tightest if that takes fewer."""
    counts = {r["length"]: r["count"] for r in left.groupBy("length").count().collect()}  # at most one for each length
    rules, bins = tightest_by_count(counts, capacity)
    if left.where("offset = 0").count() <= bins:
        return left.select("doc_row", "piece", (F.lit(part) + F.col("grp")).alias("part"), "bin", "offset")
    before = Window.partitionBy("length").orderBy("grp").rowsBetween(Window.unboundedPreceding, -1)
    firsts = left.groupBy("length", "grp").count().select("length", "grp", F.coalesce(F.sum("count").over(before), F.lit(0)).alias("first"))
    numbered = left.join(firsts, ["length", "grp"]).select("doc_row", "piece", "length", (F.col("first") + F.col("nth")).alias("nth"))
    return numbered.mapInArrow(_seat(rules), _SEATED).select("doc_row", "piece", F.lit(part).cast("long").alias("part"), "bin", "offset")


def pack(cut: DataFrame, capacity: int = CAPACITY, group_pieces: int = GROUP_PIECES) -> DataFrame:
    """The pieces with sequence_id and offset: gapless from 0, no sequence longer than ``capacity``.

    ``cut`` has doc_row, piece and length, is written (not recomputed), and no piece is longer than the
    capacity. Sequence ids are unique numbers without further meaning. No pieces give no rows.
    """
    todo, done, level, base = cut.select("doc_row", "piece", "length"), [], 0, 0
    groups = parts(todo.count(), group_pieces)
    while True:
        dealt = todo.withColumn("grp", F.pmod(F.xxhash64("doc_row", "piece"), F.lit(groups)))
        placed = settle(dealt.groupBy("grp").applyInArrow(_pack(capacity, groups == 1), _PLACED), f"packed{level}")
        number = (F.lit(base) + F.col("grp")).alias("part")
        done.append(placed.where("not open").select("doc_row", "piece", number, "bin", "offset"))
        if groups == 1:
            break
        left, level, base = placed.where("open"), level + 1, base + groups
        fewer = parts(left.count(), group_pieces)
        if 4 * fewer > 3 * groups:
            done.append(_rest(left, base, capacity))
            break
        todo, groups = left.select("doc_row", "piece", "length"), fewer
    every = done[0]
    for more in done[1:]:
        every = every.unionByName(more)
    ids = (F.shiftleft(F.col("part"), 32) + F.col("bin")).alias("sequence_id")
    return cut.join(every.select("doc_row", "piece", ids, "offset"), ["doc_row", "piece"])


def packed_sequences(docs: DataFrame, tokenizer: str | None = None, capacity: int = CAPACITY, end_id: int = END_ID) -> DataFrame:
    """Every piece of every document with its sequence; see ``pieces`` and ``pack``."""
    return pack(settle(pieces(docs, tokenizer, capacity, end_id), "pieces"), capacity)

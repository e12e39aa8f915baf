"""Removal of repeated phrases, located by Aho-Corasick automata over words.

Documents are dealt into blocks of consecutive ids. Every block sends a hash of each of its windows, once,
to the bucket of the hash, which tells the first block that holds a window what later blocks hold it too.
The first block confirms the passage: it cuts the windows' words out of its own texts, joins neighbouring
windows, and sends the passages to those blocks. Each block compiles the passages sent to it into one
automaton, streams all its documents through it, and compares around every hit word by word. So hashes only
route passages; what is removed rests on equal words. The automaton holds tiles of half a window, as every
window inside a passage holds a whole tile.

An id that many rows share has several blocks of its own. They tell the bucket where in its text each window
starts, so that of these blocks the one with the earliest start counts as the first.
"""

from __future__ import annotations

from collections.abc import Iterator

import ahocorasick
import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .shared import MISSING_ID, parts, raw, settle, text_bytes

WIDTH = 20
BLOCK_BYTES = 8 << 20  # of text in a block, about; blocks grow in number only

TARGETS = 1000  # blocks that one row sends a passage to, so that no row is large
CODE = 3
UNKNOWN = "\0" * CODE

RANGES = 4096  # bounds of ids that are sent to tasks, at most
PART_BITS = 32  # the low bits of a block's number: the part of an id that many rows share, else zero
COPIES = 1000  # rows that one row is unfolded to at a time

_FACTOR = 0x9E3779B97F4A7C15 | 1
_MASK = (1 << 64) - 1
_INVERSE = pow(_FACTOR, -1, 1 << 64)


def _powers(base: int, n: int) -> np.ndarray:
    out = np.full(n, base, np.uint64)
    out[:1] = 1
    return np.cumprod(out, dtype=np.uint64)


def _window_hashes(words: list[list[bytes]], width: int) -> tuple[np.ndarray, np.ndarray]:
    """Positions in the joined words at which a window starts inside one text, and the window's hash."""
    lengths = np.fromiter(map(len, words), np.int64, len(words))
    total = int(lengths.sum())
    hashes = np.fromiter((h for w in words for h in map(xxhash.xxh3_64_intdigest, w)), np.uint64, total)
    ends = np.cumsum(lengths)
    inside = np.ones(total + 1, bool)
    inside[total:] = False
    for end, n in zip(ends.tolist(), lengths.tolist(), strict=True):
        inside[max(end - width + 1, end - n) : end] = False
    starts = np.flatnonzero(inside)
    sums = np.concatenate((np.zeros(1, np.uint64), np.cumsum(hashes * _powers(_FACTOR, total), dtype=np.uint64)))
    out = (sums[starts + width] - sums[starts]) * _powers(_INVERSE, total)[starts]
    out ^= out >> np.uint64(32)
    out *= np.uint64(0xD6E8FEB86659FD93)
    out ^= out >> np.uint64(32)
    return starts, out


class _Block:
    """The texts of one block in the order of their ids."""

    def __init__(self, rows: pa.Table, width: int) -> None:
        rows = rows.sort_by("doc_id")
        self.width = width
        self.ids = rows.column("doc_id").to_pylist()
        self.words = [(t or b"").split() for t in raw(rows)]

    def windows(self) -> tuple[np.ndarray, np.ndarray]:
        """Distinct window hashes in order, and where each starts first: by id, then by place in the text."""
        starts, hashes = _window_hashes(self.words, self.width)
        self.offsets = np.concatenate(([0], np.cumsum([len(w) for w in self.words]))).astype(np.int64)
        if len(set(self.ids)) < len(self.ids):  # rows that share an id are one document
            owner = np.searchsorted(self.offsets, starts, side="right") - 1
            rank = np.searchsorted(np.array(self.ids, np.int64), np.array(self.ids, np.int64))[owner]
            order = np.lexsort((starts - self.offsets[owner], rank))
            starts, hashes = starts[order], hashes[order]
        distinct, first, self.counts = np.unique(hashes, return_index=True, return_counts=True)
        return distinct, starts[first]

    def in_text(self, places: np.ndarray) -> np.ndarray:
        """The words of their own texts at which windows start."""
        return places - self.offsets[np.searchsorted(self.offsets, places, side="right") - 1]

    def runs(self, places: np.ndarray) -> list[tuple[int, int]]:
        """First and last window of each run of neighbouring windows."""
        places = np.sort(places)
        cuts = np.flatnonzero(np.diff(places) != 1) + 1
        first, last = np.concatenate(([0], cuts)), np.append(cuts, len(places)) - 1
        return list(zip(places[first].tolist(), places[last].tolist(), strict=True)) if len(places) else []

    def passage(self, first: int, last: int) -> tuple[int, int, bytes]:
        """Id, first word and words of a run of windows."""
        k = int(np.searchsorted(self.offsets, first, side="right")) - 1
        start = int(first - self.offsets[k])
        return self.ids[k], start, b" ".join(self.words[k][start : start + last - first + self.width])


def _send(width: int, buckets: int):
    def run(key: tuple, rows: pa.Table) -> pa.Table:
        block, number = _Block(rows, width), key[0].as_py()
        distinct, first = block.windows()
        place = (distinct % np.uint64(buckets)).astype(np.int32)
        order = np.argsort(place, kind="stable")
        used, cuts = np.unique(place[order], return_index=True)

        def dealt(values: np.ndarray) -> list[bytes]:
            return [v.tobytes() for v in np.split(values[order], cuts[1:])] if len(used) else []

        shared_id = number % (1 << PART_BITS) > 0
        return pa.table(
            {
                "bucket": pa.array(used, pa.int32()),
                "holder": pa.array(np.full(len(used), number, np.int64)),
                "hashes": pa.array(dealt(distinct), pa.binary()),
                "starts": pa.array(dealt(block.in_text(first)) if shared_id else [None] * len(used), pa.binary()),
            }
        )

    return run


def _recurring(rows: pa.Table) -> pa.Table:
    """For the first holder of each hash that has several: the other holders and the hashes they share."""
    blobs = rows.column("hashes").to_pylist()
    hashes = np.frombuffer(b"".join(blobs), np.uint64)
    holder = np.repeat(rows.column("holder").to_numpy(), [len(b) // 8 for b in blobs])
    starts = rows.column("starts").to_pylist()
    if any(starts):  # parts of one id: the earliest start is first
        start = np.frombuffer(b"".join([s or bytes(len(b)) for s, b in zip(starts, blobs, strict=True)]), np.int64)
        order = np.lexsort((holder, start, holder >> PART_BITS, hashes))
    else:
        order = np.lexsort((holder, hashes))
    hashes, holder = hashes[order], holder[order]
    new = np.ones(len(hashes), bool)
    new[1:] = hashes[1:] != hashes[:-1]
    first = holder[np.maximum.accumulate(np.where(new, np.arange(len(hashes)), 0))]
    hashes, holder, first = hashes[~new], holder[~new], first[~new]
    order = np.lexsort((holder, first))
    hashes, holder, first = hashes[order], holder[order], first[order]
    cuts = np.flatnonzero((np.diff(first) != 0) | (np.diff(holder) != 0)) + 1
    at = np.concatenate(([0], cuts)) if len(hashes) else cuts
    return pa.table(
        {
            "source": pa.array(first[at], pa.int64()),
            "target": pa.array(holder[at], pa.int64()),
            "hashes": pa.array([h.tobytes() for h in np.split(hashes, cuts)] if len(hashes) else [], pa.binary()),
        }
    )


def _confirm(width: int):
    def run(key: tuple, rows: pa.Table, wanted: pa.Table) -> pa.Table:
        holders: dict[tuple[int, int], list[int]] = {}
        out: list[tuple[list[int], int, int, bytes]] = []
        if rows.num_rows:
            block = _Block(rows, width)
            distinct, first = block.windows()
            for found in block.runs(first[block.counts > 1]):
                holders.setdefault(found, []).append(key[0].as_py())
            shared: dict[int, list[bytes]] = {}
            for target, blob in zip(wanted.column("target").to_pylist(), wanted.column("hashes").to_pylist(), strict=True):
                shared.setdefault(target, []).append(blob)
            for target, blobs in shared.items():
                at = np.searchsorted(distinct, np.frombuffer(b"".join(blobs), np.uint64))
                for found in block.runs(first[at]):
                    holders.setdefault(found, []).append(target)
            for found, targets in holders.items():
                passage = block.passage(*found)
                out += [(targets[i : i + TARGETS], *passage) for i in range(0, len(targets), TARGETS)]
        return pa.table(
            {
                "targets": pa.array([x[0] for x in out], pa.list_(pa.int64())),
                "source_id": pa.array([x[1] for x in out], pa.int64()),
                "source_start": pa.array([x[2] for x in out], pa.int64()),
                "words": pa.array([x[3] for x in out], pa.binary()),
            }
        )

    return run


def _common(a: str, i: int, b: str, j: int, most: int) -> int:
    """How many characters agree from a[i] and b[j] on, ``most`` at the most."""
    if a[i : i + most] == b[j : j + most]:
        return most
    low, high = 0, most  # low agree, high do not
    while high - low > 1:
        mid = (low + high) // 2
        if a[i + low : i + mid] == b[j + low : j + mid]:
            low = mid
        else:
            high = mid
    return low


class _Automaton:
    """Passages compiled into one automaton over codes of words.

    A node's edges are searched one by one, so a word is CODE characters of a small alphabet rather than one
    of a large one. The first comes from an alphabet of its own, which keeps matches on whole words. Words of
    no passage have a code that no tile holds.
    """

    def __init__(self, passages: pa.Table, width: int) -> None:
        self.width, self.tile = width, width // 2
        split = [p.split(b" ") for p in passages.column("words").to_pylist()]
        self.codes = {w: _code(k) for k, w in enumerate(dict.fromkeys(w for p in split for w in p))}
        self.sources = list(zip(passages.column("source_id").to_pylist(), passages.column("source_start").to_pylist(), strict=True))
        self.passages = ["".join([self.codes[w] for w in p]) for p in split]
        tiles: dict[str, list[tuple[int, int]]] = {}
        size = self.tile * CODE
        for k, passage in enumerate(self.passages):
            for at in range(0, len(passage) - size + 1, size):
                tiles.setdefault(passage[at : at + size], []).append((k, at))
        self.machine = ahocorasick.Automaton(ahocorasick.STORE_ANY, ahocorasick.KEY_STRING)
        for tile, places in tiles.items():
            self.machine.add_word(tile, places)
        self.machine.make_automaton()

    def mark(self, doc: int, words: list[bytes]) -> bytearray:
        """One for each word that a window covers which starts earlier elsewhere."""
        hit = bytearray(len(words))
        if not self.passages or len(words) < self.width:
            return hit
        get = self.codes.get
        text = "".join([get(w, UNKNOWN) for w in words])
        back: str | None = None
        size, done = self.tile * CODE, {}
        for end, places in self.machine.iter(text):
            at = end + 1 - size
            for k, offset in places:
                if done.get((k, at - offset), -1) > end:
                    continue
                passage = self.passages[k]
                most = min(at, offset)
                low = 0
                if most:
                    back = back if back is not None else text[::-1]
                    low = _common(back, len(text) - at, passage[::-1], len(passage) - offset, most) // CODE * CODE
                high = _common(text, at, passage, offset, min(len(text) - at, len(passage) - offset)) // CODE * CODE
                done[k, at - offset] = at + high
                source, start = self.sources[k]
                first, n = (at - low) // CODE, (low + high) // CODE
                if n >= self.width and (source, start + (offset - low) // CODE) < (doc, first):
                    hit[first : first + n] = b"\x01" * n
        return hit


def _code(k: int) -> str:
    """CODE characters for a number; the first alphabet grows with the numbers."""
    k, low = divmod(k, 128)
    k, mid = divmod(k, 128)
    return chr(0x10000 + k) + chr(0x200 + mid) + chr(0x300 + low)


def _locate(width: int):
    def run(rows: pa.Table, passages: pa.Table) -> pa.Table:
        machine = _Automaton(passages, width)
        kept, count, removed, spans = [], [], [], []
        ids = rows.column("doc_id").to_pylist()
        for doc, text in zip(ids, raw(rows), strict=True):
            words = (text or b"").split()
            hit = machine.mark(doc, words)
            gone = hit.count(1)
            edges = np.flatnonzero(np.diff(np.frombuffer(b"\0" + hit + b"\0", np.int8))).tolist() if gone else []
            words_left = [w for w, h in zip(words, hit, strict=True) if not h] if gone else words
            kept.append(b" ".join(words_left))
            count.append(len(words))
            removed.append(gone)
            spans.append(edges)
        return pa.table(
            {
                "doc_id": pa.array([None if i == MISSING_ID else i for i in ids], pa.int64()),
                "text": pa.array(kept, pa.binary()).cast(pa.string()),
                "n_words": pa.array(count, pa.int64()),
                "n_removed": pa.array(removed, pa.int64()),
                "removed": pa.array(spans, pa.list_(pa.int64())),
                "copies": rows.column("copies"),
            }
        )

    return run


def blocks_of(docs: DataFrame, block_bytes: int, ranges: int = RANGES) -> tuple[DataFrame, int]:
    """doc_id, text, copies and block: blocks of consecutive ids whose numbers rise with the ids.

    At most ``ranges`` bounds, which hold a like number of rows each, go to the tasks; where there are to be
    more blocks, every range is cut into equal stretches of ids. An id that is two bounds or more at once is
    shared by many rows: its equal texts become one row, with their number in ``copies``, and its rows are dealt
    to parts by the hash of the text, as many as the bounds tell.
    """
    rows = docs.select(F.coalesce(F.col("doc_id").cast("long"), F.lit(MISSING_ID)).alias("doc_id"), "text")
    blocks = parts(text_bytes(rows), block_bytes)
    wide = min(blocks, ranges)
    cuts = parts(blocks, wide)
    bounds, shared, shares_of = np.zeros(1, np.int64), np.empty(0, np.int64), np.empty(0, np.int64)
    if blocks > 1:
        shares = [k / wide for k in range(wide + 1)]
        found = rows.agg(F.percentile_approx("doc_id", shares, max(10_000, 20 * wide)).alias("b")).first()["b"]
        bounds, times = np.unique(np.array(found or [0], np.int64), return_counts=True)
        shared, shares_of = bounds[times > 1], (times[times > 1] + 1) * cuts
        # The ids behind a shared one begin a range of their own.
        bounds = np.union1d(bounds, shared[shared < np.iinfo(np.int64).max] + 1)

    @F.pandas_udf("long")
    def block(ids: pd.Series) -> pd.Series:
        at = np.clip(np.searchsorted(bounds, ids.to_numpy(), side="right") - 1, 0, max(0, len(bounds) - 2))
        low, high = bounds[at].astype(float), bounds[np.minimum(at + 1, len(bounds) - 1)].astype(float)
        inside = np.floor((ids.to_numpy().astype(float) - low) / np.maximum(high - low, 1) * cuts)
        return pd.Series((at * cuts + np.clip(inside, 0, cuts - 1).astype(np.int64)) << PART_BITS)

    @F.pandas_udf("long")
    def part(ids: pd.Series, keys: pd.Series) -> pd.Series:
        return pd.Series(1 + keys.to_numpy() % shares_of[np.searchsorted(shared, ids.to_numpy())])

    if not len(shared):
        return rows.select("doc_id", "text", F.lit(1).cast("long").alias("copies"), block("doc_id").alias("block")), blocks
    mine = F.col("doc_id").isin(shared.tolist())
    others = rows.where(~mine).select("doc_id", "text", F.lit(1).cast("long").alias("copies"), block("doc_id").alias("block"))
    folded = settle(rows.where(mine).groupBy("doc_id", "text").agg(F.count(F.lit(1)).alias("copies")), "shared_ids")
    number = (block("doc_id") + part("doc_id", F.xxhash64("text"))).alias("block")
    return others.unionByName(folded.select("doc_id", "text", "copies", number)), blocks


def without_repeats(docs: DataFrame, width: int = WIDTH, block_bytes: int = BLOCK_BYTES, ranges: int = RANGES) -> DataFrame:
    """doc_id, text of the words kept (one blank between), n_words, n_removed, removed (word spans, flat).

    A window is ``width`` consecutive words, parted by ASCII white space; a word goes if a window covers it
    whose words also start earlier: at a smaller id, or earlier in the same document. Null and empty texts
    have no words; texts of fewer words than ``width`` stay whole. A null id comes before all others. Rows
    that share an id are one document: none is earlier than the other at the same place. No rows give none.
    """
    rows, blocks = blocks_of(docs, block_bytes, ranges)
    held = rows.groupBy("block").applyInArrow(_send(width, blocks), "bucket int, holder long, hashes binary, starts binary")
    shared = held.groupBy("bucket").applyInArrow(_recurring, "source long, target long, hashes binary")
    passages = rows.groupBy("block").cogroup(shared.groupBy("source")).applyInArrow(
        _confirm(width), "targets array<long>, source_id long, source_start long, words binary"
    )
    passages = passages.select(F.explode("targets").alias("target"), "source_id", "source_start", "words")
    found = rows.groupBy("block").cogroup(passages.groupBy("target")).applyInArrow(
        _locate(width), "doc_id long, text string, n_words long, n_removed long, removed array<long>, copies long"
    )
    # Rows that were folded come back one by one, some at a time, so that no array is large.
    some = found.select("*", F.explode(F.expr(f"sequence(0L, (copies - 1) div {COPIES})")).alias("nth"))
    many = F.expr(f"array_repeat(0, int(least({COPIES}L, copies - nth * {COPIES})))")
    return some.select("*", F.explode(many)).select("doc_id", "text", "n_words", "n_removed", "removed")

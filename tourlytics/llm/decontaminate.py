"""Benchmark windows inside documents, by a set join that is filtered on the rarest shingles.

A record of the join is an item-sized window of a benchmark text. It must be contained whole, so its
necessary prefix in an order of rarity is one shingle, the rarest by its count over all documents. Where
a document has that shingle, its place in the window gives the only possible start (positional bound) and
the words left on both sides must be enough (length bound); the words are then compared one by one.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .shared import forget, raw, settle

WINDOW = 10
SHINGLE = 3
BLOCK_BYTES = 4 << 20  # benchmark text that one broadcast holds; larger benchmarks take several, in turn

#: ASCII letters in lower case and digits stay, other ASCII bytes part words, bytes above stay.
_TABLE = bytes(b if b >= 0x80 or chr(b).isalnum() else 0x20 for b in range(256)).lower()
_WORD = r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"
_FOUND = ("n_words", "starts", "ends", "items")
_KINDS = "n_words long, starts array<long>, ends array<long>, items array<string>"
_ODD = np.uint64(0x9E3779B97F4A7C15)


def words_of(text: bytes | None) -> list[bytes]:
    return (text or b"").translate(_TABLE).split()


def _word_hashes(words: list[bytes]) -> np.ndarray:
    return np.fromiter(map(xxhash.xxh3_64_intdigest, words), np.uint64, len(words))


def _shingles(hashes: np.ndarray, width: int) -> np.ndarray:
    """A hash for each run of ``width`` words."""
    n = max(0, len(hashes) - width + 1)
    out = np.zeros(n, np.uint64)
    for i in range(width):
        out = (out ^ (out >> np.uint64(29))) * _ODD + hashes[i : i + n]
    return out


class _Keys:
    """Membership of many hashes in a small sorted set: a bit table first, then a search."""

    def __init__(self, keys: np.ndarray) -> None:
        self.keys = np.unique(keys)
        self.seen = np.zeros(1 << 20, bool)
        self.seen[self.keys >> np.uint64(44)] = True

    def places(self, hashes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Positions in ``hashes`` that are members, and the index of each in ``keys``."""
        at = np.flatnonzero(self.seen[hashes >> np.uint64(44)])
        where = np.minimum(np.searchsorted(self.keys, hashes[at]), max(0, len(self.keys) - 1))
        hit = self.keys[where] == hashes[at] if len(self.keys) else np.zeros(len(at), bool)
        return at[hit], where[hit]


class _Block:
    """Some items and their windows: for each window its item, its start in it, and its size."""

    def __init__(self, rows: list[tuple[str | None, bytes | None]], window: int) -> None:
        found = {(item, tuple(words)) for item, text in rows if (words := words_of(text))}
        found = sorted(found, key=lambda x: (x[0] is None, x[0] or "", x[1]))
        self.ids = [item for item, _ in found]
        self.words = [list(words) for _, words in found]
        counts = [max(1, len(w) - window + 1) for w in self.words]
        self.item = np.repeat(np.arange(len(counts)), counts)
        self.start = np.concatenate([np.arange(n) for n in counts]) if counts else np.empty(0, np.int64)
        self.size = np.repeat([min(window, len(w)) for w in self.words], counts).astype(np.int64)

    def shingles(self, width: int) -> dict[int, tuple[np.ndarray, np.ndarray, np.ndarray]]:
        """By shingle width: window, offset in the window and hash of every shingle of every window."""
        out: dict[int, list[list[np.ndarray]]] = {}
        first = 0
        for words, n in zip(self.words, np.bincount(self.item, minlength=len(self.words)).tolist(), strict=True):
            size = int(self.size[first])
            w = min(width, size)
            hashes, inside = _shingles(_word_hashes(words), w), np.arange(size - w + 1)
            windows, offsets = np.repeat(np.arange(n), len(inside)), np.tile(inside, n)
            parts = out.setdefault(w, [[], [], []])
            for part, x in zip(parts, (windows + first, offsets, hashes[windows + offsets]), strict=True):
                part.append(x)
            first += n
        return {w: tuple(np.concatenate(x) for x in parts) for w, parts in out.items()}


def _stretches(text: bytes, window: int, block_bytes: int) -> Iterator[bytes]:
    """An item's text, or if it is longer than a block its words in stretches that have all its windows, each once."""
    if len(text) <= block_bytes:
        yield text
        return
    words = words_of(text)
    step = max(window, len(words) * block_bytes // len(text))
    for at in range(0, max(1, len(words) - window + 1), step):
        yield b" ".join(words[at : at + step + window - 1])


def _blocks(benchmark: DataFrame, window: int, block_bytes: int) -> Iterator[_Block]:
    """Items in blocks of bounded text; they come to the driver one row after the other."""
    rows, size, some = [], 0, False
    texts = benchmark.select(F.col("item_id").cast("string").alias("i"), F.encode("text", "UTF-8").alias("t"))
    for row in texts.toLocalIterator():
        for text in _stretches(bytes(row["t"] or b""), window, block_bytes):
            rows.append((row["i"], text))
            size += len(text)
            if size >= block_bytes:
                yield _Block(rows, window)
                rows, size, some = [], 0, True
    if rows or not some:
        yield _Block(rows, window)


def _count(keys: dict[int, _Keys]):
    """Counts of the item shingles over the documents of a task."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = {w: np.zeros(len(k.keys), np.int64) for w, k in keys.items()}
        for batch in batches:
            for text in raw(batch):
                hashes = _word_hashes(words_of(text))
                for w, known in keys.items():
                    _, which = known.places(_shingles(hashes, w))
                    if len(which):
                        total[w] += np.bincount(which, minlength=len(known.keys))
        for w, counts in total.items():
            used = np.flatnonzero(counts)
            yield pa.RecordBatch.from_pydict(
                {
                    "width": pa.array(np.full(len(used), w, np.int32)),
                    "shingle": pa.array(used, pa.int64()),
                    "n": pa.array(counts[used], pa.int64()),
                }
            )

    return run


class _Index:
    """For each shingle width the prefix shingles, and by shingle the windows with its place in them."""

    def __init__(self, docs: DataFrame, block: _Block, width: int) -> None:
        self.block = block
        by_width = block.shingles(width)
        keys = {w: _Keys(hashes) for w, (_, _, hashes) in by_width.items()}
        counts = {w: np.zeros(len(k.keys), np.int64) for w, k in keys.items()}
        if keys:
            shared = docs.sparkSession.sparkContext.broadcast(keys)
            seen = docs.select("text").mapInArrow(lambda it: _count(shared.value)(it), "width int, shingle long, n long")
            for row in seen.groupBy("width", "shingle").agg(F.sum("n").alias("n")).toLocalIterator():
                counts[row["width"]][row["shingle"]] = row["n"]
            shared.unpersist()
        self.keys: dict[int, _Keys] = {}
        self.entries: dict[int, tuple[np.ndarray, np.ndarray, np.ndarray]] = {}
        for w, (windows, offsets, hashes) in by_width.items():
            rarity = counts[w][np.searchsorted(keys[w].keys, hashes)]
            order = np.lexsort((offsets, hashes, rarity, windows))
            best = order[np.unique(windows[order], return_index=True)[1]]  # the rarest shingle of each window
            best = best[np.argsort(hashes[best], kind="stable")]
            self.keys[w] = _Keys(hashes[best])
            first = np.searchsorted(hashes[best], self.keys[w].keys)
            self.entries[w] = (np.append(first, len(best)), windows[best], offsets[best])

    def find(self, words: list[bytes]) -> Iterator[tuple[int, int, int]]:
        """Item, start and end of every window that the document has."""
        hashes, block = _word_hashes(words), self.block
        for w, known in self.keys.items():
            first, windows, offsets = self.entries[w]
            for p, which in zip(*(x.tolist() for x in known.places(_shingles(hashes, w))), strict=True):
                for k in range(first[which], first[which + 1]):
                    window, start = windows[k], p - int(offsets[k])
                    end, at = start + int(block.size[window]), int(block.start[window])
                    if start < 0 or end > len(words):
                        continue
                    item = int(block.item[window])
                    if words[start:end] == block.words[item][at : at + end - start]:
                        yield item, start, end


def _merged(spans: Iterable[tuple[int, int]]) -> tuple[list[int], list[int]]:
    """Starts and ends of the stretches that the spans cover."""
    merged: list[list[int]] = []
    for a, b in sorted(spans):
        if merged and a <= merged[-1][1]:
            merged[-1][1] = max(b, merged[-1][1])
        else:
            merged.append([a, b])
    return [a for a, _ in merged], [b for _, b in merged]


def _scan(shared, left_out: tuple[str, ...] = ()):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        index: _Index = shared.value
        for batch in batches:
            count, starts, ends, items = [], [], [], []
            for text in raw(batch):
                words, ids, spans = words_of(text), set(), set()
                for item, start, end in index.find(words):
                    spans.add((start, end))
                    if index.block.ids[item] is not None:
                        ids.add(index.block.ids[item])
                begin, stop = _merged(spans)
                count.append(len(words))
                starts.append(begin)
                ends.append(stop)
                items.append(sorted(ids))
            kept = [n for n in batch.schema.names if n not in left_out]
            lists = pa.list_(pa.int64())
            found = [pa.array(count, pa.int64()), pa.array(starts, lists), pa.array(ends, lists), pa.array(items, pa.list_(pa.string()))]
            yield pa.RecordBatch.from_arrays([batch.column(n) for n in kept] + found, kept + list(_FOUND))

    return run


def _together(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """What several blocks have found in a text, as one."""
    for batch in batches:
        starts, ends, items = [], [], []
        columns = (batch.column(n).to_pylist() for n in ("starts", "ends", "items"))
        for s, e, i in zip(*columns, strict=True):
            begin, stop = _merged((x, y) for a, b in zip(s, e, strict=True) for x, y in zip(a, b, strict=True))
            starts.append(begin)
            ends.append(stop)
            items.append(sorted({x for some in i for x in some}))
        lists = pa.list_(pa.int64())
        found = [batch.column("key"), pa.array(starts, lists), pa.array(ends, lists), pa.array(items, pa.list_(pa.string()))]
        yield pa.RecordBatch.from_arrays(found, ["key", *_FOUND[1:]])


def _by_text(docs: DataFrame, blocks: Iterator[_Block], shingle: int) -> DataFrame:
    """key (digest of a text), starts, ends and items of the texts in which some block has windows; written."""
    texts, each = docs.select(F.sha2("text", 256).alias("key"), "text"), []
    for block in blocks:
        shared = docs.sparkSession.sparkContext.broadcast(_Index(docs, block, shingle))
        hits = texts.mapInArrow(_scan(shared, ("text",)), f"key string, {_KINDS}").where(F.size("starts") > 0)
        each.append(settle(hits.dropDuplicates(["key"]).drop("n_words"), "leaks"))
        shared.unpersist()
    every = each[0]
    for more in each[1:]:
        every = every.union(more)
    lists = every.groupBy("key").agg(*[F.collect_list(n).alias(n) for n in _FOUND[1:]])  # at most a row a block each
    found = settle(lists.mapInArrow(_together, f"key string, {_KINDS.split(', ', 1)[1]}"), "leaks")
    for one in each:
        forget(one)
    return found


def leaks(docs: DataFrame, benchmark: DataFrame, window: int = WINDOW, shingle: int = SHINGLE, block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """The rows of ``docs`` with n_words, starts and ends of hit word spans (merged), items: sorted ids as strings.

    A window is ``window`` consecutive words of an item; an item of fewer words, but not none, is one
    window. Null and empty texts have no words and no hits; items without words hit
    nothing, those without an id hit words but are not listed; repeated items and windows count once. One row for each row of ``docs``, repeated ids too;
    columns of the added names are replaced. The benchmark is held in blocks of ``block_bytes`` of text: each
    block counts its shingles over all documents and searches them, so that a task holds one block at a time; an
    item longer than a block takes several. Of several blocks each writes its hits, a row for each text that has
    some, and the rows are joined with what all have found by the text's digest; the documents are not written.
    """
    rows = docs.drop(*_FOUND)
    blocks = _blocks(benchmark, window, block_bytes)
    first, second = next(blocks), next(blocks, None)
    if second is None:
        shared = docs.sparkSession.sparkContext.broadcast(_Index(docs, first, shingle))
        kind = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in rows.schema.fields)
        return rows.mapInArrow(_scan(shared), f"{kind}, {_KINDS}")
    found = _by_text(docs, chain([first, second], blocks), shingle)
    keyed = rows.select(F.struct("*").alias("row"), F.sha2("text", 256).alias("key"))
    words = F.coalesce(F.regexp_count("row.text", F.lit(_WORD)), F.lit(0)).cast("long").alias("n_words")
    lists = [F.coalesce(n, F.array().cast(found.schema[n].dataType)).alias(n) for n in _FOUND[1:]]
    return keyed.join(found, "key", "left").select("row.*", words, *lists)


def contaminated(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """doc_id, n_words, items, n_hit, n_items, contaminated of each document; see ``leaks``."""
    found = leaks(docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text"), benchmark)
    hit = F.aggregate(F.zip_with("starts", "ends", lambda a, b: b - a), F.lit(0).cast("long"), lambda x, y: x + y)
    return found.select(
        "doc_id", "n_words", "items", hit.alias("n_hit"), F.size("items").cast("long").alias("n_items"), (F.size("starts") > 0).alias("contaminated")
    )


def clean(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """The rows of ``docs`` that hold no benchmark window, with their columns."""
    found = leaks(docs.select(F.struct("*").alias("row"), "text"), benchmark)
    return found.where(F.size("starts") == 0).select("row.*")

"""SimHash near-duplicates: fingerprints, and links within a few bits found by balls that meet in the middle.

A fingerprint within three bits of another shares a word with it that is one bit away from each, once
the bits of one third are left out: three differing bits that do not lie in one third leave a third
with exactly one of them, two or fewer leave a third with none. So each fingerprint emits, for each
third, itself and its one-bit variants in the other two thirds (131 words instead of the 2,081 of a
ball of two bits). Words are dealt out by all bits but those of the third. Three bits inside one third
are found among fingerprints that are equal elsewhere, by balls of one and two bits in that third.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .components import connected
from .shared import parts, raw, settle

SEED = 42
RADIUS = 3
THIRDS = ((0, 21), (21, 42), (42, 64))  # bit ranges, from the lowest bit
WORDS_PER_BUCKET = 1_000_000
BLOCK = 65_536  # shingles hashed at once

_ONE = np.uint64(1)
_MIX = np.uint64(0x9E3779B97F4A7C15)


def _fingerprint(text: bytes | None, width: int) -> int:
    """Bits set in over half the hashes of the shingles; zero without words."""
    words = (text or b"").lower().split()
    if not words:
        return 0
    line, n = b" ".join(words), max(1, len(words) - width + 1)
    ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1) - 1
    starts = np.concatenate(([0], ends[:-1] + 1))[:n]
    ends, digest = ends[len(ends) - n :], xxhash.xxh64_intdigest
    total = np.zeros(64, np.int64)
    for i in range(0, n, BLOCK):
        spans = zip(starts[i : i + BLOCK].tolist(), ends[i : i + BLOCK].tolist(), strict=True)
        block = np.array([digest(line[a:b], SEED) for a, b in spans], dtype="<u8")
        total += np.unpackbits(block.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    set_bits = total * 2 > n
    return int(np.packbits(set_bits, bitorder="little").view("<u8")[0])


def fingerprints(docs: DataFrame, width: int = 3) -> DataFrame:
    """doc_id, the hash of the text and the fingerprint of the whole text, as a long with the same 64 bits.

    Null and empty texts get zero. One row for each row of the input, repeated ids too.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = np.array([_fingerprint(t, width) for t in raw(batch)], np.uint64).astype(np.int64)
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), batch.column("text_key"), pa.array(found, pa.int64())], ["doc_id", "text_key", "fp"])

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.xxhash64("text").alias("text_key"), "text")
    return rows.mapInArrow(run, "doc_id long, text_key long, fp long")


def _third_mask(low: int, high: int) -> np.uint64:
    return np.uint64(((1 << high) - 1) & ~((1 << low) - 1))


def _words(fps: np.ndarray, low: int, high: int) -> np.ndarray:
    """Each fingerprint and its one-bit variants outside a third, one row a fingerprint."""
    flips = np.array([0] + [1 << i for i in range(64) if not low <= i < high], np.uint64)
    return fps[:, None] ^ flips[None, :]


def _deal(buckets: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            fps = np.asarray(batch.column("fp"), np.int64).view(np.uint64)
            for third, (low, high) in enumerate(THIRDS):
                words = _words(fps, low, high)
                key = words & ~_third_mask(low, high)
                key = (key ^ (key >> np.uint64(31))) * _MIX
                place = ((key ^ (key >> np.uint64(29))) * _MIX >> np.uint64(33)) % np.uint64(buckets)
                owner = np.repeat(fps, words.shape[1])
                words, place = words.ravel(), place.ravel().astype(np.int32)
                order = np.argsort(place, kind="stable")
                used, first = np.unique(place[order], return_index=True)
                cuts = first[1:]
                yield pa.RecordBatch.from_pydict(
                    {
                        "bucket": pa.array(used, pa.int32()),
                        "third": pa.array(np.full(len(used), third, np.int32)),
                        "words": pa.array([x.tobytes() for x in np.split(words[order], cuts)], pa.binary()),
                        "owners": pa.array([x.tobytes() for x in np.split(owner[order], cuts)], pa.binary()),
                    }
                )

    return run


def _meet(words: np.ndarray, owners: np.ndarray, low: int, high: int) -> list[tuple[np.ndarray, np.ndarray]]:
    """Links among the words of one third: linear in the words, no pairs of a group."""
    mask = _third_mask(low, high)
    key = words & ~mask
    order = np.lexsort((owners, words, key))
    key, words, owners = key[order], words[order], owners[order]
    same_key = key[1:] == key[:-1]
    busy = np.zeros(len(key), bool)
    busy[1:] |= same_key
    busy[:-1] |= same_key
    key, words, owners = key[busy], words[busy], owners[busy]
    if not len(key):
        return []
    same = words[1:] == words[:-1]
    links = [(owners[1:][same], owners[:-1][same])]  # both one bit from one word
    distinct, first = np.unique(words, return_index=True)
    lead = owners[first]
    for bit in range(low, high):  # words that differ by one bit of the third
        other = distinct ^ np.uint64(1 << bit)
        at = np.minimum(np.searchsorted(distinct, other), len(distinct) - 1)
        hit = (distinct[at] == other) & (distinct < other)
        links.append((lead[hit], lead[at[hit]]))
    links += _inside(owners[words == owners], mask, low, high)
    return links


def _inside(fps: np.ndarray, mask: np.uint64, low: int, high: int) -> list[tuple[np.ndarray, np.ndarray]]:
    """Links of fingerprints that are equal outside a third and differ by three bits in it."""
    fps = np.unique(fps)
    key = fps & ~mask
    order = np.argsort(key, kind="stable")
    fps, key = fps[order], key[order]
    same = key[1:] == key[:-1]
    busy = np.zeros(len(key), bool)
    busy[1:] |= same
    busy[:-1] |= same
    fps = fps[busy]
    if not len(fps):
        return []
    single = np.array([1 << i for i in range(low, high)], np.uint64)
    near = (fps[:, None] ^ single[None, :]).ravel()
    near_owner = np.repeat(fps, len(single))
    near, first = np.unique(near, return_index=True)
    near_owner, links = near_owner[first], []
    for a, b in combinations(range(low, high), 2):
        other = fps ^ np.uint64((1 << a) | (1 << b))
        at = np.minimum(np.searchsorted(near, other), len(near) - 1)
        hit = near[at] == other
        links.append((fps[hit], near_owner[at[hit]]))
    return links


def _link(group: pa.Table) -> pa.Table:
    a, b = [np.empty(0, np.uint64)], [np.empty(0, np.uint64)]
    thirds = group.column("third").to_numpy()
    for third, (low, high) in enumerate(THIRDS):
        mine = group.filter(pa.array(thirds == third))
        words = np.frombuffer(b"".join(mine.column("words").to_pylist()), np.uint64)
        owners = np.frombuffer(b"".join(mine.column("owners").to_pylist()), np.uint64)
        for x, y in _meet(words, owners, low, high):
            a.append(x)
            b.append(y)
    x, y = np.concatenate(a), np.concatenate(b)
    pairs = np.unique(np.stack((np.maximum(x, y), np.minimum(x, y)), axis=1)[x != y], axis=0)
    return pa.table({"a": pa.array(pairs[:, 0].view(np.int64)), "b": pa.array(pairs[:, 1].view(np.int64))})


def links(distinct: DataFrame) -> DataFrame:
    """(a, b) fingerprints that differ by at most three bits, enough of them to tie all that are so tied.

    ``distinct`` has one row a fingerprint in ``fp``. Every two fingerprints within three bits are in
    one component of the result, and no pair of the result is farther apart.
    """
    rows = distinct.count()
    buckets = parts(rows * 131, WORDS_PER_BUCKET, 32)
    dealt = distinct.select("fp").mapInArrow(_deal(buckets), "bucket int, third int, words binary, owners binary")
    found = dealt.groupBy("bucket").applyInArrow(_link, "a long, b long")
    return found.distinct().where(F.bit_count(F.col("a").bitwiseXOR(F.col("b"))) <= RADIUS)


def _groups(docs: DataFrame, width: int) -> tuple[DataFrame, DataFrame]:
    """The fingerprints of the rows, and for each fingerprint its group (a fingerprint) and the group's least id."""
    prints = settle(fingerprints(docs, width), "fingerprints")
    lowest = settle(prints.groupBy("fp").agg(F.min("doc_id").alias("lowest")), "distinct")
    tied = connected(links(lowest)).select(F.col("node").alias("fp"), "component")
    named = lowest.join(tied, "fp", "left").withColumn("component", F.coalesce("component", "fp"))
    # Written first, so that both sides of the join are plain shuffles and a giant component can be split.
    least = settle(named.groupBy("component").agg(F.min("lowest").alias("component_id")), "least")
    return prints, named.join(least, "component").select("fp", "component", "component_id")


def near_duplicates(docs: DataFrame, width: int = 3) -> DataFrame:
    """doc_id, fp (long) and component_id: the smallest doc_id reachable over links of up to three bits.

    Equal texts collapse to one fingerprint before anything is compared, so a group of copies costs one
    row. Null and empty texts have fingerprint zero and are linked like any other. Rows with a null
    doc_id keep their place in the linking; they never name a component unless all ids in it are null.
    """
    prints, groups = _groups(docs, width)
    return prints.join(groups, "fp").select("doc_id", "fp", "component_id")


def one_of_each(docs: DataFrame, width: int = 3) -> DataFrame:
    """One row of each group of near-duplicates: that of the smallest doc_id, with the columns of ``docs``.

    Rows without an id stand behind the others of their group; of rows that share the id, that of the least
    hash of the text stays, once.
    """
    prints, groups = _groups(docs, width)
    first = F.min(F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "text_key")).alias("first")
    kept = prints.join(groups, "fp").groupBy("component").agg(first).select("first.none", "first.doc_id", "first.text_key").distinct()
    named = [F.coalesce("doc_id", F.lit(0)).cast("long").alias("id"), F.col("doc_id").isNull().alias("none")]
    rows = docs.select(F.struct("*").alias("row"), *named, F.xxhash64("text").alias("key"))
    # Repeated rows go before the texts are shuffled, once: the join has the same keys.
    single = rows.dropDuplicates(["id", "none", "key"])
    return single.join(kept.select(*named, F.col("text_key").alias("key")), ["id", "none", "key"], "left_semi").select("row.*")


def hex_digits(column: Column) -> Column:
    """Sixteen lowercase hex digits of a long."""
    return F.lpad(F.lower(F.hex(column)), 16, "0")

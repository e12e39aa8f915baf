"""Runs of words that repeat with a period, found by block convolution with exact number-theoretic transforms.

At scale L = 1, 2, 4, ... a text is cut into blocks of L words. The sum of squared differences between a block
and the words at every distance d of L to 2L - 1 behind it comes from one cyclic convolution of 2L numbers
modulo a prime; where it is zero, the block occurs again. A run of period q and at least four periods holds
an aligned block of the scale with L <= q < 2L and its copy at distance q, so every run is met; distances
are then extended word by word, which also refuses a sum that is only zero modulo the prime.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .shared import raw

PRIME, GENERATOR = 998_244_353, 3  # PRIME - 1 is a multiple of 2^23
LEAST_WORDS, LEAST_PERIODS = 6, 4
WORDS_AT_ONCE = 1 << 17  # texts are searched together up to so many words, a longer one alone
NUMBERS_AT_ONCE = 1 << 19  # in one matrix of transforms

_P = np.uint64(PRIME)
_RUN = pa.struct([("start", pa.int64()), ("length", pa.int64()), ("period", pa.int64())])


def _reduced(x: np.ndarray) -> np.ndarray:
    return x - x // _P * _P


def _powers(root: int, count: int) -> np.ndarray:
    """1, root, root^2, ... by doubling."""
    out = np.ones(1, np.uint64)
    while len(out) < count:
        out = np.concatenate((out, _reduced(out * np.uint64(pow(root, len(out), PRIME)))))
    return out[:count]


class Transform:
    """Transforms of rows of ``size`` numbers below PRIME, ``size`` a power of two."""

    def __init__(self, size: int):
        self.size = size
        root = pow(GENERATOR, (PRIME - 1) // size, PRIME)
        self.forth = _powers(root, size // 2)
        self.back = _powers(pow(root, PRIME - 2, PRIME), size // 2)
        self.share = np.uint64(pow(size, PRIME - 2, PRIME))

    def forward(self, rows: np.ndarray) -> np.ndarray:
        """The spectrum, in bit-reversed order."""
        half = self.size // 2
        while half:
            pairs = rows.reshape(len(rows), -1, 2, half)
            u, v = pairs[:, :, 0], pairs[:, :, 1]
            out = np.empty_like(pairs)
            out[:, :, 0] = _reduced(u + v)
            out[:, :, 1] = _reduced((u + _P - v) * self.forth[:: self.size // (2 * half)])
            rows, half = out, half // 2
        return rows.reshape(len(rows), self.size)

    def inverse(self, rows: np.ndarray) -> np.ndarray:
        half = 1
        while half < self.size:
            pairs = rows.reshape(len(rows), -1, 2, half)
            u, v = pairs[:, :, 0], _reduced(pairs[:, :, 1] * self.back[:: self.size // (2 * half)])
            out = np.empty_like(pairs)
            out[:, :, 0] = _reduced(u + v)
            out[:, :, 1] = _reduced(u + _P - v)
            rows, half = out, half * 2
        return _reduced(rows.reshape(len(rows), self.size) * self.share)


def occurrences(values: np.ndarray, starts: np.ndarray, width: int, way: Transform) -> tuple[np.ndarray, np.ndarray]:
    """(start, distance) of the blocks of ``width`` words at ``starts`` that occur again ``width`` to 2 width - 1 on.

    ``values`` has numbers below PRIME and goes on for two more blocks behind the last start.
    """
    size = 2 * width
    block = values[starts[:, None] + np.arange(width)]
    window = values[starts[:, None] + np.arange(width, width + size)]
    window[:, -1] = 0  # the copy at the greatest distance ends before it
    turned = np.zeros((len(starts), size), np.uint64)
    turned[:, 0] = block[:, 0]
    turned[:, width + 1 :] = block[:, :0:-1]
    product = way.inverse(_reduced(way.forward(turned) * way.forward(window)))[:, :width]
    squares = _reduced(window * window)
    passed = np.concatenate((np.zeros((len(starts), 1), np.uint64), np.cumsum(squares, axis=1)), axis=1)
    there = passed[:, width : 2 * width] - passed[:, :width] + _reduced(block * block).sum(axis=1)[:, None]
    row, apart = np.nonzero(_reduced(there) == _reduced(product + product))
    return starts[row], apart + width


def _same(ids: np.ndarray, at: int, distance: int, step: int) -> int:
    """How many words on from ``at`` (step 1) or back from it (step -1) equal the word ``distance`` behind them."""
    count, chunk = 0, 16
    last = len(ids) - distance if step > 0 else -1
    while True:
        to = at + step * chunk
        to = min(to, last) if step > 0 else max(to, last)
        if to == at:
            return count
        low, high = (at, to) if step > 0 else (to + 1, at + 1)
        equal = ids[low:high] == ids[low + distance : high + distance]
        if not equal.all():
            return count + int(np.argmin(equal if step > 0 else equal[::-1]))
        count, at, chunk = count + high - low, to, chunk * 4


def _extended(ids: np.ndarray, starts: np.ndarray, distances: np.ndarray) -> set[tuple[int, int, int]]:
    """The runs (start, length, distance) that the seeds lie in, of at least LEAST_PERIODS distances."""
    found, done = set(), {}
    for at, distance in zip(starts.tolist(), distances.tolist()):  # ascending by place
        if at < done.get(distance, 0):
            continue
        ahead = _same(ids, at, distance, 1)
        low = at - _same(ids, at - 1, distance, -1) if at else 0
        done[distance] = at + ahead
        length = at + ahead - low + distance
        if ahead and length >= max(LEAST_WORDS, LEAST_PERIODS * distance):
            found.add((low, length, distance))
    return found


def runs_of(ids: np.ndarray, longest: int) -> list[tuple[int, int, int]]:
    """All maximal runs (start, length, smallest period) in words numbered from 0; no run is longer than ``longest``."""
    n = len(ids)
    order = np.argsort(ids, kind="stable")
    later = np.full(n, n, np.int64)  # distance to the same word's next place
    same = ids[order[1:]] == ids[order[:-1]]
    later[order[:-1][same]] = (order[1:] - order[:-1])[same]
    found: dict[tuple[int, int], int] = {}
    width = 1
    while width * LEAST_PERIODS <= longest:
        full = n // width
        near = later[: full * width].reshape(full, width).max(axis=1)
        starts = np.flatnonzero(near < 2 * width) * width  # in a copy every word comes again
        if len(starts):
            values = np.concatenate((ids.astype(np.uint64), np.zeros(2 * width, np.uint64)))
            way, rows = Transform(2 * width), max(1, NUMBERS_AT_ONCE // (2 * width))
            seeds = [occurrences(values, starts[k : k + rows], width, way) for k in range(0, len(starts), rows)]
            at, apart = (np.concatenate(x) for x in zip(*seeds))
            inside = at + apart + width <= n
            at, apart = at[inside], apart[inside]
            known = sorted((low, low + length) for low, length in found)
            if known:  # a copy inside a run of a smaller period tells of that run only
                lows, ends = np.array([k[0] for k in known]), np.maximum.accumulate([k[1] for k in known])
                place = np.searchsorted(lows, at, side="right") - 1
                new = (place < 0) | (ends[place] < at + apart + width)
                at, apart = at[new], apart[new]
            for low, length, period in _extended(ids, at, apart):
                key = (low, length)
                found[key] = min(period, found.get(key, period))
        width *= 2
    return sorted((low, length, period) for (low, length), period in found.items())


def _numbered(texts: list[list[bytes]]) -> np.ndarray:
    """The words of some texts as numbers; texts share none."""
    words = pa.array([w for ws in texts for w in ws], pa.binary()).dictionary_encode()
    owner = np.repeat(np.arange(len(texts)), [len(ws) for ws in texts])
    both = owner * len(words.dictionary) + words.indices.to_numpy(zero_copy_only=False)
    return np.unique(both, return_inverse=True)[1]


def _searched(texts: list[list[bytes]]) -> tuple[list[list[dict]], list[bytes]]:
    lengths = np.array([len(ws) for ws in texts], np.int64)
    ends = np.cumsum(lengths)
    runs: list[list[dict]] = [[] for _ in texts]
    dropped = np.zeros(int(ends[-1]) + 1, np.int64)
    if lengths.max() >= LEAST_WORDS:
        for low, length, period in runs_of(_numbered(texts), int(lengths.max())):
            at = int(np.searchsorted(ends, low, side="right"))
            runs[at].append({"start": low - int(ends[at] - lengths[at]), "length": length, "period": period})
            dropped[low + period] += 1
            dropped[low + length] -= 1
    kept = np.cumsum(dropped) == 0
    collapsed = []
    for words, found, end in zip(texts, runs, ends.tolist()):
        mine = kept[end - len(words) : end].tolist() if found else ()
        collapsed.append(b" ".join([w for w, k in zip(words, mine) if k] if found else words))
    return runs, collapsed


def _search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        texts, begin, held = raw(batch), 0, 0
        words: list[list[bytes]] = []
        for at, text in enumerate(texts):
            words.append((text or b"").split())  # bytes split at ASCII blanks: 20 and 09 to 0D
            held += len(words[-1])
            if held >= WORDS_AT_ONCE or at == len(texts) - 1:
                runs, collapsed = _searched(words)
                counts = pa.array([len(ws) for ws in words], pa.int64())
                row = batch.column("row").slice(begin, len(words))
                columns = [row, counts, pa.array(runs, pa.list_(_RUN)), pa.array(collapsed, pa.binary()).cast(pa.string())]
                yield pa.RecordBatch.from_arrays(columns, ["row", "n_words", "runs", "collapsed"])
                begin, held, words = at + 1, 0, []


def periodic_runs(docs: DataFrame, keep: Sequence[str] = ("doc_id",), text: Column | str = "text") -> DataFrame:
    """``row`` (struct of ``keep``), n_words, runs (array of start, length, period) and collapsed of every row.

    Words are ``[^\\x20\\x09-\\x0D]+``, numbered from 0. A run is a stretch of words with smallest period q, at least
    six words and four periods long, that no neighbouring word extends; runs come by start, then
    length. ``collapsed`` is the words that no run holds behind its first period, joined by one space.

    Every row is searched whole and for itself, in the task that reads it: nothing is shuffled, memory is a
    few times one text. Null and empty texts have no words, no runs and an empty ``collapsed``; repeated rows
    repeat; an empty table gives no rows; other columns never matter.
    """
    rows = docs.select(F.struct(*keep).alias("row"), (F.col(text) if isinstance(text, str) else text).alias("text"))
    kind = rows.schema["row"].dataType.simpleString()
    runs = "runs array<struct<start:bigint,length:bigint,period:bigint>>"
    return rows.mapInArrow(_search, f"row {kind}, n_words bigint, {runs}, collapsed string")


def with_periodic_tail(text: Column, doc_id: Column) -> Column:
    """The text, or for a tenth of the ids its words with a tail made periodic: a trial for searches like this.

    With h the checksum of the decimal id and g = h div 10, a text of n words with h mod 10 = 0 repeats its
    p = 1 + (n - a) div (3 + g mod 8) words from a = g mod n on to its end. Null ids leave the text alone.
    """
    h = F.crc32(doc_id.cast("string"))
    words = F.filter(F.split(text, r"[\x20\x09-\x0D]+"), lambda w: w != "")

    def tailed(ws: Column) -> Column:
        n = F.size(ws).cast("bigint")
        g = F.floor(h / 10)
        plan = F.struct((g % n).alias("a"), F.call_function("div", n - g % n, 3 + g % 8).alias("more"))
        return F.transform(
            F.array(plan),
            lambda p: F.array_join(
                F.transform(
                    ws, lambda w, i: F.when(i < p["a"], w).otherwise(F.get(ws, (p["a"] + (i - p["a"]) % (1 + p["more"])).cast("int")))
                ),
                " ",
            ),
        )[0]

    # Inside a lambda the words are bound once; an empty text has none to repeat.
    made = F.transform(F.array(words), lambda ws: F.when(F.size(ws) > 0, tailed(ws)).otherwise(text))[0]
    return F.when(h % 10 == 0, made).otherwise(text)

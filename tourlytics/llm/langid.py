"""Language of texts by a byte convolutional network, trained in numpy.

Filters of several widths run over fixed-length windows of bytes; each filter's largest value in a window
goes through a rectifier into a softmax. A text's prediction is the mean over all its windows, weighted
by their letters. Bytes are folded first: letters to lower case, digits to one class, other ASCII to
blank or one mark, bytes above ASCII as they are.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .shared import raw

WINDOW = 256
WIDTHS = (2, 3, 4)
FILTERS = 16
SAMPLE_ROWS = 4000  # labelled rows that the network is fitted on, dealt evenly over the languages
SHARES = 64  # in which the rows of a language are ranked
WINDOWS_PER_ROW = 10
EPOCHS = 8
BATCH = 64
AT_ONCE = 512  # windows scored together
UNKNOWN = "und"

_BLANK, _DIGIT, _MARK, _HIGH = 26, 27, 28, 29
CLASSES = _HIGH + 128


def _fold() -> np.ndarray:
    out = np.full(256, _MARK, np.uint8)
    out[[9, 10, 11, 12, 13, 32]] = _BLANK
    out[ord("0") : ord("9") + 1] = _DIGIT
    out[ord("a") : ord("z") + 1] = out[ord("A") : ord("Z") + 1] = np.arange(26)
    out[128:] = np.arange(_HIGH, CLASSES)
    return out


_FOLD = _fold()


def windows_of(text: bytes) -> np.ndarray:
    """The whole text as rows of WINDOW classes; the last row is filled up with blanks."""
    codes = _FOLD[np.frombuffer(text, np.uint8)]
    out = np.full(max(1, -(-len(codes) // WINDOW)) * WINDOW, _BLANK, np.uint8)
    out[: len(codes)] = codes
    return out.reshape(-1, WINDOW)


def has_letter(text: bytes | None) -> bool:
    if not text:
        return False
    codes = _FOLD[np.frombuffer(text, np.uint8)]
    return bool((codes < 26).any()) or any(map(str.isalpha, text.decode()))


@dataclass
class Network:
    languages: list[str]
    filters: dict[int, np.ndarray]  # by width: (width, class, filter)
    bias: np.ndarray
    dense: np.ndarray
    offset: np.ndarray
    _pairs: dict = field(default_factory=dict, repr=False)

    @classmethod
    def start(cls, languages: list[str], seed: int = 0) -> Network:
        rng, hidden = np.random.default_rng(seed), FILTERS * len(WIDTHS)
        filters = {w: rng.normal(0, 0.3, (w, CLASSES, FILTERS)).astype(np.float32) for w in WIDTHS}
        dense = rng.normal(0, 0.2, (hidden, len(languages))).astype(np.float32)
        return cls(languages, filters, np.zeros(hidden, np.float32), dense, np.zeros(len(languages), np.float32))

    def __getstate__(self) -> dict:
        return self.__dict__ | {"_pairs": {}}

    def parameters(self) -> list[np.ndarray]:
        return [*self.filters.values(), self.bias, self.dense, self.offset]

    def convolve(self, codes: np.ndarray, width: int) -> np.ndarray:
        """(window, place, filter) values of the filters of one width."""
        f, places = self.filters[width], codes.shape[1] - width + 1
        out = f[0].take(codes[:, :places], axis=0)
        for j in range(1, width):
            out += f[j].take(codes[:, j : j + places], axis=0)
        return out

    def pooled(self, codes: np.ndarray) -> np.ndarray:
        """Largest value of each filter, with the filters' bytes looked up two at a time."""
        if not self._pairs:
            for w, f in self.filters.items():
                pairs = [(f[j][:, None, :] + f[j + 1][None, :, :]).reshape(-1, FILTERS) for j in range(0, w - 1, 2)]
                self._pairs[w] = pairs + ([f[w - 1]] if w % 2 else [])
        codes = codes.astype(np.intp)
        two, out = codes[:, :-1] * CLASSES + codes[:, 1:], []
        for w, tables in self._pairs.items():
            places = codes.shape[1] - w + 1
            value = tables[0].take(two[:, :places], axis=0)
            for j, t in enumerate(tables[1:], 1):
                at = two[:, 2 * j : 2 * j + places] if len(t) > CLASSES else codes[:, 2 * j : 2 * j + places]
                value += t.take(at, axis=0)
            out.append(value.max(axis=1))
        return np.concatenate(out, axis=1)

    def probabilities(self, codes: np.ndarray) -> np.ndarray:
        return softmax(np.maximum(self.pooled(codes) + self.bias, 0) @ self.dense + self.offset)

    def gradients(self, codes: np.ndarray, wanted: np.ndarray) -> list[np.ndarray]:
        peaks, tops = [], []
        for w in WIDTHS:
            value = self.convolve(codes, w)
            at = value.argmax(axis=1)
            peaks.append(at)
            tops.append(np.take_along_axis(value, at[:, None, :], axis=1)[:, 0, :])
        hidden = np.maximum(np.concatenate(tops, axis=1) + self.bias, 0)
        error = softmax(hidden @ self.dense + self.offset)
        error[np.arange(len(wanted)), wanted] -= 1
        error /= len(wanted)
        back = (error @ self.dense.T) * (hidden > 0)
        out, rows, columns = [], np.arange(len(codes))[:, None], np.arange(FILTERS)[None, :]
        for k, w in enumerate(WIDTHS):
            grad = np.zeros_like(self.filters[w])
            share = back[:, k * FILTERS : (k + 1) * FILTERS]
            for j in range(w):
                np.add.at(grad[j], (codes[rows, peaks[k] + j], np.broadcast_to(columns, share.shape)), share)
            out.append(grad)
        return [*out, back.sum(axis=0), hidden.T @ error, error.sum(axis=0)]


def softmax(x: np.ndarray) -> np.ndarray:
    e = np.exp(x - x.max(axis=1, keepdims=True))
    return e / e.sum(axis=1, keepdims=True)


def train(codes: np.ndarray, labels: list[str], epochs: int = EPOCHS, seed: int = 0) -> Network:
    """Fits a network on windows and their languages, by Adam; the same rows give the same network."""
    languages = sorted(set(labels))
    net, rng = Network.start(languages, seed), np.random.default_rng(seed)
    wanted = np.array([languages.index(x) for x in labels], np.int64)
    state = [(np.zeros_like(p), np.zeros_like(p)) for p in net.parameters()]
    step, total = 0, epochs * -(-len(codes) // BATCH)
    for _ in range(epochs):
        order = rng.permutation(len(codes))
        for i in range(0, len(order), BATCH):
            some, step = order[i : i + BATCH], step + 1
            rate = 0.01 * (1 - step / (total + 1))
            for p, (m, v), g in zip(net.parameters(), state, net.gradients(codes[some], wanted[some]), strict=True):
                m += 0.1 * (g - m)
                v += 0.01 * (g * g - v)
                p -= rate * (m / (1 - 0.9**step)) / (np.sqrt(v / (1 - 0.99**step)) + 1e-7)
    return net


def remainder(doc_id: Column) -> Column:
    """crc32 of the id as text, modulo 4; null without an id."""
    return F.crc32(doc_id.cast("string")) % 4


def _samples(per_row: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keys, places, labels, out = [], [], [], []
            for label, key, text in zip(batch.column("lang").to_pylist(), batch.column("key").to_pylist(), raw(batch), strict=True):
                if not has_letter(text):
                    continue
                codes, rng = _FOLD[np.frombuffer(text, np.uint8)], np.random.default_rng(key % 2**32)
                for k in range(min(per_row, 2 + len(codes) // WINDOW * 2)):
                    size = WINDOW if k % 2 == 0 else int(rng.integers(12, WINDOW))
                    at = int(rng.integers(0, max(1, len(codes) - size + 1)))
                    row = np.full(WINDOW, _BLANK, np.uint8)
                    some = codes[at : at + size]
                    row[: len(some)] = some
                    keys.append(key)
                    places.append(k)
                    labels.append(label)
                    out.append(row.tobytes())
            columns = [pa.array(keys, pa.int64()), pa.array(places, pa.int32()), pa.array(labels, pa.string()), pa.array(out, pa.binary())]
            yield pa.RecordBatch.from_arrays(columns, ["key", "place", "lang", "codes"])

    return run


def fit(labelled: DataFrame, sample_rows: int = SAMPLE_ROWS, per_row: int = WINDOWS_PER_ROW) -> Network:
    """Fits the network on at most ``sample_rows`` rows with a text and a lang, spread over the languages.

    ``labelled`` has doc_id, text and lang. Ids are taken by their hash, a like number of each language as
    far as there are any, and of an id that repeats one row; each gives at most ``per_row`` windows, cut at random from the whole
    text in the tasks. Rows without text, letters or lang teach nothing. No rows at all give a network that
    predicts ``und``.
    """
    known = labelled.where("doc_id is not null and text is not null and lang is not null")
    rows = known.select("lang", "text", F.xxhash64("doc_id").alias("key"), F.xxhash64("text").alias("said"))
    ids = rows.groupBy("key").agg(F.min(F.struct("said", "lang")).alias("one")).select("key", "one.*")
    share = Window.partitionBy("lang", F.pmod("key", F.lit(SHARES))).orderBy("key")
    ranked = ids.withColumn("rank", F.row_number().over(share)).where(F.col("rank") <= -(-sample_rows // SHARES))
    chosen = ranked.orderBy("rank", "key").limit(sample_rows).select("key", "said", "lang")
    texts = rows.join(F.broadcast(chosen), ["key", "said", "lang"], "left_semi")
    # Copies of a chosen row give the same windows, which count once before they leave the tasks' side.
    cut = texts.mapInArrow(_samples(per_row), "key long, place int, lang string, codes binary").distinct().collect()
    found = sorted((r["lang"], bytes(r["codes"])) for r in cut)
    if not found:
        return Network.start([UNKNOWN])
    codes = np.frombuffer(b"".join(c for _, c in found), np.uint8).reshape(-1, WINDOW)
    return train(codes, [x for x, _ in found])


def _weights(codes: np.ndarray) -> np.ndarray:
    return ((codes < 26) | (codes >= _HIGH)).sum(axis=1)


def score(net: Network, texts: list[bytes | None]) -> list[tuple[str, float]]:
    """Language and probability of each text, over all its windows."""
    known = [i for i, t in enumerate(texts) if has_letter(t)]
    out: list[tuple[str, float]] = [(UNKNOWN, 0.0)] * len(texts)
    total = np.zeros((len(known), len(net.languages)))
    held, owner, size = [], [], 0

    def flush() -> None:
        nonlocal size
        if not held:
            return
        codes, whose = np.concatenate(held), np.repeat([i for i, _ in owner], [n for _, n in owner])
        for i in range(0, len(codes), AT_ONCE):
            some = codes[i : i + AT_ONCE]
            np.add.at(total, whose[i : i + AT_ONCE], net.probabilities(some) * _weights(some)[:, None])
        held.clear()
        owner.clear()
        size = 0

    for k, i in enumerate(known):
        rows = windows_of(texts[i])
        held.append(rows)
        owner.append((k, len(rows)))
        size += len(rows)
        if size >= 8 * AT_ONCE:
            flush()
    flush()
    total /= np.maximum(total.sum(axis=1, keepdims=True), 1e-30)
    for k, i in enumerate(known):
        best = int(total[k].argmax())
        out[i] = (net.languages[best], float(min(1.0, total[k, best])))
    return out


def predict(docs: DataFrame, net: Network) -> DataFrame:
    """The rows of ``docs`` with lang_pred and lang_score, from nothing but the text.

    A text that is null or has no letter gets ``und`` and 0. Columns of these names are replaced.
    """
    kept = docs.drop("lang_pred", "lang_score")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = score(net, raw(batch))
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, pa.array([x for x, _ in found], pa.string()), pa.array([p for _, p in found], pa.float64())],
                [*batch.schema.names, "lang_pred", "lang_score"],
            )

    fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in kept.schema.fields)
    return kept.mapInArrow(run, f"{fields}, lang_pred string, lang_score double")


def learned_from(docs: DataFrame) -> DataFrame:
    """The rows that may teach: those whose id does not leave 2."""
    return docs.where(remainder(F.col("doc_id")) != 2)


def languages(docs: DataFrame) -> DataFrame:
    """doc_id, held_out, lang_pred, score of every row; fitted on the rows that are not held out.

    Rows with a null id are not held out, and teach nothing.
    """
    net = fit(learned_from(docs))
    held = F.coalesce(remainder(F.col("doc_id")) == 2, F.lit(False)).alias("held_out")
    return predict(docs.select("doc_id", held, "text"), net).select("doc_id", "held_out", "lang_pred", F.col("lang_score").alias("score"))

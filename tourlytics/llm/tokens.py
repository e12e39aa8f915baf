"""Token ids of texts by a given tokenizer file, with the ids of each distinct chunk kept in the worker.

The tokenizer drops white space and no token spans it, so a text's ids are those of its chunks between
ASCII white space, one after the other. A chunk is encoded once per worker and looked up after that.
"""

from __future__ import annotations

import os
from collections.abc import Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

KEPT_CHUNKS = 400_000  # of one worker; beyond it, or beyond KEPT_BYTES, the rarer ones go
USED_CHUNKS = 250_000  # that stay then
KEPT_BYTES = 64 << 20
GROUP_BYTES = 2 << 20  # of text, tokenized at once

MARKS = ".,;:!?"
LATIN_END = "\u0180"  # letters below are in composed form already

#: Byte-level letters by byte: printable ones stand for themselves, the others for 256, 257, ... in order.
_PRINTABLE = {*range(33, 127), *range(161, 173), *range(174, 256)}
BYTE_LETTERS = {b: 256 + k for k, b in enumerate(b for b in range(256) if b not in _PRINTABLE)}

_stores: dict[tuple[str, bool], Chunks] = {}


class _Index(dict):
    """Numbers new chunks as they are asked for."""

    def __init__(self) -> None:
        self.new: list[bytes] = []

    def __missing__(self, chunk: bytes) -> int:
        number = self[chunk] = len(self)
        self.new.append(chunk)
        return number


class Chunks:
    """Ids of chunks: a number by chunk, and by number a stretch of one flat array."""

    def __init__(self, path: str, plain_specials: bool) -> None:
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.encode_special_tokens = plain_specials
        self.word = self.tokenizer.model.tokenize
        self.marks = {m: [t.id for t in self.word(m)] for m in MARKS}
        self.clear()

    def clear(self) -> None:
        self.index = _Index()
        self.flat = np.empty(1 << 20, np.uint32)
        self.starts = np.zeros(1 << 16, np.int64)
        self.lengths = np.zeros(1 << 16, np.int64)
        self.hits = np.zeros(1 << 16, np.int64)  # groups that held the chunk
        self.fill = 0  # of flat
        self.used = 0  # chunks
        self.size = 0  # their bytes

    def _make_room(self) -> None:
        """Drops all but the chunks that most groups have held; older groups count half."""
        keep = np.sort(np.argsort(-self.hits[: self.used], kind="stable")[:USED_CHUNKS])
        chunks = list(self.index)
        chunks = [chunks[k] for k in keep.tolist()]
        size = sum(map(len, chunks))
        if size > KEPT_BYTES // 2:
            return self.clear()
        lengths, stops = self.lengths[keep], np.cumsum(self.lengths[keep])
        flat = self.flat[np.arange(stops[-1]) + np.repeat(self.starts[keep] - (stops - lengths), lengths)]
        self.index, self.used, self.size, self.fill = _Index(), len(keep), size, len(flat)
        self.index.update(zip(chunks, range(len(chunks)), strict=True))
        self.flat[: len(flat)] = flat
        self.starts[: len(keep)], self.lengths[: len(keep)] = stops - lengths, lengths
        self.hits[: len(keep)], self.hits[len(keep) :] = self.hits[keep] // 2, 0

    def _simple(self, chunk: str) -> list[int] | None:
        """Ids of a word of Latin letters, with one mark behind it at most: what the tokenizer's steps come to."""
        if not chunk:
            return []
        low, mark = chunk.lower(), ()
        if low[-1] in MARKS:
            low, mark = low[:-1], self.marks[low[-1]]
        if not low.isalpha() or max(low) >= LATIN_END:
            return None
        return [t.id for t in self.word(low if low.isascii() else low.encode().decode("latin-1").translate(BYTE_LETTERS))] + [*mark]

    def _encode(self, chunks: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Flat ids and the number of ids of each chunk."""
        found = list(map(self._simple, chunks))
        rest = [k for k, ids in enumerate(found) if ids is None]
        others = self.tokenizer.encode_batch_fast([chunks[k] for k in rest], add_special_tokens=False)
        for k, other in zip(rest, others, strict=True):
            found[k] = other.ids
        lengths = np.fromiter(map(len, found), np.int64, len(found))
        return np.fromiter(chain.from_iterable(found), np.uint32, int(lengths.sum())), lengths

    def _store(self, chunks: list[str], numbers: np.ndarray) -> None:
        ids, n = self._encode(chunks)
        while self.fill + len(ids) > len(self.flat):
            self.flat = np.concatenate((self.flat, np.empty_like(self.flat)))
        self.flat[self.fill : self.fill + len(ids)] = ids
        self.starts[numbers] = self.fill + np.cumsum(n) - n
        self.lengths[numbers] = n
        self.fill += len(ids)

    def _learn(self) -> None:
        self.size += sum(map(len, self.index.new))
        new, self.index.new = [c.decode() for c in self.index.new], []
        while self.used + len(new) > len(self.starts):
            self.starts = np.concatenate((self.starts, np.zeros_like(self.starts)))
            self.lengths = np.concatenate((self.lengths, np.zeros_like(self.lengths)))
            self.hits = np.concatenate((self.hits, np.zeros_like(self.hits)))
        for i in range(0, len(new), 4096):
            some = new[i : i + 4096]
            self._store(some, np.arange(self.used + i, self.used + i + len(some)))
        self.used += len(new)

    def _group(self, texts: pa.Array) -> list[np.ndarray]:
        """Chunks are parted and numbered by Arrow; only the different ones are looked up."""
        if self.used > KEPT_CHUNKS or self.size > KEPT_BYTES:
            self._make_room()
        parted = pc.ascii_split_whitespace(_low(texts))
        coded = parted.flatten().dictionary_encode()
        different = coded.dictionary.cast(pa.binary()).to_pylist()
        numbers = np.fromiter(map(self.index.__getitem__, different), np.int64, len(different))
        if self.index.new:
            self._learn()
        self.hits[numbers] += 1
        which = numbers[coded.indices.to_numpy(zero_copy_only=False)]
        lengths = self.lengths[which]
        stops = np.concatenate(([0], np.cumsum(lengths)))
        ids = self.flat[np.arange(stops[-1]) + np.repeat(self.starts[which] - stops[:-1], lengths)]
        counts = pc.list_value_length(parted).to_numpy(zero_copy_only=False)
        ends = stops[np.concatenate(([0], np.cumsum(counts)))].tolist()
        return [ids[a:b] for a, b in zip(ends[:-1], ends[1:], strict=True)]

    def each(self, texts: pa.Array) -> Iterator[np.ndarray]:
        """The ids of each text, in order; null and empty texts have none."""
        texts = texts.cast(pa.string()).fill_null("")
        group = np.cumsum(pc.binary_length(texts).to_numpy(zero_copy_only=False), dtype=np.int64) // GROUP_BYTES
        cuts = [0, *(np.flatnonzero(np.diff(group)) + 1).tolist(), len(texts)]
        for a, b in zip(cuts[:-1], cuts[1:], strict=True):
            if b > a:
                yield from self._group(texts.slice(a, b - a))


def chunks_of(path: str, plain_specials: bool = False) -> Chunks:
    """The worker's store for a tokenizer file. With ``plain_specials`` special strings in a text are text."""
    key = (path, plain_specials)
    if key not in _stores:
        _stores[key] = Chunks(path, plain_specials)
    return _stores[key]


def vocabulary_size(path: str) -> int:
    from tokenizers import Tokenizer

    return Tokenizer.from_file(path).get_vocab_size(with_added_tokens=True)


def public_path(name: str) -> str:
    """Where a public tokenizer file of the installed package is."""
    import public_tokenizers

    return public_tokenizers.path(name)


def _low(texts: pa.Array) -> pa.Array:
    """ASCII letters in lower case, as the tokenizer has them; not in texts where special strings or marks
    to be joined with a letter could be."""
    plain = texts.cast(pa.binary())
    held = [pc.match_substring(plain, x) for x in (b"<|", b"\xcc", b"\xcd")]
    return pc.if_else(pc.or_(pc.or_(held[0], held[1]), held[2]), texts, pc.ascii_lower(texts))

import struct
import zlib
from collections import defaultdict

import numpy as np
from tokenizers import Tokenizer

from llm_frames import documents, ordered
from tourlytics.llm import packing
from tourlytics.llm.tokens import public_path


def test_pieces_and_places(spark):
    docs = documents(spark)
    found = packing.packed_sequences(docs).collect()
    tokenizer = Tokenizer.from_file(public_path("word_bpe_49k.json"))
    expected = []
    for r in docs.collect():
        ids = [*tokenizer.encode(r["text"] or "", add_special_tokens=False).ids, 1]
        for k in range(0, len(ids), 4096):
            some = ids[k : k + 4096]
            expected.append((r["doc_id"], k // 4096, k, len(some), zlib.crc32(struct.pack(f"<{len(some)}I", *some))))
    assert ordered((r["doc_id"], r["piece"], r["start"], r["length"], r["ids_crc32"]) for r in found) == ordered(expected)
    check_places(found)


def test_the_store_drops_and_learns_again(monkeypatch):
    import pyarrow as pa

    from tourlytics.llm import tokens

    path = public_path("word_bpe_49k.json")
    monkeypatch.setattr(tokens, "KEPT_CHUNKS", 30)
    monkeypatch.setattr(tokens, "USED_CHUNKS", 10)
    monkeypatch.setattr(tokens, "GROUP_BYTES", 64)
    store, plain = tokens.Chunks(path, False), Tokenizer.from_file(path)
    texts = [f"word{i % 7} Wort{i} größer{i % 23}, it's <|endoftext|> n° {i}\x1c.. J̌ a̋" for i in range(60)] + ["", " \v\f ", "x" * 3000]
    for kept in (64 << 20, 100):
        monkeypatch.setattr(tokens, "KEPT_BYTES", kept)
        for text, ids in zip(texts, store.each(pa.array(texts)), strict=True):
            assert ids.tolist() == plain.encode(text, add_special_tokens=False).ids
    assert [len(x) for x in store.each(pa.array([None, "a b"]))] == [0, 2]


def check_places(found):
    held = defaultdict(list)
    for r in found:
        held[r["sequence_id"]].append((r["offset"], r["length"]))
    for places in held.values():
        end = 0
        for offset, length in sorted(places):
            assert offset == end
            end += length
        assert end <= 4096
    return len(held)


def test_several_groups_lose_little(spark):
    rng = np.random.default_rng(0)
    sizes = np.minimum(4096, rng.lognormal(6.5, 1, 6000).astype(int) + 1)
    rows = [(i, i, 0, 0, int(s), 0) for i, s in enumerate(sizes)]
    cut = spark.createDataFrame(rows, packing._PIECES)
    packed = packing.pack(cut, group_pieces=1000).collect()
    assert len(packed) == len(rows)
    assert check_places(packed) <= -(-int(sizes.sum()) // 4096) + 1


def test_pieces_that_fill_no_sequence_come_to_an_end(spark):
    # equal pieces; a few that would fit a gap; two lengths that go together only if dissolved
    for sizes, bins in (([3000] * 60_000, 60_000), ([3000] * 60_000 + [1000] * 5, 60_000), ([2100] * 3000 + [1900] * 3000, 3000)):
        rows = [(i, i, 0, 0, s, 0) for i, s in enumerate(sizes)]
        packed = packing.pack(spark.createDataFrame(rows, packing._PIECES), group_pieces=1000).collect()
        assert len(packed) == len(rows) == len({r["doc_row"] for r in packed})
        assert check_places(packed) == bins


def test_tightest_by_count_is_tightest():
    rng = np.random.default_rng(2)
    for _ in range(100):
        sizes = rng.integers(1, 101, int(rng.integers(1, 400))) // int(rng.integers(1, 4)) + 1
        sizes = np.minimum(sizes, 100)
        lengths, counts = np.unique(sizes, return_counts=True)
        rules, bins = packing.tightest_by_count(dict(zip(lengths.tolist(), counts.tolist(), strict=True)), 100)
        assert bins == len(packing.tightest(sizes, 100))
        held = defaultdict(list)
        for k, (size, first, at, each, offset) in enumerate(rules.tolist()):
            end = rules[k + 1, 1] if k + 1 < len(rules) and rules[k + 1, 0] == size else counts[lengths == size][0]
            for i in range(end - first):
                held[at + i // each].append((offset + i % each * size, size))
        assert len(held) == bins and sum(map(len, held.values())) == len(sizes)
        for places in held.values():
            places.sort()
            assert all(a + s == b for (a, s), (b, _) in zip(places, places[1:])) and places[0][0] == 0 and sum(places[-1]) <= 100


def test_sum_of_squares_takes_the_least_change():
    rng = np.random.default_rng(1)
    bins = packing._Open(20)
    for i in range(200):
        size = int(rng.integers(1, 20))
        before = bins.n.copy()
        options = []
        for gap in [g for g in range(size, 20) if before[g]] + [20]:
            after = before.copy()
            if gap < 20:
                after[gap] -= 1
            if gap > size:
                after[gap - size] += 1
            options.append((after[1:20] ** 2).sum())
        bins.place(i, size)
        assert (bins.n[1:20] ** 2).sum() == min(options)


def test_no_documents(spark):
    assert packing.packed_sequences(documents(spark, [])).collect() == []

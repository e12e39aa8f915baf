import random
import re

import pytest

from llm_frames import documents, ordered
from tourlytics.llm import decontaminate

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def words(text):
    return WORD.findall(re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))


def brute(docs, items, n=10):
    windows = {}
    for item, text in items:
        w = words(text)
        for i in range(max(1, len(w) - n + 1) if w and item is not None else 0):
            windows.setdefault(tuple(w[i : i + n]), set()).add(str(item))
    for doc, text in docs:
        w, hit, ids = words(text), set(), set()
        for i in range(len(w)):
            for size in {len(x) for x in windows}:
                if i + size <= len(w) and (x := tuple(w[i : i + size])) in windows:
                    hit.update(range(i, i + size))
                    ids |= windows[x]
        yield doc, len(w), len(hit), len(ids), sorted(ids), bool(hit)


ITEMS = [
    (1, "Quick brown fox jumps over the LAZY dog near the, old river bank."),
    (10, "one two"),
    (2, "two"),
    (3, None),
    (4, "  ... "),
    (5, "k l m n o p q r s t u v w x y z a b"),
    (5, "k l m n o p q r s t u v w x y z a b"),
    (6, "ipsum dolor sit amet lorem ipsum dolor sit amet lorem"),
    (7, "été – naïve 漢字 🎉"),
    (None, "old river bank"),
]


@pytest.mark.parametrize("block_bytes", [1, decontaminate.BLOCK_BYTES])
def test_leaks_match_brute_force(spark, block_bytes):
    docs = documents(spark)
    items = spark.createDataFrame(ITEMS, "item_id long, text string")
    found = decontaminate.leaks(docs, items, block_bytes=block_bytes)
    got = [(r["doc_id"], r["n_words"], sum(b - a for a, b in zip(r["starts"], r["ends"])), len(r["items"]), r["items"], bool(r["starts"])) for r in found.collect()]
    assert ordered(got) == ordered(brute([(r["doc_id"], r["text"]) for r in docs.collect()], ITEMS))


@pytest.mark.parametrize("block_bytes", [40, 400])
def test_several_blocks_agree_with_one(spark, monkeypatch, block_bytes):
    """Random texts, items longer than a block, copies, repeated ids and clashing names; no document is written."""
    rng = random.Random(block_bytes)
    text = lambda n: " ".join(rng.choice("ab") + rng.choice("cd") for _ in range(n))
    rows = [(k % 7, text(rng.randrange(60)), "x", [k]) for k in range(40)] + [(3, None, "k", [1]), (None, "", "k", None)]
    docs = spark.createDataFrame(rows + rows[:9], "doc_id long, text string, key string, starts array<int>")
    items = spark.createDataFrame([(k % 9 or None, text(n)) for k, n in enumerate([3, 9, 10, 11, 25, 60, 200, 0])], "item_id long, text string")
    one = decontaminate.leaks(docs, items, window=6)
    kept, plain = [], decontaminate.settle
    monkeypatch.setattr(decontaminate, "settle", lambda df, name: kept.append(df.columns) or plain(df, name))
    many = decontaminate.leaks(docs, items, window=6, block_bytes=block_bytes)
    assert len(kept) > 2 and all(c == ["key", "starts", "ends", "items"] for c in kept)
    assert many.columns == one.columns and many.schema.simpleString() == one.schema.simpleString()
    assert ordered(many.collect()) == ordered(one.collect())
    assert 0 < one.where("size(starts) > 0").count() < one.count()


def test_a_long_item_keeps_all_its_windows():
    """Every window is in one stretch only, and no stretch is much longer than asked."""
    for n in (0, 1, 9, 10, 11, 57, 500):
        text = " ".join(f"w{i}" for i in range(n)).encode()
        for size in (1, 30, 100, 10_000):
            found = [w.split() for w in decontaminate._stretches(text, 10, size)]
            windows = [tuple(w[i : i + 10]) for w in found for i in range(max(1, len(w) - 9) if w else 0)]
            assert windows == [tuple(text.split()[i : i + 10]) for i in range(max(1, n - 9) if n else 0)]
            assert all(len(w) <= max(19, size) for w in found)


def test_items_without_an_id_hit_words(spark):
    docs = documents(spark, [(1, "the old river bank", None, None, None), (2, "a one two", None, None, None)])
    items = spark.createDataFrame([(None, "old river"), (7, "bank"), (None, "old river"), (None, "two")], "item_id long, text string")
    found = decontaminate.contaminated(docs, items).select("doc_id", "n_words", "items", "n_hit", "n_items", "contaminated")
    assert ordered(found.collect()) == ordered([(1, 4, ["7"], 3, 1, True), (2, 3, [], 1, 0, True)])
    assert decontaminate.clean(docs, items).collect() == []


def test_clean_documents_stay_whole(spark):
    docs = documents(spark)
    bench = spark.createDataFrame([(1, "Quick brown fox jumps over the lazy dog near the")], "item_id long, text string")
    kept = decontaminate.clean(docs, bench)
    assert kept.columns == docs.columns
    assert ordered(kept.collect()) == ordered(r for r in docs.collect() if r["doc_id"] not in (0, 1))


def test_empty_tables(spark):
    items = spark.createDataFrame([], "item_id long, text string")
    assert decontaminate.contaminated(documents(spark, []), items).collect() == []
    assert {r["contaminated"] for r in decontaminate.contaminated(documents(spark), items).collect()} == {False}


def test_whole_table(spark, small):
    docs, bench = spark.read.parquet(f"{small}/documents.parquet"), spark.read.parquet(f"{small}/benchmark.parquet")
    found = decontaminate.contaminated(docs, bench).select("doc_id", "n_words", "n_hit", "n_items", "items", "contaminated")
    expected = brute([(r["doc_id"], r["text"]) for r in docs.collect()], [(r["item_id"], r["text"]) for r in bench.collect()])
    assert ordered(found.collect()) == ordered(expected)
    assert found.where("contaminated").count() > 0

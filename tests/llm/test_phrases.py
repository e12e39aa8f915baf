import random

import pytest

from llm_frames import documents, ordered
from tourlytics.llm import phrases


def brute(rows, width):
    """(id, words, kept words) by the definition."""
    split = [(i, (t or "").encode().split()) for i, t in rows]
    rank = lambda i: (i is not None, i or 0)
    first = {}
    for i, words in split:
        for s in range(len(words) - width + 1):
            key = tuple(words[s : s + width])
            first[key] = min(first.get(key, (rank(i), s)), (rank(i), s))
    for i, words in split:
        gone = set()
        for s in range(len(words) - width + 1):
            if first[tuple(words[s : s + width])] < (rank(i), s):
                gone.update(range(s, s + width))
        kept = [w for k, w in enumerate(words) if k not in gone]
        yield i, b" ".join(kept).decode(), len(words), len(gone)


def check(spark, docs, width, block_bytes, ranges=phrases.RANGES):
    found = phrases.without_repeats(docs, width, block_bytes, ranges).collect()
    assert all(sum(b - a for a, b in zip(r["removed"][::2], r["removed"][1::2])) == r["n_removed"] for r in found)
    got = [(r["doc_id"], r["text"], r["n_words"], r["n_removed"]) for r in found]
    expected = list(brute([(r["doc_id"], r["text"]) for r in docs.collect()], width))
    assert ordered(got) == ordered(expected)
    return sum(x[3] for x in expected)


@pytest.mark.parametrize("block_bytes", [300, phrases.BLOCK_BYTES])
def test_odd_rows(spark, block_bytes):
    assert check(spark, documents(spark), 20, block_bytes) > 0


@pytest.mark.parametrize("seed", range(4))
def test_overlapping_passages(spark, seed):
    rng = random.Random(seed)
    pool = [[rng.choice("abcde") for _ in range(rng.randint(3, 40))] for _ in range(12)]
    rows = []
    for i in range(60):
        words = []
        for _ in range(rng.randint(0, 6)):
            p = rng.choice(pool)
            a = rng.randrange(len(p))
            words += p[a : a + rng.randint(1, 40)] + [rng.choice(["x", "y", f"u{i}"])] * rng.randint(0, 2)
        rows.append((rng.randrange(200), rng.choice([" ", "\n", " \t "]).join(words), None, None, None))
    assert check(spark, documents(spark, rows), 6, rng.choice([200, 1000, 10**9]), rng.choice([1, 3, 4096])) > 0


@pytest.mark.parametrize("ranges", [1, 4, 4096])
def test_blocks_rise_with_the_ids(spark, ranges):
    ids = [None, -(2**63), 2**63 - 1, *range(-50, 50), *range(10**15, 10**15 + 50), 7, 7]
    docs = documents(spark, [(i, "x" * 10, None, None, None) for i in ids])
    rows, blocks = phrases.blocks_of(docs, 100, ranges)
    found = sorted((r["doc_id"], r["block"]) for r in rows.collect())
    assert blocks == 16 and len({b for _, b in found}) > 2
    assert [b for _, b in found] == sorted(b for _, b in found)
    assert len(set(found)) == len(set(ids)) - 1


@pytest.mark.parametrize("hot", [None, 5, 2**63 - 1])
@pytest.mark.parametrize("ranges", [3, 4096])
def test_an_id_of_many_rows(spark, hot, ranges):
    rng = random.Random(str(hot))
    pool = [[rng.choice("abcde") for _ in range(30)] for _ in range(20)]
    rows = []
    for _ in range(150):
        words = [w for _ in range(rng.randint(1, 4)) for w in (*rng.choice(pool)[rng.randrange(20) :], rng.choice("xyz"))]
        rows.append((hot if rng.random() < 0.5 else rng.randrange(10), " ".join(words), None, None, None))
    rows += [(hot, "copies " + " ".join(pool[0]), None, None, None)] * 2100 + [(hot, None, None, None, None)] * 3
    docs = documents(spark, rows)
    dealt = phrases.blocks_of(docs, 2000, ranges)[0].collect()
    mine = {r["block"] for r in dealt if r["doc_id"] == (phrases.MISSING_ID if hot is None else hot)}
    assert len(mine) > 5 and sum(r["copies"] for r in dealt) == len(rows)
    assert len({r["block"] >> phrases.PART_BITS for r in dealt if r["block"] in mine}) == 1
    assert check(spark, docs, 6, 2000, ranges) > 0


def test_whole_table(spark, small):
    docs = spark.read.parquet(f"{small}/documents.parquet")
    assert check(spark, docs, 20, 40_000) > 0


def test_no_documents(spark):
    assert phrases.without_repeats(documents(spark, [])).collect() == []

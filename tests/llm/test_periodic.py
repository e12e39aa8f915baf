import random
import zlib
from hashlib import sha256

import pytest

import __spark_entry__ as entry
from llm_frames import documents
from tourlytics.llm import periodic


def brute(words):
    """Every maximal run, period by period."""
    n, out = len(words), {}
    for q in range(1, n // 4 + 1):
        i = 0
        while i + q < n:
            if words[i] == words[i + q]:
                j = i
                while j + q < n and words[j] == words[j + q]:
                    j += 1
                if j - i + q >= max(6, 4 * q):
                    out.setdefault((i, j - i + q), q)
                i = j
            i += 1
    return sorted((a, b, q) for (a, b), q in out.items())


def collapsed(words, runs):
    gone = {i for a, b, q in runs for i in range(a + q, a + b)}
    return " ".join(w for i, w in enumerate(words) if i not in gone)


def words_of(text):
    return [w.decode() for w in (text or "").encode().split()]


def test_transform_is_exact():
    rng = periodic.np.random.default_rng(0)
    for size in (2, 8, 64):
        way = periodic.Transform(size)
        a, b = (rng.integers(0, periodic.PRIME, (3, size)).astype("uint64") for _ in "ab")
        got = way.inverse(periodic._reduced(way.forward(a) * way.forward(b)))
        for row in range(3):
            want = [sum(int(a[row, j]) * int(b[row, (k - j) % size]) for j in range(size)) % periodic.PRIME for k in range(size)]
            assert got[row].tolist() == want


def test_runs_of_many_words():
    rng = random.Random(5)
    for _ in range(400):
        texts = []
        for _ in range(rng.randint(1, 5)):
            letters, words = rng.choice([1, 2, 3, 12]), []
            for _ in range(rng.randint(0, 6)):
                part = [b"%d" % rng.randrange(letters) for _ in range(rng.randint(1, 14))]
                words += (part * rng.randint(1, 8))[: rng.randint(1, 80)]
            texts.append(words)
        runs, _ = periodic._searched(texts)
        assert [[(r["start"], r["length"], r["period"]) for r in rs] for rs in runs] == [brute(ws) for ws in texts]


def test_runs_of_runs_and_long_texts():
    nested = (["a"] * 30 + ["b"]) * 5 + ["c"] + (["a"] * 8 + ["b"] * 8) * 6
    assert [tuple(r.values()) for r in periodic._searched([[w.encode() for w in nested]])[0][0]] == brute(nested)
    runs, texts = periodic._searched([[b"x"] * 300_000, [b"%d" % (i % 70_000) for i in range(300_000)]])
    assert runs == [[{"start": 0, "length": 300_000, "period": 1}], [{"start": 0, "length": 300_000, "period": 70_000}]]
    assert texts[0] == b"x" and len(texts[1].split()) == 70_000


def test_rows_of_every_kind(spark):
    found = periodic.periodic_runs(documents(spark), keep=["doc_id", "text", "length"]).collect()
    assert len(found) == 12
    for r in found:
        words = words_of(r.row.text)
        runs = brute(words) if len(words) < 1000 else [(0, 20_000, 5)]
        assert (r.n_words, [tuple(x) for x in r.runs]) == (len(words), runs)
        assert r.collapsed == collapsed(words, runs)
    empty = periodic.periodic_runs(documents(spark, []))
    assert empty.columns == ["row", "n_words", "runs", "collapsed"] and empty.count() == 0


def expected(doc_id, text):
    words = words_of(text)
    n = len(words)
    h = zlib.crc32(str(doc_id).encode())
    g = h // 10
    if doc_id is not None and h % 10 == 0 and n:
        a = g % n
        p = 1 + (n - a) // (3 + g % 8)
        words = [w if i < a else words[a + (i - a) % p] for i, w in enumerate(words)]
    runs = brute(words)
    best = max(((b, -a, -q) for a, b, q in runs), default=None)
    top = (None,) * 4 if best is None else (-best[1], best[0], -best[2], 1000 * best[0] // -best[2])
    lines = "".join(f"{a},{b},{q}\n" for a, b, q in runs)
    return (doc_id, len(runs), *top, *(sha256(s.encode()).hexdigest() for s in (lines, collapsed(words, runs))))


@pytest.mark.parametrize("odd", [False, True])
def test_query_against_brute_force(spark, small, tmp_path, odd):
    folder = small
    if odd:
        folder, rng = str(tmp_path), random.Random(3)
        rows = [(i, "  ".join(rng.choice(["é", "b\t", " c\n"]) for _ in range(rng.randint(0, 60))), "en", "s", 1) for i in range(200)]
        documents(spark, rows + [(None, "q " * 9, None, None, None), (7, None, "x", "y", 1)]).write.parquet(f"{folder}/documents.parquet")
    docs = spark.read.parquet(f"{folder}/documents.parquet").where("length(text) < 8000 or text is null").select("doc_id", "text").collect()
    wanted = {expected(*d) for d in docs}
    found = {tuple(r) for r in entry.queries()["op12_block_convolution"](spark, folder).collect()}
    assert wanted <= found and (odd is False or wanted == found)
    assert sum(1 for w in wanted if w[1]) > 3

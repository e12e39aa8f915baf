import random

import pyspark.sql.functions as F
import xxhash

from llm_frames import documents, ordered
from tourlytics.llm import simhash


def brute_print(text, width=3):
    words = "".join(c.lower() if c.isascii() else c for c in text or "").encode().split()
    grams = [b" ".join(words[i : i + width]) for i in range(max(1, len(words) - width + 1))] if words else []
    hashes = [xxhash.xxh64_intdigest(g, seed=42) for g in grams]
    return sum(1 << b for b in range(64) if sum(h >> b & 1 for h in hashes) * 2 > len(hashes))


def brute_components(prints):
    ids = list(prints)
    label = {i: i for i in ids}
    changed = True
    while changed:
        changed = False
        for a in ids:
            for b in ids:
                if label[a] < label[b] and bin(prints[a] ^ prints[b]).count("1") <= 3:
                    label[b], changed = label[a], True
    return label


def signed(x):
    return x - (1 << 64) if x >= 1 << 63 else x


def test_fingerprints_match_the_definition(spark):
    docs = documents(spark)
    found = simhash.fingerprints(docs).withColumn("h", simhash.hex_digits(F.col("fp"))).select("doc_id", "h").collect()
    expected = [(r["doc_id"], f"{brute_print(r['text']):016x}") for r in docs.collect()]
    assert ordered(found) == ordered(expected)


def test_links_reach_every_pair_within_three_bits(spark):
    rng = random.Random(3)
    prints = {}
    for c in range(12):
        centre = rng.getrandbits(64)
        low, high = simhash.THIRDS[c % 3]
        for _ in range(12):
            span = range(low, high) if c < 6 else range(64)
            prints[len(prints)] = centre ^ sum(1 << b for b in rng.sample(span, rng.randint(0, 3)))
    # chains, so that only steps of exactly three bits tie the ends
    at = rng.getrandbits(64)
    for _ in range(20):
        prints[len(prints)] = at
        at ^= sum(1 << b for b in rng.sample(range(64), 3))
    for _ in range(60):
        prints[len(prints)] = rng.getrandbits(64)
    rows = [(signed(p),) for p in set(prints.values())]
    pairs = simhash.links(spark.createDataFrame(rows, "fp long").repartition(4)).collect()
    mask = (1 << 64) - 1
    assert all(bin((a ^ b) & mask).count("1") <= 3 for a, b in pairs)
    values = {signed(p): signed(p) & mask for p in prints.values()}
    expected = brute_components(values)
    from tourlytics.llm.components import roots

    found = roots([(a, b) for a, b in pairs])
    assert {v: found.get(v, v) for v in values} == expected


def test_components_of_documents(spark):
    docs = documents(spark)
    found = simhash.near_duplicates(docs).collect()
    rows = docs.select("doc_id", "text").collect()
    prints = {k: brute_print(r["text"]) for k, r in enumerate(rows)}
    groups = brute_components(prints)
    expected = []
    for k, r in enumerate(rows):
        ids = [rows[j]["doc_id"] for j in groups if groups[j] == groups[k] and rows[j]["doc_id"] is not None]
        expected.append((r["doc_id"], signed(prints[k]), min(ids) if ids else None))
    assert ordered(found) == ordered(expected)


def test_one_row_of_each_group_stays(spark):
    docs = documents(spark)
    kept = simhash.one_of_each(docs)
    assert kept.columns == docs.columns
    assert ordered(r["doc_id"] for r in kept.select(F.array("doc_id")).toDF("doc_id").collect()) == ordered([[0], [2], [5], [7], [8], [9], [None]])
    assert {tuple(r) for r in kept.collect()} <= {tuple(r) for r in docs.collect()}
    assert simhash.one_of_each(documents(spark, [])).collect() == []


def test_repeated_rows_leave_one(spark):
    """Rows that share id and text leave one, and null ids stand behind others of their group."""
    rows = [(1, "a b c d", "x")] * 50 + [(None, "e f g h", "y")] * 50 + [(0, "i j k l", "z"), (None, None, "n"), (7, None, "n")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, id string")
    kept = simhash.one_of_each(docs)
    assert ordered([r["doc_id"], r["text"], r["id"]] for r in kept.collect()) == ordered([[1, "a b c d", "x"], [None, "e f g h", "y"], [0, "i j k l", "z"], [7, None, "n"]])


def test_no_documents(spark):
    assert simhash.near_duplicates(documents(spark, [])).collect() == []

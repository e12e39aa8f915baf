from hashlib import sha256

import pytest
from pyspark.sql import functions as F

from llm_frames import documents
from tourlytics.llm import merkle


def digest(*parts):
    return sha256("".join(parts).encode()).hexdigest()


def leaf(row, columns=merkle.ROW):
    values = [row[c] for c in columns]
    return digest(*("-" if v is None else f"{len(str(v).encode())}:{v}" for v in values))


def climb(nodes):
    """(root, proof of every node) by the plain definition."""
    proofs, at, level = [""] * len(nodes), list(range(len(nodes))), nodes
    while len(level) > 1:
        for k, place in enumerate(at):
            beside = place ^ 1
            proofs[k] += level[beside] if beside < len(level) else ""
        at = [p // 2 for p in at]
        level = [digest(*level[k : k + 2]) for k in range(0, len(level), 2)]
    return level[0], proofs


def expected(rows):
    groups = {}
    for r in rows:
        groups.setdefault(r["lang"], []).append(r)
    order = sorted(groups, key=lambda g: (g is not None, (g or "").encode()))
    tops, below = [], {}
    for g in order:
        ranked = sorted(groups[g], key=lambda r: (r["doc_id"] is not None, r["doc_id"] or 0, leaf(r)))
        below[g] = ranked, climb([leaf(r) for r in ranked])
        tops.append(below[g][1][0])
    root, over = climb(tops)
    out = []
    for g, outer in zip(order, over):
        ranked, (subroot, proofs) = below[g]
        out += [(r["doc_id"], leaf(r), subroot, root, p + outer) for r, p in zip(ranked, proofs)]
    return sorted(out, key=str)


def listed(found):
    return sorted(((r.id, r.leaf, r.subroot, r.root, r.proof) for r in found), key=str)


@pytest.mark.parametrize("levels", [1, merkle.LEVELS])
def test_odd_rows_in_blocks_of_any_size(spark, levels):
    docs = documents(spark)
    found = merkle.manifest(docs, levels=levels).collect()
    assert listed(found) == expected([r.asDict() for r in docs.collect()])
    assert all(r.verified and r.folded_root == r.root for r in found)


def test_many_rows_many_groups_and_tiers(spark):
    """Groups of one to 300 rows, among them names that sort by bytes; blocks of eight, so three tiers."""
    rows = [(i, f"t{i}", ("é", "z", None, "Z", "")[i % 5], "s", i) for i in range(300)]
    rows += [(i, "x", f"g{i}", None, None) for i in range(300, 340)] + [(2**60 + i, "big", "z", "s", 1) for i in range(200)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    found = merkle.manifest(docs, levels=3).collect()
    assert listed(found) == expected([r.asDict() for r in docs.collect()])


def test_changed_rows_are_found_and_only_they(spark):
    docs = documents(spark)
    seen = F.when(F.col("doc_id").isin(5, 9), merkle.leaf_hash(changed={"text": F.lit("other")}))
    found = merkle.manifest(docs, seen=seen)
    again = merkle.refolded(F.col("leaf"), F.col("sides"), F.col("proof")).alias("again")
    for r in found.select("*", again).collect():
        assert r.verified == (r.id not in (5, 9)) and r.again == r.root
        assert (r.folded_root == r.root) == r.verified


def test_one_row_and_none(spark):
    docs = documents(spark).where("doc_id = 2")
    (row,) = merkle.manifest(docs).collect()
    assert row.leaf == row.subroot == row.root == row.folded_root and row.proof == row.sides == ""
    assert merkle.manifest(documents(spark, [])).collect() == []

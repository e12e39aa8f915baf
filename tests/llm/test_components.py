import random

from tourlytics.llm.components import connected, roots


def test_components_match_union_find(spark):
    rng = random.Random(1)
    chain = [(i, i + 1) for i in range(500, 700)]
    star = [(5, i) for i in range(10, 60)]
    noise = [(rng.randrange(1000, 1400), rng.randrange(1000, 1400)) for _ in range(300)]
    edges = [*chain, *star, *noise, (7, 7), (None, 3), (60, 700), (61, 60), (60, 61)]
    rng.shuffle(edges)
    found = {r["node"]: r["component"] for r in connected(spark.createDataFrame(edges, "a long, b long").repartition(7)).collect()}
    expected = roots([e for e in edges if None not in e])
    assert {n: found.get(n, n) for n in expected} == expected


def test_no_edges(spark):
    assert connected(spark.createDataFrame([], "a long, b long")).collect() == []

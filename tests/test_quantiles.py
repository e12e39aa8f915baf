import random

import numpy as np

from tourlytics.operators.quantiles import grouped_quantiles, join_groups


def test_matches_numpy_with_null_groups_and_a_hot_group(spark):
    rnd = random.Random(3)
    rows = []
    for _ in range(2000):
        key = None if rnd.random() < 0.2 else rnd.choice(["a", "a", "a", "b", "c"])
        other = rnd.choice([None, 1, 2])
        value = None if rnd.random() < 0.1 else rnd.choice([rnd.uniform(-50, 50), 7.5, float(rnd.randrange(9))])
        rows.append((key, other, value))
    rows.append(("single", 1, 4.0))
    rows.append(("empty", 1, None))
    df = spark.createDataFrame(rows, "k string, o int, v double")
    wanted = {"low": 0.0, "q1": 0.25, "mid": 0.5, "p90": 0.9, "top": 1.0}
    groups = {}
    for k, o, v in rows:
        if v is not None:
            groups.setdefault((k, o), []).append(v)
    for accuracy in (20, 100, 10_000):
        got = {(r["k"], r["o"]): r for r in grouped_quantiles(df, ["k", "o"], "v", wanted, accuracy).collect()}
        assert set(got) == set(groups)
        for key, values in groups.items():
            for name, p in wanted.items():
                assert abs(got[key][name] - np.quantile(values, p)) < 1e-9, (key, name)


def test_a_million_different_values_in_one_group(spark):
    """Exact at any size; the brackets hold a small part of the values."""
    n = 1_000_000
    df = spark.range(n).selectExpr("if(id % 50 = 0, 'b', 'a') k", "cast((id * 7919) % 1000003 as double) / 7 v")
    wanted = {"q1": 0.25, "mid": 0.5, "q3": 0.75}
    ids = np.arange(n)
    values = (ids * 7919 % 1000003) / 7
    for r in grouped_quantiles(df, ["k"], "v", wanted, 1000).collect():
        mine = values[ids % 50 == 0] if r["k"] == "b" else values[ids % 50 != 0]
        for name, p in wanted.items():
            assert abs(r[name] - np.quantile(mine, p)) < 1e-6


def test_join_keeps_groups_without_values(spark):
    left = spark.createDataFrame([(None, 1), ("a", 2), ("b", 3)], "k string, n int")
    right = spark.createDataFrame([(None, 10), ("a", 20)], "k string, m int")
    got = sorted(((r["k"] or "", r["n"], r["m"]) for r in join_groups(left, right, ["k"]).collect()))
    assert got == [("", 1, 10), ("a", 2, 20), ("b", 3, None)]

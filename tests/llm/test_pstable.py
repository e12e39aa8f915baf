import math

import numpy as np
import pytest

from llm_frames import ordered
from tourlytics.llm import pstable
from tourlytics.llm.components import roots


def brute(rows, least=0.93):
    def usable(v):
        return v is not None and len(v) and all(x is not None and math.isfinite(x) for x in v) and any(v)

    links, pairs = [0] * len(rows), []
    for i, (_, v, a) in enumerate(rows):
        for j, (_, w, b) in enumerate(rows[:i]):
            if a is not None and a == b and usable(v) and usable(w) and len(v) == len(w):
                x, y = np.array(v, np.float64), np.array(w, np.float64)
                if x @ y / math.sqrt(x @ x) / math.sqrt(y @ y) >= least:
                    links[i] += 1
                    links[j] += 1
                    pairs.append((i, j))
    tied, least_id = roots(pairs), {}
    for i, (vec, _, _) in enumerate(rows):
        if vec is not None:
            top = tied.get(i, i)
            least_id[top] = min(least_id.get(top, vec), vec)
    for i, (vec, _, _) in enumerate(rows):
        name = least_id.get(tied.get(i, i))
        yield vec, links[i], name, vec is not None and vec == name


def frame(spark, rows):
    rows = [(i, v, k, "x", 1) for i, v, k in rows]
    return spark.createDataFrame(rows, "vec_id long, embedding array<float>, label int, cell string, n int").repartition(3)


def test_odd_rows(spark):
    nan, inf = float("nan"), float("inf")
    v = [1.0, 2.0, 3.0, -1.0]
    rows = [
        (1, v, 0), (2, [2 * x for x in v], 0), (3, v, 1), (4, v, None), (5, None, 0), (6, [], 0), (7, [0.0] * 4, 0),
        (8, [nan, 1.0, 2.0, 3.0], 0), (9, [inf, 1.0, 2.0, 3.0], 0), (10, [None, 1.0, 2.0, 3.0], 0), (11, v[:3], 0),
        (12, [-x for x in v], 0), (13, [1.0, 2.0, 3.0, -0.9], 0), (13, [1.0, 2.0, 3.0, -0.9], 0), (None, v, 1),
        (None, [9.0, -1.0, 0.0, 0.0], 3), (14, [0.0, -0.0, 1.0, 0.0], 2), (15, [-0.0, 0.0, 1.0, 0.0], 2),
    ]
    assert ordered(pstable.linked(frame(spark, rows)).collect()) == ordered(brute(rows))


@pytest.mark.parametrize("chunk", [pstable.CHUNK, 5])
def test_clusters_match_brute_force(spark, chunk):
    rng = np.random.default_rng(5)
    rows = []
    for c in range(12):
        centre = rng.normal(size=16)
        for _ in range(25):
            v = centre + rng.normal(size=16) * rng.choice([0, 0.05, 0.2])
            rows.append((len(rows) * 7 % 301, [float(x) for x in v.astype(np.float32)], c % 3))
    assert ordered(pstable.linked(frame(spark, rows), chunk=chunk).collect()) == ordered(brute(rows))


def test_tasks_stay_small_in_a_hot_cell(spark, monkeypatch):
    compare = pstable._compare

    def bounded(*args):
        run = compare(*args)

        def checked(rows):
            assert len(rows) <= 1000, len(rows)
            return run(rows)

        return checked

    monkeypatch.setattr(pstable, "_compare", bounded)
    monkeypatch.setattr(pstable, "ROWS_PER_TASK", 200)
    rng = np.random.default_rng(3)
    centre = rng.normal(size=8)
    rows = [(i, [float(x) for x in (centre + rng.normal(size=8) * 1e-3).astype(np.float32)], 1) for i in range(300)]
    assert ordered(pstable.linked(frame(spark, rows), chunk=20).collect()) == ordered(brute(rows))


def test_whole_table(spark, small):
    table = spark.read.parquet(f"{small}/embeddings.parquet")
    rows = [tuple(r) for r in table.select("vec_id", "embedding", "label").collect()]
    assert ordered(pstable.linked(table).collect()) == ordered(brute(rows))


def test_recall_near_the_bound(spark):
    rng = np.random.default_rng(11)
    rows = []
    for _ in range(600):  # pairs of cosine 0.931 to 0.95, else far apart
        a, b = rng.normal(size=64), rng.normal(size=64)
        a /= np.linalg.norm(a)
        b -= (b @ a) * a
        b /= np.linalg.norm(b)
        c = rng.uniform(0.931, 0.95)
        rows += [(len(rows), a.tolist(), 1), (len(rows) + 1, (c * a + math.sqrt(1 - c * c) * b).tolist(), 1)]
    found = pstable.linked(frame(spark, rows)).collect()
    assert sum(r["n_links"] for r in found) >= 0.995 * sum(x[1] for x in brute(rows))
    assert (1 - pstable.collision(math.sqrt(2 - 2 * pstable.LEAST_COSINE))) ** pstable.TABLES < 0.001


def test_no_vectors(spark):
    assert pstable.linked(frame(spark, [])).collect() == []


@pytest.mark.parametrize("kind, labels", [("double", [1.2, 1.9, -0.0, 0.0]), ("string", ["a", "b", "c", "c"])])
def test_labels_of_other_types(spark, kind, labels):
    v = [1.0, 2.0, 3.0, -1.0]
    rows = [(k, v, label) for k, label in enumerate([*labels, labels[0], None])]
    df = spark.createDataFrame(rows, f"vec_id long, embedding array<double>, label {kind}")
    found = {r["vec_id"]: (r["n_links"], r["component_id"]) for r in pstable.linked(df).collect()}
    assert found == {0: (1, 0), 1: (0, 1), 2: (1, 2), 3: (1, 2), 4: (1, 0), 5: (0, 5)}

import zlib

import numpy as np
import pytest

from llm_frames import documents, ordered
from tourlytics.llm import langid


@pytest.fixture(scope="module")
def table(spark):
    return spark.read.parquet("/root/testdata/sf0.01/documents.parquet")


def test_held_out_accuracy(table):
    truth = {r["doc_id"]: r["lang"] for r in table.select("doc_id", "lang").collect()}
    found = langid.languages(table).collect()
    assert len(found) == len(truth)
    assert all(r["held_out"] == (zlib.crc32(str(r["doc_id"]).encode()) % 4 == 2) and 0 <= r["score"] <= 1 for r in found)
    held = [r for r in found if r["held_out"]]
    assert sum(r["lang_pred"] == truth[r["doc_id"]] for r in held) >= 0.98 * len(held) > 0


def test_odd_rows(spark):
    docs = documents(spark)
    odd = spark.createDataFrame([(50, "12 — 34 !?", "xx"), (51, "漢字", "en"), (52, "é", "de")], "doc_id long, text string, lang string")
    both = docs.select("doc_id", "text", "lang").union(odd)
    found = {(r["doc_id"], r["lang_pred"] == "und") for r in langid.languages(both).collect()}
    assert {i for i, unknown in found if unknown} == {2, 3, 4, 50}
    learned = {r["lang"] for r in langid.learned_from(both).where("lang is not null and text rlike '[A-Za-z]'").collect()}
    assert {r["lang_pred"] for r in langid.languages(both).collect()} <= learned | {"und", "en", "de"}


def test_columns_stay_and_clashes_go(spark):
    docs = documents(spark).selectExpr("*", "'z' lang_pred", "1 lang_score")
    net = langid.train(np.stack([langid.windows_of(b"the and of")[0], langid.windows_of("der die das ß".encode())[0]]), ["en", "de"], epochs=30)
    out = langid.predict(docs, net)
    assert sorted(out.columns) == sorted(docs.columns)
    assert ordered(out.drop("lang_pred", "lang_score").collect()) == ordered(docs.drop("lang_pred", "lang_score").collect())


def test_nothing_to_learn_from(spark):
    docs = documents(spark)
    found = langid.languages(docs.selectExpr("doc_id", "text", "cast(null as string) lang")).collect()
    assert {r["lang_pred"] for r in found} == {"und"} and len(found) == docs.count()
    assert langid.languages(documents(spark, [])).collect() == []


def test_lookup_of_pairs_is_the_convolution():
    net = langid.Network.start(["a", "b"])
    codes = np.random.default_rng(0).integers(0, langid.CLASSES, (5, langid.WINDOW)).astype(np.uint8)
    plain = np.concatenate([net.convolve(codes, w).max(axis=1) for w in langid.WIDTHS], axis=1)
    assert np.allclose(net.pooled(codes), plain, atol=1e-5)


def test_gradients_match_differences():
    net = langid.Network.start(["a", "b", "c"], seed=4)
    codes = np.random.default_rng(1).integers(0, 6, (4, 30)).astype(np.uint8)
    wanted = np.array([0, 2, 1, 0])

    def loss():
        net._pairs.clear()
        return -np.log(net.probabilities(codes)[np.arange(4), wanted]).mean()

    for p, g in zip(net.parameters(), net.gradients(codes, wanted)):
        at = np.unravel_index(np.abs(g).argmax(), g.shape)
        before = p[at]
        p[at] = before + 1e-2
        high = loss()
        p[at] = before - 1e-2
        low = loss()
        p[at] = before
        assert (high - low) / 2e-2 == pytest.approx(g[at], rel=0.1, abs=2e-3)


def test_a_hot_id_counts_once(spark, monkeypatch):
    """5,000 rows of one id, some of them copies, leave one row's windows; the bound holds for rows."""
    rows = [(7, f"the hot text number {i % 40} " * 30, "en") for i in range(5000)] + [(i, f"der andere text {i}", "de") for i in range(300)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string").repartition(4)
    seen = []
    monkeypatch.setattr(langid, "train", lambda codes, labels: seen.append(labels) or langid.Network.start(["en"]))
    langid.fit(docs, sample_rows=120, per_row=5)
    (labels,) = seen
    assert len(labels) <= 120 * 5 and 1 <= labels.count("en") <= 5 < labels.count("de")

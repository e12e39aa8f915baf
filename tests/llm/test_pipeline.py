import re

import corpus_pipeline
import pytest

from llm_frames import documents, ordered
from test_decontaminate import brute as leaked
from test_simhash import brute_components, brute_print
from tourlytics.llm import packing, secret_scan


def frames_of(spark, folder, docs):
    out = [docs]
    for name, stage in corpus_pipeline.STAGES:
        out.append(corpus_pipeline.settle(stage(spark, out[-1], folder), name))
    return out


def test_stages_against_brute_force(spark, small):
    docs = spark.read.parquet(f"{small}/documents.parquet")
    bench = [tuple(r) for r in spark.read.parquet(f"{small}/benchmark.parquet").select("item_id", "text").collect()]
    raw, known, single, clean, redacted, packed = frames_of(spark, small, docs)
    assert all(f.columns == docs.columns for f in (known, single, clean, redacted))
    rows = [{r["doc_id"]: r for r in f.collect()} for f in (raw, known, single, clean, redacted)]
    assert rows[1].keys() == {i for i, r in rows[0].items() if r["text"] and re.search(r"[^\W\d_]", r["text"])}
    groups = brute_components({i: brute_print(r["text"]) for i, r in rows[1].items()})
    least = {}
    for i, g in groups.items():
        least[g] = min(i, least.get(g, i))
    assert rows[2].keys() == set(least.values())
    dirty = {x[0] for x in leaked([(i, r["text"]) for i, r in rows[2].items()], bench) if x[-1]}
    assert dirty and rows[3].keys() == rows[2].keys() - dirty
    assert rows[4].keys() == rows[3].keys()
    changed = {i for i in rows[4] if rows[4][i]["text"] != rows[3][i]["text"]}
    for i, r in rows[4].items():
        assert not re.search(f"{secret_scan.ACCESS}|{secret_scan.HEX}", r["text"])
        assert r["n_chars"] == (len(r["text"]) if i in changed else rows[3][i]["n_chars"])
    assert changed >= {i for i, r in rows[3].items() if re.search(f"{secret_scan.ACCESS}|{secret_scan.HEX}", r["text"])}
    assert {r["doc_id"] for r in packed.collect()} == rows[4].keys()
    again = packing.packed_sequences(redacted).drop("doc_row").collect()
    assert len({r["sequence_id"] for r in again}) == len({r["sequence_id"] for r in packed.collect()})


@pytest.mark.parametrize("rows", [None, []])
def test_odd_rows(spark, small, rows):
    docs = documents(spark, rows).selectExpr("*", "'c' lang_pred", "'c' hex", "1 starts", "3 row", "4 text_key")
    frames = frames_of(spark, small, docs)
    assert all(f.columns == docs.columns for f in frames[:-1])
    assert frames[-1].count() <= 20
    if rows is None:
        assert ordered([r["doc_id"]] for r in frames[1].collect()) == ordered([[i] for i in (0, 1, 5, 6, 7, 8, 9, 9, None)])
        assert ordered([r["doc_id"]] for r in frames[2].collect()) == ordered([[i] for i in (0, 5, 7, 8, 9, None)])


def test_run(spark, small):
    assert corpus_pipeline.run(spark, small).count() > 0

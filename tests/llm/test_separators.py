import numpy as np
import pytest
from tokenizers import Tokenizer

from llm_frames import documents, ordered
from tourlytics.llm import separators
from tourlytics.llm.tokens import public_path


def brute(ids, end):
    """(ordinal, start, length, closed) of a flat list."""
    out, start = [], 0
    for i, x in enumerate(ids):
        if x == end:
            out.append((len(out), start, i - start, True))
            start = i + 1
    if start < len(ids):
        out.append((len(out), start, len(ids) - start, False))
    return out


@pytest.mark.parametrize("block_tokens,span_blocks", [(1, 2), (3, 2), (7, 3), (1000, 4096)])
def test_flat_files(spark, tmp_path, block_tokens, span_blocks):
    rng = np.random.default_rng(block_tokens)
    files = [rng.choice([0, 5, 9, 65535], n, p=[0.3, 0.3, 0.3, 0.1]) for n in (0, 1, 50, 333)]
    files += [np.full(6, 65535), np.full(40, 3), np.array([3, 65535])]
    for k, ids in enumerate(files):
        ids.astype("<u2").tofile(tmp_path / f"{k}.bin")
    blocks = separators.read_flat(spark, str(tmp_path), block_tokens)
    found = separators.documents_in(blocks, 65535, span_blocks=span_blocks).collect()
    got = [(int(r["file"].rsplit("/", 1)[1][:-4]), *r[1:]) for r in found]
    assert ordered(got) == ordered((k, *x) for k, ids in enumerate(files) for x in brute(ids.tolist(), 65535))


@pytest.mark.parametrize("width", [2, 4])
def test_files_are_read_by_range(spark, tmp_path, width):
    """Ranges of two blocks, a last block that is short, names with blanks, and a file cut inside a token."""
    rng = np.random.default_rng(width)
    files = {"a b.bin": rng.integers(0, 60_000, 1001), "c%20d.bin": rng.integers(0, 60_000, 20), "empty.bin": np.zeros(0, int)}
    for name, ids in files.items():
        ids.astype(separators.WIDTHS[width]).tofile(tmp_path / name)
    opened = separators.open_range
    found = separators.read_flat(spark, str(tmp_path), 10, width, range_bytes=25 * width, open_file=lambda path: opened(path))
    assert found.rdd.getNumPartitions() == 51 + 1
    for name, ids in files.items():
        rows = found.where(found["file"].endswith(name)).orderBy("block").collect()
        assert [r["block"] for r in rows] == list(range(-(-len(ids) // 10)))
        assert b"".join(bytes(r["tokens"]) for r in rows) == ids.astype(separators.WIDTHS[width]).tobytes()
    (tmp_path / "cut.bin").write_bytes(b"abc")
    with pytest.raises(Exception, match="middle of a token"):
        separators.read_flat(spark, str(tmp_path), 10, width).collect()


@pytest.mark.parametrize("block_tokens", [5, 1 << 18])
def test_counts_match_the_tokenizer(spark, block_tokens):
    docs = documents(spark)
    extra = spark.createDataFrame([(70, "a <|endoftext|> b"), (71, "<|startoftext|>")], "doc_id long, text string")
    docs = docs.select("doc_id", "text").union(extra)
    tokenizer = Tokenizer.from_file(public_path("word_bpe_49k.json"))
    tokenizer.encode_special_tokens = True
    found = separators.counted(docs, block_tokens=block_tokens).select("doc_id", "n_tokens").collect()
    expected = [(r["doc_id"], len(tokenizer.encode(r["text"] or "", add_special_tokens=False).ids)) for r in docs.collect()]
    assert ordered(found) == ordered(expected)


def test_starts_follow_each_other(spark, small):
    rows = separators.counted(spark.read.parquet(f"{small}/documents.parquet"), block_tokens=500).orderBy("file", "start").collect()
    ends = {}
    for r in rows:
        assert r["start"] == ends.get(r["file"], 0)
        ends[r["file"]] = r["start"] + r["n_tokens"] + 1


def test_no_documents(spark):
    assert separators.counted(documents(spark, [])).collect() == []


def test_wide_ids(spark):
    """The same files with four bytes a token, an end id above two bytes, and one that does not fit."""
    docs = documents(spark)
    narrow, wide = (separators.counted(docs, block_tokens=9, width=w).select("doc_id", "n_tokens").collect() for w in (None, 4))
    assert ordered(narrow) == ordered(wide) and separators.token_width() == 2
    far = separators.counted(docs, end_id=70_000, width=4).select("doc_id", "n_tokens").collect()
    assert ordered(far) == ordered(narrow)
    with pytest.raises(Exception, match="70000 does not fit 2 bytes"):
        separators.counted(docs, end_id=70_000).collect()

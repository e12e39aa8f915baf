"""Documents in flat token files, found by their end-of-document identifiers.

A file is a stretch of unsigned integers without an index, cut into blocks. Each block is searched at once;
what it says about itself (tokens, separators, place of the last one) goes into a prefix scan over the file,
first over spans of blocks, then inside each span, which gives every block its first token's place, the number
of documents before it and where the document that runs into it began.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from urllib.parse import quote

import numpy as np
import pyarrow as pa
from pyarrow import NativeFile
from pyarrow.fs import FileSystem
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .shared import settle
from .tokens import chunks_of, public_path, vocabulary_size

BLOCK_TOKENS = 1 << 18
SPAN_BLOCKS = 4096
RANGE_BYTES = 128 << 20  # of a file, that one task reads
END_ID = 49407  # <|endoftext|> of word_bpe_49k
WIDTHS = {2: "<u2", 4: "<u4"}  # bytes of a token


def token_width(tokenizer: str | None = None) -> int:
    """Bytes that the ids of a tokenizer need."""
    return 2 if vocabulary_size(tokenizer or public_path("word_bpe_49k.json")) <= 1 << 16 else 4


def _write(path: str, end_id: int, block_tokens: int, width: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        store, end = chunks_of(path, plain_specials=True), np.array([end_id], np.uint32)
        file, held, size, block = str(TaskContext.get().partitionId()), [], 0, 0

        def row(block: int | None, tokens: np.ndarray | None, part: int | None = None, ids: list | None = None) -> pa.RecordBatch:
            if tokens is not None and len(tokens) and int(tokens.max()) >> (8 * width):
                raise ValueError(f"token {int(tokens.max())} does not fit {width} bytes")
            blob = None if tokens is None else tokens.astype(WIDTHS[width]).tobytes()
            values = [[file], [block], [blob], [part], [ids]]
            kinds = [pa.string(), pa.int64(), pa.binary(), pa.int64(), pa.list_(pa.int64())]
            return pa.RecordBatch.from_arrays([pa.array(v, k) for v, k in zip(values, kinds, strict=True)], ["file", "block", "tokens", "part", "ids"])

        for part, batch in enumerate(batches):
            yield row(None, None, part, batch.column("doc_id").to_pylist())
            for ids in store.each(batch.column("text")):
                held += [ids, end]
                size += len(ids) + 1
                if size >= block_tokens:
                    flat = np.concatenate(held)
                    for at in range(0, size - block_tokens + 1, block_tokens):
                        yield row(block, flat[at : at + block_tokens])
                        block += 1
                    held, size = [flat[size - size % block_tokens :]], size % block_tokens
        if size:
            yield row(block, np.concatenate(held))

    return run


def write_token_files(
    docs: DataFrame, tokenizer: str | None = None, end_id: int = END_ID, block_tokens: int = BLOCK_TOKENS, width: int | None = None
) -> tuple[DataFrame, DataFrame]:
    """Flat token files of the texts, an end id after each, and the ids of the documents in file order.

    One file a partition of ``docs``; a block takes no notice of where documents end. The second frame (file,
    part, ids) says whose tokens they are, in order, but not where. Null and empty texts give an end id alone. Text
    that spells a special token is tokenized as text, so only real ends are ends. A token takes ``width`` bytes,
    those that the vocabulary needs unless given; an id that does not fit is an error.
    """
    path = tokenizer or public_path("word_bpe_49k.json")
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    written = rows.mapInArrow(_write(path, end_id, block_tokens, width or token_width(path)), "file string, block long, tokens binary, part long, ids array<long>")
    name = settle(written, "tokens", compression="zstd")
    blocks = name.where("tokens is not null").select("file", "block", "tokens")
    return blocks, name.where("ids is not null").select("file", "part", "ids")


def open_range(path: str) -> NativeFile:
    """A file that ranges can be read of, in any store that Arrow reaches."""
    system, inside = FileSystem.from_uri(quote(path.replace("s3a://", "s3://", 1), safe=":/@"))
    return system.open_input_file(inside)


def read_flat(
    spark: SparkSession,
    path: str,
    block_tokens: int = BLOCK_TOKENS,
    width: int = 2,
    range_bytes: int = RANGE_BYTES,
    open_file: Callable[[str], NativeFile] = open_range,
) -> DataFrame:
    """The blocks of binary token files at a path: file, block (from 0), tokens.

    Spark lists the files, without their content; ranges of whole blocks of about ``range_bytes`` are dealt to
    tasks, which read a block at a time, so files may have any size. ``open_file`` opens a listed path for
    ``read_at`` where Arrow does not know the store. Empty files have no blocks; an end in the middle of a
    token is an error.
    """
    step = block_tokens * width
    some = max(1, range_bytes // step) * step
    files = spark.read.format("binaryFile").load(path).select("path", "length").where("length > 0")
    firsts = F.sequence(F.lit(0).cast("long"), F.col("length") - 1, F.lit(some).cast("long"))
    ranges = files.select("path", "length", F.explode(firsts).alias("first"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                if row["length"] % width:
                    raise ValueError(f"{row['path']} ends in the middle of a token")
                with open_file(row["path"]) as file:
                    for at in range(row["first"], min(row["first"] + some, row["length"]), step):
                        tokens = file.read_at(min(step, row["length"] - at), at)
                        yield pa.RecordBatch.from_pydict({"file": [row["path"]], "block": pa.array([at // step], pa.int64()), "tokens": [tokens]})

    return ranges.repartition(max(1, ranges.count()), "path", "first").mapInArrow(run, "file string, block long, tokens binary")


def _search(end_id: int, width: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            n, places = [], []
            for blob in batch.column("tokens").to_pylist():
                tokens = np.frombuffer(blob or b"", WIDTHS[width])
                n.append(len(tokens))
                places.append(np.flatnonzero(tokens == end_id))
            yield pa.RecordBatch.from_arrays(
                [batch.column("file"), batch.column("block"), pa.array(n, pa.int64()), pa.array(places, pa.list_(pa.int64()))],
                ["file", "block", "n", "ends"],
            )

    return run


def _before(rows: DataFrame, by: list[str], order: str, prefix: str) -> DataFrame:
    """Exclusive prefix scan of tokens, separators and the last separator's place, the latter counted from the scan's start."""
    before = Window.partitionBy(*by).orderBy(order).rowsBetween(Window.unboundedPreceding, -1)
    start = F.coalesce(F.sum("n").over(before), F.lit(0))
    placed = rows.withColumn(f"{prefix}start", start)
    last = F.max(F.col(f"{prefix}start") + F.col("last")).over(before)
    return placed.withColumn(f"{prefix}docs", F.coalesce(F.sum("seps").over(before), F.lit(0))).withColumn(f"{prefix}last", last)


def documents_in(blocks: DataFrame, end_id: int = END_ID, width: int = 2, span_blocks: int = SPAN_BLOCKS) -> DataFrame:
    """file, ordinal, start, length, closed: the documents of each file in order, counted in tokens from 0.

    ``blocks`` has file, block (any numbers that rise through a file) and tokens (whole tokens of ``width``
    bytes). The length leaves the separator out; two separators in a row close an empty document. Tokens
    after the last separator are a document that is not closed. Files without tokens give nothing.
    """
    found = settle(blocks.mapInArrow(_search(end_id, width), "file string, block long, n long, ends array<long>"), "ends")
    last = F.when(F.size("ends") > 0, F.element_at("ends", -1))
    thin = found.select("file", "block", "n", F.size("ends").alias("seps"), last.alias("last"), F.floor(F.col("block") / span_blocks).alias("span"))
    inner = _before(thin, ["file", "span"], "block", "in_")
    spans = inner.groupBy("file", "span").agg(F.sum("n").alias("n"), F.sum("seps").alias("seps"), F.max(F.col("in_start") + F.col("last")).alias("last"))
    outer = _before(spans, ["file"], "span", "out_").select("file", "span", "out_start", "out_docs", "out_last")
    scanned = inner.join(outer, ["file", "span"]).select(
        "file", "block", (F.col("out_start") + F.col("in_start")).alias("start"), (F.col("out_docs") + F.col("in_docs")).alias("docs"),
        (F.coalesce(F.col("out_start") + F.col("in_last"), F.col("out_last"), F.lit(-1)) + 1).alias("open"),
    )
    stitched = found.join(scanned, ["file", "block"])
    begin = lambda i: F.when(i == 0, F.col("open")).otherwise(F.col("start") + F.get("ends", i - 1) + 1)
    rows = F.transform("ends", lambda e, i: F.struct((F.col("docs") + i).alias("ordinal"), begin(i).alias("start"), (F.col("start") + e - begin(i)).alias("length")))
    closed = stitched.select("file", F.explode(rows).alias("d")).select("file", "d.*", F.lit(True).alias("closed"))
    whole = spans.groupBy("file").agg(F.sum("n").alias("n"), F.sum("seps").alias("ordinal"))
    ends = closed.groupBy("file").agg(F.max(F.col("start") + F.col("length") + 1).alias("open"))
    tail = whole.join(ends, "file", "left").withColumn("start", F.coalesce("open", F.lit(0))).where("n > start")
    return closed.unionByName(tail.select("file", "ordinal", "start", (F.col("n") - F.col("start")).alias("length"), F.lit(False).alias("closed")))


def counted(
    docs: DataFrame, tokenizer: str | None = None, block_tokens: int = BLOCK_TOKENS, end_id: int = END_ID, width: int | None = None
) -> DataFrame:
    """doc_id, file, start, n_tokens: tokens of each document, read off the flat files written from ``docs``."""
    width = width or token_width(tokenizer)
    blocks, listed = write_token_files(docs, tokenizer, end_id, block_tokens, width)
    found = documents_in(blocks, end_id, width)
    order = Window.partitionBy("file").orderBy("part")
    sized = listed.withColumn("n", F.size("ids"))
    base = F.coalesce(F.sum("n").over(order.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    owners = sized.withColumn("base", base).select("file", "base", F.posexplode("ids").alias("i", "doc_id"))
    owners = owners.select("file", (F.col("base") + F.col("i")).alias("ordinal"), "doc_id")
    return found.join(owners, ["file", "ordinal"]).select("doc_id", "file", "start", F.col("length").alias("n_tokens"))

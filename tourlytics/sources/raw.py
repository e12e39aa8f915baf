"""Raw event lines: scan, envelope decoding, and the split into good and bad records.

Decoding is columns only. A bad record becomes a row with a reason; its siblings are not affected.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.rules import first_of

# Reasons of rejected records.
BAD_JSON = "bad_json"
BAD_BASE64 = "bad_base64"
BAD_TEXT = "bad_utf8"
NO_DATA = "no_data"
NOT_AN_OBJECT = "not_an_object"
EMPTY_DOCUMENT = "empty_document"

RECORD = "kinesis struct<data string, sequenceNumber string, partitionKey string>"


def read_raw_lines(spark: SparkSession, path: str) -> DataFrame:
    """Archived files, one JSON document per line, in column ``value``."""
    return spark.read.text(path)


def read_envelope_stream(
    spark: SparkSession, path: str | None = None, source: str = "text", **options
) -> DataFrame:
    """Unbounded lines in column ``value``.

    ``text`` reads files that appear in a folder. Any other installed source works by name, for
    example ``kafka`` with its options; its ``value`` is read as text. A source of single records
    keeps its columns ``data``, ``sequenceNumber`` and ``partitionKey``.
    """
    reader = spark.readStream.format(source).options(**{k: str(v) for k, v in options.items()})
    lines = reader.load(path) if path else reader.load()
    if "data" in lines.columns:
        return lines.select(
            F.col("data").cast("string").alias("data"),
            F.col("sequenceNumber").alias("sequence_number"),
            F.col("partitionKey").alias("partition_key"),
        )
    return lines.select(F.col("value").cast("string").alias("value"))


def is_json(text: Column) -> Column:
    return F.try_parse_json(text).isNotNull()


def _from_base64(rows: DataFrame) -> DataFrame:
    """Adds ``_decoded``, the text behind base64 ``data``, and ``_refused``, the reason where there is none.

    The bytes and the text are columns of projections of their own, which makes them once: written into each
    expression that uses them, every record was decoded three times.
    """
    once = rows.withColumn("_bytes", F.try_to_binary("data", F.lit("base64")))
    once = once.withColumn("_decoded", F.try_validate_utf8(F.col("_bytes").cast("string")))
    reason = first_of([(F.col("_bytes").isNull(), BAD_BASE64), (F.col("_decoded").isNull(), BAD_TEXT)], None)
    return once.withColumn("_refused", F.when(F.col("data").isNotNull(), reason))


def decode_lines(lines: DataFrame) -> DataFrame:
    """One row per record of every line: document text, record metadata, reason if it is bad.

    A line is an envelope (an object with a list ``Records``), a JSON string holding base64, or one
    event object. Blank lines give nothing.
    """
    line = F.trim("value")
    heads = lines.where(F.col("value").isNotNull() & (line != "")).select(
        line.alias("line"),
        # Elements stay text, so that one element of a wrong kind does not spoil the list.
        F.from_json(line, "Records array<string>")["Records"].alias("_records"),
    )
    enveloped = F.col("_records").isNotNull()
    quoted = F.from_json(F.concat(F.lit("["), F.col("line"), F.lit("]")), "array<string>")[0]
    spread = heads.select(
        "line",
        enveloped.alias("_wrapped"),
        F.explode_outer("_records").alias("_record"),
    ).where(~F.col("_wrapped") | F.col("_record").isNotNull())
    spread = spread.withColumn("_head", F.from_json("_record", RECORD)["kinesis"])

    text_line = ~F.col("_wrapped") & F.col("line").startswith('"')
    data = F.when(F.col("_wrapped"), F.col("_head.data")).when(text_line, quoted)
    encoded = F.col("_wrapped") | text_line
    absent = first_of([(F.col("_wrapped"), NO_DATA)], BAD_JSON)
    return _decoded(
        spread.select(
            F.col("_head.sequenceNumber").alias("sequence_number"),
            F.col("_head.partitionKey").alias("partition_key"),
            data.alias("data"),
            F.when(~encoded, F.col("line")).alias("text"),
            F.when(encoded & data.isNull(), absent).alias("error"),
        )
    )


def decode_records(records: DataFrame) -> DataFrame:
    """The same for single records of a stream source: ``data``, ``sequence_number``, ``partition_key``."""
    return _decoded(
        records.select(
            "sequence_number",
            "partition_key",
            F.col("data").cast("string").alias("data"),
            F.lit(None).cast("string").alias("text"),
            F.when(F.col("data").isNull(), F.lit(NO_DATA)).alias("error"),
        )
    )


def _decoded(staged: DataFrame) -> DataFrame:
    """Document text from base64 ``data`` or plain ``text``, with the reason where it is no document."""
    parts = _from_base64(staged).select(
        "sequence_number",
        "partition_key",
        F.coalesce("text", "_decoded", "data").alias("payload"),  # what cannot be decoded stays as it came
        F.coalesce("error", "_refused").alias("_undecoded"),
    )
    body = F.trim("payload")
    reason = F.coalesce(
        F.col("_undecoded"),
        first_of(
            [
                (~is_json(F.col("payload")), BAD_JSON),
                (~body.startswith("{"), NOT_AN_OBJECT),
                (body.rlike(r"^\{\s*\}$"), EMPTY_DOCUMENT),
            ],
            None,
        ),
    )
    # The generator keeps the decoded values as they are: without it, each later filter on the reason
    # would be pushed below and decode every record again.
    record = F.struct("payload", "sequence_number", "partition_key", reason.alias("error"))
    return parts.select(F.explode(F.array(record)).alias("r")).select("r.*")


def split_quarantine(decoded: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Records without and with an error."""
    return decoded.where(F.col("error").isNull()), decoded.where(F.col("error").isNotNull())


def ingest_counts(decoded: DataFrame) -> DataFrame:
    """Records by outcome: ``processed`` or the reason of the rejection."""
    outcome = F.coalesce("error", F.lit("processed")).alias("outcome")
    return decoded.groupBy(outcome).agg(F.count(F.lit(1)).alias("records"))


def to_envelopes(
    records: DataFrame,
    group: Column,
    order: str = "event_id",
    encode: Callable[[Column, Column], Column] | None = None,
) -> DataFrame:
    """Envelope lines from records (``data``, ``sequence_number``, ``partition_key``), for replays.

    ``group`` names the envelope of a record and must keep envelopes small, as the stream service
    does. The records of an envelope follow ``order``.
    With ``encode``, records carry ``payload`` instead of ``data``, which is made of the payload and the order
    value after the shuffle: base64 text compresses badly.
    """
    carried = F.struct(F.col(order).alias("o"), F.col("payload" if encode else "data").alias("d"), "sequence_number", "partition_key")
    # Dealt by group first: lists made before the shuffle would be sorted whole in every task that reads
    # records, and hold one record or few.
    dealt = records.select(group.alias("_g"), carried.alias("_record")).repartition("_g")

    def record(r: Column) -> Column:
        data = encode(r["d"], r["o"]) if encode else r["d"]
        kinesis = F.struct(data.alias("data"), r["sequence_number"].alias("sequenceNumber"), r["partition_key"].alias("partitionKey"))
        return F.struct(kinesis.alias("kinesis"))

    return (
        dealt.groupBy("_g")
        .agg(F.transform(F.array_sort(F.collect_list("_record")), record).alias("Records"))
        .select(F.to_json(F.struct("Records")).alias("value"))
    )

"""Written steps, input sizes and Arrow helpers that the operators share."""

from __future__ import annotations

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..session import working_path

MISSING_ID = -(2**63)  # stands for a null id where ids are ordered: before all others


def settle(df: DataFrame, name: str, **options: str) -> DataFrame:
    """Writes a step below the shared folder and reads it back, which cuts the lineage."""
    path = working_path(df.sparkSession, name)
    df.write.options(**options).parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def forget(df: DataFrame) -> None:
    """Deletes the folder of a step that ``settle`` has written and nothing reads any more."""
    spark, jvm = df.sparkSession, df.sparkSession._jvm
    folders = {f.rsplit("/", 1)[0] for f in df.inputFiles()}
    for folder in folders:
        path = jvm.org.apache.hadoop.fs.Path(folder)
        path.getFileSystem(spark._jsparkSession.sessionState().newHadoopConf()).delete(path, True)


def text_bytes(df: DataFrame, column: str = "text") -> int:
    """UTF-8 bytes of a text column, over all rows."""
    size = F.octet_length(F.col(column)).cast("bigint")
    return df.agg(F.coalesce(F.sum(size), F.lit(0)).alias("n")).first()["n"]


def parts(amount: int, each: int, least: int = 1) -> int:
    """How many parts of about ``each`` an amount makes; grows with the amount, without an upper bound."""
    return max(least, -(-amount // each))


def raw(batch: pa.RecordBatch | pa.Table, column: str = "text") -> list[bytes | None]:
    """A text column as UTF-8 bytes, without decoding it."""
    return batch.column(column).cast(pa.binary()).to_pylist()


def table(**columns) -> pa.RecordBatch:
    return pa.RecordBatch.from_pydict(columns)


def lined_up(df: DataFrame, order: list[str], name: str) -> DataFrame:
    """All rows in one total order, written, with ``task`` and ``at``: the stretch of the order and the place in it.

    Stretches ascend and are cut by range sampling. Equal rows are told apart by their place in the input, so
    a key that a third of all rows share is spread over stretches too.
    """
    cut = df.withColumn("tie", F.monotonically_increasing_id()).repartitionByRange(*order, "tie")
    step = F.monotonically_increasing_id()  # the task's number above 33 bits, the row's below
    place = [F.shiftright(step, 33).cast("int").alias("task"), step.bitwiseAND((1 << 33) - 1).alias("at")]
    return settle(cut.sortWithinPartitions(*order, "tie").select(*df.columns, *place), name)


def ahead(sums: DataFrame, amount: str, *within: str) -> DataFrame:
    """``sums`` (a row a task, or a task and key) with the amount of all earlier tasks as ``ahead``."""
    earlier = Window.partitionBy(*within).orderBy("task").rowsBetween(Window.unboundedPreceding, -1)
    return sums.withColumn("ahead", F.coalesce(F.sum(amount).over(earlier), F.lit(0)))

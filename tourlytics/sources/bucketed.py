"""Tables bucketed by session, for joins and aggregates by session that shuffle nothing.

One task reads a whole bucket, so a session with a large part of all rows would make one task long. The sizes of
the buckets are known from the listing; ``read_bucketed`` hands out the table with its buckets only where
they are even, and as plain files otherwise, which the adaptive planner shuffles and splits.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

SLICES = 8  # tasks that write a bucket's rows, so that a hot session is written by several
UNEVEN = 4.0  # a largest bucket of more than so many times the mean is not read by one task


def write_bucketed(df: DataFrame, name: str, path: str, buckets: int, key: str = "session_id") -> None:
    """Saves a table of the session catalogue below ``path``, bucketed and sorted by ``key``.

    Choose buckets of about the size of a task's input. Each bucket is a few files.
    """
    dealt = df.withColumn("_slice", F.pmod(F.xxhash64(*[F.col(c) for c in df.columns]), F.lit(SLICES)))
    dealt = dealt.repartition(buckets, key, "_slice").drop("_slice")
    writer = dealt.write.mode("overwrite").option("compression", "zstd").option("path", path)
    writer.bucketBy(buckets, key).sortBy(key).saveAsTable(name)


def bucket_bytes(spark: SparkSession, path: str) -> DataFrame:
    """Bytes per bucket, from the listing."""
    files = spark.read.format("binaryFile").option("pathGlobFilter", "*.parquet").load(path)
    bucket = F.regexp_extract("path", r"_(\d+)(?:\.c\d+)?\.[^/]*$", 1).cast("int").alias("bucket")
    return files.groupBy(bucket).agg(F.sum("length").alias("bytes"))


def read_bucketed(spark: SparkSession, name: str, path: str, buckets: int, uneven: float = UNEVEN) -> DataFrame:
    """The table with its buckets, or as plain files if one bucket is much larger than the mean."""
    largest, total = bucket_bytes(spark, path).agg(F.max("bytes"), F.sum("bytes")).first()
    if total and largest > uneven * total / buckets:
        return spark.read.schema(spark.table(name).schema).parquet(path)
    return spark.table(name)

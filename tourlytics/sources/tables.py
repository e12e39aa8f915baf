"""Table scans and sinks on partitioned Parquet: append, merge, compaction, as-of reads."""

from __future__ import annotations

import re
from collections.abc import Callable, Iterable, Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..operators.filters import date_at, timestamp_at
from ..schemas import PARTITIONS
from ..session import drop_path, file_system, working_path
from .clustering import PUSHED_IDS, any_of

TARGET_FILE_BYTES = 128 * 1024 * 1024
BLOOM_COLUMNS = ("anonymous_id", "user_id")
EVENT_PARTITIONS = PARTITIONS["web_events"]
STAGED = "_staged"  # folder beside a table's partitions in which a replacement waits; readers skip it


# ---- Scans ------------------------------------------------------------------------------------


def read_events(spark: SparkSession, path: str, as_of=None, merge_schema: bool = False) -> DataFrame:
    table = spark.read.option("mergeSchema", str(merge_schema).lower()).parquet(path)
    return as_of_time(table, as_of) if as_of is not None else table


def as_of_time(table: DataFrame, moment, system_time: str = "processed_timestamp") -> DataFrame:
    """The table as it stood: exact for append-only tables that keep their processing time."""
    return table.where(F.col(system_time) <= timestamp_at(moment))


def union_evolved(*tables: DataFrame) -> DataFrame:
    """Rows of several schema versions; a column a version lacks is NULL there."""
    first, *others = tables
    for table in others:
        first = first.unionByName(table, allowMissingColumns=True)
    return first


# ---- Sinks ------------------------------------------------------------------------------------


def clustered(
    df: DataFrame,
    partitions: Sequence[str] = tuple(EVENT_PARTITIONS),
    cluster_by: Sequence[str] = ("session_id", "anonymous_id"),
) -> DataFrame:
    """Rows of a partition come together for writing, sorted by the clustering columns.

    A rebalance and not a plain repartition: the adaptive planner splits a partition that is larger
    than the advisory size, so a hot (day, space type) does not end up in one task and one file.
    """
    spread = df.hint("rebalance", *partitions) if partitions else df
    order = [c for c in [*partitions, *cluster_by] if c in df.columns]
    return spread.sortWithinPartitions(*order) if order else spread


def bloom_options(columns: Iterable[str]) -> dict[str, str]:
    """Writer options for a Bloom filter per row group of each column, sized by the ids that it holds."""
    out = {f"parquet.bloom.filter.enabled#{c}": "true" for c in columns}
    return {**out, "parquet.bloom.filter.adaptive.enabled": "true"} if out else out


def write_events(
    df: DataFrame,
    path: str,
    partitions: Sequence[str] = tuple(EVENT_PARTITIONS),
    cluster_by: Sequence[str] = ("session_id", "anonymous_id"),
    mode: str = "append",
) -> None:
    (
        clustered(df, partitions, cluster_by)
        .write.mode(mode)
        .option("compression", "zstd")
        .options(**bloom_options(c for c in BLOOM_COLUMNS if c in df.columns))
        .partitionBy(*partitions)
        .parquet(path)
    )


def write_staging_jsonl(df: DataFrame, path: str, mode: str = "append") -> None:
    """Compressed JSON lines, one folder per day and space type; an unknown space type is written as such.

    Every line repeats the names of the columns: as plain text, staged events took fifteen times the bytes.
    """
    named = df.withColumn("space_type", F.coalesce("space_type", F.lit("unknown")))
    clustered(named, EVENT_PARTITIONS, ()).write.mode(mode).partitionBy(
        *EVENT_PARTITIONS
    ).json(path, compression="gzip")


def write_mart(df: DataFrame, path: str, partitions: Sequence[str] = ()) -> None:
    """Full refresh of a mart."""
    writer = clustered(df, partitions, ()).write.mode("overwrite").option("compression", "zstd")
    (writer.partitionBy(*partitions) if partitions else writer).parquet(path)


def write_report(df: DataFrame, path: str, date) -> str:
    """Creates the report of a day; does nothing if it is there already."""
    target = f"{path.rstrip('/')}/daily_analytics_report_{str(date)[:10].replace('-', '')}"
    df.write.mode("ignore").parquet(target)
    return target


def register_views(views: dict[str, DataFrame]) -> None:
    for name, df in views.items():
        df.createOrReplaceTempView(name)


# ---- Merges -----------------------------------------------------------------------------------


def latest_per_key(df: DataFrame, key: str, order_cols: Sequence[str]) -> DataFrame:
    """One whole row per key, the greatest by ``order_cols``.

    ``max_by`` combines on the map side, so copies of a hot key never meet in one sort.
    """
    order = F.struct(*[F.col(c) for c in order_cols])
    return (
        df.groupBy(key)
        .agg(F.max_by(F.struct(*[F.col(c) for c in df.columns]), order).alias("_row"))
        .select("_row.*")
    )


def new_rows(
    target: DataFrame, batch: DataFrame, key: str = "event_id", order_cols: Sequence[str] = ()
) -> DataFrame:
    """Rows of the batch whose key the target lacks, one per key; both sides are read once."""
    order = list(order_cols) or _recency(batch)
    unique = latest_per_key(batch, key, order) if order else batch.dropDuplicates([key])
    return unique.join(target.select(key), key, "left_anti")


def merge_insert_only(
    target: DataFrame, batch: DataFrame, key: str = "event_id", order_cols: Sequence[str] = ()
) -> DataFrame:
    """The merged table: all target rows, plus batch rows with a new key."""
    return target.unionByName(new_rows(target, batch, key, order_cols), allowMissingColumns=True)


def append_new(
    spark: SparkSession,
    path: str,
    batch: DataFrame,
    key: str = "event_id",
    partitions: Sequence[str] = tuple(EVENT_PARTITIONS),
    day: str | None = "event_date",
    written: bool = False,
    before: Callable[[DataFrame], None] | None = None,
    copy: KeyCopy | None = None,
) -> None:
    """Insert-only merge of a batch into a table on storage.

    The batch is evaluated once: its rows are written to the shared folder and read from there; ``written``
    says that it is a written table already. Which keys repeat and which the table has is found from keys
    alone, and written: whole rows are shuffled for a join only where these keys are too many to broadcast,
    and not at all where no key repeats and the table has none of them, or all. ``day`` names the partition
    column that the key fixes, as an id that holds the event time fixes its day; then only the target's days
    from the batch's first to its last are read. Pass None if it does not. ``before`` is called with the rows that
    are new before they are appended, and not at all if there are none. ``copy`` is for merges that come again and
    again: it hands out the target's keys without opening all its files each time.
    """

    def append(new: DataFrame) -> None:
        if before:
            before(new)
        write_events(new, path, partitions)

    landed, repeats, chosen, held = (working_path(spark, f"append_{name}") for name in ("rows", "repeats", "chosen", "held"))
    try:
        rows = batch
        if not written:
            batch.write.parquet(landed)
            rows = spark.read.schema(batch.schema).parquet(landed)
        rows = one_per_key(spark, rows, key, repeats, chosen)
        target, on = read_if_exists(spark, path), [key]
        if target is None:
            append(rows)
            return
        if day:
            on = [key, day]
        days = [F.min(day), F.max(day)] if day else []
        total, *span = rows.agg(F.count(F.lit(1)), *days).first()
        if copy:
            target = copy.read(spark, path, target, on, *span)
        if day:
            target = target.where(F.col(day).between(*map(F.lit, span)) | F.col(day).isNull())
        # The table's keys stream past those of the batch: the table is not shuffled for a small batch.
        keys = rows.select(*on)
        target.select(*on).join(keys, on, "left_semi").distinct().write.parquet(held)
        known = spark.read.schema(keys.schema).parquet(held)
        found = known.count()
        if found == 0:
            append(rows)
        elif found < total:
            append(rows.join(known, on, "left_anti"))
    finally:
        for step in (landed, repeats, chosen, held):
            drop_path(spark, step)


class KeyCopy:
    """The keys of a table in a working folder, for a stream that merges batch after batch into it.

    Each batch adds a file to every partition it touches, so merges that open all files for their keys cost batches
    times files. Here a file is opened once, and the keys of many lie in a few. The table is listed at every call:
    what others have written is seen, and where a file is gone (compacted, erased) the copy is made anew. It holds
    the days of the batches, and is made anew as well when most of them are no longer asked for.
    """

    def __init__(self) -> None:
        self.folder: str | None = None
        self.seen: dict[str, str | None] = {}  # files and their days

    def read(self, spark: SparkSession, path: str, target: DataFrame, on: Sequence[str], first=None, last=None) -> DataFrame:
        """The columns ``on`` of the target's rows from one day to another, or of all; rows of other days may be among them."""
        files = {f: self._day(f, on) for f in target.inputFiles()}
        wanted = {f: d for f, d in files.items() if d is None or first is None or str(first) <= d <= str(last)}
        days = len({*self.seen.values()} - {None}), len({*wanted.values()} - {None})
        if self.folder is None or not self.seen.keys() <= files.keys() or days[0] > 2 * days[1] + 2:
            self.drop(spark)
            self.folder = working_path(spark, "keys")
        if new := sorted(wanted.keys() - self.seen.keys()):
            place = lambda f: spark._jvm.org.apache.hadoop.fs.Path(spark._jvm.java.net.URI(f)).toString()
            # The first time it may be all: they have been listed, and need not be named.
            rows = target if len(new) == len(files) else read_folders(spark, path, [place(f) for f in new], target.schema)
            rows.select(*on).write.mode("append").parquet(self.folder)
            self.seen |= {f: wanted[f] for f in new}
        if not self.seen:
            return target.select(*on).where(F.lit(False))
        return spark.read.schema(target.select(*on).schema).parquet(self.folder)

    def drop(self, spark: SparkSession) -> None:
        if self.folder is not None:
            drop_path(spark, self.folder)
        self.folder, self.seen = None, {}

    @staticmethod
    def _day(file: str, on: Sequence[str]) -> str | None:
        """The day of a file's partition, None where the path does not tell it."""
        found = re.search(rf"/{re.escape(on[1])}=([0-9]{{4}}-[0-9]{{2}}-[0-9]{{2}})/", file) if len(on) > 1 else None
        return found[1] if found else None


def one_per_key(spark: SparkSession, rows: DataFrame, key: str, repeats: str, chosen: str) -> DataFrame:
    """The same as ``latest_per_key`` by recency for written rows of which few repeat: only those are carried to be
    compared. All other rows pass by, unsorted.

    A count by key alone finds the keys that repeat. They and their chosen rows are written to two folders, so
    that their size is known before the join, and each later read gives the same rows.
    """
    again = rows.groupBy(key).agg(F.count(F.lit(1)).alias("_n")).where("_n > 1").select(F.col(key).alias("_key"))
    again.write.parquet(repeats)
    repeated = spark.read.schema(again.schema).parquet(repeats)
    if repeated.isEmpty():
        return rows
    same = F.col(key).eqNullSafe(F.col("_key"))
    latest_per_key(rows.join(repeated, same, "left_semi"), key, _recency(rows)).write.parquet(chosen)
    return rows.join(repeated, same, "left_anti").unionByName(spark.read.schema(rows.schema).parquet(chosen))


def _recency(df: DataFrame) -> list[str]:
    return [c for c in ("processed_timestamp", "event_timestamp") if c in df.columns]


def merge_upsert(
    target: DataFrame, batch: DataFrame, key: str = "event_id", order_cols: Sequence[str] = ()
) -> DataFrame:
    """Batch rows replace target rows with the same key; other rows of both stay."""
    order = list(order_cols)
    sides = target.withColumn("_side", F.lit(0)).unionByName(
        batch.withColumn("_side", F.lit(1)), allowMissingColumns=True
    )
    return latest_per_key(sides, key, ["_side", *order]).drop("_side")


def union_dedup(a: DataFrame, b: DataFrame, key: str) -> DataFrame:
    """All keys of both, one row each; a row of ``a`` wins, so the result is repeatable."""
    sides = a.withColumn("_side", F.lit(1)).unionByName(
        b.withColumn("_side", F.lit(0)), allowMissingColumns=True
    )
    return latest_per_key(sides, key, ["_side"]).drop("_side")


# ---- Maintenance ------------------------------------------------------------------------------


def read_if_exists(spark: SparkSession, path: str) -> DataFrame | None:
    try:
        return spark.read.parquet(path)
    except AnalysisException as missing:
        if missing.getCondition() in ("PATH_NOT_FOUND", "UNABLE_TO_INFER_SCHEMA"):
            return None
        raise


def _listing(spark: SparkSession, path: str, partitions: Sequence[str]) -> DataFrame:
    """One row per data file: partition values, folder and length. No file content is read."""
    files = spark.read.format("binaryFile").option("pathGlobFilter", "*.parquet").load(path)
    return files.select(*partitions, F.regexp_replace("path", "/[^/]*$", "").alias("folder"), "length")


def partition_files(
    spark: SparkSession, path: str, partitions: Sequence[str] = tuple(EVENT_PARTITIONS)
) -> DataFrame:
    """Files and bytes per partition, from the listing."""
    return _listing(spark, path, partitions).groupBy(*partitions).agg(
        F.count(F.lit(1)).alias("files"), F.sum("length").alias("bytes")
    )


def list_partitions(
    spark: SparkSession, path: str, columns: Sequence[str] = tuple(EVENT_PARTITIONS)
) -> DataFrame:
    """The partitions that hold files, from the listing."""
    return _listing(spark, path, columns).select(*columns).distinct()


def folders_of(spark: SparkSession, path: str, wanted: DataFrame, partitions: Sequence[str]) -> list[str]:
    """Folders of the partitions that ``wanted`` names; a partition value may be null."""
    files = _listing(spark, path, partitions).select(*partitions, "folder").distinct()
    same = [files[p].eqNullSafe(wanted[p]) for p in partitions]
    return [r["folder"] for r in files.join(wanted, same, "left_semi").collect()]


def read_folders(spark: SparkSession, path: str, folders: Sequence[str], schema: T.StructType) -> DataFrame:
    """Some partitions of a table, read without listing the others."""
    if not folders:
        return spark.createDataFrame([], schema)
    return spark.read.option("basePath", path).schema(schema).parquet(*folders)


# ---- Replacing partitions ---------------------------------------------------------------------


def replace_partitions(
    spark: SparkSession,
    path: str,
    rows: DataFrame,
    old: Sequence[str],
    partitions: Sequence[str] = tuple(EVENT_PARTITIONS),
    expected: int | None = None,
) -> None:
    """Puts ``rows`` in the place of the partition folders ``old`` and of those the rows fall into.

    The new partitions are written to a folder of their own inside the table, which readers skip, and
    counted if a number is expected; then a list of what to swap is written, and each folder is swapped
    by a delete and a rename. An old folder without new rows is dropped. If the driver dies before the
    list is there, the table is as before; if it dies after, ``resume_replacement`` does the rest. Run
    it while nothing else writes to these partitions. The driver handles partition folders, not rows.
    """
    resume_replacement(spark, path)
    staged = f"{path.rstrip('/')}/{STAGED}"
    drop_path(spark, staged)
    new = f"{staged}/rows"
    blooms = bloom_options(c for c in BLOOM_COLUMNS if c in rows.columns)
    rows.write.option("compression", "zstd").options(**blooms).partitionBy(*partitions).parquet(new)
    if expected is not None:
        written = sum(r[0] for r in spark.read.schema(rows.schema).parquet(new).groupBy().count().collect())
        if written != expected:
            drop_path(spark, staged)
            raise ValueError(f"{written} rows staged, {expected} expected")
    base = [_relative(spark, path, f) for f in old]
    into = [_relative(spark, new, f) for f in _folders(spark, new)]
    plan = [(f, f in set(into)) for f in sorted({*base, *into})]
    spark.createDataFrame(plan, "folder string, filled boolean").coalesce(1).write.json(f"{staged}/plan")
    resume_replacement(spark, path)


def resume_replacement(spark: SparkSession, path: str) -> None:
    """Ends a replacement that has been planned but not finished; does nothing without one."""
    root = path.rstrip("/")
    files, done = file_system(spark, f"{root}/{STAGED}/plan/_SUCCESS")
    if not files.exists(done):
        return
    for row in spark.read.schema("folder string, filled boolean").json(f"{root}/{STAGED}/plan").collect():
        place = lambda *parts: spark._jvm.org.apache.hadoop.fs.Path("/".join(parts))
        new, target = place(root, STAGED, "rows", row["folder"]), place(root, row["folder"])
        if row["filled"] and not files.exists(new):
            continue  # swapped before
        files.delete(target, True)
        if row["filled"]:
            files.mkdirs(target.getParent())
            if not files.rename(new, target):
                raise OSError(f"cannot move {new} to {target}")
    drop_path(spark, f"{root}/{STAGED}")
    spark.catalog.refreshByPath(root)


def _folders(spark: SparkSession, path: str) -> list[str]:
    """Partition folders that hold files."""
    try:
        return [r[0] for r in _listing(spark, path, ()).select("folder").distinct().collect()]
    except AnalysisException as missing:
        if missing.getCondition() == "PATH_NOT_FOUND":
            return []
        raise


def _relative(spark: SparkSession, base: str, folder: str) -> str:
    files, place = file_system(spark, base)
    return folder[len(files.makeQualified(place).toString().rstrip("/")) + 1 :]


def compact_partitions(
    spark: SparkSession,
    path: str,
    since,
    target_bytes: int = TARGET_FILE_BYTES,
    partitions: Sequence[str] = tuple(EVENT_PARTITIONS),
    spread_by: str = "event_id",
) -> None:
    """Rewrites the partitions from a day on into files near the target size; keeps every row.

    A partition of n target sizes is spread over n tasks by a hash of ``spread_by``. The new files are
    counted before they take the old ones' place; see ``replace_partitions``.
    """
    resume_replacement(spark, path)
    day = partitions[0]
    files = _listing(spark, path, partitions).where(F.col(day) >= date_at(since))
    sizes = files.groupBy(*partitions, "folder").agg(F.count(F.lit(1)).alias("files"), F.sum("length").alias("bytes"))
    sizes = sizes.where("files > 1").withColumn("_parts", F.ceil(F.col("bytes") / F.lit(target_bytes)).cast("int"))
    plan = sizes.select(*partitions, "folder", "_parts").collect()  # one row per partition folder
    if not plan:
        return
    rows = spark.read.parquet(path)
    schema = [*[rows.schema[p] for p in partitions]]
    wanted = spark.createDataFrame(
        [(*r[: len(partitions)], r["_parts"]) for r in plan], T.StructType([*schema, T.StructField("_parts", T.IntegerType())])
    )
    same = [F.col(f"t.{p}").eqNullSafe(F.col(f"w.{p}")) for p in partitions]
    old = (
        rows.where(F.col(day) >= date_at(since)).alias("t")
        .join(wanted.alias("w"), same)
        .select("t.*", F.pmod(F.xxhash64(f"t.{spread_by}"), F.col("_parts")).alias("_part"))
    )
    kept = old.repartition(sum(r["_parts"] for r in plan), *partitions, "_part").select(*rows.columns)
    replace_partitions(spark, path, kept, [r["folder"] for r in plan], partitions, old.count())


def column_stats(df: DataFrame, columns: Iterable[str] | None = None) -> DataFrame:
    """One row per column: rows, NULLs, approximate distinct values, smallest and largest as text.

    A single pass over the table with one global aggregate, then unpivoted.
    """
    names = list(columns or df.columns)
    cells = []
    for name in names:
        column = F.col(name)
        cells.append(
            F.struct(
                F.lit(name).alias("column_name"),
                F.count(F.lit(1)).alias("rows"),
                F.count_if(column.isNull()).alias("nulls"),
                F.approx_count_distinct(column).alias("distinct_estimate"),
                F.min(column).cast("string").alias("smallest"),
                F.max(column).cast("string").alias("largest"),
            )
        )
    return df.agg(F.array(*cells).alias("_cells")).select(F.explode("_cells").alias("c")).select("c.*")


# ---- Recovery and retention -------------------------------------------------------------------


def erase_subject(events: DataFrame, subjects: DataFrame, key: str = "anonymous_id") -> DataFrame:
    """Rows whose visitor is not among the subjects to erase."""
    return events.join(subjects.select(key).distinct(), key, "left_anti")


def erase_on_storage(
    spark: SparkSession,
    path: str,
    subjects: DataFrame,
    key: str = "anonymous_id",
    partitions: Sequence[str] = tuple(EVENT_PARTITIONS),
) -> None:
    """Rewrites the partitions that hold rows of the subjects without them; one that is left empty goes.

    A first pass over the key alone finds those partitions; only they are read whole. Up to ``PUSHED_IDS``
    subjects are handed to the reader, which skips row groups by their Bloom filters; more are joined.
    """
    resume_replacement(spark, path)
    rows = spark.read.parquet(path)
    wanted = subjects.select(key).where(F.col(key).isNotNull()).distinct()
    few = [r[0] for r in wanted.limit(PUSHED_IDS + 1).collect()]
    if len(few) <= PUSHED_IDS:
        hit = rows.where(any_of(key, few))
    else:
        hit = rows.select(*partitions, key).join(wanted, key, "left_semi")
    hit = hit.select(*partitions).distinct()
    folders = folders_of(spark, path, hit, partitions)
    if not folders:
        return
    held = read_folders(spark, path, folders, rows.schema)
    replace_partitions(spark, path, clustered(erase_subject(held, wanted, key).select(*rows.columns), partitions), folders, partitions)


def restore_partition(
    spark: SparkSession, backup: str, path: str, day, partitions: Sequence[str] = tuple(EVENT_PARTITIONS)
) -> None:
    """Puts one whole day of a snapshot copy back in place; partitions of the day it does not have go."""
    resume_replacement(spark, path)
    is_day = F.col(partitions[0]) == date_at(day)
    copy = spark.read.parquet(backup).where(is_day)
    old = [r["folder"] for r in _listing(spark, path, partitions).where(is_day).select("folder").distinct().collect()]
    replace_partitions(spark, path, clustered(copy, partitions), old, partitions, copy.count())


def retain_since(df: DataFrame, day, column: str = "event_date") -> DataFrame:
    """Rows inside the retention period."""
    return df.where(F.col(column) >= date_at(day))


def retain_on_storage(
    spark: SparkSession, path: str, day, partitions: Sequence[str] = tuple(EVENT_PARTITIONS)
) -> None:
    """Drops the partitions of the days before the retention period; no file content is read."""
    resume_replacement(spark, path)
    old = _listing(spark, path, partitions).where(F.col(partitions[0]) < date_at(day))
    for row in old.select("folder").distinct().collect():
        drop_path(spark, row["folder"])
    spark.catalog.refreshByPath(path)

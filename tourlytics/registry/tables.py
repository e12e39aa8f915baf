"""Table sinks, merges and maintenance, run on tables written below the shared folder."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators.filters import date_at
from ..schemas import WEB_EVENTS, conform
from ..session import working_path
from ..sources import tables
from . import data
from .catalog import query
from .events import WEB_COLS, sql_cols
from .oracle_base import AS_OF, chain, day, rnd, ts
from .result import plain

_SHORT = ["event_id", "event_date", "space_type", "session_id", "page_path"]
_OLD = "event_date <= DATE '2024-01-15'"
_NEW = "event_date >= DATE '2024-01-12'"


def _halves(spark, folder):
    """Two overlapping parts of the event table; the second has a changed page path."""
    events = data.web_events(spark, folder).select(*_SHORT, "processed_timestamp")
    old = events.where(F.col("event_date") <= date_at("2024-01-15"))
    new = events.where(F.col("event_date") >= date_at("2024-01-12"))
    return old, new.withColumn("page_path", F.concat(F.lit("/new"), F.col("page_path")))


def _merged_sql(expr: str) -> str:
    return (
        chain("web")
        + f"SELECT event_id, {day('event_date')}, space_type, session_id, {expr} AS page_path FROM web"
    )


_KEEP_OLD = f"if({_OLD}, page_path, '/new' || page_path)"
_TAKE_NEW = f"if({_NEW}, '/new' || page_path, page_path)"


@query("merge_insert_only", _merged_sql(_KEEP_OLD))
def insert_only(spark, folder):
    old, new = _halves(spark, folder)
    twice = new.unionByName(new)  # a batch may hold a key twice
    return plain(tables.merge_insert_only(old, twice).select(*_SHORT))


@query("append_new", _merged_sql(_KEEP_OLD))
def append_new(spark, folder):
    """The same merge into a table on storage, then replayed once."""
    old, new = _halves(spark, folder)
    path = working_path(spark, "append_new")
    for batch in (old, new, new):
        tables.append_new(spark, path, batch)
    return plain(spark.read.parquet(path).select(*_SHORT))


@query("merge_upsert", _merged_sql(_TAKE_NEW))
def upsert(spark, folder):
    old, new = _halves(spark, folder)
    return plain(tables.merge_upsert(old, new, order_cols=["processed_timestamp"]).select(*_SHORT))


@query("union_dedup", _merged_sql(_KEEP_OLD))
def dedup(spark, folder):
    old, new = _halves(spark, folder)
    return plain(tables.union_dedup(old, new, "event_id").select(*_SHORT))


@query(
    "union_evolved",
    chain("web")
    + f"""SELECT event_id, event_type, anonymous_id, if({_OLD}, NULL, session_id) AS session_id,
if({_OLD}, NULL, space_type) AS space_type FROM web""",
)
def evolved(spark, folder):
    events = data.web_events(spark, folder)
    first = ["event_id", "event_type", "anonymous_id"]
    day15 = date_at("2024-01-15")
    old = events.where(F.col("event_date") <= day15).select(*first)
    new = events.where(F.col("event_date") > day15).select(*first, "session_id", "space_type")
    return tables.union_evolved(old, new)


@query("written_web_events", chain("web") + f"SELECT {sql_cols(WEB_COLS)} FROM web")
def written(spark, folder):
    """The event table as read back from storage."""
    return plain(tables.as_of_time(data.web_events(spark, folder), "2024-12-31 00:00:00").select(*WEB_COLS))


@query(
    "declared_web_events",
    chain("web") + f"SELECT {sql_cols([c for c in WEB_COLS if c in WEB_EVENTS.names])} FROM web",
)
def declared(spark, folder):
    table = conform(data.web_events(spark, folder), WEB_EVENTS)
    return plain(table.drop("url_hash", "space_token"))


@query(
    "as_of_read",
    chain("web")
    + f"""SELECT event_id, {ts("processed_timestamp")} FROM web
WHERE processed_timestamp <= TIMESTAMP '2024-01-10 06:00:00'""",
)
def as_of(spark, folder):
    past = tables.as_of_time(data.web_events(spark, folder), "2024-01-10 06:00:00")
    return plain(past.select("event_id", "processed_timestamp"))


@query(
    "compacted_partitions",
    chain("web")
    + f"""SELECT {day("event_date")}, space_type, count(*) AS rows, true AS files_ok FROM web
GROUP BY event_date, space_type""",
)
def compacted(spark, folder):
    """Four appends leave several files; compaction leaves recent partitions the files they need."""
    path = working_path(spark, "compacted")
    events = data.web_events(spark, folder).select(*_SHORT)
    part = F.pmod(F.xxhash64("event_id"), F.lit(4))
    for k in range(4):
        events.where(part == k).write.mode("append").partitionBy("event_date", "space_type").parquet(path)
    tables.compact_partitions(spark, path, "2024-01-20")
    rows = spark.read.parquet(path).groupBy("event_date", "space_type").agg(
        F.count(F.lit(1)).alias("rows")
    )
    files = tables.partition_files(spark, path)
    needed = F.ceil(F.col("bytes") / F.lit(tables.TARGET_FILE_BYTES))
    is_old = F.col("event_date") < date_at("2024-01-20")
    return plain(
        rows.join(files, ["event_date", "space_type"]).select(
            "event_date", "space_type", "rows", (is_old | (F.col("files") <= needed)).alias("files_ok")
        )
    )


@query(
    "staging_jsonl",
    chain("web")
    + f"""SELECT event_id, {day("event_date")}, space_type, session_id, page_path FROM web""",
)
def staging(spark, folder):
    path = working_path(spark, "staging_jsonl")
    tables.write_staging_jsonl(data.web_events(spark, folder).select(*_SHORT), path)
    back = spark.read.schema(
        "event_id string, session_id string, page_path string, event_date date, space_type string"
    ).json(path)
    return plain(back.select(*_SHORT))


@query(
    "partition_list",
    chain("web") + f"SELECT DISTINCT {day('event_date')}, space_type FROM web",
)
def partitions(spark, folder):
    return plain(tables.list_partitions(spark, data.web_events_path(spark, folder)))


_STATS = ["anonymous_id", "space_type", "session_event_sequence"]


@query(
    "column_stats",
    chain("web")
    + " UNION ALL ".join(
        f"""SELECT '{c}' AS column_name, count(*) AS rows, count(*) - count({c}) AS nulls,
CAST(min({c}) AS VARCHAR) AS smallest, CAST(max({c}) AS VARCHAR) AS largest,
true AS estimate_holds FROM web"""
        for c in _STATS
    ),
)
def stats(spark, folder):
    """The distinct estimate is compared with the exact number, to three times its error."""
    events = data.web_events(spark, folder)
    exact = events.agg(F.explode(F.array(*[F.struct(F.lit(c).alias("column_name"), F.count_distinct(c).alias("exact")) for c in _STATS])).alias("e"))
    found = tables.column_stats(events, _STATS).join(exact.select("e.*"), "column_name")
    near = F.abs(F.col("distinct_estimate") - F.col("exact")) <= F.greatest(F.lit(1.0), 0.15 * F.col("exact"))
    return found.select("column_name", "rows", "nulls", "smallest", "largest", near.alias("estimate_holds"))


@query(
    "erased_subjects",
    chain("web")
    + f"""SELECT {day("event_date")}, count(*) AS rows FROM web
WHERE coalesce(anonymous_id, '') NOT IN ('u0', 'u3') GROUP BY event_date""",
)
def erased(spark, folder):
    subjects = spark.createDataFrame([("u0",), ("u3",)], "anonymous_id string")
    kept = tables.erase_subject(data.web_events(spark, folder), subjects)
    return plain(kept.groupBy("event_date").agg(F.count(F.lit(1)).alias("rows")))


@query(
    "restored_partition",
    chain("web") + f"SELECT {day('event_date')}, space_type, count(*) AS rows FROM web GROUP BY ALL",
)
def restored(spark, folder):
    """A day is damaged in a copy of the table, by loss and by a foreign space type, then put back."""
    events = data.web_events(spark, folder).select(*_SHORT)
    backup, path = working_path(spark, "backup"), working_path(spark, "restored")
    tables.write_events(events, backup)
    bad_day = F.col("event_date") == date_at("2024-01-15")
    junk = events.where(bad_day).limit(5).withColumn("space_type", F.lit("junk"))
    tables.write_events(events.where(~bad_day | (F.col("page_path") == "/home")).unionByName(junk), path)
    tables.restore_partition(spark, backup, path, "2024-01-15")
    table = spark.read.parquet(path)
    return plain(table.groupBy("event_date", "space_type").agg(F.count(F.lit(1)).alias("rows")))


@query(
    "retained_events",
    chain("web")
    + f"""SELECT {day("event_date")}, count(*) AS rows FROM web WHERE event_date >= DATE '2024-01-21'
GROUP BY event_date""",
)
def retained(spark, folder):
    kept = tables.retain_since(data.web_events(spark, folder), "2024-01-21")
    return plain(kept.groupBy("event_date").agg(F.count(F.lit(1)).alias("rows")))


@query(
    "erased_on_storage",
    chain("web")
    + f"""SELECT {day("event_date")}, space_type, count(*) AS rows FROM web
WHERE coalesce(anonymous_id, '') NOT IN ('u0', 'u3') GROUP BY ALL""",
)
def erased_files(spark, folder):
    """A subject is the only visitor of a partition, which goes; counted from what is on storage."""
    path = working_path(spark, "erase")
    events = data.web_events(spark, folder).select(*_SHORT, "anonymous_id")
    alone = events.where("anonymous_id = 'u3'").limit(3).withColumn("space_type", F.lit("only u3"))
    tables.write_events(events.unionByName(alone), path)
    tables.erase_on_storage(spark, path, spark.createDataFrame([("u0",), ("u3",), (None,)], "anonymous_id string"))
    left = spark.read.parquet(path).groupBy("event_date", "space_type").agg(F.count(F.lit(1)).alias("rows"))
    return plain(tables.list_partitions(spark, path).join(left, ["event_date", "space_type"]))


@query(
    "retained_on_storage",
    chain("web")
    + f"""SELECT {day("event_date")}, space_type, count(*) AS rows FROM web
WHERE event_date >= DATE '2024-01-21' GROUP BY ALL""",
)
def retained_files(spark, folder):
    path = working_path(spark, "retain")
    tables.write_events(data.web_events(spark, folder).select(*_SHORT), path)
    tables.retain_on_storage(spark, path, "2024-01-21")
    left = spark.read.parquet(path).groupBy("event_date", "space_type").agg(F.count(F.lit(1)).alias("rows"))
    return plain(tables.list_partitions(spark, path).join(left, ["event_date", "space_type"]))


@query(
    "written_report",
    chain("fct")
    + f"""SELECT space_type, count(*) AS rows, {rnd("avg(engagement_score)", "avg_engagement")}
FROM fct GROUP BY space_type""",
)
def report(spark, folder):
    """Mart and report sinks: full refresh, then a report that is created once."""
    fact = data.fact(spark, folder)
    mart = working_path(spark, "mart")
    body = fact.groupBy("event_date", "space_type").agg(
        F.count(F.lit(1)).alias("n"), F.sum("engagement_score").alias("s")
    )
    for _ in range(2):  # the second write replaces the first
        tables.write_mart(body, mart, ["event_date"])
    table = spark.read.parquet(mart)
    whole = table.groupBy("space_type").agg(
        F.sum("n").alias("rows"), (F.sum("s") / F.sum("n")).alias("avg_engagement")
    )
    reports = working_path(spark, "reports")
    tables.write_report(whole, reports, AS_OF)
    target = tables.write_report(whole.limit(0), reports, AS_OF)  # ignored: it exists
    return plain(spark.read.parquet(target))


@query(
    "registered_views",
    chain("fct")
    + """SELECT session_time, count(*) AS sessions FROM (SELECT session_id,
min(time_period) AS session_time FROM fct GROUP BY session_id) GROUP BY session_time""",
)
def views(spark, folder):
    tables.register_views({"fct_web_events": data.fact(spark, folder)})
    return spark.sql(
        """SELECT session_time, count(*) AS sessions FROM (
             SELECT session_id, min(time_period) AS session_time
             FROM fct_web_events GROUP BY session_id)
           GROUP BY session_time"""
    )

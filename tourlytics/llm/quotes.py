"""Quotation linking: conversations in reply order, without the quotes.

Quoted passages are parsed with their level, normalised and hashed, and joined to the first message of the
conversation that says the same in its own words. Replies are tied to what they quote; threads are found by
doubling the distance of every message to its root. Everything is DataFrame functions.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .shared import forget, settle

_LINE_END, _QUOTED = r"\r?\n", r"^[ \t]*>[> \t]*"
_BLANKS = " \t\n\x0b\f\r"
_PASSAGE, _LEVEL = "\x00", "\x01"  # taken out of texts before they mark anything


def normalised(text: Column) -> Column:
    """Lower case, white space as single blanks, none at the ends."""
    return F.trim(F.regexp_replace(F.lower(text), r"\s+", " "))


def _hash(text: Column) -> Column:
    return F.sha2(normalised(text), 256)


def _hashes(texts: Column) -> Column:
    """Hashes of the texts that hold anything, each once."""
    return F.array_distinct(F.transform(F.filter(texts, lambda x: normalised(x) != ""), _hash))


def passages(messages: DataFrame) -> DataFrame:
    """The messages with passages: runs of lines of one quote level, as structs level and said (lines joined).

    Level 0 is the message's own words; a level is the number of marks ``>`` before a line, with blanks
    between them or not. Null texts have no passages.
    """
    clean = F.translate("text", _PASSAGE + _LEVEL, "  ")

    def parsed(line: Column) -> Column:
        prefix = F.regexp_extract(line, _QUOTED, 0)
        level = F.length(F.regexp_replace(prefix, "[^>]", ""))
        return F.struct(level.alias("level"), F.substring(line, F.length(prefix) + 1, F.length(line)).alias("said"))

    lines = messages.withColumn("lines_", F.transform(F.split(clean, _LINE_END, -1), parsed))
    before = F.concat(F.array(F.lit(-1)), F.transform("lines_", lambda x: x["level"]))
    marked = F.zip_with(
        "lines_",
        F.slice(before, 1, F.size("lines_")),
        lambda x, level: F.when(x["level"] == level, F.concat(F.lit("\n"), x["said"])).otherwise(
            F.concat(F.lit(_PASSAGE), x["level"].cast("string"), F.lit(_LEVEL), x["said"])
        ),
    )
    runs = F.split(F.array_join(marked, ""), _PASSAGE, -1)

    def passage(run: Column) -> Column:
        return F.struct(F.substring_index(run, _LEVEL, 1).cast("int").alias("level"), F.substring_index(run, _LEVEL, -1).alias("said"))

    return lines.withColumn("passages", F.transform(F.slice(runs, 2, F.size(runs)), passage)).drop("lines_")


def _own(found: Column) -> Column:
    """The message's own words, blank lines at both ends taken off."""
    said = F.transform(F.filter(found, lambda p: p["level"] == 0), lambda p: p["said"])
    return F.btrim(F.array_join(said, "\n"), F.lit(_BLANKS))


def quote_links(messages: DataFrame) -> DataFrame:
    """conv_id, turn, level, hash, original_turn: quoted passages and the message they come from.

    A passage is looked up whole; one that nobody said whole is looked up line by line. The original is the
    first message of the conversation that says it as its whole text, a paragraph or a line of its own words,
    if that comes before the quoting one. One row for each message, level and hash; original_turn is null where
    nobody has said it before. Messages without conv_id or turn quote nothing and say nothing.
    """
    keyed = passages(messages.where("conv_id is not null and turn is not null").select("conv_id", "turn", "text"))
    own = _own(F.col("passages"))
    units = _hashes(F.concat(F.array(own), F.split(own, r"\n[ \t]*\n"), F.split(own, r"\n")))
    said = keyed.select("conv_id", "turn", F.explode(units).alias("hash")).groupBy("conv_id", "hash").agg(F.min("turn").alias("first"))
    said = settle(said, "said")
    quoted = F.filter("passages", lambda p: (p["level"] > 0) & (normalised(p["said"]) != ""))
    whole = keyed.select("conv_id", "turn", F.explode(quoted).alias("p")).select("conv_id", "turn", "p.level", "p.said", _hash(F.col("p.said")).alias("hash"))
    found = whole.join(said, ["conv_id", "hash"], "left").withColumn("first", F.when(F.col("first") < F.col("turn"), F.col("first")))
    found = settle(found, "quoted")
    lines = found.where("first is null and said like '%\\n%'")
    lines = lines.select("conv_id", "turn", "level", F.explode(_hashes(F.split("said", "\n"))).alias("hash"))
    lines = lines.join(said, ["conv_id", "hash"], "left").withColumn("first", F.when(F.col("first") < F.col("turn"), F.col("first")))
    rows = found.where("first is not null or said not like '%\\n%'").select("conv_id", "turn", "level", "hash", "first")
    rows = rows.unionByName(lines.select("conv_id", "turn", "level", "hash", "first"))
    return rows.groupBy("conv_id", "turn", "level", "hash").agg(F.min("first").alias("original_turn"))


def _threads(replies: DataFrame) -> DataFrame:
    """conv_id, turn, root_turn, depth of messages that reply; rounds grow with the logarithm of the depth."""
    now = settle(replies.select("conv_id", "turn", F.col("reply_to").alias("up"), F.lit(1).cast("long").alias("depth"), F.lit(False).alias("top")), "threads")
    while now.where("not top").limit(1).count():
        above = now.select("conv_id", F.col("turn").alias("up"), F.col("up").alias("next"), F.col("depth").alias("more"))
        joined = now.join(above, ["conv_id", "up"], "left")
        before, now = now, settle(
            joined.select(
                "conv_id", "turn", F.coalesce("next", "up").alias("up"), (F.col("depth") + F.coalesce("more", F.lit(0))).alias("depth"), F.col("next").isNull().alias("top")
            ),
            "threads",
        )
        forget(before)
    return now.select("conv_id", "turn", F.col("up").alias("root_turn"), "depth")


def conversations(messages: DataFrame) -> DataFrame:
    """The messages in reply order without quotes: the columns of ``messages`` and the following.

    reply_to: the latest original among the passages quoted at level 1, else among all; null if nothing is
    linked. root_turn and depth: first message of the thread and steps to it (the turn itself and 0 without a
    reply). n_quoted, n_linked: passages (or their lines) quoted, and those with an original. Text holds the
    message's own words; null stays null. In a conversation a thread's messages stand together: the order is
    conv_id, root_turn, turn, and the rows come in it. Rows that share conv_id and turn are one message in
    the linking and all stay; rows without conv_id or turn come out with no links.
    """
    added = ("reply_to", "root_turn", "depth", "n_quoted", "n_linked")
    columns = [c for c in messages.columns if c not in added]
    links = quote_links(messages)
    direct = F.max(F.when(F.col("level") == 1, F.col("original_turn")))
    by_message = links.groupBy("conv_id", "turn").agg(
        F.coalesce(direct, F.max("original_turn")).alias("reply_to"),
        F.count(F.lit(1)).alias("n_quoted"), F.count("original_turn").alias("n_linked"),
    )
    by_message = settle(by_message, "replies")
    threads = _threads(by_message.where("reply_to is not null"))
    kept = messages.select(F.struct(*[F.col(f"`{c}`") for c in columns]).alias("row"), "text")
    keyed = kept.select("row", "text", F.col("row.conv_id").alias("conv_id"), F.col("row.turn").alias("turn"))
    out = keyed.join(by_message, ["conv_id", "turn"], "left").join(threads, ["conv_id", "turn"], "left")
    # Ordered first: sorting looks at its rows twice, and a text is parsed once, on its way out.
    out = out.withColumn("root_turn", F.coalesce("root_turn", "turn")).orderBy("conv_id", "root_turn", "turn")
    zero = lambda c: F.coalesce(c, F.lit(0)).cast("long").alias(c)
    said = F.when(F.col("text").isNotNull(), _own(F.col("passages"))).alias("text")
    shown = [said if c == "text" else F.col(f"row.`{c}`") for c in columns]
    return passages(out).select(*shown, "reply_to", "root_turn", zero("depth"), zero("n_quoted"), zero("n_linked"))

"""Secrets in texts: fixed patterns, and strings that a character Markov model takes for random.

Two models of the transitions between characters are trained on labelled tokens, one on random strings and
one on ordinary identifiers. A token counts as a secret if the ratio of its likelihoods under the two is
high. Everything is DataFrame functions; the driver sees the counts of character pairs only.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .regions import matches, replaced

#: Kinds in the order they are listed, their patterns and least lengths.
KINDS = ("assign", "access", "hex", "markov")
ASSIGN = r"""((?i:password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
ASSIGN_LEAST = 12
ACCESS = r"AKIA[A-Z0-9]{14,}"  # with the four letters at least 18; a shorter run holds no longer one
HEX = r"[0-9a-f]{16,}"

CANDIDATE_LEAST = 20
CANDIDATE = rf"[A-Za-z0-9+/=_-]{{{CANDIDATE_LEAST},}}"
ALPHABET = "abcdefghijklmnopqrstuvwxyzABCDEFGHIJKLMNOPQRSTUVWXYZ0123456789+/=_-"
STATES = len(ALPHABET) + 2  # 0: any other character; the last: before the first character
LEAST_RATIO = 12.0  # of the logarithms, for the whole token
LEAST_MEAN = 1.75  # of the logarithms, for each character

SAMPLE_DOCUMENTS = 2000  # rows whose words teach what is ordinary
SAMPLE_RANDOM = 2000  # generated strings of each form


def _codes(token: Column) -> Column:
    characters = F.filter(F.split(token, ""), lambda c: c != "")
    return F.transform(characters, lambda c: F.instr(F.lit(ALPHABET), c))


def labelled_tokens(docs: DataFrame, sample_documents: int = SAMPLE_DOCUMENTS, sample_random: int = SAMPLE_RANDOM) -> DataFrame:
    """token, random: labelled samples. Ordinary ones are words of some documents, alone and joined as identifiers,
    and rules, dates and numbers. Random ones are hex, base-64 and capital strings made from
    hashes, and the values of fixed patterns in the same documents. At most ``sample_documents`` rows give words:
    the ids are taken by their hash, and of each id one text; rows without an id or a text give none.
    """
    rows = docs.where("doc_id is not null and text is not null").select("doc_id", "text")
    drawn = rows.select(F.xxhash64("doc_id").alias("h"), F.xxhash64("text").alias("t")).groupBy("h").agg(F.min("t").alias("t"))
    chosen = drawn.orderBy("h").limit(sample_documents)
    some = rows.join(F.broadcast(chosen), (F.xxhash64("doc_id") == F.col("h")) & (F.xxhash64("text") == F.col("t")), "left_semi")
    some = some.groupBy("doc_id").agg(F.first("text").alias("text"))  # copies of a row count once
    base = F.concat(*[F.regexp_extract_all("text", F.lit(p), F.lit(0)) for p in (ACCESS, HEX)], F.regexp_extract_all("text", F.lit(ASSIGN), F.lit(2)))
    known = some.select(F.explode(base).alias("token")).where(F.length("token") >= 12).select("token", F.lit(True).alias("random"))
    words = F.filter(F.split("text", r"[^A-Za-z]+"), lambda w: F.length(w) >= 2)
    listed = some.select(words.alias("w"))
    pairs = F.transform("w", lambda w, i: F.struct(w.alias("a"), F.get("w", i + 1).alias("b"), i.alias("i")))
    joined = listed.select(F.explode(pairs).alias("p")).where("p.b is not null").select("p.*")
    low = [F.lower(c) for c in "ab"]
    forms = [
        F.col("a"), F.concat_ws("_", *low), F.concat_ws("_", F.upper("a"), F.upper("b")), F.concat(low[0], F.initcap("b")),
        F.concat(F.initcap("a"), F.initcap("b")), F.concat_ws("/", *low), F.concat_ws("/", low[0], F.initcap("b")),
        F.concat(low[0], F.lit("-"), low[1], (F.col("i") % 100).cast("string")),
    ]
    identifier = F.get(F.array(*forms), F.col("i") % len(forms))
    rules = [F.expr(f"repeat('{c}', id % 60 + 2)") for c in "-=_+/0"]
    numbers = [F.date_add(F.lit("2000-01-01").cast("date"), F.col("id").cast("int")).cast("string"), (F.col("id") * 7919).cast("string"), F.concat(F.lit("v"), (F.col("id") % 30).cast("string"))]
    marks = docs.sparkSession.range(sample_random).select(F.explode(F.array(*rules, *numbers)).alias("token"))
    ordinary = joined.select(identifier.alias("token"), F.lit(False).alias("random"))
    ordinary = ordinary.unionByName(marks.select("token", F.lit(False).alias("random")))
    return known.unionByName(ordinary).unionByName(random_tokens(docs.sparkSession, sample_random))


def random_tokens(spark: SparkSession, rows: int) -> DataFrame:
    """Strings made from hashes, in the forms that keys have."""
    digest = F.sha2(F.concat(F.lit("sample-"), F.col("id").cast("string")), 256)
    coded = F.regexp_replace(F.base64(F.unhex(digest)), "=", "")
    forms = F.array(coded, F.upper(F.regexp_replace(coded, "[+/]", "")), F.substring(digest, 1, 40), F.translate(coded, "+/", "-_"))
    return spark.range(rows).select(F.explode(forms).alias("token"), F.lit(True).alias("random"))


def train(samples: DataFrame, weight: float = 0.5) -> list[float]:
    """Logarithms of the ratio of transition probabilities, by state before and state, from labelled tokens.

    ``samples`` has token and random; null and empty tokens teach nothing; without samples all is zero.
    """
    codes = _codes(F.col("token"))
    before = F.concat(F.array(F.lit(STATES - 1)), codes)  # one longer
    pairs = F.filter(F.zip_with(before, codes, lambda a, b: F.struct(a.alias("a"), b.alias("b"))), lambda p: p["b"].isNotNull())
    seen = samples.where("token <> ''").select("random", F.explode(pairs).alias("p")).groupBy("random", "p.a", "p.b").count()
    counts = {True: [weight] * STATES * STATES, False: [weight] * STATES * STATES}
    for row in seen.collect():  # at most two rows for each pair of states
        counts[row["random"]][row["a"] * STATES + row["b"]] += row["count"]
    logs = {}
    for kind, table in counts.items():
        sums = [sum(table[a * STATES : (a + 1) * STATES]) for a in range(STATES)]
        logs[kind] = [math.log(n / sums[k // STATES]) for k, n in enumerate(table)]
    return [x - y for x, y in zip(logs[True], logs[False], strict=True)]


def log_ratio(token: Column, model: list[float]) -> Column:
    """How much likelier a token is as a random string than as an ordinary one, in logarithms."""
    table = F.split(F.lit(",".join(f"{x:.6f}" for x in model)), ",").cast("array<double>")
    start = F.struct(F.lit(STATES - 1).alias("state"), F.lit(0.0).alias("sum"))

    def step(acc: Column, c: Column) -> Column:
        return F.struct(c.alias("state"), (acc["sum"] + F.get(table, acc["state"] * STATES + c)).alias("sum"))

    return F.aggregate(_codes(token), start, step, lambda acc: acc["sum"])


def scan(docs: DataFrame, model: list[float]) -> DataFrame:
    """The rows of ``docs`` with arrays assign, access, hex, markov of structs s, e, m (code points, text).

    Base patterns are found per kind, leftmost and without overlap; assignments need a value of at least
    ASSIGN_LEAST characters. Markov spans are tokens of CANDIDATE characters, or what base spans leave of them
    in parts of at least CANDIDATE_LEAST. Null and empty texts have none. Columns of these names are replaced.
    """
    text = F.col("text")
    out = docs.withColumn("assign", F.filter(matches(text, ASSIGN), lambda x: F.length(F.regexp_extract(x["m"], ASSIGN, 2)) >= ASSIGN_LEAST))
    out = out.withColumn("access", matches(text, ACCESS)).withColumn("hex", matches(text, HEX))

    # Base spans are blanked out, so that a candidate ends there and its rest is a candidate by itself.
    base = F.transform(F.concat("assign", "access", "hex"), lambda x: F.struct(x["s"].alias("s"), x["e"].alias("e")))
    out = out.withColumn("rest_", replaced(text, base, lambda size: F.repeat(F.lit(" "), size)))

    def likely(x: Column) -> Column:
        ratio = log_ratio(x["m"], model)
        return ratio >= F.greatest(F.lit(LEAST_RATIO), LEAST_MEAN * F.length(x["m"]))

    return out.withColumn("markov", F.filter(matches(F.col("rest_"), CANDIDATE), likely)).drop("rest_")


def listed(kinds: tuple[str, ...]) -> Column:
    """kind:start:end of the spans of some kinds, by start and then kind, joined by commas."""
    of = lambda k: F.transform(k, lambda x: F.struct(x["s"].alias("s"), F.lit(KINDS.index(k)).alias("k"), x["e"].alias("e")))
    rows = F.array_sort(F.concat(*[of(k) for k in kinds]))
    name = lambda x: F.get(F.array(*map(F.lit, KINDS)), x["k"])
    return F.array_join(F.transform(rows, lambda x: F.concat_ws(":", name(x), x["s"].cast("string"), x["e"].cast("string"))), ",")


def redacted(docs: DataFrame, model: list[float], by: str = "[secret]") -> DataFrame:
    """The rows of ``docs`` with every span in text replaced and n_chars counted anew where there was one."""
    found = scan(docs.select(F.struct("*").alias("row"), "text"), model)
    spans = F.transform(F.concat(*KINDS), lambda x: F.struct(x["s"].alias("s"), x["e"].alias("e")))
    found = found.select("row", spans.alias("spans"), "text")
    found = found.select("row", "spans", replaced(F.col("text"), F.col("spans"), lambda size: F.lit(by)).alias("text"))
    length = F.when(F.size("spans") > 0, F.length("text").cast("long")).otherwise(F.col("row.n_chars")) if "n_chars" in docs.columns else None
    new = {"text": F.col("text"), "n_chars": length}
    return found.select(*[new[c].alias(c) if c in new else F.col(f"row.`{c}`") for c in docs.columns])

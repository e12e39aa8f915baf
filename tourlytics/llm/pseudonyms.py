"""Format-preserving pseudonyms for personal numbers, dates and addresses in texts.

A validated value is permuted within its own format by a keyed Feistel network, so the pseudonym is valid
too, and equal values get equal pseudonyms in every document. Numbers with a check digit keep it right, and
are looked for with every end (and cards with every start) that whole groups of digits allow, as neighbours
such as an expiry or a year may look like a part of them.
Everything is DataFrame functions; the key is a parameter, and the rounds are HMACs under it.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

ROUNDS = 10
KINDS = ("email", "iban", "ip", "date", "ssn", "phone", "card")  # tried in this order where matches start together

#: The formats. Runs that could be long are possessive and never begun inside.
_OCTET = r"(?:25[0-5]|2[0-4][0-9]|1[0-9][0-9]|[1-9]?[0-9])"
FORMATS = {
    "email": r"(?<![A-Za-z0-9._%+-])[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
    "iban": r"(?<![A-Za-z0-9])[A-Z]{2}[0-9]{2}(?: ?[A-Z0-9]{4}){2,7}(?: ?[A-Z0-9]{1,3})?(?![A-Za-z0-9])",
    "ip": rf"(?<![0-9.])(?:{_OCTET}\.){{3}}{_OCTET}(?!\.?[0-9])",
    "date": r"(?<![0-9./-])(?:[0-9]{4}-[0-9]{2}-[0-9]{2}|[0-9]{2}\.[0-9]{2}\.[0-9]{4}|[0-9]{2}/[0-9]{2}/[0-9]{4})(?![0-9/-])",
    "ssn": r"(?<![0-9-])[0-9]{3}-[0-9]{2}-[0-9]{4}(?![0-9-])",
    "phone": r"(?<![0-9(+])(?:\+[0-9]{1,3}[ .-]?)?(?:\([0-9]{3}\) ?|[0-9]{3}[ .-])[0-9]{3}[ .-][0-9]{4}(?![0-9])",
    "card": r"(?<![0-9])[0-9](?:[ -]?[0-9]){12,18}(?![0-9])",
}
CHECKED = {"iban": r"[A-Za-z0-9]", "card": r"[0-9]"}  # kinds with a check digit, and what may not stand beside them
CHECKED_ANY = "|".join(FORMATS[k] for k in CHECKED)
IBAN_LENGTHS = {
    15: "NO", 16: "BE", 18: "DK FI FK FO GL NL SD", 19: "MK SI", 20: "AT BA EE KZ LT LU MN XK", 21: "CH HR LI LV",
    22: "BG BH CR DE GB GE IE ME RS VA", 23: "AE GI IL IQ OM SO TL", 24: "AD CZ ES MD PK RO SA SE SK TN VG", 25: "LY PT ST",
    26: "IS TR", 27: "BI DJ FR GR IT MC MR SM", 28: "AL AZ BY CY DO GT HN HU LB NI PL SV", 29: "BR EG PS QA UA",
    30: "JO KW MU YE", 31: "MT SC", 32: "LC", 33: "RU",
}

FIRST_DAY, DAYS = "1900-01-01", 229 * 319  # to 2099-12-31
_LOWER, _UPPER, _DIGITS = "abcdefghijklmnopqrstuvwxyz", "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "0123456789"


def _let(value: Column, use: Callable[[Column], Column]) -> Column:
    """``use`` of a value that is worked out once, where a function over an array would do so for every element."""
    return F.get(F.transform(F.array(value), use), F.lit(0))


def _characters(text: Column) -> Column:
    return F.filter(F.split(text, ""), lambda c: c != "")


def _digits(text: Column) -> Column:
    return F.regexp_replace(text, "[^0-9]", "")


def secret(spark: SparkSession, key: str) -> Column:
    """The key, padded for HMAC, as a value that is read at run time: neither a plan nor a log shows it."""
    pads = []
    for name, block in (("sha256", 64), ("sha512", 128)):
        short = hashlib.new(name, key.encode()).digest() if len(key.encode()) > block else key.encode()
        pads += [bytes(b ^ mask for b in short.ljust(block, b"\0")) for mask in (0x36, 0x5C)]
    kind = "k struct<inner256:binary,outer256:binary,inner512:binary,outer512:binary>"
    return spark.createDataFrame([(tuple(pads),)], kind).scalar()


def _digest(key: Column, tweak: str, turn: Column, half: Column, bits: int) -> Column:
    """HMAC of a round's input, in hexadecimal."""
    said = F.concat_ws("|", F.lit(tweak), turn.cast("string"), half).cast("binary")
    inner = F.unhex(F.sha2(F.concat(key[f"inner{bits}"], said), bits))
    return F.sha2(F.concat(key[f"outer{bits}"], inner), bits)


def _number(hexadecimal: Column) -> Column:
    return F.conv(hexadecimal, 16, 10).cast("bigint")


def permuted_number(n: Column, rows: int, columns: int, key: Column, tweak: str) -> Column:
    """A keyed permutation of 0 .. rows * columns - 1."""

    def turn(acc: Column, k: Column) -> Column:
        add = lambda half: _number(F.substring(_digest(key, tweak, k, half.cast("string"), 256), 1, 13))
        row = F.when(k % 2 == 0, (acc["row"] + add(acc["column"])) % rows).otherwise(acc["row"])
        column = F.when(k % 2 == 1, (acc["column"] + add(acc["row"])) % columns).otherwise(acc["column"])
        return F.struct(row.alias("row"), column.alias("column"))

    start = F.struct(F.floor(n / columns).cast("bigint").alias("row"), (n % columns).cast("bigint").alias("column"))
    return F.aggregate(F.sequence(F.lit(1), F.lit(ROUNDS)), start, turn, lambda acc: acc["row"] * columns + acc["column"])


def permuted_text(text: Column, key: Column, tweak: str) -> Column:
    """A keyed permutation of the strings with letters, capitals and digits in the same places."""

    def moved(half: Column, other: Column, k: Column) -> Column:
        def move(digest: Column, c: Column, i: Column) -> Column:
            step = _number(F.substring(digest, (i % 42) * 3 + 1, F.lit(3)))
            out = c
            for alphabet in (_LOWER, _UPPER, _DIGITS):
                at = F.instr(F.lit(alphabet), c)
                shifted = F.substring(F.lit(alphabet), ((at - 1 + step) % len(alphabet) + 1).cast("int"), F.lit(1))
                out = F.when(at > 0, shifted).otherwise(out)
            return out

        digest = _digest(key, tweak, k, other, 512)
        return _let(digest, lambda d: F.array_join(F.transform(_characters(half), lambda c, i: move(d, c, i)), ""))

    def turn(acc: Column, k: Column) -> Column:
        left = F.when(k % 2 == 0, moved(acc["left"], acc["right"], k)).otherwise(acc["left"])
        right = F.when(k % 2 == 1, moved(acc["right"], acc["left"], k)).otherwise(acc["right"])
        return F.struct(left.alias("left"), right.alias("right"))

    half = F.floor(F.length(text) / 2).cast("int")
    start = F.struct(F.substring(text, F.lit(1), half).alias("left"), F.substring(text, half + 1, F.length(text)).alias("right"))
    return F.aggregate(F.sequence(F.lit(1), F.lit(ROUNDS)), start, turn, lambda acc: F.concat(acc["left"], acc["right"]))


def refilled(text: Column, filling: Column, wanted: str) -> Column:
    """The text with its characters of a class replaced, in order, by those of ``filling``."""

    def step(put: Column, acc: Column, c: Column) -> Column:
        mine = c.rlike(wanted)
        one = F.when(mine, F.substring(put, acc["k"], F.lit(1))).otherwise(c)
        return F.struct(F.concat(acc["out"], one).alias("out"), (acc["k"] + mine.cast("int")).alias("k"))

    start = F.struct(F.lit("").alias("out"), F.lit(1).alias("k"))
    return _let(filling, lambda put: F.aggregate(_characters(text), start, lambda acc, c: step(put, acc, c), lambda acc: acc["out"]))


def _luhn_sum(digits: Column) -> Column:
    """Digit sum with every second digit doubled, the last one not."""
    weighted = F.transform(F.reverse(_characters(digits)), lambda c, i: F.when(i % 2 == 1, F.pmod(c.cast("int") * 2 - 1, F.lit(9)) + F.when(c == "0", -8).otherwise(1)).otherwise(c.cast("int")))
    return F.aggregate(weighted, F.lit(0), lambda a, x: a + x)


def _mod_97(text: Column) -> Column:
    """Remainder of an account number, letters counting 10 to 35."""

    def step(acc: Column, c: Column) -> Column:
        at = F.instr(F.lit(_DIGITS + _UPPER), c) - 1
        return F.pmod(F.when(at > 9, acc * 100 + at).otherwise(acc * 10 + at), F.lit(97))

    return F.aggregate(_characters(text), F.lit(0), step)


def _email(m: Column, key: Column) -> tuple[Column, Column]:
    local, domain = F.substring_index(m, "@", 1), F.substring_index(m, "@", -1)
    return F.lit(True), F.concat(permuted_text(local, key, "email"), F.lit("@"), domain)


def _iban(m: Column, key: Column) -> tuple[Column, Column]:
    plain = F.replace(m, F.lit(" "), F.lit(""))
    country, account = F.substring(plain, 1, 2), F.substring(plain, F.lit(5), F.length(plain))
    valid = _mod_97(F.concat(account, F.substring(plain, 1, 4))) == 1
    moved = permuted_text(account, key, "iban")
    check = F.lpad((98 - _mod_97(F.concat(moved, country, F.lit("00")))).cast("string"), 2, "0")
    return valid, refilled(m, F.concat(country, check, moved), "[A-Z0-9]")


def _ip(m: Column, key: Column) -> tuple[Column, Column]:
    number = F.aggregate(F.split(m, r"\."), F.lit(0).cast("bigint"), lambda a, x: a * 256 + x.cast("bigint"))
    moved = permuted_number(number, 1 << 16, 1 << 16, key, "ip")
    parts = F.transform(F.array(*[F.lit(s) for s in (24, 16, 8, 0)]), lambda s: F.pmod(F.floor(moved / F.pow(F.lit(2), s)), F.lit(256)).cast("string"))
    return F.lit(True), F.array_join(parts, ".")


def _date(m: Column, key: Column) -> tuple[Column, Column]:
    layouts = {"-": "yyyy-MM-dd", ".": "dd.MM.yyyy", "/": "MM/dd/yyyy"}
    of = lambda f: F.when(F.instr(m, "-") > 0, f(layouts["-"])).when(F.instr(m, ".") > 0, f(layouts["."])).otherwise(f(layouts["/"]))
    day = F.datediff(of(lambda p: F.to_date(F.try_to_timestamp(m, F.lit(p)))), F.lit(FIRST_DAY).cast("date"))
    moved = F.date_add(F.lit(FIRST_DAY).cast("date"), permuted_number(day.cast("bigint"), 229, 319, key, "date").cast("int"))
    return day.between(0, DAYS - 1), of(lambda p: F.date_format(moved, p))


def _ssn(m: Column, key: Column) -> tuple[Column, Column]:
    area, group, serial = (F.split(m, "-")[k].cast("bigint") for k in range(3))
    valid = area.between(1, 899) & (area != 666) & (group > 0) & (serial > 0)
    place = area - F.when(area > 666, 2).otherwise(1)
    moved = permuted_number((place * 99 + group - 1) * 9999 + serial - 1, 898 * 99, 9999, key, "ssn")
    first = F.floor(moved / (99 * 9999))
    out = [first + F.when(first >= 665, 2).otherwise(1), F.pmod(F.floor(moved / 9999), F.lit(99)) + 1, F.pmod(moved, F.lit(9999)) + 1]
    return valid, F.concat_ws("-", *[F.lpad(x.cast("bigint").cast("string"), n, "0") for x, n in zip(out, (3, 2, 4), strict=True)])


def _phone(m: Column, key: Column) -> tuple[Column, Column]:
    digits = _digits(m)
    return F.lit(True), refilled(m, F.concat(F.substring(digits, F.lit(1), F.length(digits) - 10), permuted_text(F.substring(digits, -10, 10), key, "phone")), "[0-9]")


def _card(m: Column, key: Column) -> tuple[Column, Column]:
    digits = _digits(m)
    body = F.concat(F.substring(digits, 1, 1), permuted_text(F.substring(digits, F.lit(2), F.length(digits) - 2), key, "card"))
    check = F.pmod(-_luhn_sum(F.concat(body, F.lit("0"))), F.lit(10)).cast("string")
    return _luhn_sum(digits) % 10 == 0, refilled(m, F.concat(body, check), "[0-9]")


_RULES: dict[str, Callable[[Column, Column], tuple[Column, Column]]] = {
    "email": _email, "iban": _iban, "ip": _ip, "date": _date, "ssn": _ssn, "phone": _phone, "card": _card,
}


def _iban_of(length: int, countries: str) -> str:
    groups, tail = divmod(length - 4, 4)
    return rf"(?:{countries.replace(' ', '|')})[0-9]{{2}}(?: ?[A-Z0-9]{{4}}){{{groups}}}" + (rf" ?[A-Z0-9]{{{tail}}}" if tail else "")


#: What may be a value with a check digit: the usual forms, and then any other, the first choice first. Candidates overlap.
_USUAL = {
    "iban": "|".join(_iban_of(n, c) for n, c in IBAN_LENGTHS.items()),
    "card": "[0-9]{13,19}|[0-9]{4}(?:[ -][0-9]{4}){3}|[0-9]{4}[ -][0-9]{6}[ -][0-9]{4,5}",
}
_OTHER = {"iban": [FORMATS["iban"]], "card": [rf"[0-9](?:[ -]?[0-9]){{{n - 1}}}" for n in range(19, 12, -1)]}


def _checked(text: Column, kind: str, key: Column) -> Column:
    """A pattern of the valid values of a kind in a text; null if there are none."""
    beside = CHECKED[kind]

    def valid(t: Column, patterns: list[str]) -> Column:
        found = [F.regexp_extract_all(t, F.lit(f"(?<!{beside})(?=((?:{p}))(?!{beside}))"), F.lit(1)) for p in patterns]
        return F.array_distinct(F.filter(F.concat(*found), lambda m: _RULES[kind](m, key)[0]))

    def pattern(values: Column) -> Column:
        one = F.concat(F.lit(f"(?<!{beside})(?:"), F.array_join(values, "|"), F.lit(f")(?!{beside})"))
        return F.when(F.size(values) > 0, one)

    def both(usual: Column) -> Column:
        rest = F.coalesce(F.regexp_replace(text, pattern(usual), F.lit("_")), text)  # so that no other candidate overlaps
        return _let(F.concat(usual, valid(rest, _OTHER[kind])), pattern)

    return F.when(text.rlike(FORMATS[kind]), _let(valid(text, [_USUAL[kind]]), both))


def _pattern(text: Column, key: Column) -> Column:
    """The formats, those with a check digit as the valid values that the text holds."""
    plain = "|".join(FORMATS[k] for k in KINDS if k not in CHECKED)
    every = F.concat_ws("|", *[_checked(text, k, key) if k in CHECKED else F.lit(FORMATS[k]) for k in KINDS])
    return F.when(text.rlike(CHECKED_ANY), every).otherwise(F.lit(plain))


def _kind(m: Column) -> Column:
    out = F.lit(None).cast("string")
    for kind in reversed(KINDS):
        out = F.when(m.rlike(f"^(?:{FORMATS[kind]})$"), F.lit(kind)).otherwise(out)
    return out


def _replaced(x: Column, key: Column) -> Column:
    """kind and pseudonym of a match; the match itself, without a kind, if it is not valid."""
    name, out = F.lit(None).cast("string"), x["m"]
    for kind in KINDS:
        valid, pseudonym = _RULES[kind](x["m"], key)
        mine = (x["kind"] == kind) & valid
        name, out = F.when(mine, F.lit(kind)).otherwise(name), F.when(mine, pseudonym).otherwise(out)
    return F.struct(name.alias("kind"), out.alias("put"))


def pseudonymised(docs: DataFrame, key: str) -> DataFrame:
    """The rows of ``docs`` with valid personal values in text replaced, and their number by kind in n_<kind>.

    Emails (local part), account numbers with right check digits, IPv4 addresses, calendar dates from 1900 to
    2099 (yyyy-MM-dd, dd.MM.yyyy, MM/dd/yyyy), social security numbers, phone numbers (country code kept) and
    card numbers with a right check digit (first digit kept). Values that fail their check stay as they are; of
    valid ones that overlap, those of usual length and grouping count, then the first, then the longest.
    Separators stay in place and do not count: equal digits get equal pseudonyms. Null texts stay null; columns
    named n_<kind> are replaced.
    """
    columns = [c for c in docs.columns if c not in {f"n_{k}" for k in KINDS}]
    text, hidden = F.col("text"), F.col("key_")
    pattern = F.col("pattern_")
    found = F.transform(F.regexp_extract_all(text, pattern, F.lit(0)), lambda m: F.struct(_kind(m).alias("kind"), m.alias("m")))
    none = F.array().cast("array<struct<kind:string,m:string>>")
    out = docs.select(*[F.col(f"`{c}`") for c in columns]).withColumn("key_", secret(docs.sparkSession, key))
    out = out.withColumn("pattern_", _pattern(text, hidden))
    out = out.withColumn("found_", F.when(F.rlike(text, pattern), found).otherwise(none))
    out = out.withColumn("put_", F.transform("found_", lambda x: _replaced(x, hidden)))
    puts = F.concat(F.transform("put_", lambda x: x["put"]), F.array(F.lit("")))
    joined = F.array_join(F.flatten(F.zip_with(F.split(text, pattern, -1), puts, lambda gap, put: F.array(gap, put))), "")
    of = lambda kind: F.size(F.filter("put_", lambda x: x["kind"] == kind)).cast("long")
    counts = [of(kind).alias(f"n_{kind}") for kind in KINDS]
    rebuilt = F.when(F.size("put_") > 0, joined).otherwise(text).alias("text")
    return out.select(*[rebuilt if c == "text" else F.col(f"`{c}`") for c in columns], *counts)

import datetime as dt
import hmac
import ipaddress
import re
import time

import pyspark.sql.functions as F
import pytest

from llm_frames import documents, ordered
from tourlytics.llm import pseudonyms

KEY = "test key"


def texts(spark, rows, key=KEY):
    docs = documents(spark, [(i, t, None, None, None) for i, t in enumerate(rows)])
    found = {r["doc_id"]: r for r in pseudonymised(docs, key)}
    return [found[i] for i in range(len(rows))]


def pseudonymised(docs, key=KEY):
    return pseudonyms.pseudonymised(docs, key).collect()


def luhn(text):
    digits = [int(c) for c in text if c.isdigit()][::-1]
    return (sum(digits[::2]) + sum(sum(divmod(2 * d, 10)) for d in digits[1::2])) % 10 == 0


def shape(text):
    return re.sub("[a-z]", "a", re.sub("[A-Z]", "A", re.sub("[0-9]", "9", text)))


# ---- The rules once more, in plain Python ----


def mac(bits, *parts, key=KEY):
    return hmac.new(key.encode(), "|".join(map(str, parts)).encode(), f"sha{bits}").hexdigest()


def plain_number(n, rows, columns, tweak):
    row, column = divmod(n, columns)
    for k in range(1, pseudonyms.ROUNDS + 1):
        if k % 2:
            column = (column + int(mac(256, tweak, k, row)[:13], 16)) % columns
        else:
            row = (row + int(mac(256, tweak, k, column)[:13], 16)) % rows
    return row * columns + column


def plain_text(text, tweak):
    halves = [text[: len(text) // 2], text[len(text) // 2 :]]
    for k in range(1, pseudonyms.ROUNDS + 1):
        at, out = k % 2, ""
        digest = mac(512, tweak, k, halves[1 - at])
        for i, c in enumerate(halves[at]):
            step = int(digest[i % 42 * 3 : i % 42 * 3 + 3], 16)
            for first, size in (("a", 26), ("A", 26), ("0", 10)):
                if 0 <= ord(c) - ord(first) < size:
                    c = chr(ord(first) + (ord(c) - ord(first) + step) % size)
                    break
            out += c
        halves[at] = out
    return "".join(halves)


def fill(shape_of, digits, wanted):
    rest = iter(digits)
    return "".join(next(rest) if re.match(wanted, c) else c for c in shape_of)


def plain(kind, v):
    """The pseudonym of a valid value."""
    if kind == "email":
        local, domain = v.split("@")
        return f"{plain_text(local, 'email')}@{domain}"
    if kind == "iban":
        account = plain_text(v.replace(" ", "")[4:], "iban")
        check = 98 - int("".join(str(int(c, 36)) for c in account + v[:2] + "00")) % 97
        return fill(v, f"{v[:2]}{check:02}{account}", "[A-Z0-9]")
    if kind == "ip":
        return str(ipaddress.ip_address(plain_number(int(ipaddress.ip_address(v)), 1 << 16, 1 << 16, "ip")))
    if kind == "date":
        layout = "%Y-%m-%d" if "-" in v else "%d.%m.%Y" if "." in v else "%m/%d/%Y"
        first = dt.date(1900, 1, 1)
        day = (dt.datetime.strptime(v, layout).date() - first).days
        return (first + dt.timedelta(plain_number(day, 229, 319, "date"))).strftime(layout)
    if kind == "ssn":
        areas = [a for a in range(1, 900) if a != 666]
        area, group, serial = map(int, v.split("-"))
        place, serial = divmod(plain_number((areas.index(area) * 99 + group - 1) * 9999 + serial - 1, 898 * 99, 9999, "ssn"), 9999)
        return f"{areas[place // 99]:03}-{place % 99 + 1:02}-{serial + 1:04}"
    digits = re.sub("[^0-9]", "", v)
    if kind == "phone":
        return fill(v, digits[:-10] + plain_text(digits[-10:], "phone"), "[0-9]")
    body = digits[0] + plain_text(digits[1:-1], "card")
    return fill(v, body + next(c for c in "0123456789" if luhn(body + c)), "[0-9]")


VALID = {
    "email": ["anna.72@mail3.example.com", "x@y.org", "A-b_c+d%e.1@sub.host-name.io"],
    "iban": ["DE89370400440532013000", "GB82 WEST 1234 5698 7654 32", "FR1420041010050500013M02606"],
    "ip": ["169.122.221.182", "0.0.0.0", "255.255.255.255", "10.0.0.1"],
    "date": ["2024-02-29", "1900-01-01", "2099-12-31", "31.12.1999", "02/29/2000"],
    "ssn": ["123-45-6789", "899-99-9999", "001-01-0001", "667-10-0001"],
    "phone": ["+1 (988) 555-2485", "555-123-4567", "(017) 555-7713", "+49 170.555.1234"],
    "card": ["4111111111111111", "4111 1111 1111 1111", "5500-0000-0000-0004", "378282246310005", "6011000990139424"],
}
INVALID = [
    "4111111111111112", "256.1.1.1", "1.2.3.4.5", "2023-02-29", "32.01.2000", "13/13/2000", "666-12-3456", "000-12-3456", "123-00-4567", "1899-12-31",
    "DE89370400440532013001", "a@b", "@x.org", "12345", "v1.2.3", "01.2.3.4",
]


def test_valid_values_move_within_their_format(spark):
    rows = [(k, v) for k, values in VALID.items() for v in values]
    found = texts(spark, [f"see {v}, then." for _, v in rows])
    for (kind, value), r in zip(rows, found):
        got = re.fullmatch(r"see (.*), then\.", r["text"])[1]
        assert got != value and got == plain(kind, value), value
        assert r[f"n_{kind}"] == 1 and sum(r[f"n_{k}"] for k in VALID) == 1, value
        if kind == "card":
            assert luhn(got) and got[0] == value[0]
        if kind not in ("ip",):
            assert shape(got) == shape(value)
        if kind == "email":
            assert got.split("@")[1] == value.split("@")[1]
    # the pseudonyms are valid themselves
    again = texts(spark, [r["text"] for r in found], "another key")
    assert [[r[f"n_{k}"] for k in VALID] for r in again] == [[r[f"n_{k}"] for k in VALID] for r in found]


def test_invalid_values_stay(spark):
    found = texts(spark, [f"see {v} then" for v in INVALID])
    assert [r["text"] for r in found] == [f"see {v} then" for v in INVALID]


CARD, SPACED = "4111111111111111", "4111 1111 1111 1111"
NEIGHBOURS = [
    ("card", SPACED, "{} 12/26"), ("card", CARD, "{} 123"), ("card", "5500-0000-0000-0004", "{} 2024"), ("card", SPACED, "2 {} 12/26 ok"),
    ("card", SPACED, "in 12 34 {} 12 34 56"), ("card", "378282246310005", "7 {}-11"),
    ("iban", "ES91 2100 0418 4502 0005 1332", "{} BIC CAIXESBB"), ("iban", "ES91 2100 0418 4502 0005 1332", "{} 2024"),
    ("iban", "ES9121000418450200051332", "{} USD"), ("iban", "DE89 3704 0044 0532 0130 00", "{} BANK A"), ("iban", "NO93 8601 1117 947", "{} IN 2024"),
]


def test_neighbours_do_not_hide_a_value(spark):
    found = texts(spark, [frame.format(v) for _, v, frame in NEIGHBOURS])
    alone = texts(spark, [v for _, v, _ in NEIGHBOURS])
    for (kind, value, frame), r, one in zip(NEIGHBOURS, found, alone):
        assert one["text"] != value and r["text"] == frame.format(one["text"]), frame
        assert r[f"n_{kind}"] == 1
    date, both = texts(spark, [f"{SPACED} 12/26/2027", f"{SPACED} 12 5500 0000 0000 0004 34"])
    assert SPACED not in date["text"] and date["n_card"] == date["n_date"] == 1
    assert both["n_card"] == 2 and SPACED not in both["text"] and "5500 0000 0000 0004" not in both["text"]


def test_equal_values_stay_linked_and_keys_matter(spark):
    a, b, c = texts(spark, ["4111111111111111", "x 4111 1111 1111 1111 y 4111-1111-1111-1111", "5500000000000004"])
    digits = lambda t: re.sub("[^0-9]", "", t)
    assert digits(b["text"]) == digits(a["text"]) * 2 and digits(c["text"]) != digits(a["text"])
    assert texts(spark, ["4111111111111111"], "other")[0]["text"] != a["text"]


@pytest.mark.parametrize("rows,columns", [(229, 319), (7, 30), (1, 50), (40, 3)])
def test_numbers_are_permuted(spark, rows, columns):
    moved = pseudonyms.permuted_number(F.col("id"), rows, columns, F.col("key"), "t")
    ids = spark.range(min(rows * columns, 3000)).withColumn("key", pseudonyms.secret(spark, KEY))
    out = [r[0] for r in ids.select(moved).collect()]
    assert out[:50] == [plain_number(i, rows, columns, "t") for i in range(len(out))][:50]
    assert len(set(out)) == len(out) and min(out) >= 0 and max(out) < rows * columns


@pytest.mark.parametrize("width", [1, 2, 3])
def test_texts_are_permuted(spark, width):
    text = F.lpad(F.col("id").cast("string"), width, "0")
    ids = spark.range(10**width).withColumn("key", pseudonyms.secret(spark, KEY))
    out = [r[0] for r in ids.select(pseudonyms.permuted_text(text, F.col("key"), "t")).collect()]
    assert out[:50] == [plain_text(str(i).zfill(width), "t") for i in range(min(50, len(out)))]
    assert sorted(out) == [str(i).zfill(width) for i in range(10**width)]


def test_odd_rows_and_tables(spark):
    docs = documents(spark).withColumn("n_card", F.lit("clash"))
    found = pseudonyms.pseudonymised(docs, KEY)
    assert ordered(found.select(docs.drop("n_card").columns).collect()) == ordered(docs.drop("n_card").collect())
    assert pseudonymised(documents(spark, [])) == []


def test_whole_table(spark, small):
    docs = spark.read.parquet(f"{small}/documents.parquet")
    found = {r["doc_id"]: r for r in pseudonymised(docs)}
    email, phone = re.compile(r"[a-z]+\.\d\d@mail\d\.example\.com"), re.compile(r"\+1 \(\d{3}\) 555-\d{4}")
    hits = 0
    for r in docs.collect():
        got = found[r["doc_id"]]
        for pattern in (email, phone):
            for value in pattern.findall(r["text"]):
                hits += 1
                assert value not in got["text"]
        if not any(got[f"n_{k}"] for k in VALID):
            assert got["text"] == r["text"]
    assert hits > 0


def test_no_text_ends_a_job_or_takes_the_square_of_its_length(spark):
    """Labels, dots, digits, blanks and marks, 100,000 of them each, beside every format."""
    many = 100_000
    runs = ["b." * many, "." * many, "-" * many, "7" * many, "7 " * many, "A" * many, "AB12 " * many, " " * many, "a@" * many, "1." * many, "+1 (" * many, "é" * many]
    texts_of = [f"a@{r}com" for r in runs] + runs + [f"{v} {runs[k % len(runs)]}" for k, v in enumerate(VALID["card"] + VALID["iban"] + VALID["phone"])]
    found = texts(spark, texts_of)
    assert found[0]["n_email"] == 1 and found[0]["text"] == plain("email", texts_of[0])
    assert len(found) == len(texts_of)


def test_time_of_many_values_in_one_text(spark):
    def seconds(count):
        cards = [f"4{i:014}" for i in range(count)]
        begin = time.time()
        (row,) = texts(spark, [" pay ".join(c + next(d for d in "0123456789" if luhn(c + d)) for c in cards)])
        assert row["n_card"] == count
        return time.time() - begin

    seconds(10)
    fixed = seconds(10)
    assert seconds(2000) - fixed < 20


def test_the_key_is_in_no_plan(spark):
    found = pseudonyms.pseudonymised(documents(spark), "a-very-secret-key")
    found.collect()
    shown = found._jdf.queryExecution().toString() + found._jdf.queryExecution().optimizedPlan().toJSON()
    assert "a-very-secret-key" not in shown and bytes(b ^ 0x36 for b in b"a-very-secret-key").hex() not in shown.lower()

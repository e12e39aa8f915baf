import random
import re
import time

import pytest

from llm_frames import ordered
from tourlytics.llm import quotes


def norm(text):
    return re.sub(r"\s+", " ", text.lower()).strip(" ")


def parse(text):
    runs = []
    for line in re.split(r"\r?\n", text or "") if text is not None else []:
        prefix = (re.match(r"[ \t]*>[> \t]*", line) or [""])[0]
        level, said = prefix.count(">"), line[len(prefix):]
        if runs and runs[-1][0] == level:
            runs[-1][1].append(said)
        else:
            runs.append((level, [said]))
    return [(level, "\n".join(said)) for level, said in runs]


def brute(rows):
    """(conv, turn, role, text, reply_to, root, depth, quoted, linked) by the definition."""
    own = lambda text: "\n".join(s for level, s in parse(text) if level == 0).strip()
    first, links = {}, {}
    for conv, turn, _, text in rows:
        if conv is not None and turn is not None:
            said = own(text)
            for unit in {norm(u) for u in [said, *re.split(r"\n[ \t]*\n", said), *said.split("\n")]} - {""}:
                first[conv, unit] = min(turn, first.get((conv, unit), turn))
    for conv, turn, _, text in rows:
        if conv is None or turn is None:
            continue
        for level, said in parse(text):
            if level and norm(said):
                original = first.get((conv, norm(said)), turn)
                units = [norm(said)]
                if original >= turn and "\n" in said:
                    units = {norm(u) for u in said.split("\n")} - {""}
                for unit in units:
                    original = first.get((conv, unit), turn)
                    links[conv, turn, level, unit] = original if original < turn else None
    reply = {}
    for pick in ((lambda level: True), (lambda level: level == 1)):
        best = {}
        for (conv, turn, level, _), original in links.items():
            if original is not None and pick(level):
                best[conv, turn] = max(original, best.get((conv, turn), original))
        reply |= best
    for conv, turn, role, text in rows:
        root, depth = turn, 0
        while (conv, root) in reply:
            root, depth = reply[conv, root], depth + 1
        mine = [o for (c, t, _, _), o in links.items() if (c, t) == (conv, turn)]
        yield conv, turn, role, None if text is None else own(text), reply.get((conv, turn)), root, depth, len(mine), len([o for o in mine if o is not None])


def frame(spark, rows):
    return spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")


def check(spark, rows):
    found = [tuple(r) for r in quotes.conversations(frame(spark, rows).repartition(4)).collect()]
    assert ordered(found) == ordered(brute(rows))
    keys = [[(v is not None, v or 0) for v in (r[0], r[5], r[1])] for r in found]
    assert keys == sorted(keys)
    return found


def test_nested_quotes(spark):
    rows = [
        (1, 0, "a", "Hello there\n\nHow are you?"),
        (1, 1, "b", "> Hello  THERE\nHi!\n> How are you?\nFine."),
        (1, 2, "a", ">> Hello there\n> Hi!\n\nGood"),
        (1, 3, "b", "> > Hello there\n>> How are you?\nagain"),
        (1, 4, "c", "> nobody said this\n> Fine.\r\nok"),
        (1, 5, "c", "> ok\n>\n>   \nlast > not a quote"),
        (1, 6, "c", ">"),
        (2, 0, "a", "> Hello there"),
        (2, 1, "a", "Hello there"),
        (2, 2, "a", "> Hello there"),
        (2, 2, "a", "> Hello there"),
        (2, 3, None, None), (2, 4, "x", ""), (None, 1, "x", "> Hello there\nno conversation"), (2, None, "x", "> Hello there\nno turn"),
        (3, 0, "x", "\x00\x01> odd"), (3, 1, "x", ">" * 5000 + " deep"), (3, 2, "x", "> a\n" * 3000 + "long"), (4, 7, "x", "🎉\n> 🎉"), (4, 8, "x", ">🎉"),
    ]
    found = {(r[0], r[1], r[3]): r for r in check(spark, [r for r in rows if r[0] != 3])}
    assert found[1, 2, "Good"][4:7] == (1, 0, 2)
    assert len(quotes.conversations(frame(spark, rows)).collect()) == len(rows)


@pytest.mark.parametrize("seed", range(3))
def test_random_conversations(spark, seed):
    rng = random.Random(seed)
    lines = [f"line {i} says {'so' * (i % 3)}" for i in range(14)]
    rows = []
    for conv in range(4):
        for turn in range(rng.choice([0, 5, 40])):
            text = "\n".join(rng.choice(["", "", "> ", ">> ", " >", "> > >"]) + rng.choice(["", *lines]) for _ in range(rng.randint(0, 6)))
            rows.append((conv, turn, "r", text))
    check(spark, rows)


def test_a_long_chain_is_one_thread(spark):
    rows = [(1, 0, "a", "said 0")] + [(1, t, "a", f"> said {t - 1}\nsaid {t}") for t in range(1, 70)]
    found = check(spark, rows)
    assert {(r[5], r[6] - r[1]) for r in found} == {(0, 0)}


def test_no_messages_and_clashing_columns(spark):
    assert quotes.conversations(frame(spark, [])).collect() == []
    clash = frame(spark, [(1, 0, "a", "x"), (1, 1, "b", "> x\ny")]).selectExpr("*", "'z' passages", "5 depth", "6 said", "7 level", "'h' hash", "9 lines_")
    out = quotes.conversations(clash)
    assert [r["depth"] for r in out.collect()] == [0, 1] and {r["passages"] for r in out.collect()} == {"z"}


def test_time_follows_a_run_of_blanks(spark):
    def seconds(blanks):
        talk = [(1, 0, "a", "word" + " " * blanks + "more" + " \t" * blanks), (1, 1, "b", "> word" + " " * blanks + "more\nyes" + "\n" * blanks + "x")]
        df = spark.createDataFrame(talk, "conv_id long, turn long, role string, text string")
        begin = time.time()
        rows = quotes.conversations(df).collect()
        assert rows[1]["reply_to"] == 0 and rows[0]["text"].endswith("more") and rows[1]["text"].startswith("yes")
        return time.time() - begin

    seconds(10)
    short, long = seconds(10_000), seconds(80_000)
    assert long < 16 * max(short, 1.0)

"""Places of pattern matches in texts, with DataFrame functions only.

All of it takes time in proportion to a text and to its matches, but for a factor that is the logarithm of
their number: places come from running sums by doubling, and pieces are cut from chunks of the text.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F

EMPTY = "array<struct<s:int,e:int,m:string>>"
CHUNK = 1000  # characters; a piece of a text is cut from the chunks that hold it


def let(value: Column, use: Callable[[Column], Column]) -> Column:
    """``use`` of a value that is worked out once."""
    return F.get(F.transform(F.array(value), use), F.lit(0))


def running(values: Column, join: Callable[[Column, Column], Column]) -> Column:
    """Each element joined with all before it, by doubling the reach: ``join`` is a sum or a maximum."""
    rounds = F.sequence(F.lit(0), F.ceil(F.log2(F.size(values) + 1)).cast("int"))

    def further(acc: Column, r: Column) -> Column:
        reach = F.call_function("shiftleft", F.lit(1), r)
        return F.transform(acc, lambda x, i: F.when(i >= reach, join(x, F.get(acc, i - reach))).otherwise(x))

    return F.aggregate(rounds, values, further)


def matches(text: Column, pattern: str) -> Column:
    """Leftmost non-overlapping matches as structs: s and e in code points (end exclusive), m the match.

    The text between two matches gives the distance from one to the next. Null texts have no matches;
    the pattern must not match an empty string.
    """

    def placed(found: Column) -> Column:
        gaps = F.split(text, pattern, -1)  # one more than there are matches
        steps = F.zip_with(F.slice(gaps, 1, F.size(found)), found, lambda gap, m: F.length(gap) + F.length(m))
        ends = running(steps, lambda a, b: a + b)
        return F.zip_with(found, ends, lambda m, e: F.struct((e - F.length(m)).alias("s"), e.alias("e"), m.alias("m")))

    walked = let(F.regexp_extract_all(text, F.lit(pattern), F.lit(0)), placed)
    return F.when(text.rlike(pattern), walked).otherwise(F.array().cast(EMPTY))


def merged(spans: Column) -> Column:
    """Spans (structs s, e, any order) as disjoint ones, ascending; overlapping ones become one."""
    plain = F.array_sort(F.transform(spans, lambda x: F.struct(x["s"].alias("s"), x["e"].alias("e"))))

    def joined(ordered: Column) -> Column:
        return let(running(F.transform(ordered, lambda x: x["e"]), F.greatest), lambda reach: apart(ordered, reach))

    def apart(ordered: Column, reach: Column) -> Column:
        places = F.sequence(F.lit(0), F.size(ordered) - 1)
        first = F.filter(places, lambda i: (i == 0) | (F.get(ordered, i)["s"] >= F.get(reach, i - 1)))
        last = lambda firsts, k: F.coalesce(F.get(firsts, k + 1), F.size(ordered)) - 1
        return let(
            first,
            lambda firsts: F.transform(
                firsts, lambda i, k: F.struct(F.get(ordered, i)["s"].alias("s"), F.get(reach, last(firsts, k)).alias("e"))
            ),
        )

    return F.when(F.size(spans) > 0, let(plain, joined)).otherwise(F.array().cast("array<struct<s:int,e:int>>"))


def _piece(chunks: Column, begin: Column, end: Column) -> Column:
    first = F.call_function("div", begin, F.lit(CHUNK)).cast("int")
    count = F.call_function("div", end, F.lit(CHUNK)).cast("int") - first + 1
    held = F.array_join(F.slice(chunks, first + 1, count), "")
    return F.when(end > begin, F.substring(held, begin - first * CHUNK + 1, end - begin)).otherwise("")


def replaced(text: Column, spans: Column, by: Callable[[Column], Column]) -> Column:
    """The text with each span (structs s, e; may overlap, any order) replaced by ``by`` of its length; unchanged
    without spans. Spans that overlap are replaced as one."""
    chunks = F.regexp_extract_all(text, F.lit(f"(?s).{{1,{CHUNK}}}"), F.lit(0))

    def rebuilt(parts: Column, found: Column) -> Column:
        before = lambda k: F.when(k > 0, F.get(found, k - 1)["e"]).otherwise(F.lit(0))
        pieces = F.transform(found, lambda x, k: F.concat(_piece(parts, before(k), x["s"]), by(x["e"] - x["s"])))
        tail = _piece(parts, F.element_at(found, -1)["e"], F.length(text))
        return F.concat(F.array_join(pieces, ""), tail)

    built = let(chunks, lambda parts: let(merged(spans), lambda found: rebuilt(parts, found)))
    return F.when(F.size(spans) > 0, built).otherwise(text)

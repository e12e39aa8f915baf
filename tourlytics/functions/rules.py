"""Small builders for rule columns, so a classifier is a table of values plus one expression."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column
from pyspark.sql import functions as F


def first_of(rules: Iterable[tuple[Column, object]], otherwise: object) -> Column:
    """Value of the first rule whose condition is true; NULL conditions do not match."""
    chain = None
    for condition, value in rules:
        value = value if isinstance(value, Column) else F.lit(value)
        chain = F.when(condition, value) if chain is None else chain.when(condition, value)
    return chain.otherwise(otherwise if isinstance(otherwise, Column) else F.lit(otherwise))


def at_least(value: Column, steps: Iterable[tuple[float, object]], otherwise: object) -> Column:
    """Descending lower bounds: label of the first bound the value reaches."""
    return first_of([(value >= bound, label) for bound, label in steps], otherwise)


def below(value: Column, steps: Iterable[tuple[float, object]], otherwise: object) -> Column:
    """Ascending upper bounds: label of the first bound the value stays under."""
    return first_of([(value < bound, label) for bound, label in steps], otherwise)


def has_any(text: Column, words: Iterable[str]) -> Column:
    found = None
    for word in words:
        found = text.contains(word) if found is None else found | text.contains(word)
    return found


def percent(part: Column, whole: Column) -> Column:
    """``100 * part / whole`` as a double; NULL when the whole is zero."""
    return F.try_divide(part.cast("double") * 100.0, whole.cast("double"))


def count_if(condition: Column) -> Column:
    return F.count(F.when(condition, 1))

"""Small tables with the odd rows that every operator must take."""

from __future__ import annotations

LONG = "lorem ipsum dolor sit amet " * 4000

TEXTS = [
    (0, "The quick brown fox jumps over the lazy dog near the old river bank today", "en", "a", 10),
    (1, "the quick brown fox jumps over the lazy dog near the old river bank today", "en", "a", 10),
    (2, None, None, None, None),
    (3, "", "en", "b", 0),
    (4, " \t\n ", None, "b", 3),
    (5, "one two", "en", None, 7),
    (6, "one two", "en", None, 7),
    (7, LONG, "la", "c", len(LONG)),
    (8, "Größe straße ñandú été – naïve 漢字 🎉 fin", "de", "c", 5),
    (9, "a b c d e f g h i j k l m n o p q r s t u v w x y z " * 3, "en", "c", 5),
    (9, "a b c d e f g h i j k l m n o p q r s t u v w x y z " * 3, "en", "c", 5),
    (None, "a row without an id has words of its own here", "en", "c", 5),
]


def documents(spark, rows=None):
    """Documents with a further column whose name clashes with those that operators add."""
    frame = spark.createDataFrame(TEXTS if rows is None else rows, "doc_id long, text string, lang string, source string, n_chars long")
    extra = "cast(doc_id as string) bucket, 1 block, 'x' component, 2 n_words, 3 items, 4 spans, 5 fp, 6 piece, 7 length, 8 score"
    return frame.selectExpr("*", *extra.split(", ")).repartition(3)


def key(row):
    return tuple((v is not None, str(v)) for v in row)


def ordered(rows):
    return sorted(map(tuple, rows), key=key)

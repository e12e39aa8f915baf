"""Result form of the registered queries: plain scalar columns that any engine prints alike."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


def plain(df: DataFrame, drop: tuple[str, ...] = ()) -> DataFrame:
    """Times and dates as text, whole numbers as bigint, doubles to 8 places, arrays joined.

    The viewer direction becomes three columns.
    """
    out = []
    for field in df.schema.fields:
        name, kind, column = field.name, field.dataType, F.col(f"`{field.name}`")
        if name in drop:
            continue
        if isinstance(kind, T.StructType):
            out += [column[f.name].alias(f.name) for f in kind.fields]
        elif isinstance(kind, (T.TimestampType, T.TimestampNTZType)):
            out.append(F.date_format(column, "yyyy-MM-dd HH:mm:ss.SSSSSS").alias(name))
        elif isinstance(kind, T.DateType):
            out.append(F.date_format(column, "yyyy-MM-dd").alias(name))
        elif isinstance(kind, (T.IntegerType, T.ShortType)):
            out.append(column.cast("bigint").alias(name))
        elif isinstance(kind, (T.DoubleType, T.FloatType)):
            out.append(F.round(column, 8).alias(name))
        elif isinstance(kind, T.ArrayType) and isinstance(kind.elementType, T.StringType):
            out.append(F.array_join(F.array_sort(column), ",").alias(name))
        else:
            out.append(column)
    return df.select(*out)

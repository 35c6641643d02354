"""Rows as lines of JSON, for loaders that take text.

One object per row with every column of the frame in its order, nulls included. Decimals and
instants become text, so that no reader can round them: decimals in plain digits without
needless zeros, instants in UTC with microseconds only where there are any. Dates become
ISO text; text, integers and truth values stay what they are.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Types that JSON holds as they are.
_PLAIN = (T.StringType, T.BooleanType, T.ByteType, T.ShortType, T.IntegerType, T.LongType)


def decimal_text(value: Column, scale: int) -> Column:
    """Plain digits of a decimal in an ANSI session; no zeros end a fraction."""
    digits = value.cast("string")
    return F.regexp_replace(digits, r"\.?0+$", "") if scale else digits


def instant_text(value: Column) -> Column:
    """ISO text of an instant in a UTC session, such as ``2026-01-31T05:00:00+00:00``."""
    fraction = F.when(F.unix_micros(value) % 1_000_000 == 0, "").otherwise(
        F.date_format(value, ".SSSSSS")
    )
    return F.concat(F.date_format(value, "yyyy-MM-dd'T'HH:mm:ss"), fraction, F.lit("+00:00"))


def _json_value(field: T.StructField) -> Column:
    kind, value = field.dataType, F.col(f"`{field.name}`")
    if isinstance(kind, T.DecimalType):
        return decimal_text(value, kind.scale)
    if isinstance(kind, T.TimestampType):
        return instant_text(value)
    if isinstance(kind, T.DateType):
        return F.date_format(value, "yyyy-MM-dd")
    if isinstance(kind, _PLAIN):
        return value
    raise TypeError(f"{field.name}: {kind.simpleString()} has no exact form in JSON")


def encoded(rows: DataFrame) -> DataFrame:
    """``line``: one JSON object per row. A type that JSON cannot hold exactly is refused."""
    fields = [_json_value(f).alias(f.name) for f in rows.schema.fields]
    return rows.select(F.to_json(F.struct(*fields), {"ignoreNullFields": "false"}).alias("line"))


def write_rows(rows: DataFrame, path: str) -> None:
    """Text files of lines. JSON escapes line breaks, so a line is a row."""
    encoded(rows).write.text(path)

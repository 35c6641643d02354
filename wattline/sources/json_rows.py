"""Reading rows from lines of JSON, strictly.

The counterpart of ``sinks.json_rows``. A line is taken only if it is one object with exactly
the columns of the schema, in any order, whose values have the type of their column and fit it
without being rounded. Every other line is returned with its errors, none is dropped.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from wattline.functions import text

# How numbers and dates are written.
_INTEGER = r"^-?(0|[1-9][0-9]*)$"
_DECIMAL = r"^-?[0-9]+(\.[0-9]+)?$"
_DATE = r"^[0-9]{4}-[0-9]{2}-[0-9]{2}$"


def _read(kind: T.DataType, value: Column) -> Column:
    """The typed value, from its text; null where that is none."""
    if isinstance(kind, T.DecimalType):
        wide = value.try_cast(T.DecimalType(38, kind.scale))
        decimals = F.length(F.regexp_extract(value, r"\.([0-9]*?)0*$", 1))
        exact = value.rlike(_DECIMAL) & (decimals <= kind.scale)
        return F.when(exact, wide.try_cast(kind))
    if isinstance(kind, T.TimestampType):
        fraction = F.regexp_extract(value, r"[.,]([0-9]*?)0*(?:Z|[+-][0-9:]*)$", 1)
        return F.when(F.length(fraction) <= 6, text.offset_timestamp(value))
    if isinstance(kind, T.DateType):
        return F.when(value.rlike(_DATE), value.try_cast(kind))
    if isinstance(kind, T.StringType):
        return value
    if isinstance(kind, T.BooleanType):
        return F.when(value.isin("true", "false"), value == "true")
    if isinstance(kind, T.IntegralType):
        return F.when(value.rlike(_INTEGER), value.try_cast(kind))
    raise TypeError(f"{kind.simpleString()} has no exact form in JSON")


def _quoted(kind: T.DataType) -> bool:
    return not isinstance(kind, (T.IntegralType, T.BooleanType))


def decoded(lines: DataFrame, schema: T.StructType, line: str = "line") -> DataFrame:
    """The columns of ``schema``, then ``line`` and ``errors``; errors are empty for good lines.

    Columns of a line with errors hold what could be read. Blank lines and null have errors as
    well, and so has a line that repeats a key.
    """
    parsed = F.try_parse_json(F.col(line))
    whole = F.col("_line")
    # A parser stops after the first value; in both brackets only a lone value is one.
    in_array = F.json_array_length(F.concat(F.lit("["), whole, F.lit("]")))
    in_object = F.size(F.json_object_keys(F.concat(F.lit('{"r":'), whole, F.lit("}"))))
    lone = (in_array == 1) & (in_object == 1) & F.schema_of_variant("_parsed").startswith("OBJECT")
    names = F.json_object_keys(whole)
    expected = F.array(*[F.lit(f.name) for f in schema.fields])

    # Every value is looked up, read and judged once, one step below the other: written as one
    # expression each use would do all of it again.
    numbered = list(enumerate(schema.fields))

    def checked(n: int, field: T.StructField) -> Column:
        # VOID: null in the line. Null: no such key, reported with the keys.
        found, typed = F.col(f"_kind{n}"), F.col(f"_typed{n}")
        wanted = "STRING" if _quoted(field.dataType) else (
            "BOOLEAN" if isinstance(field.dataType, T.BooleanType) else "BIGINT"
        )
        missing = F.lit(False) if field.nullable else found == "VOID"
        bad = (found != "VOID") & ((found != wanted) | typed.isNull())
        return F.when(missing | bad, F.lit(f"{field.name}: missing or invalid"))

    def looked_up(n: int, field: T.StructField) -> list[Column]:
        path = _path(field.name)
        kind = F.schema_of_variant(F.try_variant_get(F.col("_parsed"), path, "variant"))
        value = F.try_variant_get(F.col("_parsed"), path, "string")
        return [value.alias(f"_value{n}"), kind.alias(f"_kind{n}")]

    keyed = (
        lines.select(F.col(line).alias("_line"), parsed.alias("_parsed"))
        .select("_line", "_parsed", F.when(lone, names).alias("_names"))
        .select("_line", "_names", *[c for n, f in numbered for c in looked_up(n, f)])
        .select(
            "_line", "_names", *[f"_kind{n}" for n, _ in numbered],
            *[_read(f.dataType, F.col(f"_value{n}")).alias(f"_typed{n}") for n, f in numbered],
        )
    )
    extra = F.transform(
        F.array_except("_names", expected), lambda n: F.concat(n, F.lit(": unknown column"))
    )
    lacking = F.transform(
        F.array_except(expected, F.col("_names")), lambda n: F.concat(n, F.lit(": no such key"))
    )
    every = F.concat(extra, lacking, F.array(*[checked(n, f) for n, f in numbered]))
    errors = F.when(F.col("_names").isNull(), F.array(F.lit("line: not one JSON object"))).otherwise(
        F.filter(every, lambda e: e.isNotNull())
    )
    # Exploding one value is a fence: a filter on errors would otherwise repeat all below it.
    return keyed.select(
        *[F.col(f"_typed{n}").alias(f.name) for n, f in numbered],
        F.col("_line").alias(line), F.explode(F.array(errors)).alias("errors"),
    )


def _path(name: str) -> str:
    """Path of a key; names that no path can hold are refused."""
    quote = '"' if "'" in name else "'"
    if not name or "?" in name or quote in name:
        raise ValueError(f"{name}: a column of this name cannot be looked up in JSON")
    return f"$[{quote}{name}{quote}]"


def accepted(decoded_lines: DataFrame, schema: T.StructType) -> DataFrame:
    """Rows of the lines without errors."""
    return decoded_lines.where(F.size("errors") == 0).select(
        *[F.col(f"`{name}`") for name in schema.fieldNames()]
    )


def read_rows(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """``decoded`` for all lines of the text files below ``path``."""
    return decoded(spark.read.text(path).select(F.col("value").alias("line")), schema)

"""Rows written as JSON lines, and lines read back strictly."""

import json
from datetime import date, datetime, timezone
from decimal import Decimal

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from wattline.sinks import json_rows as sink
from wattline.sources import json_rows as source

SCHEMA = T.StructType([
    T.StructField("text", T.StringType(), False),
    T.StructField("number", T.LongType()),
    T.StructField("amount", T.DecimalType(38, 9)),
    T.StructField("whole", T.DecimalType(5, 0)),
    T.StructField("at", T.TimestampType()),
    T.StructField("day", T.DateType()),
    T.StructField("true", T.BooleanType()),
    T.StructField("a.b 'c\\", T.StringType()),
])
ROWS = [
    ("", 2**63 - 1, Decimal("0.000000001"), Decimal(100), datetime(2026, 1, 31, 5), date(2024, 2, 29), True, "q"),
    ('a"\\/\n\r \u0001é😀', -1, Decimal("-100.50"), Decimal(0), datetime(1, 1, 1, 0, 0, 0, 120), None, False, None),
    ("null", None, Decimal(0), None, None, None, None, ""),
    ("x", 0, Decimal("12345678901234567890123456789.123456789"), Decimal(-7),
     datetime(9999, 12, 31, 23, 59, 59, 999999), date(1, 1, 1), True, "{}"),
]


def frame(spark):
    utc = [tuple(v.replace(tzinfo=timezone.utc) if isinstance(v, datetime) else v for v in row) for row in ROWS]
    return spark.createDataFrame(utc, SCHEMA)


def plain(value):
    """What a line is defined to hold for a value."""
    if isinstance(value, datetime):
        return value.replace(tzinfo=timezone.utc).isoformat()
    if isinstance(value, date):
        return value.isoformat()
    if isinstance(value, Decimal):
        digits = f"{value:f}"
        return digits.rstrip("0").rstrip(".") if "." in digits else digits
    return value


def test_lines(spark):
    lines = [r.line for r in sink.encoded(frame(spark)).collect()]
    assert not any("\n" in line for line in lines)
    assert [list(json.loads(line).items()) for line in lines] == [
        list(zip(SCHEMA.fieldNames(), map(plain, row))) for row in ROWS
    ]


def test_round_trip(spark, tmp_path):
    sink.write_rows(frame(spark), str(tmp_path / "rows"))
    read = source.read_rows(spark, str(tmp_path / "rows"), SCHEMA)
    good = source.accepted(read, SCHEMA)
    assert good.count() == read.count() == len(ROWS)
    assert good.exceptAll(frame(spark)).isEmpty() and frame(spark).exceptAll(good).isEmpty()


def test_tables_without_rows_and_clashing_names(spark):
    none = sink.encoded(frame(spark).limit(0))
    assert none.isEmpty() and source.decoded(none, SCHEMA).isEmpty()
    names = T.StructType([T.StructField(n, T.StringType()) for n in ("_line", "_parsed", "_names")])
    rows = spark.createDataFrame([("1", None, "3")], names)
    assert source.accepted(source.decoded(sink.encoded(rows), names), names).collect() == rows.collect()


def test_strictness(spark):
    schema = T.StructType([
        T.StructField("s", T.StringType(), False), T.StructField("n", T.IntegerType()),
        T.StructField("d", T.DecimalType(4, 2)), T.StructField("t", T.TimestampType()),
    ])
    whole, bad = ["line: not one JSON object"], lambda name: [f"{name}: missing or invalid"]

    def line(**given):
        return json.dumps({"s": "x", "n": 1, "d": "1.5", "t": "2026-01-01T00:00:00Z"} | given)

    one = line()
    cases = {
        one: [], line(d="-99.990000"): [], line(n=None, d=None, t=None): [],
        line(t="2026-01-01T02:00:00.123456000+02:00"): [], f"  {one}\t": [],
        "{" + ",".join(reversed(one[1:-1].split(", "))) + "}": [],
        None: whole, "": whole, "null": whole, "[1]": whole, "x": whole, one[:-1]: whole,
        one + "x": whole, one + one: whole, f"{one},{one}": whole, f"{one}],[{one}": whole,
        one + "}": whole, f"[{one}]": whole, one[:-1] + ', "s": "y"}': whole,
        line(s=None): bad("s"), line(s=1): bad("s"), line(s={"a": "b"}): bad("s"),
        line(n="1"): bad("n"), line(n=1.5): bad("n"), line(n=2**31): bad("n"), line(n=2**70): bad("n"),
        line(n=True): bad("n"), line(d=1.5): bad("d"), line(d="1.501"): bad("d"), line(d="100"): bad("d"),
        line(d="1e1"): bad("d"), line(d=" 1"): bad("d"), line(t="2026-01-01T00:00:00"): bad("t"),
        line(t="2026-01-01T00:00:00.1234567Z"): bad("t"), line(t="2026-02-30T00:00:00Z"): bad("t"),
        line(z=1): ["z: unknown column"],
        '{"s": "x", "n": 1, "d": null}': ["t: no such key"],
    }
    lines = spark.createDataFrame([(i, c) for i, c in enumerate(cases)], "id int, line string")
    found = source.decoded(lines.coalesce(1).orderBy("id"), schema).collect()
    assert {r.line: r.errors for r in found} == cases
    assert len(found) == len(cases)


def test_types_without_exact_form(spark):
    with pytest.raises(TypeError, match="v: double"):
        sink.encoded(spark.createDataFrame([(1.5,)], "v double"))
    with pytest.raises(TypeError, match="double"):
        source.decoded(spark.createDataFrame([("{}",)], "line string"), T.StructType([T.StructField("v", T.DoubleType())]))


def test_values_are_looked_up_once(spark):
    """A filter on errors and several uses of a value must not repeat the lookups."""
    at, d = F.current_timestamp().alias("at"), F.col("id").cast("decimal(9,2)").alias("d")
    lines = sink.encoded(spark.range(3).select(at, d))
    schema = T.StructType([
        T.StructField("at", T.TimestampType()), T.StructField("d", T.DecimalType(9, 2))
    ])
    rows = source.accepted(source.decoded(lines, schema), schema)
    plan = rows._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("try_variant_get(") <= 2 * len(schema)
    assert rows.count() == 3

from datetime import datetime

import pytest
from pyspark.sql import functions as F

from wattline.functions import measures, text
from wattline.schemas import DATASETS, REQUIRED_COLUMNS
from wattline.sources import manifest, zones


def each(spark, column, values, kind="string"):
    frame = spark.createDataFrame(list(enumerate(values)), f"i int, v {kind}")
    return [r.x for r in frame.select("i", column.alias("x")).orderBy("i").collect()]


def one(spark, column, value, kind="string"):
    return each(spark, column, [value], kind)[0]


DURATIONS = [
    ("PT15M", 900), ("PT1H", 3600), ("PT1H30M", 5400), ("PT90S", 90), ("PT0M", 0), ("PT", 0),
    ("PT9223372036854775807H", None), ("PT99999999999999999999S", None),
    ("P1D", 0), ("15M", 0), ("PT1.5H", 0), ("", 0),
]


def test_duration(spark):
    got = each(spark, text.duration_seconds(F.col("v")), [v for v, _ in DURATIONS])
    assert got == [s for _, s in DURATIONS]


TIMESTAMPS = [
    ("2026-08-20T00:00Z", datetime(2026, 8, 20)),
    ("2026-08-22T08:27:52Z", datetime(2026, 8, 22, 8, 27, 52)),
    ("2026-08-20T02:00+02:00", datetime(2026, 8, 20)),
    ("2026-08-20T02:00:00+0200", datetime(2026, 8, 20)),
    ("2026-08-20 00:00:00.250Z", datetime(2026, 8, 20, 0, 0, 0, 250000)),
    ("2026-08-20T00:00+02", datetime(2026, 8, 19, 22)), ("20260820T0130Z", datetime(2026, 8, 20, 1, 30)),
    ("2026-08-20T07+00:00", datetime(2026, 8, 20, 7)),
    ("2026-08-20T00:00-01:00:30", datetime(2026, 8, 20, 1, 0, 30)),
    ("2026-08-20T00:00+25:00", None), ("2026-08-20T24:61Z", None),
    ("2026-08-20T00:00", None), ("2026-08-20", None), ("2026-13-20T00:00Z", None),
    ("20 Aug 2026", None), ("", None), (None, None),
]


def test_offset_timestamp(spark):
    column = text.offset_timestamp(F.col("v")).cast("timestamp_ntz")
    assert each(spark, column, [v for v, _ in TIMESTAMPS]) == [t for _, t in TIMESTAMPS]


INTEGERS = [
    ("1", 1), ("+5", 5), (" 7", 7), ("1.0", None), ("x", None), ("", None),
    ("99999999999999999999", None),
]


def test_integer(spark):
    assert each(spark, text.integer(F.col("v")), [v for v, _ in INTEGERS]) == [
        n for _, n in INTEGERS
    ]


NUMERICS = [
    ("38821.26", "38821.260000000"), ("-1e3", "-1000.000000000"),
    ("0.0000000005", "1E-9"), ("NaN", None), ("", None),
]


def test_numeric(spark):
    got = each(spark, text.numeric(F.col("v")), [v for v, _ in NUMERICS])
    assert [None if n is None else str(n) for n in got] == [n for _, n in NUMERICS]


INTERVALS = [
    ("PT15M", 15, 96), ("PT30M", 30, 48), ("PT60M", 60, 24), ("PT1H", 60, 24),
    ("PT7M", 7, 206), ("PT1H30M", None, None), ("PT90S", None, None), ("PT0M", 0, None),
    ("PT9223372036854775807H", None, None), ("PT99999999999999999999M", None, None),
]


def test_interval_minutes_and_expected_count(spark):
    interval = measures.interval_minutes(F.col("v"))
    values = [v for v, _, _ in INTERVALS]
    assert each(spark, interval, values) == [m for _, m, _ in INTERVALS]
    expected = measures.rounded_ratio(F.lit(measures.MINUTES_PER_DAY), interval)
    assert each(spark, expected, values) == [n for _, _, n in INTERVALS]


def test_rounding_is_half_away_from_zero(spark):
    ratio = measures.rounded_ratio(F.col("v"), F.lit(2))
    assert each(spark, ratio, [5, -5, 3, 4], "int") == [3, -3, 2, 2]


def test_load_id(spark):
    got = one(spark, text.load_id("actual_load", F.col("v")), "a/b.xml")
    import hashlib

    assert got == "raw_actual_load_" + hashlib.sha256(b"a/b.xml").hexdigest()[:24]


@pytest.mark.parametrize("start, end", [
    ("2024-12-31T23:30Z", "2025-01-01T00:30Z"),
    ("2024-12-31T19:30-04:00", "2024-12-31T20:30-04:00"),
])
def test_manifest_names_and_params_are_utc(spark, start, end):
    frame = manifest.parsed_intervals(
        spark.createDataFrame([(start, end)], "a string, b string"), "a", "b"
    )
    rows = manifest.request_manifest(frame).filter("bidding_zone = '10YES-REE------0'").collect()
    got = {r.dataset: r for r in rows}
    assert set(got) == set(DATASETS)
    for dataset, row in got.items():
        assert row.source_object_name == (
            f"entsoe/{dataset}/bidding_zone=10YES-REE------0/year=2024/month=12/day=31/"
            "20241231T2330Z_20250101T0030Z.xml"
        )
    bounds = {"periodStart": "202412312330", "periodEnd": "202501010030"}
    zone = "10YES-REE------0"
    assert got["actual_load"].params == {
        "documentType": "A65", "processType": "A16", "outBiddingZone_Domain": zone, **bounds}
    assert got["actual_generation"].params == {
        "documentType": "A75", "processType": "A16", "in_Domain": zone, **bounds}
    assert got["day_ahead_prices"].params == {
        "documentType": "A44", "contract_MarketAgreement.type": "A01", "out_Domain": zone,
        "in_Domain": zone, **bounds}


@pytest.mark.parametrize("start, end, problem", [
    ("2026-08-20T00:00Z", "2026-08-20T00:00Z", "b is not after a"),
    ("2026-08-20T01:00Z", "2026-08-20T02:00+02:00", "b is not after a"),
    ("2026-08-20T00:00", "2026-08-20T01:00Z", "a: not a timestamp with offset"),
    ("2026-08-20T00:00Z", "2026-08-20T01:00", "b: not a timestamp with offset"),
])
def test_bad_intervals_are_named_and_give_no_requests(spark, start, end, problem):
    frame = manifest.parsed_intervals(
        spark.createDataFrame([(start, end)], "a string, b string"), "a", "b"
    )
    assert frame.first().problem == problem
    assert manifest.request_manifest(frame).isEmpty()


def test_zone_dimension(spark):
    rows = zones.zones(spark).collect()
    assert len({r.eic_code for r in rows}) == len({r.name for r in rows}) == len(rows) == 10
    assert len({r.market for r in rows}) == 4


def test_daily_manifest_has_a_request_per_day_zone_and_dataset(spark):
    bounds = spark.sql("select date'2026-03-28' as f, date'2026-03-30' as l")
    requests = manifest.request_manifest(manifest.daily_intervals(bounds, "f", "l"))
    assert requests.count() == 3 * 10 * 3
    assert requests.select("source_object_name").distinct().count() == 90
    assert "Join" not in requests._jdf.queryExecution().executedPlan().toString()


def test_required_columns_are_counted():
    counts = {p: sum(len(c) for m, c in REQUIRED_COLUMNS.items() if m.startswith(p))
              for p in ("stg", "int", "fct", "agg")}
    assert counts["stg"] == 19 and counts["int"] == 36 and counts["fct"] + counts["agg"] == 78


def test_raw_schemas():
    shape = {n: [(f.name, f.dataType.simpleString(), f.nullable) for f in d.schema.fields]
             for n, d in DATASETS.items()}
    assert {n: len(f) for n, f in shape.items()} == {
        "actual_load": 18, "actual_generation": 20, "day_ahead_prices": 21}
    nullable = {n: [c for c, _, null in f if null] for n, f in shape.items()}
    assert nullable == {
        "actual_load": [],
        "actual_generation": ["in_bidding_zone", "out_bidding_zone"],
        "day_ahead_prices": ["classification_sequence_position"],
    }
    for fields in shape.values():
        kinds = {n: k for n, k, _ in fields}
        assert kinds["revision_number"] == kinds["position"] == "bigint"
        assert kinds.get("quantity", kinds.get("price_amount")) == "decimal(38,9)"
        assert kinds["point_timestamp"] == kinds["document_created_at"] == "timestamp"
    layouts = {n: (d.layout.day_column, d.layout.cluster_by) for n, d in DATASETS.items()}
    assert layouts == {
        "actual_load": ("point_date", ("out_bidding_zone",)),
        "actual_generation": ("point_date", ("in_bidding_zone", "out_bidding_zone", "psr_type")),
        "day_ahead_prices": ("point_date", ("in_domain", "out_domain")),
    }


def test_a_text_is_looked_up_once(spark):
    def plan(column):
        frame = spark.createDataFrame([("x",)], "x string").select(column)
        return frame._jdf.queryExecution().analyzed().toString()

    assert plan(text.offset_timestamp(F.upper("x")).alias("t")).count("upper(") == 1
    assert plan(text.duration_seconds(F.col("x")).alias("t")).count("regexp_extract(") == 3
    start = F.current_timestamp()
    assert plan(text.later(start, F.length("x"), F.lit(1)).alias("t")).count("length(") == 1

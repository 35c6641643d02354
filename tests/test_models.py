import random
from datetime import date, datetime, timedelta

import frames as f
import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from wattline.operators import checks, projections, versions
from wattline.plans import models, quality
from wattline.schemas import LOAD, PRICE_DUPLICATE_KEYS, PRICE_PAYLOAD, REQUIRED_COLUMNS


def branch_load(spark, rows, **common):
    return models.load_branch(f.load(spark, rows, **common))


def branch_prices(spark, rows, **common):
    return models.price_branch(f.prices(spark, rows, **common))


def one(df):
    rows = f.naive(df).collect()
    assert len(rows) == 1
    return rows[0]


CHAIN = [
    {"revision_number": 2, "document_created_at": f.DAY + timedelta(days=9)},
    {"revision_number": 10},
    {"revision_number": 10, "document_created_at": f.DAY + timedelta(hours=1)},
    {"revision_number": 10, "document_created_at": f.DAY + timedelta(hours=1),
     "source_object_name": "p"},
    {"revision_number": 10, "document_created_at": f.DAY + timedelta(hours=1),
     "source_object_name": "p", "document_mrid": "e"},
    {"revision_number": 10, "document_created_at": f.DAY + timedelta(hours=1),
     "source_object_name": "p", "document_mrid": "e", "time_series_mrid": "t"},
]


def test_version_order_step_by_step(spark):
    rows = [
        {**row, "quantity": i, "out_bidding_zone": f"Z{n}"}
        for n in range(1, len(CHAIN) + 1) for i, row in enumerate(CHAIN[:n])
    ]
    got = branch_load(spark, rows)["int_actual_load_canonical"].collect()
    assert {r.bidding_zone: int(r.load_quantity) for r in got} == {
        f"Z{n}": n - 1 for n in range(1, len(CHAIN) + 1)
    }


def test_rows_equal_in_the_order_still_give_one_stable_row(spark):
    for order in ((5, 7, 6), (7, 6, 5)):
        canonical = branch_load(spark, [{"quantity": q} for q in order])[
            "int_actual_load_canonical"]
        assert int(one(canonical).load_quantity) == 7


def test_text_revisions_compare_as_numbers(spark):
    rows = f.load(spark, [{"revision_number": 2}, {"revision_number": 10, "quantity": 9}])
    staged = projections.stage_load(rows.withColumn("revision_number", F.col(
        "revision_number").cast("string")))
    assert one(models.canonical_load(staged)).load_quantity == 9


def test_directions(spark):
    rows = [
        {"in_bidding_zone": "A", "out_bidding_zone": None},
        {"in_bidding_zone": None, "out_bidding_zone": "B"},
        {"in_bidding_zone": "A", "out_bidding_zone": "B"},
        {"in_bidding_zone": None, "out_bidding_zone": None},
    ]
    branch = models.generation_branch(f.generation(spark, rows))
    got = branch["int_actual_generation_normalized"].collect()
    assert [(r.bidding_zone, r.domain_direction) for r in got] == [
        ("A", "in"), ("B", "out"), ("A", "both"), (None, "none")]
    assert len(got[0]) == 22
    bad = branch["int_actual_generation_normalized"].filter(checks.not_single_zone())
    assert sorted(r.domain_direction for r in bad.collect()) == ["both", "none"]
    # Directions are part of the grain.
    assert branch["fct_generation_by_type"].count() == 4


def test_null_classification_is_its_own_group(spark):
    rows = [{"classification_sequence_position": c, "price_amount": i}
            for i, c in enumerate((None, 1, 2, None))]
    facts = branch_prices(spark, rows)["fct_day_ahead_prices"].collect()
    assert {r.classification_sequence_position for r in facts} == {None, 1, 2}
    assert len(facts) == 3


def test_duplicates_keep_the_lowest_series_and_versions_the_highest(spark):
    rows = [
        {"time_series_mrid": "s10", "price_amount": 1},
        {"time_series_mrid": "s2", "price_amount": 2},
        {"source_object_name": "a", "time_series_mrid": "s1", "price_amount": 3},
    ]
    branch = branch_prices(spark, rows)
    kept = branch["int_day_ahead_prices_deduplicated"].collect()
    # Ids sort as text: s10 comes before s2.
    assert sorted(r.time_series_id for r in kept) == ["s1", "s10"]
    assert one(branch["int_day_ahead_prices_canonical"]).time_series_id == "s10"


def test_rows_that_tie_on_all_else_are_picked_by_their_other_columns(spark):
    rows = [{"at": 1, "position": p} for p in (2, 5, 3)]
    frame = f.load(spark, rows)
    picks = {
        models.canonical_load(projections.stage_load(df)).first().position
        for df in (frame, frame.repartition(3), frame.orderBy("position"))
    }
    assert picks == {5}


def test_unequal_duplicates_see_nulls(spark):
    def found(a, b):
        rows = [{"time_series_mrid": "s1", **a}, {"time_series_mrid": "s2", **b}]
        staged = projections.stage_prices(f.prices(spark, rows))
        return [(r.row_count, r.payload_variant_count) for r in checks.unequal_duplicates(
            staged, PRICE_DUPLICATE_KEYS, PRICE_PAYLOAD).collect()]

    assert found({}, {}) == []
    assert found({}, {"price_amount": 2}) == [(2, 2)]
    assert found({}, {"price_amount": None}) == [(2, 2)]
    assert found({"price_amount": None}, {"price_amount": None}) == []


def test_daily_load(spark):
    rows = [{"at": h, "quantity": q} for h, q in ((0, 10), (1, "30.5"), (2, "30.5"), (23, -4))]
    day = one(branch_load(spark, rows)["agg_daily_load"])
    assert day.asDict() == {
        "bidding_zone": "Z", "observation_date": date(2026, 8, 20), "quantity_unit": "MAW",
        "resolution": "PT60M", "interval_minutes": 60, "observed_interval_count": 4,
        "expected_interval_count": 24, "average_load_mw": f.Decimal("16.750000000"),
        "minimum_load_mw": f.Decimal("-4.000000000"),
        "maximum_load_mw": f.Decimal("30.500000000"),
        "peak_load_timestamp": datetime(2026, 8, 20, 1), "observed_energy_mwh": 67.0,
        "coverage_ratio": 4 / 24, "is_complete_observation_day": False,
    }


def test_energy_uses_the_interval_and_full_days_are_complete(spark):
    rows = [{"at": q / 4, "quantity": 100} for q in range(96)]
    day = one(branch_load(spark, rows, resolution="PT15M")["agg_daily_load"])
    assert (day.observed_energy_mwh, day.coverage_ratio) == (2400.0, 1.0)
    assert day.is_complete_observation_day


def test_average_rounds_at_nine_places(spark):
    rows = [{"at": h, "quantity": q} for h, q in enumerate((1, 1, 0))]
    assert one(branch_load(spark, rows)["agg_daily_load"]).average_load_mw == f.Decimal(
        "0.666666667")


def test_resolutions_without_interval_length(spark):
    day = one(branch_load(spark, [{}], resolution="PT1H30M")["agg_daily_load"])
    for column in ("interval_minutes", "expected_interval_count", "observed_energy_mwh",
                   "coverage_ratio", "is_complete_observation_day"):
        assert day[column] is None
    assert day.observed_interval_count == 1


def test_two_resolutions_in_a_day_are_reported(spark):
    branch = branch_load(spark, [{"at": 0}, {"at": 1, "resolution": "PT30M"}])
    assert branch["agg_daily_load"].count() == 2
    report = quality.model_report("agg_daily_load", branch["agg_daily_load"])
    bad = {r.check: r.violations for r in report.filter("violations > 0").collect()}
    assert bad == {"daily_load_is_unique": 1}


@pytest.mark.parametrize("hours, expected", [(23, 92), (24, 96), (25, 100)])
def test_delivery_day_length(spark, hours, expected):
    start = datetime(2026, 3, 28, 23)
    rows = [{
        "period_start": start, "period_end": start + timedelta(hours=hours),
        "point_timestamp": start + timedelta(minutes=15 * i), "price_amount": [-1, 0, 2][i % 3],
    } for i in range(expected)]
    day = one(branch_prices(spark, rows, resolution="PT15M")["agg_daily_day_ahead_prices"])
    assert day.expected_interval_count == day.observed_interval_count == expected
    assert day.is_complete_delivery_day and day.coverage_ratio == 1.0
    # The date of the period's end, although most points lie on other dates.
    assert day.delivery_date == (start + timedelta(hours=hours)).date()
    negative = (expected + 2) // 3
    assert day.negative_price_interval_count == negative
    assert day.negative_price_duration_hours == negative / 4


def test_delivery_days_mix_resolutions_by_the_shortest(spark):
    rows = [{"at": 0, "price_amount": -1}, {"at": 1, "price_amount": -1, "resolution": "PT30M"},
            {"at": 2, "price_amount": -1, "resolution": "PT90S"}]
    day = one(branch_prices(spark, rows)["agg_daily_day_ahead_prices"])
    assert (day.interval_minutes, day.resolution) == (30, "PT30M")
    assert day.expected_interval_count == 48
    # Every row counts its own interval; one without a length adds nothing.
    assert day.negative_price_duration_hours == 1.5
    assert day.negative_price_interval_count == 3


def test_negative_hours_of_unknown_intervals(spark):
    def hours(*prices):
        rows = [{"at": h, "price_amount": p} for h, p in enumerate(prices)]
        branch = branch_prices(spark, rows, resolution="PT90S")
        return one(branch["agg_daily_day_ahead_prices"]).negative_price_duration_hours

    assert hours(-1, -2) is None
    assert hours(-1, 2) == hours(1, 2) == hours(None, -1) == 0.0


def daily(spark, **changed):
    base = branch_load(spark, [{"at": h} for h in range(24)])["agg_daily_load"]
    return base.withColumns({k: F.expr(v) for k, v in changed.items()})


def test_power_day_rules_catch_each_violation(spark):
    cases = [
        {"interval_minutes": "0L"},
        {"expected_interval_count": "0L"},
        {"observed_interval_count": "-1L"},
        {"observed_interval_count": "25L"},
        {"coverage_ratio": "-0.1D"},
        {"coverage_ratio": "1.1D"},
        {"is_complete_observation_day": "false"},
        {"minimum_load_mw": "average_load_mw + 1"},
        {"maximum_load_mw": "average_load_mw - 1"},
        {"observed_energy_mwh": "-1D"},
        {"peak_load_timestamp": "timestamp'2026-08-19 23:59:59'"},
        {"peak_load_timestamp": "timestamp'2026-08-21 00:00:00'"},
    ]
    rule = checks.invalid_power_day("load")
    assert daily(spark).filter(rule).isEmpty()
    for case in cases:
        assert daily(spark, **case).filter(rule).count() == 1, case
    assert daily(spark, interval_minutes="null").filter(rule).isEmpty()


def test_price_day_rules_catch_each_violation(spark):
    day = branch_prices(spark, [{"at": h, "price_amount": h - 3} for h in range(24)])[
        "agg_daily_day_ahead_prices"]
    rule = checks.invalid_price_day()
    assert day.filter(rule).isEmpty()
    for column, value in (
        ("period_end", "period_start"), ("interval_minutes", "0L"),
        ("expected_interval_count", "0L"), ("observed_interval_count", "25L"),
        ("coverage_ratio", "2D"), ("is_complete_delivery_day", "false"),
        ("negative_price_interval_count", "-1L"), ("negative_price_interval_count", "25L"),
        ("negative_price_duration_hours", "-1D"), ("negative_price_duration_hours", "24.5D"),
        ("minimum_price_eur_per_mwh", "average_price_eur_per_mwh + 1"),
        ("maximum_price_eur_per_mwh", "average_price_eur_per_mwh - 1"),
    ):
        assert day.withColumn(column, F.expr(value)).filter(rule).count() == 1, column


def test_report_has_all_checks_and_finds_seeded_violations(spark):
    built = models.all_models(
        f.load(spark, [{}, {"at": 1, "time_series_mrid": None}]),
        f.generation(spark, [{"out_bidding_zone": None}, {"at": 1}]),
        f.prices(spark, [{"time_series_mrid": "s1"}, {"time_series_mrid": "s2",
                                                       "price_amount": 5},
                         {"at": 1, "out_domain": "Y"}]),
    )
    report = quality.quality_report(built).collect()
    assert len(report) == 149 and {r.model for r in report} == set(REQUIRED_COLUMNS)
    bad = {(r.model, r.check): r.violations for r in report if r.violations}
    assert bad == {
        **{(m, "not_null:time_series_id"): 1 for m in (
            "stg_actual_load", "int_actual_load_canonical", "fct_actual_load")},
        ("int_actual_generation_normalized", "actual_generation_has_single_bidding_zone"): 1,
        ("int_day_ahead_prices_deduplicated", "day_ahead_domains_match"): 1,
        ("stg_day_ahead_prices", "day_ahead_price_duplicates_are_equivalent"): 1,
    }
    frame = spark.createDataFrame(report)
    assert not quality.passes(frame) and quality.passes(frame.filter("violations = 0"))


def test_empty_inputs_pass_every_check(spark):
    built = models.all_models(f.load(spark, []), f.generation(spark, []), f.prices(spark, []))
    report = quality.quality_report(built)
    assert report.count() == 149 and quality.passes(report)


def test_views(spark):
    models.create_views(branch_load(spark, [{}]))
    assert spark.sql("select count(*) from agg_daily_load").first()[0] == 1


def test_a_hot_key_is_reduced_before_the_shuffle(spark):
    hot = spark.range(0, 20000, numPartitions=4).select(
        (F.col("id") % 1).cast("string").alias("bidding_zone"), (F.col("id") % 1).alias("t"),
        F.col("id").alias("v"))
    latest = versions.latest_version(hot, ("bidding_zone", "t"), order=[F.col("v").desc()])
    assert latest.first().v == 19999
    plan = latest._jdf.queryExecution().executedPlan().toString()
    before_shuffle = plan[plan.index("Exchange hash"):]
    assert "WindowGroupLimit" in before_shuffle and "Partial" in before_shuffle


def test_canonical_checks_reuse_the_shuffle_of_the_version_pick(spark):
    canonical = branch_load(spark, [{}, {"at": 1}])["int_actual_load_canonical"]
    report = quality.model_report("int_actual_load_canonical", canonical)
    plan = report._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange hashpartitioning") == 1


def test_zone_filters_reach_the_scan(spark, tmp_path):
    raw = f.load(spark, [{"out_bidding_zone": z} for z in "ABC"])
    raw.write.parquet(str(tmp_path / "raw"))
    stored = spark.read.schema(LOAD.schema).parquet(str(tmp_path / "raw"))
    facts = models.load_branch(stored)["fct_actual_load"].filter("bidding_zone = 'B'")
    assert facts.count() == 1
    plan = facts._jdf.queryExecution().executedPlan().toString()
    assert "PushedFilters: [IsNotNull(out_bidding_zone), EqualTo(out_bidding_zone,B)]" in plan
    # Columns that neither the facts nor the version order need are not read.
    read = plan[plan.index("ReadSchema"):]
    assert not any(c in read for c in ("curve_type", "business_type", "object_aggregation"))


@settings(max_examples=5, deadline=None,
          suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(seed=st.integers(0, 10**6))
def test_version_pick_against_brute_force(spark, seed):
    rng = random.Random(seed)
    rows = [
        {"out_bidding_zone": rng.choice("AB"), "at": rng.randrange(3),
         "revision_number": rng.randrange(3),
         "document_created_at": f.DAY + timedelta(hours=rng.randrange(2)),
         "source_object_name": rng.choice(["o1", "o10", "o2"]),
         "document_mrid": rng.choice("de"), "time_series_mrid": rng.choice("st"),
         "quantity": rng.randrange(5)}
        for _ in range(120)
    ]
    order = ("revision_number", "document_created_at", "source_object_name", "document_mrid",
             "time_series_mrid", "quantity")
    best = {}
    for row in rows:
        key, rank = (row["out_bidding_zone"], row["at"]), tuple(row[c] for c in order)
        best[key] = max(best.get(key, rank), rank)
    got = f.naive(branch_load(spark, rows)["int_actual_load_canonical"]).collect()
    found = {
        (r.bidding_zone, (r.point_timestamp - f.DAY).seconds // 3600): (
            r.revision_number, r.document_created_at, r.source_object_name, r.document_id,
            r.time_series_id, int(r.load_quantity))
        for r in got
    }
    assert found == best

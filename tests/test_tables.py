import os
from concurrent.futures import ThreadPoolExecutor
from datetime import date, datetime, timedelta

import frames as f
import pytest
import xml_samples as x
from pyspark.sql import functions as F

from wattline import schemas
from wattline.plans import ingest as ing
from wattline.plans import marts
from wattline.session import work_folder
from wattline.sinks import tables as sinks
from wattline.sources import documents as docs
from wattline.sources import tables
from wattline.streaming.ingest import ingest_stream

LOAD_CHAIN, GENERATION_CHAIN, PRICE_CHAIN = marts.CHAINS


def same(a, b):
    return a.count() == b.count() and a.exceptAll(b.select(a.columns)).isEmpty()


def name(zone, day, suffix=""):
    return (
        f"entsoe/actual_load/bidding_zone={zone}/year=2026/month=08/day={day:02}/"
        f"202608{day:02}T0000Z_202608{day + 1:02}T0000Z{suffix}.xml"
    )


def batch(spark, *rows):
    """(name, text) or (name, text, minutes after noon)."""
    noon = datetime(2026, 8, 20, 12)
    full = [
        (r[0], bytearray(r[1].encode()), noon + timedelta(minutes=r[2] if len(r) > 2 else 0))
        for r in rows
    ]
    return spark.createDataFrame(
        full, "source_object_name string, content binary, arrived_at timestamp"
    )


def payload(value):
    return x.load().replace("412.75", str(value))


def values(spark, root):
    rows = tables.read_raw(spark, root, schemas.LOAD).filter("position = 1").collect()
    return sorted((r.source_object_name, float(r.quantity)) for r in rows)


def statuses(rows):
    return {r.source_object_name: (r.stored, r.status, r.row_count) for r in rows.collect()}


def test_ingest_lands_loads_and_accounts(spark, tmp_path):
    root = str(tmp_path)
    ing.provision_raw(spark, root)
    assert tables.read_raw(spark, root, schemas.LOAD).count() == 0
    a, b, c = name("A", 20), name("B", 20), "no-day.xml"
    bad = x.load().replace("PT15M", "P1D")
    empty = x.document("D", "A65", "d", [])
    rows = batch(spark, (a, payload(1)), (a, payload(2), 5), (a, payload(3), -5), (b, bad),
                 (c, empty))
    ledger = ing.ingest(spark, rows, "actual_load", root, "day1")
    assert statuses(ledger) == {
        a: (True, "loaded", 2), b: (True, "rejected", 0), c: (True, "rejected", 0)}
    assert {r.bidding_zone for r in ledger.collect()} == {"A", "B", None}
    # The earliest payload of a batch is the one that counts.
    assert values(spark, root) == [(a, 3.0)]
    refused = {r.source_object_name: r.errors[0] for r in ing.quarantined(spark, root).collect()}
    assert refused == {b: "Period.resolution: missing or invalid", c: "document: no points"}
    assert ing.landed(spark, root).count() == 3

    # The same batch again, with other payloads: nothing is stored or loaded twice.
    again = batch(spark, (a, payload(9)), (b, payload(4)))
    ledger = ing.ingest(spark, again, "actual_load", root, "day1")
    assert statuses(ledger) == {a: (False, "already loaded", 0), b: (False, "loaded", 2)}
    assert values(spark, root) == [(a, 3.0), (b, 4.0)]
    # The first payload stays in the landing table although it was not accepted.
    kept = {r.source_object_name: bytes(r.content).decode()
            for r in ing.landed(spark, root).collect()}
    assert kept[b] == bad and len(kept) == 3
    assert ing.ledger(spark, root).count() == 5

    # Another object that covers the same points is kept; revisions are picked later.
    other = name("A", 20, "-late")
    ing.ingest(spark, batch(spark, (other, payload(7))), "actual_load", root, "day2")
    assert values(spark, root) == sorted([(a, 3.0), (other, 7.0), (b, 4.0)])
    added = ing.batch_rows(spark, root, schemas.LOAD, "day2").collect()
    assert {r.source_object_name for r in added} == {other}


@pytest.mark.parametrize("stage", ["parsed", "quarantine", "ledger", "commits"])
def test_a_batch_that_broke_off_is_completed_by_running_it_again(
    spark, tmp_path, monkeypatch, stage
):
    root, a, b = str(tmp_path), name("A", 20), name("B", 21)
    rows = batch(spark, (a, payload(1)), (b, payload(2)))

    def broken(*args, **kwargs):
        raise ConnectionError("lost")

    with monkeypatch.context() as patch:
        if stage == "parsed":
            patch.setattr(ing.docs, "parse", broken)
        elif stage == "commits":
            commit = ing.commits.commit

            def commit_of_landing_only(session, root, entry, *rest):
                landing = entry["load_batch"].startswith("landing-")
                return commit(session, root, entry, *rest) if landing else broken()

            patch.setattr(ing.commits, "commit", commit_of_landing_only)
        else:
            write = sinks.write_batch

            def write_batch(df, root, table, *rest):
                return broken() if table == stage else write(df, root, table, *rest)

            patch.setattr(ing.sinks, "write_batch", write_batch)
        with pytest.raises(ConnectionError):
            ing.ingest(spark, rows, schemas.LOAD, root, "b")
    ledger = ing.ingest(spark, rows, schemas.LOAD, root, "b")
    # The payloads had been landed by the first attempt.
    assert statuses(ledger) == {a: (False, "loaded", 2), b: (False, "loaded", 2)}
    assert values(spark, root) == [(a, 1.0), (b, 2.0)]
    assert ing.landed(spark, root).count() == 2
    assert ing.ledger(spark, root).count() == 2


@pytest.mark.parametrize("stage", ["quarantine", "ledger"])
def test_another_batch_takes_the_objects_of_one_that_broke_off(spark, tmp_path, monkeypatch, stage):
    root, a, b = str(tmp_path), name("A", 20), name("B", 21)
    write = sinks.write_batch

    def write_batch(df, folder, table, *rest):
        if table == stage:
            raise ConnectionError("lost")
        return write(df, folder, table, *rest)

    with monkeypatch.context() as patch:
        patch.setattr(ing.sinks, "write_batch", write_batch)
        with pytest.raises(ConnectionError):
            ing.ingest(spark, batch(spark, (a, payload(1))), schemas.LOAD, root, "x")
    assert values(spark, root) == [] and ing.ledger(spark, root).isEmpty()
    both = batch(spark, (a, payload(1)), (b, payload(2)))
    ing.ingest(spark, both, schemas.LOAD, root, "x-1")
    assert values(spark, root) == [(a, 1.0), (b, 2.0)]
    again = ing.ingest(spark, batch(spark, (a, payload(1))), schemas.LOAD, root, "x")
    assert statuses(again) == {a: (False, "already loaded", 0)}
    assert values(spark, root) == [(a, 1.0), (b, 2.0)]
    assert ing.batch_rows(spark, root, schemas.LOAD, "x").isEmpty()
    assert ing.batch_rows(spark, root, schemas.LOAD, "x-1").count() == 4
    with pytest.raises(ValueError):
        ing.ingest(spark, both, schemas.LOAD, root, "a/b")


@pytest.mark.parametrize("table", ["landing", "actual_load", "ledger"])
def test_a_writer_that_finishes_in_between_keeps_its_objects(spark, tmp_path, monkeypatch, table):
    """Batch ``y`` runs whole while ``x`` has read what is there and not yet written ``table``."""
    root, a, b, c = str(tmp_path), name("A", 20), name("B", 21), name("C", 22)
    write, turns = sinks.write_batch, []

    def write_batch(df, folder, to, *rest):
        if to == table and not turns:
            turns.append(to)
            ing.ingest(spark, batch(spark, (b, payload(5)), (c, payload(6))), schemas.LOAD, root, "y")
        return write(df, folder, to, *rest)

    with monkeypatch.context() as patch:
        patch.setattr(ing.sinks, "write_batch", write_batch)
        rows = batch(spark, (a, payload(1)), (b, payload(2)))
        ledger = ing.ingest(spark, rows, schemas.LOAD, root, "x")
    landed_first = table != "landing"
    assert statuses(ledger) == {a: (True, "loaded", 2), b: (landed_first, "already loaded", 0)}
    assert values(spark, root) == [(a, 1.0), (b, 5.0), (c, 6.0)]
    assert ing.batch_rows(spark, root, schemas.LOAD, "x").count() == 2
    kept = {r.source_object_name: bytes(r.content).decode() for r in ing.landed(spark, root).collect()}
    assert kept == {a: payload(1), b: payload(2 if landed_first else 5), c: payload(6)}
    assert ing.landed(spark, root).count() == 3
    # nothing of the attempt that was given up is left
    keys = {r.load_batch for r in ing.commits.log(spark, root).collect()}
    for folder in ("actual_load", "ledger", "landing"):
        assert {p.name.split("=")[1] for p in (tmp_path / folder).glob("load_batch=*")} <= keys


def parsed_names(patch):
    """Names in each call of the parse."""
    parse, calls = docs.parse, []

    def seen(rows, spec):
        calls.append(sorted(r.source_object_name for r in rows.select("source_object_name").collect()))
        return parse(rows, spec)

    patch.setattr(ing.docs, "parse", seen)
    return calls


@pytest.mark.parametrize("table", ["landing", "ledger"])
def test_a_writer_that_lost_parses_no_document_twice(spark, tmp_path, monkeypatch, table):
    """What others loaded while it landed is not parsed; after a lost commit nothing is parsed anew."""
    root, a, b, c = str(tmp_path), name("A", 20), name("B", 21), name("C", 22)
    write, turns = sinks.write_batch, []

    def write_batch(df, folder, to, *rest):
        if to == table and not turns:
            turns.append(to)
            ing.ingest(spark, batch(spark, (b, payload(5)), (c, "<bad")), schemas.LOAD, root, "y")
        return write(df, folder, to, *rest)

    with monkeypatch.context() as patch:
        patch.setattr(ing.sinks, "write_batch", write_batch)
        calls = parsed_names(patch)
        rows = batch(spark, (a, payload(1)), (b, payload(2)), (c, payload(6)))
        ledger = ing.ingest(spark, rows, schemas.LOAD, root, "x")
    assert calls == ([[b, c], [a, c]] if table == "landing" else [[a, b, c], [b, c]])
    first = table != "landing"
    assert statuses(ledger) == {
        a: (True, "loaded", 2), b: (first, "already loaded", 0), c: (first, "loaded", 2)}
    assert values(spark, root) == [(a, 1.0), (b, 5.0), (c, 6.0)]


def test_a_commit_in_the_last_moment_is_seen(spark, tmp_path, monkeypatch):
    """Batch ``y`` runs whole after ``x`` looked for other commits and before it takes a number."""
    root, a, b = str(tmp_path), name("A", 20), name("B", 21)
    free, turns = ing.commits._name_if_free, []

    def name_if_free(session, folder, number, line):
        if "actual_load-x-" in line and not turns:
            turns.append(number)
            ing.ingest(spark, batch(spark, (b, payload(5))), schemas.LOAD, root, "y")
        return free(session, folder, number, line)

    with monkeypatch.context() as patch:
        patch.setattr(ing.commits, "_name_if_free", name_if_free)
        rows = batch(spark, (a, payload(1)), (b, payload(2)))
        ledger = ing.ingest(spark, rows, schemas.LOAD, root, "x")
    assert statuses(ledger) == {a: (True, "loaded", 2), b: (True, "already loaded", 0)}
    assert values(spark, root) == [(a, 1.0), (b, 5.0)]


def test_payloads_are_looked_up_and_written_as_far_as_needed(spark, tmp_path, monkeypatch):
    """A first batch reads its documents once; contents of loaded objects are not written again."""
    root, a, b, c = str(tmp_path), name("A", 20), name("B", 21), name("C", 22)
    day_range, written, ranges, kept = ing._day_range, ing._written, [], []

    def seen_range(rows, dataset):
        ranges.append("loaded" in rows.columns)
        return day_range(rows, dataset)

    def seen_written(session, df, label):
        out = written(session, df, label)
        if label == "payloads":
            kept.append({r.source_object_name for r in out.filter("content is not null").collect()})
        return out

    monkeypatch.setattr(ing, "_day_range", seen_range)
    monkeypatch.setattr(ing, "_written", seen_written)
    ing.ingest(spark, batch(spark, (a, payload(1)), (b, "<bad")), schemas.LOAD, root, "x")
    rows = batch(spark, (a, payload(7)), (b, payload(2)), (c, payload(3)))
    ledger = ing.ingest(spark, rows, schemas.LOAD, root, "y")
    assert ranges == [True, False]
    assert kept == [{a, b}, {b, c}]
    assert statuses(ledger) == {
        a: (False, "already loaded", 0), b: (False, "loaded", 2), c: (True, "loaded", 2)}
    assert values(spark, root) == [(a, 1.0), (b, 2.0), (c, 3.0)]
    # landing alone gives all contents back
    assert ing.land(spark, rows, schemas.LOAD, root).filter("content is null").isEmpty()


def test_commits_are_numbered_once(spark, tmp_path):
    root = str(tmp_path)
    ing.commits.open_log(spark, root)
    assert ing.commits.last(spark, root) == 0

    def commit(i):
        entry = {"dataset": "d", "batch": f"b{i}", "load_batch": f"k{i}"}
        return ing.commits.commit(spark, root, entry, 0, lambda later: False)

    with ThreadPoolExecutor(6) as pool:
        assert all(pool.map(commit, range(12)))
    rows = ing.commits.log(spark, root).collect()
    assert sorted(r.number for r in rows) == list(range(1, 13))
    assert {r.load_batch for r in rows} == {f"k{i}" for i in range(12)}
    entry = {"dataset": "d", "batch": "late", "load_batch": "late"}
    assert not ing.commits.commit(spark, root, entry, 3, lambda later: later.count() == 9)
    assert ing.commits.commit(spark, root, {**entry, "dataset": "e"}, 3, lambda later: later.count() > 0)
    assert ing.commits.last(spark, root) == 13


def test_strict_mode_fails_after_accounting(spark, tmp_path):
    root, a, b = str(tmp_path), name("A", 20), name("B", 20)
    rows = batch(spark, (a, payload(1)), (b, "<broken"))
    with pytest.raises(ing.RejectedDocuments):
        ing.ingest(spark, rows, schemas.LOAD, root, "b", strict=True)
    assert values(spark, root) == [(a, 1.0)]
    assert ing.quarantined(spark, root).count() == 1


def test_stream_takes_each_file_once(spark, tmp_path):
    store, root, state = tmp_path / "store", str(tmp_path / "out"), str(tmp_path / "state")

    def put(object_name, text):
        path = store / object_name
        path.parent.mkdir(parents=True, exist_ok=True)
        path.write_text(text)

    def run():
        stream = docs.stream_documents(spark, str(store))
        ingest_stream(stream, schemas.LOAD, root, state).awaitTermination()

    a, b = name("A", 20), name("B", 20)
    put(a, payload(1))
    run()
    assert values(spark, root) == [(a, 1.0)]
    put(b, payload(2))
    run()
    run()
    assert values(spark, root) == [(a, 1.0), (b, 2.0)]
    assert ing.ledger(spark, root).count() == 2


def rows_over_days(days, **extra):
    return [{"at": 24 * d + h, "quantity": d * 100 + h, "price_amount": d * 100 + h, **extra}
            for d in range(days) for h in range(24)]


def write_raw(rows, dataset, root, label):
    sinks.write_batch(rows, root, dataset.name, label, dataset.layout)


def test_layout_prunes_days_and_sorts_files(spark, tmp_path):
    root = str(tmp_path)
    rows = f.load(spark, [{"at": 24 * d, "out_bidding_zone": f"Z{z}"}
                          for z in (2, 0, 1) for d in range(3)])
    write_raw(rows, schemas.LOAD, root, "b1")
    assert sorted(os.listdir(f"{root}/actual_load")) == ["load_batch=b1"]
    assert {p for p in os.listdir(f"{root}/actual_load/load_batch=b1") if "=" in p} == {
        f"point_date=2026-08-{d}" for d in (20, 21, 22)}
    day = tables.read_raw(spark, root, schemas.LOAD, "2026-08-21", date(2026, 8, 21))
    assert [r.out_bidding_zone for r in day.collect()] == ["Z0", "Z1", "Z2"]
    assert [fld.name for fld in day.schema] == schemas.RAW_LOAD.fieldNames()
    plan = day.select("quantity")._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(point_date" in plan
    assert "ReadSchema: struct<quantity:decimal(38,9)>" in plan
    # The same batch written again replaces itself.
    write_raw(rows, schemas.LOAD, root, "b1")
    assert tables.read_raw(spark, root, schemas.LOAD).count() == 9


def check_refresh(spark, tmp_path, chain, make, first, late):
    raw_root, live, full = (str(tmp_path / n) for n in ("raw", "live", "full"))
    write_raw(make(spark, first), chain.dataset, raw_root, "b1")
    marts.build_chain(spark, tables.read_raw(spark, raw_root, chain.dataset), chain, live)
    before = {p: os.path.getmtime(f"{live}/{chain.facts}/{p}")
              for p in os.listdir(f"{live}/{chain.facts}") if "=" in p}
    changed = make(spark, late)
    write_raw(changed, chain.dataset, raw_root, "b2")
    marts.refresh_chain(spark, raw_root, chain, live, changed)
    built = marts.build_chain(
        spark, tables.read_raw(spark, raw_root, chain.dataset), chain, full)
    for table in (chain.facts, chain.daily):
        stored = tables.read_table(
            spark, f"{live}/{table}", built[table].schema, schemas.MART_LAYOUTS[table])
        assert same(stored, built[table]), table
    after = {p: os.path.getmtime(f"{live}/{chain.facts}/{p}") for p in before}
    return {p for p in before if before[p] != after[p]}, built


def test_refresh_load(spark, tmp_path):
    late = [{"at": 30, "quantity": 999, "revision_number": 2}, {"at": 24 * 9, "quantity": 5}]
    touched, _ = check_refresh(spark, tmp_path, LOAD_CHAIN, f.load, rows_over_days(4), late)
    assert touched == {"point_date=2026-08-21"}


def test_refresh_generation(spark, tmp_path):
    late = [{"at": 3, "psr_type": "B99"}, {"at": 50, "revision_number": 0}]
    check_refresh(spark, tmp_path, GENERATION_CHAIN, f.generation,
                  rows_over_days(3, out_bidding_zone=None), late)


def delivery(days, **extra):
    """Hourly prices of delivery days from 22:00 to 22:00."""
    out = []
    for d in range(days):
        start = f.DAY + timedelta(days=d) - timedelta(hours=2)
        out += [{"point_timestamp": start + timedelta(hours=h), "period_start": start,
                 "period_end": start + timedelta(days=1), "price_amount": d * 10 + h, **extra}
                for h in range(24)]
    return out


def test_refresh_prices_across_midnight(spark, tmp_path):
    late = [{**r, "revision_number": 2, "price_amount": -5} for r in delivery(3)[24:26]]
    touched, _ = check_refresh(spark, tmp_path, PRICE_CHAIN, f.prices, delivery(4), late)
    assert touched == {"point_date=2026-08-20"}


def test_refresh_prices_empties_a_delivery_day_that_lost_its_points(spark, tmp_path):
    # All points of the second day are revised into one long period that ends a day later.
    second = delivery(2)[24:]
    end = second[0]["period_end"] + timedelta(days=1)
    late = [{**r, "revision_number": 2, "period_end": end} for r in second]
    _, built = check_refresh(spark, tmp_path, PRICE_CHAIN, f.prices, delivery(2), late)
    days = {r.delivery_date for r in built[PRICE_CHAIN.daily].collect()}
    assert days == {date(2026, 8, 20), date(2026, 8, 22)}


def test_publish_only_what_passes(spark, tmp_path):
    raw_root, root = str(tmp_path / "raw"), str(tmp_path / "out")
    assert marts.published_folder(spark, root) is None
    with pytest.raises(LookupError):
        marts.read_published(spark, root, "agg_daily_load")
    write_raw(f.load(spark, rows_over_days(2)), schemas.LOAD, raw_root, "b1")
    write_raw(f.generation(spark, rows_over_days(2, out_bidding_zone=None)),
              schemas.GENERATION, raw_root, "b1")
    write_raw(f.prices(spark, delivery(2)), schemas.PRICES, raw_root, "b1")
    assert marts.build_and_publish(spark, raw_root, root, "r1")
    day = marts.read_published(spark, root, "agg_daily_load", "2026-08-21", "2026-08-21")
    assert [r.observed_interval_count for r in day.collect()] == [24]

    # A second resolution breaks the daily grain: the run is kept but not published.
    write_raw(f.load(spark, [{"at": 1, "resolution": "PT30M", "revision_number": 2}]),
              schemas.LOAD, raw_root, "b2")
    assert not marts.build_and_publish(spark, raw_root, root, "r2")
    first = marts.published_folder(spark, root)
    assert first.startswith(f"{root}/runs/r1-")
    log = {r.run: r.passed for r in marts.publication_log(spark, root).collect()}
    assert log == {"r1": True, "r2": False}
    folder = marts.publication_log(spark, root).filter("run = 'r2'").first().folder
    report = spark.read.schema(marts.REPORT_DDL).parquet(f"{folder}/report")
    assert report.filter("violations > 0").first().check == "daily_load_is_unique"
    assert marts.read_published(spark, root, "agg_daily_load").count() == 2

    # A used name does not overwrite what is live.
    assert not marts.build_and_publish(spark, raw_root, root, "r1")
    assert marts.published_folder(spark, root) == first
    assert marts.read_published(spark, root, "agg_daily_load").count() == 2


def test_checked_refresh_equals_a_rebuild(spark, tmp_path):
    raw_root, root, full = (str(tmp_path / n) for n in ("raw", "out", "full"))
    write_raw(f.load(spark, rows_over_days(3)), schemas.LOAD, raw_root, "b1")
    write_raw(f.generation(spark, rows_over_days(2, out_bidding_zone=None)),
              schemas.GENERATION, raw_root, "b1")
    write_raw(f.prices(spark, delivery(2)), schemas.PRICES, raw_root, "b1")
    with pytest.raises(LookupError):
        marts.refresh_and_publish(spark, raw_root, root, "r0", {"actual_load": f.load(spark, [])})
    assert marts.build_and_publish(spark, raw_root, root, "r1")
    late = {
        "actual_load": f.load(spark, [{"at": 30, "revision_number": 2, "quantity": 9}]),
        "day_ahead_prices": f.prices(spark, [
            {**row, "source_object_name": "o2", "revision_number": 2, "price_amount": 77}
            for row in delivery(2)[:3]
        ]),
    }
    for name_, rows in late.items():
        write_raw(rows, schemas.DATASETS[name_], raw_root, "b2")
    assert marts.refresh_and_publish(spark, raw_root, root, "r2", late)
    marts.build_all(spark, raw_root, full)
    shapes = marts.mart_schemas(spark)
    for table, layout in schemas.MART_LAYOUTS.items():
        rebuilt = tables.read_table(spark, f"{full}/{table}", shapes[table], layout)
        assert same(marts.read_published(spark, root, table), rebuilt), table
    # untouched days stay where they were first written
    held = marts.snapshot(spark, root).filter("table = 'fct_actual_load'")
    assert held.select("folder").distinct().count() == 2
    assert held.count() == held.select("day").distinct().count() == 3

    live = marts.published_folder(spark, root)
    worse = f.load(spark, [{"at": 30, "resolution": "PT30M", "revision_number": 3}])
    write_raw(worse, schemas.LOAD, raw_root, "b3")
    assert not marts.refresh_and_publish(spark, raw_root, root, "r3", {"actual_load": worse})
    assert marts.published_folder(spark, root) == live


def test_published_table_is_one_scan_and_folds(spark, tmp_path):
    raw_root, root, full = (str(tmp_path / n) for n in ("raw", "out", "full"))
    write_raw(f.load(spark, rows_over_days(5)), schemas.LOAD, raw_root, "b0")
    write_raw(f.generation(spark, rows_over_days(1, out_bidding_zone=None)),
              schemas.GENERATION, raw_root, "b0")
    write_raw(f.prices(spark, delivery(1)), schemas.PRICES, raw_root, "b0")
    days = [f"2026-08-{d}" for d in range(20, 25)]
    assert marts.build_and_publish(spark, raw_root, root, "r0")

    def scans():
        plan = marts.read_published(spark, root, "fct_actual_load")._jdf.queryExecution()
        return plan.sparkPlan().toString().count("FileScan")

    for k in range(1, 5):
        late = f.load(spark, [{"at": 24 * k - 19, "revision_number": 2, "quantity": 50 + k}])
        write_raw(late, schemas.LOAD, raw_root, f"b{k}")
        assert marts.refresh_and_publish(spark, raw_root, root, f"r{k}", {"actual_load": late})
        assert scans() == 1
    marts.build_all(spark, raw_root, full)
    shapes = marts.mart_schemas(spark)

    def same_as_rebuilt():
        for table in ("fct_actual_load", "agg_daily_load"):
            layout = schemas.MART_LAYOUTS[table]
            rebuilt = tables.read_table(spark, f"{full}/{table}", shapes[table], layout)
            assert same(marts.read_published(spark, root, table), rebuilt), table
        two = marts.read_published(spark, root, "fct_actual_load", days[1], days[2])
        found = two.select(F.to_date("point_timestamp").cast("string")).distinct().collect()
        assert {r[0] for r in found} == set(days[1:3])

    same_as_rebuilt()
    def attempts():
        held = marts.snapshot(spark, root).filter("table = 'agg_daily_load'")
        return held.select("folder").distinct().count()

    assert attempts() == 5
    assert marts.fold_published(spark, root, "folded")
    assert attempts() == 1
    same_as_rebuilt()
    assert scans() == 1
    assert not marts.fold_published(spark, root, "again")
    with pytest.raises(ValueError):
        marts.build_and_publish(spark, raw_root, root, "a/b")


def test_work_folders_lie_in_the_shared_folder(spark):
    shared = spark.conf.get("spark.checkpoint.dir")
    assert work_folder(spark, "a").startswith(shared)
    assert work_folder(spark, "a") != work_folder(spark, "a")

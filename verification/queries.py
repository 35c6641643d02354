"""Registered queries. Each takes ``(spark, sf_dir)`` and reads whole test tables."""

from __future__ import annotations

from collections.abc import Callable
from concurrent.futures import ThreadPoolExecutor

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from verification import made_documents
from wattline import schemas
from wattline.functions import measures, text
from wattline.operators import checks, projections, versions
from wattline.plans import ingest, marts, models, quality
from wattline.session import configure, work_folder
from wattline.sinks import json_rows as json_sink
from wattline.sinks import tables as sinks
from wattline.sources import bridge, documents, json_rows, manifest, tables, zones
from wattline.streaming import ingest as stream

Query = Callable[[SparkSession, str], DataFrame]


def comparable(df: DataFrame) -> DataFrame:
    """Values in the form both engines return alike."""

    def column(field: T.StructField) -> Column:
        c = F.col(f"`{field.name}`")
        if isinstance(field.dataType, (T.DecimalType, T.DoubleType)):
            c = F.round(c.cast("double"), 6)
        elif isinstance(field.dataType, T.TimestampType):
            c = c.cast("timestamp_ntz")
        elif isinstance(field.dataType, T.DateType):
            c = F.date_format(c, "yyyy-MM-dd")
        return c.alias(field.name)

    return df.select(*[column(f) for f in df.schema.fields])


def _events(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bridge.events(configure(spark), sf_dir)


def _branch(build, raw, model: str, resolution: Callable[[], Column] | None = None) -> Query:
    def query(spark: SparkSession, sf_dir: str) -> DataFrame:
        rows = raw(_events(spark, sf_dir), resolution() if resolution else None)
        return comparable(build(rows)[model])

    return query


def _load(model: str, resolution=None) -> Query:
    return _branch(models.load_branch, bridge.raw_load, model, resolution)


def _generation(model: str, resolution=None) -> Query:
    return _branch(models.generation_branch, bridge.raw_generation, model, resolution)


def _price(model: str, resolution=None) -> Query:
    return _branch(models.price_branch, bridge.raw_prices, model, resolution)


def _all_models(spark: SparkSession, sf_dir: str) -> dict[str, DataFrame]:
    """All models over the mixed-resolution frames, where several checks find violations."""
    ev = _events(spark, sf_dir)
    mixed = bridge.mixed_resolution
    return models.all_models(
        bridge.raw_load(ev, mixed()),
        bridge.raw_generation(ev, mixed()),
        bridge.raw_prices(ev, mixed()),
    )


def _check(model: str, check: Callable[[DataFrame], DataFrame]) -> Query:
    return lambda spark, sf_dir: comparable(check(_all_models(spark, sf_dir)[model]))


def _duplicates(model: str, grain) -> Query:
    return _check(model, lambda df: checks.duplicated_keys(df, grain))


def _repeated(model: str, grain, rows: str) -> Query:
    """Duplicates of a unique model, after some of its rows were added a second time."""
    return _check(model, lambda df: checks.duplicated_keys(df.unionByName(df.filter(rows)), grain))


def price_from_staged(spark: SparkSession, sf_dir: str) -> DataFrame:
    staged = projections.stage_prices(bridge.raw_prices(_events(spark, sf_dir)))
    return comparable(models.canonical_prices(models.deduplicated_prices(staged)))


def _hot(raw: DataFrame) -> DataFrame:
    """A third of all rows put on one zone and point in time."""
    hot = F.col("revision_number") == 1
    at = F.lit("2024-01-15 12:00:00").cast("timestamp")
    return raw.withColumns({
        "out_bidding_zone": F.when(hot, "Z0").otherwise(F.col("out_bidding_zone")),
        "point_timestamp": F.when(hot, at).otherwise(F.col("point_timestamp")),
        "resolution": F.lit("PT60M"),
    })


def hot_key(model: str) -> Query:
    def query(spark: SparkSession, sf_dir: str) -> DataFrame:
        raw = _hot(bridge.raw_load(_events(spark, sf_dir)))
        return comparable(models.load_branch(raw)[model])

    return query


def lineitem_latest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The version operator over a table that repeats its keys."""
    schema = (
        "l_orderkey bigint, l_partkey bigint, l_suppkey bigint, l_linenumber int, "
        "l_quantity double, l_extendedprice double, l_shipdate timestamp_ntz"
    )
    items = configure(spark).read.schema(schema).parquet(f"{sf_dir}/lineitem.parquet")
    order = [F.col(c).desc() for c in (
        "l_shipdate", "l_partkey", "l_suppkey", "l_quantity", "l_extendedprice",
    )]
    return comparable(
        versions.latest_version(items, ("l_orderkey", "l_linenumber"), order=order)
    )


def not_null(spark: SparkSession, sf_dir: str) -> DataFrame:
    parts = [
        checks.null_counts(df, schemas.REQUIRED_COLUMNS[name]).select(
            F.lit(name).alias("model"), "column_name", "null_count"
        )
        for name, df in _all_models(spark, sf_dir).items()
    ]
    out = parts[0]
    for part in parts[1:]:
        out = out.unionByName(part)
    return out


def report(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.quality_report(_all_models(spark, sf_dir))


def overcounted_load_days(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Daily KPIs over staged rows, whose repeated points overfill the days."""
    staged = projections.stage_load(bridge.raw_load(_events(spark, sf_dir)))
    daily = models.daily_load(projections.load_facts(staged))
    return comparable(daily.filter(checks.invalid_power_day("load")))


def overcounted_generation_days(spark: SparkSession, sf_dir: str) -> DataFrame:
    raw = bridge.raw_generation(_events(spark, sf_dir))
    # One zone and production type for all rows: enough repeated points to overfill a day.
    staged = projections.stage_generation(raw).withColumn("psr_type", F.lit("B10"))
    normalized = projections.normalize_direction(staged).withColumn("bidding_zone", F.lit("Z"))
    facts = projections.generation_facts(normalized)
    daily = models.daily_generation(facts)
    return comparable(daily.filter(checks.invalid_power_day("generation")))


def overcounted_price_days(spark: SparkSession, sf_dir: str) -> DataFrame:
    staged = projections.stage_prices(bridge.raw_prices(_events(spark, sf_dir)))
    merged = staged.withColumn("classification_sequence_position", F.lit(None).cast("bigint"))
    daily = models.daily_prices(projections.price_facts(merged))
    return comparable(daily.filter(checks.invalid_price_day()))


def domain_mismatches(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The domain check over rows whose out domain is another one at prices above 50."""
    raw = bridge.raw_prices(_events(spark, sf_dir))
    shifted = F.when(F.col("price_amount") > 50, F.lit("Z-other")).otherwise(F.col("out_domain"))
    rows = projections.stage_prices(raw.withColumn("out_domain", shifted))
    return comparable(models.deduplicated_prices(rows).filter(checks.domains_differ()))


def _parsed(make, spec):
    def frame(spark: SparkSession, sf_dir: str) -> DataFrame:
        return documents.parse(make(_events(spark, sf_dir)), spec)

    return frame


def _points(make, spec) -> Query:
    frame = _parsed(make, spec)
    return lambda spark, sf_dir: comparable(documents.flatten(frame(spark, sf_dir), spec))


def encoded_points(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Points of documents in several encodings, and of some with internal entities."""
    made = made_documents.encoded_load_documents(_events(spark, sf_dir)).drop("event_id")
    return comparable(documents.flatten(documents.parse(made, documents.LOAD), documents.LOAD))


def json_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """JSON lines of all RAW rows of the three datasets."""
    ev = _events(spark, sf_dir)
    parts = [
        json_sink.encoded(raw(ev)).select(F.lit(dataset.name).alias("dataset"), "line")
        for dataset, raw in _RAW.items()
    ]
    return parts[0].unionByName(parts[1]).unionByName(parts[2])


def json_round_trip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """RAW prices written as JSON lines and read back; every third line is spoilt.

    Lines are spoilt by event_id, which is part of the series' name, in three ways.
    """
    path, schema = _folder(spark, "json"), schemas.PRICES.schema
    json_sink.write_rows(bridge.raw_prices(_events(spark, sf_dir)), path)
    lines = spark.read.text(path).select(F.col("value").alias("line"))
    number = F.regexp_extract("line", r'"time_series_mrid":"s([0-9]+)"', 1).cast("bigint") % 9
    spoilt = (
        F.when(number == 0, F.regexp_replace("line", '"position":([0-9]+)', '"position":"$1"'))
        .when(number == 3, F.regexp_replace("line", '"auction_type"', '"auctiontype"'))
        .when(number == 6, F.concat("line", F.lit(" {}")))
        .otherwise(F.col("line"))
    )
    decoded = json_rows.decoded(lines.select(spoilt.alias("line")), schema).drop("line")
    # Good and spoilt lines are told apart in one reading.
    path = _folder(spark, "decoded")
    decoded.write.parquet(path)
    read = spark.read.schema(decoded.schema).parquet(path)
    good = comparable(json_rows.accepted(read, schema)).withColumn("errors", F.lit(None).cast("string"))
    bad = read.where(F.size("errors") > 0).select(F.array_join("errors", "; ").alias("errors"))
    return good.unionByName(bad, allowMissingColumns=True)


def quarantine(spark: SparkSession, sf_dir: str) -> DataFrame:
    parsed = _parsed(made_documents.damaged_price_documents, documents.PRICES)(spark, sf_dir)
    return documents.rejected(parsed).select(
        "source_object_name",
        F.element_at("errors", 1).alias("first_error"),
        F.size("errors").cast("bigint").alias("error_count"),
    )


def accepted_points(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What the damaged document set still delivers, per document."""
    parsed = _parsed(made_documents.damaged_price_documents, documents.PRICES)(spark, sf_dir)
    return comparable(
        documents.flatten(parsed, documents.PRICES)
        .groupBy("source_object_name")
        .agg(F.count("*").alias("point_count"), F.sum("price_amount").alias("price_sum"))
    )


def zone_lookup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Points per zone of the dimension; events are spread over the zones by user."""
    codes = F.array(*[F.lit(code) for _, _, code in zones.ZONES])
    index = (F.col("user_id") % len(zones.ZONES) + 1).cast("int")
    counted = (
        _events(spark, sf_dir)
        .groupBy(F.element_at(codes, index).alias("eic_code"))
        .agg(F.count("*").alias("point_count"), F.sum("value").alias("value_sum"))
    )
    return comparable(zones.with_zone(counted, "eic_code"))


def manifest_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Requests that cover the days of the events table."""
    day = F.to_date("ts")
    bounds = _events(spark, sf_dir).agg(F.min(day).alias("first"), F.max(day).alias("last"))
    requests = manifest.request_manifest(manifest.daily_intervals(bounds, "first", "last"))
    return comparable(requests.withColumn("params", F.to_json("params")))


def interval_problems(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Interval validation over bounds written in several ways, one per event."""
    kind = F.col("event_id") % 5
    stamp = F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss")
    texts = _events(spark, sf_dir).select(
        "event_id",
        F.when(kind == 0, stamp).otherwise(F.concat(stamp, F.lit("+02:00"))).alias("start_text"),
        F.when(kind == 1, F.concat(stamp, F.lit("+02:00")))
        .when(kind == 2, F.concat(stamp, F.lit("+03:00")))
        .when(kind == 3, F.lit("tomorrow"))
        .otherwise(F.concat(stamp, F.lit("Z")))
        .alias("end_text"),
    )
    return comparable(manifest.parsed_intervals(texts, "start_text", "end_text"))


def _folder(spark: SparkSession, label: str) -> str:
    return work_folder(spark, f"query-{label}")


def _half(df: DataFrame, number: int) -> DataFrame:
    return df.filter(F.col("event_id") % 2 == number)


def landing_rerun(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two landings of all load documents; the second brings other payloads for the names."""
    documents = made_documents.load_documents(_events(spark, sf_dir))
    other = documents.withColumn("content", F.lit("<late/>").cast("binary"))
    root = _folder(spark, "landing")
    ingest.land(spark, _half(documents, 0), schemas.LOAD, root)
    again = ingest.land(spark, other, schemas.LOAD, root)
    kept = ingest.landed(spark, root).select(
        "source_object_name", F.sha2("content", 256).alias("payload_hash")
    )
    late = F.sha2(F.lit("<late/>").cast("binary"), 256)
    return again.join(kept, "source_object_name").select(
        "source_object_name", "stored", (F.col("payload_hash") == late).alias("is_late_payload")
    )


def append_rerun(spark: SparkSession, sf_dir: str) -> DataFrame:
    """RAW rows after a first batch, the same batch again, and a batch that overlaps it."""
    documents = made_documents.generation_documents(_events(spark, sf_dir))
    root = _folder(spark, "append")
    for rows, batch in ((_half(documents, 0), "b1"), (_half(documents, 0), "b1"),
                        (documents, "b2")):
        ingest.ingest(spark, rows, schemas.GENERATION, root, batch)
    return comparable(tables.read_raw(spark, root, schemas.GENERATION))


def other_batch_after_a_broken_one(spark: SparkSession, sf_dir: str) -> DataFrame:
    """RAW rows after an attempt that wrote rows and ledger but no commit, and another batch."""
    made = made_documents.generation_documents(_events(spark, sf_dir))
    root, spec = _folder(spark, "broken"), documents.GENERATION
    ingest.ingest(spark, _half(made, 0), schemas.GENERATION, root, "x")
    lost = documents.parse(_half(made, 1), spec)
    key = "actual_generation-y-0"
    sinks.write_batch(
        documents.flatten(lost, spec), root, "actual_generation", key, schemas.GENERATION.layout
    )
    left = ingest.ledger(spark, root).withColumn("load_batch", F.lit(key))
    sinks.write_batch(left.drop("load_batch"), root, "ledger", key, None, ingest.FOLDERS)
    ingest.ingest(spark, made, schemas.GENERATION, root, "x-1")
    return comparable(tables.read_raw(spark, root, schemas.GENERATION))


def writers_at_once(spark: SparkSession, sf_dir: str) -> DataFrame:
    """RAW rows and landed objects after three overlapping batches that ran side by side."""
    made = made_documents.generation_documents(_events(spark, sf_dir))
    root = _folder(spark, "writers")
    parts = {"x": _half(made, 0), "y": _half(made, 1), "all": made}
    with ThreadPoolExecutor(len(parts)) as pool:
        runs = [
            pool.submit(ingest.ingest, spark, rows, schemas.GENERATION, root, batch)
            for batch, rows in parts.items()
        ]
        for run in runs:
            run.result()
    rows = tables.read_raw(spark, root, schemas.GENERATION)
    landed = ingest.landed(spark, root).groupBy("source_object_name").agg(F.count("*").alias("landed"))
    return comparable(rows.join(landed, "source_object_name"))


def rows_of_one_batch(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows of batch ``x`` beside a batch whose name begins alike."""
    made = made_documents.generation_documents(_events(spark, sf_dir))
    root = _folder(spark, "batches")
    ingest.ingest(spark, _half(made, 0), schemas.GENERATION, root, "x")
    ingest.ingest(spark, made, schemas.GENERATION, root, "x-1")
    return comparable(ingest.batch_rows(spark, root, schemas.GENERATION, "x"))


def provisioned(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows per RAW table right after provisioning, and after one of them got its documents."""
    root = _folder(spark, "provisioned")
    made = made_documents.load_documents(_events(spark, sf_dir))

    def counts(moment: str) -> DataFrame:
        parts = [
            tables.read_raw(spark, root, dataset).agg(
                F.lit(moment).alias("moment"), F.lit(name).alias("dataset"),
                F.count("*").alias("row_count"),
            )
            for name, dataset in schemas.DATASETS.items()
        ]
        return parts[0].unionByName(parts[1]).unionByName(parts[2])

    ingest.provision_raw(spark, root)
    path = _folder(spark, "counts")
    counts("provisioned").write.parquet(path)
    ingest.ingest(spark, made, schemas.LOAD, root, "b1")
    ingest.provision_raw(spark, root)
    return spark.read.parquet(path).unionByName(counts("loaded"))


# What becomes of a document by event_id % 7: text to replace, its replacement, the error.
OUT_OF_RANGE = {
    0: ("<position>3<", "<position>10000000000000<", "Point.instant: missing or invalid"),
    1: ("<position>3<", "<position>9223372036854775807<", "Point.instant: missing or invalid"),
    2: ("PT15M", "PT9223372036854775807H", "Period.resolution: missing or invalid"),
    3: ("<position>3<", "<position>99999999999999999999<", "Point.position: missing or invalid"),
}


def out_of_range(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Outcome of load documents of which some hold values no timestamp can take."""
    made = made_documents.load_documents(_events(spark, sf_dir))
    body, kind = F.col("content").cast("string"), F.col("event_id") % 7
    damaged = body
    for number, (old, new, _) in OUT_OF_RANGE.items():
        changed = F.replace(body, F.lit(old), F.lit(new))
        damaged = F.when(kind == number, changed).otherwise(damaged)
    rows = made.withColumn("content", damaged.cast("binary"))
    root = _folder(spark, "range")
    ingest.ingest(spark, rows, schemas.LOAD, root, "b1")
    points = tables.read_raw(spark, root, schemas.LOAD).groupBy("source_object_name").agg(
        F.count("*").alias("points")
    )
    reasons = ingest.quarantined(spark, root).select(
        "source_object_name", F.element_at("errors", 1).alias("reason"),
        F.size("errors").cast("bigint").alias("error_count"),
    )
    return points.join(reasons, "source_object_name", "full")


def ledger_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ledger of a batch of partly damaged documents, and of the whole set after it."""
    documents = made_documents.damaged_price_documents(_events(spark, sf_dir))
    root = _folder(spark, "ledger")
    ingest.ingest(spark, _half(documents, 0), schemas.PRICES, root, "b1")
    return ingest.ingest(spark, documents, schemas.PRICES, root, "b2").select(
        "load_id", "dataset", "bidding_zone", "source_object_name", "stored", "status",
        "row_count",
    )


def streamed_points(spark: SparkSession, sf_dir: str) -> DataFrame:
    """RAW load rows after a stream over a landing table that grew between two runs."""
    documents = made_documents.load_documents(_events(spark, sf_dir))
    landing, root, state = (_folder(spark, n) for n in ("arrivals", "stream", "state"))
    columns = ["source_object_name", "content", "arrived_at"]
    for number in (0, 1):
        _half(documents, number).select(*columns).write.mode("append").parquet(landing)
        arrivals = spark.readStream.schema(documents.select(*columns).schema).parquet(landing)
        stream.ingest_stream(arrivals, schemas.LOAD, root, state).awaitTermination()
    return comparable(tables.read_raw(spark, root, schemas.LOAD))


def _stored_raw(spark: SparkSession, ev: DataFrame, label: str) -> str:
    root = _folder(spark, label)
    for dataset, rows in (
        (schemas.LOAD, bridge.raw_load(ev)),
        (schemas.GENERATION, bridge.raw_generation(ev)),
        (schemas.PRICES, bridge.raw_prices(ev)),
    ):
        sinks.write_batch(rows, root, dataset.name, "all", dataset.layout)
    return root


def partitioned_mart(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Daily load read back from the stored table for a range of days."""
    ev = _events(spark, sf_dir)
    raw_root = _stored_raw(spark, ev, "raw")
    root = _folder(spark, "marts")
    raw = tables.read_raw(spark, raw_root, schemas.LOAD)
    built = marts.build_chain(spark, raw, marts.CHAINS[0], root)
    schema = built["agg_daily_load"].schema
    layout = schemas.MART_LAYOUTS["agg_daily_load"]
    path = f"{root}/agg_daily_load"
    return comparable(
        tables.read_table(spark, path, schema, layout, "2024-01-05", "2024-01-11")
    )


def _refreshed(number: int, table: str) -> Query:
    """Stored table after the later half of the events came in as a second batch."""

    def query(spark: SparkSession, sf_dir: str) -> DataFrame:
        ev = _events(spark, sf_dir)
        raw_root = _stored_raw(spark, _half(ev, 0), "raw")
        root = _folder(spark, "marts")
        chain = marts.CHAINS[number]
        raw = tables.read_raw(spark, raw_root, chain.dataset)
        built = marts.build_chain(spark, raw, chain, root)
        shape = {
            "actual_load": bridge.raw_load,
            "actual_generation": bridge.raw_generation,
            "day_ahead_prices": bridge.raw_prices,
        }[chain.dataset.name]
        changed = shape(_half(ev, 1))
        sinks.write_batch(changed, raw_root, chain.dataset.name, "late", chain.dataset.layout)
        marts.refresh_chain(spark, raw_root, chain, root, changed)
        return comparable(
            tables.read_table(
                spark, f"{root}/{table}", built[table].schema, schemas.MART_LAYOUTS[table]
            )
        )

    return query


def _clean_raw(spark: SparkSession, ev: DataFrame, load: DataFrame) -> str:
    """RAW tables that pass every check: one zone column, one resolution, one document per
    series."""
    clean = (
        bridge.raw_generation(ev, F.lit("PT60M"))
        .withColumn("_zone", F.coalesce("in_bidding_zone", "out_bidding_zone", F.lit("Z0")))
        .withColumns({"in_bidding_zone": F.col("_zone"),
                      "out_bidding_zone": F.lit(None).cast("string")})
        .drop("_zone")
    )
    prices = bridge.raw_prices(ev).withColumn("document_mrid", F.col("time_series_mrid"))
    raw_root = _folder(spark, "raw")
    for dataset, rows in ((schemas.LOAD, load), (schemas.GENERATION, clean),
                          (schemas.PRICES, prices)):
        sinks.write_batch(rows, raw_root, dataset.name, "b1", dataset.layout)
    return raw_root


def published_refresh(table: str) -> Query:
    """A published load table after a checked refresh with the later half of the events."""

    def query(spark: SparkSession, sf_dir: str) -> DataFrame:
        ev = _events(spark, sf_dir)
        raw_root = _clean_raw(spark, ev, bridge.raw_load(_half(ev, 0)))
        root = _folder(spark, "published")
        marts.build_and_publish(spark, raw_root, root, "r1")
        late = bridge.raw_load(_half(ev, 1))
        sinks.write_batch(late, raw_root, "actual_load", "b2", schemas.LOAD.layout)
        marts.refresh_and_publish(spark, raw_root, root, "r2", {"actual_load": late})
        return comparable(marts.read_published(spark, root, table))

    return query


def folded_refreshes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Published daily load after two refreshes whose attempts were then folded into one."""
    ev = _events(spark, sf_dir)
    raw_root = _clean_raw(spark, ev, bridge.raw_load(_half(ev, 0)))
    root = _folder(spark, "published")
    marts.build_and_publish(spark, raw_root, root, "r1")
    late = bridge.raw_load(_half(ev, 1))
    first = F.pmod(F.dayofyear("point_timestamp"), F.lit(2)) == 0
    for run, rows in (("r2", late.filter(first)), ("r3", late.filter(~first))):
        sinks.write_batch(rows, raw_root, "actual_load", run, schemas.LOAD.layout)
        marts.refresh_and_publish(spark, raw_root, root, run, {"actual_load": rows})
    marts.fold_published(spark, root, "folded", min_days=1000)
    return comparable(marts.read_published(spark, root, "agg_daily_load"))


def refused_refresh(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Published daily load after a refresh whose second resolution breaks the daily grain."""
    ev = _events(spark, sf_dir)
    raw_root = _clean_raw(spark, ev, bridge.raw_load(ev))
    root = _folder(spark, "published")
    marts.build_and_publish(spark, raw_root, root, "r1")
    late = bridge.raw_load(ev, F.lit("PT30M")).withColumn("revision_number", F.lit(9).cast("bigint"))
    late = late.filter("position % 2 = 1")
    sinks.write_batch(late, raw_root, "actual_load", "b2", schemas.LOAD.layout)
    marts.refresh_and_publish(spark, raw_root, root, "r2", {"actual_load": late})
    return comparable(marts.read_published(spark, root, "agg_daily_load"))


def publish_gate(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Publication log after a clean run, a run whose checks fail, and the first name again."""
    ev = _events(spark, sf_dir)
    raw_root, root = _clean_raw(spark, ev, bridge.raw_load(ev)), _folder(spark, "published")
    marts.build_and_publish(spark, raw_root, root, "r1")
    sinks.write_batch(
        bridge.raw_generation(ev), raw_root, "actual_generation", "b2", schemas.GENERATION.layout
    )
    marts.build_and_publish(spark, raw_root, root, "r2")
    marts.build_and_publish(spark, raw_root, root, "r1")
    log = marts.publication_log(spark, root)
    current = F.lit(marts.published_folder(spark, root))
    rows = marts.read_published(spark, root, "fct_generation_by_type").count()
    return log.select(
        "run", "passed", (F.col("folder") == current).alias("is_current"),
        F.lit(rows).cast("bigint").alias("published_generation_rows"),
    )


def raw_scan(dataset: schemas.Dataset) -> Query:
    """RAW rows read back from a stored table for a range of days."""

    def query(spark: SparkSession, sf_dir: str) -> DataFrame:
        root = _stored_raw(spark, _events(spark, sf_dir), "raw")
        return comparable(tables.read_raw(spark, root, dataset, "2024-01-10", "2024-01-12"))

    return query


def views(spark: SparkSession, sf_dir: str) -> DataFrame:
    """SQL over the session views of the models."""
    ev = _events(spark, sf_dir)
    models.create_views(models.load_branch(bridge.raw_load(ev)))
    return comparable(spark.sql(
        "select bidding_zone, count(*) as days, sum(observed_interval_count) as points, "
        "sum(observed_energy_mwh) as energy_mwh, min(coverage_ratio) as lowest_coverage "
        "from agg_daily_load group by bidding_zone"
    ))


def empty_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ledger of documents of which every third has lost its points."""
    documents_ = made_documents.load_documents(_events(spark, sf_dir))
    body = F.col("content").cast("string")
    bare = F.regexp_replace(body, "<Point>.*?</Point>", "").cast("binary")
    content = F.when(F.col("event_id") % 3 == 0, bare).otherwise(F.col("content"))
    root = _folder(spark, "empty")
    ingest.ingest(
        spark, documents_.withColumn("content", content), schemas.LOAD, root, "b1"
    )
    reasons = ingest.quarantined(spark, root).select(
        "source_object_name", F.element_at("errors", 1).alias("reason")
    )
    rows = ingest.ledger(spark, root).select("source_object_name", "status", "row_count")
    return rows.join(reasons, "source_object_name", "left")


def durations(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The two readings of a duration: any ``PTnHnMnS``, and interval lengths of the KPIs."""
    n = (F.col("event_id") % 90).cast("string")
    kind = F.col("event_id") % 6
    written = (
        F.when(kind == 0, F.concat(F.lit("PT"), n, F.lit("M")))
        .when(kind == 1, F.concat(F.lit("PT"), n, F.lit("H")))
        .when(kind == 2, F.concat(F.lit("PT"), n, F.lit("H30M")))
        .when(kind == 3, F.concat(F.lit("PT"), n, F.lit("S")))
        .when(kind == 4, F.concat(F.lit("P"), n, F.lit("D")))
        .otherwise(F.concat(F.lit("PT1H"), n, F.lit("M5S")))
    )
    rows = _events(spark, sf_dir).select("event_id", written.alias("duration"))
    minutes = measures.interval_minutes(F.col("duration"))
    return rows.select(
        "event_id", "duration",
        text.duration_seconds(F.col("duration")).alias("seconds"),
        minutes.alias("interval_minutes"),
        measures.rounded_ratio(F.lit(measures.MINUTES_PER_DAY), minutes).alias("per_day"),
    )


_RAW = {
    schemas.LOAD: bridge.raw_load,
    schemas.GENERATION: bridge.raw_generation,
    schemas.PRICES: bridge.raw_prices,
}

QUERIES: dict[str, Query] = {
    "prj1_stg_load": _load("stg_actual_load"),
    "prj2_stg_generation": _generation("stg_actual_generation"),
    "prj3_stg_price": _price("stg_day_ahead_prices"),
    "prj4_generation_direction": _generation("int_actual_generation_normalized"),
    "win1_load_canonical": _load("int_actual_load_canonical"),
    "win2_generation_canonical": _generation("int_actual_generation_canonical"),
    "win3_price_dedup": _price("int_day_ahead_prices_deduplicated"),
    "win4_price_canonical": _price("int_day_ahead_prices_canonical"),
    "win4_price_canonical_one_shuffle": price_from_staged,
    "win_latest_lineitem": lineitem_latest,
    "win1_hot_key": hot_key("int_actual_load_canonical"),
    "agg1_hot_key": hot_key("agg_daily_load"),
    "prj5_fct_load": _load("fct_actual_load"),
    "prj6_fct_generation": _generation("fct_generation_by_type"),
    "prj7_fct_price": _price("fct_day_ahead_prices"),
    "agg1_daily_load": _load("agg_daily_load"),
    "agg2_daily_generation": _generation("agg_daily_generation_by_type"),
    "agg3_daily_price": _price("agg_daily_day_ahead_prices"),
    "agg1_mixed_resolution": _load("agg_daily_load", bridge.mixed_resolution),
    "agg2_mixed_resolution": _generation(
        "agg_daily_generation_by_type", bridge.mixed_resolution
    ),
    "agg3_mixed_resolution": _price("agg_daily_day_ahead_prices", bridge.mixed_resolution),
    "q0_not_null": not_null,
    "q1_load_duplicates": _duplicates("stg_actual_load", schemas.LOAD_GRAIN),
    "q2_generation_duplicates": _duplicates(
        "int_actual_generation_normalized", schemas.GENERATION_GRAIN
    ),
    "q3_single_zone": _check(
        "int_actual_generation_normalized", lambda df: df.filter(checks.not_single_zone())
    ),
    "q4_domains_match": domain_mismatches,
    "q5_unequal_duplicates": _check(
        "stg_day_ahead_prices",
        lambda df: checks.unequal_duplicates(
            df, schemas.PRICE_DUPLICATE_KEYS, schemas.PRICE_PAYLOAD
        ),
    ),
    "q6_price_duplicates": _duplicates("stg_day_ahead_prices", schemas.PRICE_DUPLICATE_KEYS),
    "q7_price_grain_duplicates": _duplicates(
        "int_day_ahead_prices_deduplicated", schemas.PRICE_GRAIN
    ),
    "q8_fct_load_unique": _repeated(
        "fct_actual_load", schemas.LOAD_GRAIN, "hour(point_timestamp) = 3"
    ),
    "q9_fct_generation_unique": _repeated(
        "fct_generation_by_type", schemas.GENERATION_GRAIN, "hour(point_timestamp) = 3"
    ),
    "q10_fct_price_unique": _repeated(
        "fct_day_ahead_prices", schemas.PRICE_FACT_GRAIN, "hour(point_timestamp) = 3"
    ),
    "q11_daily_price_unique": _repeated(
        "agg_daily_day_ahead_prices", schemas.DAILY_PRICE_GRAIN, "day(delivery_date) < 9"
    ),
    "q12_daily_load_duplicates": _duplicates("agg_daily_load", schemas.DAILY_LOAD_GRAIN),
    "q13_daily_generation_duplicates": _duplicates(
        "agg_daily_generation_by_type", schemas.DAILY_GENERATION_GRAIN
    ),
    "q14_daily_load_validity": overcounted_load_days,
    "q15_daily_generation_validity": overcounted_generation_days,
    "q16_daily_price_validity": overcounted_price_days,
    "quality_report": report,
    "src1_load_xml": _points(made_documents.load_documents, documents.LOAD),
    "src1_load_encodings": encoded_points,
    "src2_generation_xml": _points(made_documents.generation_documents, documents.GENERATION),
    "src3_price_xml": _points(made_documents.price_documents, documents.PRICES),
    "src3_quarantine": quarantine,
    "src3_accepted_points": accepted_points,
    "src4_raw_scan": raw_scan(schemas.PRICES),
    "src4_raw_scan_load": raw_scan(schemas.LOAD),
    "src4_raw_scan_generation": raw_scan(schemas.GENERATION),
    "src_out_of_range": out_of_range,
    "src5_zones": zone_lookup,
    "src6_manifest": manifest_rows,
    "src8_interval_validation": interval_problems,
    "snk1_landing_rerun": landing_rerun,
    "snk2_append_rerun": append_rerun,
    "snk2_broken_then_other_batch": other_batch_after_a_broken_one,
    "snk2_rows_of_one_batch": rows_of_one_batch,
    "snk2_writers_at_once": writers_at_once,
    "snk2_json_lines": json_lines,
    "snk2_json_round_trip": json_round_trip,
    "snk4_provisioned": provisioned,
    "snk3_empty_documents": empty_documents,
    "snk5_views": views,
    "snk7_partitioned_mart": partitioned_mart,
    "snk8_ledger": ledger_rows,
    "incremental_load_facts": _refreshed(0, "fct_actual_load"),
    "incremental_daily_load": _refreshed(0, "agg_daily_load"),
    "incremental_generation_facts": _refreshed(1, "fct_generation_by_type"),
    "incremental_daily_generation": _refreshed(1, "agg_daily_generation_by_type"),
    "incremental_price_facts": _refreshed(2, "fct_day_ahead_prices"),
    "incremental_daily_price": _refreshed(2, "agg_daily_day_ahead_prices"),
    "publish_gate": publish_gate,
    "publish_refresh_load_facts": published_refresh("fct_actual_load"),
    "publish_refresh_daily_load": published_refresh("agg_daily_load"),
    "publish_folded_daily_load": folded_refreshes,
    "publish_refused_refresh": refused_refresh,
    "fn_durations": durations,
    "str1_stream_load": streamed_points,
}

"""Market documents made from ``events``, one document per event.

Each document has two series of one period each. The first one has two points with a
missing position between them; the second one gives its bounds with a UTC offset.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from wattline.functions import text
from wattline.sources.bridge import zone

_NAMESPACE = "urn:iec62325.351:tc57wg16:451-6:generationloaddocument:3:0"


def _tag(name: str, *content: Column | str) -> Column:
    inner = [F.lit(c) if isinstance(c, str) else c for c in content]
    return F.concat(F.lit(f"<{name}>"), *inner, F.lit(f"</{name}>"))


def _amount(value: Column) -> Column:
    return value.cast("decimal(12,2)").cast("string")


def _point(position: int | str, amount_tag: str, value: Column) -> Column:
    return _tag("Point", _tag("position", str(position)), _tag(amount_tag, _amount(value)))


def _period(interval_tag: str, start: Column, end: Column, resolution: str, *points: Column):
    interval = _tag(interval_tag, _tag("start", start), _tag("end", end))
    return _tag("Period", interval, _tag("resolution", resolution), *points)


def hour_start() -> Column:
    return F.date_trunc("hour", "ts")


def _utc(instant: Column) -> Column:
    return F.date_format(instant, "yyyy-MM-dd'T'HH:mm'Z'")


def _two_hours_east(instant: Column) -> Column:
    return F.date_format(instant + F.expr("interval 2 hours"), "yyyy-MM-dd'T'HH:mm:ss'+02:00'")


def _header(document_type: str, *extra: Column) -> list[Column]:
    created = F.date_format(F.date_trunc("second", "ts"), "yyyy-MM-dd'T'HH:mm:ss'Z'")
    return [
        _tag("mRID", F.concat(F.lit("d"), F.col("event_id").cast("string"))),
        _tag("revisionNumber", (F.col("event_id") % 3 + 1).cast("string")),
        _tag("type", document_type),
        *extra,
        _tag("createdDateTime", created),
    ]


def _series(suffix: str, *parts: Column) -> Column:
    name = F.concat(F.lit("s"), F.col("event_id").cast("string"), F.lit(suffix))
    return _tag("TimeSeries", _tag("mRID", name), *parts)


def _document(root: str, *parts: Column) -> Column:
    prolog = f'<?xml version="1.0" encoding="UTF-8"?>\n<{root} xmlns="{_NAMESPACE}">'
    return F.concat(F.lit(prolog), *parts, F.lit(f"</{root}>\n"))


# Documents of one part, some 200 MB.
_PART = 100_000


def _spread(events: DataFrame) -> DataFrame:
    """The same events over all cores: a few bytes each become a document of 2 kB, and a part
    of the table that is small to read is much to parse. Parts hold a bounded number of documents,
    so that those of a task can be sorted in memory."""
    cores = events.sparkSession.sparkContext.defaultParallelism
    parts = max(3 * cores, -(-events.count() // _PART))
    return events.repartition(parts, "event_id", "ts")


def _named(df: DataFrame, dataset: str, xml: Column) -> DataFrame:
    """Object names carry the event id as a directory below the day, so they are unique."""
    name = text.object_name(
        dataset, zone(), hour_start(), hour_start() + F.expr("interval 1 hour")
    )
    unique = F.concat(
        F.substring_index(name, "/", 6), F.lit("/"), F.col("event_id").cast("string"), F.lit("/"),
        F.substring_index(name, "/", -1),
    )
    return _spread(df).select(
        unique.alias("source_object_name"),
        xml.cast("binary").alias("content"),
        F.col("ts").alias("arrived_at"),
        "event_id",
    )


def _quantity_periods(amount: str = "quantity", second_interval: str = "timeInterval"):
    start = hour_start()
    end = start + F.expr("interval 1 hour")
    value = F.col("value")
    first = _period(
        "timeInterval", _utc(start), _utc(end), "PT15M",
        _point(1, amount, value), _point(3, amount, value + 1),
    )
    second = _period(
        second_interval, _two_hours_east(start), _two_hours_east(end), "PT1H",
        _point(1, amount, value + 2),
    )
    return first, second


def load_xml() -> Column:
    def series(suffix: str, period: Column) -> Column:
        return _series(
            suffix,
            _tag("businessType", "A04"),
            _tag("objectAggregation", "A01"),
            _tag("outBiddingZone_Domain.mRID", zone()),
            _tag("quantity_Measure_Unit.name", "MAW"),
            _tag("curveType", "A03"),
            period,
        )

    first, second = _quantity_periods()
    return _document(
        "GL_MarketDocument",
        *_header("A65", _tag("process.processType", "A16")),
        series("-a", first), series("-b", second),
    )


def generation_xml() -> Column:
    def series(suffix: str, zone_tag: str, period: Column) -> Column:
        return _series(
            suffix,
            _tag("businessType", "A01"),
            _tag("objectAggregation", "A08"),
            _tag(zone_tag, zone()),
            _tag("quantity_Measure_Unit.name", "MAW"),
            _tag("curveType", "A03"),
            _tag("MktPSRType", _tag("psrType", F.col("event_type"))),
            period,
        )

    first, second = _quantity_periods()
    return _document(
        "GL_MarketDocument",
        *_header("A75", _tag("process.processType", "A16")),
        series("-a", "outBiddingZone_Domain.mRID", first),
        series("-b", "inBiddingZone_Domain.mRID", second),
    )


def price_xml() -> Column:
    sequence = F.col("user_id") % 3
    classification = F.when(sequence == 0, F.lit("")).otherwise(
        _tag(
            "classificationSequence_AttributeInstanceComponent.position",
            sequence.cast("string"),
        )
    )

    def series(suffix: str, period: Column) -> Column:
        return _series(
            suffix,
            _tag("auction.type", "A01"),
            _tag("businessType", "A62"),
            _tag("in_Domain.mRID", zone()),
            _tag("out_Domain.mRID", zone()),
            _tag("contract_MarketAgreement.type", "A01"),
            _tag("currency_Unit.name", "EUR"),
            _tag("price_Measure_Unit.name", "MWH"),
            classification,
            _tag("curveType", "A03"),
            period,
        )

    first, second = _quantity_periods("price.amount", "period.timeInterval")
    return _document(
        "Publication_MarketDocument", *_header("A44"), series("-a", first), series("-b", second)
    )


def load_documents(events: DataFrame) -> DataFrame:
    return _named(events, "actual_load", load_xml())


def encoded_load_documents(events: DataFrame) -> DataFrame:
    """The load documents in six forms by event_id % 6: UTF-8, both orders of UTF-16, two
    single-byte encodings with a byte that only they read so, and internal entities."""
    xml, kind = load_xml(), F.col("event_id") % 6

    def declared(encoding: str) -> Column:
        return F.replace(xml, F.lit('"UTF-8"'), F.lit(f'"{encoding}"'))

    def curve(text_: Column, code: str) -> Column:
        return F.replace(text_, F.lit(">A03<"), F.lit(f">{code}<"))

    marked = F.concat(F.lit("\ufeff"), curve(declared("UTF-16"), "\u0141A03"))
    declarations = (
        '?>\n<!DOCTYPE GL_MarketDocument [<!ENTITY a "&u;03">\n<!ENTITY u "A"> <!ENTITY u "B">]>'
    )
    content = (
        F.when(kind == 0, F.encode(marked, "UTF-16LE"))
        .when(kind == 1, F.encode(marked, "UTF-16BE"))
        .when(kind == 2, F.encode(curve(declared("windows-1252"), "\x80A03"), "ISO-8859-1"))
        .when(kind == 3, F.encode(curve(declared("iso-8859-2"), "\xa3A03"), "ISO-8859-1"))
        .when(kind == 4, F.encode(F.replace(curve(xml, "&a;"), F.lit("?>"), F.lit(declarations)), "UTF-8"))
        .otherwise(F.encode(xml, "UTF-8"))
    )
    return _named(events, "actual_load", content)


def generation_documents(events: DataFrame) -> DataFrame:
    return _named(events, "actual_generation", generation_xml())


def price_documents(events: DataFrame) -> DataFrame:
    return _named(events, "day_ahead_prices", price_xml())


# Defect of a document by event_id % 11, and the error it must be rejected with.
DEFECTS = {
    0: ("<createdDateTime>", "<createdDateTime>x", "createdDateTime: missing or invalid"),
    1: ("<mRID>d", "<mRID> </mRID><mRID>d", "mRID: missing or invalid"),
    2: ("<position>3<", "<position>0<", "Point.position: missing or invalid"),
    3: ("PT15M", "P15M", "Period.resolution: missing or invalid"),
    4: ("timeInterval>", "interval>", "Period.start: missing or invalid"),
    5: ("</Period>", "", "document: not well-formed XML"),
    6: ("<price.amount>", "<price.amount>x", "Point.price.amount: missing or invalid"),
    7: ("</Publication_MarketDocument>", "</Publication_MarketDocument>junk",
        "document: not well-formed XML"),
    8: ("<curveType>A03", "<curveType>", "TimeSeries.curveType: missing or invalid"),
}


def damaged_price_documents(events: DataFrame) -> DataFrame:
    """All price documents; nine of eleven have a defect."""
    documents = price_documents(events)
    body = F.col("content").cast("string")
    kind = F.col("event_id") % 11
    damaged = body
    for number, (old, new, _) in DEFECTS.items():
        damaged = F.when(kind == number, F.replace(body, F.lit(old), F.lit(new))).otherwise(
            damaged
        )
    return documents.withColumn("content", damaged.cast("binary"))

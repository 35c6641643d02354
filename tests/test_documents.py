from datetime import datetime
from decimal import Decimal

import pytest
import xml_samples as x
from pyspark.sql import functions as F

from verification import made_documents
from wattline.sources import documents as d

SPECS = {"load": d.LOAD, "generation": d.GENERATION, "prices": d.PRICES}


def parse(spark, spec, *texts):
    rows = [
        (f"o{i}", t if isinstance(t, (bytes, type(None))) else t.encode())
        for i, t in enumerate(texts)
    ]
    rows = [(n, bytearray(t) if t is not None else None) for n, t in rows]
    frame = spark.createDataFrame(rows, "source_object_name string, content binary")
    return d.parse(frame, spec)


def points(spark, spec, *texts):
    rows = d.flatten(parse(spark, spec, *texts), spec)
    return rows.orderBy("source_object_name", "time_series_mrid", "position").collect()


def errors(spark, spec, *texts):
    found = d.rejected(parse(spark, spec, *texts)).collect()
    return {r.source_object_name: list(r.errors) for r in found}


def utc(*parts):
    return datetime(2025, *parts)


def naive(spark, df):
    """Timestamps as UTC wall time, whatever the zone of this process."""
    stamps = [f.name for f in df.schema.fields if f.dataType.typeName() == "timestamp"]
    return df.withColumns({c: F.col(c).cast("timestamp_ntz") for c in stamps})


def test_load_points_and_gap(spark):
    rows = naive(spark, d.flatten(parse(spark, d.LOAD, x.load()), d.LOAD)).orderBy("position")
    first, second = rows.collect()
    assert rows.columns == d.LOAD.dataset.schema.fieldNames()
    assert first.asDict() == {
        "source_object_name": "o0", "document_mrid": "L-77", "document_type": "A65",
        "revision_number": 1, "document_created_at": utc(3, 12, 14, 5, 9),
        "process_type": "A16", "time_series_mrid": "ts-7a", "business_type": "A04",
        "object_aggregation": "A01", "out_bidding_zone": x.ZONE, "quantity_unit": "MAW",
        "curve_type": "A03", "period_start": utc(3, 10), "period_end": utc(3, 10, 1),
        "resolution": "PT15M", "position": 1, "point_timestamp": utc(3, 10),
        "quantity": Decimal("412.750000000"),
    }
    # Position 2 is missing; position 3 keeps its own time.
    assert (second.position, second.point_timestamp) == (3, utc(3, 10, 0, 30))
    assert second.quantity == Decimal("398.2")


def test_generation_keeps_direction(spark):
    rows = points(spark, d.GENERATION, x.generation())
    got = [(r.time_series_mrid, r.position, r.in_bidding_zone, r.out_bidding_zone,
            r.psr_type, str(r.quantity.normalize())) for r in rows]
    assert got == [
        ("ts-drawn", 1, x.ZONE, None, "B10", "7.15"),
        ("ts-fed", 1, None, x.ZONE, "B10", "51.35"),
        ("ts-fed", 3, None, x.ZONE, "B10", "48.9"),
    ]


def test_prices_with_either_interval_element(spark):
    texts = (x.prices(), x.prices(interval="period.timeInterval"))
    frame = naive(spark, d.flatten(parse(spark, d.PRICES, *texts), d.PRICES))
    every = frame.orderBy("source_object_name", "time_series_mrid", "position").collect()
    assert [r[1:] for r in every[:4]] == [r[1:] for r in every[4:]]
    rows = every[:4]
    got = [(r.time_series_mrid, r.classification_sequence_position, r.position,
            r.point_timestamp, float(r.price_amount)) for r in rows]
    assert got == [
        ("auction-1", 2, 24, utc(3, 10, 3, 45), 88.41),
        ("auction-1", 2, 26, utc(3, 10, 4, 15), 91.07),
        ("auction-2", 1, 24, utc(3, 10, 3, 45), 88.41),
        ("auction-2", 1, 26, utc(3, 10, 4, 15), 91.07),
    ]
    assert rows[0].period_start == utc(3, 9, 22)


def test_classification_is_optional_but_positive(spark):
    absent = x.prices(classes=(None, None))
    empty = x.prices(classes=("", None))
    assert {r.classification_sequence_position for r in points(spark, d.PRICES, absent, empty)} \
        == {None}
    bad = errors(spark, d.PRICES, x.prices(classes=(0, 1)), x.prices(classes=("two", 1)))
    message = f"TimeSeries.{x.CLASSIFICATION}: missing or invalid"
    assert bad == {"o0": [message], "o1": [message]}


DEFECTS = [
    ("<mRID>L-77</mRID>", "<mRID> \n </mRID>", "mRID"),
    ("<mRID>L-77</mRID>", "", "mRID"),
    ("<type>A65</type>", "<type/>", "type"),
    ("<revisionNumber>1<", "<revisionNumber>1.5<", "revisionNumber"),
    ("14:05:09Z", "14:05:09", "createdDateTime"),
    ("<process.processType>A16</process.processType>", "", "process.processType"),
    ("<mRID>ts-7a</mRID>", "", "TimeSeries.mRID"),
    ("<curveType>A03</curveType>", "<curveType> </curveType>", "TimeSeries.curveType"),
    ("<start>2025-03-10T00:00Z", "<start>2025-03-10T00:00", "Period.start"),
    ("<end>2025-03-10T01:00Z", "<end>soon", "Period.end"),
    ("PT15M", "P1D", "Period.resolution"),
    ("PT15M", "PT0M", "Period.resolution"),
    ("PT15M", "PT", "Period.resolution"),
    ("<position>3<", "<position>0<", "Point.position"),
    ("<position>3<", "<position>-1<", "Point.position"),
    ("<position>3</position>", "", "Point.position"),
    ("398.20", "a lot", "Point.quantity"),
    ("<quantity>398.20</quantity>", "", "Point.quantity"),
]


def test_one_bad_element_rejects_the_whole_document_only(spark):
    damaged = [x.load().replace(old, new) for old, new, _ in DEFECTS]
    assert x.load() not in damaged
    texts = [*damaged, x.load()]
    assert errors(spark, d.LOAD, *texts) == {
        f"o{i}": [f"{error}: missing or invalid"] for i, (_, _, error) in enumerate(DEFECTS)
    }
    assert {r.source_object_name for r in points(spark, d.LOAD, *texts)} == {f"o{len(damaged)}"}


def test_values_out_of_range_reject_their_document_only(spark):
    texts = [
        x.load().replace("<position>3<", "<position>10000000000000<"),
        x.load().replace("<position>3<", "<position>9223372036854775807<"),
        x.load().replace("PT15M", "PT9223372036854775807H"),
        x.load().replace("PT15M", "PT2000000000H"),
        x.load(),
    ]
    instant, resolution = "Point.instant", "Period.resolution"
    expected = [instant, instant, resolution, instant]
    assert errors(spark, d.LOAD, *texts) == {
        f"o{i}": [f"{e}: missing or invalid"] for i, e in enumerate(expected)
    }
    assert {r.source_object_name for r in points(spark, d.LOAD, *texts)} == {"o4"}


def named(encoding):
    return x.load().replace('encoding="UTF-8"', f'encoding="{encoding}"' if encoding else "")


def test_encodings(spark):
    cases = [
        ("ISO-8859-1", "latin-1", "Ä"), ("iso-8859-2", "iso8859-2", "Ł"), ("ISO8859-15", "iso8859-15", "€"),
        ("windows-1252", "cp1252", "€"), ("CP1250", "cp1250", "ž"), ("windows-1251", "cp1251", "Ж"),
        ("UTF-8", "utf-8-sig", "Ł"), ("UTF-16", "utf-16", "Ł😀"), ("", "utf-16", "Ł"),
        ("UTF-16BE", "utf-16-be", "😀Ł"), ("utf-16le", "utf-16-le", "\ud7ff\ue000😀😀"),
        ("", "utf-16-be", "€"),
    ]
    marks = [mark + "A03" + mark for _, _, mark in cases]
    texts = [named(e).replace("A03", m).encode(c) for (e, c, _), m in zip(cases, marks)]
    assert errors(spark, d.LOAD, *texts) == {}
    rows = points(spark, d.LOAD, *texts)
    assert {(r.source_object_name, r.curve_type) for r in rows} == {
        (f"o{i}", m) for i, m in enumerate(marks)
    }


def test_long_declarations_and_long_wide_documents(spark):
    spaced = x.load().replace('encoding="UTF-8"', " " * 300 + 'encoding="ISO-8859-1"')
    for text, codec in ((spaced, "latin-1"), (named("UTF-16"), "utf-16")):
        wide = text.replace("</TimeSeries>", "</TimeSeries><!--" + "Ä" * 300_000 + "-->")
        wide = wide if codec == "latin-1" else wide.replace("Ä", "😀")
        assert errors(spark, d.LOAD, wide.encode(codec)) == {}


def test_unsupported_encodings_keep_their_reason(spark):
    good = x.load()
    texts = [
        good.encode("utf-16"), named("UTF-16").encode(), named("UTF-16LE").encode("utf-16-be"),
        named("Shift_JIS").encode(), named("EBCDIC-CP-US").encode(), named("ISO-8859-12").encode(),
    ]
    reason = ["document: unsupported encoding"]
    assert errors(spark, d.LOAD, *texts) == {f"o{i}": reason for i in range(len(texts))}


def test_bytes_that_do_not_fit_their_encoding(spark):
    wide = named("UTF-16").encode("utf-16-le")
    comment = "<!--x-->".encode("utf-16-le")
    texts = [
        named("windows-1252").replace("A03", "?A03").encode().replace(b"?A03", b"\x81A03"),
        b"\xff\xfe" + wide + b"\n",  # cut off unit
        b"\xff\xfe" + wide + comment.replace(b"x\0", b"\x00\xd8"),  # first half alone
        b"\xff\xfe" + wide + comment.replace(b"x\0", b"\x00\xdc"),  # second half alone
        b"\xff\xfe" + wide + comment.replace(b"x\0", b"\x00\xdc\x00\xd8"),  # halves swapped
        b"\xff\xfe", b"\xfe\xff\x00",
    ]
    found = errors(spark, d.LOAD, *texts)
    assert found == {f"o{i}": ["document: not well-formed XML"] for i in range(len(texts))}


def declared(subset, body="&a;"):
    prolog, rest = x.load().replace("A03", body).split("\n", 1)
    return f"{prolog}\n<!DOCTYPE GL_MarketDocument {subset}>\n{rest}"


def test_internal_entities(spark):
    cases = {
        "A03": declared('[<!ENTITY a "A03">]'),
        "one": declared("[<!ENTITY a 'one'> <!ENTITY a 'two'>]"),
        "x-y-x": declared('[<!ENTITY a "&b;-&c;-&b;"><!ENTITY b "x"><!ENTITY c "y">]'),
        "y-x": declared('[<!ENTITY b "x"><!ENTITY c "y-&b;"><!ENTITY a "&c;">]'),
        "äz": declared('[<!-- <!ENTITY a "no"> --><!ENTITY a "&#228;z">]'),
        "p&q": declared('[<!ENTITY a "p&amp;q">]'),
        "$1\\x": declared('[<!ENTITY a "$1\\x">]'),
        "plain": declared("", "plain"),
        "sys": declared('SYSTEM "http://nowhere/x.dtd"', "sys"),
        "sub": declared('SYSTEM "x>[y].dtd" [<!ELEMENT mRID (#PCDATA)><!ENTITY a "sub">] '),
        "é": declared('[<!ENTITY a "é">]').replace("UTF-8", "ISO-8859-15").encode("iso8859-15"),
    }
    assert errors(spark, d.LOAD, *cases.values()) == {}
    rows = points(spark, d.LOAD, *cases.values())
    assert {(r.source_object_name, r.curve_type) for r in rows} == {
        (f"o{i}", curve) for i, curve in enumerate(cases)
    }


def test_entities_that_stay_out(spark):
    nested = "".join(f'<!ENTITY e{i} "{f"&e{i - 1};" * 10}">' for i in range(1, 12))
    texts = [
        declared("[]"), declared('[<!ENTITY a "&a;">]'), declared('[<!ENTITY a "&b;"><!ENTITY b "&a;">]'),
        declared('[<!ENTITY a SYSTEM "file:///etc/hostname">]'),
        declared('[<!ENTITY a "&#38;lt;">]'), declared('[<!ENTITY a "&#x3c;x/>">]'),
        declared('[<!ENTITY % p "x"><!ENTITY a "%p;">]'), declared('[<!ENTITY a "x">]', "<![CDATA[&a;]]>"),
        declared(f'[<!ENTITY e0 "{"x" * 10}">{nested}]', "&e11;"),
    ]
    found = errors(spark, d.LOAD, *texts)
    assert found == {f"o{i}": ["document: not well-formed XML"] for i in range(len(texts))}


def test_names_come_from_the_place_below_the_root(spark, tmp_path):
    root = tmp_path / "data"
    for place in ("one.xml", "x/mydata/one.xml", "data/one.xml"):
        (root / place).parent.mkdir(parents=True, exist_ok=True)
        (root / place).write_text(x.load())
    expected = {"one.xml", "x/mydata/one.xml", "data/one.xml"}
    for path in (str(root), f"{root}/", f"file:{root}", f"file://{root}/"):
        rows = d.read_documents(spark, path).collect()
        assert {r.source_object_name for r in rows} == expected
    stream = d.stream_documents(spark, f"{root}/").writeStream.format("memory")
    stream.queryName("names").trigger(availableNow=True).start().awaitTermination()
    assert {r.source_object_name for r in spark.table("names").collect()} == expected
    elsewhere = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(str(root))
    with pytest.raises(Exception, match="not below"):
        d.name_objects(elsewhere, str(root / "x")).collect()
    with pytest.raises(ValueError):
        d.read_documents(spark, f"{root}/*")


def test_not_well_formed(spark):
    good = x.load()
    texts = [
        good + "junk", good + good.split("\n")[1], good.replace("</Period>", ""), "", "text",
        None, good.encode() + b"\xff\xfe", good.replace("</mRID>", "</mRIX>", 1),
    ]
    found = errors(spark, d.LOAD, *texts)
    assert found == {f"o{i}": ["document: not well-formed XML"] for i in range(len(texts))}


def test_lenient_forms_are_accepted(spark):
    good = x.load()
    prefixed = good.split("\n")[1].replace("</", "</p:").replace("<", "<p:")
    prefixed = prefixed.replace("<p:/p:", "</p:").replace("xmlns=", "xmlns:p=")
    repeated = good.replace("<mRID>L-77<", "<mRID>first</mRID><mRID>second<")
    texts = [
        prefixed,
        good.replace("GL_MarketDocument", "AnyRoot"),
        good + "\n<!-- end -->\n",
        good.replace("</GL_MarketDocument>", "</GL_MarketDocument >"),
        good.replace("L-77", "\n  L-77\t"),
        good.replace("2025-03-10T00:00Z", "2025-03-10T02:00:00.000+02:00"),
        good.replace("UTF-8", "ISO-8859-1").replace("A03", "Ä03").encode("latin-1"),
        repeated,
        good.replace("<mRID>series", '<mRID codingScheme="A01">series'),
        good.replace("PT15M", "PT0H15M0S"),
    ]
    assert errors(spark, d.LOAD, *texts) == {}
    rows = [r for r in points(spark, d.LOAD, *texts) if r.position == 3]
    assert len(rows) == len(texts)
    by_name = {r.source_object_name: r for r in rows}
    assert {r.point_timestamp for r in rows} == {by_name["o0"].point_timestamp}
    assert by_name["o6"].curve_type == "Ä03"
    assert by_name["o7"].document_mrid == "first"
    assert {r.time_series_mrid for r in rows} == {"ts-7a"}
    assert by_name["o4"].document_mrid == "L-77"


def test_empty_branches_are_validated_but_give_no_rows(spark):
    no_series = x.document("D", "A65", "d", [])
    no_period = x.document("D", "A65", "d", [x.series("s", x.LOAD_PARTS)])
    no_points = x.document("D", "A65", "d", [
        x.series("s", x.LOAD_PARTS, x.period(*x.HOUR, "PT15M", []))])
    bad_series = x.document("D", "A65", "d", [x.series("s", x.LOAD_PARTS[1:])])
    texts = (no_series, no_period, no_points, bad_series)
    parsed = parse(spark, d.LOAD, *texts)
    assert d.flatten(parsed, d.LOAD).count() == 0
    assert errors(spark, d.LOAD, *texts) == {"o3": ["TimeSeries.businessType: missing or invalid"]}
    assert {r.point_count for r in parsed.filter("size(errors) = 0").collect()} == {0}
    refused = d.rejected(d.reject_empty(parsed)).collect()
    assert {(r.source_object_name, r.errors[0]) for r in refused if r.source_object_name != "o3"} \
        == {(f"o{i}", "document: no points") for i in range(3)}


def test_several_series_periods_and_points(spark):
    day = [x.period(f"2025-03-10T0{h}:00Z", f"2025-03-10T0{h + 1}:00Z", "PT30M",
                    [(1, h), (2, h + 0.5)]) for h in range(3)]
    text = x.document("D", "A65", "d", [
        x.series("a", x.LOAD_PARTS, *day), x.series("b", x.LOAD_PARTS, day[0])])
    rows = points(spark, d.LOAD, text)
    assert len(rows) == 8
    a = {float(r.quantity): r.point_timestamp for r in rows if r.time_series_mrid == "a"}
    assert (a[2.5] - a[0.0]).total_seconds() == 2.5 * 3600


def test_documents_are_parsed_once_also_under_a_filter(spark):
    parsed = parse(spark, d.PRICES, x.prices())
    for frame in (d.rejected(parsed), d.flatten(parsed, d.PRICES).filter("price_amount > 0")):
        plan = frame._jdf.queryExecution().executedPlan().toString()
        assert plan.count("from_xml(") == 1
        assert "Exchange" not in plan


def test_read_documents_names_objects_by_path(spark, tmp_path):
    name = "entsoe/actual_load/bidding_zone=Z/year=2026/month=08/day=20/a.xml"
    path = tmp_path / "store" / name
    path.parent.mkdir(parents=True)
    path.write_text(x.load())
    (path.parent / "note.txt").write_text("no document")
    rows = d.read_documents(spark, str(tmp_path / "store")).collect()
    assert [(r.source_object_name, bytes(r.content)) for r in rows] == [(name, x.load().encode())]


def test_encoding_is_looked_up_once(spark):
    from wattline.sources import documents

    rows = spark.createDataFrame(
        [("a", bytearray(b"<x/>"))], "source_object_name string, content binary"
    )
    plan = documents.parse(rows, documents.LOAD)._jdf.queryExecution().optimizedPlan().toString()
    # once in the first bytes, and once in the whole where those do not end the first tag
    assert plan.count("encoding=") == 2


def test_encoding_beyond_the_first_bytes(spark):
    from wattline.sources import documents

    far = b"\n" * 600 + b'<?xml version="1.0" encoding="windows-1252"?><x/>'
    split = b"<?xml" + b" " * 600 + b'encoding="iso-8859-2"?><x/>'
    none = b"<x>" + b" " * 600 + b'<?xml encoding="cp1250"?></x>'
    made = [(i, bytearray(c)) for i, c in enumerate((far, split, none))]
    rows = spark.createDataFrame(made, "id int, content binary")
    found = rows.select("id", documents.declared_encoding(rows.content).alias("e")).collect()
    assert {r.id: r.e for r in found} == {0: "WINDOWS-1252", 1: "ISO-8859-2", 2: ""}


def test_documents_are_made_on_all_cores(spark):
    from verification import made_documents

    columns = "1 as user_id, 'a' as event_type, 1.0D as value, timestamp'2024-01-01 00:00:00' as ts"
    events = spark.range(50, numPartitions=1).selectExpr("id as event_id", *columns.split(", "))
    assert made_documents.load_documents(events).rdd.getNumPartitions() >= spark.sparkContext.defaultParallelism


def test_usual_roots_are_told_by_one_pattern(spark):
    usual = [x.load(), x.prices(), "<a></a>", " <?xml version='1.0'?><!-- b --><a>/ </b></a>\n\t"]
    other = [
        "", "<a>", "<a/>", "a", "</a><a></a>", "<!-- </a> --><a></a>", "<a></a>x", "<a></a><!-- c -->",
        "<ab></a>", "<ab><a></a>", "<a><a></a></a>", "<a></a></a>", "<a>x/a></a>", "<a>/a>", "<a>/a> </a>", "<a b='1'></a >",
    ]
    rows = spark.createDataFrame([(t,) for t in usual + other], "xml string")
    root, trimmed = d._root_tag(F.col("xml")), d._trimmed(F.col("xml"))
    got = {r.xml: (r.usual, r.single) for r in rows.select(
        "xml", F.col("xml").rlike(d._USUAL_ROOT).alias("usual"),
        d._single_root(F.col("xml"), root, trimmed).alias("single")).collect()}
    assert [got[t][0] for t in usual] == [True] * len(usual)
    assert [t for t in got if got[t][0] and not got[t][1]] == []
    assert not any(got[t][0] for t in other)
    long = "<a>" + "<b>/</b>" * 200_000 + "</a>"
    assert spark.createDataFrame([(long,)], "xml string").filter(F.col("xml").rlike(d._USUAL_ROOT)).count()


def test_documents_are_made_in_parts_of_bounded_size(spark, monkeypatch):
    monkeypatch.setattr(made_documents, "_PART", 10)
    events = spark.range(995).selectExpr("id as event_id", "timestamp_seconds(id) as ts")
    assert made_documents._spread(events).rdd.getNumPartitions() == 100

"""Market documents (XML) flattened to one typed row per point.

A document is one row. It is parsed once, turned into typed nested arrays, and
checked as a whole *before* it is exploded, so a bad element anywhere rejects its
document without a shuffle. ``read_documents`` -> ``parse`` -> ``flatten`` for the
accepted rows and ``rejected`` for the rest.
"""

from __future__ import annotations

import os
import re
from collections.abc import Callable
from dataclasses import dataclass
from functools import reduce
from operator import or_
from string import ascii_lowercase, ascii_uppercase

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from wattline import schemas
from wattline.functions import text

_CORRUPT = "_corrupt"


@dataclass(frozen=True)
class Field:
    """A scalar element: its path, the output column, how to read it, and when it is valid."""

    path: str
    column: str
    read: Callable[[Column], Column] | None = None
    required: bool = True
    minimum: int | None = None


@dataclass(frozen=True)
class DocumentSpec:
    """Elements of one document type at each nesting level."""

    dataset: schemas.Dataset
    header: tuple[Field, ...]
    series: tuple[Field, ...]
    point: tuple[Field, ...]
    intervals: tuple[str, ...] = ("timeInterval",)


# Element names of the three document types and the columns they become.
_HEADER = (
    Field("mRID", "document_mrid"),
    Field("type", "document_type"),
    Field("revisionNumber", "revision_number", text.integer),
    Field("createdDateTime", "document_created_at", text.offset_timestamp),
)
_PROCESS = Field("process.processType", "process_type")
_POSITION = Field("position", "position", text.integer, minimum=1)
_QUANTITY = Field("quantity", "quantity", text.numeric)

LOAD = DocumentSpec(
    schemas.LOAD,
    header=(*_HEADER, _PROCESS),
    series=(
        Field("mRID", "time_series_mrid"),
        Field("businessType", "business_type"),
        Field("objectAggregation", "object_aggregation"),
        Field("outBiddingZone_Domain.mRID", "out_bidding_zone"),
        Field("quantity_Measure_Unit.name", "quantity_unit"),
        Field("curveType", "curve_type"),
    ),
    point=(_POSITION, _QUANTITY),
)

GENERATION = DocumentSpec(
    schemas.GENERATION,
    header=(*_HEADER, _PROCESS),
    series=(
        Field("mRID", "time_series_mrid"),
        Field("businessType", "business_type"),
        Field("objectAggregation", "object_aggregation"),
        Field("inBiddingZone_Domain.mRID", "in_bidding_zone", required=False),
        Field("outBiddingZone_Domain.mRID", "out_bidding_zone", required=False),
        Field("quantity_Measure_Unit.name", "quantity_unit"),
        Field("curveType", "curve_type"),
        Field("MktPSRType/psrType", "psr_type"),
    ),
    point=(_POSITION, _QUANTITY),
)

PRICES = DocumentSpec(
    schemas.PRICES,
    header=_HEADER,
    series=(
        Field("mRID", "time_series_mrid"),
        Field("auction.type", "auction_type"),
        Field("businessType", "business_type"),
        Field("in_Domain.mRID", "in_domain"),
        Field("out_Domain.mRID", "out_domain"),
        Field("contract_MarketAgreement.type", "contract_market_agreement_type"),
        Field("currency_Unit.name", "currency_unit"),
        Field("price_Measure_Unit.name", "price_unit"),
        Field(
            "classificationSequence_AttributeInstanceComponent.position",
            "classification_sequence_position",
            text.integer,
            required=False,
            minimum=1,
        ),
        Field("curveType", "curve_type"),
    ),
    point=(_POSITION, Field("price.amount", "price_amount", text.numeric)),
    intervals=("timeInterval", "period.timeInterval"),
)
SPECS = {s.dataset.name: s for s in (LOAD, GENERATION, PRICES)}


def document_ddl(spec: DocumentSpec) -> str:
    """XML schema of a document type. Scalars are arrays so the first repeat can win."""

    def scalars(fields: tuple[Field, ...], sep: str) -> list[str]:
        parts = []
        for field in fields:
            outer, _, inner = field.path.partition("/")
            kind = f"array<struct<`{inner}`:array<string>>>" if inner else "array<string>"
            parts.append(f"`{outer}`{sep}{kind}")
        return parts

    bounds = "array<struct<`start`:array<string>,`end`:array<string>>>"
    period = [f"`{name}`:{bounds}" for name in spec.intervals]
    period += ["`resolution`:array<string>"]
    period += [f"`Point`:array<struct<{','.join(scalars(spec.point, ':'))}>>"]
    series = scalars(spec.series, ":") + [f"`Period`:array<struct<{','.join(period)}>>"]
    top = scalars(spec.header, " ")
    top += [f"`TimeSeries` array<struct<{','.join(series)}>>", f"`{_CORRUPT}` string"]
    return ", ".join(top)


def read_documents(spark: SparkSession, path: str) -> DataFrame:
    """``(source_object_name, content, arrived_at)`` of every XML file under ``path``.

    Object names are relative to ``path``. Directory names are not read as columns.
    """
    files = (
        spark.read.format("binaryFile")
        .option("recursiveFileLookup", "true")
        .option("pathGlobFilter", "*.xml")
        .load(path)
    )
    return name_objects(files, path)


def stream_documents(spark: SparkSession, path: str) -> DataFrame:
    """The same rows as a stream that delivers every file once."""
    files = (
        spark.readStream.format("binaryFile")
        .schema("path string, modificationTime timestamp, length bigint, content binary")
        .option("recursiveFileLookup", "true")
        .option("pathGlobFilter", "*.xml")
        .load(path)
    )
    return name_objects(files, path)


def name_objects(files: DataFrame, path: str) -> DataFrame:
    """Files named by their place below ``path``; a file from elsewhere fails the job."""
    if set("*?[{") & set(path):
        raise ValueError(f"{path}: names are relative to one folder, so it cannot be a pattern")
    scheme = r"^[A-Za-z][A-Za-z0-9+.-]*:(//[^/]*)?"
    bare = re.sub(scheme, "", path)
    root = (bare if bare.startswith("/") else os.path.abspath(bare)).rstrip("/") + "/"
    place = F.regexp_replace("path", scheme, "")
    outside = F.raise_error(F.concat(F.lit(f"not below {root}: "), F.col("path")))
    name = F.substring(place, len(root) + 1, 2**31 - 1)
    return files.select(
        F.when(F.startswith(place, F.lit(root)), name)
        .otherwise(outside.cast("string")).alias("source_object_name"),
        "content",
        F.col("modificationTime").alias("arrived_at"),
    )


# Names of single-byte encodings, by family, and the codec each stands for.
_SINGLE_BYTE = {
    **{f"{family}{n}": f"iso8859-{n}" for n in (*range(1, 12), *range(13, 17))
       for family in ("ISO-8859-", "ISO8859-", "ISO_8859-")},
    **{f"{family}{n}": f"cp{n}" for n in range(1250, 1259) for family in ("WINDOWS-", "CP")},
}
# Declared encodings read as UTF-8, and the ways a document of two bytes a
# character can begin and be declared.
_UTF8 = ("", "UTF-8", "US-ASCII")
_BEGIN = {"FEFF": "UTF-16BE", "FFFE": "UTF-16LE", "003C": "UTF-16BE", "3C00": "UTF-16LE"}
_LATIN = "".join(map(chr, range(128, 256)))
_UNDEFINED = "\ufffd"


def _two_byte_order(content: Column) -> Column:
    """Which UTF-16 the first bytes show; null for documents of one byte a character."""
    begin = F.hex(F.substring(content, 1, 2))
    found = F.when(F.lit(False), F.lit(""))
    for first, order in _BEGIN.items():
        found = found.when(begin == first, order)
    return found


# Bytes in which nearly every XML declaration ends.
_HEAD = 512


def declared_encoding(content: Column) -> Column:
    """Encoding named by the XML declaration, upper case; empty when it names none.

    Nothing after the end of the first tag can name it, so more than the first bytes is looked
    at only where that tag does not end there.
    """
    one_byte = _two_byte_order(content).isNull()

    def plain(some: Column) -> Column:
        latin = F.decode(some, "ISO-8859-1")
        return F.when(one_byte, latin).otherwise(F.translate(latin, "\x00", ""))

    def named(some: Column) -> Column:
        pattern = r"""^[^<]*<\?xml[^>]*?encoding=["']([A-Za-z0-9._-]+)["']"""
        return F.regexp_extract(plain(some), pattern, 1)

    head = F.substring(content, 1, _HEAD)
    name = F.when(plain(head).rlike("^[^<]*<[^>]*>"), named(head)).otherwise(named(content))
    return F.translate(name, ascii_lowercase, ascii_uppercase)


def _unsupported(order: Column, declared: Column) -> Column:
    fits = declared.isin("", "UTF-16") | (declared == order)
    return F.coalesce(
        F.when(order.isNotNull(), ~fits).otherwise(~declared.isin(*_UTF8, *_SINGLE_BYTE)),
        F.lit(False),
    )


def unsupported_encoding(content: Column) -> Column:
    """Whether the named encoding cannot be read, or the first bytes contradict it."""
    return _unsupported(_two_byte_order(content), declared_encoding(content))


def _single_byte(content: Column, declared: Column) -> Column:
    """Text of one byte a character; null where a byte has no character in that encoding.

    These encodings differ only in bytes from 128 on; text without any is as it is.
    """
    latin = F.decode(content, "ISO-8859-1")
    found = F.when(declared == "ISO-8859-1", latin)
    for codec in dict.fromkeys(_SINGLE_BYTE.values()):
        names = [name for name, of in _SINGLE_BYTE.items() if of == codec]
        to = bytes(range(128, 256)).decode(codec, "replace")
        text_ = F.translate(latin, _LATIN, to)
        none = "".join(f"\\x{128 + i:02x}" for i, c in enumerate(to) if c == _UNDEFINED)
        found = found.when(
            declared.isin(*names), F.when(~latin.rlike(f"[{none}]"), text_) if none else text_
        )
    plain = declared.isin(*_SINGLE_BYTE) & ~latin.rlike(r"[\x80-\xff]")
    return F.when(plain, latin).otherwise(found)


def _two_bytes(content: Column, order: str) -> Column:
    """Text of UTF-16 without its mark; null where units are cut off or halves unpaired.

    The bytes are checked first, as decoding would fail the job. Where there are halves, whole
    pairs are taken out one by one from the start on, after which no half may be left.
    """
    high, low, other = "[\\u00D8-\\u00DB]", "[\\u00DC-\\u00DF]", "[^\\u00D8-\\u00DF]"
    unit = "(?:{}.)" if order == "UTF-16BE" else "(?:.{})"
    usual, pair = unit.format(other), unit.format(high) + unit.format(low)
    marked = F.hex(F.substring(content, 1, 2)).isin("FEFF", "FFFE")
    body = F.when(marked, F.substring(content, 3, 2**31 - 1)).otherwise(content)
    latin = F.decode(body, "ISO-8859-1")
    rest = F.regexp_replace(latin, rf"(?s)\G({usual}*+){pair}", "$1")
    whole = rf"(?s)^{usual}*+\z"
    return F.when(latin.rlike(whole) | rest.rlike(whole), F.decode(body, order))


def decoded(content: Column) -> Column:
    """Document text in its declared encoding; null where the bytes do not fit it.

    UTF-8, UTF-16 of either order, with or without a mark, and the single-byte families of
    ``_SINGLE_BYTE``.
    """
    order, declared = _two_byte_order(content), declared_encoding(content)
    return _decoded(content, order, declared, _unsupported(order, declared))


def _decoded(content: Column, order: Column, declared: Column, unsupported: Column) -> Column:
    return (
        F.when(unsupported, F.lit(None).cast("string"))
        .when(order == "UTF-16BE", _two_bytes(content, "UTF-16BE"))
        .when(order == "UTF-16LE", _two_bytes(content, "UTF-16LE"))
        .when(declared.isin(*_UTF8), F.try_validate_utf8(content.cast("string")))
        .otherwise(_single_byte(content, declared))
    )


def _texts(documents: DataFrame) -> DataFrame:
    """``source_object_name``, ``xml`` and ``unreadable`` of every document.

    Each step reads columns of the one before, so an encoding is looked up once.
    """
    if dict(documents.dtypes)["content"] != "binary":
        return documents.select(
            "source_object_name", F.col("content").alias("xml"), F.lit(False).alias("unreadable")
        )
    content, order, declared = F.col("content"), F.col("_order"), F.col("_declared")
    return (
        documents.select(
            "source_object_name", "content",
            _two_byte_order(content).alias("_order"), declared_encoding(content).alias("_declared"),
        )
        .withColumn("unreadable", _unsupported(order, declared))
        .select(
            "source_object_name",
            _decoded(content, order, declared, F.col("unreadable")).alias("xml"), "unreadable",
        )
    )


# A document may not become longer than this many characters, or this many times its length.
EXPANDED_CHARS, EXPANDED_TIMES = 8_000_000, 100
_DOCTYPE = r"""(?s)<!DOCTYPE(?:[^\["'>]|"[^"]*"|'[^']*')*+(?:\[(.*?)\]\s*)?>"""
_ENTITY = r"""<!ENTITY\s+([A-Za-z_:][\w:.-]*)\s+(?:"([^"%]*)"|'([^'%]*)')\s*>"""


def expanded(xml: Column) -> Column:
    """Document text with the internal entities of its DOCTYPE put in and that taken away.

    A name keeps its first declaration, and values may refer to other entities. Entities from
    elsewhere are never fetched. Null where a text would outgrow the bound, where a value
    holds an escaped ``&`` or ``<`` (which would have to be read twice), and where CDATA
    holds ``&``, which must stay as it is.
    """
    subset = F.coalesce(F.regexp_extract(xml, _DOCTYPE, 1), F.lit(""))
    subset = F.regexp_replace(subset, r"(?s)<!--.*?-->", "")
    body = F.regexp_replace(xml, _DOCTYPE, "")
    whole = F.regexp_extract_all(subset, F.lit(_ENTITY), F.lit(0))
    entities = F.transform(whole, lambda e: F.struct(
        F.concat(F.lit("&"), F.regexp_extract(e, _ENTITY, 1), F.lit(";")).alias("ref"),
        F.concat(F.regexp_extract(e, _ENTITY, 2), F.regexp_extract(e, _ENTITY, 3)).alias("value"),
    ))
    most = F.greatest(F.lit(EXPANDED_CHARS), EXPANDED_TIMES * F.length(xml))

    def put_in(text_: Column, entity: Column) -> Column:
        ref, value = entity["ref"], entity["value"]
        without = F.length(F.replace(text_, ref, F.lit("")))
        times = (F.length(text_) - without) / F.length(ref)
        return F.when(without + times * F.length(value) <= most, F.replace(text_, ref, value))

    # as many rounds as there are entities: no chain of values that ends is longer
    rounds = F.flatten(F.array_repeat(entities, F.size(entities)))
    full = F.aggregate(rounds, body, put_in)
    twice = F.exists(entities, lambda e: e["value"].rlike("&#(?:0*(?:38|60)|x0*(?:26|3[cC]));"))
    raw = body.rlike(r"(?s)<!\[CDATA\[(?:(?!\]\]>)[^&])*+&")
    return F.when((F.size(entities) == 0) | ~(twice | raw), full)


def _first(values: Column) -> Column:
    """First of several same-named elements; later repeats are ignored.

    The XML reader has already trimmed the text and turned empty text into null.
    """
    return F.get(values, F.lit(0))


def _value(field: Field, element: Column) -> Column:
    outer, _, inner = field.path.partition("/")
    raw = _first(_first(element[outer])[inner]) if inner else _first(element[outer])
    return field.read(raw) if field.read else raw


def _typed(fields: tuple[Field, ...], element: Column) -> list[Column]:
    columns = [_value(f, element).alias(f.column) for f in fields]
    # An optional value that is present but unreadable must still reject the document.
    columns += [
        _first(element[f.path]).isNotNull().alias(f"has_{f.column}")
        for f in fields
        if f.read and not f.required
    ]
    return columns


def _children(array: Column) -> Column:
    return F.coalesce(array, F.array())


def _typed_series(spec: DocumentSpec, document: Column) -> Column:
    def point(q: Column) -> Column:
        return F.struct(*_typed(spec.point, q))

    def period(p: Column) -> Column:
        interval = _first(F.coalesce(*[p[name] for name in spec.intervals]))
        resolution = _first(p["resolution"])
        return F.struct(
            text.offset_timestamp(_first(interval["start"])).alias("period_start"),
            text.offset_timestamp(_first(interval["end"])).alias("period_end"),
            resolution.alias("resolution"),
            text.duration_seconds(resolution).alias("resolution_seconds"),
            F.transform(_children(p["Point"]), point).alias("points"),
        )

    def timed(p: Column) -> Column:
        """The period with the instants of its points; start and step are read only once."""

        def instant(q: Column) -> Column:
            steps = F.try_subtract(q["position"], F.lit(1).cast("bigint"))
            at = text.later(p["period_start"], steps, p["resolution_seconds"])
            return F.struct(*[q[f.column].alias(f.column) for f in spec.point], at.alias("instant"))

        names = ("period_start", "period_end", "resolution", "resolution_seconds")
        return F.struct(
            *[p[n].alias(n) for n in names], F.transform(p["points"], instant).alias("points")
        )

    def series(s: Column) -> Column:
        return F.struct(
            *_typed(spec.series, s),
            F.transform(F.transform(_children(s["Period"]), period), timed).alias("periods"),
        )

    return F.transform(_children(document["TimeSeries"]), series)


def _bad(field: Field, holder: Callable[[str], Column]) -> Column:
    """Whether a value is missing, unreadable or too small. Never null."""
    value = holder(field.column)
    bad = value.isNull()
    if not field.required:
        bad = holder(f"has_{field.column}") & bad if field.read else F.lit(False)
    return bad if field.minimum is None else bad | F.coalesce(value < field.minimum, F.lit(False))


def _checks(level: str, fields: tuple[Field, ...], holder: Callable[[str], Column]) -> dict:
    return {f"{level}{f.path}": _bad(f, holder) for f in fields if f.required or f.read}


def _period_checks(p: Column) -> dict[str, Column]:
    seconds = p["resolution_seconds"]
    return {
        "Period.start": p["period_start"].isNull(),
        "Period.end": p["period_end"].isNull(),
        "Period.resolution": seconds.isNull() | (seconds < 1),
    }


def _point_checks(spec: DocumentSpec, p: Column, point: Column) -> dict[str, Column]:
    readable = point["position"].isNotNull() & p["period_start"].isNotNull()
    timed = readable & p["resolution_seconds"].isNotNull()
    return {
        **{f"Point.{f.path}": _bad(f, lambda name: point[name]) for f in spec.point},
        "Point.instant": timed & point["instant"].isNull(),
    }


def _messages(found: dict[str, Column]) -> Column:
    return F.array(*[F.when(c, F.lit(f"{n}: missing or invalid")) for n, c in found.items()])


def _errors(spec: DocumentSpec) -> Column:
    """Distinct errors of a document. The list is only built where something is wrong."""
    header = _checks("", spec.header, F.col)

    def of_series(s: Column) -> dict[str, Column]:
        return _checks("TimeSeries.", spec.series, lambda name: s[name])

    def period_is_bad(p: Column) -> Column:
        point_is_bad = lambda q: reduce(or_, _point_checks(spec, p, q).values())
        return reduce(or_, _period_checks(p).values()) | F.exists(p["points"], point_is_bad)

    def period_messages(p: Column) -> Column:
        def any_point(name: str) -> Column:
            return F.exists(p["points"], lambda q: _point_checks(spec, p, q)[name])

        names = [*(f"Point.{f.path}" for f in spec.point), "Point.instant"]
        return _messages(_period_checks(p) | {name: any_point(name) for name in names})

    def series_is_bad(s: Column) -> Column:
        return reduce(or_, of_series(s).values()) | F.exists(s["periods"], period_is_bad)

    def series_messages(s: Column) -> Column:
        inner = F.transform(s["periods"], period_messages)
        return F.concat(_messages(of_series(s)), F.flatten(inner))

    series = F.col("series")
    every = F.concat(_messages(header), F.flatten(F.transform(series, series_messages)))
    return (
        F.when(F.col("unreadable"), F.array(F.lit("document: unsupported encoding")))
        .when(F.col("malformed"), F.array(F.lit("document: not well-formed XML")))
        .when(
            reduce(or_, header.values()) | F.exists(series, series_is_bad),
            F.array_distinct(F.filter(every, lambda e: e.isNotNull())),
        )
        .otherwise(F.array().cast("array<string>"))
    )


def _root_tag(xml: Column) -> Column:
    return F.regexp_extract(xml, r"<([A-Za-z_][^\s/>]*)", 1)


def _trimmed(xml: Column) -> Column:
    """Text without space at its end, which is looked for only where there is some."""
    spaces = F.substring(xml, -1, 1).isin(*text.WHITESPACE)
    return F.when(spaces, F.rtrim(xml, F.lit(text.WHITESPACE))).otherwise(xml)


# A root whose closing tag is found first at the end. Possessive, so a failed match ends at once.
_USUAL_ROOT = (
    r"(?s)\A[^<]*(?:<(?![A-Za-z_/])[^<]*)*+<([A-Za-z_][^\s/>]*+)[^/]*(?:/(?!\1>)[^/]*)*+"
    r"/(?<=</)\1>[ \t\r\n\f\x0b]*\z"
)


def _single_root(xml: Column, root: Column, trimmed: Column) -> Column:
    """Whether the root element closes once and only comments follow it."""
    closing = F.concat(F.lit("</"), root, F.lit(">"))
    at_end = F.position(closing, trimmed) + F.length(closing) == F.length(trimmed) + 1
    # Rarely needed: a childless root, space inside the tag, or comments after it.
    name = F.regexp_extract(
        xml, r"(?s)</([A-Za-z_][^\s<>]*)\s*>\s*(?:<!--.*?-->\s*|<\?.*?\?>\s*)*$", 1
    )
    tag = F.concat(F.lit("</"), root)
    once = F.length(F.replace(xml, tag, F.lit(""))) == F.length(xml) - F.length(tag)
    childless = ~F.contains(xml, F.lit("</")) & F.endswith(trimmed, F.lit("/>"))
    return F.when(at_end, True).otherwise(childless | (once & (name == root)))


def parse(documents: DataFrame, spec: DocumentSpec) -> DataFrame:
    """One row per document: typed header, typed nested series, ``errors``, ``point_count``.

    ``documents`` has ``source_object_name`` and ``content`` (binary or string).
    """
    options = {
        "ignoreNamespace": "true",
        "ignoreSurroundingSpaces": "true",
        "nullValue": "",
        "columnNameOfCorruptRecord": _CORRUPT,
    }
    plain, usual = F.col("xml"), F.col("_usual")
    single = _single_root(plain, F.col("_root"), F.col("_trimmed"))
    read = _texts(documents).withColumn(
        "xml", F.when(F.contains(plain, F.lit("<!DOCTYPE")), expanded(plain)).otherwise(plain)
    ).withColumn("_usual", plain.rlike(_USUAL_ROOT)).withColumns({
        "_root": F.when(~usual, _root_tag(plain)), "_trimmed": F.when(~usual, _trimmed(plain)),
    }).select(
        "source_object_name",
        F.from_xml("xml", document_ddl(spec), options).alias("document"),
        (plain.isNull() | ~(usual | single)).alias("broken"),
        "unreadable",
    )
    document = F.col("document")
    typed = read.select(
        "source_object_name",
        "unreadable",
        (F.col("broken") | document.isNull() | document[_CORRUPT].isNotNull()).alias("malformed"),
        *[c for c in _typed(spec.header, document)],
        _typed_series(spec, document).alias("series"),
    )
    points = F.aggregate(
        F.flatten(F.transform("series", lambda s: s["periods"])),
        F.lit(0).cast("bigint"),
        lambda total, p: total + F.size(p["points"]),
    )
    body = F.struct("series", points.alias("point_count"), _errors(spec).alias("errors"))
    # Exploding one value is a fence: without it a filter on the result would be pushed
    # below and repeat the whole parse for every field it looks at.
    header = [f.column for f in spec.header]
    fenced = typed.select("source_object_name", *header, F.explode(F.array(body)).alias("body"))
    return fenced.select("source_object_name", *header, "body.*")


def flatten(parsed: DataFrame, spec: DocumentSpec) -> DataFrame:
    """One row per point of every accepted document, in the dataset's RAW schema."""
    header = ["source_object_name", *[f.column for f in spec.header]]
    series = [f.column for f in spec.series]
    period = ["period_start", "period_end", "resolution", "resolution_seconds"]
    accepted = F.when(F.size("errors") == 0, F.col("series"))
    # Scalars are picked out before the next explode, so no row carries its sibling points.
    rows = (
        parsed.select(*header, F.explode(accepted).alias("s"))
        .select(*header, *[f"s.{c}" for c in series], "s.periods")
        .select(*header, *series, F.explode("periods").alias("p"))
        .select(*header, *series, *[f"p.{c}" for c in period], "p.points")
        .select(*header, *series, *period, F.explode("points").alias("v"))
        .select(
            *header, *series, *period, *[f"v.{f.column}" for f in spec.point],
            F.col("v.instant").alias("point_timestamp"),
        )
    )
    return rows.select(*spec.dataset.schema.fieldNames())


def reject_empty(parsed: DataFrame) -> DataFrame:
    """Rejects documents without a single point, as a load of them would be empty."""
    empty = (F.size("errors") == 0) & (F.col("point_count") == 0)
    reason = F.array(F.lit("document: no points"))
    return parsed.withColumn("errors", F.when(empty, reason).otherwise(F.col("errors")))


def rejected(parsed: DataFrame) -> DataFrame:
    """Documents with at least one error, and why."""
    return parsed.filter(F.size("errors") > 0).select("source_object_name", "errors")

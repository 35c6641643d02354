"""Reading typed values out of document text, and formatting them back.

Every parser returns null for text it does not accept, so callers can report the
field instead of failing the job.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Accepted text formats.
_DURATION = r"^PT(?:([0-9]+)H)?(?:([0-9]+)M)?(?:([0-9]+)S)?$"
_USUAL_TIMESTAMP = (
    r"^[0-9]{4}-[0-9]{2}-[0-9]{2}[T ][0-9]{2}:[0-9]{2}(:[0-9]{2}([.,][0-9]+)?)?"
    r"(Z|[+-][0-9]{2}:[0-9]{2})$"
)
_OFFSET_TIMESTAMP = (
    r"^([0-9]{4})-?([0-9]{2})-?([0-9]{2})[T ]([0-9]{2})(?::?([0-9]{2})(?::?([0-9]{2})(?:[.,]([0-9]+))?)?)?"
    r"(Z|[+-][0-9]{2}(?::?[0-9]{2}(?::?[0-9]{2})?)?)$"
)
# Microseconds at the ends of the years 1 to 9999.
_MICROS = (-62_135_596_800_000_000, 253_402_300_799_999_999)
WHITESPACE = " \t\r\n\f\x0b"


def integer(text: Column) -> Column:
    return text.try_cast("bigint")


def numeric(text: Column) -> Column:
    return text.try_cast("decimal(38,9)")


def offset_timestamp(text: Column) -> Column:
    """Instant of an ISO timestamp. Text without a UTC offset is not accepted.

    Separators and lower units may be left out, and the offset may hold seconds.
    """

    # Taken apart in a function over one value, so the text is looked up once.
    return F.get(F.transform(F.array(text), _instant), F.lit(0))


def _instant(text: Column) -> Column:
    # Nearly all timestamps are written out; those only lack seconds at times.
    to_end = F.substring(text, 17, 2**31 - 1)
    without_seconds = F.concat(F.substring(text, 1, 16), F.lit(":00"), to_end)
    seconds = F.substring(text, 17, 1) == ":"
    usual = F.when(seconds, F.translate(text, ",", ".")).otherwise(without_seconds)
    return F.when(text.rlike(_USUAL_TIMESTAMP), usual.try_cast("timestamp")).otherwise(
        _taken_apart(text)
    )


def _taken_apart(text: Column) -> Column:
    def part(group: int) -> Column:
        return F.regexp_extract(text, _OFFSET_TIMESTAMP, group)

    def unit(group: int) -> Column:
        return F.when(part(group) == "", "00").otherwise(part(group))

    fraction = F.when(part(7) == "", "0").otherwise(part(7))
    date = F.concat_ws("-", part(1), part(2), part(3))
    time = F.concat(F.concat_ws(":", unit(4), unit(5), unit(6)), F.lit("."), fraction)
    local = F.concat(date, F.lit("T"), time, F.lit("Z")).try_cast("timestamp")
    digits = F.rpad(F.regexp_replace(part(8), "[^0-9]", ""), 6, "0")
    hours, minutes, seconds = (digits.substr(i, 2).try_cast("bigint") for i in (1, 3, 5))
    ahead = F.when(F.startswith(part(8), F.lit("-")), -1).otherwise(1).cast("bigint")
    valid = (hours < 24) & (minutes < 60) & (seconds < 60)
    shift = ahead * (hours * 3600 + minutes * 60 + seconds)
    moved = later(local, -shift, F.lit(1).cast("bigint"))
    return F.when(text.rlike(_OFFSET_TIMESTAMP) & valid, moved)


def duration_seconds(text: Column) -> Column:
    """Seconds of an ISO ``PTnHnMnS`` duration; zero for any other text, null on overflow."""

    def number(amount: Column) -> Column:
        # An absent part is empty text. It must not reach the cast, which would fail slowly.
        return F.when(amount != "", amount.try_cast("bigint")).otherwise(0)

    def total(numbers: Column) -> Column:
        hours, minutes, seconds = (
            F.try_multiply(F.get(numbers, F.lit(i)), F.lit(unit).cast("bigint"))
            for i, unit in enumerate((3600, 60, 1))
        )
        return F.try_add(F.try_add(hours, minutes), seconds)

    # Functions over one value: each part of the text is found once.
    parts = F.array(*[F.regexp_extract(text, _DURATION, group) for group in (1, 2, 3)])
    return F.get(F.transform(F.array(F.transform(parts, number)), total), F.lit(0))


def later(start: Column, steps: Column, seconds: Column) -> Column:
    """Instant some steps after another; null where it leaves the years 1 to 9999."""
    elapsed = F.try_multiply(F.try_multiply(steps, seconds), F.lit(1_000_000).cast("bigint"))
    micros = F.try_add(F.unix_micros(start), elapsed)

    def instant(at: Column) -> Column:
        return F.when(at.between(*_MICROS), F.timestamp_micros(at))

    return F.get(F.transform(F.array(micros), instant), F.lit(0))


def utc_minute(instant: Column) -> Column:
    """``yyyyMMddHHmm``; the session time zone is UTC."""
    return F.date_format(instant, "yyyyMMddHHmm")


def load_id(dataset: str | Column, object_name: Column) -> Column:
    """Deterministic id of loading one object into one dataset."""
    name = F.lit(dataset) if isinstance(dataset, str) else dataset
    digest = F.sha2(object_name.cast("binary"), 256).substr(1, 24)
    return F.concat(F.lit("raw_"), name, F.lit("_"), digest)


def object_name(dataset: str | Column, zone: Column, start: Column, end: Column) -> Column:
    """Landing name of one dataset, zone and UTC interval, dated by the interval start."""
    # The parts of a name and their formats.
    name = F.lit(dataset) if isinstance(dataset, str) else dataset
    stamp = "yyyyMMdd'T'HHmm'Z'"
    return F.concat(
        F.lit("entsoe/"), name,
        F.lit("/bidding_zone="), zone,
        F.date_format(start, "'/year='yyyy'/month='MM'/day='dd'/'"),
        F.date_format(start, stamp), F.lit("_"), F.date_format(end, stamp), F.lit(".xml"),
    )

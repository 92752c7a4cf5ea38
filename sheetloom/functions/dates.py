"""Dates as people type them into sheets, and the time stamps of file listings."""

from pyspark.sql import Column
from pyspark.sql import functions as F

# Day zero of spreadsheet serial numbers, and the last serial (9999-12-31).
SERIAL_EPOCH = "1899-12-30"
LAST_SERIAL = 2958465

_SERIAL = r"^\s*([0-9]+)(\.[0-9]*)?\s*$"
_SLASH = r"(?s)^\s*([0-9]{1,2})/([0-9]{1,2})/%s(?![0-9]).*$"


def _whole(digits: Column) -> Column:
    """Digits as a number. An empty text is set aside first: casting it costs an exception per row."""
    return F.nullif(digits, F.lit("")).try_cast("int")


def serial_date(c: Column) -> Column:
    """Spreadsheet serial number as a date; the time of day is cut off. Not a number: NULL."""
    days = _whole(F.regexp_extract(c, _SERIAL, 1))
    return F.date_add(F.lit(SERIAL_EPOCH).cast("date"), F.when(days <= LAST_SERIAL, days))


def _iso_text(c: Column, repair_year: bool) -> Column:
    """Slash dates rewritten year first, two-digit years as 20xx, the rest as it is.

    All repairs are made on the text: as nested date expressions they would
    repeat each other's input and swell the plans they are used in.
    """
    four = F.regexp_replace(c, _SLASH % "([0-9]{4})", "$3-$1-$2")
    text = F.regexp_replace(four, _SLASH % "([0-9]{2})", "20$3-$1-$2")
    if repair_year:
        text = F.regexp_replace(text, r"^\s*00([0-9]{2}-)", "20$1")
    return F.trim(text)


def widen_year(d: Column) -> Column:
    """Years below 100 mean this century."""
    return F.when(F.year(d) < 100, F.add_months(d, 24000)).otherwise(d)


def mixed_date(c: Column, repair_year: bool = True) -> Column:
    """Serial number, month/day/year with two or four year digits, or ISO text; else NULL.

    Text after a slash date and a time after an ISO date are ignored.
    """
    iso = F.when(~c.rlike(_SERIAL), _iso_text(c, repair_year)).try_cast("date")
    return F.coalesce(serial_date(c), iso)


def calendar_date(c: Column) -> Column:
    """As ``mixed_date``, but only slash forms and serial numbers count."""
    is_slash = c.rlike(_SLASH % "([0-9]{4}|[0-9]{2})")
    text = F.when(is_slash, _iso_text(c, True)).try_cast("date")
    return F.coalesce(text, serial_date(c))


# The accepted time stamp forms, tried in this order.
_ISO = r"^([0-9]{4}-[0-9]{2}-[0-9]{2})([T ][0-9]{2}:[0-9]{2}(:[0-9]{2}(\.[0-9]+)?)?)?(Z|[+-][0-9]{2}:?[0-9]{2})?$"
_BASIC = r"^([0-9]{4})([0-9]{2})([0-9]{2})T([0-9]{2})([0-9]{2})([0-9]{2})$"
_LEADING_DAY = r"(?s)^([0-9]{4})([0-9]{2})([0-9]{2}).*$"


def parse_timestamp_utc(c: Column) -> Column:
    """ISO with ``Z``, offset or neither, ``yyyyMMddTHHmmss``, or a leading ``yyyyMMdd``.

    The result is UTC without a zone, so it reads the same under every session
    time zone; text without an offset is taken as UTC. Digits beyond microseconds are
    cut. No form fits: NULL.
    """
    zone = F.regexp_extract(c, _ISO, 5)
    hours = _whole(F.regexp_extract(zone, r"^[+-]([0-9]{2})", 1))
    minutes = _whole(F.regexp_extract(zone, r"([0-9]{2})$", 1))
    offset = F.coalesce(hours * 60 + minutes, F.lit(0))
    offset = F.when(zone.startswith("-"), -offset).otherwise(offset)
    clock = F.regexp_replace(F.regexp_extract(c, _ISO, 2), r"(\.[0-9]{6})[0-9]+$", "$1")
    local = F.concat(F.regexp_extract(c, _ISO, 1), clock).try_cast("timestamp_ntz")
    iso = F.timestamp_add("MINUTE", -offset, local)
    basic = F.when(c.rlike(_BASIC), F.regexp_replace(c, _BASIC, "$1-$2-$3 $4:$5:$6"))
    day = F.when(c.rlike(_LEADING_DAY), F.regexp_replace(c, _LEADING_DAY, "$1-$2-$3"))
    return F.coalesce(iso, basic.try_cast("timestamp_ntz"), day.try_cast("timestamp_ntz"))

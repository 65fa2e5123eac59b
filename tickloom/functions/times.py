"""UNIX nanoseconds in a bigint are the source of truth; Spark timestamps
(microseconds) are derived from them. Nothing here depends on the session zone
except parsing of zone-less text, which is read as UTC by ``configure``."""

from __future__ import annotations

import datetime as dt
import re

from pyspark.sql import Column
from pyspark.sql import functions as F

SECOND = 1_000_000_000
MINUTE = 60 * SECOND
HOUR = 60 * MINUTE
DAY = 24 * HOUR
MILLI = 1_000_000
# The null timestamp (2^64 - 1 does not fit a bigint) and the widest ns dates.
UNDEF_TIMESTAMP = 18446744073709551615
MIN_DATE = dt.date(1677, 9, 21)
MAX_DATE = dt.date(2262, 4, 11)


def floor_to(ns: Column, width: int) -> Column:
    """Start of the ``width``-wide bucket, also right before 1970."""
    return ns - F.pmod(ns, F.lit(width))


def bucket(ns: Column, width: int) -> Column:
    """Number of the ``width``-wide bucket (bigint, exact)."""
    return F.call_function("div", floor_to(ns, width), F.lit(width))


def utc_date(ns: Column) -> Column:
    return F.date_from_unix_date(bucket(ns, DAY).cast("int"))


def ceil_date(ns: Column) -> Column:
    """The date itself at midnight, else the next date."""
    day = utc_date(ns)
    return F.when(F.pmod(ns, F.lit(DAY)) == 0, day).otherwise(F.date_add(day, 1))


def to_timestamp(ns: Column) -> Column:
    """Microsecond timestamp, rounded down."""
    return F.timestamp_micros(bucket(ns, 1000))


def from_timestamp(ts: Column) -> Column:
    return F.unix_micros(ts.cast("timestamp")) * F.lit(1000)


def date_to_ns(day: Column) -> Column:
    return F.unix_date(day).cast("bigint") * F.lit(DAY)


def iso_text(ns: Column) -> Column:
    """``2020-12-28T00:00:00.006150193Z``."""
    def two(width: int, limit: int) -> Column:
        return F.lpad(F.pmod(bucket(ns, width), F.lit(limit)).cast("string"), 2, "0")

    return F.concat(
        utc_date(ns).cast("string"), F.lit("T"),
        two(HOUR, 24), F.lit(":"), two(MINUTE, 60), F.lit(":"), two(SECOND, 60), F.lit("."),
        F.lpad(F.pmod(ns, F.lit(SECOND)).cast("string"), 9, "0"), F.lit("Z"),
    )


def parse_ns(text: Column) -> Column:
    """Text to nanoseconds: ISO text first, else a whole number of nanoseconds.

    Four and eight digits are a year and a compact date. Digits below the
    microsecond are kept. Text that is neither gives NULL.
    """
    t = F.trim(text)
    compact = t.rlike("^[0-9]{8}$")
    number = t.rlike("^-?[0-9]+$") & ~compact & ~t.rlike("^[0-9]{4}$")
    day = F.try_to_date(t, "yyyyMMdd")
    stamp = t.try_cast("timestamp")
    extra = F.rpad(F.regexp_extract(t, r"\.[0-9]{6}([0-9]{1,3})", 1), 3, "0").cast("bigint")
    return (
        F.when(number, t.try_cast("bigint"))
        .when(compact, date_to_ns(day))
        .otherwise(from_timestamp(stamp) + extra)
    )


def text_of(value: Column, kind: str) -> Column:
    """Request form of a time value: text as is, numbers as digits, dates and
    timestamps in ISO form."""
    if kind in ("string", "bigint", "int"):
        return value.cast("string")
    if kind == "date":
        return F.date_format(value, "yyyy-MM-dd")
    if kind in ("timestamp", "timestamp_ntz"):
        whole = F.date_format(value, "yyyy-MM-dd'T'HH:mm:ss")
        micros = F.pmod(F.unix_micros(value.cast("timestamp")), F.lit(1_000_000))
        return F.when(micros == 0, whole).otherwise(
            F.concat(whole, F.lit("."), F.lpad(micros.cast("string"), 6, "0")))
    raise TypeError(f"no time text for type {kind}")


def date_or_null(text: Column) -> Column:
    return F.to_date(text.try_cast("timestamp"))


def timestamp_or_null(text: Column) -> Column:
    return text.try_cast("timestamp")


_ISO = re.compile(
    r"^(\d{4})(?:-(\d{2}))?(?:-(\d{2}))?(?:[T ](\d{2})(?::(\d{2}))?(?::(\d{2})(?:\.(\d{1,9}))?)?)?"
    r"(Z|[+-]\d{2}:?\d{2})?$"
)


def _ns_of(moment: dt.datetime) -> int:
    gone = moment - dt.datetime(1970, 1, 1, tzinfo=dt.timezone.utc)
    return (gone.days * 86_400 + gone.seconds) * SECOND + gone.microseconds * 1000


def bound_ns(value, end_of: bool = False) -> int:
    """A request bound as nanoseconds.

    With ``end_of`` the bound is filled forward by the resolution of the text:
    ``2022`` is the start of 2023, ``2022-06`` that of July, and so on.
    """
    if isinstance(value, bool) or value is None:
        raise TypeError("a time bound must be a number, text, date or datetime")
    if isinstance(value, int):
        return value
    if isinstance(value, dt.datetime):
        moment = value if value.tzinfo else value.replace(tzinfo=dt.timezone.utc)
        return _ns_of(moment)
    if isinstance(value, dt.date):
        day = value + dt.timedelta(days=1) if end_of else value
        return _ns_of(dt.datetime(day.year, day.month, day.day, tzinfo=dt.timezone.utc))
    text = str(value).strip()
    found = _ISO.match(text)
    if not found:
        return int(text)
    year, month, day, hour, minute, second, frac, zone = found.groups()
    offset = dt.timedelta()
    if zone and zone != "Z":
        digits = zone[1:].replace(":", "")
        offset = dt.timedelta(hours=int(digits[:2]), minutes=int(digits[2:]))
        offset = -offset if zone[0] == "-" else offset
    start = dt.datetime(int(year), int(month or 1), int(day or 1), int(hour or 0), int(minute or 0),
                        int(second or 0), tzinfo=dt.timezone.utc) - offset
    ns = _ns_of(start) + int((frac or "").ljust(9, "0"))
    if not end_of:
        return ns
    if month is None:
        return _ns_of(start.replace(year=start.year + 1))
    if day is None:
        after = (start.replace(day=1) + dt.timedelta(days=32)).replace(day=1)
        return _ns_of(after)
    step = DAY if hour is None else HOUR if minute is None else MINUTE if second is None else (
        SECOND if frac is None else 10 ** (9 - len(frac)))
    return ns + step

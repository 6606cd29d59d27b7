"""Epoch-millisecond handling, day placement, time zones and clock injection.

Every cast on untrusted text is a ``try_cast``: with ANSI mode on, one bad record
would otherwise fail the whole job.
"""

from __future__ import annotations

import datetime as dt
import re
from decimal import Decimal

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Epoch milliseconds of 0001-01-01 and 9999-12-31: outside of it timestamp_millis
# overflows, or the day cannot be written as yyyy-MM-dd.
MIN_EPOCH_MILLIS = -62_135_596_800_000
MAX_EPOCH_MILLIS = 253_402_300_799_999

DAY_FORMAT = "yyyy-MM-dd"
MILLIS_FORMAT = "yyyy-MM-dd HH:mm:ss.SSS"
SECONDS_FORMAT = "yyyy-MM-dd HH:mm:ss"

# The two JSON timestamp standards, as the sign between day and time. A
# fraction of one to nine digits and a zone (Z or an offset) may follow the time.
TIMESTAMP_STANDARDS = {"SQL": " ", "ISO-8601": "T"}
_DAY, _TIME = r"(\d{4}-\d{2}-\d{2})", r"(\d{2}:\d{2}:\d{2}(?:\.\d{1,9})?)"
_ZONE = r" ?(Z|[+-]\d{2}:?\d{2})?"

_UNITS = {
    "ms": "milliseconds", "millisecond": "milliseconds", "milliseconds": "milliseconds",
    "s": "seconds", "sec": "seconds", "second": "seconds", "seconds": "seconds",
    "m": "minutes", "min": "minutes", "minute": "minutes", "minutes": "minutes",
    "h": "hours", "hour": "hours", "hours": "hours",
    "d": "days", "day": "days", "days": "days",
}


def as_col(value) -> Column:
    """Column as it is, a string as a column name, anything else as a literal."""
    if isinstance(value, Column):
        return value
    return F.col(value) if isinstance(value, str) else F.lit(value)


def as_instant(value) -> Column:
    """An injectable clock reading: a Column, a datetime, ISO text, or None for "now"."""
    if value is None:
        return F.current_timestamp()
    if isinstance(value, Column):
        return value
    if isinstance(value, str):
        return F.expr(f"timestamp_ntz'{value}'")
    return F.lit(value)


def as_day(value) -> Column:
    """An injectable calendar day: a Column, a date, ISO text, or None for today."""
    if value is None:
        return F.current_date()
    if isinstance(value, Column):
        return value.cast("date")
    if isinstance(value, str):
        value = dt.date.fromisoformat(value)
    if isinstance(value, dt.datetime):
        value = value.date()
    return F.lit(value)


def interval_text(text: str) -> str:
    """Normalise ``5s``, ``5 s`` or ``5 seconds`` to the form Spark takes (``5 seconds``)."""
    found = re.fullmatch(r"\s*(\d+)\s*([a-zA-Z]+)\s*", text)
    if not found or found.group(2).lower() not in _UNITS:
        raise ValueError(f"not an interval: {text!r}")
    return f"{int(found.group(1))} {_UNITS[found.group(2).lower()]}"


def epoch_millis(col) -> Column:
    """Text or number to epoch milliseconds; NULL when it is no number or out of range."""
    millis = as_col(col).try_cast("bigint")
    return F.when(millis.between(MIN_EPOCH_MILLIS, MAX_EPOCH_MILLIS), millis)


def millis_to_timestamp(col) -> Column:
    """Epoch milliseconds (text or number) to an instant; NULL when unusable."""
    return F.timestamp_millis(epoch_millis(col))


def millis_to_seconds(col: str) -> Column:
    """Integer division of an epoch-millisecond column, without a detour through DOUBLE."""
    return F.expr(f"try_cast(`{col}` AS bigint) div 1000")


def epoch_seconds(df: DataFrame, ts: str) -> Column:
    """Whole seconds since 1970 of a timestamp column; a zone-less one is read as it stands."""
    if isinstance(df.schema[ts].dataType, T.TimestampNTZType):
        return F.expr(
            f"CAST(CAST(`{ts}` - timestamp_ntz'1970-01-01 00:00:00' AS INTERVAL SECOND) AS bigint)"
        )
    return F.unix_seconds(F.col(ts))


def timestamp_text(col) -> Column:
    """Timestamp as text with a fixed precision of milliseconds."""
    return F.date_format(as_col(col), MILLIS_FORMAT)


def truncate_millis(col) -> Column:
    """Keep milliseconds only (a source column declared with precision 3)."""
    return F.date_trunc("MILLISECOND", as_col(col))


def parse_timestamp(col, standard: str = "SQL", zone: str = "UTC") -> Column:
    """Text to an instant by one of the JSON timestamp standards; NULL when it does not fit.

    Text without a zone is a reading in ``zone``; the session's zone plays no part.
    """
    text, form = as_col(col), f"^{_DAY}{TIMESTAMP_STANDARDS[standard]}{_TIME}{_ZONE}$"
    given = F.regexp_replace(F.regexp_extract(text, form, 3), r"^([+-]\d{2})(\d{2})$", "$1:$2")
    wall = F.concat_ws(" ", F.regexp_extract(text, form, 1), F.regexp_extract(text, form, 2))
    # A fraction beyond microseconds cannot be held.
    wall = F.regexp_replace(wall, r"(\.\d{6})\d+$", "$1")
    zoned = F.concat(wall, F.when(given == "", F.lit(f" {zone}")).otherwise(given))
    return F.when(text.rlike(form), zoned.try_cast("timestamp"))


def utc_wall(instant) -> Column:
    """An instant as UTC wall time without a zone, whatever the session's zone is."""
    seconds = F.unix_micros(as_col(instant)).cast("decimal(18,0)") * F.lit(Decimal("0.000001"))
    return F.expr("timestamp_ntz'1970-01-01 00:00:00'") + F.make_dt_interval(
        F.lit(0), F.lit(0), F.lit(0), seconds.cast("decimal(18,6)")
    )


def to_utc(col, source_zone: str) -> Column:
    """A zone-less reading taken on a server in ``source_zone``, as UTC wall time."""
    wall = as_col(col).cast("timestamp_ntz")
    return F.convert_timezone(F.lit(source_zone), F.lit("UTC"), wall)


def event_day(col, fallback_day=None) -> Column:
    """Day of a timestamp column, or ``fallback_day`` (default: today) where there is none."""
    return F.coalesce(F.to_date(as_col(col)), as_day(fallback_day))


def event_day_from_millis(col, fallback_day=None, zone: str = "UTC") -> Column:
    """Day, in ``zone``, of an epoch-millisecond value, or ``fallback_day`` where it is unusable."""
    wall = F.convert_timezone(F.lit("UTC"), F.lit(zone), utc_wall(millis_to_timestamp(col)))
    return event_day(wall, fallback_day)


def day_text(col) -> Column:
    """Day partition value kept as text, ``yyyy-MM-dd``."""
    return F.date_format(as_col(col), DAY_FORMAT)


def hours_before(as_of, hours: int) -> Column:
    return as_instant(as_of) - F.expr(f"INTERVAL {int(hours)} HOURS")

"""ISO-8601 text and UTC wall-clock times."""

from __future__ import annotations

from datetime import datetime, timedelta

from pyspark.sql import Column
from pyspark.sql import functions as F

_EPOCH = datetime(1970, 1, 1)
_FIRST, _LAST = ((time - _EPOCH) // timedelta(microseconds=1) for time in (datetime.min, datetime.max))


def at(time: datetime | None) -> Column:
    """A fixed wall-clock time, so that a rerun gives the same rows.

    Written as text: a literal from a Python time would pass through the zones of Python and session.
    """
    return F.lit(None if time is None else time.isoformat(sep=" ")).cast("timestamp_ntz")


def parse_iso(text: Column) -> Column:
    """ISO-8601 text to UTC wall-clock time; null when it is no date, with or without a time, or not of the years 0001 to 9999.

    Text without a zone is read as UTC.  The year counts after the zone is applied: a time that a zone moves out of the
    range is unreadable.  The session's time zone and its clock play no part.
    """
    text = F.when(text.rlike(r"^\d{4}-\d{2}-\d{2}(?:[T ]|$)"), text)
    stamped = (
        F.when(text.rlike(r"^\d{4}-\d{2}-\d{2}$"), F.concat(text, F.lit("T00:00:00Z")))
        .when(text.rlike(r"(?:Z|[+-]\d{2}:?\d{2})$"), text)
        .otherwise(F.concat(text, F.lit("Z")))
    )
    micros = F.unix_micros(F.try_to_timestamp(stamped))
    return F.when(micros.between(_FIRST, _LAST), F.timestamp_add("MICROSECOND", micros, at(_EPOCH)))


def format_iso(time: Column) -> Column:
    """UTC wall-clock time to ISO-8601 text with ``Z``; microseconds only where there are any."""
    whole = F.date_format(time, "yyyy-MM-dd'T'HH:mm:ss'Z'")
    exact = F.date_format(time, "yyyy-MM-dd'T'HH:mm:ss.SSSSSS'Z'")
    return F.when(F.date_format(time, "SSSSSS") == "000000", whole).otherwise(exact)


def request_id(kind: str, time: Column) -> Column:
    """``<kind>-<seconds since 1970>``."""
    seconds = F.timestamp_diff("SECOND", at(_EPOCH), time)
    return F.concat(F.lit(f"{kind}-"), seconds.cast("string"))

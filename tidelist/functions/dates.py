"""Date and timestamp functions. The session time zone is UTC (see ``session.configure``)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Cast alone would also accept words such as "yesterday" or "now".
ISO_PATTERN = (
    r"^\s*\d{4}-\d{2}-\d{2}"
    r"([Tt ]\d{2}:\d{2}(:\d{2}(\.\d+)?)?\s*([Zz]|[+-]\d{2}(:?\d{2})?)?)?\s*$"
)


def utc_timestamp(text: Column) -> Column:
    """Instant of an ISO-8601 text (UTC when it names no offset); anything else is NULL."""
    return F.when(text.rlike(ISO_PATTERN), F.upper(F.trim(text)).try_cast("timestamp"))


def millis_timestamp(millis: Column) -> Column:
    return F.timestamp_millis(millis)


def week_start(day: Column) -> Column:
    """Monday of the ISO week."""
    return F.date_trunc("week", day).cast("date")


def days_between(start: Column, end: Column) -> Column:
    return F.date_diff(end, start).cast("bigint")

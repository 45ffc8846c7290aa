"""Time column expressions. Text and naive values are UTC."""

from __future__ import annotations

from datetime import UTC, datetime, timedelta

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import DataType, TimestampType

# The choices a reader has, and what any other choice means.
LOOKBACKS = {
    "5min": timedelta(minutes=5),
    "15min": timedelta(minutes=15),
    "1hour": timedelta(hours=1),
}
LONGEST_LOOKBACK = timedelta(days=1)
DEFAULT_LOOKBACK = "15min"

def lookback(choice: str = DEFAULT_LOOKBACK) -> timedelta:
    """Length of the time range a choice stands for; one day for any other text."""
    return LOOKBACKS.get(choice, LONGEST_LOOKBACK)


def utc_naive(moment: Column, kind: DataType) -> Column:
    """A timestamp of either kind without its zone, in UTC whatever zone the session has."""
    if not isinstance(kind, TimestampType):
        return moment
    return F.timestamp_add("MICROSECOND", F.unix_micros(moment), F.lit("1970-01-01").cast("timestamp_ntz"))


def as_instant(moment: datetime | Column | None, kind: DataType) -> Column:
    """``moment`` as a column of the compared column's own type.

    Equal types keep the comparison free of casts, so it reaches the file scan.
    ``None`` means now; a naive datetime is UTC; a column is cast by the session's rules.
    """
    zoned = isinstance(kind, TimestampType)
    if moment is None:
        now = F.current_timestamp()
        return now if zoned else utc_naive(now, TimestampType())
    if isinstance(moment, Column):
        return moment.cast(kind)
    if moment.tzinfo is not None:
        moment = moment.astimezone(UTC).replace(tzinfo=None)
    return F.lit(moment.isoformat() + "Z" * zoned).cast(kind)


def _text(moment: Column, kind: DataType) -> Column:
    """``yyyy-MM-dd HH:mm:ss`` and the fraction that is not zero, in UTC."""
    return utc_naive(moment, kind).cast("string")


def clock_time(moment: Column, kind: DataType) -> Column:
    """Time of day as shown to a reader."""
    return F.substring(_text(moment, kind), 12, 8)


def iso_text(moment: Column, kind: DataType) -> Column:
    """ISO-8601 text in UTC with all six fractional digits."""
    text = _text(moment, kind)
    fraction = F.rpad(F.substring(text, 21, 6), 6, "0")
    return F.concat(F.substring(text, 1, 10), F.lit("T"), F.substring(text, 12, 8), F.lit("."), fraction)

"""Parameterised queries a reader asks of the stored tables."""

from __future__ import annotations

from datetime import datetime, timedelta

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tickloom.functions import as_instant, clock_time, lookback, two_decimals
from tickloom.functions.times import DEFAULT_LOOKBACK
from tickloom.schema import ALERT_ROWS

HOUR = timedelta(hours=1)


def price_history(
    ticks: DataFrame,
    symbol: str,
    choice: str = DEFAULT_LOOKBACK,
    as_of: datetime | Column | None = None,
) -> DataFrame:
    """A symbol's ticks from ``as_of`` back over the chosen range, oldest first.

    Both ends belong to the range. Where the table is laid out by ``day``, only
    files of the range's days are read.
    """
    end = as_instant(as_of, ticks.schema["timestamp"].dataType)
    start = end - F.lit(lookback(choice))
    wanted = (F.col("symbol") == symbol) & F.col("timestamp").between(start, end)
    if "day" in ticks.columns:
        wanted &= F.col("day").between(F.to_date(start), F.to_date(end))
    return ticks.where(wanted).select("timestamp", "price", "volume").orderBy("timestamp")


def recent_alerts(
    alerts: DataFrame,
    symbol: str,
    as_of: datetime | Column | None = None,
    within: timedelta = HOUR,
    limit: int = ALERT_ROWS,
) -> DataFrame:
    """A symbol's newest alerts, by the end of their window; a top-k report."""
    since = as_instant(as_of, alerts.schema["window_end"].dataType) - F.lit(within)
    return (
        alerts.where((F.col("symbol") == symbol) & (F.col("window_end") >= since))
        .select(F.col("window_end").alias("timestamp"), "alert_type", "value")
        .orderBy(F.desc("timestamp"), "alert_type")
        .limit(limit)
    )


def alert_feed(
    alerts: DataFrame,
    symbol: str,
    as_of: datetime | Column | None = None,
    within: timedelta = HOUR,
    limit: int = ALERT_ROWS,
) -> DataFrame:
    """Recent alerts as shown to a reader: time of day, type, two-decimal value."""
    return recent_alerts(alerts, symbol, as_of, within, limit).select(
        clock_time(F.col("timestamp"), alerts.schema["window_end"].dataType).alias("time"),
        "alert_type",
        two_decimals(F.col("value")).alias("value"),
    )

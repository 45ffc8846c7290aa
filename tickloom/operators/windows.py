"""Tumbling event-time windows per symbol."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tickloom.functions import as_instant, exact_mean, percent_of
from tickloom.schema import WATERMARK_DELAY, WINDOW_WIDTH

WINDOW_KEY = ("symbol", "window_start", "window_end")


def per_window(ticks: DataFrame, width: str, delay: str, *aggregates: Column) -> DataFrame:
    """Aggregate per ``(symbol, window)``; the window as two plain columns.

    A stream needs the window struct as key, for its watermark. A table groups by
    the window start alone: a shorter key, and one that Spark's fast hash map
    takes. Either way tasks aggregate before the shuffle, so a busy symbol
    reaches it as one row per window and task.
    """
    window = F.window("timestamp", width)
    if ticks.isStreaming:
        grouped = ticks.withWatermark("timestamp", delay).groupBy("symbol", window)
        return (
            grouped.agg(*aggregates)
            .withColumn("window_start", F.col("window.start"))
            .withColumn("window_end", F.col("window.end"))
            .drop("window")
        )
    return (
        ticks.withColumn("window_start", window["start"])
        .groupBy("symbol", "window_start")
        .agg(*aggregates)
        .withColumn("window_end", F.col("window_start") + F.expr(f"INTERVAL {width}"))
    )


def windowed_stats(
    ticks: DataFrame,
    width: str = WINDOW_WIDTH,
    delay: str = WATERMARK_DELAY,
    since: datetime | Column | None = None,
) -> DataFrame:
    """All figures of a window in one pass; bars, stats and alerts are cut from it.

    ``volatility`` is the price range in percent of the mean price, null where
    that mean is zero. ``delay`` counts for streams only. ``since`` leaves out
    windows that end before it, and lets the scan skip their ticks.
    """
    if since is not None:
        since = as_instant(since, ticks.schema["timestamp"].dataType)
        ticks = ticks.where(F.col("timestamp") >= since - F.expr(f"INTERVAL {width}"))
    spread = F.col("high") - F.col("low")
    stats = per_window(
        ticks,
        width,
        delay,
        exact_mean("price").alias("ma"),
        F.max("price").alias("high"),
        F.min("price").alias("low"),
        exact_mean("volume").alias("avg_volume"),
    ).select(
        *WINDOW_KEY,
        "ma",
        "high",
        "low",
        "avg_volume",
        spread.alias("price_range"),
        percent_of(spread, F.col("ma")).alias("volatility"),
    )
    return stats if since is None else stats.where(F.col("window_end") >= since)


def price_bars(stats: DataFrame) -> DataFrame:
    """Mean, highest and lowest price and mean volume per window."""
    return stats.select(*WINDOW_KEY, "ma", "high", "low", "avg_volume")


def price_stats(stats: DataFrame) -> DataFrame:
    """Price range and volatility per window."""
    return stats.select(*WINDOW_KEY, "price_range", "volatility")

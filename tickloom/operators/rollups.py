"""Partial aggregates of windows that can be put together, and results cut from them.

A rollup row holds totals, counts, extremes and the first and last price of a symbol's ticks in a window. Rows of
one window add up in any order, so batches, late ticks and coarser windows need no tick again.
Totals are exact; means are divided only when a result is cut.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tickloom.functions import percent_of
from tickloom.operators.indicators import arrival
from tickloom.operators.windows import WINDOW_KEY, per_window
from tickloom.schema import ROLLUP, WATERMARK_DELAY, WINDOW_WIDTH


def rollup(ticks: DataFrame, width: str = WINDOW_WIDTH) -> DataFrame:
    """Rollup rows of ticks, a table or a micro-batch. Ticks without a price count for volume only, and vice versa.

    The first tick is the one with the lowest price of the earliest, the last the one with the highest
    price of the newest, among those with a price.
    """
    at = F.when(F.col("price").isNotNull(), F.col("timestamp"))
    return _shaped(per_window(
        ticks,
        width,
        WATERMARK_DELAY,
        F.sum("price").alias("price_total"),
        F.count("price").alias("price_count"),
        F.max("price").alias("high"),
        F.min("price").alias("low"),
        F.sum("volume").alias("volume_total"),
        F.count("volume").alias("volume_count"),
        F.min(at).alias("first_at"),
        F.min_by("price", arrival("timestamp", "price")).alias("first_price"),
        F.max(at).alias("last_at"),
        F.max_by("price", arrival("timestamp", "price")).alias("last_price"),
    ))


def _merging() -> list[Column]:
    return [
        F.sum("price_total").alias("price_total"),
        F.sum("price_count").alias("price_count"),
        F.max("high").alias("high"),
        F.min("low").alias("low"),
        F.sum("volume_total").alias("volume_total"),
        F.sum("volume_count").alias("volume_count"),
        F.min("first_at").alias("first_at"),
        F.min_by("first_price", arrival("first_at", "first_price")).alias("first_price"),
        F.max("last_at").alias("last_at"),
        F.max_by("last_price", arrival("last_at", "last_price")).alias("last_price"),
    ]


def _shaped(rows: DataFrame) -> DataFrame:
    return rows.select(*[F.col(name).cast(kind).alias(name) for name, kind in ROLLUP.columns.items()])


def merged(rollups: DataFrame) -> DataFrame:
    """One row per symbol and window."""
    return _shaped(rollups.groupBy(*WINDOW_KEY).agg(*_merging()))


def coarser(rollups: DataFrame, width: str) -> DataFrame:
    """Rollups of wider windows; ``width`` is a multiple of the width that the rows have."""
    starts = rollups.withColumn("timestamp", F.col("window_start"))
    return _shaped(per_window(starts, width, WATERMARK_DELAY, *_merging()))


def _mean(what: str) -> Column:
    return F.try_divide(F.col(f"{what}_total").cast("double"), F.col(f"{what}_count"))


def rollup_stats(rollups: DataFrame) -> DataFrame:
    """What ``windowed_stats`` gives, from one rollup row per window; bars, stats and alerts are cut from it."""
    spread = F.col("high") - F.col("low")
    return rollups.select(
        *WINDOW_KEY,
        _mean("price").alias("ma"),
        "high",
        "low",
        _mean("volume").alias("avg_volume"),
        spread.alias("price_range"),
        percent_of(spread, _mean("price")).alias("volatility"),
    )


def rollup_days(rollups: DataFrame) -> DataFrame:
    """What ``daily_stats`` gives, from rollups of any width that divides a day."""
    return coarser(rollups, "1 day").select(
        "symbol", F.col("window_start").alias("date"), "high", "low", _mean("price").alias("avg_price"),
        F.col("volume_total").alias("total_volume"),
    )


def rollup_closes(rollups: DataFrame, width: str = "1 hour") -> DataFrame:
    """What ``closes`` gives."""
    rows = coarser(rollups, width).where("last_price is not null")
    return rows.select(*WINDOW_KEY, F.col("last_price").alias("close"))

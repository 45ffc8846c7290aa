"""Latest tick per symbol and daily summary."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tickloom.functions import exact_mean
from tickloom.operators.windows import per_window
from tickloom.schema import DAILY_VIEW, LATEST_VIEW, WATERMARK_DELAY

# Size of the broadcast side of latest_prices: at most this many rows of two
# 8-byte numbers, whatever the number of ticks and symbols.
FLOOR_BUCKETS = 65536


def _recent_only(ticks: DataFrame) -> DataFrame:
    """Leave out ticks that cannot be the newest of their symbol.

    Symbols are hashed to a fixed number of buckets, and the floor of a bucket is
    the oldest of its symbols' newest timestamps. Finding the floors reads two
    columns and needs no sort; the join keeps the ticks where they are.
    """
    bucket = F.pmod(F.xxhash64("symbol"), F.lit(FLOOR_BUCKETS))
    floors = (
        ticks.groupBy("symbol")
        .agg(F.max("timestamp").alias("newest"))
        .groupBy(bucket.alias("bucket"))
        .agg(F.min("newest").alias("floor"))
    )
    near = ticks.withColumn("bucket", bucket).join(F.broadcast(floors), "bucket")
    return near.where(F.col("timestamp") >= F.col("floor")).drop("bucket", "floor")


def latest_prices(ticks: DataFrame) -> DataFrame:
    """The newest tick of each symbol: larger volume, then price, win a tie.

    ``max_by`` over structs makes Spark sort each task's rows by symbol. A table
    is therefore thinned out first, reading it twice; a micro-batch is small enough.
    Ticks without a timestamp do not count.
    """
    tick = F.struct("price", "volume", "timestamp")
    rank = F.struct("timestamp", "volume", "price")
    dated = ticks.where(F.col("timestamp").isNotNull())
    candidates = dated if ticks.isStreaming else _recent_only(dated)
    return (
        candidates.groupBy("symbol")
        .agg(F.max_by(tick, rank).alias("tick"))
        .select("symbol", "tick.*")
    )


def daily_stats(ticks: DataFrame) -> DataFrame:
    """Highest, lowest and mean price and total volume per symbol and UTC day.

    A day is a window of one day, which gives what truncating to the day gives in
    UTC, without a time zone lookup per tick. Ticks without a timestamp do not count.
    """
    return per_window(
        ticks,
        "1 day",
        WATERMARK_DELAY,
        F.max("price").alias("high"),
        F.min("price").alias("low"),
        exact_mean("price").alias("avg_price"),
        F.sum("volume").alias("total_volume"),
    ).select(
        "symbol", F.col("window_start").alias("date"), "high", "low", "avg_price", "total_volume"
    )


def create_views(ticks: DataFrame) -> None:
    """Register both results as SQL views; they are computed when queried."""
    latest_prices(ticks).createOrReplaceTempView(LATEST_VIEW)
    daily_stats(ticks).createOrReplaceTempView(DAILY_VIEW)

"""Indicators over closing prices: relative strength and trend.

They look back over a number of bars, not over a span of time, so the bars of a
symbol are numbered and cut into blocks of fixed size, each with the few bars
before it as context. No task ever gets a symbol's whole history.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from tickloom.operators.windows import WINDOW_KEY, per_window
from tickloom.schema import WATERMARK_DELAY

BLOCK = 4096
RSI_CHANGES = 14
SHORT_MEAN = 3
LONG_MEAN = 12


def arrival(timestamp: str = "timestamp", price: str = "price") -> Column:
    """Order of ticks as one number: timestamp first, then price; null without a price.

    A decimal key lets Spark aggregate by hash; a struct would make it sort all
    ticks. Sixteen digits before the point leave room for any decimal(18,2).
    """
    micros = F.unix_micros(F.col(timestamp).cast("timestamp")).cast("decimal(19,0)")
    amount = F.coalesce(F.col(price).try_cast("decimal(18,2)"), F.lit(0))
    return F.when(F.col(price).isNotNull(), micros * F.lit(10**16).cast("decimal(17,0)") + amount)


def closes(ticks: DataFrame, width: str = "1 hour", delay: str = WATERMARK_DELAY) -> DataFrame:
    """Price of the newest tick per symbol and window; the higher price wins a tie. ``delay`` counts for streams."""
    priced = ticks.where(F.col("price").isNotNull())
    close = F.max_by("price", arrival()).alias("close")
    return per_window(priced, width, delay, close).select(*WINDOW_KEY, "close")


def numbered(bars: DataFrame) -> DataFrame:
    """Bars with their ``position`` in the symbol's history, counted from 0.

    Counted per month, then shifted by the size of the months before, so that the
    only thing gathered per symbol is one row per month.
    """
    month = F.date_trunc("month", "window_start")
    dated = bars.withColumn("month", month)
    in_month = W.partitionBy("symbol", "month").orderBy("window_start")
    earlier = W.partitionBy("symbol").orderBy("month").rowsBetween(W.unboundedPreceding, -1)
    shifts = (
        dated.groupBy("symbol", "month")
        .agg(F.count("*").alias("size"))
        .select(
            F.col("symbol").alias("of_symbol"),
            F.col("month").alias("of_month"),
            F.coalesce(F.sum("size").over(earlier), F.lit(0)).alias("shift"),
        )
    )
    same = F.col("symbol").eqNullSafe(F.col("of_symbol")) & (F.col("month") == F.col("of_month"))
    return (
        dated.withColumn("place", F.row_number().over(in_month) - 1)
        .join(shifts, same)
        .withColumn("position", F.col("shift") + F.col("place"))
        .select(*bars.columns, "position")
    )


def looking_back(bars: DataFrame, context: int, block: int = BLOCK) -> tuple[DataFrame, W]:
    """Numbered bars in blocks, and a window over a block in time order.

    The last ``context`` bars of a block are repeated in the next one, marked by
    ``lead``. Rows with ``lead`` set are to be dropped after the window.
    """
    own = F.expr(f"position div {block}")
    repeated = F.col("position") % block >= block - context
    targets = F.when(repeated, F.array(own, own + 1)).otherwise(F.array(own))
    blocks = (
        numbered(bars)
        .withColumn("block", F.explode(targets))
        .withColumn("lead", F.col("block") != own)
    )
    return blocks, W.partitionBy("symbol", "block").orderBy("position")


#: Closes before a bar that both indicators look back to.
REACH = max(RSI_CHANGES, LONG_MEAN - 1)


def last_closes(bars: DataFrame, reach: int = REACH) -> DataFrame:
    """The newest closes of each symbol, as many as the next bar's indicators need."""
    newest = W.partitionBy("symbol").orderBy(F.desc("window_start"))
    return bars.withColumn("_n", F.row_number().over(newest)).where(F.col("_n") <= reach).drop("_n")


def rsi(bars: DataFrame, changes: int = RSI_CHANGES, block: int = BLOCK) -> DataFrame:
    """Relative strength index of closing prices, from plain sums of rises and falls.

    ``100 * G / (G + L)`` over the last ``changes`` bar-to-bar changes; null with
    fewer changes or without any movement.
    """
    blocks, in_block = looking_back(bars, changes, block)
    step = F.col("close") - F.lag("close").over(in_block)
    last = in_block.rowsBetween(1 - changes, 0)
    gain = F.sum(F.greatest(F.col("step"), F.lit(0))).over(last)
    loss = F.sum(F.greatest(-F.col("step"), F.lit(0))).over(last)
    moved = (F.col("gain") + F.col("loss")).cast("double")
    strength = F.try_divide(100 * F.col("gain").cast("double"), moved)
    return (
        blocks.withColumn("step", step)
        .withColumn("gain", gain)
        .withColumn("loss", loss)
        .where(~F.col("lead"))
        .select(
            *WINDOW_KEY, "close", F.when(F.col("position") >= changes, strength).alias("rsi")
        )
    )


def trend(
    bars: DataFrame, short: int = SHORT_MEAN, long: int = LONG_MEAN, block: int = BLOCK
) -> DataFrame:
    """Whether the mean of the last closes is above or below a longer mean.

    The means are compared as cross-multiplied sums, which is exact for decimals.
    Null before ``long`` bars exist.
    """
    blocks, in_block = looking_back(bars, long - 1, block)
    near = F.sum("close").over(in_block.rowsBetween(1 - short, 0)) * long
    far = F.sum("close").over(in_block.rowsBetween(1 - long, 0)) * short
    direction = (
        F.when(F.col("position") < long - 1, None)
        .when(F.col("near") > F.col("far"), "up")
        .when(F.col("near") < F.col("far"), "down")
        .otherwise("flat")
    )
    return (
        blocks.withColumn("near", near)
        .withColumn("far", far)
        .where(~F.col("lead"))
        .select(*WINDOW_KEY, "close", direction.alias("trend"))
    )

"""Going on with the open windows of one checkpoint in another, which may have another number of state partitions.

The number of state partitions is fixed by a query's first start. To change it, the query is stopped, its open
windows are read from its state and written beside the new checkpoint, and the new query takes them in with its first
batch as partial aggregates, next to ticks, which are partial aggregates of themselves. Windows that the old
query closed stay closed: ticks of theirs are left out as late.
"""

from __future__ import annotations

import json

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tickloom.functions import as_instant, utc_naive
from tickloom.operators.rollups import rollup_stats
from tickloom.operators.windows import per_window
from tickloom.session import children, exists

#: What the state of a window holds, in the order in which ``windowed_stats`` aggregates it.
STATE = (
    "struct<price_total:decimal(20,2),none:boolean,price_count:bigint,high:decimal(10,2),low:decimal(10,2),"
    "volume_total:bigint,volume_count:bigint>"
)
SEEDS = (
    "symbol STRING, timestamp TIMESTAMP, price_total DECIMAL(20,2), price_count BIGINT, high DECIMAL(10,2), "
    "low DECIMAL(10,2), volume_total BIGINT, volume_count BIGINT"
)
CLOSED = "closed TIMESTAMP"


def seeds_of(checkpoint: str) -> str:
    """The folder beside a checkpoint with the windows that its query begins with."""
    return f"{checkpoint}-seeds"


def open_windows(spark: SparkSession, checkpoint: str, batch: int) -> DataFrame:
    """Windows that are open after a batch of a stopped query, as partial aggregates at the time they start."""
    state = spark.read.format("statestore").option("batchId", batch).load(checkpoint)
    held = F.col("value").cast(STATE)
    names = ["price_total", "price_count", "high", "low", "volume_total", "volume_count"]
    return state.select(
        F.col("key.symbol").alias("symbol"),
        F.col("key.window.start").alias("timestamp"),
        *[held[name].alias(name) for name in names],
    )


def hand_over(spark: SparkSession, old: str, new: str) -> str | None:
    """Write what the query of checkpoint ``new`` begins with, from the stopped query of ``old``.

    The position in the source that the old query had reached comes back, in the source's own words: what
    ``startingOffsets`` takes for a topic. Null for a query that has no batch yet. The checkpoint ``new`` must not have
    been used.
    """
    if exists(spark, new):
        raise ValueError(f"{new} is in use")
    batches = [int(name) for name in children(spark, f"{old}/commits") if name.isdigit()]
    if not batches:
        return None
    last = max(batches)
    lines = [row[0] for row in spark.read.text(f"{old}/offsets/{last}", wholetext=True).collect()]  # a short file
    _, settings, *positions = lines[0].strip().split("\n")
    closed = json.loads(settings)["batchWatermarkMs"]
    folder = seeds_of(new)
    open_windows(spark, old, last).write.mode("overwrite").parquet(f"{folder}/windows")
    mark = spark.range(1).select(F.timestamp_millis(F.lit(closed)).alias("closed"))
    mark.write.mode("overwrite").parquet(f"{folder}/closed")
    return positions[0] if positions else None


def seeded_stats(ticks: DataFrame, folder: str, width: str, delay: str) -> DataFrame:
    """What ``windowed_stats`` gives for a stream that begins with the windows in ``folder``."""
    spark = ticks.sparkSession
    mark = spark.read.schema(CLOSED).parquet(f"{folder}/closed")
    ended = mark.select(utc_naive(F.col("closed"), mark.schema["closed"].dataType)).first()[0]
    timely = F.window("timestamp", width)["end"] > as_instant(ended, ticks.schema["timestamp"].dataType)
    pieces = ticks.where(timely).select(
        "symbol",
        "timestamp",
        F.col("price").cast("decimal(20,2)").alias("price_total"),
        F.col("price").isNotNull().cast("long").alias("price_count"),
        F.col("price").cast("decimal(10,2)").alias("high"),
        F.col("price").cast("decimal(10,2)").alias("low"),
        F.col("volume").cast("long").alias("volume_total"),
        F.col("volume").isNotNull().cast("long").alias("volume_count"),
    )
    seeds = spark.readStream.schema(SEEDS).parquet(f"{folder}/windows")
    windows = per_window(
        pieces.unionByName(seeds),
        width,
        delay,
        F.sum("price_total").cast("decimal(28,2)").alias("price_total"),
        F.sum("price_count").alias("price_count"),
        F.max("high").alias("high"),
        F.min("low").alias("low"),
        F.sum("volume_total").alias("volume_total"),
        F.sum("volume_count").alias("volume_count"),
    )
    return rollup_stats(windows)

"""The ``events`` table of the test data, read as ticks."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tickloom.sources.wire import tick_text


def ticks_from_events(events: DataFrame) -> DataFrame:
    """Each event is a tick: its type the symbol, its value the price.

    A stream gets zoned timestamps, which watermarks need.
    """
    return events.select(*_tick_columns(events))


def _tick_columns(events: DataFrame) -> list[Column]:
    moment = F.col("ts").cast("timestamp") if events.isStreaming else F.col("ts")
    level = F.regexp_extract("props", r'"k": (\d+)', 1).try_cast("int")
    return [
        F.col("event_type").alias("symbol"),
        F.col("value").cast("decimal(18,2)").alias("price"),
        (level * 1000).alias("volume"),
        moment.alias("timestamp"),
    ]


def messages_from_events(events: DataFrame, *kept: str) -> DataFrame:
    """A topic message for every event, and beside it a damaged one for every tenth ``event_id``.

    Columns named ``kept`` stay beside the message.

    In turn: cut off, text instead of JSON, a wrongly typed price, an object without the fields of a
    tick, something after the object, and two objects.
    """
    numbered = events.select("event_id", *kept, *_tick_columns(events))
    numbered = numbered.withColumn("text", tick_text(numbered))
    text, turn = F.col("text"), F.expr("event_id div 10 % 6")
    damaged = (
        F.when(turn == 0, F.rtrim(text, F.lit("}")))
        .when(turn == 1, F.col("symbol"))
        .when(turn == 2, F.regexp_replace(text, r'"price":[\d.]+', '"price":"high"'))
        .when(turn == 3, "{}")
        .when(turn == 4, F.concat(text, F.lit(" and more")))
        .otherwise(F.concat(text, text))
    )
    both = F.when(F.col("event_id") % 10 == 0, F.array(text, damaged)).otherwise(F.array(text))
    return numbered.select(*kept, F.explode(both).alias("value")).withColumn("value", F.col("value").cast("binary"))

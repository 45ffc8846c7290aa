"""JSON messages to typed ticks and back."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType

from tickloom.functions import iso_text
from tickloom.schema import TICK_FIELDS

_BROKEN, _ENDED, _ALONE = "_broken", "_ended", "_alone"
_FIELDS = ("symbol", "price", "volume", "timestamp")


def _reason() -> Column:
    """Why a parsed message is no tick; null for a good one.

    A message may parse and still lack a field, so each field is looked at.
    """
    missing = [F.when(F.col(name).isNull(), F.lit(name)) for name in _FIELDS]
    endless = F.isnan("price") | (F.abs("price") == F.lit(float("inf")))
    malformed = "malformed message"
    return (
        F.when(F.col("value").isNull(), "empty message")
        .when(F.col(_BROKEN).isNotNull() | ~F.coalesce(_ENDED, F.lit(False)), malformed)
        .when(endless, "price is not a number")
        .when(~F.coalesce(_ALONE, F.lit(False)), malformed)
        .when(
            F.coalesce(*missing).isNotNull(),
            F.concat(F.lit("missing "), F.concat_ws(", ", *missing)),
        )
    )


def parse_messages(messages: DataFrame) -> DataFrame:
    """Tick fields next to the message ``value`` and a ``reason``, one row each.

    Spark's parser stops after the first JSON value and says nothing of what follows. So a message
    is parsed as a member of an object with another member behind it, which is lost if the message holds
    anything but one value; and it must make an array of one element.

    The record is spread by ``inline`` rather than by ``data.*``: later filters
    cannot be moved below a generator, where they would parse the message again
    for every field they look at.
    """
    text = F.col("value")
    framed = F.from_json(
        F.concat(F.lit('{"tick":'), text, F.lit(f',"{_ENDED}":true}}')),
        f"tick STRUCT<{TICK_FIELDS}>, {_ENDED} BOOLEAN, {_BROKEN} STRING",
        {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": _BROKEN, "timeZone": "UTC"},
    )
    alone = F.json_array_length(F.concat(F.lit("["), text, F.lit("]"))) == 1
    return (
        messages.select(text.cast("string").alias("value"))
        .select("value", alone.alias(_ALONE), F.inline(F.array(framed)))
        .select(*[F.col(f"tick.{name}").alias(name) for name in _FIELDS], "value", _BROKEN, _ENDED, _ALONE)
        .select(*_FIELDS, "value", _reason().alias("reason"))
    )


def decode_ticks(messages: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Split messages into ticks and quarantined ``(value, reason)`` rows."""
    parsed = parse_messages(messages)
    ticks = parsed.where(F.col("reason").isNull()).select(*_FIELDS)
    rejected = parsed.where(F.col("reason").isNotNull()).select("value", "reason")
    return ticks, rejected


def tick_text(ticks: DataFrame) -> Column:
    """The JSON object for a tick. ``to_json`` alone would cut the microseconds."""
    price = F.col("price")
    if isinstance(ticks.schema["price"].dataType, DoubleType):
        price = F.round(price, 2).alias("price")
    moment = iso_text(F.col("timestamp"), ticks.schema["timestamp"].dataType).alias("timestamp")
    return F.to_json(F.struct("symbol", price, "volume", moment))


def encode_ticks(ticks: DataFrame) -> DataFrame:
    """One JSON object per tick in the binary column ``value``."""
    return ticks.select(tick_text(ticks).cast("binary").alias("value"))

"""Threshold alerts on windowed stats."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tickloom.operators.windows import WINDOW_KEY
from tickloom.schema import PRICE_ALERT, VOLATILITY_LIMIT, VOLUME_ALERT, VOLUME_LIMIT


def _alert(label: str, figure: str, limit: float) -> Column:
    """One rule: its label, its figure, and whether the figure is over the limit."""
    value = F.col(figure)
    return F.struct(
        F.lit(label).alias("alert_type"), value.alias("value"), (value > limit).alias("hit")
    )


def _raise(stats: DataFrame, *rules: Column) -> DataFrame:
    """A row per window and rule that hits.

    Windows are read once for all rules. A union of filtered copies would
    aggregate the ticks once per rule, and on a stream keep the state twice.
    """
    alert = ("alert_type", "value")
    return (
        stats.select(*WINDOW_KEY, F.inline(F.array(*rules)))
        .where("hit")
        .select(*WINDOW_KEY, *alert)
    )


def price_alerts(stats: DataFrame, volatility_limit: float = VOLATILITY_LIMIT) -> DataFrame:
    """Windows whose volatility is above the limit, not at it."""
    return _raise(stats, _alert(PRICE_ALERT, "volatility", volatility_limit))


def volume_alerts(stats: DataFrame, volume_limit: float = VOLUME_LIMIT) -> DataFrame:
    """Windows whose mean volume is above the limit, not at it."""
    return _raise(stats, _alert(VOLUME_ALERT, "avg_volume", volume_limit))


def detect_alerts(
    stats: DataFrame,
    volatility_limit: float = VOLATILITY_LIMIT,
    volume_limit: float = VOLUME_LIMIT,
) -> DataFrame:
    """Price and volume alerts together; a window can raise both."""
    return _raise(
        stats,
        _alert(PRICE_ALERT, "volatility", volatility_limit),
        _alert(VOLUME_ALERT, "avg_volume", volume_limit),
    )

"""Numeric column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def exact_mean(name: str) -> Column:
    """Mean as one division of an exact total by a count.

    Decimals and integers add up exactly, so the result does not depend on row
    order or on the number of tasks. Null for a group without values.
    """
    return F.try_divide(F.sum(name).cast("double"), F.count(name))


def percent_of(part: Column, whole: Column) -> Column:
    """``part`` in percent of ``whole``; null where ``whole`` is zero."""
    return F.try_divide(part.cast("double"), whole) * 100


def two_decimals(value: Column) -> Column:
    """Text with two decimal places."""
    return F.format_string("%.2f", value.cast("double"))

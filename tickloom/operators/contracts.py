"""Fitting rows to a target table."""

from __future__ import annotations

from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tickloom.functions import iso_text, utc_naive
from tickloom.schema import Contract


def _value(name: str, rows: DataFrame, contract: Contract) -> Column:
    """A column in the contract's type, null where it has none; naive times are UTC."""
    column, kind = F.col(name), contract.columns[name]
    if kind == "TIMESTAMP_NTZ":
        column = utc_naive(column, rows.schema[name].dataType)
    return column.try_cast(kind)


def fits(rows: DataFrame, contract: Contract) -> Column:
    """Whether every value has a non-null counterpart in the contract's type."""

    def one(name: str) -> Column:
        good, limit = _value(name, rows, contract).isNotNull(), contract.lengths.get(name)
        return good if limit is None else good & (F.char_length(name) <= limit)

    return F.coalesce(reduce(and_, map(one, contract.columns)), F.lit(False))


def cast_to(rows: DataFrame, contract: Contract) -> DataFrame:
    """Rows in the contract's columns and types; prices are rounded half up."""
    return rows.select(*[_value(name, rows, contract).alias(name) for name in contract.columns])


def misfit(contract: Contract) -> str:
    """Why a row that breaks a contract is quarantined."""
    return f"does not fit {contract.table}"


def conform(rows: DataFrame, contract: Contract) -> tuple[DataFrame, DataFrame]:
    """Split rows into those cast to the contract and those that break it.

    Broken rows (null, too long, out of range) keep their original values.
    """
    good = fits(rows, contract)
    return cast_to(rows.where(good), contract), rows.where(~good).select(*contract.columns)


def as_quarantine(rows: DataFrame, reason: str) -> DataFrame:
    """Broken rows in the shape of the quarantine table, times as ISO text in UTC."""
    moments = [f.name for f in rows.schema if f.dataType.typeName().startswith("timestamp")]
    shown = rows.withColumns({n: iso_text(F.col(n), rows.schema[n].dataType) for n in moments})
    return shown.select(F.to_json(F.struct(*shown.columns)).alias("value"), F.lit(reason).alias("reason"))

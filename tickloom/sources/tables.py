"""Stored tables: parquet folders or relational tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from tickloom.schema import ALERTS, TICKS, Contract
from tickloom.sources.rewrites import counting, rewrites


def jdbc_options(contract: Contract, given: dict[str, str]) -> dict[str, str]:
    """Options for reading a table. Its timestamps have no zone and are read that
    way, so that predicates on them need no cast and reach the database."""
    return {"dbtable": contract.table, "preferTimestampNTZ": "true", **given}


def read_table(
    spark: SparkSession,
    contract: Contract,
    path: str | None = None,
    jdbc: dict[str, str] | None = None,
) -> DataFrame:
    """A table as a lazy scan; predicates and columns are pushed into either kind.

    Of a table that was rewritten, the folders that count are read, as they are now: a rewrite
    that ends later changes nothing for this scan. ``jdbc`` options pass through, ``partitionColumn`` and its bounds
    included.
    """
    if path is not None:
        rows = spark.read.parquet(path)
        stored_by_job = {"day", "source", "batch_id"} <= set(rows.columns)
        return counting(rows, rewrites(spark, path)) if stored_by_job else rows
    if jdbc is None:
        raise ValueError("give a path or JDBC options")
    return spark.read.format("jdbc").options(**jdbc_options(contract, jdbc)).load()


def read_ticks(
    spark: SparkSession, path: str | None = None, jdbc: dict[str, str] | None = None
) -> DataFrame:
    return read_table(spark, TICKS, path, jdbc)


def read_alerts(
    spark: SparkSession, path: str | None = None, jdbc: dict[str, str] | None = None
) -> DataFrame:
    return read_table(spark, ALERTS, path, jdbc)

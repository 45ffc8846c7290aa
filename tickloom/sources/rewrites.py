"""Which folders of a stored table count, by its record of rewrites.

The record is a small table in ``_rewrites`` below the table: for each rewrite, a row per day and checkpoint that
it took in, with the last batch of it. Conditions are on the columns that name folders, so
a scan lists and reads only folders that count.
"""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Iterable
from functools import reduce
from operator import or_

from pyspark.sql import Column, DataFrame, Row, SparkSession
from pyspark.sql import functions as F

from tickloom.session import exists

# ``published`` is in microseconds since 1970.
#: The checkpoint that rewritten rows claim to be from; their batch is the number of the rewrite.
REWRITTEN = "rewritten"
REWRITES = "day DATE, source STRING, last BIGINT, version BIGINT, published BIGINT"


def rewrites(spark: SparkSession, path: str) -> list[Row]:
    """The record of a table: some rows per rewritten day."""
    folder = f"{path}/_rewrites"
    if not exists(spark, folder):
        return []
    return spark.read.schema(REWRITES).parquet(folder).collect()


def newest_rewrites(done: Iterable) -> dict[tuple, Row]:
    """The entry that takes in most, per day and checkpoint."""
    found: dict[tuple, Row] = {}
    for row in done:
        key = row["day"], row["source"]
        if key not in found or row["last"] > found[key]["last"]:
            found[key] = row
    return found


def record(entries: Iterable) -> Column:
    """Whether a row is in a folder that one of the entries ``(day, source, last, ...)`` takes in."""
    days = defaultdict(list)
    for day, source, last, *_ in entries:
        days[source, last].append(day)
    parts = [
        (F.col("source") == source) & (F.col("batch_id") <= last) & F.col("day").isin(sorted(of))
        for (source, last), of in sorted(days.items())
    ]
    return reduce(or_, parts, F.lit(False))


def counting(rows: DataFrame, done: list[Row]) -> DataFrame:
    """Rows of folders that count: batches no rewrite took in, and the newest rewrite of each day."""
    if not done:
        return rows.where(F.col("source") != REWRITTEN)
    newest: dict = {}
    for row in done:
        newest[row["day"]] = max(newest.get(row["day"], 0), row["version"])
    days = defaultdict(list)
    for day, version in newest.items():
        days[version].append(day)
    current = [(F.col("batch_id") == v) & F.col("day").isin(sorted(of)) for v, of in sorted(days.items())]
    taken = record(r for r in newest_rewrites(done).values() if r["source"] != REWRITTEN)
    rewritten = F.col("source") == REWRITTEN
    return rows.where((rewritten & reduce(or_, current)) | (~rewritten & ~taken))

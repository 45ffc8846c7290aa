"""Rewriting closed days of stored tables into few files.

A micro-batch leaves a folder per day, so a table that a stream fills has ever more small files. A
rewrite reads the batches of days that are over, writes their rows sorted into a folder of its own, and
then publishes it by one small file in the table's record of rewrites. Readers take from that record which folders
count: until the file is there the batches, from then on the rewritten folder. Batches that come later for such a day
are read beside it, until the next rewrite takes them in. A batch that is repeated after its rows
were rewritten leaves those days out. Folders that no longer count are deleted by ``clean`` after a time, so that
queries that began before a rewrite still find their files.

One rewrite of a table may run at a time.
"""

from __future__ import annotations

from collections.abc import Callable
from datetime import UTC, date, datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tickloom.schema import Contract
from tickloom.session import children, remove
from tickloom.sources.rewrites import REWRITES, REWRITTEN, counting, newest_rewrites, record, rewrites

Combine = Callable[[DataFrame], DataFrame]


def compact(
    spark: SparkSession,
    tables,
    contract: Contract,
    before: date,
    combine: Combine | None = None,
    least: int = 2,
) -> int:
    """Rewrite the days before ``before`` that have at least ``least`` folders; the number of days comes back.

    ``combine`` may put rows together that the batches of a day brought apart, such as rollups. A day's files
    are as many as its bytes ask for: the sort's shuffle has ranges of the session's advisory size.
    """
    if contract.time is None:
        raise ValueError(f"rows of {contract.table} have no time")
    path = tables.path(contract)
    done = rewrites(spark, path)
    live = counting(tables.scan(spark, contract), done).where(F.col("day") < F.lit(before))
    found = live.groupBy("day", "source").agg(
        F.max("batch_id").alias("last"), F.count_distinct("batch_id").alias("folders")
    )
    found = found.collect()  # a row per day and checkpoint
    folders: dict[date, int] = {}
    for row in found:
        folders[row["day"]] = folders.get(row["day"], 0) + row["folders"]
    wanted = [row for row in found if folders[row["day"]] >= least]
    if not wanted:
        return 0
    version = 1 + max((row["version"] for row in done), default=0)
    days = sorted({row["day"] for row in wanted})
    # what comes in from here on is left for the next time
    limits = [(row["day"], row["source"], row["last"], version, None) for row in wanted]
    rows = live.where(F.col("day").isin(days)).where(record(limits))
    rows = rows.select(*contract.columns)
    if combine is not None:
        rows = combine(rows)
    order = ["day", "symbol", contract.time]
    rows = rows.withColumn("day", F.to_date(contract.time)).repartitionByRange(*order)
    marked = rows.sortWithinPartitions(*order).withColumns(
        {"source": F.lit(REWRITTEN), "batch_id": F.lit(version).cast("long")}
    )
    tables.overwrite(marked, contract)
    entries = spark.createDataFrame(limits, REWRITES).withColumn("published", F.unix_micros(F.current_timestamp()))
    entries.coalesce(1).write.mode("append").parquet(f"{path}/_rewrites")
    return len(days)


def clean(spark: SparkSession, tables, contract: Contract, before: datetime) -> int:
    """Delete folders that stopped to count before a point in time (naive: UTC); their number comes back."""
    limit = before if before.tzinfo else before.replace(tzinfo=UTC)
    path = tables.path(contract)
    every = rewrites(spark, path)
    done = [row for row in every if row["published"] < limit.timestamp() * 1_000_000]
    gone = 0
    for (day, source), row in newest_rewrites(done).items():
        folder = f"{path}/day={day}/source={source}"
        for name, batch in _batches(spark, folder):
            if batch <= row["last"] and source != REWRITTEN:
                remove(spark, f"{folder}/{name}")
                gone += 1
    kept: dict[date, int] = {}
    for row in done:
        kept[row["day"]] = max(kept.get(row["day"], 0), row["version"])
    for day, version in kept.items():
        folder = f"{path}/day={day}/source={REWRITTEN}"
        for name, batch in _batches(spark, folder):
            if batch < version:
                remove(spark, f"{folder}/{name}")
                gone += 1
    return gone


def _batches(spark: SparkSession, folder: str) -> list[tuple[str, int]]:
    names = [name for name in children(spark, folder) if name.startswith("batch_id=")]
    return [(name, int(name.partition("=")[2])) for name in names]

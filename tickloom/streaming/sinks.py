"""Writing micro-batches to tables, so that a repeated batch changes nothing."""

from __future__ import annotations

import json
import logging
from collections.abc import Callable
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass, replace
from datetime import datetime
from functools import partial, reduce
from typing import Protocol

from pyspark import StorageLevel, inheritable_thread_target
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from tickloom.functions import as_instant
from tickloom.operators.contracts import as_quarantine, conform, misfit
from tickloom.schema import HIGH_WATER, KEYED_TICKS, LEDGER, QUARANTINE, TICKS, Contract
from tickloom.session import children, exists, remove
from tickloom.sources.rewrites import counting, record, rewrites
from tickloom.sources.tables import read_table

log = logging.getLogger(__name__)

@dataclass(frozen=True)
class Batch:
    """A micro-batch. Ids count per checkpoint, so the checkpoint's own id belongs to it.

    ``again`` is false for a batch that cannot be a repeat: any but the first after a start. ``rows`` is
    about how many rows it has, where that is known.
    """

    query: str
    id: int
    run: str = ""
    again: bool = True
    rows: int | None = None

    @property
    def source(self) -> str:
        return f"{self.query}-{self.run}" if self.run else self.query


#: Rows that one task of a write takes, about, where the size of a batch is known.
ROWS_PER_TASK = 500_000


def in_tasks(rows: DataFrame, tasks: int | None, batch: Batch) -> DataFrame:
    """Rows in at most ``tasks`` tasks, and in no more than their number asks for."""
    if batch.rows is not None:
        wanted = -(-batch.rows // ROWS_PER_TASK) or 1
        tasks = wanted if tasks is None else min(tasks, wanted)
    return rows if tasks is None else rows.coalesce(tasks)


class Tables(Protocol):
    """A set of target tables."""

    def create(self, spark: SparkSession, *contracts: Contract) -> None: ...

    def append(self, rows: DataFrame, contract: Contract, batch: Batch) -> None: ...

    def merge(
        self,
        rows: DataFrame,
        contract: Contract,
        batch: Batch,
        combine: Callable[[DataFrame], DataFrame],
    ) -> None: ...

    def advance(self, spark: SparkSession, batch: Batch) -> None: ...


@dataclass(frozen=True)
class ParquetTables:
    """Tables as folders below ``root``, partitioned by checkpoint and micro-batch.

    Writing a batch again replaces its own partitions and no other; a new checkpoint has an id of
    its own and so adds to what older ones stored. Tables of rows with a time are partitioned by day
    first and sorted by symbol and time within a file, so that scans for one symbol and a time range read a few
    row groups of a few days; their days can be rewritten (see ``compaction``). ``tasks`` bounds the tasks, and so
    the files, of one write; without it a write has the tasks of its batch.
    """

    root: str
    tasks: int | None = None

    def path(self, contract: Contract) -> str:
        return f"{self.root}/{contract.table}"

    def parts(self, contract: Contract) -> list[str]:
        return [*(["day"] if contract.time else []), "source", "batch_id"]

    def create(self, spark: SparkSession, *contracts: Contract) -> None:
        """Make tables that are not there yet, so that those without rows can be read."""
        for contract in contracts:
            if not exists(spark, self.path(contract)):
                empty = spark.createDataFrame([], self._ddl(contract))
                empty.write.mode("append").partitionBy(self.parts(contract)).parquet(self.path(contract))

    def append(self, rows: DataFrame, contract: Contract, batch: Batch) -> None:
        """Write a batch. If it is a repeat, days that were rewritten with its rows are left out."""
        marked = in_tasks(rows, self.tasks, batch).withColumns(
            {"source": F.lit(batch.source), "batch_id": F.lit(batch.id).cast("long")}
        )
        if contract.time:
            marked = marked.withColumn("day", F.to_date(contract.time))
            done = rewrites(rows.sparkSession, self.path(contract)) if batch.again else []
            if done:
                marked = marked.where(~record(done))
            marked = marked.sortWithinPartitions("day", "symbol", contract.time)
        self.overwrite(marked, contract)

    def overwrite(self, marked: DataFrame, contract: Contract) -> None:
        """Replace the folders that rows with all partition columns belong to, and no others."""
        writer = marked.write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
        writer.partitionBy(self.parts(contract)).parquet(self.path(contract))

    def merge(
        self,
        rows: DataFrame,
        contract: Contract,
        batch: Batch,
        combine: Callable[[DataFrame], DataFrame],
    ) -> None:
        """Put the batch together with the state before it and store that as the new state."""
        state = self.state_before(rows.sparkSession, contract, batch)
        self.put_state(rows if state is None else combine(state.unionByName(rows)), contract, batch)

    def state_before(self, spark: SparkSession, contract: Contract, batch: Batch) -> DataFrame | None:
        """What the batch before stored as state."""
        earlier = [i for i in self._states(spark, contract, batch) if i < batch.id]
        if not earlier:
            return None
        return spark.read.schema(contract.ddl).parquet(self._state(contract, batch, earlier[-1]))

    def put_state(self, rows: DataFrame, contract: Contract, batch: Batch) -> None:
        """Store rows as the state after a batch.

        States older than the one before are deleted: a repeated batch still finds what it needs.
        """
        self.append(rows, contract, batch)
        for old in [i for i in self._states(rows.sparkSession, contract, batch) if i < batch.id][:-1]:
            remove(rows.sparkSession, self._state(contract, batch, old))

    def _state(self, contract: Contract, batch: Batch, id: int) -> str:
        return f"{self.path(contract)}/source={batch.source}/batch_id={id}"

    def _states(self, spark: SparkSession, contract: Contract, batch: Batch) -> list[int]:
        """Batches whose state is stored, two or three, in order."""
        names = children(spark, f"{self.path(contract)}/source={batch.source}")
        return sorted(int(n.partition("=")[2]) for n in names if n.startswith("batch_id="))

    def advance(self, spark: SparkSession, batch: Batch) -> None:
        """Move the high-water mark, a state of one row, on to the newest tick that a batch stored.

        That tick is in the newest day that the batch has a folder of, so only this folder is read.
        """
        path, newest = self.path(TICKS), None
        for day in sorted((n for n in children(spark, path) if n.startswith("day=")), reverse=True):
            folder = f"{path}/{day}/source={batch.source}/batch_id={batch.id}"
            if exists(spark, folder):
                newest = spark.read.schema(TICKS.ddl).parquet(folder).agg(F.max("timestamp")).first()[0]
                break
        mark = spark.createDataFrame([(newest,)], HIGH_WATER.ddl)
        self.merge(mark, HIGH_WATER, batch, lambda both: both.agg(F.max("newest").alias("newest")))

    def newest(self, spark: SparkSession) -> datetime | None:
        """Time of the newest tick stored, from the high-water mark of each checkpoint."""
        return self.read_state(spark, HIGH_WATER).agg(F.max("newest")).first()[0]

    def read(self, spark: SparkSession, contract: Contract) -> DataFrame:
        """The whole table. The schema is given, so a table without rows reads too."""
        rows = self.scan(spark, contract)
        if contract.time:
            rows = counting(rows, rewrites(spark, self.path(contract)))
        extra = ["day"] if contract is TICKS else []
        return rows.select(*contract.columns, *extra)

    def read_state(self, spark: SparkSession, contract: Contract) -> DataFrame:
        """The newest state that each checkpoint merged."""
        rows = self.scan(spark, contract)
        newest = rows.groupBy("source").agg(F.max("batch_id").alias("batch_id"))
        return rows.join(newest, ["source", "batch_id"], "left_semi").select(*contract.columns)

    def _ddl(self, contract: Contract) -> str:
        kinds = {"day": "DATE", "source": "STRING", "batch_id": "BIGINT"}
        return ", ".join([contract.ddl, *(f"{n} {kinds[n]}" for n in self.parts(contract))])

    def scan(self, spark: SparkSession, contract: Contract) -> DataFrame:
        """All folders of a table, whether they count or not, with the columns that name them."""
        return spark.read.schema(self._ddl(contract)).parquet(self.path(contract))


def write_jdbc(
    rows: DataFrame, table: str, options: dict[str, str], mode: str = "append"
) -> None:
    """Write to a relational table; a failure is logged and raised.

    Each partition opens a connection: bound them with the ``numPartitions`` option.
    """
    try:
        rows.write.format("jdbc").options(**options).option("dbtable", table).mode(mode).save()
    except Exception:
        log.exception("writing table %s failed", table)
        raise


def unseen(rows: DataFrame, stored: DataFrame, key: tuple[str, ...]) -> DataFrame:
    """Rows whose key is not stored yet."""
    return rows.join(stored.select(*key), list(key), "left_anti")


@dataclass(frozen=True)
class JdbcTables:
    """Relational tables reached with the given JDBC options.

    JDBC only appends. Windows and alerts have a natural key, so a repeated batch
    adds just the keys that are missing, looked up within the batch's own range of
    window starts. Ticks have no key: a batch that failed half-way can leave
    duplicates there, which the parquet tables avoid. ``tasks`` bounds the connections of one write.

    With ``ledger`` the table of ticks has the further columns of ``KEYED_TICKS``, and ``LEDGER`` names the batches
    that are stored as a whole. A tick is known by its batch, a hash of its values and its number among
    equal ones, none of which depends on the order of rows, so a repeated batch adds what is missing.
    """

    options: dict[str, str]
    tasks: int | None = None
    ledger: bool = False

    def create(self, spark: SparkSession, *contracts: Contract) -> None:
        """Relational tables are made by their owner."""

    def append(self, rows: DataFrame, contract: Contract, batch: Batch) -> None:
        rows = in_tasks(rows, self.tasks, batch)
        if contract is TICKS and self.ledger:
            self._append_keyed(rows, batch)
            return
        if contract.key:
            starts = F.min("window_start").alias("first"), F.max("window_start").alias("last")
            first, last = rows.agg(*starts).first()
            if first is None:
                return
            stored = read_table(rows.sparkSession, contract, jdbc=self.options)
            kind = stored.schema["window_start"].dataType
            span = as_instant(first, kind), as_instant(last, kind)
            rows = unseen(rows, stored.where(F.col("window_start").between(*span)), contract.key)
        write_jdbc(rows, contract.table, self.options)

    def _append_keyed(self, rows: DataFrame, batch: Batch) -> None:
        """Ticks first, the batch's entry in the ledger last; only a batch that may be a repeat is looked up."""
        spark = rows.sparkSession
        own = (F.col("source") == batch.source) & (F.col("batch_id") == batch.id)
        equal = Window.partitionBy(*TICKS.columns).orderBy("row_key")
        keyed = rows.select(
            *TICKS.columns,
            F.lit(batch.source).alias("source"),
            F.lit(batch.id).cast("long").alias("batch_id"),
            F.xxhash64(*TICKS.columns).alias("row_key"),
        ).withColumn("row_no", F.row_number().over(equal))
        if batch.again:
            if not read_table(spark, LEDGER, jdbc=self.options).where(own).isEmpty():
                return
            keyed = unseen(keyed, read_table(spark, KEYED_TICKS, jdbc=self.options).where(own), KEYED_TICKS.key)
        write_jdbc(keyed.select(*KEYED_TICKS.columns), TICKS.table, self.options)
        write_jdbc(spark.createDataFrame([(batch.source, batch.id)], LEDGER.ddl), LEDGER.table, self.options)

    def merge(
        self,
        rows: DataFrame,
        contract: Contract,
        batch: Batch,
        combine: Callable[[DataFrame], DataFrame],
    ) -> None:
        """Appends changes; a reader combines them, as the latest-price view does."""
        self.append(rows, contract, batch)

    def advance(self, spark: SparkSession, batch: Batch) -> None:
        """A database finds its newest time by an index."""


def store(
    parts: list[tuple[DataFrame, Contract]],
    tables: Tables,
    batch: Batch,
    quarantine: DataFrame | None = None,
) -> None:
    """Fit each part to its contract and write it; what does not fit is quarantined.

    The tables are written at the same time, each by jobs of its own.
    """

    def write_good(rows: DataFrame, contract: Contract) -> None:
        tables.append(conform(rows, contract)[0], contract, batch)

    def write_rejected() -> None:
        broken = [as_quarantine(conform(rows, contract)[1], misfit(contract)) for rows, contract in parts]
        whole = reduce(DataFrame.unionByName, broken if quarantine is None else [quarantine, *broken])
        if not whole.isEmpty():
            tables.append(whole, QUARANTINE, batch)

    writes = [partial(write_good, *part) for part in parts]
    spark = (parts[0][0] if parts else quarantine).sparkSession
    with ThreadPoolExecutor(len(writes) + 1) as threads:
        # threads take over the properties of this one, so that their jobs end with the query
        started = [threads.submit(inheritable_thread_target(spark)(write)) for write in [*writes, write_rejected]]
        for write in started:
            write.result()


def checkpoint_id(spark: SparkSession, checkpoint: str) -> str:
    """The id that Spark gave a checkpoint when it was first used."""
    lines = spark.read.text(f"{checkpoint}/metadata").collect()  # one short line
    return json.loads("".join(r[0] for r in lines))["id"]


def start_sink(
    stream: DataFrame,
    name: str,
    checkpoint: str,
    write: Callable[[DataFrame, Batch], None],
    mode: str = "append",
    trigger: dict | None = None,
    keep: bool = True,
) -> StreamingQuery:
    """Start a query that hands each micro-batch with rows to ``write(rows, batch)``.

    With ``keep`` the batch is computed once and kept while it feeds several tables, which suits
    aggregates. Losing the kept blocks costs a recomputation from the source, not the result. Without,
    every table that is written computes it anew, which suits large batches of plain rows.
    """
    runs: list[str] = []

    def write_batch(rows: DataFrame, batch_id: int) -> None:
        if not runs:
            runs.append(checkpoint_id(rows.sparkSession, checkpoint))
            batch = Batch(name, batch_id, runs[0])
        else:
            batch = Batch(name, batch_id, runs[0], again=False)
        if not keep:
            write(rows, batch)
            return
        kept = rows.persist(StorageLevel.MEMORY_AND_DISK)
        try:
            size = kept.count()
            if size:
                write(kept, replace(batch, rows=size))
        finally:
            kept.unpersist()

    writer = (
        stream.writeStream.queryName(name)
        .foreachBatch(write_batch)
        .outputMode(mode)
        .option("checkpointLocation", checkpoint)
    )
    if trigger:
        writer = writer.trigger(**trigger)
    return writer.start()
